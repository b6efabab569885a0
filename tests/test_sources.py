from __future__ import annotations

import datetime
import json

import pytest
from pyspark.sql import functions as F

from txrisk import schemas
from txrisk.operators.facts import clean
from txrisk.sources import code_maps, parquet, tables, workspace

HEADER = "id,date,client_id,card_id,amount,merchant_id,merchant_city,zip,mcc,errors"


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_transactions_from_csv(spark, tmp_path):
    path = write(
        tmp_path / "transactions_data.csv",
        HEADER,
        '0,2024-01-15 10:30:00,10,4524,"$1,200.00",7,ONLINE,,5812,',
        "1,2024-01-15 18:45:00,10,4524,$-77.00,7,Beulah,01234,,\"Bad PIN,Technical Glitch\"",
        "2,bad,ten,4524,free,7,Beulah,01234,5812,",
    )
    raw = tables.read_transactions(spark, path)
    assert raw.schema.simpleString() == schemas.TRANSACTIONS.simpleString()
    first, second, third = clean(raw).orderBy("id").collect()
    assert float(first["amount_clean"]) == 1200 and first["zip"] is None and first["errors"] is None
    assert second["zip"] == "01234" and second["mcc"] is None and second["errors"] == "Bad PIN,Technical Glitch"
    assert second["tx_ts"] == datetime.datetime(2024, 1, 15, 18, 45)
    assert third["client_id"] is third["amount_clean"] is third["tx_ts"] is None
    kept = tables.read_transactions(spark, path, keep_corrupt=True)
    assert [r["id"] for r in kept.collect() if r[tables.CORRUPT]] == [2]


def test_columns_are_matched_by_name(spark, tmp_path):
    path = write(tmp_path / "cards.csv", "card_type,id,cvv,credit_limit", "Debit,7,123,$24295", "Credit,8,456,$1")
    found = tables.read_cards(spark, path)
    assert sorted(map(tuple, found.select("id", "card_type", "credit_limit").collect())) == [
        (7, "Debit", "$24295"),
        (8, "Credit", "$1"),
    ]
    assert "cvv" not in found.columns
    users = write(tmp_path / "users.csv", "id,current_age,gender,yearly_income,credit_score", "1,53,Female,$59696,787")
    assert tuple(tables.read_users(spark, users).first()) == (1, 53, "Female", "$59696", 787)


def test_code_map_holds_descriptions(spark, tmp_path, rows):
    path = write(
        tmp_path / "mcc_codes.json", "{", '"5812": "Eating Places and Restaurants",', '"5541": "Service Stations"', "}"
    )
    expected = [(5541, "Service Stations"), (5812, "Eating Places and Restaurants")]
    assert rows(code_maps.read_mcc_codes(spark, path)) == expected
    lines = write(tmp_path / "lines.json", *[json.dumps({str(code): text}) for code, text in expected])
    assert rows(code_maps.read_mcc_codes(spark, lines, one_per_file=False)) == expected
    odd = spark.createDataFrame([('{"x1": "A", "7": null}',), ("not json",)], "value string")
    assert rows(code_maps.code_rows(odd)) == [(None, "A"), (7, None)]


def test_fraud_labels(spark, tmp_path, rows):
    flat = write(tmp_path / "flat.json", '{"1": "Yes", "2": "No"}')
    nested = write(tmp_path / "nested.json", '{"target": {"1": "Yes", "2": "No"}}')
    expected = [(1, True), (2, False)]
    assert rows(code_maps.read_fraud_labels(spark, flat)) == expected
    assert rows(code_maps.read_fraud_labels(spark, nested, field="target")) == expected


def test_one_large_label_file_is_read_by_several_tasks(spark, tmp_path):
    pairs = [f'"{i}": "{"No" if i % 3 else "Yes"}"' for i in range(3000)]
    path = write(tmp_path / "labels.json", '{"target": {', ",\n".join(pairs), "}}")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        found = code_maps.read_label_pairs(spark, path).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r["transaction_id"], r["is_fraud"]) for r in found) == [(i, i % 3 == 0) for i in range(3000)]
    assert len({r["task"] for r in found}) > 3
    odd = write(tmp_path / "odd.json", '{"x": "Yes"}')
    assert [tuple(r) for r in code_maps.read_label_pairs(spark, odd).collect()] == [(None, True)]
    assert code_maps.read_label_pairs(spark, write(tmp_path / "none.json", "{}")).isEmpty()


def test_parquet_modes_and_folders(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", [1]), (2, "b", [])], "risk_score int, day string, reasons array<int>")
    path = str(tmp_path / "out")
    parquet.write_parquet(df, path)
    parquet.write_parquet(df, path, mode="append")
    assert spark.read.parquet(path).count() == 4
    parquet.write_parquet(df, path, partition_by=["day"])
    assert sorted(p.name for p in (tmp_path / "out").glob("day=*")) == ["day=a", "day=b"]
    assert spark.read.parquet(path).count() == 2
    found = parquet.read_scores(spark, path, above=1)
    assert [r["risk_score"] for r in found.collect()] == [2]
    assert "GreaterThan(risk_score,1)" in found._jdf.queryExecution().executedPlan().toString()


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert workspace.new_folder(spark, "x").startswith(named + "/x-")
    staged = workspace.stage_all(a=spark.range(3), b=spark.range(4).withColumn("t", F.lit("x")))
    assert staged["a"].count() == 3 and staged["b"].count() == 4
    assert all(file.startswith("file://" + named) for file in staged["b"].inputFiles())


def test_files_with_another_order_of_columns_are_refused(spark, tmp_path):
    folder = tmp_path / "cards"
    folder.mkdir()
    write(folder / "a.csv", "id,client_id,card_type", "1,10,Debit")
    write(folder / "b.csv", "client_id,id,card_type", "20,2,Credit")
    with pytest.raises(Exception, match="CSV header does not conform to the schema"):
        tables.read_cards(spark, str(folder)).collect()


def test_a_batch_that_is_appended_again_counts_once(spark, tmp_path, rows):
    path = str(tmp_path / "batches")
    batch = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id long")
    parquet.append_once(batch(1, 2), path, "a")
    for again in ((3,), (3, 4), (3, 4)):
        parquet.append_once(batch(*again), path, "2024-01-01")
    assert rows(parquet.read_appended(spark, path)) == [(1,), (2,), (3,), (4,)]
    parquet.append_once(batch(), path, "a")
    assert parquet.read_appended(spark, path).count() == 4
    with pytest.raises(ValueError):
        parquet.append_once(spark.createDataFrame([(1, "x")], "id long, batch string"), path, "b")


def test_profile_of_rows_that_pass_by(spark, build, rows):
    from txrisk.operators import profile
    from txrisk.operators.facts import clean

    raw = build.raw({"amount": "?"}, {"date": "", "mcc": None}, {"errors": "x", "amount": "-$1"}, {"date": "yesterday"})
    for given in (raw, raw.filter("false")):
        tx = clean(given.withColumn("a.b", F.lit(None).cast("string")))
        seen = profile.Observed(tx, [*given.columns, "a.b"])
        workspace.stage(seen.rows.drop("a.b"), "seen")
        names = [c for c in rows(seen.null_profile()) if c[0] != "a.b"]
        assert names == rows(profile.null_profile(given))
        assert rows(seen.quality()) == rows(profile.quality(clean(given)))
