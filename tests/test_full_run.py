from __future__ import annotations

import json

from txrisk.operators import indicators, score
from txrisk.operators.facts import clean, facts
from txrisk.params import Floors
from txrisk.plans import full_run
from verification import adapter

SF = "/root/testdata/sf0.001"


def as_csv(df, path):
    df.coalesce(1).write.option("header", True).csv(path)
    return path


def test_from_text_files_to_saved_reports(spark, rows, tmp_path):
    """The raw files are written as a user would have them, and every report is saved and read back."""
    codes = {str(r["mcc_code"]): r["mcc_category"] for r in adapter.codes(spark, SF).collect()}
    (tmp_path / "mcc_codes.json").write_text(json.dumps(codes, indent=1))
    paths = {
        name: as_csv(getattr(adapter, name)(spark, SF), str(tmp_path / name))
        for name in ("transactions", "cards", "users")
    } | {"codes": str(tmp_path / "mcc_codes.json")}
    settings = full_run.Settings(as_of=adapter.AS_OF, floors=Floors(10, 10, 10, 10))
    folders = full_run.run(full_run.load(spark, paths), settings, str(tmp_path / "output"))

    saved = {name: spark.read.parquet(folder) for name, folder in folders.items()}
    assert saved["transactions_enriched"].count() == saved["transaction_features"].count() == 1000
    direct = facts(clean(adapter.transactions(spark, SF)))
    assert rows(saved["risk_scores"]) == rows(score.risk_scores(indicators.card_days(direct)))
    assert rows(saved["by_hour"]) == rows(direct.groupBy("tx_hour").agg({"n_tx": "sum"}))
    assert sum(r[1] for r in rows(saved["category_volume"], "merchant_category", "n_tx")) <= 1000
    assert saved["population_profile"].count() == 2
    assert all(saved[name].count() > 0 for name in ("suspicious_cards", "top_cities", "category_risk", "quality"))


def test_transactions_without_an_id(spark):
    given = [getattr(adapter, name)(spark, SF) for name in ("transactions", "cards", "users", "codes")]
    inputs = full_run.Inputs(given[0].drop("id"), *given[1:])
    named = full_run.reports(inputs, full_run.Settings(as_of=adapter.AS_OF))
    assert named["transaction_features"].select("id").distinct().count() == given[0].count()
    assert named["transaction_features"].filter("minutes_since_last IS NOT NULL").count() > 0
    assert named["velocity_bursts"].columns and named["type_suspects"].columns and named["schema"].count() == 9
