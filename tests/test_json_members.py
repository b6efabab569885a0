"""Objects that are read by many tasks give what a parser of the whole text gives."""

from __future__ import annotations

import json
import random

import pytest

from txrisk.sources import code_maps
from txrisk.sources.json_members import scalar_members

HARD = ["Yes", "a, b", 'said "no", and left', "back\\slash\\", '\\"', "{", "}, {", '": "', "", ",", ",,,", "ü\n\t€", "[1, 2]", 1, -2.5, 1e30, True, False, None, 0]


@pytest.fixture
def small_splits(spark):
    """Sets the bytes of a split; a batch of pieces is small too."""
    name, batch = "spark.sql.files.maxPartitionBytes", "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(batch, 7)

    def cut(size):
        spark.conf.set(name, size)

    yield cut
    spark.conf.set(name, before)
    spark.conf.unset(batch)


def parsed(spark, path):
    """By Spark's own parser, from the whole text."""
    text = spark.read.text(path, wholetext=True)
    return text.selectExpr("explode(from_json(value, 'map<string,string>')) AS (key, value)")


def listed(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("size", ["64", "3000"])
@pytest.mark.parametrize("style", [{}, {"indent": 1}, {"ensure_ascii": False, "separators": (",", ":")}])
def test_any_object_in_any_splits(spark, tmp_path, small_splits, size, style):
    rng = random.Random(size)
    held = {str(i) + rng.choice(["", ", x", '"', "{"]): rng.choice(HARD) for i in range(150)}
    (tmp_path / "a.json").write_text(json.dumps(held, **style))
    (tmp_path / "b.json").write_text(json.dumps({"only, one": "x" * 3000 + ", " + "y" * 3000}, **style))
    (tmp_path / "c.json").write_text("{ }\n")
    (tmp_path / "d.json").write_text("")
    path = str(tmp_path / "*.json")
    small_splits(size)
    found = listed(scalar_members(spark, path))
    small_splits("128m")
    assert found == listed(parsed(spark, path)) and len(found) == len(held) + 1


def test_members_of_one_field(spark, tmp_path, small_splits):
    labels = {str(i): "Yes, {" if i % 3 else "No" for i in range(200)}
    objects = [
        {"meta": {"1": "no label", "target": "x"}, "n": 5, "target": labels, "z": "after", "more": {"2": "no label"}},
        {"target": {"1000": "Yes"}}, {"target": {}}, {"other": {"1": "Yes"}}, {"target": {"2000": 1}, "3": 1},
    ]
    for i, held in enumerate(objects):
        (tmp_path / f"{i}.json").write_text(json.dumps(held))
    small_splits("100")
    found = scalar_members(spark, str(tmp_path), "target")
    assert listed(found) == sorted([*labels.items(), ("1000", "Yes"), ("2000", "1")], key=str)


def test_labels_that_are_no_text(spark, tmp_path, rows):
    path = tmp_path / "labels.json"
    path.write_text('{"1": 1, "2": 0, "3": true,\n "4": "Yes", "5": null, "6": "1, 2"}')
    found = rows(code_maps.read_label_pairs(spark, str(path), positive=("Yes", "1", "true")))
    assert found == [(1, True), (2, False), (3, True), (4, True), (5, None), (6, False)]
    whole = rows(code_maps.read_fraud_labels(spark, str(path), positive="1"))
    assert whole == rows(code_maps.read_label_pairs(spark, str(path), positive="1"))


def test_codes_of_any_size_equal_the_parsed_object(spark, tmp_path, rows, small_splits):
    held = {str(5000 + i): f"Shops, \"fine\" and {{other}} {i}" for i in range(100)} | {"x": "no code"}
    (tmp_path / "codes.json").write_text(json.dumps(held))
    expected = rows(code_maps.read_mcc_codes(spark, str(tmp_path)))
    small_splits("150")
    assert rows(code_maps.read_code_pairs(spark, str(tmp_path))) == expected and len(expected) == 101


@pytest.mark.parametrize("text", ['{"1": [1, 2]}', '{"1": Yes}', '{"1" "Yes"}', '{"1": "a"} "2"'])
def test_what_is_no_member_is_an_error(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception, match="no key and scalar"):
        scalar_members(spark, str(tmp_path)).collect()
