"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from txrisk.operators import amounts, enrich, indicators, rules, score, sequences
from txrisk.operators.facts import clean, facts
from txrisk.operators.summary import summary
from txrisk.sources.workspace import stage
from verification import adapter
from verification.queries import BATCH, Given, queries

SF = "/root/testdata/sf0.001"


def planned(df) -> str:
    """The plan as Spark would start it, before it is adapted to sizes."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[-1]


def exchanges(df) -> int:
    return len(re.findall(r"Exchange hashpartitioning", planned(df)))


@pytest.fixture(scope="module")
def given(spark):
    return Given(spark, SF)


@pytest.mark.parametrize("name", [n for n in BATCH if "saved" not in n and "roundtrip" not in n])
def test_no_python_and_no_cross_join(spark, name):
    plan = planned(queries()[name](spark, SF))
    for unwanted in ("Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin", "collect_set", "collect_list"):
        assert unwanted not in plan


def test_card_days_shuffle_twice(given):
    assert exchanges(indicators.card_days(given.facts)) == 2


def test_card_day_counts_shuffle_once(given):
    assert exchanges(indicators.card_day_tx(given.facts)) == 1
    assert exchanges(indicators.card_day_spend(given.facts)) == 1


def test_sums_are_partial_before_the_shuffle(given):
    plan = planned(indicators.daily(given.facts))
    assert plan.index("functions=[sum(") < plan.index("Exchange") < plan.index("partial_sum(")


@pytest.mark.parametrize(
    ("report", "carries"),
    [
        (sequences.gaps, 1),
        (sequences.velocity_bursts, 1),
        (sequences.error_streaks, 1),
        (sequences.dormant_reactivations, 3),
    ],
)
def test_only_one_row_per_day_is_ordered_by_card_alone(given, report, carries):
    """Moments are dealt by card and day; only the sums of days are brought together by card."""
    plan = planned(report(stage(given.moments, "moments")))
    by_card = re.findall(r"Exchange hashpartitioning\(card_id#\d+L?, \d+\).*\n.*?([A-Z]\w+)", plan)
    assert by_card == ["HashAggregate"] * carries
    assert len(re.findall(r"Window \[.*\], \[card_id#\d+L?\], \[day#", plan)) == carries
    assert not re.search(r"\], \[card_id#\d+L?\], \[(second|at)#", plan)


def test_summary_scans_once(given):
    plan = planned(summary(given.facts))
    assert plan.count("FileScan") == 1 and exchanges(summary(given.facts)) == 1


def test_exact_statistics_scan_once(given):
    df = amounts.amount_stats(given.facts, exact=True)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_top_k_sorts_nothing_as_a_whole(given):
    days = indicators.card_days(given.facts)
    for df in (score.top_risk_scores(score.risk_scores(days)), rules.top_suspicious_cards(given.suspicious())):
        plan = planned(df)
        assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_only_needed_columns_are_read(spark, tmp_path):
    path = str(tmp_path / "tx")
    clean(adapter.transactions(spark, SF)).write.parquet(path)
    stored = facts(spark.read.parquet(path))
    plan = planned(indicators.card_day_tx(stored))
    assert "ReadSchema: struct<card_id:bigint,tx_date:date>" in plan
    high = stored.filter(F.col("amount_clean") > 200).select("id", "amount_clean")
    assert "GreaterThan(amount_clean" in planned(high)
    assert "ReadSchema: struct<pos_cents" not in planned(amounts.exact_median(stored))


def test_a_card_with_most_rows_is_split_in_the_enriching_joins(spark, build):
    """With dimensions too large to broadcast, adaptive execution splits the partition of the busy card."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        tx = spark.range(0, 40_000, 1, 8).select(
            "id",
            F.lit("2024-01-15 10:00:00").alias("date"),
            (F.col("id") % 50).alias("client_id"),
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).alias("card_id"),
            F.concat(F.lit("$"), F.col("id").cast("string")).alias("amount"),
            F.lit(1).alias("mcc"),
        )
        known = build.cards(*[{"id": i, "card_type": "Debit"} for i in range(300)])
        users = build.users(*[{"id": i} for i in range(40)])
        joined = enrich.enrich(clean(tx), build.codes(c1="A"), known, users).select("id", "card_type", "current_age")
        found = joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    assert sorted(r["id"] for r in found) == list(range(40_000))
    typed = sum(r["card_type"] == "Debit" for r in found)
    assert typed == sum(1 for i in range(40_000) if i % 3 == 0 or i % 5000 < 300)
