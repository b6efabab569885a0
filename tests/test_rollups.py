"""Sketches and bitmaps per group, put together for coarser groups, against the rows themselves."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from txrisk.operators import amounts, categories, city_days, indicators, profile, sketches
from txrisk.operators.facts import clean, facts
from txrisk.operators.summary import part, summary


def days_of(rows):
    daily = indicators.daily(rows)
    return city_days.city_days(daily, city_days.numbered_cities(daily))


@pytest.fixture
def busy(build):
    rng = random.Random(9)
    cities = ["Paris", "Lyon", "ONLINE", None, "Rome", ""]
    return build.facts(*[
        {
            "card_id": rng.choice([1, 2, 3, None]), "client_id": rng.choice([1, 2, None]), "merchant_id": rng.randrange(9),
            "merchant_city": rng.choice(cities), "amount": rng.choice([f"${rng.randrange(1, 5000)}.25", "-$3", "?", None]),
            "date": rng.choice(["2024-01-31 10:00:00", "2024-02-01 00:00:00", "2024-03-04 23:00:00", "2023-12-31 01:00:00", "?", None]),
        }
        for _ in range(400)
    ])


def test_card_lifetime_from_bitmaps_equals_the_rows(busy, rows):
    assert rows(city_days.card_lifetime(days_of(busy))) == rows(indicators.card_lifetime(busy))


def test_any_span_of_days_equals_the_rows(busy, rows):
    spans = city_days.spans(days_of(busy), F.trunc("tx_date", "MM"))
    city = F.col("merchant_city")
    expected = busy.groupBy("card_id", F.trunc("tx_date", "MM").alias("span_0")).agg(
        F.count_distinct(city).alias("a"), F.count_distinct(F.when(city != "ONLINE", city)).alias("p"), F.count_distinct("tx_date").alias("d"), F.sum("n_tx").alias("n")
    )
    assert rows(spans, "card_id", "span_0", "n_cities_all", "n_cities_physical", "n_days", "n_tx") == rows(expected)


def test_more_cities_than_a_bitmap_holds(spark, rows):
    n = 70_000
    tx = spark.range(n).select(
        F.lit("2024-01-01 00:00:00").alias("date"), F.lit(1).alias("client_id"), (F.col("id") % 2).alias("card_id"), F.lit("$1").alias("amount"),
        F.lit(1).alias("merchant_id"), F.concat(F.lit("c"), F.col("id").cast("string")).alias("merchant_city"), F.lit(None).cast("string").alias("errors"),
    )
    made = facts(clean(tx))
    numbered = city_days.numbered_cities(made)
    assert numbered.agg(F.min("city_no"), F.max("city_no"), F.count_distinct("city_no")).first()[:] == (1, n, n)
    days = city_days.city_days(indicators.daily(made), numbered)
    assert days.select("bucket").distinct().count() == 3
    assert rows(city_days.card_lifetime(days), "card_id", "n_tx", "n_cities", "n_days") == [(0, n // 2, n // 2, 1), (1, n // 2, n // 2, 1)]


def test_bitmaps_are_hashed_as_numbers(spark, rows):
    """Bitmaps of 4 KB for each card and day were sorted whole, and every task held as many of them as its memory took."""
    made = spark.range(400).select(
        (F.col("id") % 3).alias("card_id"), F.lit("2024-01-01").cast("date").alias("tx_date"), F.concat(F.lit("c"), F.col("id").cast("string")).alias("merchant_city"),
        *[F.lit(1).cast("long").alias(m) for m in indicators.DAILY_MEASURES],
    )
    numbered = spark.range(400).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("merchant_city"), (F.col("id") * 200 + 1).alias("city_no"))
    days = city_days.city_days(made, numbered)
    assert days.schema["cities"].dataType.simpleString() == "bigint"
    assert days.count() <= 400
    weekly = city_days.weekly_cities(days)
    plans = [frame._jdf.queryExecution().executedPlan().toString() for frame in (days, weekly)]
    assert not any("SortAggregate" in plan or "ObjectHashAggregate" in plan for plan in plans)
    assert sorted(rows(weekly, "card_id", "n_cities_all")) == [(0, 134), (1, 133), (2, 133)]


def test_summed_volumetry_equals_the_rows(busy, build, rows):
    for given in (busy, busy.filter("false")):
        summed = profile.summed_volumetry(indicators.daily(given), categories.merchant_totals(given))
        assert rows(summed) == rows(profile.volumetry(given))
        assert "Expand" not in summed._jdf.queryExecution().executedPlan().toString()


def test_lifetime_copies_no_row(busy):
    plan = city_days.card_lifetime(days_of(busy))._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_small_groups_have_their_exact_median(busy, rows):
    small = summary(busy)
    by_time = part(small, "time")
    found = rows(sketches.amount_quantiles(by_time, ["tx_month"]), "tx_month", "p50")
    expected = rows(busy.filter("n_pos > 0").groupBy("tx_month").agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY pos_cents)") / 100))
    assert found == expected
    assert rows(sketches.sketched_amount_stats(part(small, "amount"))) == rows(amounts.amount_stats(busy, exact=True))
    none = sketches.sketched_amount_stats(part(summary(busy.filter("n_pos = 0")), "amount"))
    assert rows(none) == [(None, None, None, None)]


def test_large_groups_keep_the_stated_error(spark):
    values = spark.range(300_000).select(F.pmod(F.xxhash64("id"), F.lit(1_000_003)).alias("pos_cents"), F.lit(1).alias("n_pos"), (F.col("id") % 3).alias("g"), (F.col("id") % 40).alias("part"))
    parts = values.groupBy("g", "part").agg(F.sum("n_pos").alias("n_pos"), sketches.positive_sketch())
    for rank in (0.05, 0.5, 0.95):
        quantiles = sketches.amount_quantiles(parts, ["g"], [rank])
        off = sketches.off_by(values, quantiles, ["g"], f"p{round(100 * rank)}", rank)
        assert off.agg(F.max("off_by")).first()[0] <= 2 * sketches.rank_error() and off.count() == 3


def test_distinct_counts_of_any_period(busy, rows):
    per_day = sketches.identity_sketches(busy, "tx_month", "tx_date")
    names = ("client_id", "card_id", "merchant_id")
    counts = [F.count_distinct(c).alias(c) for c in names]
    assert rows(sketches.distinct_identities(per_day, "tx_month")) == rows(busy.groupBy("tx_month").agg(*counts))
    assert rows(sketches.distinct_identities(per_day)) == rows(busy.agg(*counts))


def test_members_are_counted_in_and_out(spark, busy, rows):
    months = sketches.identity_sketches(busy, "tx_month")
    some = spark.createDataFrame([(1,), (3,), (3,), (99,)], "card_id long")
    card = F.col("card_id")
    inside = busy.groupBy("tx_month").agg(F.count_distinct(F.when(card.isin(1, 3), card)), F.count_distinct(F.when(card == 2, card)))
    assert rows(sketches.members_in_groups(months, some)) == rows(inside)
    nobody = sketches.members_in_groups(months, some.filter("false"))
    assert {r[1] for r in rows(nobody)} == {0}


def test_distinct_counts_beyond_the_exact_size(spark):
    n = 1 << (sketches.DISTINCT_BITS + 3)
    made = spark.range(n).select(*[F.col("id").alias(c) for c in sketches.IDENTITIES], (F.col("id") % 5).alias("g"))
    found = sketches.distinct_identities(sketches.identity_sketches(made, "g")).first()
    assert abs(found["n_cards"] / n - 1) < 5 * 2 ** (-sketches.DISTINCT_BITS / 2)
