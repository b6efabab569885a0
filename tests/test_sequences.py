"""Sequences against a plain loop over sorted rows, on random rows with ties, gaps and one very busy card."""

from __future__ import annotations

import datetime
import random
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from txrisk.operators import features, sequences
from txrisk.operators.attach import attach
from txrisk.params import BurstRules

START = datetime.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def random_rows():
    rng = random.Random(11)
    rows = []
    for i in range(600):
        card = 1 if rng.random() < 0.5 else rng.choice([2, 3, 4, 5, None])
        ts = START + datetime.timedelta(seconds=rng.choice([0, 1, 60, 299, 300, 301, 86400]) * rng.randint(0, 40))
        rows.append(
            {
                "id": i,
                "card_id": card,
                "client_id": card and card // 2,
                "date": ts.strftime("%Y-%m-%d %H:%M:%S") if rng.random() > 0.05 else "?",
                "errors": rng.choice(["Bad PIN", "Technical Glitch", "", None]),
                "amount": f"${rng.randint(-500, 5000) / 100}",
            }
        )
    return rows


@pytest.fixture(scope="module")
def facts(build, random_rows):
    return build.facts(*random_rows).cache()


@pytest.fixture(scope="module")
def moments(facts):
    return sequences.moments(facts).cache()


def parsed(row):
    return None if row["date"] == "?" else datetime.datetime.strptime(row["date"], "%Y-%m-%d %H:%M:%S")


@pytest.fixture(scope="module")
def by_card(random_rows):
    """Dated rows of every known card as (time, failed, id, wrong PIN), in order."""
    dated = [r for r in random_rows if r["card_id"] is not None and parsed(r)]
    key = lambda r: r["card_id"]
    return {
        card: sorted((parsed(r), bool(r["errors"]), r["id"], r["errors"] == "Bad PIN") for r in group)
        for card, group in groupby(sorted(dated, key=key), key)
    }


def test_lag_example(build, rows):
    facts = build.facts(*[{"date": f"2024-01-15 10:{m:02d}:00"} for m in (0, 5, 35)])
    found = sequences.time_since_last(facts, sequences.moments(facts))
    assert rows(found, "id", "minutes_since_last") == [(0, None), (1, 5.0), (2, 30.0)]


@pytest.mark.parametrize("hot_rows", [5_000_000, 20, 2])
def test_time_since_last(facts, moments, by_card, random_rows, hot_rows):
    expected = {r["id"]: None for r in random_rows}
    for events in by_card.values():
        ordered = sorted((ts, i) for ts, _, i, _ in events)
        for (before, _), (ts, i) in zip(ordered, ordered[1:]):
            expected[i] = (ts - before).total_seconds() / 60
    found = sequences.time_since_last(facts, moments, hot_rows=hot_rows).collect()
    assert len(found) == len(expected)
    assert {r["id"]: r["minutes_since_last"] for r in found} == expected


@pytest.mark.parametrize("hot_rows", [5_000_000, 50])
def test_amount_deviation(facts, random_rows, hot_rows):
    by_client = {}
    for r in random_rows:
        if r["client_id"] is not None:
            by_client.setdefault(r["client_id"], []).append((r["id"], round(float(r["amount"][1:]) * 100)))
    expected = {
        i: abs(cents - sum(c for _, c in group) / len(group)) / 100 for group in by_client.values() for i, cents in group
    }
    found = features.amount_deviation(facts, hot_rows=hot_rows).collect()
    assert {r["id"]: r["amount_deviation"] for r in found} == expected
    assert len(found) == len(expected)


def trailing_counts(events, seconds, weight):
    found = set()
    for ts, *_ in {e[0]: e for e in events if weight(e)}.values():
        n = sum(weight(e) for e in events if 0 <= (ts - e[0]).total_seconds() <= seconds)
        found.add((ts, n))
    return found


def test_velocity_and_pin_bursts(moments, by_card):
    rules = BurstRules(velocity_tx=3, pin_errors=2)
    for function, weight, seconds, least in (
        (sequences.velocity_bursts, lambda e: 1, 300, 3),
        (sequences.pin_bursts, lambda e: int(e[3]), 3600, 2),
    ):
        expected = {
            (card, ts, n)
            for card, events in by_card.items()
            for ts, n in trailing_counts(events, seconds, weight)
            if n >= least
        }
        found = [tuple(r) for r in function(moments, rules).collect()]
        assert set(found) == expected and len(found) == len(expected) > 0


def runs(events):
    """Runs of failed transactions between successes, the last one open."""
    run, found = [], []
    for event in events:
        if event[1]:
            run.append(event)
        else:
            found.append(run)
            run = []
    return [*found, run]


def test_error_streaks(moments, by_card):
    expected = {
        (card, run[0][0], run[-1][0], len(run)) for card, events in by_card.items() for run in runs(events) if run
    }
    found = [tuple(r) for r in sequences.error_streaks(moments).collect()]
    assert sorted(found) == sorted(expected)
    longest = {card: (max(map(len, runs(e))), len(runs(e)[-1])) for card, e in by_card.items()}
    assert {r[0]: (r[1], r[2]) for r in sequences.consecutive_errors(moments).collect()} == longest


def test_pin_lockouts(moments, by_card):
    expected = [
        (card, run[0][0], run[-1][0], sum(e[3] for e in run))
        for card, events in by_card.items()
        for run in runs(events)
        if sum(e[3] for e in run) >= 3
    ]
    found = sequences.pin_lockouts(moments, BurstRules(pin_lockout=3)).collect()
    assert sorted(map(tuple, found)) == sorted(expected)


def test_dormant_reactivations(moments, by_card):
    rules = BurstRules(dormant_days=1, wake_tx=2, wake_seconds=600)
    expected = set()
    for card, events in by_card.items():
        times = sorted({e[0] for e in events})
        for before, ts in zip(times, times[1:]):
            after = sum(1 for e in events if 0 <= (e[0] - ts).total_seconds() <= 600)
            if (ts - before).total_seconds() > 86400 and after >= 2:
                expected.add((card, ts, (ts - before).total_seconds() / 86400, after))
    found = [tuple(r) for r in sequences.dormant_reactivations(moments, rules).collect()]
    assert set(found) == expected and len(found) == len(expected)


@pytest.mark.parametrize("hot_rows", [1, 3, 100])
def test_attach_is_a_left_join(spark, hot_rows):
    """A third of the rows in one group, NULL keys, and rows of unknown groups."""
    table = [(i, 7 if i % 3 == 0 else i % 11 if i % 5 else None) for i in range(500)]
    rows = spark.createDataFrame(table, "id bigint, k int")
    groups = rows.filter("k <> 4").groupBy("k").agg(F.count("*").alias("n"), F.sum("id").alias("total"))
    plain = rows.join(groups.drop("n"), "k", "left").select("id", "k", "total")
    found = attach(rows, groups, ["k"], "n", hot_rows=hot_rows)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_features_keep_every_row(build, facts, random_rows):
    """Undated rows and rows without card, client or code keep what is known about them."""
    from txrisk.operators.facts import rollup
    from txrisk.operators.indicators import daily

    groups = features.feature_groups(
        facts,
        daily(facts),
        sequences.moments(facts),
        rollup(facts, "mcc"),
        build.codes(c5812="A"),
        build.cards({"id": 1, "card_on_dark_web": "Yes"}),
        build.users({"id": 0, "credit_score": 700}),
        "2024-01-30",
    )
    found = {r["id"]: r for r in features.transaction_features(facts, groups, hot_rows=30).collect()}
    assert sorted(found) == sorted(r["id"] for r in random_rows)
    for row in random_rows:
        got = found[row["id"]]
        assert got["card_on_dark_web"] == (1 if row["card_id"] == 1 else None)
        assert (got["tx_per_day"] is None) == (row["card_id"] is None or row["date"] == "?")
        assert (got["card_error_ratio"] is None) == (row["card_id"] is None)
        assert (got["amount_deviation"] is None) == (row["client_id"] is None)
        assert got["merchant_volume"] == 600


def test_rows_without_ids_of_a_large_group_are_dealt_out(spark):
    rows = spark.range(2000).selectExpr("id % 7 AS v", "CAST(NULL AS BIGINT) AS id", "1L AS k").repartition(8)
    groups = spark.sql("SELECT 1L AS k, 2000L AS n, 'x' AS name")
    joined = attach(rows, groups, ["k"], "n", hot_rows=50)
    assert joined.filter("name = 'x'").count() == 2000
    nobody = attach(rows.withColumn("k", F.lit(None).cast("long")), groups, ["k"], "n", hot_rows=50)
    assert nobody.filter("name IS NULL").count() == 2000


def test_a_busy_card_is_spread_over_tasks(spark):
    """A third of the moments belong to one card; no task has more than a few times the median of the rows."""
    second = F.when(F.col("id") % 3 == 0, F.col("id") * 20).otherwise(F.col("id") * 20 + 7)
    card = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997)
    made = spark.range(90_000).select(
        card.alias("card_id"),
        F.timestamp_seconds(second).alias("tx_ts"),
        second.alias("second"),
        F.lit(1).cast("bigint").alias("n_tx"),
        (F.col("id") % 2).alias("n_errors"),
        F.lit(0).cast("bigint").alias("n_pin"),
        F.col("id").alias("first_id"),
    )
    settings = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        for found in (
            sequences.gaps(made),
            sequences.trailing(made, "n_tx", 300, 1),
            sequences.error_streaks(made),
        ):
            sizes = sorted(r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect())
            assert sizes[-1] <= 3 * sizes[len(sizes) // 2]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_what_lies_before_midnight_counts(build, rows):
    """Gaps, trailing counts, streaks and reactivations over the end of one day and several days."""
    times = ["2024-01-01 23:58:00", "2024-01-01 23:59:30", "2024-01-02 00:00:30", "2024-01-05 12:00:00", "2024-01-05 23:59:59", "2024-01-06 00:00:00"]
    failed = ["Bad PIN", "Bad PIN", "Bad PIN", None, "Bad PIN", "Bad PIN"]
    given = sequences.moments(build.facts(*[{"date": d, "errors": e} for d, e in zip(times, failed)]))
    assert [r[0] for r in rows(sequences.gaps(given), "gap_seconds")] == [None, 1, 60, 90, 43199, 302370]
    assert [r[0] for r in rows(sequences.trailing(given, "n_tx", 150, 1), "n_recent")] == [1, 1, 1, 2, 2, 3]
    assert [r[0] for r in rows(sequences.error_streaks(given), "n_errors")] == [2, 3]
    woken = sequences.dormant_reactivations(given, BurstRules(dormant_days=3, wake_seconds=43200, wake_tx=2))
    assert [r[0] for r in rows(woken, "n_after")] == [3]
