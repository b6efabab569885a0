"""Transactions stored by card: the same results, and rows that stay where they are."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from txrisk.operators import by_card, enrich, errors, sequences
from txrisk.operators.facts import clean, facts
from txrisk.operators.reaching import bits_for, full_cells, reaching
from txrisk.sources.by_card import open_by_card, write_by_card


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]


@pytest.fixture(scope="module")
def raw(build):
    """A third of the rows belongs to card 7, a part has no card, some have no time; seconds repeat."""
    rng = random.Random(4)
    made = []
    for i in range(900):
        card = 7 if i % 3 == 0 else rng.choice([None, *range(20, 60)])
        time = rng.choice([None, "?", *[f"2024-02-0{d} 10:00:{s:02}" for d in (1, 2) for s in range(0, 60, 3)]])
        failure = rng.choice([None, "Bad PIN", "Technical Glitch"])
        made.append({"card_id": card, "client_id": i % 30, "date": time, "errors": failure, "amount": f"${i}.10"})
    return build.raw(*made)


@pytest.fixture(scope="module")
def stored(raw, tmp_path_factory):
    return write_by_card(clean(raw), "stored_by_card", str(tmp_path_factory.mktemp("by-card") / "tx"), buckets=8, hot_rows=40)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def dimensions(build):
    cards = build.cards(*[{"id": i, "card_type": f"type {i % 3}", "credit_limit": f"${i}"} for i in (7, *range(20, 50))])
    return build.codes(c5812="Eating"), cards, build.users(*[{"id": i, "credit_score": 600 + i} for i in range(20)])


def test_rows_are_kept_once(stored, raw, rows):
    names = ["id", "card_id", "amount"]
    assert rows(stored.rows, *names) == rows(raw, *names)


def test_busy_cards_have_slots_and_a_second_has_one(stored):
    busy = {r["card_id"]: r["slots"] for r in stored.busy.collect()}
    assert busy[7] == 300 // 40 + 1 and set(busy) <= {7, None}
    used = stored.rows.filter("card_id = 7").select("slot").distinct().count()
    assert 4 <= used <= busy[7]
    seconds = stored.rows.filter("card_id = 7 AND tx_ts IS NOT NULL").groupBy("tx_ts").agg(F.countDistinct("slot").alias("n"))
    assert seconds.filter("n > 1").isEmpty()


def test_moments_and_totals_equal_those_of_plain_rows(stored, raw, rows):
    plain = facts(clean(raw))
    assert rows(by_card.moments(stored)) == rows(sequences.moments(plain))
    for floor in (0, 15):
        assert rows(by_card.card_error_rates(stored, floor)) == rows(errors.error_rates(plain, "card_id", floor))


def test_enriched_equal_those_of_plain_rows(stored, raw, dimensions, rows, no_broadcast):
    names = ["id", "card_id", "merchant_category", "card_type", "credit_limit_clean", "credit_score"]
    plain = enrich.enrich(clean(raw), *dimensions)
    found = by_card.enrich(stored, *dimensions)
    assert rows(found, *names) == rows(plain, *names)
    assert set(found.columns) == set(plain.columns)


def test_moments_do_not_exchange_dated_rows(stored):
    dated, undated = re.findall(r"HashAggregate.*?FileScan[^\n]*", planned(by_card.moments(stored)), re.DOTALL)
    assert "isnotnull(tx_ts" in dated and "Bucketed: true" in dated and "Exchange" not in dated
    assert "isnull(tx_ts" in undated and undated.index("Exchange") < undated.index("partial_sum")


def test_card_totals_exchange_sums_only(stored):
    plan = planned(by_card.card_totals(stored, "n_tx", "n_errors"))
    assert plan.count("Exchange") == 1 and plan.index("Exchange") < plan.index("slot#")


def test_cards_are_brought_to_the_rows(stored, dimensions, no_broadcast):
    """The only exchange by card is that of the cards."""
    plan = planned(by_card.with_card(stored, dimensions[1]))
    join, rest = plan[: plan.index("FileScan")], plan[plan.index("FileScan") :]
    assert "SortMergeJoin" in join and "Exchange hashpartitioning" not in join
    assert "Bucketed: true" in rest and "Exchange hashpartitioning" in rest


def test_another_session_opens_what_is_stored(spark, raw, tmp_path, rows):
    path = str(tmp_path / "tx")
    written = write_by_card(clean(raw), "opened_by_card", path, buckets=5, hot_rows=40)
    before = rows(by_card.moments(written))
    spark.sql("DROP TABLE opened_by_card")
    opened = open_by_card(spark, "opened_by_card", path)
    assert rows(by_card.moments(opened)) == before
    assert "5 out of 5" in planned(by_card.moments(opened))


def test_written_twice_is_replaced_and_empty_is_empty(spark, raw, tmp_path):
    path = str(tmp_path / "tx")
    for _ in range(2):
        assert write_by_card(clean(raw), "twice_by_card", path, hot_rows=40).rows.count() == 900
    empty = write_by_card(clean(raw.limit(0)), "twice_by_card", path)
    assert by_card.moments(empty).isEmpty() and by_card.card_totals(empty).isEmpty()


def test_clashing_columns_are_refused(raw, tmp_path):
    for name in ("slot", "Slots", "busy_card"):
        with pytest.raises(ValueError):
            write_by_card(clean(raw).withColumn(name, F.lit(1)), "refused_by_card", str(tmp_path / "tx"))


# groups that reach a floor


@pytest.mark.parametrize("bits", [1, 4, 10])
@pytest.mark.parametrize("floor", [1, 12, 18, 300, 1000])
def test_sketched_rates_equal_exact_ones(raw, rows, bits, floor):
    plain = facts(clean(raw))
    assert rows(errors.error_rates(plain, "card_id", floor, bits)) == rows(errors.error_rates(plain, "card_id", floor))


def test_only_candidates_remain(spark):
    """100,000 cards of one row and ten of a thousand: with room enough nearly only the ten are left to be shuffled."""
    many = spark.range(100_000).select(F.col("id").alias("card_id"), F.lit(1).alias("n_tx"))
    few = spark.range(10_000).select((-1 - F.col("id") % 10).alias("card_id"), F.lit(1).alias("n_tx"))
    rows = many.union(few)
    kept = reaching(rows, "card_id", 50, bits=bits_for(110_000, 50))
    assert kept.filter("card_id < 0").count() == 10_000
    assert kept.filter("card_id >= 0").count() < 100
    assert full_cells(rows, "card_id", 50, bits=13).groupBy("line").count().filter("count > 20").isEmpty()


def test_sketch_of_nothing_and_of_no_card(spark, rows):
    none = spark.createDataFrame([(None, 3), (None, 4), (1, 2)], "card_id long, n_tx int")
    assert rows(reaching(none, "card_id", 7, bits=8)) == [(None, 3), (None, 4)]
    assert reaching(none.limit(0), "card_id", 0, bits=8).isEmpty()
    with pytest.raises(ValueError):
        reaching(none, "card_id", 1, bits=40)
    with pytest.raises(ValueError):
        reaching(none.withColumn("reaching_cell", F.lit(1)), "card_id", 1)


def test_sums_of_cells_are_partial(raw):
    plan = planned(reaching(facts(clean(raw)), "card_id", 10, bits=8))
    assert plan.count("BroadcastHashJoin") == 4 and "Exchange hashpartitioning" not in plan
