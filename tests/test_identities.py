"""Exact distinct counts that roll up, also beyond the size to which sketches are exact."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from txrisk.operators import identities, sketches


@pytest.fixture
def many(spark):
    """More clients, cards and merchants than a sketch holds, in groups that share them; and groups without any."""
    n = (1 << sketches.DISTINCT_BITS) + 9_000
    found = spark.range(2 * n).select(*[(F.col("id") % n).alias(c) for c in sketches.IDENTITIES], (F.col("id") % 2).alias("g"), (F.col("id") % 5).alias("part"))
    none = spark.range(3).select(*[F.lit(None).cast("long").alias(c) for c in sketches.IDENTITIES], F.lit(7).alias("g"), F.col("id").alias("part"))
    return n, found.union(none).union(none.withColumn("g", F.lit(None)))


def test_counts_beyond_a_sketch_are_exact(many, rows):
    n, made = many
    fine = identities.identity_rows(made, "g", "part")
    expected = made.groupBy("g").agg(*[F.count_distinct(c) for c in sketches.IDENTITIES])
    assert rows(identities.distinct_identities(fine, "g")) == rows(expected)
    assert rows(identities.distinct_identities(fine)) == [(n, n, n)]
    assert rows(identities.distinct_identities(identities.identity_rows(made))) == [(n, n, n)]


def test_registered_months_count_more_cards_than_a_sketch(spark, rows):
    from verification.queries import BATCH

    class Given:
        facts = spark.range(75_000).select(*[F.col("id").alias(c) for c in sketches.IDENTITIES], F.lit(1).alias("tx_month"), F.lit(None).cast("date").alias("tx_date"))

    assert rows(BATCH["active_by_month"](Given)) == [(1, 75_000, 75_000, 75_000)]


def test_members_beyond_a_sketch_are_exact(spark, many, rows):
    n, made = many
    members = spark.range(0, 2 * n, 3).select(F.col("id").alias("card_id")).union(spark.sql("SELECT CAST(NULL AS BIGINT)"))
    found = identities.members_in_groups(identities.identity_rows(made, "g"), members.union(members))
    card = F.col("card_id")
    expected = made.groupBy("g").agg(F.count_distinct(F.when(card % 3 == 0, card)), F.count_distinct(F.when(card % 3 != 0, card)))
    assert rows(found) == rows(expected)
    assert rows(identities.members_in_groups(identities.identity_rows(made), members.filter("false"))) == [(0, n)]


def test_registered_suspects_count_more_cards_than_a_sketch(spark, rows):
    from verification.queries import BATCH

    class Given:
        facts = spark.range(75_000).select(*[F.col("id").alias(c) for c in sketches.IDENTITIES], F.lit(1).alias("tx_month"))
        suspicious = staticmethod(lambda: spark.range(10, 72_010).select(F.col("id").alias("card_id")))

    assert rows(BATCH["suspects_by_month"](Given)) == [(1, 72_000, 3_000)]
