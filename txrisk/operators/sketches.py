"""Quantiles and distinct counts that roll up: sketches per group, merged for any coarser group or period.

A sketch has a fixed size, so partial ones are built before the shuffle and a group of any number of rows is one small value. Quantile
sketches (KLL) are wrong by a share of the rows of at most :func:`rank_error`; distinct sketches (theta) are exact up to
``2 ** DISTINCT_BITS`` values and then have a relative standard error of ``2 ** (-DISTINCT_BITS / 2)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.functions.rounding import amount, mean_amount

QUANTILE_K = 800
DISTINCT_BITS = 16
IDENTITIES = {"client_id": "clients", "card_id": "cards", "merchant_id": "merchants"}


def rank_error(k: int = QUANTILE_K) -> float:
    """The share of the rows by which a quantile's rank may be off, with 99 % confidence (the sketch's published bound)."""
    return 2.296 / k**0.9723


def positive_sketch(k: int = QUANTILE_K) -> Column:
    """The positive amounts of a group of facts, in cents; rows without one do not count."""
    return F.kll_sketch_agg_bigint(F.when(F.col("n_pos") > 0, F.col("pos_cents")), F.lit(k)).alias("pos_sketch")


def amount_quantiles(sketched: DataFrame, keys: Sequence[str] = (), ranks: Sequence[float] = (0.5,)) -> DataFrame:
    """Quantiles of the positive amounts per ``keys`` (of all without any), from rows that hold ``n_pos`` and ``pos_sketch``.

    ``keys``, ``n_pos`` and one column per rank, such as ``p50``. Groups without a positive amount have NULL.
    """
    merged = sketched.filter("n_pos > 0").groupBy(*keys).agg(
        F.sum("n_pos").alias("n_pos"), F.kll_merge_agg_bigint("pos_sketch").alias("pos_sketch")
    )
    found = F.kll_sketch_get_quantile_bigint("pos_sketch", F.array(*[F.lit(float(r)) for r in ranks]))
    has_any = F.col("n_pos") > 0
    named = [F.when(has_any, amount(found[i])).alias(f"p{round(100 * r)}") for i, r in enumerate(ranks)]
    return merged.select(*keys, "n_pos", *named)


def sketched_amount_stats(sketched: DataFrame) -> DataFrame:
    """As :func:`txrisk.operators.amounts.amount_stats`, from a grouping of the summary: no transaction is read for the median."""
    found = sketched.agg(
        F.sum("n_pos").alias("n_pos"),
        F.sum("pos_cents").alias("pos_cents"),
        F.min("min_pos_cents").alias("min_cents"),
        F.max("max_pos_cents").alias("max_cents"),
        F.kll_merge_agg_bigint(F.when(F.col("n_pos") > 0, F.col("pos_sketch"))).alias("pos_sketch"),
    )
    median = F.when(F.col("n_pos") > 0, F.kll_sketch_get_quantile_bigint("pos_sketch", F.lit(0.5)))
    return found.select(
        mean_amount(F.col("pos_cents"), F.col("n_pos")).alias("mean_amount"),
        amount(median).alias("median_amount"),
        amount(F.col("min_cents")).alias("min_amount"),
        amount(F.col("max_cents")).alias("max_amount"),
    )


def off_by(values: DataFrame, quantiles: DataFrame, keys: Sequence[str], name: str, rank: float) -> DataFrame:
    """By how much the rank of ``quantiles[name]`` misses ``rank``, per group: the share of rows between them, 0 if the value's
    rows cover it. ``values`` are facts; one pass over those with a positive amount."""
    positive = values.filter("n_pos > 0")
    if keys:
        joined = positive.join(quantiles.select(*keys, name), list(keys))
    else:
        joined = positive.withColumn(name, quantiles.select(name).scalar())
    cents = F.round(F.col(name) * 100).cast("long")
    below = F.sum((F.col("pos_cents") < cents).cast("long")) / F.count("*")
    upto = F.sum((F.col("pos_cents") <= cents).cast("long")) / F.count("*")
    return joined.groupBy(*keys).agg(F.greatest(below - rank, F.lit(rank) - upto, F.lit(0.0)).alias("off_by"))


def identity_sketches(facts: DataFrame, *keys: str) -> DataFrame:
    """Sketches of the clients, cards and merchants of every group; NULL is none of them."""
    made = [F.theta_sketch_agg(F.col(c), F.lit(DISTINCT_BITS)).alias(name) for c, name in IDENTITIES.items()]
    return facts.groupBy(*keys).agg(*made)


def distinct_identities(sketched: DataFrame, *keys: str) -> DataFrame:
    """Distinct clients, cards and merchants per ``keys``, from sketches of finer groups, for instance of any period from months."""
    counts = [F.theta_sketch_estimate(F.theta_union_agg(name, F.lit(DISTINCT_BITS))).alias(f"n_{name}") for name in IDENTITIES.values()]
    return sketched.groupBy(*keys).agg(*counts)


def members_in_groups(sketched: DataFrame, members: DataFrame, identity: str = "card_id") -> DataFrame:
    """Of every group of ``sketched``, how many of its distinct cards (or clients or merchants) are in ``members`` and how many are not.

    ``members`` becomes one sketch, one row of a fixed size, which meets every group; no row is looked at again.
    """
    name = IDENTITIES[identity]
    one = members.agg(F.theta_sketch_agg(F.col(identity), F.lit(DISTINCT_BITS)).alias("members")).scalar()
    keys = [c for c in sketched.columns if c not in IDENTITIES.values()]
    return sketched.select(
        *keys,
        F.theta_sketch_estimate(F.theta_intersection(name, one)).alias(f"n_{name}_in"),
        F.theta_sketch_estimate(F.theta_difference(name, one)).alias(f"n_{name}_out"),
    )
