"""Exact counts of distinct clients, cards and merchants that roll up: one row for each of them in a group.

The rows of a finer grouping give every coarser one. They are found by sums before and after the shuffle, by group and value, so
no group and no set is gathered in one task; there are at most three for each row of the facts. Sketches (``sketches.py``) are smaller
but only exact up to a size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.operators.sketches import IDENTITIES


def identity_rows(facts: DataFrame, *keys: str) -> DataFrame:
    """``keys, identity, value``: the distinct clients, cards and merchants of every group. A group's missing ones are a NULL, so
    that a group without any stays."""
    return facts.unpivot(list(keys), list(IDENTITIES), "identity", "value").distinct()


def distinct_identities(found: DataFrame, *keys: str) -> DataFrame:
    """Distinct clients, cards and merchants per ``keys``, from :func:`identity_rows` of the same or finer groups."""
    each = found.select(*keys, "identity", "value").distinct()
    counts = [F.count(F.when(F.col("identity") == c, F.col("value"))).alias(f"n_{name}") for c, name in IDENTITIES.items()]
    return each.groupBy(*keys).agg(*counts)


def members_in_groups(found: DataFrame, members: DataFrame, identity: str = "card_id") -> DataFrame:
    """Of every group of :func:`identity_rows`, how many of its distinct cards (or clients or merchants) are in ``members`` and how many
    are not. Each of them meets at most one member."""
    name = IDENTITIES[identity]
    inside = members.select(F.col(identity).alias("value"), F.lit(True).alias("inside")).distinct()
    keys = [c for c in found.columns if c not in ("identity", "value")]
    return (
        found.filter(F.col("identity") == identity)
        .join(inside, "value", "left")
        .groupBy(*keys)
        .agg(
            F.count(F.when(F.col("inside"), F.col("value"))).alias(f"n_{name}_in"),
            F.count(F.when(F.col("inside").isNull(), F.col("value"))).alias(f"n_{name}_out"),
        )
    )
