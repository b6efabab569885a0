"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.sources.workspace import stage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def _figures(edges: DataFrame) -> tuple:
    """Equal for equal edge tables, and for different ones only by an unlikely chance."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of an edge, root being the smallest node of its component.

    ``edges`` has two columns of one orderable type. Each round writes its edges to the shared folder, so a
    lost executor costs one round at most; the number of rounds grows with the logarithm of the size. The steps are
    joins and minima, so no neighbourhood is gathered in a task.
    """
    left, right = edges.columns
    now = stage(
        edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).filter("u <> v").distinct(), "edges"
    )
    before = _figures(now)
    while before[0]:
        now = stage(_small_star(_large_star(now).distinct()).distinct(), "edges")
        after = _figures(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
