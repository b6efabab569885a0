"""Mixing the documents of several sources to target weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txrisk.sources.workspace import stage

#: Weights of the sources in order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: A source is repeated this often at most.
MAX_RATE = 3
SEED = "mix"


def n_words(text: Column) -> Column:
    """Number of words, which space and U+0009 to U+000D separate; 0 for NULL."""
    held = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.size(F.array_remove(F.split(held, " "), "")).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_rate: int = MAX_RATE) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``, one row per source.

    Targets share the sum of all sizes by weight; a target over ``max_rate`` times its source's size stops there and
    its excess is shared by the others, until none is above. The sources that stop are those with the smallest
    ``size / weight``, so running sums in that order give the level at once. The windows hold one row per
    source, never a row per document.
    """
    every = Window.partitionBy()
    by_name = every.orderBy(F.col("source").isNull(), "source")
    rank = (F.row_number().over(by_name) - 1) % len(weights)
    weighted = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (rank + 1).cast("int")).cast("long"))
    capped = weighted.withColumn("cap", F.col("source_size") * max_rate)
    in_turn = every.orderBy(F.col("cap").cast("double") / F.col("weight"), F.col("source").isNull(), "source")
    ahead = in_turn.rowsBetween(Window.unboundedPreceding, -1)
    left = capped.select(
        "*",
        F.row_number().over(in_turn).alias("turn"),
        (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(ahead), F.lit(0))).alias("words_left"),
        (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(ahead), F.lit(0))).alias("weight_left"),
    )
    free = F.col("words_left") * F.col("weight") <= F.col("cap") * F.col("weight_left")
    level = left.select("*", F.min(F.when(free, F.struct("turn", "words_left", "weight_left"))).over(every).alias("level"))
    share = F.col("level.words_left").cast("double") * F.col("weight") / F.col("level.weight_left")
    return level.select("source", "source_size", F.least(share, F.col("cap").cast("double")).alias("target"))


def drawn(doc_id: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the id only: 52 bits of an MD5 digest."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(2**52))


def plan_mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_rate: int = MAX_RATE, seed: str = SEED) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies`` for every document, and nothing else of it.

    ``docs`` has ``doc_id, source, text``. NULL and empty texts have size 0. The rate of a source is its target over
    its size (0 if the size is 0). A document is taken floor(rate) times and once more if :func:`drawn` is below the
    fraction, so reruns agree and rows with the same id are treated alike. A NULL source is a source, the last one.

    Sizes are summed per source before the shuffle. The sources' rates are joined without a hint: Spark broadcasts
    them if they are small, else adaptive execution splits the rows of a large source.
    """
    sized = stage(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")), "sizes")
    goals = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_rate)
    goals = stage(goals, "targets").withColumnRenamed("source", "of_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    copies = F.floor("rate") + (drawn(F.col("doc_id"), seed) < F.col("rate") - F.floor("rate")).cast("long")
    return (
        sized.join(goals, F.col("source").eqNullSafe(F.col("of_source"))).withColumn("rate", rate)
        .select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"))
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_rate: int = MAX_RATE, seed: str = SEED) -> DataFrame:
    """The documents of the mix: all columns of ``docs`` and ``copy``, counted from 1, one row per copy. If ``docs`` has a
    column ``copy``, the new one is named ``copy_``.

    Rates are those of :func:`plan_mix`. They depend on the source alone, so the texts are not shuffled for them.
    """
    sizes = docs.groupBy("source").agg(F.sum(n_words(F.col("text"))).alias("source_size"))
    goals = stage(targets(sizes, weights, max_rate), "targets").select(
        "source", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("rate")
    )
    name = "copy"
    while name in map(str.lower, docs.columns):
        name += "_"
    extra = drawn(F.col("row.doc_id"), seed) < F.col("rate") - F.floor("rate")
    copies = (F.floor("rate") + extra.cast("long")).cast("int")
    rows = docs.select(F.struct("*").alias("row"))
    return (
        rows.join(goals, F.col("row.source").eqNullSafe(F.col("source"))).select("row", copies.alias("copies")).filter("copies > 0")
        .select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("nth")).select("row.*", F.col("nth").alias(name))
    )
