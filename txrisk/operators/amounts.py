"""How the positive amounts are distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txrisk.functions.bands import band_label, band_order
from txrisk.functions.rounding import amount, mean_amount, percent
from txrisk.params import AMOUNT_BANDS, Bands

CELL_BITS = 20


def _per_value(facts: DataFrame) -> DataFrame:
    """How often each positive amount occurs."""
    return (
        facts.filter(F.col("n_pos") > 0)
        .groupBy(F.col("pos_cents").alias("cents"))
        .agg(F.sum("n_pos").alias("n"))
    )


def exact_median(facts: DataFrame) -> DataFrame:
    """The lowest positive amount that at least half of the positive amounts do not exceed.

    The amounts are first counted per value. The values are then searched in two steps, by their upper bits
    and then by the ``CELL_BITS`` lower ones, so that no task has to order all of them: DECIMAL(12,2) leaves
    about a million cells for the first step to order, and the one cell of the second a million values.
    """
    per_value = _per_value(facts).withColumn("cell", F.shiftright("cents", CELL_BITS))
    per_cell = per_value.groupBy("cell").agg(F.sum("n").alias("n_cell"))
    everything = Window.partitionBy(F.lit(0))
    located = (
        per_cell.select(
            "cell",
            F.sum("n_cell").over(everything.orderBy("cell")).alias("upto"),
            F.sum("n_cell").over(everything).alias("n_all"),
            "n_cell",
        )
        .filter((F.col("upto") * 2 >= F.col("n_all")) & ((F.col("upto") - F.col("n_cell")) * 2 < F.col("n_all")))
        .select("cell", (F.col("upto") - F.col("n_cell")).alias("before"), "n_all")
    )
    inside = Window.partitionBy("cell").orderBy("cents")
    return (
        per_value.join(F.broadcast(located), "cell")  # one row
        .select("cents", "n_all", (F.col("before") + F.sum("n").over(inside)).alias("upto"))
        .filter(F.col("upto") * 2 >= F.col("n_all"))
        .agg(F.min("cents").alias("median_cents"))
    )


def amount_stats(facts: DataFrame, exact: bool = False) -> DataFrame:
    """Mean, median, lowest and highest positive amount.

    The median is a sketch unless ``exact``. Then everything comes from the count per value, which Spark
    computes once for all three of its uses.
    """
    if exact:
        cents, n = F.col("cents"), F.col("n")
        measured = _per_value(facts).agg(
            F.sum(n).alias("n_pos"),
            F.sum(cents * n).alias("pos_cents"),
            F.min(cents).alias("min_cents"),
            F.max(cents).alias("max_cents"),
        )
        both = measured.unionByName(exact_median(facts), allowMissingColumns=True)
        found = both.agg(*[F.max(name).alias(name) for name in both.columns])
    else:
        found = facts.agg(
            F.sum("n_pos").alias("n_pos"),
            F.sum("pos_cents").alias("pos_cents"),
            F.min("min_pos_cents").alias("min_cents"),
            F.max("max_pos_cents").alias("max_cents"),
            F.percentile_approx("min_pos_cents", 0.5).alias("median_cents"),
        )
    return found.select(
        mean_amount(F.col("pos_cents"), F.col("n_pos")).alias("mean_amount"),
        amount(F.col("median_cents")).alias("median_amount"),
        amount(F.col("min_cents")).alias("min_amount"),
        amount(F.col("max_cents")).alias("max_amount"),
    )


def with_amount_band(facts: DataFrame, bands: Bands = AMOUNT_BANDS) -> DataFrame:
    """Adds the band of a positive amount and its order; NULL for other amounts."""
    positive = F.when(F.col("n_pos") > 0, F.col("amount_clean"))
    return facts.withColumns(
        {"amount_band": band_label(positive, bands), "band_ord": band_order(positive, bands)}
    )


def amount_bands(banded: DataFrame) -> DataFrame:
    """Number and share of the positive amounts per band."""
    per_band = (
        banded.filter(F.col("band_ord").isNotNull())
        .groupBy("band_ord", "amount_band")
        .agg(F.sum("n_pos").alias("n_tx"))
    )
    everything = F.sum("n_tx").over(Window.partitionBy(F.lit(0)))  # over one row per band
    return per_band.select(
        "band_ord", "amount_band", "n_tx", percent(F.col("n_tx"), everything).alias("pct_tx")
    ).orderBy("band_ord")


def high_amount_share(facts: DataFrame) -> DataFrame:
    """Positive amounts strictly above the high amount of :func:`txrisk.operators.facts.facts`."""
    return facts.agg(F.sum("n_high").alias("n_high"), F.sum("n_pos").alias("n_pos")).select(
        "n_high", percent(F.col("n_high"), F.col("n_pos")).alias("pct_high")
    )
