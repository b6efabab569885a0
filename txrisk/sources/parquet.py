"""Parquet results: overwrite or append, optionally one folder per value of some columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """Write ``df``. With ``partition_by`` the rows of a folder are brought together first, and the
    rebalance hint lets Spark split a folder that holds far more rows than the others."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
        df.write.mode(mode).partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode(mode).parquet(path)


def append_once(df: DataFrame, path: str, batch: str, column: str = "batch") -> None:
    """Add the rows of ``batch`` to a table that has a folder for each batch. The same batch written again replaces its rows, so a job
    that is repeated adds them once; other batches are not touched. A batch without rows changes nothing.

    Readers see ``column`` with the name of the batch; see :func:`read_appended`.
    """
    if column in df.columns:
        raise ValueError(f"the rows have a column {column}")
    tagged = df.withColumn(column, F.lit(batch))
    tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def read_appended(spark: SparkSession, path: str, column: str = "batch") -> DataFrame:
    """All batches of :func:`append_once`, without their names."""
    return spark.read.parquet(path).drop(column)


def read_scores(spark: SparkSession, path: str, above: int | None = None) -> DataFrame:
    """Saved risk scores; the filter is pushed into the scan."""
    scores = spark.read.parquet(path)
    return scores if above is None else scores.filter(F.col("risk_score") > above)
