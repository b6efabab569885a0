"""Deterministic top-k reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top(df: DataFrame, k: int, by: str, *ties: str) -> DataFrame:
    """The ``k`` rows with the highest ``by``; equal rows are ordered by the ``ties`` columns.

    Spark keeps ``k`` rows per partition and merges those, so nothing is sorted as a whole.
    """
    return df.orderBy(F.desc_nulls_last(by), *[F.asc_nulls_last(name) for name in ties]).limit(k)
