"""When transactions happen."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.functions.rounding import percent


def _count_by(facts: DataFrame, key: str) -> DataFrame:
    return facts.groupBy(key).agg(F.sum("n_tx").alias("n_tx")).orderBy(key)


def by_hour(facts: DataFrame) -> DataFrame:
    return _count_by(facts, "tx_hour")


def by_day_of_week(facts: DataFrame) -> DataFrame:
    """1 is Sunday, 7 is Saturday."""
    return _count_by(facts, "tx_dow")


def by_month(facts: DataFrame) -> DataFrame:
    return _count_by(facts, "tx_month")


def night_share(facts: DataFrame) -> DataFrame:
    """Transactions from 00:00:00 to 05:59:59 as a share of all, those without a time included."""
    return facts.agg(F.sum("n_night").alias("n_night"), F.sum("n_tx").alias("n_tx")).select(
        "n_night", percent(F.col("n_night"), F.col("n_tx")).alias("pct_night")
    )
