"""Merchant categories and merchants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.functions.rounding import mean_amount, percent
from txrisk.operators.enrich import with_category
from txrisk.operators.facts import totals
from txrisk.operators.ranking import top
from txrisk.params import DecisionRules, Floors


def by_category(facts: DataFrame, codes: DataFrame, *measures: str) -> DataFrame:
    """Measures per category: rolled up per code first, so one row per code meets the code table."""
    per_code = facts.groupBy("mcc").agg(*totals(*measures))
    return with_category(per_code, codes).groupBy("merchant_category").agg(*totals(*measures))


def category_volume(facts: DataFrame, codes: DataFrame) -> DataFrame:
    return by_category(facts, codes, "n_tx", "n_amount", "net_cents").select(
        "merchant_category", "n_tx", mean_amount(F.col("net_cents"), F.col("n_amount")).alias("mean_amount")
    )


def top_categories(facts: DataFrame, codes: DataFrame, k: int = 10) -> DataFrame:
    return top(category_volume(facts, codes), k, "n_tx", "merchant_category")


def category_means(facts: DataFrame, codes: DataFrame, floors: Floors = Floors()) -> DataFrame:
    """Mean positive amount of the categories with enough positive transactions."""
    return (
        by_category(facts, codes, "n_pos", "pos_cents")
        .filter(F.col("n_pos") > floors.category_tx_above)
        .select(
            "merchant_category",
            F.col("n_pos").alias("n_tx"),
            mean_amount(F.col("pos_cents"), F.col("n_pos")).alias("mean_amount"),
        )
    )


def top_category_means(facts: DataFrame, codes: DataFrame, k: int = 10, floors: Floors = Floors()) -> DataFrame:
    return top(category_means(facts, codes, floors), k, "mean_amount", "merchant_category")


def category_risk(
    facts: DataFrame, codes: DataFrame, rules: DecisionRules = DecisionRules(), floors: Floors = Floors()
) -> DataFrame:
    """Reported categories, marked as high-value when their mean amount is above the limit."""
    return category_means(facts, codes, floors).withColumn(
        "is_high_value", F.col("mean_amount") > rules.high_mean_amount
    )


MERCHANT_MEASURES = ("n_tx", "n_pos", "pos_cents", "n_errors")


def merchant_totals(facts: DataFrame) -> DataFrame:
    """The measures of every merchant; a run writes them once and hands them to the reports below in place of the facts."""
    return facts.groupBy("merchant_id").agg(*totals(*MERCHANT_MEASURES))


def merchants(facts: DataFrame) -> DataFrame:
    """Volume, mean positive amount and error rate per merchant: its reputation."""
    return merchant_totals(facts).select(
        "merchant_id",
        "n_tx",
        mean_amount(F.col("pos_cents"), F.col("n_pos")).alias("mean_amount"),
        percent(F.col("n_errors"), F.col("n_tx")).alias("error_rate"),
    )


def suspicious_merchants(facts: DataFrame, rules: DecisionRules = DecisionRules()) -> DataFrame:
    """Merchants with few transactions and high amounts."""
    return merchants(facts).filter(
        (F.col("n_tx") <= rules.merchant_max_tx) & (F.col("mean_amount") > rules.merchant_min_mean)
    )
