"""Flagging suspicious cards and saying why."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.functions.bands import band_label
from txrisk.operators.ranking import top
from txrisk.params import CRITERIA_ACTIONS, CRITERIA_LEVELS, DARK_WEB_YES, Thresholds


def dark_web_cards(cards: DataFrame) -> DataFrame:
    return cards.filter(F.col("card_on_dark_web") == DARK_WEB_YES).select(F.col("id").alias("card_id")).distinct()


def rule_hits(card_days: DataFrame, cards: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """Days on which each card broke each rule, and whether the card is on the dark web (0 or 1).

    The rules are three conditions over one pass of the card-days; the card table meets one row per card.
    """
    days = {
        "high_tx_count": F.col("n_tx") > limits.max_tx,
        "multi_city": F.col("n_cities_physical") > limits.max_cities,
        "high_amount": F.col("pos_cents") > limits.max_amount * 100,
    }
    per_card = card_days.groupBy("card_id").agg(
        *[F.count_if(broken).alias(rule) for rule, broken in days.items()]
    )
    listed = dark_web_cards(cards).withColumn("dark_web", F.lit(1).cast("bigint"))
    return per_card.join(listed, "card_id", "left").fillna(0, ["dark_web"])


RULES = ("dark_web", "high_amount", "high_tx_count", "multi_city")


def suspicious_cards(card_days: DataFrame, cards: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """Cards that broke a rule: their distinct reasons, rule hits counted per day, and distinct criteria."""
    hits = rule_hits(card_days, cards, limits)
    reasons = F.array_compact(F.array(*[F.when(F.col(rule) > 0, F.lit(rule)) for rule in RULES]))
    n_hits = sum((F.col(rule) for rule in RULES[1:]), F.col(RULES[0]))
    return (
        hits.select("card_id", reasons.alias("reasons"), n_hits.alias("n_rule_hits"))
        .filter(F.col("n_rule_hits") > 0)
        .withColumn("n_criteria", F.size("reasons"))
    )


def top_suspicious_cards(suspicious: DataFrame, k: int = 20) -> DataFrame:
    return top(suspicious, k, "n_rule_hits", "card_id")


def suspicious_count(suspicious: DataFrame) -> DataFrame:
    return suspicious.agg(F.count("*").alias("n_cards"))


def suspicion_reasons(suspicious: DataFrame) -> DataFrame:
    """Suspicious cards per reason, the most frequent reason first."""
    return (
        suspicious.select(F.explode("reasons").alias("reason"))
        .groupBy("reason")
        .agg(F.count("*").alias("n_cards"))
        .orderBy(F.desc("n_cards"), "reason")
    )


def criteria_levels(suspicious: DataFrame) -> DataFrame:
    """Risk level and action by the number of distinct criteria a card meets."""
    n = F.col("n_criteria")
    return suspicious.withColumns(
        {"level": band_label(n, CRITERIA_LEVELS), "action": band_label(n, CRITERIA_ACTIONS)}
    )
