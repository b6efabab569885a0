"""The weighted risk score of a card-day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.functions.bands import band_label, band_order
from txrisk.operators.indicators import card_day_indicators
from txrisk.operators.ranking import top
from txrisk.params import SCORE_ACTIONS, SCORE_BANDS, Bands, ScoreWeights


def risk_scores(card_days: DataFrame, weights: ScoreWeights = ScoreWeights()) -> DataFrame:
    """Indicators and score of every card-day. A day without a valid amount gets no bonus."""
    score = (
        F.col("n_tx") * weights.per_tx
        + F.col("n_cities_all") * weights.per_city
        + F.col("n_errors") * weights.per_error
        + F.col("n_night") * weights.per_night_tx
        + F.when(F.col("amount_net") > weights.high_amount, weights.high_amount_bonus).otherwise(0)
    )
    return card_day_indicators(card_days).withColumn("risk_score", score)


def top_risk_scores(scores: DataFrame, k: int = 20) -> DataFrame:
    return top(scores, k, "risk_score", "card_id", "tx_date")


def score_bands(scores: DataFrame, bands: Bands = SCORE_BANDS) -> DataFrame:
    """Card-days per score band, lowest band first."""
    score = F.col("risk_score")
    return (
        scores.groupBy(band_order(score, bands).alias("band_ord"), band_label(score, bands).alias("score_band"))
        .agg(F.count("*").alias("n_card_days"))
        .orderBy("band_ord")
    )


def score_levels(scores: DataFrame) -> DataFrame:
    """Every card-day with the level of its score and the action that goes with it."""
    score = F.col("risk_score")
    return scores.select(
        "card_id",
        "tx_date",
        "risk_score",
        band_label(score, SCORE_BANDS).alias("level"),
        band_label(score, SCORE_ACTIONS).alias("action"),
    )
