"""Failed transactions: which errors, whose, and how often."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.functions.bands import band_label, band_order
from txrisk.functions.rounding import percent, ratio
from txrisk.operators.enrich import user_attributes
from txrisk.operators.facts import totals
from txrisk.operators.ranking import top
from txrisk.operators.reaching import reaching
from txrisk.params import CREDIT_BANDS, ERROR_RISK, Bands, DecisionRules, Floors


def error_types(facts: DataFrame, split_errors: bool = False) -> DataFrame:
    """Transactions per error text; ``split_errors`` counts the comma-separated parts one by one."""
    failed = facts.filter(F.col("n_errors") > 0)
    if split_errors:
        failed = failed.withColumn("errors", F.explode(F.split("errors", r"\s*,\s*"))).filter(
            F.col("errors") != ""
        )
    return failed.groupBy("errors").agg(F.sum("n_errors").alias("n_tx"))


def top_error_types(facts: DataFrame, k: int = 10, split_errors: bool = False) -> DataFrame:
    return top(error_types(facts, split_errors), k, "n_tx", "errors")


def top_error_type(facts: DataFrame) -> DataFrame:
    """The most frequent error text (the first by name of equals), its transactions and its share of all failed ones; no
    row without errors."""
    first = F.min(F.struct((-F.col("n_tx")).alias("n"), "errors"))
    found = error_types(facts).agg(first.alias("first"), F.sum("n_tx").alias("n_all")).filter("first IS NOT NULL")
    n = -F.col("first.n")
    return found.select("first.errors", n.alias("n_tx"), percent(n, F.col("n_all")).alias("error_share"))


def error_type_risk(facts: DataFrame) -> DataFrame:
    """Every error text with what it says about the transaction; unlisted texts are unknown."""
    risk = F.create_map(*[F.lit(part) for pair in ERROR_RISK.items() for part in pair])
    return error_types(facts).withColumn(
        "risk", F.coalesce(F.try_element_at(risk, F.col("errors")), F.lit("unknown"))
    )


def error_rates(facts: DataFrame, key: str, floor: int = 0, bits: int | None = None) -> DataFrame:
    """Error rate of every card or client with at least ``floor`` transactions.

    With ``bits``, a sketch of that size first rules out rows of smaller groups (see :mod:`txrisk.operators.reaching`).
    """
    return (
        (facts if bits is None else reaching(facts, key, floor, bits=bits))
        .groupBy(key)
        .agg(*totals("n_tx", "n_errors"))
        .filter(F.col("n_tx") >= floor)
        .withColumn("error_rate", percent(F.col("n_errors"), F.col("n_tx")))
    )


def card_error_rates(facts: DataFrame, k: int = 10, floors: Floors = Floors(), bits: int | None = None) -> DataFrame:
    return top(error_rates(facts, "card_id", floors.card_tx, bits), k, "error_rate", "card_id")


def client_error_rates(facts: DataFrame, k: int = 10, floors: Floors = Floors(), bits: int | None = None) -> DataFrame:
    return top(error_rates(facts, "client_id", floors.client_tx, bits), k, "error_rate", "client_id")


def scored_clients(facts: DataFrame, users: DataFrame, floors: Floors = Floors()) -> DataFrame:
    """Error rates of the clients whose credit score is known. One row per client meets ``users``."""
    rates = error_rates(facts, "client_id", floors.scored_client_tx)
    scores = user_attributes(users).select("client_id", "credit_score")
    return rates.join(scores.filter(F.col("credit_score").isNotNull()), "client_id")


def credit_band_errors(
    facts: DataFrame, users: DataFrame, bands: Bands = CREDIT_BANDS, floors: Floors = Floors()
) -> DataFrame:
    """Mean of the clients' error rates per credit-score band."""
    score = F.col("credit_score")
    in_hundredths = (F.col("error_rate").cast("decimal(12,2)") * 100).cast("bigint")
    return (
        scored_clients(facts, users, floors)
        .groupBy(band_order(score, bands).alias("band_ord"), band_label(score, bands).alias("credit_band"))
        .agg(F.count("*").alias("n_clients"), F.sum(in_hundredths).alias("total"))
        .select(
            "band_ord",
            "credit_band",
            "n_clients",
            ratio(F.col("total"), F.col("n_clients") * 100).alias("mean_error_rate"),
        )
        .orderBy("band_ord")
    )


def weak_profiles(
    facts: DataFrame, users: DataFrame, rules: DecisionRules = DecisionRules(), floors: Floors = Floors()
) -> DataFrame:
    """Clients with a low credit score and a high error rate."""
    return scored_clients(facts, users, floors).filter(
        (F.col("credit_score") < rules.weak_credit_score) & (F.col("error_rate") > rules.weak_error_rate)
    )


def error_rate_bands(facts: DataFrame, key: str, bands: Bands) -> DataFrame:
    """Cards or clients per error-rate band."""
    rate = F.col("error_rate")
    return (
        error_rates(facts, key)
        .groupBy(band_order(rate, bands).alias("band_ord"), band_label(rate, bands).alias("error_band"))
        .agg(F.count("*").alias("n_groups"))
        .orderBy("band_ord")
    )


def dominant_errors(facts: DataFrame) -> DataFrame:
    """The most frequent error text of every card, the alphabetically first among equals."""
    per_error = (
        facts.filter(F.col("n_errors") > 0).groupBy("card_id", "errors").agg(F.sum("n_errors").alias("n_errors"))
    )
    best = F.min(F.struct((-F.col("n_errors")).alias("rank"), F.col("errors").alias("errors")))
    return (
        per_error.groupBy("card_id")
        .agg(best.alias("best"))
        .select(
            "card_id",
            F.col("best.errors").alias("dominant_error"),
            (-F.col("best.rank")).alias("n_dominant"),
        )
    )


def error_concentration(facts: DataFrame) -> DataFrame:
    """Share of a card's errors that fell into its worst hour."""
    per_hour = (
        facts.filter((F.col("n_errors") > 0) & F.col("tx_ts").isNotNull())
        .groupBy("card_id", "tx_date", "tx_hour")
        .agg(F.sum("n_errors").alias("n_errors"))
    )
    return (
        per_hour.groupBy("card_id")
        .agg(F.sum("n_errors").alias("n_errors"), F.max("n_errors").alias("n_worst_hour"))
        .withColumn("worst_hour_share", percent(F.col("n_worst_hour"), F.col("n_errors")))
    )
