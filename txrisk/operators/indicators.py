"""Indicators per card and day, per card, and per client and card.

Distinct cities are counted by summing twice, per card, day and city and then per card and day. So they
are exact without gathering a set of cities anywhere, and a card that holds a large share of the rows is
spread over its days and cities. Both steps build partial sums before they shuffle.

A run that needs many of these writes the :func:`daily` table once and hands it to the others in place
of the facts: all of them are sums of its measures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.functions import cleaning as C
from txrisk.functions.rounding import amount, percent
from txrisk.operators.facts import totals
from txrisk.operators.ranking import top

DAILY_KEYS = ("client_id", "card_id", "tx_date", "merchant_city")
DAILY_MEASURES = (
    "n_tx",
    "n_amount",
    "net_cents",
    "n_pos",
    "pos_cents",
    "n_errors",
    "n_night",
    "n_online",
)


def daily(facts: DataFrame) -> DataFrame:
    """The measures of cards and clients per client, card, day and city."""
    return facts.groupBy(*DAILY_KEYS).agg(*totals(*DAILY_MEASURES))


def card_days(facts: DataFrame) -> DataFrame:
    """The same measures per card and day, with two counts of cities.

    ``n_cities_physical`` leaves out online purchases and is what the rules look at; ``n_cities_all``
    counts ``ONLINE`` as a city, as the score does.
    """
    city = F.col("merchant_city")
    per_city = facts.groupBy("card_id", "tx_date", "merchant_city").agg(*totals(*DAILY_MEASURES))
    return per_city.groupBy("card_id", "tx_date").agg(
        *totals(*DAILY_MEASURES),
        F.count(city).alias("n_cities_all"),
        F.count_if(C.is_physical(city)).alias("n_cities_physical"),
    )


def card_day_tx(facts: DataFrame) -> DataFrame:
    return facts.groupBy("card_id", "tx_date").agg(*totals("n_tx"))


def card_day_spend(facts: DataFrame) -> DataFrame:
    """Sum of the positive amounts; a day without one has no row."""
    return (
        facts.filter(F.col("n_pos") > 0)
        .groupBy("card_id", "tx_date")
        .agg(*totals("pos_cents"))
        .select("card_id", "tx_date", amount(F.col("pos_cents")).alias("spend_pos"))
    )


def card_day_cities(facts: DataFrame) -> DataFrame:
    """Distinct cities other than ``ONLINE``; a day without one has no row."""
    return (
        facts.filter(C.is_physical(F.col("merchant_city")))
        .groupBy("card_id", "tx_date")
        .agg(F.count_distinct("merchant_city").alias("n_cities_physical"))
    )


def card_error_ratio(facts: DataFrame) -> DataFrame:
    return (
        facts.groupBy("card_id")
        .agg(*totals("n_tx", "n_errors"))
        .withColumn("error_ratio", percent(F.col("n_errors"), F.col("n_tx")))
    )


def top_indicators(facts: DataFrame, k: int = 5) -> dict[str, DataFrame]:
    """The ``k`` most active card-days or cards of each of the four indicators."""
    day = ("card_id", "tx_date")
    return {
        "transactions": top(card_day_tx(facts), k, "n_tx", *day),
        "spend": top(card_day_spend(facts), k, "spend_pos", *day),
        "cities": top(card_day_cities(facts), k, "n_cities_physical", *day),
        "errors": top(card_error_ratio(facts), k, "error_ratio", "card_id"),
    }


def card_lifetime(facts: DataFrame) -> DataFrame:
    """Transactions, net amount, distinct cities and active days of every card."""
    return (
        facts.groupBy("card_id")
        .agg(
            *totals("n_tx", "n_amount", "net_cents"),
            F.count_distinct("merchant_city").alias("n_cities"),
            F.count_distinct("tx_date").alias("n_days"),
        )
        .select(
            "card_id",
            "n_tx",
            amount(F.col("net_cents"), F.col("n_amount")).alias("amount_net"),
            "n_cities",
            "n_days",
        )
    )


def card_day_indicators(card_days: DataFrame) -> DataFrame:
    """The indicators the score is made of; the amount is net of refunds."""
    return card_days.select(
        "card_id",
        "tx_date",
        "n_tx",
        amount(F.col("net_cents"), F.col("n_amount")).alias("amount_net"),
        "n_cities_all",
        "n_errors",
        "n_night",
    )


def week_start() -> Column:
    """The Monday of the week of ``tx_date``."""
    return F.date_sub(F.col("tx_date"), F.weekday("tx_date"))


def weekly_tx(facts: DataFrame) -> DataFrame:
    return facts.groupBy("card_id", week_start().alias("week_start")).agg(*totals("n_tx"))


def online_ratio(facts: DataFrame) -> DataFrame:
    return (
        facts.groupBy("card_id")
        .agg(*totals("n_tx", "n_online"))
        .withColumn("online_pct", percent(F.col("n_online"), F.col("n_tx")))
    )
