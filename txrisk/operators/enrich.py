"""Adding what is known about the category, the card and the client.

The joins carry no hint: Spark broadcasts a dimension when its size is known to be small and otherwise
joins by key, where adaptive execution splits the partition of a card or client that holds a large share
of the rows. Reports do not need these joins on the rows at all. They first roll the rows up to the
key and join one row per key (see the ``*_by_*`` functions of the other modules).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.functions import cleaning as C
from txrisk.params import UNKNOWN_CATEGORY


def card_attributes(cards: DataFrame) -> DataFrame:
    return cards.select(
        F.col("id").alias("card_id"),
        "card_brand",
        "card_type",
        "card_on_dark_web",
        C.money(F.col("credit_limit")).alias("credit_limit_clean"),
        "has_chip",
        "year_pin_last_changed",
    )


def card_dates(cards: DataFrame) -> DataFrame:
    return cards.select(
        F.col("id").alias("card_id"),
        C.month_start(F.col("acct_open_date")).alias("opened_on"),
        "year_pin_last_changed",
    )


def user_attributes(users: DataFrame) -> DataFrame:
    return users.select(
        F.col("id").alias("client_id"),
        "current_age",
        "gender",
        "credit_score",
        C.money(F.col("yearly_income").cast("string")).alias("yearly_income_clean"),
        "num_credit_cards",
    )


def with_category(rows: DataFrame, codes: DataFrame) -> DataFrame:
    """Left join on the category code; rows without a known code get the default category."""
    return rows.join(codes, rows["mcc"] == codes["mcc_code"], "left").withColumn(
        "merchant_category", F.coalesce("mcc_category", F.lit(UNKNOWN_CATEGORY))
    )


def enrich(tx: DataFrame, codes: DataFrame, cards: DataFrame, users: DataFrame) -> DataFrame:
    """Every transaction with its category, card and client columns; unknown ones stay, with NULLs."""
    return (
        with_category(tx, codes)
        .join(card_attributes(cards), "card_id", "left")
        .join(user_attributes(users), "client_id", "left")
    )
