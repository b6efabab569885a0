"""Sums and joins by card over transactions that are stored by card (see :mod:`txrisk.sources.by_card`).

Each gives what its namesake gives for any transactions, but the rows are not exchanged: an exchange sees one row for each card
and slot at most, or the undated rows' sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.functions.rounding import percent
from txrisk.operators import sequences
from txrisk.operators.enrich import card_attributes, user_attributes, with_category
from txrisk.operators.facts import facts, rollup, totals
from txrisk.sources.by_card import KEYS, ByCard


def moments(stored: ByCard) -> DataFrame:
    """As :func:`txrisk.operators.sequences.moments`. A second of a card is in one slot; only undated rows may be in several."""
    rows, dated = facts(stored.rows), F.col("tx_ts").isNotNull()
    return sequences.moments(rows.filter(dated), "slot").drop("slot").union(sequences.moments(rows.filter(~dated)))


def card_totals(stored: ByCard, *measures: str) -> DataFrame:
    """The named measures per card (all by default), summed per slot first."""
    per_slot = facts(stored.rows).groupBy(*KEYS).agg(*totals(*measures))
    return rollup(per_slot, "card_id")


def card_error_rates(stored: ByCard, floor: int = 0) -> DataFrame:
    """As :func:`txrisk.operators.errors.error_rates` by card."""
    counted = card_totals(stored, "n_tx", "n_errors").filter(F.col("n_tx") >= floor)
    return counted.withColumn("error_rate", percent(F.col("n_errors"), F.col("n_tx")))


def with_card(stored: ByCard, cards: DataFrame) -> DataFrame:
    """The rows with the columns of their card. The cards are dealt to the rows' buckets; rows stay where they are."""
    about = stored.per_slot(card_attributes(cards))
    return stored.rows.join(about, list(KEYS), "left").drop("slot")


def enrich(stored: ByCard, codes: DataFrame, cards: DataFrame, users: DataFrame) -> DataFrame:
    """As :func:`txrisk.operators.enrich.enrich`. The join by card comes first, while the rows are by card."""
    return with_category(with_card(stored, cards), codes).join(user_attributes(users), "client_id", "left")
