"""Cards: what kind they are, how old, and whether they are for sale somewhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.functions.rounding import amount, mean_amount
from txrisk.operators.enrich import card_attributes, card_dates
from txrisk.operators.facts import totals
from txrisk.operators.ranking import top
from txrisk.operators.rules import dark_web_cards
from txrisk.params import CARD_TYPE_RISK, DecisionRules


def by_card_type(facts: DataFrame, cards: DataFrame, *keys: str) -> DataFrame:
    """Transactions and mean amount per card attribute; the rows are rolled up per card first."""
    measures = totals("n_tx", "n_amount", "net_cents")
    per_card = facts.groupBy("card_id").agg(*measures)
    return (
        per_card.join(card_attributes(cards), "card_id", "left")
        .groupBy(*keys)
        .agg(*measures)
        .select(
            *keys, "n_tx", mean_amount(F.col("net_cents"), F.col("n_amount")).alias("mean_amount")
        )
    )


def card_type_brand(facts: DataFrame, cards: DataFrame) -> DataFrame:
    return by_card_type(facts, cards, "card_type", "card_brand").orderBy(
        F.desc("n_tx"), F.asc_nulls_last("card_type"), F.asc_nulls_last("card_brand")
    )


def type_risk(card_type: Column) -> Column:
    """The risk of the first listed kind whose name occurs in the card type; a prepaid debit card is prepaid."""
    (first, risk), *others = CARD_TYPE_RISK.items()
    chain = F.when(card_type.contains(first), F.lit(risk))
    for kind, risk in others:
        chain = chain.when(card_type.contains(kind), F.lit(risk))
    return chain.otherwise(F.lit("unknown"))


def card_type_risk(facts: DataFrame, cards: DataFrame) -> DataFrame:
    return by_card_type(facts, cards, "card_type").withColumn("risk", type_risk(F.col("card_type")))


def dark_web_activity(facts: DataFrame, cards: DataFrame) -> DataFrame:
    """Transactions and net amount of every card that is on the dark web and still in use."""
    per_card = facts.groupBy("card_id").agg(*totals("n_tx", "n_amount", "net_cents"))
    return per_card.join(dark_web_cards(cards), "card_id", "left_semi").select(
        "card_id", "n_tx", amount(F.col("net_cents"), F.col("n_amount")).alias("amount_net")
    )


def dark_web_count(facts: DataFrame, cards: DataFrame) -> DataFrame:
    return dark_web_activity(facts, cards).agg(F.count("*").alias("n_cards"))


def top_dark_web_cards(facts: DataFrame, cards: DataFrame, k: int = 10) -> DataFrame:
    return top(dark_web_activity(facts, cards), k, "n_tx", "card_id")


def card_ages(cards: DataFrame, as_of: str) -> DataFrame:
    """Age of every card in days and years since its PIN was changed, on the given day."""
    day = F.lit(as_of).cast("date")
    return card_dates(cards).select(
        "card_id",
        F.datediff(day, "opened_on").alias("card_age_days"),
        (F.year(day) - F.col("year_pin_last_changed")).alias("pin_age_years"),
    )


def _cards_in_use(facts: DataFrame, cards: DataFrame, as_of: str) -> DataFrame:
    per_card = facts.groupBy("card_id").agg(*totals("n_tx"))
    return per_card.join(card_ages(cards, as_of), "card_id")


def new_card_bursts(
    facts: DataFrame, cards: DataFrame, as_of: str, rules: DecisionRules = DecisionRules()
) -> DataFrame:
    """Young cards with many transactions."""
    return _cards_in_use(facts, cards, as_of).filter(
        (F.col("card_age_days") < rules.new_card_days) & (F.col("n_tx") >= rules.new_card_tx)
    ).select("card_id", "n_tx", "card_age_days")


def stale_pins(
    facts: DataFrame, cards: DataFrame, as_of: str, rules: DecisionRules = DecisionRules()
) -> DataFrame:
    """Cards in use whose PIN has not been changed for years."""
    return (
        _cards_in_use(facts, cards, as_of)
        .filter(F.col("pin_age_years") >= rules.stale_pin_years)
        .select("card_id", "n_tx", "pin_age_years")
    )
