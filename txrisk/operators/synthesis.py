"""The figures of the closing report, one row each: (``metric``, ``value``)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.functions import cleaning as C
from txrisk.functions.rounding import mean_amount, percent
from txrisk.operators.amounts import exact_median
from txrisk.operators.cards import dark_web_count
from txrisk.operators.enrich import card_attributes, user_attributes
from txrisk.operators.errors import error_rates, error_types
from txrisk.operators.facts import totals
from txrisk.params import BAD_PIN, INSUFFICIENT_BALANCE, DecisionRules, Thresholds


def _metrics(one_row: DataFrame, **metrics: Column) -> DataFrame:
    """A one-row frame laid out as one row per metric."""
    pairs = [
        F.struct(F.lit(name).alias("metric"), value.cast("double").alias("value")) for name, value in metrics.items()
    ]
    return one_row.select(F.inline(F.array(*pairs)))


def _overall(facts: DataFrame) -> DataFrame:
    """Everything that a single pass over the transactions can tell."""
    n, n_pos, n_errors = F.sum("n_tx"), F.sum("n_pos"), F.sum("n_errors")
    small = F.when(F.col("amount_clean") < 50, F.col("n_pos"))

    def of_rows(condition: Column) -> Column:
        return percent(F.sum(F.when(condition, F.col("n_tx")).otherwise(F.lit(0))), n)

    def of_errors(text: str) -> Column:
        return percent(F.sum(F.when(F.col("errors") == text, F.col("n_errors")).otherwise(F.lit(0))), n_errors)

    figures = {
        "night_share": percent(F.sum("n_night"), n),
        "daytime_share": of_rows(F.col("tx_hour").between(10, 19)),
        "weekend_share": of_rows(C.is_weekend(F.col("tx_dow"))),
        "online_share": percent(F.sum("n_online"), n),
        "share_below_50": percent(F.sum(F.coalesce(small, F.lit(0))), n_pos),
        "share_above_200": percent(F.sum("n_high"), n_pos),
        "mean_amount": mean_amount(F.sum("pos_cents"), n_pos),
        "insufficient_balance_share": of_errors(INSUFFICIENT_BALANCE),
        "bad_pin_share": of_errors(BAD_PIN),
    }
    one_row = facts.agg(*[value.alias(name) for name, value in figures.items()])
    return _metrics(one_row, **{name: F.col(name) for name in figures})


def _top_error_share(facts: DataFrame) -> DataFrame:
    types = error_types(facts)
    best = types.agg(F.max("n_tx").alias("best"), F.sum("n_tx").alias("n"))
    return _metrics(best, top_error_share=percent(F.col("best"), F.col("n")))


def _cards(facts: DataFrame, cards: DataFrame, rate_above: int = 10) -> DataFrame:
    """Error-prone cards, and the mean amount of credit and debit cards, from one row per card."""
    per_card = error_rates(facts, "card_id").filter(F.col("card_id").isNotNull())
    failing = per_card.agg(F.count_if(F.col("error_rate") > rate_above).alias("n"))
    spent = facts.groupBy("card_id").agg(*totals("n_amount", "net_cents"))
    typed = spent.join(card_attributes(cards).select("card_id", "card_type"), "card_id", "left")

    def mean_of(kind: str) -> Column:
        of_kind = F.col("card_type").contains(kind)
        return mean_amount(
            F.sum(F.when(of_kind, F.col("net_cents"))), F.sum(F.when(of_kind, F.col("n_amount")))
        )

    means = typed.agg(mean_of("Credit").alias("credit"), mean_of("Debit").alias("debit"))
    return (
        _metrics(failing, cards_error_rate_above_10=F.col("n"))
        .unionAll(_metrics(means, mean_amount_credit=F.col("credit"), mean_amount_debit=F.col("debit")))
        .unionAll(_metrics(dark_web_count(facts, cards), dark_web_cards_active=F.col("n_cards")))
    )


def _credit(facts: DataFrame, users: DataFrame, rules: DecisionRules) -> DataFrame:
    """Error rates of the transactions of clients with a low credit score and of the others."""
    per_client = facts.groupBy("client_id").agg(*totals("n_tx", "n_errors"))
    scored = per_client.join(user_attributes(users).select("client_id", "credit_score"), "client_id")

    def rate(condition: Column) -> Column:
        return percent(F.sum(F.when(condition, F.col("n_errors"))), F.sum(F.when(condition, F.col("n_tx"))))

    low = F.col("credit_score") < rules.weak_credit_score
    rates = scored.agg(rate(low).alias("low"), rate(~low).alias("other"))
    return _metrics(rates, error_rate_low_credit=F.col("low"), error_rate_other_credit=F.col("other"))


def synthesis_metrics(
    facts: DataFrame,
    daily: DataFrame,
    card_days: DataFrame,
    cards: DataFrame,
    users: DataFrame,
    rules: DecisionRules = DecisionRules(),
    limits: Thresholds = Thresholds(),
) -> DataFrame:
    """All figures. ``daily`` may be the facts again; on large data it is the written daily table."""
    mobile = card_days.agg(F.count_if(F.col("n_cities_physical") > limits.max_cities).alias("n"))
    parts = [
        _overall(facts),
        _metrics(exact_median(facts), median_amount=F.col("median_cents") / F.lit(100)),
        _top_error_share(facts),
        _cards(daily, cards),
        _metrics(mobile, card_days_above_3_cities=F.col("n")),
        _credit(daily, users, rules),
    ]
    return reduce(DataFrame.unionAll, parts)
