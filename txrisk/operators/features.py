"""Features for a later model: per transaction, and per card, day and week."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.functions import cleaning as C
from txrisk.functions.rounding import amount, percent
from txrisk.operators.attach import HOT_ROWS, attach
from txrisk.operators.cards import card_ages
from txrisk.operators.categories import category_risk, merchants
from txrisk.operators.enrich import card_attributes, user_attributes, with_category
from txrisk.operators.errors import dominant_errors
from txrisk.operators.facts import totals
from txrisk.operators.indicators import card_days, week_start, weekly_tx
from txrisk.operators.sequences import consecutive_errors, gaps, minutes_since_last
from txrisk.params import DARK_WEB_YES, DecisionRules, Floors

# Join keys of the rows without a time or a category code.
NO_TIME = -(1 << 62)
NO_CODE = -1


def no_day():
    return F.lit("0001-01-01").cast("date")


def client_means(facts: DataFrame) -> DataFrame:
    """What a client usually spends, in cents, and from how many transactions."""
    return (
        facts.filter(F.col("client_id").isNotNull())
        .groupBy("client_id")
        .agg(*totals("n_tx", "n_amount", "net_cents"))
        .select(
            "client_id",
            F.col("n_tx").alias("client_n_tx"),
            (F.col("net_cents") / F.nullif(F.col("n_amount"), F.lit(0).cast("bigint"))).alias("usual_cents"),
        )
    )


def _deviation():
    return F.abs(C.cents(F.col("amount_clean")) - F.col("usual_cents")) / F.lit(100.0)


def amount_deviation(facts: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Distance of every amount from the client's mean; transactions without a client have none."""
    rows = facts.filter(F.col("client_id").isNotNull()).select("id", "client_id", "amount_clean")
    return attach(rows, client_means(facts), ["client_id"], "client_n_tx", hot_rows=hot_rows).select(
        "id", "client_id", _deviation().alias("amount_deviation")
    )


def credit_limit_ratio(facts: DataFrame, cards: DataFrame) -> DataFrame:
    """Amount as a share of the card's credit limit."""
    limits = card_attributes(cards).select("card_id", "credit_limit_clean")
    return (
        facts.select("id", "card_id", "amount_clean")
        .join(limits, "card_id", "left")
        .select("id", "card_id", _limit_share().alias("amount_to_limit"))
    )


def _limit_share():
    limit = F.col("credit_limit_clean").cast("double")
    return F.col("amount_clean").cast("double") / F.when(limit != 0, limit)


def card_features(
    facts: DataFrame, daily: DataFrame, moments: DataFrame, cards: DataFrame, as_of: str
) -> DataFrame:
    """One row per card in use: error ratio, runs, dominant error, online share, ages and dark-web flag."""
    totals_per_card = daily.groupBy("card_id").agg(*totals("n_tx", "n_errors", "n_online"))
    about = card_attributes(cards).select(
        "card_id", C.flag(F.col("card_on_dark_web") == DARK_WEB_YES).alias("card_on_dark_web"), "credit_limit_clean"
    )
    return (
        totals_per_card.select(
            "card_id",
            percent(F.col("n_errors"), F.col("n_tx")).alias("card_error_ratio"),
            percent(F.col("n_online"), F.col("n_tx")).alias("online_pct"),
        )
        .join(dominant_errors(facts).select("card_id", "dominant_error"), "card_id", "left")
        .join(consecutive_errors(moments), "card_id", "left")
        .join(about, "card_id", "left")
        .join(card_ages(cards, as_of), "card_id", "left")
    )


def card_day_features(daily: DataFrame, per_card: DataFrame) -> DataFrame:
    """Per card and day: transactions, physical cities, spend, transactions of the week, and the card's
    own features. Undated transactions count as a day of their own, without daily figures."""
    per_day = card_days(daily).withColumn("week_start", week_start())
    per_week = weekly_tx(per_day).withColumnRenamed("n_tx", "tx_per_week")
    dated = F.col("tx_date").isNotNull()
    return (
        per_day.join(per_week, ["card_id", "week_start"], "left")
        .select(
            "card_id",
            F.coalesce("tx_date", no_day()).alias("day"),
            F.when(dated, F.col("n_tx")).alias("tx_per_day"),
            F.when(dated, F.col("n_cities_physical")).alias("cities_per_day"),
            F.when(dated, amount(F.col("pos_cents"))).alias("spend_per_day"),
            "tx_per_week",
        )
        .join(per_card, "card_id", "left")
    )


def _timed(moments: DataFrame) -> DataFrame:
    return moments.withColumns(
        {"second": F.coalesce("second", F.lit(NO_TIME)), "day": F.coalesce(F.to_date("tx_ts"), no_day())}
    )


def _by_moment(moments: DataFrame, per_day: DataFrame) -> DataFrame:
    """Everything known about a card at one of its seconds."""
    look_back = F.when(F.col("tx_ts").isNotNull(), F.col("first_id")).alias("first_id")
    return (
        _timed(gaps(moments))
        .select("card_id", "second", "day", F.col("n_tx").alias("moment_n_tx"), look_back, "gap_seconds")
        .join(per_day, ["card_id", "day"], "left")
        .drop("day")
    )


def _by_code(per_code: DataFrame, codes: DataFrame, rules: DecisionRules, floors: Floors) -> DataFrame:
    risks = category_risk(per_code, codes, rules, floors).select(
        "merchant_category",
        F.col("mean_amount").alias("category_mean_amount"),
        C.flag(F.col("is_high_value")).alias("is_high_value_category"),
    )
    sized = per_code.select(
        "mcc", F.coalesce("mcc", F.lit(NO_CODE)).alias("code"), F.col("n_tx").alias("code_n_tx")
    )
    return with_category(sized, codes).join(risks, "merchant_category", "left").select(
        "code", "code_n_tx", "category_mean_amount", "is_high_value_category"
    )


def feature_groups(
    facts: DataFrame,
    daily: DataFrame,
    moments: DataFrame,
    per_code: DataFrame,
    codes: DataFrame,
    cards: DataFrame,
    users: DataFrame,
    as_of: str,
    rules: DecisionRules = DecisionRules(),
    floors: Floors = Floors(),
) -> dict[str, DataFrame]:
    """The features of a card at a moment, of a client, of a merchant and of a category code.

    The coarse ones are joined to the finer ones first: card features meet one row per card and day, and
    those one row per card and second. ``per_code`` has the measures by ``mcc``.
    """
    per_card = card_features(facts, daily, moments, cards, as_of)
    scores = user_attributes(users).select("client_id", "credit_score")
    return {
        "moment": _by_moment(moments, card_day_features(daily, per_card)),
        "client": client_means(daily).join(scores, "client_id", "left"),
        "merchant": merchants(facts).select(
            "merchant_id",
            F.col("n_tx").alias("merchant_n_tx"),
            F.col("n_tx").alias("merchant_volume"),
            F.col("error_rate").alias("merchant_error_rate"),
        ),
        "code": _by_code(per_code, codes, rules, floors),
    }


GROUP_KEYS = {
    "moment": (["card_id", "second"], "moment_n_tx"),
    "client": (["client_id"], "client_n_tx"),
    "merchant": (["merchant_id"], "merchant_n_tx"),
    "code": (["code"], "code_n_tx"),
}


def transaction_features(facts: DataFrame, groups: dict[str, DataFrame], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every transaction with all features, given the :func:`feature_groups`.

    Hand in the groups as written tables: then the transactions are read once, joined four times, and the
    search for groups with very many rows is a filter that the Parquet statistics answer.
    """
    rows = facts.select(
        "id",
        "client_id",
        "card_id",
        "merchant_id",
        F.coalesce("mcc", F.lit(NO_CODE)).alias("code"),
        F.coalesce(C.epoch_seconds(F.col("tx_ts")), F.lit(NO_TIME)).alias("second"),
        "amount_clean",
        F.col("n_night").alias("is_night"),
        C.flag(C.is_weekend(F.col("tx_dow"))).alias("is_weekend"),
        F.col("n_online").alias("is_online"),
    )
    for name, (keys, size) in GROUP_KEYS.items():
        rows = attach(rows, groups[name], keys, size, hot_rows=hot_rows)
    return rows.select(
        "id",
        "client_id",
        "card_id",
        "merchant_id",
        F.col("amount_clean").cast("double").alias("amount"),
        "is_night",
        "is_weekend",
        "is_online",
        "tx_per_day",
        "tx_per_week",
        "cities_per_day",
        "spend_per_day",
        "online_pct",
        _deviation().alias("amount_deviation"),
        _limit_share().alias("amount_to_limit"),
        minutes_since_last().alias("minutes_since_last"),
        "card_error_ratio",
        "longest_run",
        "current_run",
        "dominant_error",
        "card_on_dark_web",
        "credit_score",
        "card_age_days",
        "pin_age_years",
        "category_mean_amount",
        "is_high_value_category",
        "merchant_volume",
        "merchant_error_rate",
    )
