"""Streaming versions of the card indicators.

A window is reported once the watermark has passed its end, so the output is append-only and can go to
files or a queue. Transactions later than the delay are dropped by the watermark; transactions without a
time belong to no window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.functions import cleaning as C
from txrisk.functions.rounding import amount
from txrisk.operators.enrich import card_attributes, user_attributes, with_category
from txrisk.operators.facts import clean, facts, totals
from txrisk.operators.indicators import DAILY_MEASURES
from txrisk.operators.score import risk_scores
from txrisk.params import BAD_PIN, BurstRules
from txrisk.sources.workspace import new_folder

DELAY = "1 hour"


def timed(raw: DataFrame, delay: str = DELAY) -> DataFrame:
    """Facts of a raw stream with a watermark on ``event_time``."""
    rows = facts(clean(raw)).withColumn("event_time", C.instant(F.col("tx_ts")))
    return rows.withWatermark("event_time", delay)


def _window_start():
    return C.wall_clock(F.col("window.start"))


def card_days(stream: DataFrame) -> DataFrame:
    """The card-day indicators of finished days.

    Two aggregations follow each other, as in the batch version: per card, day and city, then per card and
    day. The state holds numbers only and no set of cities.
    """
    per_city = stream.groupBy(F.window("event_time", "1 day"), "card_id", "merchant_city").agg(*totals(*DAILY_MEASURES))
    city = F.col("merchant_city")
    return (
        per_city.groupBy("window", "card_id")
        .agg(
            *totals(*DAILY_MEASURES),
            F.count(city).alias("n_cities_all"),
            F.count_if(C.is_physical(city)).alias("n_cities_physical"),
        )
        .withColumn("tx_date", F.to_date(_window_start()))
        .drop("window")
    )


def card_day_scores(stream: DataFrame) -> DataFrame:
    return risk_scores(card_days(stream))


def _sliding(stream: DataFrame, measure, seconds: int, slide_seconds: int, at_least: int) -> DataFrame:
    """Only rows that measure something are put into windows. The filter looks at the time too: otherwise
    Spark would apply it below the watermark, and the other rows would no longer move the clock."""
    measure = measure * C.flag(F.col("event_time").isNotNull())
    window = F.window("event_time", f"{seconds} seconds", f"{slide_seconds} seconds")
    return (
        stream.withColumn("measured", measure)
        .filter(F.col("measured") > 0)
        .groupBy(window, "card_id")
        .agg(F.sum("measured").alias("n_window"))
        .filter(F.col("n_window") >= at_least)
        .select("card_id", _window_start().alias("window_start"), "n_window")
    )


def velocity_alerts(stream: DataFrame, rules: BurstRules = BurstRules(), slide_seconds: int = 60) -> DataFrame:
    """Cards with many transactions in a short window."""
    return _sliding(stream, F.col("n_tx"), rules.velocity_seconds, slide_seconds, rules.velocity_tx)


def pin_alerts(stream: DataFrame, rules: BurstRules = BurstRules(), slide_seconds: int = 600) -> DataFrame:
    """Cards with several wrong PINs in a window."""
    wrong = C.flag(F.coalesce(F.col("errors").contains(BAD_PIN), F.lit(False)))
    return _sliding(stream, wrong, rules.pin_seconds, slide_seconds, rules.pin_errors)


def enriched(stream: DataFrame, codes: DataFrame, cards: DataFrame, users: DataFrame) -> DataFrame:
    """Stream-static left joins; the static tables are read again for every batch."""
    return (
        with_category(stream, codes)
        .join(card_attributes(cards), "card_id", "left")
        .join(user_attributes(users), "client_id", "left")
    )


def sessions(stream: DataFrame, gap: str = "6 hours") -> DataFrame:
    """Spells of activity of a card, ended by a silence longer than ``gap``.

    Set ``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition`` to true in the session, so
    that sessions are merged within each task before the shuffle and a busy card sends few rows. The amount of a
    session without a valid amount is NULL.
    """
    return (
        stream.groupBy(F.session_window("event_time", gap).alias("spell"), "card_id")
        .agg(F.sum("n_tx").alias("n_tx"), F.sum("n_amount").alias("n_amount"), F.sum("net_cents").alias("net_cents"))
        .select(
            "card_id",
            C.wall_clock(F.col("spell.start")).alias("session_start"),
            C.wall_clock(F.col("spell.end")).alias("session_end"),
            "n_tx",
            F.when(F.col("n_amount") > 0, amount(F.col("net_cents"))).alias("amount_net"),
        )
    )


def drain(stream: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Process everything the source holds now and return the table of all results so far.

    Results and checkpoint are in ``folder``: the same stream drained again into the same folder goes on where it
    stopped. Without one, a new folder is made in the shared folder and everything is processed.
    """
    folder = folder or new_folder(stream.sparkSession, name)
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{folder}/table")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/table")
