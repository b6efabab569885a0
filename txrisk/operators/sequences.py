"""What a card does in the order of time.

The rows are first reduced to *moments*: one row per card and second, summed before the shuffle. Windows over
moments are cut by card and day, so that one holds at most 86,400 of them (twice that in :func:`trailing`)
however busy the card is. What is carried into a day comes from one small row per card and day, over which a
second window runs, and is joined back by card and day. Transactions of the same second are taken as: successes
first, then errors. Rows without a card belong to no sequence. The undated rows of a card share one moment
without a time, which only :func:`gaps` keeps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from txrisk.functions import cleaning as C
from txrisk.operators.attach import HOT_ROWS, attach
from txrisk.operators.facts import totals
from txrisk.params import BAD_PIN, BurstRules

DAY_SECONDS = 86400


def moments(facts: DataFrame, *also: str) -> DataFrame:
    """Per card and second: transactions, errors, wrong PINs and the lowest transaction id (NULL without a
    column ``id``, which only the reports on single transactions need). ``also`` names columns that depend on card and
    second alone and by which the rows are stored."""
    first_id = F.min("id") if "id" in facts.columns else F.lit(None).cast("bigint")
    wrong_pin = F.coalesce(F.col("errors").contains(BAD_PIN), F.lit(False))
    return (
        facts.filter(F.col("card_id").isNotNull())
        .groupBy("card_id", "tx_ts", *also)
        .agg(
            *totals("n_tx", "n_errors"),
            F.sum(C.flag(wrong_pin)).alias("n_pin"),
            first_id.alias("first_id"),
        )
        .withColumn("second", C.epoch_seconds(F.col("tx_ts")))
    )


def _dated(moments: DataFrame) -> DataFrame:
    return moments.filter(F.col("second").isNotNull())


def _day(second: str) -> Column:
    return F.floor(F.col(second) / DAY_SECONDS)


def _in_day(*order: str) -> WindowSpec:
    return Window.partitionBy("card_id", "day").orderBy(*order)


def _over_days() -> WindowSpec:
    """The days of a card: one row each."""
    return Window.partitionBy("card_id").orderBy("day")


def gaps(moments: DataFrame) -> DataFrame:
    """Seconds since the card's previous moment; NULL for its first one and for undated rows."""
    by_day = moments.withColumn("day", _day("second"))
    last = by_day.filter(F.col("day").isNotNull()).groupBy("card_id", "day").agg(F.max("second").alias("last"))
    carried = last.select("card_id", "day", F.lag("last").over(_over_days()).alias("day_before"))
    return (
        by_day.withColumn("before", F.lag("second").over(_in_day("second")))
        .join(carried, ["card_id", "day"], "left")
        .select(*moments.columns, (F.col("second") - F.coalesce("before", "day_before")).alias("gap_seconds"))
    )


def minutes_since_last() -> Column:
    """Only the first transaction of a second looks back; the others follow one of the same second."""
    return F.when(F.col("id") == F.col("first_id"), F.col("gap_seconds") / F.lit(60)).when(
        F.col("first_id").isNotNull(), F.lit(0.0)
    )


def time_since_last(facts: DataFrame, moments: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Minutes since the card's previous transaction, for every transaction."""
    per_moment = gaps(moments).select("card_id", "tx_ts", "n_tx", "first_id", "gap_seconds")
    rows = facts.select("id", "card_id", "tx_ts")
    return attach(rows, per_moment, ("card_id", "tx_ts"), "n_tx", sizes=moments, hot_rows=hot_rows).select(
        "id", "card_id", "tx_ts", minutes_since_last().alias("minutes_since_last")
    )


def _running(rows: DataFrame, measure: str, name: str, *order: str) -> DataFrame:
    """``rows`` with ``name``, the card's total of ``measure`` so far in the given order, which begins with a second.

    Each row costs one addition: the total within its day is added to that of the days before.
    """
    by_day = rows.withColumn("day", _day(order[0]))
    so_far = _in_day(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = _over_days().rowsBetween(Window.unboundedPreceding, -1)
    days = by_day.groupBy("card_id", "day").agg(F.sum(measure).alias("of_day"))
    carried = days.select("card_id", "day", F.coalesce(F.sum("of_day").over(earlier), F.lit(0)).alias("carried"))
    return (
        by_day.withColumn("within", F.sum(measure).over(so_far))
        .join(carried, ["card_id", "day"])
        .select(*rows.columns, (F.col("within") + F.col("carried")).alias(name))
    )


def _event(at: Column, kind: int, change: Column) -> Column:
    return F.struct(at.alias("at"), F.lit(kind).alias("kind"), change.cast("bigint").alias("change"))


def trailing(moments: DataFrame, measure: str, seconds: int, at_least: int) -> DataFrame:
    """Moments at which the last ``seconds`` (both ends included) hold enough of ``measure``.

    A window frame of that many seconds would be added up anew for every row. Instead, every moment is
    added when it comes and taken off again when its time is over, after the moments of that second and on the
    day on which it falls, so that the running total is what is in the window.
    """
    here, second = F.col(measure), F.col("second")
    events = F.array(_event(second, 0, here), _event(second + seconds, 1, -here))
    changes = _dated(moments).filter(here > 0).select("card_id", "tx_ts", F.inline(events))
    return (
        _running(changes, "change", "n_recent", "at", "kind")
        .filter((F.col("kind") == 0) & (F.col("n_recent") >= at_least))
        .select("card_id", "tx_ts", "n_recent")
    )


def velocity_bursts(moments: DataFrame, rules: BurstRules = BurstRules()) -> DataFrame:
    return trailing(moments, "n_tx", rules.velocity_seconds, rules.velocity_tx)


def pin_bursts(moments: DataFrame, rules: BurstRules = BurstRules()) -> DataFrame:
    return trailing(moments, "n_pin", rules.pin_seconds, rules.pin_errors)


def dormant_reactivations(moments: DataFrame, rules: BurstRules = BurstRules()) -> DataFrame:
    """Moments that end a long silence of the card and begin enough transactions.

    What follows a moment is the total at the end of its time less the total before it. Both are read off one
    running total, at the moment's own event and at one that ends its time; few moments have the latter.
    """
    second = F.col("second")
    woken = F.col("gap_seconds") > rules.dormant_days * DAY_SECONDS
    look_ahead = F.when(woken, _event(second + rules.wake_seconds, 1, F.lit(0)))
    events = F.array_compact(F.array(_event(second, 0, F.col("n_tx")), look_ahead))
    changes = gaps(_dated(moments)).select("card_id", "tx_ts", "gap_seconds", woken.alias("woken"), F.inline(events))
    at_end = F.max(F.when(F.col("kind") == 1, F.col("total")))
    before = F.max(F.when(F.col("kind") == 0, F.col("total") - F.col("change")))
    return (
        _running(changes, "change", "total", "at", "kind")
        .filter("woken")
        .groupBy("card_id", "tx_ts")
        .agg((F.max("gap_seconds") / F.lit(DAY_SECONDS)).alias("gap_days"), (at_end - before).alias("n_after"))
        .filter(F.col("n_after") >= rules.wake_tx)
    )


def _runs(moments: DataFrame) -> DataFrame:
    """Stretches of a card between two successes; a stretch without errors has length 0.

    The number of moments with a success so far names the stretch. A stretch may last many days, so its moments
    are summed per day before they are brought together.
    """
    failed = F.col("n_errors") > 0
    marked = _dated(moments).withColumn("success", C.flag(F.col("n_tx") > F.col("n_errors")))
    return (
        _running(marked, "success", "run", "second")
        .groupBy("card_id", "run")
        .agg(
            F.sum("n_errors").alias("n_errors"),
            F.sum("n_pin").alias("n_pin"),
            F.min(F.when(failed, F.col("tx_ts"))).alias("started"),
            F.max(F.when(failed, F.col("tx_ts"))).alias("ended"),
        )
    )


def error_streaks(moments: DataFrame, at_least: int = 1) -> DataFrame:
    """Maximal runs of consecutive failed transactions of a card."""
    return (
        _runs(moments)
        .filter(F.col("n_errors") >= at_least)
        .select("card_id", "started", "ended", "n_errors")
    )


def consecutive_errors(moments: DataFrame) -> DataFrame:
    """The longest run of errors of every card, and the run it is in now."""
    return (
        _runs(moments)
        .groupBy("card_id")
        .agg(
            F.max("n_errors").alias("longest_run"),
            F.max_by("n_errors", "run").alias("current_run"),
        )
    )


def pin_lockouts(moments: DataFrame, rules: BurstRules = BurstRules()) -> DataFrame:
    """Runs with enough wrong PINs since the card's last successful transaction."""
    return (
        _runs(moments)
        .filter(F.col("n_pin") >= rules.pin_lockout)
        .select("card_id", "started", "ended", "n_pin")
    )
