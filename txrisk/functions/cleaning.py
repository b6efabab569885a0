"""Turning the raw text columns into typed ones. Bad text becomes NULL, also under ANSI SQL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txrisk.params import ONLINE_CITY, TIME_PATTERN


def money(text: Column) -> Column:
    """``$1,200.00`` -> 1200.00. A decimal of 12 digits is a long inside Spark."""
    return F.translate(text, "$,", "").try_cast("decimal(12,2)")


def cents(amount: Column) -> Column:
    return (amount * 100).cast("bigint")


def event_time(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` -> TIMESTAMP_NTZ, whatever the session time zone."""
    return F.when(text.rlike(TIME_PATTERN), text.try_cast("timestamp_ntz"))


def month_start(text: Column) -> Column:
    """``MM/yyyy`` -> the first day of that month."""
    return F.when(
        text.rlike(r"^\d{2}/\d{4}$"),
        F.concat(F.substring(text, 4, 4), F.lit("-"), F.substring(text, 1, 2), F.lit("-01")).try_cast("date"),
    )


def epoch_seconds(ts: Column) -> Column:
    """Seconds since 1970 of a zone-less timestamp, computed without a time zone."""
    return (
        F.unix_date(F.to_date(ts)).cast("bigint") * 86400
        + F.hour(ts) * 3600
        + F.minute(ts) * 60
        + F.second(ts)
    )


def instant(ts: Column) -> Column:
    """A zone-less time as the TIMESTAMP that watermarks need, counted as if it were UTC."""
    return F.timestamp_seconds(epoch_seconds(ts))


def wall_clock(moment: Column) -> Column:
    """The zone-less time of an :func:`instant`."""
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.unix_seconds(moment))


def is_missing(column: Column) -> Column:
    """NULL or empty text; the cast makes the comparison legal for every type."""
    return column.isNull() | (column.cast("string") == "")


def has_error(errors: Column) -> Column:
    return F.coalesce(errors != "", F.lit(False))


def is_online(city: Column) -> Column:
    return F.coalesce(city == ONLINE_CITY, F.lit(False))


def is_physical(city: Column) -> Column:
    return F.coalesce(city != ONLINE_CITY, F.lit(False))


def is_night(hour: Column) -> Column:
    return F.coalesce(hour.between(0, 5), F.lit(False))


def is_weekend(dow: Column) -> Column:
    """Sunday is 1 and Saturday is 7."""
    return F.coalesce(dow.isin(1, 7), F.lit(False))


def flag(condition: Column) -> Column:
    return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("bigint")
