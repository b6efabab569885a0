from __future__ import annotations

import datetime
import random
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from txrisk.functions import cleaning as C
from txrisk.functions.bands import band_label, band_order
from txrisk.functions.rounding import amount, mean_amount, percent, ratio
from txrisk.params import AMOUNT_BANDS, CREDIT_BANDS, SCORE_BANDS


def values(df, expression):
    return [r[0] for r in df.select(expression).collect()]


def test_money_is_parsed_or_null(build):
    texts = build.column("string", "$123.45", "$-77.00", "$1,200.00", "abc", "", None, "-$5", "$0.005", "12")
    expected = ["123.45", "-77.00", "1200.00", None, None, None, "-5.00", "0.01", "12.00"]
    assert values(texts, C.money(F.col("v"))) == [None if e is None else Decimal(e) for e in expected]


def test_event_time_takes_one_format_only(build):
    texts = build.column(
        "string", "2024-01-15 10:30:00", "2024-01-15", "2024-02-30 10:00:00", "2024-01-15T10:30:00", "x", "", None
    )
    assert values(texts, C.event_time(F.col("v"))) == [datetime.datetime(2024, 1, 15, 10, 30)] + [None] * 6


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kathmandu"])
def test_times_do_not_depend_on_the_session_zone(spark, build, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 02:30 does not exist on this day in New York.
        ts = C.event_time(F.col("v"))
        [row] = build.column("string", "2024-03-10 02:30:15").select(
            F.hour(ts), F.to_date(ts), C.epoch_seconds(ts)
        ).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(row) == (2, datetime.date(2024, 3, 10), 1710037815)


def test_same_day_truncation(build):
    texts = build.column("string", "2024-01-15 10:30:00", "2024-01-15 18:45:00")
    assert set(values(texts, F.to_date(C.event_time(F.col("v"))))) == {datetime.date(2024, 1, 15)}


def test_missing_values(build):
    assert values(build.column("string", None, "", " ", "x"), C.is_missing(F.col("v"))) == [True, True, False, False]
    assert values(build.column("int", None, 0), C.is_missing(F.col("v"))) == [True, False]
    assert values(build.column("timestamp", None), C.is_missing(F.col("v"))) == [True]


def test_errors_and_cities(build):
    texts = build.column("string", None, "", "Bad PIN", "ONLINE")
    assert values(texts, C.has_error(F.col("v"))) == [False, False, True, True]
    assert values(texts, C.is_online(F.col("v"))) == [False, False, False, True]
    assert values(texts, C.is_physical(F.col("v"))) == [False, True, True, False]


def test_night_is_from_midnight_to_six(build):
    times = build.column("string", "2024-01-15 00:00:00", "2024-01-15 05:59:59", "2024-01-15 06:00:00", "?")
    assert values(times, C.is_night(F.hour(C.event_time(F.col("v"))))) == [True, True, False, False]


def test_weekend(build):
    days = build.column("string", "2024-01-14 12:00:00", "2024-01-15 12:00:00", "2024-01-20 12:00:00", "?")
    dow = F.dayofweek(C.event_time(F.col("v")))
    assert values(days, dow) == [1, 2, 7, None]
    assert values(days, C.is_weekend(dow)) == [True, False, True, False]


def test_opening_month(build):
    texts = build.column("string", "09/2002", "13/2002", "2002", None)
    assert values(texts, C.month_start(F.col("v"))) == [datetime.date(2002, 9, 1), None, None, None]


def test_bands_are_half_open(build):
    amounts = build.column("double", 9.99, 10.0, 49.99, 50.0, 199.99, 200.0, None)
    assert values(amounts, band_order(F.col("v"), AMOUNT_BANDS)) == [1, 2, 2, 3, 3, 4, None]
    scores = build.column("int", 599, 600, 699, 700, 799, 800, None)
    assert values(scores, band_order(F.col("v"), CREDIT_BANDS)) == [1, 2, 2, 3, 3, 4, None]
    risks = build.column("int", 9, 10, 29, 30, 49, 50)
    labels = SCORE_BANDS.labels
    assert values(risks, band_label(F.col("v"), SCORE_BANDS)) == [labels[i] for i in (0, 1, 1, 2, 2, 3)]


def test_ratios_round_half_up_exactly(spark):
    rng = random.Random(7)
    pairs = [(rng.randint(-(10**12), 10**12), rng.randint(0, 10**6)) for _ in range(500)]
    pairs += [(1, 8), (-1, 8), (5, 1000), (-5, 1000), (1, 3), (0, 5), (7, 0)]
    frame = spark.createDataFrame(pairs, "num bigint, den bigint")

    def expected(num, den):
        if den == 0:
            return None
        q = Fraction(num, den)
        digits = (Decimal(q.numerator) / Decimal(q.denominator)).quantize(Decimal("0.01"), ROUND_HALF_UP)
        return float(digits)

    found = values(frame, ratio(F.col("num"), F.col("den")))
    assert found == [expected(*pair) for pair in pairs]


def test_percent_and_amounts(spark):
    frame = spark.createDataFrame([(1, 3, 12345), (0, 0, 0)], "a bigint, b bigint, c bigint")
    columns = [percent(F.col("a"), F.col("b")), mean_amount(F.col("c"), F.col("b")), amount(F.col("c"), F.col("b"))]
    assert [tuple(r) for r in frame.select(*columns).collect()] == [(33.33, 41.15, 123.45), (None, None, None)]
