"""Distinct cities over any span of days, from one bitmap of numbered cities per card and day.

Distinct counts do not add up; bitmaps do: those of a week, a month or a card's life are the ``OR`` of its days'. So longer spans
read the daily bitmaps and never the rows, and one grouping gives the cities beside the other measures. Of a bitmap only the words of
64 cities are held in which a card has any. A word is a number, summed by hashing as all other measures; whole bitmaps of 4 KB had
to be sorted, and were most of a task's memory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txrisk.functions.rounding import amount
from txrisk.operators.facts import totals
from txrisk.operators.indicators import DAILY_MEASURES, week_start
from txrisk.sources.workspace import stage

#: Cities in a word of a bitmap: the bits of a BIGINT.
WORD = 64


def numbered_cities(facts: DataFrame) -> DataFrame:
    """``merchant_city, city_no``: the distinct cities, numbered from 1 without a gap.

    Each partition numbers its own; the numbers of those before are added, from one row for each partition. The table is written, so
    that the numbers stay what they are.
    """
    cities = facts.select("merchant_city").filter("merchant_city IS NOT NULL").distinct()
    held = stage(cities.withColumn("place", F.monotonically_increasing_id()), "cities")
    placed = held.select("merchant_city", F.shiftright("place", 33).alias("part"), F.col("place").bitwiseAND((1 << 33) - 1).alias("row"))
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("earlier"))
    return placed.join(parts, "part").select("merchant_city", (F.col("row") + F.col("earlier") + 1).alias("city_no"))


def city_days(daily: DataFrame, cities: DataFrame) -> DataFrame:
    """``card_id, tx_date, bucket, word, cities`` and the measures, from facts or :func:`txrisk.operators.indicators.daily`.

    A bitmap covers 32,768 cities, a bucket, and is held as its words: ``cities`` has the bits of 64 cities. There is a row for each word
    of which a card visits a city in a day, so never more than one for each city. Measures are those of the word's cities, and rows
    without a city are in a bucket NULL, so all measures still add up.
    """
    numbered = daily.join(cities, "merchant_city", "left")
    place = F.bitmap_bit_position("city_no")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (place % WORD).cast("int"))
    words = [F.bitmap_bucket_number("city_no").alias("bucket"), F.floor(place / WORD).cast("int").alias("word")]
    return numbered.groupBy("card_id", "tx_date", *words).agg(*totals(*DAILY_MEASURES), F.bit_or(bit).alias("cities"))


def spans(days: DataFrame, *span: str | Column) -> DataFrame:
    """Per card and ``span`` (columns or expressions of ``tx_date``; none for its whole life): the measures, ``n_days``,
    and the distinct cities, of which ``n_cities_physical`` leaves out ``ONLINE``.

    Days come from one row per card, span and day, cities from one per card, span and word; both are small and meet by card and span.
    """
    names = ["card_id", *(f"span_{i}" for i in range(len(span)))]
    dated = days.select("*", *[(F.col(s) if isinstance(s, str) else s).alias(n) for s, n in zip(span, names[1:])])
    per_days = dated.groupBy(*names, "tx_date").agg(*totals(*DAILY_MEASURES))
    per_days = per_days.groupBy(*names).agg(*totals(*DAILY_MEASURES), F.count("tx_date").alias("n_days"))
    per_cities = dated.filter("bucket IS NOT NULL").groupBy(*names, "bucket", "word").agg(F.bit_or("cities").alias("cities"))
    per_cities = per_cities.groupBy(*names).agg(F.sum(F.bit_count("cities")).alias("n_cities_all"))
    same = [per_days[n].eqNullSafe(per_cities[n]) for n in names]
    joined = per_days.join(per_cities, same, "left").select(per_days["*"], F.coalesce("n_cities_all", F.lit(0)).alias("n_cities_all"))
    online = (F.col("n_online") > 0).cast("long")
    return joined.withColumn("n_cities_physical", F.col("n_cities_all") - online)


def card_lifetime(days: DataFrame) -> DataFrame:
    """As :func:`txrisk.operators.indicators.card_lifetime`."""
    net = amount(F.col("net_cents"), F.col("n_amount")).alias("amount_net")
    return spans(days).select("card_id", "n_tx", net, F.col("n_cities_all").alias("n_cities"), "n_days")


def weekly_cities(days: DataFrame) -> DataFrame:
    """Distinct cities of a card in every week, which begins on a Monday; undated rows are in a week NULL."""
    return spans(days, week_start()).select("card_id", F.col("span_0").alias("week_start"), "n_cities_all", "n_cities_physical")
