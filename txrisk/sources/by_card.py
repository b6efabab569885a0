"""Transactions stored by card: a bucketed and sorted table whose rows need no exchange to be summed or joined by card.

A bucket is read by one task, so a busy card must not be one bucket. Rows are stored under ``card_id`` and ``slot``: a card has
``1 + rows div hot_rows`` slots, and a row's slot is a hash of its second. Rows of one card and second therefore stand
together, and what is summed by card and second, such as moments, is whole within a bucket. Rows without a card or without a second
are dealt by a hash of the whole row, as they belong to no second; what is summed from them is put together afterwards.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.operators.attach import HOT_ROWS
from txrisk.sources.workspace import stage

#: Rows that a bucket is meant to hold, and the most buckets that Spark allows by default.
BUCKET_ROWS = 5_000_000
MOST_BUCKETS = 100_000
KEYS = ("card_id", "slot")
ORDER = ("card_id", "tx_ts")


@dataclass(frozen=True)
class ByCard:
    """The stored ``rows``, which have a column ``slot``, and the ``busy`` cards with their number of ``slots``."""

    rows: DataFrame
    busy: DataFrame

    def per_slot(self, dimension: DataFrame) -> DataFrame:
        """``dimension``, one row per card, repeated for every slot of the card.

        ``busy`` is broadcast: it has at most ``rows / hot_rows`` rows.
        """
        numbers = F.sequence(F.lit(0), F.coalesce("slots", F.lit(1)) - 1)
        return dimension.join(F.broadcast(self.busy), "card_id", "left").withColumn("slot", F.explode(numbers)).drop("slots")


def busy_cards(tx: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``card_id, slots`` of the cards that need several slots, and of the rows without a card if these do."""
    slots = F.floor(F.col("n") / hot_rows).cast("int") + 1
    return tx.groupBy("card_id").agg(F.count("*").alias("n")).filter(F.col("n") >= hot_rows).select("card_id", slots.alias("slots"))


def _register(spark: SparkSession, table: str, path: str) -> ByCard:
    return ByCard(spark.table(table), spark.read.parquet(f"{path}/busy"))


def write_by_card(tx: DataFrame, table: str, path: str, buckets: int | None = None, hot_rows: int = HOT_ROWS) -> ByCard:
    """Store ``tx`` (see :func:`txrisk.operators.facts.clean`) as ``table`` under ``path``, replacing what is there.

    Every bucket is one file, sorted by card and second, so that a reader of some cards skips most row groups. ``buckets`` is
    chosen from the number of rows if it is not given. The rows are shuffled once, here, and not again by what reads them by
    card. An empty ``tx`` makes an empty table; a column ``slot``, ``slots`` or ``busy_card`` is an error.
    """
    taken = {"slot", "slots", "busy_card"} & {name.lower() for name in tx.columns}
    if taken:
        raise ValueError(f"the rows have a column {min(taken)}")
    spark = tx.sparkSession
    busy = stage(busy_cards(tx, hot_rows), "busy-cards")
    if buckets is None:
        buckets = min(MOST_BUCKETS, 1 + tx.count() // BUCKET_ROWS)
    known = F.broadcast(busy.withColumnRenamed("card_id", "busy_card"))
    in_sequence = F.col("card_id").isNotNull() & F.col("tx_ts").isNotNull()
    dealt_by = F.when(in_sequence, F.xxhash64("tx_ts")).otherwise(F.xxhash64(*tx.columns))
    slot = F.pmod(dealt_by, F.coalesce("slots", F.lit(1))).cast("int")
    placed = tx.join(known, F.col("card_id").eqNullSafe(F.col("busy_card")), "left").select(*tx.columns, slot.alias("slot"))
    stored = placed.repartition(buckets, *KEYS).write.mode("overwrite").option("path", f"{path}/rows")
    stored.bucketBy(buckets, *KEYS).sortBy(*ORDER).saveAsTable(table)
    busy.write.mode("overwrite").parquet(f"{path}/busy")
    spark.range(1).select(F.lit(buckets).alias("buckets")).write.mode("overwrite").parquet(f"{path}/layout")
    return _register(spark, table, path)


def open_by_card(spark: SparkSession, table: str, path: str) -> ByCard:
    """What :func:`write_by_card` stored under ``path``, made known as ``table`` to a session whose catalog does not have it."""
    buckets = spark.read.parquet(f"{path}/layout").first()["buckets"]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(f"{path}/rows").schema)
    clustered = f"CLUSTERED BY ({', '.join(KEYS)}) SORTED BY ({', '.join(ORDER)}) INTO {buckets} BUCKETS"
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {clustered} LOCATION '{path}/rows'")
    return _register(spark, table, path)
