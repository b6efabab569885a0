"""Exact bursts on a stream: at every moment, what a card did in the seconds before it.

Windows on a grid miss a burst that straddles the grid. Here rows are first summed per card and second, which partial sums
do before the shuffle; a second is passed on when the watermark has passed it, so a card's seconds come in order. Of each card the
state holds the seconds that the window still covers, and a timer drops them once they are of no more use.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from txrisk.functions import cleaning as C
from txrisk.params import BAD_PIN, BurstRules

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def arbitrary_state(spark: SparkSession) -> Iterator[None]:
    """Spark keeps state with timers in RocksDB only. Queries that start within use it; the session is left as it was."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def moments(stream: DataFrame, measure: Column) -> DataFrame:
    """``card_id, event_time, second, n``: the measure summed per card and second, for seconds that have any. Rows without a card
    belong to none. What is left out still moves the clock, as in :func:`txrisk.streaming.cards.velocity_alerts`."""
    counted = measure * C.flag(F.col("event_time").isNotNull() & F.col("card_id").isNotNull())
    return (
        stream.withColumn("measured", counted)
        .filter(F.col("measured") > 0)
        .groupBy(F.window("event_time", "1 second"), "card_id")
        .agg(F.sum("measured").alias("n"))
        .select("card_id", F.window_time("window").alias("event_time"), F.col("window.start").cast("long").alias("second"), "n")
    )


class Trailing(StatefulProcessor):
    """A card's last ``seconds`` seconds. Reports every second at which these, both ends included, sum up to ``at_least``."""

    def __init__(self, seconds: int, at_least: int) -> None:
        self.seconds, self.at_least = seconds, at_least

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ring = handle.getListState("ring", "second long, n long")
        self.expiry = handle.getValueState("expiry", "at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = list(rows)
        came, count = (np.concatenate([part[c].to_numpy(np.int64) for part in new]) for c in ("second", "n"))
        order = np.argsort(came)
        held = list(self.ring.get())
        second = np.concatenate([np.array([r[0] for r in held], np.int64), came[order]])
        total = np.concatenate([[0], np.array([r[1] for r in held], np.int64), count[order]]).cumsum()
        first = np.searchsorted(second, second - self.seconds)
        recent = total[1:] - total[first]
        self.keep(second, np.diff(total), int(first[-1]), timerValues.getCurrentWatermarkInMs(), bool(held))
        found = np.arange(len(second)) >= len(held)
        found &= recent >= self.at_least
        if found.any():
            yield pd.DataFrame({"card_id": [key[0]] * int(found.sum()), "second": second[found], "n_recent": recent[found]})

    def keep(self, second: np.ndarray, n: np.ndarray, begin: int, watermark: int, was_held: bool) -> None:
        """Hold the seconds from ``begin`` on that a second after the watermark may still cover. Of a card without any nothing is
        held, so that cards that came and went within a batch cost no state and no timer."""
        begin = max(begin, int(np.searchsorted(second, watermark // 1000 - self.seconds)))
        if was_held:
            self.handle.deleteTimer(self.expiry.get()[0])
        if begin < len(second):
            self.ring.put([(int(s), int(k)) for s, k in zip(second[begin:], n[begin:])])
            at = (int(second[-1]) + self.seconds + 1) * 1000
            self.expiry.update((at,))
            self.handle.registerTimer(at)
        elif was_held:
            self.ring.clear()
            self.expiry.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.ring.clear()
        self.expiry.clear()
        return iter(())

    def close(self) -> None:
        pass


def trailing(stream: DataFrame, measure: Column, seconds: int, at_least: int) -> DataFrame:
    """``card_id, tx_ts, n_recent``: as :func:`txrisk.operators.sequences.trailing`, for all seconds that the watermark has passed.

    Start the query within :func:`arbitrary_state`.
    """
    alerts = moments(stream, measure).groupBy("card_id").transformWithStateInPandas(
        Trailing(seconds, at_least), "card_id long, second long, n_recent long", "append", "eventTime"
    )
    return alerts.select("card_id", C.wall_clock(F.timestamp_seconds("second")).alias("tx_ts"), "n_recent")


def velocity_bursts(stream: DataFrame, rules: BurstRules = BurstRules()) -> DataFrame:
    """Moments at which a card has made many transactions within a short time."""
    return trailing(stream, F.col("n_tx"), rules.velocity_seconds, rules.velocity_tx)


def pin_bursts(stream: DataFrame, rules: BurstRules = BurstRules()) -> DataFrame:
    """Moments at which a card has had several wrong PINs within some time."""
    wrong = C.flag(F.coalesce(F.col("errors").contains(BAD_PIN), F.lit(False)))
    return trailing(stream, wrong, rules.pin_seconds, rules.pin_errors)
