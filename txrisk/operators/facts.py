"""Typed transactions and their additive measures.

Every report is a sum, a minimum or a maximum of the measures below over some grouping. They can be
summed from the rows or from any roll-up of them, so a report gives the same result on either:
``by_hour(facts)`` equals ``by_hour(rollup(facts, "tx_hour", "mcc"))``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.functions import cleaning as C

SUMMED = (
    "n_tx",
    "n_amount",
    "net_cents",
    "n_pos",
    "pos_cents",
    "n_high",
    "n_errors",
    "n_night",
    "n_online",
)
LOWEST = ("min_pos_cents",)
HIGHEST = ("max_pos_cents",)


def clean(raw: DataFrame) -> DataFrame:
    """Typed amount and time columns next to the raw ones."""
    return (
        raw.withColumns({"amount_clean": C.money(F.col("amount")), "tx_ts": C.event_time(F.col("date"))})
        .withColumns(
            {
                "tx_hour": F.hour("tx_ts"),
                "tx_dow": F.dayofweek("tx_ts"),
                "tx_month": F.month("tx_ts"),
                "tx_date": F.to_date("tx_ts"),
            }
        )
    )


def with_id(tx: DataFrame) -> DataFrame:
    """``tx`` with a number for every row if it has no column ``id``. Write the result before using it twice: the
    numbers are only stable in a written table."""
    return tx if "id" in tx.columns else tx.withColumn("id", F.monotonically_increasing_id())


def facts(tx: DataFrame, high_amount: int = 200) -> DataFrame:
    """``tx`` (see :func:`clean`) with one column per measure. Unused ones are pruned by Spark."""
    amount = F.col("amount_clean")
    positive = F.coalesce(amount > 0, F.lit(False))
    in_cents = C.cents(amount)
    return tx.withColumns(
        {
            "n_tx": F.lit(1).cast("bigint"),
            "n_amount": C.flag(amount.isNotNull()),
            "net_cents": F.coalesce(in_cents, F.lit(0)),
            "n_pos": C.flag(positive),
            "pos_cents": F.coalesce(F.when(positive, in_cents), F.lit(0)),
            "n_high": C.flag(amount > high_amount),
            "n_errors": C.flag(C.has_error(F.col("errors"))),
            "n_night": C.flag(C.is_night(F.col("tx_hour"))),
            "n_online": C.flag(C.is_online(F.col("merchant_city"))),
            "min_pos_cents": F.when(positive, in_cents),
            "max_pos_cents": F.when(positive, in_cents),
        }
    )


def totals(*names: str) -> list:
    """The aggregate expressions that carry the named measures (all of them by default) upwards."""
    chosen = names or SUMMED + LOWEST + HIGHEST
    combine = {**dict.fromkeys(SUMMED, F.sum), **dict.fromkeys(LOWEST, F.min), **dict.fromkeys(HIGHEST, F.max)}
    return [combine[name](name).alias(name) for name in chosen]


def rollup(rows: DataFrame, *keys: str) -> DataFrame:
    """All measures that ``rows`` has, per group; partial sums are built before the shuffle."""
    present = [name for name in SUMMED + LOWEST + HIGHEST if name in rows.columns]
    return rows.groupBy(*keys).agg(*totals(*present))
