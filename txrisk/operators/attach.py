"""Bringing a value computed per group back to the rows of the group."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 5_000_000
NO_GROUP_SLOTS = 1 << 20


def attach(
    rows: DataFrame,
    groups: DataFrame,
    keys: Sequence[str],
    size: str,
    sizes: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left-join ``groups`` (one row per ``keys``, with its number of rows in ``size``) to ``rows``.

    A plain join would send all rows of a group to one task. Here every group has ``1 + size div hot_rows``
    slots, so that no slot has many more than ``hot_rows`` rows however large the group is; its rows are dealt
    to them by a hash of the whole row and its partition, which also spreads rows without an id, and the
    group is repeated once per slot. The list of groups with several slots is broadcast; there are at most
    ``rows / hot_rows`` of them. Rows with a NULL key have no group and are dealt to slots that nothing is in.

    ``sizes`` is a cheaper source of ``keys`` and ``size``, if ``groups`` takes long to compute.
    """
    keys = list(keys)
    values = [name for name in groups.columns if name not in (*keys, size)]
    extra = F.floor(F.coalesce(F.col(size), F.lit(0)) / hot_rows)
    hot = (groups if sizes is None else sizes).filter(extra > 0).select(*keys, (extra + 1).alias("_slots"))
    per_slot = groups.select(*keys, *values, F.explode(F.sequence(F.lit(0).cast("bigint"), extra)).alias("_slot"))
    no_group = reduce(or_, [F.col(key).isNull() for key in keys])
    slots = F.when(no_group, F.lit(NO_GROUP_SLOTS)).otherwise(F.coalesce("_slots", F.lit(1)))
    slot = F.pmod(F.xxhash64(*rows.columns, F.spark_partition_id()), slots)
    return (
        rows.join(F.broadcast(hot), keys, "left")
        .withColumn("_slot", slot)
        .join(per_slot, [*keys, "_slot"], "left")
        .select(*rows.columns, *values)
    )
