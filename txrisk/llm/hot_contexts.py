"""Contexts of one anchor at very many places: dealt to groups that hold every pair which may agree in enough bytes.

A context is what stands before an anchor (reversed) and from it on. Two contexts agree in ``l`` bytes to the left and ``r`` to the right, and
count if ``l + r >= length``. In a group all members agree in ``a`` bytes to the left and ``b`` to the right. One with too many members is
split: with ``c`` halfway between ``b`` and ``length - a``, a pair that counts has ``r >= c`` or ``l > length - c``, so that the members go to groups of equal
``c`` bytes to the right and to groups of equal ``length - c + 1`` bytes to the left. Contexts without an equal one in that many bytes stand alone and are done. What is
left to decide at least halves each time, as all that a group's members agree in is taken into account first; where ``a + b >= length`` all pairs of a group count, and the longest agreement of each member is that with its neighbour in sorted order,
left and right by themselves. Then nothing is compared in pairs and the group may have any size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.llm.deep_shallow import lcp
from txrisk.sources.workspace import stage

_KEYS = ("anchor", "unit")


def deal(contexts: DataFrame, length: int, most: int) -> tuple[DataFrame, DataFrame | None]:
    """Groups of at most ``most`` members to compare, and the groups in which all pairs count (None if there are none).

    ``contexts`` has one row ``anchor, key, left, right`` (and others, which are kept) per different context, written. The results also have ``unit``; groups are
    by ``anchor`` and ``unit``. A split copies a context at most once and leaves out groups of one. There are at most about ``log2(length)`` splits one in
    the other, 9 for 400 bytes, however many contexts there are; around a common passage one is enough.
    """
    state = contexts.withColumns({"unit": F.lit(b""), "a": F.lit(0), "b": F.lit(0)})
    small: list[DataFrame] = []
    sure: list[DataFrame] = []
    while True:
        counted = state.groupBy(*_KEYS).agg(F.count("*").alias("members"))
        large = stage(counted.filter(F.col("members") > most).select(*_KEYS), "large")
        small.append(state.join(large, list(_KEYS), "left_anti"))
        if large.isEmpty():
            break
        agreed = stage(_agreed(state.join(large, list(_KEYS), "left_semi")), "agreed")
        held = state.drop("a", "b").join(agreed, list(_KEYS))
        enough = F.col("a") + F.col("b") >= length
        if not agreed.filter(enough).isEmpty():
            sure.append(held.filter(enough))
        right = F.col("b") + F.ceil((length - F.col("a") - F.col("b")) / 2).cast("int")
        halves = [
            held.filter(~enough & (F.octet_length(side) >= size)).withColumns({name: size, "unit": _within(mark, side, size)})
            for name, mark, side, size in (("b", b"R", "right", right), ("a", b"L", "left", length - right + 1))
        ]
        children = halves[0].unionByName(halves[1])
        shared = stage(children.groupBy(*_KEYS).agg(F.count("*").alias("members")).filter("members > 1").drop("members"), "shared")
        state = stage(children.join(shared, list(_KEYS), "left_semi"), "split")
    return _united(small), _united(sure) if sure else None


def _agreed(state: DataFrame) -> DataFrame:
    """``anchor, unit, a, b``: in how many bytes all members of a group agree, as its first and its last one in sorted order do."""

    def common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [batch[c].to_pylist() for c in ("l0", "l1", "r0", "r1")]
            a, b = (pa.array(map(lcp, *pair), pa.int32()) for pair in (sides[:2], sides[2:]))
            yield pa.RecordBatch.from_arrays([batch["anchor"], batch["unit"], a, b], [*_KEYS, "a", "b"])

    ends = [f(side).alias(name) for side in ("left", "right") for f, name in ((F.min, f"{side[0]}0"), (F.max, f"{side[0]}1"))]
    return state.groupBy(*_KEYS).agg(*ends).mapInArrow(common, "anchor long, unit binary, a int, b int")


def _within(mark: bytes, side: str, size: Column) -> Column:
    return F.unhex(F.md5(F.concat("unit", F.lit(mark), F.substr(F.col(side), F.lit(1), size))))


def _united(frames: list[DataFrame]) -> DataFrame:
    made = frames[0]
    for frame in frames[1:]:
        made = made.unionByName(frame)
    return made.drop("a", "b")


def nearest(groups: DataFrame, side: str) -> DataFrame:
    """``key, reach``: in how many bytes of ``side`` a member agrees with another one of its group, at most.

    Members are ordered by range over all tasks, so that a group spreads over as many as its size needs; the first and the last row of
    each task, two for each partition, are compared by one task.
    """
    rows = groups.select(*_KEYS, "key", F.col(side).alias("side"))

    def compare(batches: Iterator[pa.RecordBatch], place: Callable[[], int]) -> Iterator[pa.RecordBatch]:
        first = last = None
        for batch in batches:
            keys, reach = [], []
            for anchor, unit, key, side in zip(*(batch[c].to_pylist() for c in (*_KEYS, "key", "side"))):
                now = (anchor, unit, key, side)
                if last is not None and last[:2] == now[:2]:
                    keys += [last[2], key]
                    reach += [lcp(last[3], side)] * 2
                first, last = first or now, now
            yield told(keys, reach)
        if first is not None:
            yield told([first[2], last[2]], [-1, -1], place(), (first, last))

    def told(keys: list, reach: list, place: int | None = None, edges: tuple = ()) -> pa.RecordBatch:
        blank = [None] * len(keys)
        made = {
            "key": pa.array(keys, pa.binary()),
            "reach": pa.array(reach, pa.int32()),
            "place": pa.array(blank if place is None else [2 * place, 2 * place + 1], pa.int64()),
            "anchor": pa.array([e[0] for e in edges] or blank, pa.int64()),
            "unit": pa.array([e[1] for e in edges] or blank, pa.binary()),
            "side": pa.array([e[3] for e in edges] or blank, pa.binary()),
        }
        return pa.RecordBatch.from_pydict(made)

    schema = "key binary, reach int, place long, anchor long, unit binary, side binary"
    ordered = rows.repartitionByRange(*_KEYS, "side", "key").sortWithinPartitions(*_KEYS, "side", "key")
    found = stage(ordered.mapInArrow(lambda batches: compare(batches, lambda: TaskContext.get().partitionId()), schema), "neighbours")
    edges = found.filter("place IS NOT NULL").select(*_KEYS, "key", "side", "place").repartition(1).sortWithinPartitions("place").drop("place")
    across = edges.mapInArrow(lambda batches: compare(batches, lambda: 0), schema)
    return found.union(across).filter("place IS NULL").groupBy("key").agg(F.max("reach").alias("reach"))
