"""Contexts of a hot anchor, against all pairs."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from txrisk.llm.deep_shallow import lcp
from txrisk.llm.hot_contexts import deal, nearest
from txrisk.llm.suffix_dedup import reaches
from txrisk.sources.workspace import stage

SCHEMA = "anchor long, key binary, left binary, right binary"


def made(seed: int) -> list[tuple]:
    """Contexts of two anchors whose sides agree in many different lengths; some are short."""
    dice, out = random.Random(seed), set()
    stems = [bytes(dice.choice(b"ab") for _ in range(40)) for _ in range(2)]
    for _ in range(220):
        left, right = (dice.choice(stems)[: dice.randint(4, 40)] + bytes(dice.choice(b"xyz") for _ in range(40)) for _ in "lr")
        out.add((dice.choice([1, 1, 1, 2]), left[: dice.choice([32, 32, 11])], right[: dice.choice([40, 40, 30])]))
    return [(a, b"%d" % i, left, right) for i, (a, left, right) in enumerate(sorted(out))]


def longest(rows: list[tuple], length: int) -> dict[bytes, tuple[int, int]]:
    """By key: the most bytes to the left and to the right among the pairs that count."""
    out: dict[bytes, tuple[int, int]] = {}
    for i, x in enumerate(rows):
        for y in rows[:i]:
            if x[0] == y[0] and (l := lcp(x[2], y[2])) + (r := lcp(x[3], y[3])) >= length:
                for key in (x[1], y[1]):
                    best = out.get(key, (0, 0))
                    out[key] = (max(best[0], l), max(best[1], r))
    return out


@pytest.mark.parametrize(("seed", "most"), [(1, 3), (2, 8), (3, 1), (4, 10_000)])
def test_groups_hold_every_pair_that_counts(spark, seed, most):
    length, rows = 40, made(seed)
    units, sure = deal(stage(spark.createDataFrame(rows, SCHEMA), "contexts"), length, most)
    groups: dict[tuple, list] = {}
    for r in units.collect():
        groups.setdefault((r.anchor, bytes(r.unit)), []).append(r)
    assert max(map(len, groups.values()), default=0) <= most
    got: dict[bytes, tuple[int, int]] = {}
    for members in groups.values():
        found = reaches([bytes(m.left) for m in members], [bytes(m.right) for m in members], length) if len(members) > 1 else []
        for m, pairs in zip(members, found):
            for l, r in pairs:
                best = got.get(bytes(m.key), (0, 0))
                got[bytes(m.key)] = (max(best[0], l), max(best[1], r))
    if sure is not None:
        sides = [{bytes(r.key): r.reach for r in nearest(sure, side).collect()} for side in ("left", "right")]
        for key in sides[0]:
            best = got.get(key, (0, 0))
            got[key] = (max(best[0], sides[0][key]), max(best[1], sides[1][key]))
    assert got == longest(rows, length)
    assert sure is not None if seed == 3 else seed < 3 or sure is None


def many(spark, n: int, left, right):
    """``n`` contexts of one anchor."""
    return stage(spark.range(n).select(F.lit(7).cast("long").alias("anchor"), F.unhex(F.md5(F.col("id").cast("string"))).alias("key"), left, right), "many")


def random_bytes(mark: str, blocks: int):
    return F.concat(*[F.unhex(F.sha2(F.concat(F.lit(f"{mark}{i}"), F.col("id").cast("string")), 256)) for i in range(blocks)])


def test_a_hundred_thousand_contexts_are_shipped_twice_at_most(spark):
    contexts = many(spark, 100_000, random_bytes("l", 11).alias("left"), random_bytes("r", 12).alias("right"))
    units, sure = deal(contexts, 400, 16384)
    assert sure is None and units.count() <= 200_000
    assert units.groupBy("anchor", "unit").count().filter("count > 16384").isEmpty()


def test_what_all_share_is_sorted_and_not_paired(spark):
    """All agree in 400 bytes to the right, and each has one other that agrees in 32 bytes to the left: one copy for each level of splits."""
    same = F.lit(bytes(range(200)) * 2)
    pair = F.unhex(F.sha2(F.concat(F.lit("p"), F.floor(F.col("id") / 2).cast("string")), 256))
    contexts = many(spark, 60_000, F.concat(pair, F.lit(b"\0"), random_bytes("l", 10)).alias("left"), same.alias("right"))
    units, sure = deal(contexts, 400, 16384)
    assert sure is not None and sure.count() == 60_000 and units.count() <= 9 * 60_000
    left = {r["reach"]: r["count"] for r in nearest(sure, "left").groupBy("reach").count().collect()}
    assert sum(left.values()) == 60_000 and all(33 <= reach < 40 for reach in left)
    assert [tuple(r) for r in nearest(sure, "right").groupBy("reach").count().collect()] == [(400, 60_000)]


def test_no_contexts(spark):
    units, sure = deal(stage(spark.createDataFrame([], SCHEMA), "none"), 400, 5)
    assert units.isEmpty() and sure is None
