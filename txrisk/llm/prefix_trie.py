"""The trie of the turns that rebuilt conversations begin with, by fingerprints that are composed and never by rebuilt texts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.llm import fingerprint as fp
from txrisk.sources.workspace import stage

#: Conversations in one row of the ids that are hashed: 2^12 neighbouring ids.
ID_BITS = 12
EMPTY = hashlib.sha256().hexdigest()

NODE = ["depth", "f1", "f2"]
PARENT = ["depth", "q1", "q2"]


def references(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, told, chars`` of the stored turns: SHA-256 of role and text, and the text's code points; no texts.

    NULL roles and texts are empty. Rows without a conversation belong to none and are left out.
    """
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    told = F.unhex(F.sha2(F.concat(F.sha2(said("role"), 256), said("text")), 256))
    held = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", told.alias("told"), F.length(said("text")).cast("long").alias("chars"))
    return held.filter("conv_id IS NOT NULL").withColumn("row", F.monotonically_increasing_id())


def _batch(arrays: list, schema: str) -> pa.RecordBatch:
    made = [a if isinstance(a, pa.Array) else pa.array(a) for a in arrays]
    return pa.RecordBatch.from_arrays(made, [field.split()[0] for field in schema.split(", ")])


STORED = "conv_id long, part int, k long, v1 long, v2 long, told binary, chars long"


def stored_prefixes(refs: DataFrame, seed: int, points: tuple[int, int]) -> DataFrame:
    """The fingerprint ``v1, v2`` of every stored conversation's first ``k`` turns, beside its ``k``-th turn.

    Turns are sorted by range (turn, NULL first, then digest), so a long conversation is spread over partitions. Each partition
    is scanned alone; the fingerprints of what stands before in other partitions are composed on the driver, from at most two
    rows for each partition, and put before by :func:`_carried`.
    """
    keys = ["conv_id", "turn", "told", "row"]
    ordered = refs.repartitionByRange(*keys).sortWithinPartitions(*keys).select("conv_id", "told", "chars")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, length, values = None, 0, [0, 0]
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch["conv_id"].to_numpy()
            new = np.append(True, conv[1:] != conv[:-1])
            starts = np.flatnonzero(new)
            run_at = np.arange(len(conv)) - starts[np.cumsum(new) - 1] + 1
            carried = int(starts[1]) if len(starts) > 1 else len(conv)
            carried = carried if last == conv[0] else 0
            place = run_at.astype(np.int64)
            place[:carried] += length
            out, digests = [], batch["told"].to_pylist()
            for lane, point in enumerate(points):
                value = fp.prefixes(fp.symbols(digests, lane, seed), run_at, point)
                if carried:
                    before = fp.times(np.full(carried, values[lane], np.uint64), fp.powers(point, run_at[:carried]))
                    value[:carried] = fp.plus(value[:carried], before)
                out.append(value)
            last, length, values = conv[-1], int(place[-1]), [int(v[-1]) for v in out]
            parts = np.full(len(conv), part, np.int32)
            arrays = [batch["conv_id"], parts, place, *(v.astype(np.int64) for v in out), batch["told"], batch["chars"]]
            yield _batch(arrays, STORED)

    scanned = stage(ordered.mapInArrow(scan, STORED), "prefixes")
    ends = scanned.groupBy("conv_id", "part").agg(F.max(F.struct("k", "v1", "v2")).alias("end"))
    several = ends.groupBy("conv_id").agg(F.count("*").alias("parts")).filter("parts > 1")
    spread = ends.join(several, "conv_id").select("conv_id", "part", "end.*").orderBy("conv_id", "part").collect()
    return _carried(scanned, spread, points)


def _carried(scanned: DataFrame, spread: Sequence, points: tuple[int, int]) -> DataFrame:
    """Puts before the prefixes of a partition what its conversation has in earlier ones; ``spread`` has the last prefix of each
    conversation in more than one partition, in order."""
    before: dict[tuple[int, int], tuple[int, ...]] = {}
    now: tuple[int, ...] = (0, 0, 0)
    for i, r in enumerate(spread):
        if not i or spread[i - 1]["conv_id"] != r["conv_id"]:
            now = (0, 0, 0)
        else:
            before[r["conv_id"], r["part"]] = now
        values = ((v * pow(point, r["k"], fp.P) + own) % fp.P for v, point, own in zip(now[1:], points, (r["v1"], r["v2"])))
        now = (now[0] + r["k"], *values)
    if not before:
        return scanned

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {n: batch[n].to_numpy(zero_copy_only=False) for n in ("conv_id", "part", "k", "v1", "v2")}
            k, v = columns["k"].copy(), [columns["v1"].astype(np.uint64), columns["v2"].astype(np.uint64)]
            for conv, part in set(zip(columns["conv_id"].tolist(), columns["part"].tolist())) & before.keys():
                at = np.flatnonzero((columns["conv_id"] == conv) & (columns["part"] == part))
                length, *values = before[conv, part]
                for lane, point in enumerate(points):
                    v[lane][at] = fp.plus(v[lane][at], fp.times(np.full(len(at), values[lane], np.uint64), fp.powers(point, columns["k"][at])))
                k[at] += length
            arrays = [batch["conv_id"], batch["part"], k, *(x.astype(np.int64) for x in v), batch["told"], batch["chars"]]
            yield _batch(arrays, STORED)

    return scanned.mapInArrow(carry, STORED)


def rebuilt(stored: DataFrame, plan: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id, base, head`` (turns of ``base`` it begins with), ``skip`` (own turns left out), ``own``, and the
    fingerprints ``b1, b2`` of that head and ``o1, o2`` of the own turns left out.

    ``plan`` has ``conv_id, base, head`` for every conversation; a base with fewer turns gives all it has, an absent one none.
    """
    own = stored.groupBy("conv_id").agg(F.max("k").alias("own"))
    of_base = own.select(F.col("conv_id").alias("base"), F.col("own").alias("base_own"))
    convs = own.join(plan.select("conv_id", "base", F.col("head").alias("skip")), "conv_id").join(of_base, "base", "left")
    convs = convs.withColumn("head", F.least("skip", F.coalesce("base_own", F.lit(0).cast("long")))).drop("base_own")
    most = plan.agg(F.max("head")).first()[0] or 0
    heads = stored.filter(F.col("k") <= most)
    of_head = heads.select(F.col("conv_id").alias("base"), F.col("k").alias("head"), F.col("v1").alias("b1"), F.col("v2").alias("b2"))
    of_skip = heads.select("conv_id", F.col("k").alias("skip"), F.col("v1").alias("o1"), F.col("v2").alias("o2"))
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("b1", "b2", "o1", "o2")]
    joined = convs.join(of_head, ["base", "head"], "left").join(of_skip, ["conv_id", "skip"], "left")
    return joined.select("conv_id", "base", "head", "skip", "own", *zero)


MEMBERS = "depth long, f1 long, f2 long, q1 long, q2 long, told binary, chars long, n long, conv_id long, n_ends long, end_id long, own_turn boolean"


def memberships(stored: DataFrame, convs: DataFrame, seed: int, points: tuple[int, int]) -> DataFrame:
    """Rows of ``MEMBERS``: the node ``depth, f1, f2`` that ``n`` rebuilt conversations begin with, ``conv_id`` being the least of them, its parent's
    fingerprint ``q1, q2``, its last turn's digest and length, and how many of them end there (``end_id`` the least).

    Own turns give a row each: own prefix, minus the skipped head, plus the base's, all as fingerprints. A base's
    turns give one row for all conversations that begin with them, counted by length of head first.
    """
    suffix = F.greatest(F.col("own") - F.col("skip"), F.lit(0))
    counts = convs.filter("head > 0").groupBy(F.col("base").alias("conv_id"), F.col("head").alias("k")).agg(
        F.count("*").alias("n"),
        F.min("conv_id").alias("least"),
        F.count_if(suffix == 0).alias("n_ends"),
        F.min(F.when(suffix == 0, F.col("conv_id"))).alias("end_id"),
    )
    longest = counts.groupBy("conv_id").agg(F.max("k").alias("longest"))
    zero = F.lit(0).cast("long")
    same = ["conv_id", "k"]
    in_heads = stored.join(longest, "conv_id").filter("k <= longest").join(counts, same, "left")
    rest = "PARTITION BY conv_id ORDER BY k DESC"  # a head of k turns also has the shorter ones
    heads = in_heads.select(
        F.col("k").alias("depth"), "v1", "v2", zero.alias("e1"), zero.alias("e2"), zero.alias("shift"), "told", "chars",
        F.expr(f"sum(n) OVER ({rest})").alias("n"), F.expr(f"min(least) OVER ({rest})").alias("conv_id"),
        F.coalesce("n_ends", zero).alias("n_ends"), "end_id", F.lit(False).alias("own_turn"),
    )
    at_end = F.col("k") == F.col("own")
    tails = stored.join(convs, "conv_id").filter(F.col("k") > F.col("skip")).select(
        (F.col("head") + F.col("k") - F.col("skip")).alias("depth"), "v1", "v2",
        *[F.expr(f"CASE WHEN b{i} >= o{i} THEN b{i} - o{i} ELSE b{i} - o{i} + {fp.P} END").alias(f"e{i}") for i in (1, 2)],
        (F.col("k") - F.col("skip")).alias("shift"), "told", "chars", F.lit(1).cast("long").alias("n"), "conv_id",
        at_end.cast("long").alias("n_ends"), F.when(at_end, F.col("conv_id")).alias("end_id"), F.lit(True).alias("own_turn"),
    )

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            number = lambda c: batch[c].to_numpy().astype(np.uint64)
            digests, made = batch["told"].to_pylist(), []
            for lane, point in enumerate(points):
                value = fp.plus(number(f"v{lane + 1}"), fp.times(number(f"e{lane + 1}"), fp.powers(point, number("shift"))))
                above = fp.times(fp.minus(value, fp.symbols(digests, lane, seed)), np.uint64(fp.inverse(point)))
                made.append((value.astype(np.int64), above.astype(np.int64)))
            arrays = [batch["depth"], made[0][0], made[1][0], made[0][1], made[1][1], *(batch[c] for c in ("told", "chars", "n", "conv_id", "n_ends", "end_id", "own_turn"))]
            yield _batch(arrays, MEMBERS)

    return tails.unionByName(heads).mapInArrow(compose, MEMBERS)


def _nodes(members: DataFrame) -> DataFrame:
    found = members.groupBy(*NODE).agg(
        F.min("q1").alias("q1"), F.min("q2").alias("q2"), F.max("chars").alias("chars"), F.sum("n").alias("n_convs"),
        F.min("conv_id").alias("conv_id"), F.sum("n_ends").alias("n_ends"), F.min("end_id").alias("end_id"),
        ((F.min("told") == F.max("told")) & (F.min("q1") == F.max("q1")) & (F.min("q2") == F.max("q2"))).alias("one"),
    )
    return stage(found, "nodes")


def _subtree_sums(shared: DataFrame, names: Sequence[str]) -> DataFrame:
    """``depth, f1, f2`` and, for each of ``names``, its sum over a node's subtree among ``shared``, which holds every parent.

    In round i every node has the sums of the 2^i levels that begin with it and knows its ancestor 2^i levels up; adding what stands
    there doubles both. Rounds grow with the logarithm of the depth; each is written to the shared folder.
    """
    up = ["u1", "u2"]
    now = stage(shared.select(*NODE, *names, F.col("q1").alias("u1"), F.col("q2").alias("u2")), "levels")
    deepest, step = now.agg(F.max("depth")).first()[0] or 0, 1
    while step <= deepest:
        to = [(F.col("depth") - step).alias("depth"), F.col("u1").alias("f1"), F.col("u2").alias("f2")]
        below = now.filter(F.col("depth") >= step).select(*to, *names)
        below = below.groupBy(*NODE).agg(*[F.sum(n).alias(f"more_{n}") for n in names])
        sums = [(F.col(n) + F.coalesce(f"more_{n}", F.lit(0))).alias(n) for n in names]
        grown = now.join(below, NODE, "left").select(*NODE, *sums, *up)
        high = now.filter(F.col("depth") >= step).select((F.col("depth") + step).alias("depth"), F.col("f1").alias("u1"), F.col("f2").alias("u2"), F.col("u1").alias("w1"), F.col("u2").alias("w2"))
        next_up = [F.col("w1").alias("u1"), F.col("w2").alias("u2")]
        low = grown.filter(F.col("depth") < 2 * step).select(*NODE, *names, F.lit(None).cast("long").alias("u1"), F.lit(None).cast("long").alias("u2"))
        now = stage(low.union(grown.filter(F.col("depth") >= 2 * step).join(high, ["depth", *up]).select(*NODE, *names, *next_up)), "levels")
        step *= 2
    return now.select(*NODE, *names)


def _end_hashes(ends: DataFrame) -> DataFrame:
    """``depth, f1, f2, ends_sha256``: SHA-256 of the ids, in order and joined by commas.

    Ids are packed first, at most 2^ID_BITS of them in a row; one task then hashes a node's rows as they stream by.
    """
    block = F.shiftright("conv_id", ID_BITS).alias("block")
    packed = ends.groupBy(*NODE, block).agg(F.array_join(F.array_sort(F.collect_list("conv_id")), ",").alias("ids"))
    ordered = packed.repartition(*NODE).sortWithinPartitions(*NODE, "block").select(*NODE, "ids")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64()] * 3 + [pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], [*NODE, "ends_sha256"])

        node, held, done = None, None, []
        for batch in batches:
            for *here, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if here != node:
                    if held is not None:
                        done.append((*node, held.hexdigest()))
                    node, held = here, hashlib.sha256(ids.encode())
                else:
                    held.update(f",{ids}".encode())
            if done:
                yield batch_of(done)
                done = []
        if held is not None:
            yield batch_of([(*node, held.hexdigest())])

    return ordered.mapInArrow(digest, "depth long, f1 long, f2 long, ends_sha256 string")


def prefix_trie(turns: DataFrame, plan: DataFrame, points: Sequence[tuple[int, int]] = fp.POINTS) -> DataFrame:
    """One row per node: ``conv_id`` (its least member), ``depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    ``turns`` has ``conv_id, turn, role, text``, other columns being ignored; rows of one turn stand by digest. ``plan`` says which conversation each one
    begins with, see :func:`rebuilt`. Repeated rows are turns like others. An empty table has no node.

    A node's members agree in its fingerprint. That they agree in turns is verified by what their references store: within a node all last turns have one
    SHA-256 and all parents one fingerprint, which proves equality from the root down. If any node fails, all is done again with
    other ``points``; when these are used up, an error is raised.
    """
    refs = stage(references(turns), "references")
    for seed, pair in enumerate(points):
        stored = stored_prefixes(refs, seed, pair)
        convs = stage(rebuilt(stored, plan), "rebuilt")
        members = stage(memberships(stored, convs, seed, pair), "members")
        nodes = _nodes(members)
        if not nodes.filter("NOT one").limit(1).count():
            return _report(nodes, members, convs)
    raise ValueError("different turns have equal fingerprints at all points")


def _report(nodes: DataFrame, members: DataFrame, convs: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("long")
    none = F.lit(None).cast("long")
    without = F.col("own") <= F.col("skip")
    ends_at_head = convs.filter(without).select(F.col("head").alias("depth"), F.col("b1").alias("f1"), F.col("b2").alias("f2"), "conv_id")
    no_turn = without & (F.col("head") == 0)
    root = convs.groupBy().agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.count_if(no_turn).alias("n_ends"),
        F.min(F.when(no_turn, F.col("conv_id"))).alias("end_id"),
    ).filter("n_convs > 0")
    root = root.select(zero.alias("depth"), zero.alias("f1"), zero.alias("f2"), none.alias("q1"), none.alias("q2"), zero.alias("chars"), "n_convs", "conv_id", "n_ends", "end_id")
    all_nodes = nodes.drop("one").select(*root.columns).union(root)
    children = nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("f1"), F.col("q2").alias("f2")).agg(
        F.count("*").alias("n_children"), F.count_if(F.col("n_convs") == 1).alias("alone")
    )
    shared = all_nodes.filter("n_convs > 1 OR depth = 0").join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", zero))
    shared = stage(
        shared.withColumn("n_leaves", F.coalesce("alone", zero) + (F.col("n_children") == 0).cast("long")).withColumn(
            "saved_tokens", (F.col("n_convs") - 1) * F.col("chars")
        ),
        "shared",
    )
    sums = _subtree_sums(shared, ["n_leaves", "saved_tokens"])
    ends = members.filter("own_turn AND n_ends = 1")
    several = shared.filter("n_ends > 1").select(*NODE)
    ends = ends.select(*NODE, F.col("end_id").alias("conv_id")).union(ends_at_head)
    hashes = _end_hashes(ends.join(several, NODE, "left_semi"))
    together = shared.drop("n_leaves", "saved_tokens").join(sums, NODE).join(hashes, NODE, "left")
    made = [*NODE, "q1", "q2", "conv_id", "n_convs", "n_ends", "end_id", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    own_end = F.lit(None).cast("string").alias("ends_sha256")
    alone = nodes.filter("n_convs = 1").select(*made[:9], (F.col("n_ends") == 0).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), zero.alias("saved_tokens"), own_end)
    above = shared.select((F.col("depth") + 1).alias("depth"), F.col("f1").alias("q1"), F.col("f2").alias("q2"), F.col("conv_id").alias("above_id"))
    every = together.select(*made).union(alone).join(above, PARENT, "left")
    digest = F.when(F.col("n_ends") == 0, F.lit(EMPTY)).when(F.col("n_ends") == 1, F.sha2(F.col("end_id").cast("string"), 256)).otherwise(F.col("ends_sha256"))
    parent = F.when(F.col("depth") > 0, F.coalesce("above_id", "conv_id")).alias("parent_conv_id")
    return every.select("conv_id", "depth", parent, "n_convs", "n_children", "n_leaves", "saved_tokens", digest.alias("ends_sha256"))
