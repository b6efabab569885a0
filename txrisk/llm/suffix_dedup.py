"""Removing every passage of 400 bytes that stands anywhere else, by sorted suffixes at anchors."""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.llm.deep_shallow import deep_shallow_sort, lcp
from txrisk.llm.hot_contexts import deal, nearest
from txrisk.llm.tables import flag_members
from txrisk.sources.workspace import stage

LENGTH = 400
#: Bytes of an anchor: 2 to the power of this.
ANCHOR_POWER = 5
#: Bytes of a text in which anchors are sought at a time.
CHUNK = 1 << 20
#: Places of an anchor that are compared in one task. The different contexts of an anchor with more are dealt to groups of at most
#: as many, see :mod:`txrisk.llm.hot_contexts`.
PART = 16384
#: Contexts in a batch.
BATCH = 4096

_FACTOR = 0x9E3779B97F4A7C15


def _table() -> np.ndarray:
    x = (np.arange(1, 257, dtype=np.uint64) * np.uint64(_FACTOR)) ^ np.uint64(0xD1B54A32D192ED03)
    for shift in (30, 27, 31):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(0xBF58476D1CE4E5B9)
    return x


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (width - size)], x[width - size :]) if width > size else x


def anchors(text: bytes, length: int = LENGTH, power: int = ANCHOR_POWER, table: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of a text's anchors: in every string of ``length`` bytes, the 32 bytes with the least hash, the
    first of equal ones. Equal strings so have the same anchor at the same place."""
    size, table = 1 << power, _table() if table is None else table
    places, hashes = [], []
    for at in range(0, max(0, len(text) - length + 1), CHUNK):
        h = table[np.frombuffer(text, np.uint8, min(CHUNK + length - 1, len(text) - at), at)]
        factor = _FACTOR
        for k in range(power):
            h = h[: -(1 << k)] * np.uint64(factor) + h[1 << k :]
            factor = factor * factor % (1 << 64)
        mixed = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
        mask = np.uint64((1 << 21) - 1)
        least = _sliding_min((mixed & ~mask) | np.arange(len(h), dtype=np.uint64), length - size + 1) & mask
        found = least[np.append(True, least[1:] != least[:-1])].astype(np.int64)
        places.append(found + at)
        hashes.append(h[found].view(np.int64))
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place, first = np.unique(np.concatenate(places), return_index=True)
    return place, np.concatenate(hashes)[first]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def reaches(lefts: list[bytes], rights: list[bytes], length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """For each of several different contexts of an anchor, pairs (bytes before it, bytes from it on) such that another context
    agrees in both and they make ``length`` together. Lefts are reversed. All longest pairs are found.

    The right sides are sorted; contexts are merged from the longest common right side to the shortest, and each merged
    group keeps its members in the order of their left sides, where the best partner is a neighbour.
    """
    n = len(lefts)
    out: list[list[tuple[int, int]]] = [[] for _ in range(n)]

    def meet(i: int, j: int, right: int) -> None:
        left = lcp(lefts[i], lefts[j])
        if left + right >= length:
            out[i].append((left, right))
            out[j].append((left, right))

    if n == 2:
        meet(0, 1, lcp(*rights))
        return out
    order = deep_shallow_sort(rights)
    common = [lcp(rights[a], rights[b]) for a, b in zip(order, order[1:])]
    by_left = deep_shallow_sort(lefts)
    rank = [0] * n
    for r, i in enumerate(by_left):
        rank[i] = r
    group, members = list(range(n)), {i: [rank[i]] for i in range(n)}

    def root(i: int) -> int:
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return i

    for right, k in sorted(((c, k) for k, c in enumerate(common)), reverse=True):
        a, b = root(order[k]), root(order[k + 1])
        small, large = (a, b) if len(members[a]) < len(members[b]) else (b, a)
        held = members[large]
        for r in members.pop(small):
            at = bisect_left(held, r)
            if at:
                meet(by_left[r], by_left[held[at - 1]], right)
            if at < len(held):
                meet(by_left[r], by_left[held[at]], right)
            held.insert(at, r)
        group[small] = large
    return out


def _of_group(rows: list[tuple[bytes, bytes, bytes, list[int]]], length: int) -> Iterator[tuple[bytes, list[int]]]:
    """Spans (digest, starts and ends) that one anchor's contexts (reversed left, right, digest, places) prove repeated."""
    same: dict[tuple[bytes, bytes], list[tuple[bytes, list[int]]]] = {}
    for left, right, digest, places in rows:
        same.setdefault((left, right), []).append((digest, places))
    if len(same) == 1 and len(rows) == 1 and len(rows[0][3]) == 1:
        return
    keys = list(same)
    found = reaches([k[0] for k in keys], [k[1] for k in keys], length) if len(keys) > 1 else [[]]
    for key, reach in zip(keys, found):
        held = same[key]
        if sum(len(p) for _, p in held) > 1:
            reach = [(len(key[0]), len(key[1]))]  # no other context agrees in more
        for digest, places in held if reach else ():
            spans = _merged([(p - left, p + right) for p in places for left, right in set(reach)])
            yield digest, [x for span in spans for x in span]


def repeated(docs: DataFrame, length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """``digest, spans`` of texts in which something is repeated, and ``digest, text`` of the texts that might have something.

    ``spans`` holds starts and ends in bytes, not merged. ``digest`` is the text's MD5; equal texts are one.
    """
    before = length - (1 << ANCHOR_POWER)
    texts = docs.select(F.unhex(F.md5(F.col("text"))).alias("digest"), "text").filter(F.octet_length("text") >= length)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = _table(), set()
        for batch in batches:
            digests, places, hashes, sizes = [], [], [], []
            for digest, text in zip(batch["digest"].to_pylist(), batch["text"].cast(pa.large_binary())):
                if digest not in seen:
                    seen.add(digest)
                    place, made = anchors(text.as_py(), length, table=table)
                    order = np.argsort(made, kind="stable")
                    made = made[order]
                    first = np.flatnonzero(np.append(True, made[1:] != made[:-1]))
                    digests += [digest] * len(first)
                    places.append(place[order])
                    hashes.append(made[first])
                    sizes.append(np.diff(np.append(first, len(made))))
            if digests:
                offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32)
                of_anchor = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(places).astype(np.int32)))
                columns = [pa.array(np.concatenate(hashes)), pa.array(digests, pa.binary()), of_anchor]
                yield pa.RecordBatch.from_arrays(columns, ["anchor", "digest", "places"])

    found = texts.mapInArrow(find, "anchor long, digest binary, places array<int>").dropDuplicates(["anchor", "digest"])
    each = stage(found, "found")
    counted = each.groupBy("anchor").agg(F.sum(F.size("places")).alias("all")).filter(F.col("all") > 1)
    several = each.join(counted, "anchor")
    of_text = several.groupBy("digest").agg(
        F.collect_list(F.struct("anchor", "places", (F.col("all") > PART).alias("hot"))).alias("anchors"),
        F.max(F.col("all") > PART).alias("hot"), F.min(F.col("all") > PART).alias("only_hot"),
    )
    of_text = stage(of_text, "anchors")
    maybe = flag_members(texts, F.col("digest"), of_text, F.col("digest")).filter("__maybe").drop("__maybe")
    held = stage(maybe.dropDuplicates(["digest"]).join(of_text, "digest"), "held")

    def contexts(hot: bool, whole: bool):
        """Contexts of the anchors that are hot or not: ``anchor, key, digest, places`` and, if ``whole``, ``left, right``."""

        def batch_of(rows: dict[tuple, list[int]], digest: bytes) -> pa.RecordBatch:
            made = {
                "anchor": pa.array([a for a, _, _ in rows], pa.int64()),
                "key": pa.array([hashlib.md5(b"%d %d " % (a, len(left)) + left + right).digest() for a, left, right in rows], pa.binary()),
                "digest": pa.array([digest] * len(rows), pa.binary()),
                "places": pa.array(list(rows.values()), pa.list_(pa.int32())),
            }
            if whole:
                made |= {"left": pa.array([r[1] for r in rows], pa.binary()), "right": pa.array([r[2] for r in rows], pa.binary())}
            return pa.RecordBatch.from_pydict(made)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i, digest in enumerate(batch["digest"].to_pylist()):
                    text = batch["text"][i].cast(pa.large_binary()).as_py()
                    rows: dict[tuple, list[int]] = {}
                    for a in batch["anchors"][i].as_py():
                        for p in a["places"] if a["hot"] == hot else ():
                            left, right = text[max(0, p - before) : p][::-1], text[p : p + length]
                            if len(left) + len(right) >= length:
                                rows.setdefault((a["anchor"], left, right), []).append(p)
                            if len(rows) >= BATCH:
                                yield batch_of(rows, digest)
                                rows = {}
                    if rows:
                        yield batch_of(rows, digest)

        schema = "anchor long, key binary, digest binary, places array<int>" + ", left binary, right binary" * whole
        return held.filter(F.col("hot") if hot else ~F.col("only_hot")).select("digest", "text", "anchors").mapInArrow(run, schema)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        found: dict[bytes, list[int]] = {}  # spans of texts, put together before they are shuffled
        size = 0

        def close() -> None:
            nonlocal size
            for digest, spans in _of_group(rows, length):
                found.setdefault(digest, []).extend(spans)
                size += len(spans)

        def out() -> pa.RecordBatch:
            nonlocal size
            merged = [[x for s in _merged(list(zip(v[::2], v[1::2]))) for x in s] for v in found.values()]
            made = pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(merged, pa.list_(pa.int32()))], ["digest", "spans"])
            found.clear()
            size = 0
            return made

        for batch in batches:
            columns = (batch[c].to_pylist() for c in ("anchor", "unit", "left", "right", "digest", "places"))
            for anchor, unit, *row in zip(*columns):
                if (anchor, unit) != now:
                    close()
                    now, rows = (anchor, unit), []
                rows.append(tuple(row))
            if size > 1_000_000:
                yield out()
        close()
        yield out()

    def compared(rows: DataFrame) -> DataFrame:
        held = rows.select("anchor", "unit", "left", "right", "digest", "places").repartition("anchor", "unit")
        return held.sortWithinPartitions("anchor", "unit").mapInArrow(compare, "digest binary, spans array<int>")

    found = compared(contexts(False, True).withColumn("unit", F.lit(0)))
    # equal contexts of a hot anchor are one row, at place 0, and repeated as a whole if they stand at several places
    whole = contexts(True, True).withColumn("n", F.size("places").cast("long"))
    different = stage(whole.groupBy("anchor", "key", "left", "right").agg(F.sum("n").alias("n")), "contexts")
    units, sure = deal(different, length, PART)
    place = F.array(F.lit(0)).alias("places")
    reach = compared(units.select("anchor", "unit", "left", "right", F.col("key").alias("digest"), place))
    whole = [F.octet_length(side).cast("int") for side in ("left", "right")]
    reach = reach.union(different.filter("n > 1").select("key", F.array(-whole[0], whole[1])))
    if sure is not None:
        left, right = (nearest(sure, side).select("key", F.col("reach").alias(side)) for side in ("left", "right"))
        reach = reach.union(left.join(right, "key").select("key", F.array(-F.col("left"), F.col("right"))))
    # every pair of a context spans its anchor, so together they are one span
    reach = reach.groupBy(F.col("digest").alias("key")).agg(F.min(F.col("spans")[0]).alias("from"), F.max(F.col("spans")[1]).alias("to"))
    spread = F.flatten(F.transform("places", lambda p: F.array(p + F.col("from"), p + F.col("to"))))
    told = contexts(True, False).join(reach, "key").select("digest", spread.alias("spans"))
    spans = found.union(told).groupBy("digest").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    return spans, held.select("digest", "text")


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row of ``docs`` (``doc_id, text``; others are ignored).

    Removed is each byte covered by a string of ``length`` bytes that also starts anywhere else in any text, the same one
    included; strings may overlap. ``n_spans`` counts the maximal removed runs; the digest is that of the remaining bytes. NULL is
    an empty text; texts shorter than ``length`` lose nothing. Rows with equal texts are treated alike: of ``length`` bytes
    or more, all of each is removed.

    Every such string holds an anchor, so the suffixes to sort are those at anchors that occur twice. A task holds the
    contexts of one anchor at up to ``PART`` places. Of a more frequent one, equal contexts are summed to one row first and dealt to
    groups of at most ``PART`` that agree in more bytes; what is found is joined back to the places. Larger groups remain only where all
    members agree in ``length`` bytes, and these are sorted over many tasks. Anchors are counted by partial sums. Only texts that may hold a repeated anchor are
    shuffled, by their digest, and each task sends one of equal texts.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = stage(
        docs.select("doc_id", F.unhex(F.md5(text)).alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"), F.unhex(F.sha2(text, 256)).alias("sha")),
        "texts",
    )
    copied = rows.filter(F.col("n_bytes") >= length).groupBy("digest").agg(F.count("*").alias("copies")).filter("copies > 1")
    copied = stage(copied.select("digest", F.lit(True).alias("copied")), "copied")
    spans, held = repeated(docs, length)
    single = stage(spans.join(copied, "digest", "left_anti"), "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for text, flat in zip(batch["text"].cast(pa.large_binary()), batch["spans"].to_pylist()):
                data, kept, at = memoryview(text.as_py()), hashlib.sha256(), 0
                runs = _merged(list(zip(flat[::2], flat[1::2])))
                for a, b in runs:
                    kept.update(data[at:a])
                    at = b
                kept.update(data[at:])
                made.append((sum(b - a for a, b in runs), len(runs), kept.digest()))
            columns = [pa.array([m[i] for m in made], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([batch["digest"], *columns], ["digest", "removed", "runs", "kept"])

    done = held.join(single, "digest").mapInArrow(cut, "digest binary, removed long, runs long, kept binary")
    done = stage(done.dropDuplicates(["digest"]), "done")
    joined = rows.join(copied, "digest", "left").join(done, "digest", "left")
    empty = F.lit(hashlib.sha256().hexdigest())
    whole = F.coalesce("copied", F.lit(False))
    return joined.select(
        "doc_id", "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("runs", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, empty).otherwise(F.lower(F.hex(F.coalesce("kept", "sha")))).alias("kept_sha256"),
    )
