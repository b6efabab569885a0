"""Exact join of documents by the Jaccard similarity of their shingle sets, with adaptive multi-match prefixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txrisk.llm.components import components
from txrisk.llm.memory import release, tidy
from txrisk.llm.shingles import WordHashes, shingle_sets
from txrisk.sources.workspace import stage

WORDS = 5
#: Documents link when ``similarity[1] * intersection >= similarity[0] * union``.
SIMILARITY = (80, 100)
#: Cells of the table of counts, how many of them make a row, tasks that sum them, and shingles a task counts at a time.
CELLS, ROW, SUMMERS, COUNTED = 1 << 24, 1 << 16, 32, 1 << 20
#: Most counting tasks for each core.
SPREAD = 8
#: Least counts of the levels by which a cell is known: half a standard deviation of chance apart, then an eighth of the count.
LEVELS = np.unique(np.concatenate([np.arange(4, 161) ** 2 // 16, 1600 * 2 ** (np.arange(1, 100) / 6)]).astype(np.int64))[:255]
#: A shingle is frequent from this count over what chance puts into its cell.
FREQUENT = 16
#: Longest requirement of shared prefix shingles.
MOST_MATCHES = 4
#: Lists up to this length are joined pair by pair; the documents of longer ones are verified block by block.
LIST = 64
BLOCK_DOCS, BLOCK_SHINGLES = 256, 1 << 20


def _binary(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch["text"].cast(pa.large_binary()).to_pylist()]


def shingle_counts(docs: DataFrame, width: int) -> np.ndarray:
    """How many documents have the shingles of each cell, as the number of ``LEVELS`` that the count reaches. A cell takes the shingles
    whose hashes end alike; a byte is kept for each, so the table can go to every task, whatever the number of documents.

    Each task counts all shingles of its documents; the tables of the tasks are packed and summed by parts. What shingles of the
    same cell add is about the same everywhere, so a shingle that stands out in all documents together is known, however few of them
    a task has. The counts only choose the order in which prefixes are taken; the join is exact for any order.
    """

    @tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, table, held, size = WordHashes(), np.zeros(CELLS, np.uint16), [], 0

        def add() -> None:
            cells, counts = np.unique((np.concatenate(held) & np.uint64(CELLS - 1)).astype(np.uint32), return_counts=True)
            table[cells] = np.minimum(table[cells] + counts, np.iinfo(np.uint16).max)

        for batch in batches:
            for tokens in shingle_sets(_binary(batch), width, known):
                held.append(tokens)
                size += len(tokens)
                if size >= COUNTED:
                    add()
                    held, size = [], 0
        if held:
            add()
        for at in range(0, CELLS, ROW):
            if (some := table[at : at + ROW]).any():
                kind = "u1" if some.max() < 256 else "u2"
                packed = pa.compress(some.astype(kind).tobytes(), "zstd", asbytes=True)
                yield pa.RecordBatch.from_pydict({"at": [at], "kind": [kind], "counts": [packed]}, packed_rows)

    @tidy
    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                size = min(ROW, CELLS) * np.dtype(row["kind"]).itemsize
                found = np.frombuffer(pa.decompress(row["counts"], size, "zstd", asbytes=True), row["kind"])
                sums[row["at"]] = sums.get(row["at"], 0) + found.astype(np.int64)
        for at, summed in sums.items():
            levels = np.searchsorted(LEVELS, summed, "right").astype(np.uint8).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([levels], pa.binary())], ["at", "levels"])

    packed_rows = pa.schema([("at", pa.int64()), ("kind", pa.string()), ("counts", pa.binary())])
    tasks = SPREAD * docs.sparkSession.sparkContext.defaultParallelism  # a table each: fewer, fuller ones take less room
    counted = docs.select("text").coalesce(tasks).mapInArrow(count, "at long, kind string, counts binary").repartition(SUMMERS, "at")
    out = np.zeros(CELLS, np.uint8)
    for row in counted.mapInArrow(add_up, "at long, levels binary").collect():
        out[row["at"] : row["at"] + ROW] = np.frombuffer(row["levels"], np.uint8)
    return out


def level_weights(table: np.ndarray) -> np.ndarray:
    """For each level about how many documents a shingle of it has, without those that chance puts into its cell; 0 if it is not frequent."""
    least = np.concatenate([[0], LEVELS])
    chance = least[int(np.searchsorted(np.cumsum(np.bincount(table, minlength=len(least))), len(table) / 2))]
    return np.where(least >= FREQUENT + chance + 4 * np.sqrt(chance), least - chance, 0).astype(np.int64)


#: After a unit of verification over this size a task gives memory back; after each small one it would cost more than the unit.
RELEASED_BYTES = 1 << 23


def prefix_of(tokens: np.ndarray, table: np.ndarray, weights: np.ndarray, similarity: tuple[int, int]) -> tuple[np.ndarray, int, int]:
    """A set's prefix, how much of it serves as the smaller side's, and how many of its shingles a partner must share.

    The order is by level, then by hash. A partner that is no larger shares at least
    ``num/den * n`` shingles, one that is no smaller at least ``2 num / (num + den) * n``; so prefixes that leave out all but
    ``l - 1`` of those share at least l. l is lengthened while the estimated cost falls: the lists to read, and the
    candidates to verify, of which a list of length c gives c - 1, fewer as l of them are needed.
    """
    num, den = similarity
    n = len(tokens)
    levels = table[(tokens & np.uint64(len(table) - 1)).astype(np.int64)]
    order = np.argsort(levels, kind="stable")  # the hashes ascend
    probe, index = n - -(-num * n // den), n - -(-2 * num * n // (num + den))
    most = min(MOST_MATCHES, -(-num * n // den))
    weight = weights[levels[order[: probe + most]]]
    if not weight[probe]:  # no list is known to be long: one match is enough
        return tokens[order[: probe + 1]], index + 1, 1
    cost = np.cumsum(np.maximum(weight - 1, 0))
    totals = [cost[probe + k - 1] * (1 + n / 8 / k) + probe + k for k in range(1, most + 1)]
    best = int(np.argmin(totals)) + 1
    return tokens[order[: probe + best]], index + best, best


def sketch(tokens: np.ndarray) -> bytes:
    """Parities of a set's shingles over a power of two of places, at least one for each shingle and 64 in all."""
    places = max(64, 1 << (len(tokens) - 1).bit_length())
    parity = np.bincount((tokens & np.uint64(places - 1)).astype(np.int64), minlength=places) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").tobytes()


def may_link(a: bytes, b: bytes, both: int, similarity: tuple[int, int]) -> bool:
    """False only if two sets of ``both`` shingles together cannot link: places whose parities differ each hold a shingle
    that only one of the sets has. The longer sketch is folded to the length of the shorter."""
    num, den = similarity
    a, b = (a, b) if len(a) >= len(b) else (b, a)
    x, bits = int.from_bytes(a, "little"), 8 * len(a)
    while bits > 8 * len(b):
        bits //= 2
        x = (x >> bits) ^ (x & ((1 << bits) - 1))
    differ = (x ^ int.from_bytes(b, "little")).bit_count()
    return (both - differ) * (num + den) >= 2 * both * num


def prefixes(docs: DataFrame, width: int, similarity: tuple[int, int]) -> DataFrame:
    """``doc_id, node, n, matches, tokens, n_index, sketch`` per document. ``node`` is a hash of the set: documents with equal sets are
    one node. ``tokens`` and ``sketch`` are NULL where the task has given them for the node already, or if the set is empty."""
    table = shingle_counts(docs, width)
    weights = level_weights(table)
    kind = dict(docs.dtypes)["doc_id"]

    @tidy
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = WordHashes(), set()
        for batch in batches:
            made: list[tuple] = []
            for found in shingle_sets(_binary(batch), width, known):
                node = xxhash.xxh3_64_intdigest(found.tobytes()) - (1 << 63)
                row = (node, len(found), None, None, None, None)
                if len(found) and node not in seen:
                    seen.add(node)
                    prefix, n_index, need = prefix_of(found, table, weights, similarity)
                    row = (node, len(found), need, prefix.view(np.int64), n_index, sketch(found))
                made.append(row)
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.int32(), pa.binary())
            columns = [pa.array([row[i] for row in made], t) for i, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], ["doc_id", "node", "n", "matches", "tokens", "n_index", "sketch"])

    schema = f"doc_id {kind}, node long, n int, matches int, tokens array<long>, n_index int, sketch binary"
    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def shared_tokens(rows: DataFrame) -> DataFrame:
    """``token, node, n, matches, indexed, listed``: the prefix shingles that more than one node has; ``listed`` counts them."""
    each = rows.filter("tokens IS NOT NULL").select("node", "n", "matches", "n_index", F.posexplode("tokens").alias("place", "token"))
    one = (
        each.select("token", "node", "n", "matches", (F.col("place") < F.col("n_index")).alias("indexed"))
        .repartition("token").groupBy("token", "node").agg(*[F.max(c).alias(c) for c in ("n", "matches", "indexed")])
    )
    return one.withColumn("listed", F.count("*").over(Window.partitionBy("token"))).filter("listed > 1")


def pair_candidates(shared: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Pairs ``(x, y)`` of nodes, x the larger, that share enough prefix shingles of lists no longer than ``LIST``.

    Pairs that share a shingle of a longer list are left to the blocks.
    """
    num, den = similarity
    short = shared.filter(F.col("listed") <= LIST)
    x = short.select("token", F.col("node").alias("x"), F.col("n").alias("nx"), F.col("matches").alias("mx"))
    y = short.filter("indexed").select("token", F.col("node").alias("y"), F.col("n").alias("ny"), F.col("matches").alias("my"))
    fits = (F.col("ny") < F.col("nx")) | ((F.col("ny") == F.col("nx")) & (F.col("y") < F.col("x")))
    joined = x.join(y, (x["token"] == y["token"]) & fits & (F.col("ny") * den >= F.col("nx") * num))
    grown = joined.groupBy("x", "y").agg(F.count("*").alias("c"), F.max("nx").alias("nx"), F.max("ny").alias("ny"), F.max(F.least("mx", "my")).alias("need"))
    return grown.filter("c >= need").select("x", "y", "nx", "ny")


def filtered(pairs: DataFrame, rows: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """The pairs that their sketches do not rule out."""
    sketches = rows.filter("sketch IS NOT NULL").select("node", "sketch").dropDuplicates(["node"])
    x, y = (sketches.select(F.col("node").alias(k), F.col("sketch").alias(f"s{k}")) for k in "xy")
    held = pairs.join(x, "x").join(y, "y").select("x", "y", (F.col("nx") + F.col("ny")).alias("both"), "sx", "sy")

    @tidy
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch[c].to_pylist() for c in ("sx", "sy", "both"))
            yield batch.select(["x", "y"]).filter(pa.array([may_link(a, b, n, similarity) for a, b, n in zip(*columns)], pa.bool_()))

    return held.mapInArrow(cut, "x long, y long")


def _numbered(nodes: DataFrame, lead: str) -> DataFrame:
    """``node, n, block`` from ``node, n`` and a column by which nodes belong together: cut by number and total size."""
    by_size = Window.partitionBy(lead).orderBy("n", "node")
    nth, filled = F.floor((F.row_number().over(by_size) - 1) / BLOCK_DOCS), F.floor(F.sum("n").over(by_size) / BLOCK_SHINGLES)
    return nodes.select("node", "n", F.xxhash64(F.lit(lead), lead, nth, filled).alias("block"))


def list_blocks(shared: DataFrame) -> DataFrame:
    """Blocks of the nodes of long lists, put together by their longest list."""
    lists = shared.filter(F.col("listed") > LIST)
    lead = lists.groupBy("node").agg(F.max("n").alias("n"), F.max(F.struct("listed", "token")).alias("lead"))
    return _numbered(lead.select("node", "n", F.col("lead.token").alias("token")), "token")


def pair_blocks(pairs: DataFrame, sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Blocks of the nodes that candidate pairs connect, and the pairs of different blocks that hold a candidate."""
    of = stage(_numbered(components(pairs).join(sizes, "node"), "root"), "pair-blocks")
    a, b = (of.select(F.col("node").alias(k), F.col("block").alias(to)) for k, to in (("x", "p"), ("y", "q")))
    across = pairs.join(a, "x").join(b, "y").filter("p <> q")
    return of, across.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()


def block_pairs(shared: DataFrame, of_node: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """``a, b``, a < b: blocks that have a long list in common and sizes that may be similar."""
    num, den = similarity
    sizes = of_node.groupBy("block").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    lists = shared.filter(F.col("listed") > LIST).select("token", "node").join(of_node, "node").select("token", "block").distinct()
    a = lists.select("token", F.col("block").alias("a"))
    b = lists.select("token", F.col("block").alias("b"))
    pairs = a.join(b, (a["token"] == b["token"]) & (F.col("a") < F.col("b"))).select("a", "b").distinct()
    low, high = (sizes.select(F.col("block").alias(k), F.col("low").alias(f"low_{k}"), F.col("high").alias(f"high_{k}")) for k in "ab")
    fit = (F.col("high_a") * den >= F.col("low_b") * num) & (F.col("high_b") * den >= F.col("low_a") * num)
    return pairs.join(low, "a").join(high, "b").filter(fit).select("a", "b")


def linked(sets: list[np.ndarray], side: np.ndarray, similarity: tuple[int, int], columns: int = 4096) -> list[tuple[int, int]]:
    """A spanning forest of the links between sets of side 0 and side 1, or among all where there is one side only."""
    num, den = similarity
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    tokens, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = counts[inverse] > 1
    column = (np.cumsum(counts > 1) - 1)[inverse[common]]
    owner = owner[common]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    one = side.min() == side.max()
    rows, cols = np.arange(len(sets)) if one else np.flatnonzero(side == 0), np.arange(len(sets)) if one else np.flatnonzero(side == 1)
    overlap = np.zeros((len(rows), len(cols)), np.float32)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, columns):
        lo, hi = np.searchsorted(column, [at, at + columns])
        held = np.zeros((len(sets), columns), np.float32)
        held[owner[lo:hi], column[lo:hi] - at] = 1
        overlap += held[rows] @ held[cols].T
    overlap = np.rint(overlap).astype(np.int64)
    union = sizes[rows][:, None] + sizes[cols][None, :] - overlap
    i, j = np.nonzero(den * overlap >= num * union)
    parent = list(range(len(sets)))

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    out = []
    for a, b in zip(rows[i].tolist(), cols[j].tolist()):
        if (ra := root(a)) != (rb := root(b)):
            parent[ra] = rb
            out.append((a, b))
    return out


def _bits(needed: DataFrame) -> np.ndarray:
    """A filter of 2^25 bits on hashes of ``doc_id``: 4 MB at most, however many ids there are."""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 25))
    made = needed.select((place + 1).alias("p")).groupBy(F.bitmap_bucket_number("p").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
    out = np.zeros((1 << 25) // 8, np.uint8)
    for row in made.collect():
        at = (row["k"] - 1) * 4096
        out[at : at + 4096] = np.frombuffer(row["bits"], np.uint8)[: len(out) - at]
    return out


def sets_of(docs: DataFrame, rows: DataFrame, of_node: DataFrame, width: int) -> DataFrame:
    """``block, node, tokens``: the whole sets of the nodes of blocks, made again from one document of each."""
    nodes = of_node.select("node", "block").distinct()
    reps = stage(rows.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("doc_id")), "reps")
    bits = _bits(reps)

    @tidy
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            place = batch["place"].to_numpy()
            batch = batch.filter(pa.array((bits[place >> 3] >> (place & 7)) & 1 == 1))
            found = list(shingle_sets(_binary(batch), width, known))
            nodes = [xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) for s in found]
            sets = pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), sets], ["node", "tokens"])

    placed = docs.select("text", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 25)).alias("place"))
    made = placed.mapInArrow(make, "node long, tokens array<long>").join(nodes, "node")
    return made.dropDuplicates(["node", "block"]).select("block", "node", "tokens")


def verify(sets: DataFrame, across: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Edges ``(x, y)`` that connect what links within the blocks of ``sets`` and across the given pairs of them."""

    def check(unit: pa.Table) -> pa.Table:
        unit = unit.combine_chunks()
        held = [np.asarray(t.values).view(np.uint64) for t in unit["tokens"].chunk(0)]
        nodes = unit["node"].to_numpy()
        pairs = np.array(linked(held, unit["side"].to_numpy(), similarity), np.int64).reshape(-1, 2)
        found = pa.table({"x": nodes[pairs[:, 0]], "y": nodes[pairs[:, 1]]})
        if unit.nbytes > RELEASED_BYTES:
            del unit, held
            release()
        return found

    within = sets.select("block", F.lit(0).alias("side"), "node", "tokens").groupBy("block").applyInArrow(check, "x long, y long")
    sides = [
        across.join(sets, across[side] == sets["block"]).select("a", "b", F.lit(i).alias("side"), "node", "tokens")
        for i, side in enumerate("ab")
    ]
    return within.union(sides[0].union(sides[1]).groupBy("a", "b").applyInArrow(check, "x long, y long"))


def near_duplicates(docs: DataFrame, width: int = WORDS, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs`` (``doc_id, text``; other columns are ignored).

    A document's set holds its different ``width``-word shingles (lower-cased in ASCII, words split at blanks); with fewer
    words the whole sequence is one shingle. Documents link when their sets' Jaccard similarity is at least
    ``similarity``; ``component_id`` is the smallest id that links lead to (NULL ids aside; NULL if there is no other). A
    document without words, or NULL, has no shingles and stands alone. Rows with equal ids are told apart by their sets.

    Every link is found: the prefix filter loses none, and each candidate is verified on whole sets. Equal sets are one
    node. Pairs within long lists are never emitted: their documents are cut into blocks. So are those that candidate
    pairs connect. Blocks, and pairs of blocks, are verified inside a task, and only a spanning forest's edges leave it. Shingles and sets are known by 64-bit hashes.
    """
    rows = stage(prefixes(docs, width, similarity), "prefixes")
    shared = stage(shared_tokens(rows), "shared")
    pairs = stage(filtered(pair_candidates(shared, similarity), rows, similarity), "pairs")
    in_pairs, across_pairs = pair_blocks(pairs, rows.filter("tokens IS NOT NULL").groupBy("node").agg(F.max("n").alias("n")))
    in_lists = stage(list_blocks(shared), "list-blocks")
    across = stage(across_pairs.union(block_pairs(shared, in_lists, similarity)), "across")
    sets = stage(sets_of(docs, rows.select("doc_id", "node"), in_pairs.union(in_lists), width), "sets")
    edges = stage(verify(sets, across, similarity), "links")
    roots = components(edges)
    of = rows.select("doc_id", "node", "n").join(roots, "node", "left")
    of = stage(of.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("root", "node").alias("root")), "members")
    groups = of.filter("n_shingles > 0").groupBy("root").agg(F.min("doc_id").alias("least"), F.count("*").alias("size"))
    several = groups.filter("size > 1").select("root", "least")
    joined = of.join(several, "root", "left")
    alone = F.col("least").isNull() | (F.col("n_shingles") == 0)
    return joined.select("doc_id", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))
