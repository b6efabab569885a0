"""Finding passages of benchmarks in training documents with an FM-index per shard of documents."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.llm.fm_index import FMIndex
from txrisk.llm.memory import tidy
from txrisk.llm.tables import column, extended

#: Words are runs of digits, letters a to z (of either case) and characters beyond ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
WINDOW = 13
#: A document is contaminated if at least one of ``SHARE`` of its words stands in a window.
SHARE = 20
#: Bytes of text in a shard (a longer text is a shard of its own), of a piece that is split into words, and of benchmark
#: texts that are searched together.
SHARD_BYTES = 1 << 22
PIECE_BYTES = 1 << 20
PHRASE_BYTES = 1 << 25


def words(text: bytes) -> Iterator[list[bytes]]:
    """The words of a whole UTF-8 text, lower-cased in ASCII, piece by piece; pieces are cut at a blank or line end."""
    at = 0
    while at < len(text):
        end = min(len(text), at + PIECE_BYTES)
        while end < len(text) and WORD.match(text[end : end + 1].lower()):  # not inside a word
            end += 1
        yield WORD.findall(text[at:end].lower())
        at = end


@dataclass
class Phrases:
    """Items of a benchmark as one array of word numbers from 2 up, cut by ``ends``."""

    names: list[str] = field(default_factory=list)
    numbers: dict[bytes, int] = field(default_factory=dict)
    ids: list[np.ndarray] = field(default_factory=list)
    size: int = 0

    def add(self, name: str, text: str) -> None:
        found = [w for piece in words(text.encode()) for w in piece]
        if found:
            self.names.append(name)
            self.ids.append(np.array([self.numbers.setdefault(w, len(self.numbers) + 2) for w in found], np.int32))
            self.size += len(text)

    def windows(self, width: int, block: int = 1 << 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of windows of equal length, with the item of each."""
        by_length: dict[int, list[int]] = {}
        for i, ids in enumerate(self.ids):
            by_length.setdefault(min(width, len(ids)), []).append(i)
        for length, items in by_length.items():
            held: list[np.ndarray] = []
            owners: list[np.ndarray] = []
            for i in items:
                held.append(np.lib.stride_tricks.sliding_window_view(self.ids[i], length))
                owners.append(np.full(len(held[-1]), i))
                if sum(map(len, held)) >= block:
                    yield np.concatenate(held).astype(np.int64), np.concatenate(owners)
                    held, owners = [], []
            if held:
                yield np.concatenate(held).astype(np.int64), np.concatenate(owners)


def read_phrases(benchmark: DataFrame, limit: int = PHRASE_BYTES) -> list[Phrases]:
    """The benchmark in parts of about ``limit`` characters (at least one part). NULL ids are named ``null``."""
    parts = [Phrases()]
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")), F.coalesce("text", F.lit("")))
    for name, text in rows.toLocalIterator():
        if parts[-1].size >= limit:
            parts.append(Phrases())
        parts[-1].add(name, text)
    return parts


def search(texts: list[bytes], phrases: Phrases, width: int) -> tuple[np.ndarray, list[np.ndarray], list[set[str]]]:
    """Number of words, merged hit spans (starts and ends in words) and item names of the texts of a shard.

    Only stretches of benchmark vocabulary at least as long as the shortest window enter the index, each followed by a
    separator: nothing else can hold an occurrence.
    """
    number = phrases.numbers.get
    ids = [np.concatenate([np.fromiter((number(w, 0) for w in p), np.int32, len(p)) for p in words(t)] or [np.zeros(0, np.int32)]) for t in texts]
    sizes = np.array([len(x) for x in ids], np.int64)
    spans: list[np.ndarray] = [np.zeros((0, 2), np.int64) for _ in texts]
    items: list[set[str]] = [set() for _ in texts]
    if not phrases.ids or not sizes.sum():
        return sizes, spans, items
    line = np.concatenate([np.append(x, 0) for x in ids])  # a 0 ends every text
    doc_at = np.cumsum(sizes + 1) - (sizes + 1)
    known = np.concatenate([[0], (line > 0).astype(np.int8), [0]])
    edges = np.diff(known)
    begins, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    least = min(width, min(map(len, phrases.ids)))
    long = ends - begins >= least
    begins, lengths = begins[long], (ends - begins)[long]
    if not len(begins):
        return sizes, spans, items
    run_at = np.cumsum(lengths + 1) - (lengths + 1)
    symbols = np.ones(int((lengths + 1).sum()), np.int64)
    inside = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    symbols[np.repeat(run_at, lengths) + inside] = line[np.repeat(begins, lengths) + inside]
    index = FMIndex(symbols)
    marks = np.zeros(len(line) + 1, np.int64)
    for patterns, owners in phrases.windows(width):
        for which, place in index.find(patterns):
            run = np.searchsorted(run_at, place, side="right") - 1
            start = begins[run] + place - run_at[run]
            marks += np.bincount(start, minlength=len(marks)) - np.bincount(start + patterns.shape[1], minlength=len(marks))
            doc = np.searchsorted(doc_at, start, side="right") - 1
            for d, i in np.unique(np.stack([doc, owners[which]]), axis=1).T.tolist():
                items[d].add(phrases.names[i])
    hit = np.concatenate([[0], (np.cumsum(marks)[:-1] > 0).astype(np.int8), [0]])
    edges = np.diff(hit)
    merged = np.stack([np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)], 1)
    doc = np.searchsorted(doc_at, merged[:, 0], side="right") - 1
    for d in np.unique(doc):
        spans[d] = merged[doc == d] - doc_at[d]
    return sizes, spans, items


def _shards(texts: list[bytes]) -> Iterator[slice]:
    at, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > SHARD_BYTES:
            yield slice(at, i)
            at, size = i, 0
        size += len(text)
    if at < len(texts):
        yield slice(at, len(texts))


def contamination(docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ("doc_id",), width: int = WINDOW, text: str = "text") -> DataFrame:
    """``n_words, n_hit, n_items, items_sha256, contaminated, spans`` beside the columns ``keep`` of ``docs``.

    ``docs`` has ``text`` (or a struct with it in ``keep``: ``row.text``), ``benchmark`` has ``item_id, text``. A window is ``width`` consecutive words of an item, or all
    words of a shorter item; items without words have none. ``n_hit`` counts the document's words inside an occurrence of a
    window, ``spans`` holds the merged runs of such words as (start, end) in words, ``n_items`` the items whose windows
    occur. A document is contaminated if ``n_hit > 0`` and ``20 * n_hit >= n_words``. NULL texts have no words. Without
    benchmark items nothing is hit.

    One pass over the documents without a shuffle. A task indexes 4 MB of text at a time. The benchmark goes to the tasks
    in parts of 32 MB, one step of the same pass for each.
    """
    parts = read_phrases(benchmark)
    counts = ["n_words long", "n_hit long", "n_items long", "items_sha256 string", "contaminated boolean"]
    carried = ["spans array<array<int>>", "__items array<string>"]
    apart = [] if "." in text else [text]
    now = docs.select(*keep, *apart)

    def step(phrases: Phrases, first: bool, last: bool):
        @tidy
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = [t or b"" for t in column(batch, text).cast(pa.large_binary()).to_pylist()]
                n_words, spans, items = [], [], []
                for shard in _shards(texts):
                    a, b, c = search(texts[shard], phrases, width)
                    n_words += a.tolist()
                    spans += [x.tolist() for x in b]
                    items += c
                if not first:
                    spans = [merge(a + b) for a, b in zip(spans, batch["spans"].to_pylist())]
                    items = [a | set(b) for a, b in zip(items, batch["__items"].to_pylist())]
                made = {c: batch[c] for c in keep}
                if last:
                    n_hit = [sum(b - a for a, b in x) for x in spans]
                    made["n_words"] = pa.array(n_words, pa.int64())
                    made["n_hit"] = pa.array(n_hit, pa.int64())
                    made["n_items"] = pa.array([len(x) for x in items], pa.int64())
                    made["items_sha256"] = pa.array([hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in items], pa.string())
                    made["contaminated"] = pa.array([h > 0 and SHARE * h >= n for h, n in zip(n_hit, n_words)], pa.bool_())
                else:
                    made |= {c: batch[c] for c in apart}
                    made["__items"] = pa.array([sorted(x) for x in items], pa.list_(pa.string()))
                made["spans"] = pa.array(spans, pa.list_(pa.list_(pa.int32())))
                yield pa.RecordBatch.from_pydict(made)

        return run

    for i, phrases in enumerate(parts):
        last = i == len(parts) - 1
        made = counts + carried[:1] if last else [*(f"{c} string" for c in apart), carried[1], carried[0]]
        now = now.mapInArrow(step(phrases, i == 0, last), extended(now, keep, ", ".join(made)))
    return now


def merge(spans: list[list[int]]) -> list[list[int]]:
    """Overlapping or touching spans as one, in order."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out
