"""Quality scores from how much better a text compresses with a dictionary of good text than with one of bad text."""

from __future__ import annotations

import math
import random
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.llm.tables import extended
from txrisk.sources.workspace import stage

#: Bounds of what is learned from: labelled documents of each class, and blocks from all over each that make a dictionary.
TRAIN_DOCS = 3000
DICTIONARY_BYTES = 1 << 16
SAMPLE_BLOCKS = 8
#: Texts are compressed in blocks, so that a long text cannot serve as its own dictionary.
BLOCK_BYTES = 1 << 11
LEVEL = 3
THRESHOLD = 0.3


@dataclass
class Model:
    good: bytes
    bad: bytes
    slope: float
    offset: float


def blocks(text: bytes, size: int = BLOCK_BYTES) -> list[bytes]:
    """The whole text in blocks of about equal length."""
    n = max(1, -(-len(text) // size))
    return [text[len(text) * i // n : len(text) * (i + 1) // n] for i in range(n)]


def some_blocks(text: bytes, wanted: int = SAMPLE_BLOCKS, size: int = BLOCK_BYTES) -> list[bytes]:
    """All :func:`blocks` of a text, or ``wanted`` of them from all over it, chosen by its hash."""
    n = max(1, -(-len(text) // size))
    chosen = range(n) if n <= wanted else sorted(random.Random(zlib.crc32(text)).sample(range(n), wanted))
    return [text[len(text) * i // n : len(text) * (i + 1) // n] for i in chosen]


class Compressor:
    """Compressed sizes with one dictionary, which is digested once."""

    def __init__(self, content: bytes):
        held = zstandard.ZstdCompressionDict(content)
        held.precompute_compress(level=LEVEL)
        options = {"write_checksum": False, "write_content_size": False, "write_dict_id": False}
        self.made = zstandard.ZstdCompressor(dict_data=held, level=LEVEL, **options)

    def size(self, parts: list[bytes]) -> int:
        return sum(len(self.made.compress(p)) for p in parts)


def gain(text: bytes, good: Compressor, bad: Compressor) -> float:
    """How many bytes the dictionary of good text saves against the other, per compressed byte; 0 for an empty text."""
    if not text:
        return 0.0
    parts = blocks(text)
    with_good, with_bad = good.size(parts), bad.size(parts)
    return (with_bad - with_good) / max(with_good, with_bad)


def dictionary(found: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary of at most ``size`` bytes: trained, or the end of the blocks themselves where they are too few to train."""
    samples = [b for b in found if len(b) >= 8]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(samples)[-size:] or b"        "


def calibrate(gains: np.ndarray, good: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """Slope and offset of a logistic curve from gains to the chance of label 1, by Newton steps with a slight penalty."""
    x = np.stack([gains, np.ones_like(gains)], 1)
    w = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (good - p) - 1e-3 * w)
        w += np.clip(step, -20, 20)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def divide(labels: list[int]) -> tuple[list[int], list[int]]:
    """Which rows make the dictionaries, three in four, and which the curve: the fourth (all if a part lacks a class)."""
    every = list(range(len(labels)))
    parts = [i for i in every if i % 4], every[::4]
    seen, unseen = (p if len({labels[i] for i in p}) == 2 else every for p in parts)
    return seen, unseen


def dictionaries(rows: list[tuple[list[bytes], int]]) -> tuple[bytes, bytes]:
    """Of good and of bad text, from ``(blocks, label)`` rows."""
    good, bad = (dictionary([b for held, y in rows if y == label for b in held]) for label in (1, 0))
    return good, bad


def train(rows: list[tuple[bytes, int]]) -> Model | None:
    """A model of ``(text, label)`` rows in a fixed order; None if a class is absent. Dictionaries are made from three rows
    in four and the curve is fitted on the fourth, which the dictionaries have not seen (on all if it lacks a class)."""
    rows = [r for r in rows if r[0]]
    if len({label for _, label in rows}) < 2:
        return None
    seen, unseen = divide([label for _, label in rows])
    good, bad = dictionaries([(some_blocks(rows[i][0]), rows[i][1]) for i in seen])
    with_good, with_bad = Compressor(good), Compressor(bad)
    gains = np.array([gain(rows[i][0], with_good, with_bad) for i in unseen])
    return Model(good, bad, *calibrate(gains, np.array([float(rows[i][1]) for i in unseen])))


def sample(docs: DataFrame, labels: DataFrame, per_class: int = TRAIN_DOCS) -> DataFrame:
    """``h, doc_id, digest, text, quality`` of at most ``per_class`` labelled documents of each class, chosen by a hash of their id.

    ``docs`` has ``doc_id, text``, ``labels`` has ``doc_id, quality``; rows with a NULL or an empty text and qualities other than
    0 and 1 are left out. The chosen ids are bounded, so they are broadcast; the whole texts are written to the shared folder.
    """
    known = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).filter("doc_id IS NOT NULL")
    order = [F.xxhash64("doc_id", F.lit(11)), "doc_id"]
    first, second = (known.filter(F.col("quality") == y).distinct().orderBy(*order).limit(per_class) for y in (0, 1))
    texts = docs.select("doc_id", "text").filter("text <> ''").join(F.broadcast(first.union(second)), "doc_id")
    return stage(texts.select(F.xxhash64("doc_id").alias("h"), "doc_id", F.unhex(F.md5("text")).alias("digest"), "text", "quality"), "sample")


def prior_shift(labels: DataFrame, per_class: int = TRAIN_DOCS) -> float:
    """What the curve's offset lacks where :func:`sample` takes a smaller share of one class than of the other: the log ratio of
    the shares. 0 where no class has more than ``per_class`` ids."""
    known = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).filter("doc_id IS NOT NULL").distinct()
    counts = {r["quality"]: r["n"] for r in known.filter("quality IN (0, 1)").groupBy("quality").agg(F.count("*").alias("n")).collect()}
    more = {y: math.log(max(1.0, counts.get(y, 0) / per_class)) for y in (0, 1)}
    return more[1] - more[0]


def learn(docs: DataFrame, labels: DataFrame, per_class: int = TRAIN_DOCS) -> Model | None:
    """The model that :func:`train` makes of the texts of :func:`sample`, which stay in Spark tasks.

    To the driver come up to ``SAMPLE_BLOCKS`` blocks of 2 KiB from all over each text for the dictionaries, and for the curve the
    gain of each whole text that the dictionaries have not seen. Scores have the level of the classes' true counts, see :func:`prior_shift`. Rows with a NULL
    and qualities other than 0 and 1 are left out, an id with both counts as both, one that repeats in ``labels`` once. At most ``4 * per_class`` rows take part, the first by the
    hash of the id (ids may repeat in ``docs``).
    """
    rows, key = sample(docs, labels, per_class), ("h", "doc_id", "digest", "quality")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [some_blocks(t.as_py()) for t in batch["text"].cast(pa.large_binary())]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in key), pa.array(made, pa.list_(pa.binary()))], [*key, "blocks"])

    found = rows.mapInArrow(cut, extended(rows, key, "blocks array<binary>")).orderBy(*key).limit(4 * per_class).collect()
    labels_ = [r["quality"] for r in found]
    if len(set(labels_)) < 2:
        return None
    seen, unseen = divide(labels_)
    good, bad = dictionaries([([bytes(b) for b in found[i]["blocks"]], labels_[i]) for i in seen])
    wanted = {(found[i]["doc_id"], bytes(found[i]["digest"]), labels_[i]) for i in unseen}

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with_good, with_bad = Compressor(good), Compressor(bad)
        for batch in batches:
            keys = zip(*(batch[c].to_pylist() for c in key[1:]))
            some = batch.take(pa.array([i for i, k in enumerate(keys) if k in wanted], pa.int64()))
            gains = [gain(t.as_py(), with_good, with_bad) for t in some["text"].cast(pa.large_binary())]
            yield pa.RecordBatch.from_arrays([*(some[c] for c in key), pa.array(gains, pa.float64())], [*key, "gain"])

    # rows that agree in id, text and label count once
    rated = rows.mapInArrow(rate, extended(rows, key, "gain double")).distinct().select("quality", "gain").collect()
    rated = sorted((r["quality"], r["gain"]) for r in rated)
    slope, offset = calibrate(np.array([g for _, g in rated]), np.array([float(y) for y, _ in rated]))
    return Model(good, bad, slope, offset + prior_shift(labels, per_class))


def score(docs: DataFrame, model: Model | None, keep: tuple[str, ...] = ("doc_id",), threshold: float = THRESHOLD) -> DataFrame:
    """``score, predicted, gain`` beside the columns ``keep`` of ``docs``, from its column ``text`` alone.

    The whole text is compressed, in blocks of 2 KiB, with both dictionaries. ``score`` (0 to 1) is the calibrated chance
    of label 1. Empty and NULL texts have gain 0; without a model every score is 0.5. One pass without a shuffle.
    """
    kept = docs.select(*keep, "text")

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good, bad = (Compressor(model.good), Compressor(model.bad)) if model else (None, None)
        for batch in batches:
            texts = batch["text"].cast(pa.large_binary())
            gains = np.array([gain(t.as_py() or b"", good, bad) if model else 0.0 for t in texts], float)
            scores = 1 / (1 + np.exp(-np.clip(model.slope * gains + model.offset, -30, 30))) if model else gains + 0.5
            made = [pa.array(scores), pa.array((scores >= threshold).astype(np.int32)), pa.array(gains)]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in keep), *made], [*keep, "score", "predicted", "gain"])

    return kept.mapInArrow(rate, extended(kept, keep, "score double, predicted int, gain double"))
