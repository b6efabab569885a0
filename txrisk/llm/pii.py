"""Personal data by fixed rules, and more of it by patterns that are bootstrapped from what the rules find."""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.sources.workspace import stage

KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match ends at the end of a run of digits, so the next can only begin at the start of one: no run is read twice.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")
#: What may be an identifier: a run of digits and separators, a token with an at sign; tokens with a digit count against.
RUN = re.compile(r"[+(]?[0-9][0-9 ().\-/]*+")
TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*")
GROUPS = re.compile(r"[0-9]{1,3}(?:[ .\-][0-9]{1,3}){3}\Z")
TRAILING = ".,;:!?)]}>\"'"
#: Score and number of different identifiers from which a pattern is trusted.
TRUSTED = 0.7
SUPPORT = 4
#: Characters of a word, its last ones, that a pattern holds.
WORD_END = 48
WORD = re.compile(r"\S+")
#: Longer values are compared by digest.
LONG = 128


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of the whole pattern, sought from each at sign: what stands before it cannot hold another."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of everything that the fixed rules find, in order; in code points."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            if m.end() - m.start() <= 37 and 14 <= len(digits := NOT_DIGIT.sub("", m[0])) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def _patterns(text: str, starts: list[int]) -> Iterator[list[str]]:
    """For each of ascending places the last two words before it, and the last one, lower-cased and with 0 for digits; only if they
    hold a letter. A place in a word has the part of it that stands before; the text is read once."""
    words, near = WORD.finditer(text), deque(maxlen=2)
    word = next(words, None)
    for start in starts:
        while word and word.end() <= start:
            near.append(text[max(word.start(), word.end() - WORD_END) : word.end()])
            word = next(words, None)
        part = [text[max(word.start(), start - WORD_END) : start]] if word and word.start() < start else []
        last = [DIGIT.sub("0", w.lower()) for w in [*near, *part][-2:]]
        made = {" ".join(last), last[-1]} if last else ()
        yield sorted(p for p in made if any(map(str.isalpha, p)))


def _fits(value: str) -> list[int]:
    """Numbers of the kinds whose shape, read loosely, a value has."""
    if "@" in value:
        left, _, right = value.partition("@")
        return [0] if left and right and "@" not in right else []
    n = len(NOT_DIGIT.sub("", value))
    out = [1] if GROUPS.match(value) else []
    return out + ([2] if 12 <= n <= 19 else []) + ([3] if 7 <= n <= 15 else [])


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, str, int | None, list[int], list[str]]]:
    """``(start, end, value, seed kind, kinds that fit, patterns)``: what the rules found, and everything else with a digit or
    an at sign; places that overlap are given once, the rules' first."""
    if not base and "@" not in text and not DIGIT.search(text):
        return []
    held = [(a, b, k) for a, k, b in base]
    for m in RUN.finditer(text):
        value = m[0].rstrip(" ().-/")
        if len(value) >= 7:
            held.append((m.start(), m.start() + len(value), None))
    for m in TOKEN.finditer(text):
        held.append((m.start(), m.start() + len(m[0].rstrip(TRAILING)), None))
    apart, end = [], 0
    for a, b, kind in sorted(held, key=lambda x: (x[0], x[2] is None, -x[1])):
        if a >= end and b > a:
            apart.append((a, b, kind))
            end = b
    out = []
    for (a, b, kind), patterns in zip(apart, _patterns(text, [a for a, _, _ in apart])):
        value = text[a:b].lower()
        fits = _fits(value)
        out.append((a, b, hashlib.md5(value.encode()).hexdigest() if b - a > LONG else value, kind, fits, patterns))
    return out


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, digest, base, found`` per document: what the rules find, and the candidates with their patterns."""
    kind = dict(docs.dtypes)["doc_id"]
    span = "array<struct<start:int,kind:int,end:int>>"
    found = "array<struct<start:int,end:int,value:string,seed:int,fits:array<int>,patterns:array<string>>>"
    base_type = pa.list_(pa.struct([(n, pa.int32()) for n in ("start", "kind", "end")]))
    found_type = pa.list_(
        pa.struct([("start", pa.int32()), ("end", pa.int32()), ("value", pa.string()), ("seed", pa.int32()), ("fits", pa.list_(pa.int32())), ("patterns", pa.list_(pa.string()))])
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bases, founds = [], []
            for held in batch["text"]:
                text = held.as_py() or ""
                spans = base_spans(text)
                bases.append([dict(zip(("start", "kind", "end"), s)) for s in spans])
                founds.append([dict(zip(("start", "end", "value", "seed", "fits", "patterns"), c)) for c in candidates(text, spans)])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["digest"], pa.array(bases, base_type), pa.array(founds, found_type)], ["doc_id", "digest", "base", "found"]
            )

    keyed = docs.select("doc_id", F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("digest"), "text")
    return keyed.mapInArrow(read, f"doc_id {kind}, digest binary, base {span}, found {found}")


def _figures(trusted: DataFrame) -> tuple:
    """Equal for equal tables of patterns and scores, and for different ones only by an unlikely chance."""
    return tuple(trusted.agg(F.count("*"), F.bit_xor(F.xxhash64("pattern", "kind", "score"))).first())


def bootstrap(edges: DataFrame) -> DataFrame:
    """``pattern, kind, score`` of the trusted patterns, from the graph of patterns and values.

    ``edges`` has one row ``pattern, value, seed, fits`` per pair. A pattern's score for a kind is the sum of its values'
    confidences over the number of its different values, of any kind or none. A seed's confidence is 1 for its kind and 0 for others;
    another value has the chance that at least one of its trusted patterns is right. Each round is two sums, joined by
    pattern and by value; rounds write their trusted patterns, and go
    on until neither these nor their scores (to 9 digits) change. They end, as scores only ever rise.
    """
    totals = edges.groupBy("pattern").agg(F.count("*").alias("values")).filter(F.col("values") >= SUPPORT)
    seeds = edges.filter("seed IS NOT NULL").select("pattern", "value", F.col("seed").alias("kind"), F.lit(1.0).alias("confidence"))
    others = edges.filter("seed IS NULL").select("pattern", "value", F.explode("fits").alias("kind"))
    trusted, before = None, None
    while True:
        sure = seeds
        if trusted is not None:
            learned = others.join(trusted, ["pattern", "kind"]).groupBy("value", "kind")
            learned = learned.agg((1 - F.exp(F.sum(F.log(1.0000001 - F.col("score"))))).alias("confidence"))
            sure = seeds.union(others.join(learned, ["value", "kind"]).select("pattern", "value", "kind", "confidence"))
        scored = sure.groupBy("pattern", "kind").agg(F.sum("confidence").alias("sum"), F.sum((F.col("confidence") >= TRUSTED).cast("int")).alias("support"))
        scored = scored.filter(F.col("support") >= SUPPORT).join(totals, "pattern")
        scored = scored.select("pattern", "kind", F.round(F.col("sum") / F.col("values"), 9).alias("score")).filter(F.col("score") >= TRUSTED)
        trusted = stage(scored, "patterns")
        after = _figures(trusted)
        if after == before or not after[0]:
            return trusted
        before = after


def find_personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` for every row of ``docs`` (``doc_id, text``).

    The counts and ``base_sha256`` concern the fixed rules' spans, written ``kind:start:end`` by start, then kind, joined by
    commas. ``spans`` has these and the learned ones in the same form: values that have a kind's shape, overlap no rule's span and
    follow a pattern trusted for the kind (the best one, then the first kind). Places are code points, ends exclusive. NULL is an
    empty text; other columns are ignored. Patterns come from all documents; equal texts count once for each pair of
    pattern and value, however often they are repeated.

    One pass over the texts; what follows works on the candidates only. Pairs are summed before each shuffle, and a
    pattern's occurrences are joined, not gathered.
    """
    rows = stage(scan(docs), "scanned")
    each = rows.select("digest", F.explode("found").alias("c")).select("digest", "c.*")
    pairs = each.select(F.explode("patterns").alias("pattern"), "value", "seed", "fits")
    edges = stage(pairs.groupBy("pattern", "value").agg(F.min("seed").alias("seed"), F.first("fits").alias("fits")), "edges")
    trusted = bootstrap(edges)
    open_ = each.filter("seed IS NULL AND size(fits) > 0").select("digest", "start", "end", "fits", F.explode("patterns").alias("pattern"))
    told = open_.join(trusted, "pattern").filter(F.array_contains("fits", F.col("kind")))
    best = told.groupBy("digest", "start", "end").agg(F.min(F.struct((-F.col("score")).alias("s"), "kind")).alias("best"))
    more = best.groupBy("digest").agg(F.collect_list(F.struct("start", F.col("best.kind").alias("kind"), "end")).alias("more"))
    joined = rows.select("doc_id", "digest", "base").join(more, "digest", "left")
    names = F.array(*map(F.lit, KINDS))

    def written(spans):
        return F.concat_ws(",", F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])))

    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, i))).cast("long").alias(f"n_{kind}") for i, kind in enumerate(KINDS)]
    everything = F.when(F.col("more").isNull(), F.col("base")).otherwise(F.concat("base", "more"))
    return joined.select("doc_id", *counts, F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(everything).alias("spans"))
