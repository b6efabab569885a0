"""Registered queries against SQL, and against brute force where SQL cannot say it."""

from __future__ import annotations

import collections
import hashlib
import re
import zlib

import pytest

import corpus_pipeline
from txrisk.llm import oracle, pii
from txrisk.llm.queries import queries
from txrisk.sources.workspace import stage
from verification.compare import database, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return database(SF)


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_matches_sql(spark, duck, name):
    _, problems = differences(queries()[name](spark, SF), duck, oracle.oracle_sql()[name])
    assert not problems


def test_language_is_right_on_held_out_documents(spark, duck):
    true = dict(duck.sql("SELECT doc_id, lang FROM documents").fetchall())
    rows = queries()["op1_language_id"](spark, SF).collect()
    assert len(rows) == len(true)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in true if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r.lang_pred == true[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_quality_separates_held_out_documents(spark, duck):
    label = dict(duck.sql("SELECT doc_id, quality FROM labels").fetchall())
    rows = queries()["op2_quality"](spark, SF).collect()
    assert len(rows) == duck.sql("SELECT count(*) FROM documents").fetchall()[0][0]
    held = [r for r in rows if r.held_out and r.doc_id in label]
    good, bad = ([r.score for r in held if label[r.doc_id] == y] for y in (1, 0))
    pairs = [(a > b) + (a == b) / 2 for a in good for b in bad]
    assert sum(pairs) >= 0.8 * len(pairs)
    assert all(r.predicted == (r.score >= 0.3) for r in rows)


RULES = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m, d: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m, d: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m, d: 14 <= len(d) <= 19 and pii.luhn(d)),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m, d: 10 <= len(d) <= 15),
]


def test_personal_data_rules(spark, duck):
    rows = {r.doc_id: r for r in queries()["op4_pii"](spark, SF).collect()}
    for doc_id, text in duck.sql("SELECT doc_id, text FROM documents").fetchall():
        found = [
            (m.start(), k, m.end())
            for k, (_, rule, holds) in enumerate(RULES)
            for m in re.finditer(rule, text or "")
            if holds(m[0], re.sub("[^0-9]", "", m[0]))
        ]
        spans = [f"{RULES[k][0]}:{a}:{b}" for a, k, b in sorted(found)]
        row = rows[doc_id]
        assert row.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == tuple(sum(k == i for _, k, _ in found) for i in range(4))
        assert set(spans) <= {*row.spans.split(",")} | {""}


def brute_repeats(texts: dict[int, str | None], length: int) -> dict[int, tuple]:
    data = {i: (t or "").encode() for i, t in texts.items()}
    seen = collections.Counter(b[s : s + length] for b in data.values() for s in range(len(b) - length + 1))
    out = {}
    for i, b in data.items():
        cover = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] > 1:
                cover[s : s + length] = b"\1" * length
        kept = bytes(x for x, c in zip(b, cover) if not c)
        out[i] = (len(b), sum(cover), len(re.findall(b"\1+", bytes(cover))), hashlib.sha256(kept).hexdigest())
    return out


def test_suffix_dedup_is_brute_force(spark, duck):
    want = brute_repeats(dict(duck.sql("SELECT doc_id, text FROM documents").fetchall()), 400)
    got = {r[0]: tuple(r)[1:] for r in queries()["op8_suffix_dedup"](spark, SF).collect()}
    assert got == want


def test_pipeline_keeps_what_its_stages_keep(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs.count()
    for _, step in corpus_pipeline.STAGES[:-1]:
        kept = stage(step(spark, docs, SF), "stage")
        assert kept.columns == docs.columns and kept.subtract(docs).isEmpty()
        docs = kept
    assert 0.7 * before < docs.count() < before
    last = corpus_pipeline.run(spark, SF)
    assert last.columns == [*docs.columns, "copy"] and last.select("doc_id").subtract(docs.select("doc_id")).isEmpty()
