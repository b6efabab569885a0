"""The prefix trie against rebuilding every conversation, and the arithmetic of fingerprints against Python's."""

from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from txrisk.llm import fingerprint as fp
from txrisk.llm.prefix_trie import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows, plan):
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of all nodes."""
    told = lambda r, x: hashlib.sha256((hashlib.sha256(r.encode()).hexdigest() + x).encode()).digest()
    stored = collections.defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            stored[c].append((t is not None, t or 0, told(r or "", x or ""), r or "", x or ""))
    stored = {c: [s[3:] for s in sorted(found)] for c, found in stored.items()}
    rebuilt = {c: tuple(stored.get(plan[c][0], [])[: plan[c][1]] + own[plan[c][1] :]) for c, own in stored.items()}
    members = collections.defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children, leaves, saved = collections.Counter(), collections.Counter(), collections.Counter()
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, convs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(convs) - 1) * (len(node[-1][1]) if node else 0)
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(rebuilt[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), parent, len(convs), children[node], leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def made(spark, rows, plan, **more):
    turns = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("told", "k", "depth", "f1", "base", "row")})
    plans = spark.createDataFrame([(c, b, h) for c, (b, h) in plan.items()], "conv_id long, base long, head long")
    return sorted(map(tuple, prefix_trie(turns, plans, **more).collect()), key=str)


def conversations(seed, n=60):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-50, 5000), n):
        for t in range(rng.choice([1, 1, 2, 3, 5, 8])):
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "user", None, ""]), rng.choice(["a", "a", "ab", "é", "", None, "b\nc"])))
    ids = sorted({r[0] for r in rows})
    return rows, {c: (rng.choice([*ids[:4], 10**6, None]), rng.randrange(0, 7)) for c in ids}


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_trie_equals_rebuilt_texts(spark, coalesce):
    rows, plan = conversations(1)
    rows += [(None, 0, "user", "nobody's"), (6000, 1, "user", "word " * 60_000)]
    long = [(c, t, "user", f"turn {t % 50}" if t < 700 or c == 7000 else "other") for c in (7000, 7001) for t in range(900)]
    plan |= {6000: (None, 0), 7000: (7000, 0), 7001: (7000, 3)}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        assert made(spark, rows + long, plan) == brute(rows + long, plan)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_equal_conversations_and_no_turns_at_all(spark):
    rows = [(c, 0, "user", "same") for c in range(3, 9000, 2)] + [(2, 0, "user", "only")] * 2
    plan = {c: (c, 0) for c in range(3, 9000, 2)} | {2: (None, 5)}
    found = made(spark, rows, plan)
    assert found == brute(rows, plan) and len(found) == 2
    assert made(spark, [], {}) == []


def test_colliding_fingerprints_are_found_and_tried_again(spark):
    rows = [(c, t, "user", x) for c, said in ((1, "abc"), (2, "bac"), (3, "abd")) for t, x in enumerate(said)]
    plan = {c: (None, 0) for c in (1, 2, 3)}
    sums = (1, 1)  # with point 1 a fingerprint is a sum, which does not see order
    assert made(spark, rows, plan, points=[sums, fp.POINTS[0]]) == brute(rows, plan)
    with pytest.raises(ValueError):
        made(spark, rows, plan, points=[sums])


def test_arithmetic():
    rng = random.Random(2)
    edge = [0, 1, 2, fp.P - 1, fp.P - 2, 1 << 60, (1 << 31) - 1, 1 << 31]
    a, b = ([*edge, *(rng.randrange(fp.P) for _ in range(200))] for _ in range(2))
    pairs = [(x, y) for x in a[:20] for y in b]
    x, y = (np.array(v, np.uint64) for v in zip(*pairs))
    assert fp.times(x, y).tolist() == [p * q % fp.P for p, q in pairs]
    assert fp.plus(x, y).tolist() == [(p + q) % fp.P for p, q in pairs]
    assert fp.minus(x, y).tolist() == [(p - q) % fp.P for p, q in pairs]
    assert fp.powers(fp.POINTS[0][0], np.arange(300)).tolist() == [pow(fp.POINTS[0][0], k, fp.P) for k in range(300)]
    symbols = np.array([rng.randrange(fp.P) for _ in range(500)], np.uint64)
    run_at = np.concatenate([np.arange(1, n + 1) for n in (1, 1, 250, 248)])
    expected, now = [], 0
    for symbol, at in zip(symbols.tolist(), run_at):
        now = ((0 if at == 1 else now) * fp.POINTS[1][0] + symbol) % fp.P
        expected.append(now)
    assert fp.prefixes(symbols, run_at, fp.POINTS[1][0]).tolist() == expected
