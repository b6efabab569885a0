"""Conversation repair against brute force: all edit sequences of short conversations, a table of states for long ones."""

from __future__ import annotations

import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from txrisk.llm import branch_bound, structure_repair
from txrisk.llm.queries import queries

LEGAL = re.compile(r"(s?(ua)+)?")


def every_edit(rows: str):
    """All audits whose roles are legal, with their costs; at most three insertions in a row."""

    def go(at, audit, cost, roles):
        if at == len(rows) and LEGAL.fullmatch(roles):
            yield cost, audit
        if not audit.endswith("III"):
            for role in "ua":
                yield from go(at, audit + "I", cost + 3, roles + role)
        if at < len(rows):
            row = rows[at]
            yield from go(at + 1, audit + "D", cost + 4, roles)
            if not row.isdigit():
                more = 3 * row.isupper()
                yield from go(at + 1, audit + "K", cost + more, roles + row.lower())
                for role in "ua":
                    yield from go(at + 1, audit + "R", cost + 3 + more, roles + role)

    return go(0, "", 0, "")


def by_table(rows: str):
    """The same for long conversations: the least (cost, audit) after each row and state."""
    best = {"": (0, "")}

    def insert(now):
        for _ in range(3):
            for state, (cost, audit) in list(now.items()):
                due = "a" if state == "u" else "u"
                now[due] = min(now.get(due, (10**9, "")), (cost + 3, audit + "I"))

    insert(best)
    for row in rows:
        after = {}
        for state, (cost, audit) in best.items():
            due = "a" if state == "u" else "u"
            ways = [(state, 4, "D")]
            if not row.isdigit():
                more = 3 * row.isupper()
                ways.append((due, 3 + more, "R"))
                if row.lower() == due or (row.lower() == "s" and state == ""):
                    ways.append((row.lower(), more, "K"))
            for to, more, edit in ways:
                after[to] = min(after.get(to, (10**9, "")), (cost + more, audit + edit))
        insert(after)
        best = after
    return min(best[s] for s in ("", "a") if s in best)


def test_short_conversations_equal_all_edits():
    for rows in map("".join, itertools.chain(*(itertools.product("suaxSU1", repeat=n) for n in range(3)))):
        assert branch_bound.solve(rows) == min(every_edit(rows)) == by_table(rows), rows
    rng = random.Random(3)
    for _ in range(25):
        rows = "".join(rng.choices("suaxSUAX1234", k=3))
        assert branch_bound.solve(rows) == min(every_edit(rows)) == by_table(rows), rows


def test_long_conversations_equal_the_table_and_few_nodes_are_expanded():
    rng = random.Random(4)
    kinds = ["suax", "ua", "u", "S", "uX", "sSuUaAxX1234", "1", "ssuaa"]
    for n in (1, 7, 31, 32, 33, 64, 65, 150):
        for kind in kinds:
            rows = "".join(rng.choices(kind, k=n))
            assert branch_bound.solve(rows) == by_table(rows), rows
            piece = rows[: branch_bound.PIECE]
            assert branch_bound.search(piece, branch_bound.START, branch_bound.DONE)[1] <= 4 * 2000


def brute(rows):
    """What the report says of one conversation: rows of (turn, role, text) after damage."""
    said = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    told = lambda r, x: hashlib.sha256((hashlib.sha256(r.encode()).hexdigest() + x).encode()).digest()
    said.sort(key=lambda s: (s[0] is not None, s[0] or 0, told(s[1], s[2])))
    seen, codes, faults = set(), "", [0, 0, 0]
    for _, role, text in said:
        kind = role[:1] if role[:1] in ("s", "u", "a") else "x"
        held = text.strip(" \t\n\x0b\f\r")
        if not held or (role, text) in seen:
            faults[bool(held)] += 1
            kind = str("suax".index(kind) + 1)
        elif held[-1] not in ".!?":
            faults[2] += 1
            kind = kind.upper()
        seen.add((role, text))
        codes += kind
    plain = codes.lower().translate(str.maketrans("1234", "suax"))
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(plain, plain[1:]))
    turns = [t for t, _, _ in said if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    cost, audit = by_table(codes)
    out, at, last = [], 0, ""
    for edit in audit:
        due = "assistant" if last[:1] == "u" else "user"
        if edit == "I":
            out.append((due, ""))
        else:
            if edit != "D":
                out.append((said[at][1] if edit == "K" else due, said[at][2]))
            at += 1
        last = out[-1][0] if out else ""
    repaired = "\n".join(f"{r}:{x}" for r, x in out)
    return gaps, *faults, illegal, cost, audit, hashlib.sha256(repaired.encode()).hexdigest()


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_report_equals_brute_force(spark, coalesce):
    rng = random.Random(6)
    texts = ["One.", "two", "Three? ", "\n", "", None, "über!\n\n", "a\nb", "end.\x85"]
    roles = ["system", "user", "assistant", "tool", "", None, "User", "ü"]
    rows = [(rng.choice([1, 2, 3, None, -7]), rng.choice([0, 1, 2, 5, None]), rng.choice(roles), rng.choice(texts)) for _ in range(150)]
    rows += [(50 + i, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.") for i in range(5) for t in range(6)]
    rows += [(99, t % 1500, rng.choice(roles[:3]), f"Turn {t % 700}.") for t in range(3000)] + [(98, None, None, None)] * 200
    rows += [(97, 1, "user", "word. " * 50_000)]
    turns = spark.createDataFrame([(*r, False, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, dropped boolean, n string, told int")
    turns = turns.unionByName(turns.limit(1).select(F.lit(1000).cast("long").alias("conv_id"), F.lit(None).alias("turn"), "role", "text", F.lit(True).alias("dropped"), "n", "told"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        found = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in structure_repair.report(turns).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    expected = {c: brute([r[1:] for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    expected[1000] = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert found == expected


def test_damage(spark):
    turns = spark.createDataFrame([(c, t, "system", "Is it? No!") for c in range(40) for t in (None, 1)], "conv_id long, turn long, role string, text string")
    made = structure_repair.damage(turns)
    kind = lambda c, t: __import__("zlib").crc32(f"{c}:{' ' if t is None else t}".encode()) % 20
    expected = []
    for c in range(40):
        for t in (None, 1):
            k = kind(c, t)
            row = (c, None if k == 0 else t, None if k == 0 else "user" if k == 4 else "system", {0: None, 1: "", 2: "Is it No"}.get(k, "Is it? No!"), k == 0)
            expected += [row] * (2 if k == 3 else 1)
    assert sorted(map(str, map(tuple, made.collect()))) == sorted(map(str, expected))


def test_empty_table_and_text_ids(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string, dropped boolean")
    assert structure_repair.report(empty).count() == 0
    named = spark.createDataFrame([("a", 1, "user", "Hi."), ("b", 1, "user", "Hi.")], "conv_id string, turn int, role string, text string")
    repairs = structure_repair.find_repairs(named)
    assert {(r.conv_id, r.cost, r.audit) for r in repairs.collect()} == {("a", 3, "KI"), ("b", 3, "KI")}
    rows = structure_repair.repaired(named, repairs).collect()
    assert {tuple(r) for r in rows} == {(c, i, *x) for c in "ab" for i, x in enumerate([("user", "Hi."), ("assistant", "")])}


def test_the_query_keeps_every_conversation(spark):
    ids = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id").distinct().count()
    assert queries()["op13_structure_repair"](spark, "/root/testdata/sf0.001").count() == ids
