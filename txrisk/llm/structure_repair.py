"""Conversation structure repair: faults, the cheapest edits by branch and bound, and the repaired text."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.llm import branch_bound
from txrisk.sources.workspace import stage

BLANKS = r"[\x20\x09-\x0D]"
DUE_ROLE = {branch_bound.USER: "user", branch_bound.ASSISTANT: "assistant"}
#: Rows in one batch of what a task returns.
BATCH = 4096


def blank(text: Column) -> Column:
    return ~text.rlike(r"[^\x20\x09-\x0D]")


def truncated(text: Column) -> Column:
    """The last character that is no blank doesn't end a sentence; false for blank texts."""
    return text.rlike(rf"[^.!?\x20\x09-\x0D]{BLANKS}*\z")


def damage(turns: DataFrame) -> DataFrame:
    """``turns`` with faults that depend on conversation and turn alone, NULLs being read as one space: of twenty rows one is dropped,
    one loses its text, one its ``.!?``, one is repeated, one is said by the user. Dropped rows leave a row with ``turn,
    role, text`` NULL and ``dropped`` true, so that no conversation disappears."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(said("text"), "[.!?]", "")).otherwise(said("text"))
    role = F.when(kind == 4, "user").otherwise(said("role"))
    made = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), (kind == 0).alias("dropped"), kind.alias("kind"))
    gone = lambda c: F.when(~F.col("dropped"), F.col(c)).alias(c)
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return made.select("conv_id", gone("turn"), gone("role"), gone("text"), "dropped", copies.alias("copy")).drop("copy")


def _read(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, told`` with NULL roles and texts as one space; ``told`` orders rows of one turn by content."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    read = turns.select("conv_id", "turn", said("role"), said("text"))
    return read.withColumn("told", F.unhex(F.sha2(F.concat(F.sha2("role", 256), "text"), 256)))


def faults(turns: DataFrame) -> DataFrame:
    """One row for all rows of a conversation that agree in turn, role and text: ``conv_id, turn, told``, their number ``n`` and the
    search's characters for the ``first`` of them and for the ``others``.

    A row is blank, else a duplicate of an earlier row (smaller turn, NULL first, or beside it), else truncated. The first turn of a role and
    text is a minimum, so neither the rows of a conversation nor the copies of a text meet in one task.
    """
    text, role = F.col("text"), F.col("role")
    initial = F.substring(role, 1, 1)
    kind = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    must = F.translate(kind, "suax", "1234")
    of_row = F.when(blank(text), must).when(truncated(text), F.upper(kind)).otherwise(kind)
    read = turns.select("conv_id", "turn", "told", of_row.alias("row"), must.alias("must"), blank(text).alias("blank"))
    runs = read.groupBy("conv_id", "turn", "told").agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("row", "must", "blank")])
    runs = stage(runs, "runs")
    at = F.struct(F.col("turn").isNotNull().alias("given"), "turn")
    again = runs.groupBy("conv_id", "told").agg(F.min(at).alias("earliest"), F.count("*").alias("turns")).filter("turns > 1")
    same = runs.conv_id.eqNullSafe(again.conv_id) & (runs.told == again.told)
    joined = runs.join(again, same, "left").select(runs["*"], again.earliest)
    later = ~at.eqNullSafe(F.coalesce("earliest", at))
    return joined.select("conv_id", "turn", "told", "n", "blank", F.when(later, F.col("must")).otherwise(F.col("row")).alias("first"), F.col("must").alias("others"))


def _pairs(rows: str) -> int:
    """Adjacent roles that no conversation has."""
    kinds = rows.lower().translate(str.maketrans("1234", branch_bound.INITIALS))
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:]))


class _Open:
    """A conversation, or the part of it in one partition, as far as it has been read."""

    def __init__(self, conv) -> None:
        self.conv, self.rows, self.done = conv, "", None
        self.illegal, self.head, self.tail = 0, "", ""

    def add(self, rows: str) -> None:
        self.illegal += _pairs(self.tail + rows)
        self.head, self.tail = self.head or rows[:1], rows[-1:]
        self.rows += rows
        while len(self.rows) > branch_bound.PIECE:
            self._fold(branch_bound.PIECE)

    def _fold(self, n: int) -> None:
        found, self.rows = branch_bound.paths(self.rows[:n]), self.rows[n:]
        self.done = found if self.done is None else branch_bound.joined(self.done, found)

    def best(self) -> tuple[int, str]:
        if self.done is None:
            return branch_bound.solve(self.rows)
        return branch_bound.whole(self.paths())

    def paths(self) -> branch_bound.Paths:
        self._fold(len(self.rows))
        return self.done


PART = (
    "conv_id {}, part int, cost long, audit string, illegal long, head string, tail string, "
    "paths array<struct<a: int, b: int, cost: long, audit: string>>"
)


def _searched(ordered: DataFrame) -> DataFrame:
    """Of rows of :func:`faults` in order: a row per conversation and partition, as ``PART``. ``cost`` and ``audit`` are of a conversation
    that begins and ends in its partition; the first and the last of a partition have ``paths`` instead.

    A task holds one batch, and of a conversation the audits of at most 16 pairs of states.
    """
    kind = dict(ordered.dtypes)["conv_id"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        now: _Open | None = None
        at_edge, out = True, []

        def told(edge: bool) -> tuple:
            cost, audit = (None, None) if edge else now.best()
            found = [{"a": a, "b": b, "cost": c, "audit": e} for (a, b), (c, e) in now.paths().items()] if edge else None
            return now.conv, part, cost, audit, now.illegal, now.head, now.tail, found

        for batch in batches:
            rows = zip(*(batch[c].to_pylist() for c in ("conv_id", "n", "first", "others")))
            for conv, n, first, others in rows:
                if now is None or now.conv != conv:
                    if now is not None:
                        out.append(told(at_edge))
                        at_edge = False
                    now = _Open(conv)
                now.add(first)
                for i in range(0, n - 1, BATCH):
                    now.add(others * min(BATCH, n - 1 - i))
            if len(out) >= BATCH:
                yield batch_of(out)
                out = []
        if now is not None:
            out.append(told(True))
        if out:
            yield batch_of(out)

    struct = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
    kinds = [pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.list_(struct)]
    conv_kind = pa.string() if kind == "string" else pa.int64()

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        names = ["conv_id", "part", "cost", "audit", "illegal", "head", "tail", "paths"]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), [conv_kind, *kinds])], names)

    return ordered.mapInArrow(search, PART.format(kind))


def _assembled(parts: DataFrame) -> DataFrame:
    """``conv_id, cost, audit, illegal`` of the conversations at the edges of partitions, from their paths in each: at most two rows for
    each partition, joined in order."""
    kind = dict(parts.dtypes)["conv_id"]

    def assemble(rows: pa.Table) -> pa.Table:
        rows = sorted(rows.to_pylist(), key=lambda r: r["part"])
        found, illegal, tail = None, 0, ""
        for r in rows:
            here = {(p["a"], p["b"]): (p["cost"], p["audit"]) for p in r["paths"]}
            found = here if found is None else branch_bound.joined(found, here)
            illegal += r["illegal"] + _pairs(tail + r["head"])
            tail = r["tail"]
        cost, audit = branch_bound.whole(found)
        conv = pa.array([rows[0]["conv_id"]], pa.string() if kind == "string" else pa.int64())
        made = [conv, pa.array([cost], pa.int64()), pa.array([audit], pa.string()), pa.array([illegal], pa.int64())]
        return pa.Table.from_arrays(made, ["conv_id", "cost", "audit", "illegal"])

    return parts.groupBy("conv_id").applyInArrow(assemble, f"conv_id {kind}, cost long, audit string, illegal long")


def find_repairs(turns: DataFrame) -> DataFrame:
    """``conv_id, turns, blank, duplicate, truncated, illegal, cost, audit``: what is wrong with every conversation, and its cheapest edits.

    ``turns`` has ``conv_id`` (a number or text), ``turn, role, text``; other columns are ignored. Rows stand by turn (NULL first), those of one turn by a
    digest of role and text. NULL roles and texts are one space; NULL is a conversation of its own. An empty table
    gives no rows. Only digests and one character for a row are sorted: by range, so that a long conversation is spread over
    partitions and searched in each.
    """
    if dict(turns.dtypes)["conv_id"] != "string":
        turns = turns.withColumn("conv_id", F.col("conv_id").cast("long"))
    runs = stage(faults(_read(turns)), "faults")
    keys = ["conv_id", "turn", "told"]
    ordered = runs.repartitionByRange(*keys).sortWithinPartitions(*keys).select("conv_id", "n", "first", "others")
    parts = stage(_searched(ordered), "parts")
    best = parts.filter("paths IS NULL").select("conv_id", "cost", "audit", "illegal")
    best = best.union(_assembled(parts.filter("paths IS NOT NULL")))
    first_dup = F.col("first").rlike("[1-4]") & ~F.col("blank")
    duplicates = F.when(F.col("blank"), 0).otherwise(F.col("n") - 1 + first_dup.cast("int"))
    sums = runs.groupBy("conv_id").agg(
        F.sum("n").alias("turns"),
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
        F.sum(duplicates).alias("duplicate"),
        F.sum(F.col("first").rlike("[SUAX]").cast("long")).alias("truncated"),
    )
    return sums.join(best, sums.conv_id.eqNullSafe(best.conv_id)).select(sums["*"], "illegal", "cost", "audit")


def repaired(turns: DataFrame, repairs: DataFrame) -> DataFrame:
    """The rows of ``turns`` after the edits in ``repairs``: ``conv_id, place`` (from 0), ``role, text``.

    One shuffle by conversation; Spark sorts, the audit first, and rows stream past it. A task holds one batch and one audit.
    """
    if dict(turns.dtypes)["conv_id"] != "string":
        turns = turns.withColumn("conv_id", F.col("conv_id").cast("long"))
    read = _read(turns).select("conv_id", F.lit(True).alias("is_row"), "turn", "told", "role", "text")
    kinds = dict(read.dtypes)
    null = lambda c: F.lit(None).cast(kinds[c]).alias(c)
    plans = repairs.select("conv_id", F.lit(False).alias("is_row"), null("turn"), null("told"), null("role"), F.col("audit").alias("text"))
    keys = ["conv_id", "is_row", "turn", "told"]
    ordered = read.union(plans).repartition("conv_id").sortWithinPartitions(*keys).select("conv_id", "is_row", "role", "text")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, place, state = "", 0, 0, branch_bound.START
        for batch in batches:
            made: list[tuple] = []
            for conv, is_row, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                edit = ""
                if is_row:
                    edit, at = audit[at], at + 1
                else:
                    audit, at, place, state = text, 0, 0, branch_bound.START
                if edit == "K":
                    state = branch_bound.NEXT[state][role[0]]
                elif edit == "R":
                    state = branch_bound.DUE[state]
                    role = DUE_ROLE[state]
                if edit in ("K", "R"):
                    made.append((conv, place, role, text))
                    place += 1
                while audit[at : at + 1] == "I":  # those behind this row, or before the first
                    state, at = branch_bound.DUE[state], at + 1
                    made.append((conv, place, DUE_ROLE[state], ""))
                    place += 1
            if made:
                types = [batch.schema.field("conv_id").type, pa.int64(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*made), types)], ["conv_id", "place", "role", "text"])

    return ordered.mapInArrow(apply, f"conv_id {kinds['conv_id']}, place long, role string, text string")


def digests(rows: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256`` of the output of :func:`repaired`, whose partitions and order it keeps: SHA-256 of ``role:text``, joined by line ends."""
    kind = dict(rows.dtypes)["conv_id"]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, held, done = None, None, []
        for batch in batches:
            kinds = [batch.schema.field("conv_id").type, pa.string()]
            for c, place, role, text in zip(*(x.to_pylist() for x in batch.columns)):
                if place == 0:
                    if held is not None:
                        done.append((conv, held.hexdigest()))
                    conv, held = c, hashlib.sha256()
                held.update(f"{chr(10) if place else ''}{role}:{text}".encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done), kinds)], ["conv_id", "repaired_sha256"])
                done = []
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], kinds[0]), pa.array([held.hexdigest()], kinds[1])], ["conv_id", "repaired_sha256"])

    return rows.mapInArrow(digest, f"conv_id {kind}, repaired_sha256 string")


def gaps(turns: DataFrame) -> DataFrame:
    """``conv_id, gaps``: turns that lie between a conversation's first and last and have no row."""
    span = F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")
    return turns.groupBy("conv_id").agg(F.coalesce(span, F.lit(0)).cast("long").alias("gaps"))


def report(turns: DataFrame) -> DataFrame:
    """Faults, gaps, cheapest edits and the digest of the repaired text of every conversation in ``turns``; rows with ``dropped`` true only name one."""
    rows = turns.filter("NOT dropped")
    repairs = stage(find_repairs(rows), "repairs")
    made = digests(repaired(rows, repairs))
    found = turns.select("conv_id").distinct()
    for more in (gaps(rows), repairs, made):
        name = [c for c in more.columns if c != "conv_id"]
        found = found.join(more, found.conv_id.eqNullSafe(more.conv_id), "left").select(found["*"], *[more[c] for c in name])
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.lit(hashlib.sha256().hexdigest())
    return found.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))
