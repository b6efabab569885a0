"""Chat formatting by columnar byte assembly, with a loss mask, and the way back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A turn is ``<s>ROLE``, a line end, the text and ``</s>``.
OPEN, MIDDLE, CLOSE = b"<s>", b"\n", b"</s>"
#: Control strings of this and of common templates; behind their first character an escaped text has a backslash more.
CONTROL = r"([<\[])(\\*)(/?s>|/?INST\]|</?SYS>>|\|im_start\|>|\|im_end\|>|\|endoftext\|>)"
ESCAPED = CONTROL.replace(r"(\\*)", r"\\(\\*)")
LEARNED = "assistant"
#: A conversation over this size is returned in several pieces, cut between turns.
PIECE_BYTES = 1 << 22

SCHEMA = "conv_id {}, piece int, n_turns long, formatted string, loss_starts array<int>, loss_ends array<int>"


def escape(texts: pa.Array) -> pa.Array:
    """Add a backslash to every control string, also to those that have some already."""
    return pc.replace_substring_regex(texts, CONTROL, r"\1\\\2\3")


def unescape(text: str) -> str:
    return re.sub(ESCAPED, r"\1\2\3", text)


def escape_role(roles: pa.Array) -> pa.Array:
    """A role holds no line end, so that it ends at the first one."""
    return escape(pc.replace_substring(pc.replace_substring(roles, "\\", "\\\\"), "\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(\\|n)", lambda m: "\n" if m[1] == "n" else "\\", unescape(role))


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string array without NULLs."""
    held = texts.cast(pa.large_binary())
    _, offsets, data = held.buffers()
    places = np.frombuffer(offsets, np.int64)[held.offset : held.offset + len(held) + 1]
    return places, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def _scatter(out: np.ndarray, at: np.ndarray, source: np.ndarray, places: np.ndarray, block: int = 4096) -> None:
    """Copy the i-th segment of ``source`` to ``out[at[i]:]``, by one index array for each block of segments."""
    for i in range(0, len(at), block):
        lengths = np.diff(places[i : i + block + 1])
        shift = np.repeat(at[i : i + block][: len(lengths)] - places[i : i + block][: len(lengths)], lengths)
        here = np.arange(places[i], places[min(i + block, len(at))])
        out[here + shift] = source[here]


def _fixed(out: np.ndarray, at: np.ndarray, mark: bytes) -> None:
    for k, byte in enumerate(mark):
        out[at + k] = byte


def _points(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code points before byte positions, which ascend."""
    begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return begins[at]


def assemble(conv: np.ndarray, roles: pa.Array, texts: pa.Array) -> tuple[pa.Array, np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Format turns into one buffer, a row for each run of equal numbers in ``conv``.

    Returns the rows, their numbers of turns, and for each row the starts and ends (code points in the row) of the texts
    that are learned. Segment lengths give every header's and text's offset; nothing is joined in Python.
    """
    learned = pc.equal(roles, LEARNED).to_numpy(zero_copy_only=False)
    role_at, role_data = _bytes(escape_role(roles))
    text_at, text_data = _bytes(escape(texts))
    role_len, text_len = np.diff(role_at), np.diff(text_at)
    turn_len = role_len + text_len + len(OPEN) + len(MIDDLE) + len(CLOSE)
    ends = np.cumsum(turn_len)
    starts = ends - turn_len
    out = np.empty(int(ends[-1]), np.uint8)
    role_to = starts + len(OPEN)
    text_to = role_to + role_len + len(MIDDLE)
    _fixed(out, starts, OPEN)
    _scatter(out, role_to, role_data, role_at)
    _fixed(out, role_to + role_len, MIDDLE)
    _scatter(out, text_to, text_data, text_at)
    _fixed(out, text_to + text_len, CLOSE)
    first = np.flatnonzero(np.append(True, conv[1:] != conv[:-1]))
    offsets = np.append(starts[first], ends[-1]).astype(np.int64)
    rows = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(out))
    marks = np.stack([text_to, text_to + text_len], 1)[learned].ravel()
    points = _points(out, np.concatenate([marks, starts[first]]))
    base = points[len(marks) :]
    row_of = np.searchsorted(first, np.flatnonzero(learned), side="right") - 1
    spans = points[: len(marks)].reshape(-1, 2) - base[row_of][:, None]
    cuts = np.searchsorted(row_of, np.arange(1, len(first)))
    return rows, np.diff(np.append(first, len(conv))), np.split(spans[:, 0], cuts), np.split(spans[:, 1], cuts)


def format_conversations(turns: DataFrame, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """One row per conversation: ``conv_id, piece, n_turns, formatted, loss_starts, loss_ends``.

    ``turns`` has ``conv_id, turn, role, text``; other columns are ignored. Rows stand by turn (NULL first), then role and
    text, so that equal turns have one order. NULL text and role are empty, a NULL ``conv_id`` is a conversation too. The loss
    covers the texts of assistants, in code points of ``formatted``. A conversation of more than ``piece_bytes``
    comes in several rows, in order of ``piece``. An empty table gives no rows.

    Rows are shuffled by conversation and sorted by Spark, which spills; a task holds one Arrow batch and the
    unfinished conversation, so even a very long one needs bounded memory.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = turns.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    kind = dict(rows.dtypes)["conv_id"]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        piece, last = 0, None

        def made(part: pa.Table) -> pa.RecordBatch:
            nonlocal piece, last
            part = part.combine_chunks()
            ids = part["conv_id"].chunk(0)
            same = ids.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            texts, n, a, b = assemble(same, part["role"].chunk(0), part["text"].chunk(0))
            firsts = np.flatnonzero(np.append(True, same[1:] != same[:-1]))
            names = ids.take(pa.array(firsts))
            numbers = np.zeros(len(firsts), np.int32)
            if last is not None and last[0] == names[0].as_py():
                numbers[0] = piece + 1
            piece, last = int(numbers[-1]), (names[-1].as_py(),)
            spans = [pa.array(x, pa.list_(pa.int32())) for x in (a, b)]
            return pa.RecordBatch.from_arrays(
                [names, pa.array(numbers), pa.array(n.astype(np.int64)), texts.cast(pa.string()), *spans],
                ["conv_id", "piece", "n_turns", "formatted", "loss_starts", "loss_ends"],
            )

        for batch in batches:
            now = pa.Table.from_batches([batch])
            now = pa.concat_tables([held, now]) if held is not None else now
            if not len(now):
                continue
            ids = now["conv_id"].combine_chunks()
            same = ids.dictionary_encode(null_encoding="encode")
            same = (same.combine_chunks() if isinstance(same, pa.ChunkedArray) else same).indices.to_numpy(zero_copy_only=False)
            other = np.flatnonzero(same != same[-1])
            cut = int(other[-1]) + 1 if len(other) else 0  # rows before belong to finished conversations
            if now.slice(cut).nbytes > piece_bytes:
                cut = len(now)
            if cut:
                yield made(now.slice(0, cut))
            held = now.slice(cut) if cut < len(now) else None
        if held is not None:
            yield made(held)

    return ordered.mapInArrow(build, SCHEMA.format(kind))


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what :func:`format_conversations` wrote, from its text and mask alone; keeps its partitions and order.

    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``: turns as role, line end, text, line end;
    the learned texts one after the other; both unescaped.
    """
    kind = dict(formatted.dtypes)["conv_id"]
    turn = re.compile(re.escape(OPEN.decode()) + r"([^\n]*)\n(.*?)" + re.escape(CLOSE.decode()), re.S)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: list | None = None
        done: list[list] = []

        def out() -> pa.RecordBatch:
            rows = [(c, n, h.hexdigest(), k, m.hexdigest(), f) for c, n, h, k, m, f in done]
            done.clear()
            kinds = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names)

        for batch in batches:
            id_type = batch["conv_id"].type
            for row in batch.to_pylist():
                if row["piece"] == 0 or now is None:
                    if now:
                        done.append(now)
                    now = [row["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for m in turn.finditer(row["formatted"]):
                    now[1] += 1
                    now[2].update(f"{unescape_role(m[1])}\n{unescape(m[2])}\n".encode())
                for a, b in zip(row["loss_starts"], row["loss_ends"]):
                    learned = unescape(row["formatted"][a:b])
                    now[3] += len(learned)
                    now[4].update(learned.encode())
                now[5] += len(row["formatted"])
            if done:
                yield out()
        if now:
            done.append(now)
            yield out()

    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.mapInArrow(read, schema)
