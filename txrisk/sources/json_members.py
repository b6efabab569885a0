"""The members of one JSON object of any size, read by as many tasks as its file has splits.

The text is cut at commas, as Spark splits it. Whether a comma stands inside a string is only known from all that
precedes it, so every split reports how it changes the state (quotes and depth), for either state it may begin in; joining
the reports in order gives each split its true state. Pieces whose comma was part of a string are then put together again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txrisk.sources.workspace import stage

_STRING = r'"([^"\\]*+(?:\\.[^"\\]*+)*+)"'
_SCALAR = r'("[^"\\]*+(?:\\.[^"\\]*+)*+"|-?[0-9][0-9.eE+-]*|true|false|null)'
#: Objects that open or close, then a key and its scalar, then objects that close.
MEMBER = rf"(?s)^[\s{{}}]*(?:{_STRING}\s*:\s*\{{[\s}}]*)*(?:{_STRING}\s*:\s*{_SCALAR})?[\s}}]*$"
_OPENED, _KEY, _VALUE = 1, 2, 3


def _marks(text: Column) -> Column:
    """Quotes and braces in their order, without those that a backslash makes part of a string."""
    return F.regexp_replace(F.regexp_replace(text, r"(?s)\\.", ""), r'[^"{}]', "")


def _count(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def _depth(outside: Column) -> Column:
    return _count(outside, "{") - _count(outside, "}")


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """What stands between commas, with its split, its order there, and how it changes the state.

    ``odd``: it turns outside into inside a string or back. ``if_out`` and ``if_in``: its change of depth, beginning outside or inside.
    """
    text = spark.read.option("lineSep", ",").text(path)
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    marks = _marks(F.col("value"))
    quoted = r'"[^"]*("|$)'
    if_out = _depth(F.regexp_replace(marks, quoted, ""))
    if_in = _depth(F.regexp_replace(F.regexp_replace(marks, r'^[^"]*("|$)', ""), quoted, ""))
    changes = [(_count(marks, '"') % 2).alias("odd"), if_out.alias("if_out"), if_in.alias("if_in")]
    return text.select("value", *place, F.monotonically_increasing_id().alias("seq"), *changes)


CHANGES = "value string, file string, block long, seq long, odd long, turns long, from_out long, from_in long, depth_out long, depth_in long"


def _changes(pieces: DataFrame) -> DataFrame:
    """Beside every piece what those before it in its split have changed, as they stream by: nothing is shuffled.

    ``turns`` counts the odd ones before. ``from_out`` and ``from_in`` are the piece's change of depth if the split begins outside or inside a
    string, ``depth_out`` and ``depth_in`` the sums of those before.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, carried = None, np.zeros(3, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            number = {c: batch[c].to_numpy().astype(np.int64) for c in ("block", "odd", "if_out", "if_in")}
            other = number["block"][1:] != number["block"][:-1]
            other |= pc.not_equal(batch["file"].slice(1), batch["file"].slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
            starts = np.append(0, np.flatnonzero(other) + 1)
            run = np.zeros(batch.num_rows, np.int64)
            run[starts[1:]] = 1
            run = np.cumsum(run)
            first = (batch["file"][0].as_py(), int(number["block"][0]))
            carried = carried if first == split else np.zeros(3, np.int64)

            def before(values: np.ndarray, k: int) -> np.ndarray:
                """The sum within the split without the piece itself."""
                total = np.cumsum(values) - values
                total = total - total[starts][run] + np.where(run == 0, carried[k], 0)
                sums[k] = total[-1] + values[-1]
                return total

            sums = np.zeros(3, np.int64)
            turns = before(number["odd"], 0)
            even = turns % 2 == 0
            from_out = np.where(even, number["if_out"], number["if_in"])
            from_in = np.where(even, number["if_in"], number["if_out"])
            made = [number["odd"], turns, from_out, from_in, before(from_out, 1), before(from_in, 2)]
            split, carried = (batch["file"][-1].as_py(), int(number["block"][-1])), sums
            names = [field.split()[0] for field in CHANGES.split(", ")]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in names[:4]), *map(pa.array, made)], names)

    return pieces.mapInArrow(scan, CHANGES)


def _states(changes: DataFrame) -> DataFrame:
    """The state in which each split begins: one row per split, joined in order within a file."""
    splits = changes.groupBy("file", "block").agg(*[F.sum(c).alias(c) for c in ("odd", "from_out", "from_in")])
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("turns_before", F.coalesce(F.sum("odd").over(before), F.lit(0)))
    change = F.when(F.col("turns_before") % 2 == 0, F.col("from_out")).otherwise(F.col("from_in"))
    splits = splits.withColumn("change", change)
    return splits.select("file", "block", "turns_before", F.coalesce(F.sum("change").over(before), F.lit(0)).alias("depth_before"))


def _members(spark: SparkSession, path: str) -> DataFrame:
    """The text of every member: ``file, at`` (its order in the file), ``depth`` (where it begins), ``text``.

    Most pieces are members and stay where they are. Of the others those with equal numbers of turns before, by
    two, belong together; no more than one member's pieces are gathered.
    """
    changes = stage(_changes(_pieces(spark, path)), "json-pieces")
    known = changes.join(_states(changes), ["file", "block"])
    turns = F.col("turns_before") + F.col("turns")
    depth = F.col("depth_before") + F.when(F.col("turns_before") % 2 == 0, F.col("depth_out")).otherwise(F.col("depth_in"))
    known = known.select("file", F.struct("block", "seq").alias("at"), "value", "odd", turns.alias("turns"), depth.alias("depth"))
    whole = (F.col("turns") % 2 == 0) & (F.col("odd") == 0)
    cut = known.filter(~whole).groupBy("file", F.floor(F.col("turns") / 2).alias("member"))
    pieces = F.array_sort(F.collect_list(F.struct("at", "value")))
    joined = cut.agg(F.min("at").alias("at"), F.min_by("depth", "at").alias("depth"), F.array_join(F.transform(pieces, lambda p: p["value"]), ",").alias("text"))
    return known.filter(whole).select("file", "at", "depth", F.col("value").alias("text")).union(joined.select("file", "at", "depth", "text"))


def _text(json: Column) -> Column:
    """A scalar as :func:`from_json` gives it for a string: NULL for null, numbers and booleans as they are written."""
    return F.from_json(F.concat(F.lit('{"v":'), json, F.lit("}")), "v string")["v"]


def scalar_members(spark: SparkSession, path: str, field: str | None = None) -> DataFrame:
    """``key, value`` (text) of every scalar member of the JSON objects in the files, one object per file.

    With ``field`` only those of the object that is the value of this top-level member. Without, members of nested objects
    count as well. Values may be text with any characters, numbers, booleans and null; an array, or text that is no member, is an error, which
    is raised when ``key`` or ``value`` is used. Equal keys give a row each. Empty files and objects give none.
    """
    members = _members(spark, path)
    part = lambda k: F.regexp_extract("text", MEMBER, k)
    parsed = members.select(
        "file", "at", "text", F.col("text").rlike(MEMBER).alias("fits"), part(_VALUE).alias("raw"), part(_KEY).alias("raw_key"), part(_OPENED).alias("opened"),
        (F.col("depth") + _depth(F.regexp_replace(_marks(F.col("text")), '"[^"]*"', ""))).alias("depth_after"),
    )
    if field is not None:
        parsed = _within(stage(parsed, "json-members"), field)
    # the error is no part of a filter, which Spark might apply to pieces
    held = parsed.filter(~F.col("fits") | (F.col("raw") != ""))
    wrong = F.raise_error(F.concat(F.lit("no key and scalar: "), F.substring("text", 1, 100))).cast("string")
    right = lambda json: F.when(F.col("fits"), _text(json)).otherwise(wrong)
    return held.select(right(F.concat(F.lit('"'), "raw_key", F.lit('"'))).alias("key"), right(F.col("raw")).alias("value"))


def _within(members: DataFrame, field: str) -> DataFrame:
    """The members of the object that ``field`` opens: from its opening to the first member after which the depth is that of
    the file's object again. One begin and one end for each file."""
    depth = F.col("depth_after") + _count(F.regexp_extract("text", r"[\s}]*$", 0), "}")
    members = members.withColumn("depth", depth)
    opens = members.filter((_text(F.concat(F.lit('"'), "opened", F.lit('"'))) == field) & (F.col("depth") == 2))
    begin = opens.groupBy("file").agg(F.min("at").alias("begin"))
    later = members.join(begin, "file").filter(F.col("at") >= F.col("begin"))
    end = later.filter("depth_after < 2").groupBy("file").agg(F.min("at").alias("end"))
    inside = (F.col("at") <= F.col("end")) & (F.col("depth") == 2)
    return later.join(end, "file").filter(inside | ~F.col("fits"))
