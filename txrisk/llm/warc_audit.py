"""Fixity audit of two replicas of a WARC collection by Merkle trees over ordered offset ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txrisk.sources.workspace import stage

#: Records of a file, on average.
FILE_RECORDS = 2048
#: Children of a tree node.
FAN_OUT = 16


def _record(page_id: Column, url: Column, html: Column) -> Column:
    """The bytes of a response record. The record id is made from page_id, the date is fixed: records are reproducible."""
    body = F.coalesce(html, F.lit("")).cast("binary")
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return F.concat(head.cast("binary"), body, F.lit("\r\n\r\n").cast("binary"))


def records(pages: DataFrame, file_records: int = FILE_RECORDS) -> DataFrame:
    """``page_id, file, position, offset, length, sha256, record``: the records of ``pages`` (``page_id, url, html``) laid into files.

    A record's file is chosen by a hash of its id and URL, the number of files follows the number of rows, and records
    stand in a file by page_id (NULL first), URL and digest. NULL URL and HTML are empty. Rows that are equal stand next
    to each other. Other columns are ignored.
    """
    files = max(1, -(-pages.count() // file_records))
    key = F.concat_ws("|", F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.coalesce("url", F.lit("")))
    made = pages.select(
        "page_id", "url", (F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long") % files).alias("file"),
        _record(F.col("page_id"), F.col("url"), F.col("html")).alias("record"),
    ).withColumns({"length": F.octet_length("record").cast("long"), "sha256": F.sha2("record", 256)})
    in_file = Window.partitionBy("file").orderBy("page_id", "url", "sha256")
    ahead = in_file.rowsBetween(Window.unboundedPreceding, -1)
    return made.select(
        "page_id", "file", (F.row_number().over(in_file) - 1).alias("position"),
        F.coalesce(F.sum("length").over(ahead), F.lit(0)).alias("offset"), "length", "sha256", "record",
    )


def leaves(replica: DataFrame) -> DataFrame:
    """``file, node, hash, length`` of level 0: the digest of a record's bytes with its offset. Domain byte 0."""
    place = F.concat(F.lit("0:"), F.col("offset").cast("string"), F.lit(":"), F.col("length").cast("string"), F.lit(":"))
    return replica.select(
        "file", F.col("position").cast("long").alias("node"),
        F.sha2(F.concat(place.cast("binary"), F.col("record")), 256).alias("hash"), "length",
    )


def _parents(level: DataFrame, fan_out: int) -> DataFrame:
    """Nodes over ``fan_out`` neighbours, hashed in order: a group is ``fan_out`` small rows, whatever the file's size."""
    kids = F.sort_array(F.collect_list(F.struct("node", "hash")))
    joined = F.concat_ws(",", F.transform(kids, lambda k: k["hash"]))
    grown = level.groupBy("file", F.floor(F.col("node") / fan_out).alias("up"))
    return grown.agg(F.sha2(F.concat(F.lit("1:"), joined), 256).alias("hash"), F.sum("length").alias("length")).withColumnRenamed("up", "node")


def tree(replica: DataFrame, fan_out: int = FAN_OUT) -> list[DataFrame]:
    """The levels from the leaves to a root (node 0) per file, each written to the shared folder."""
    levels = [stage(leaves(replica), "leaves")]
    top = levels[0].agg(F.max("node")).first()[0] or 0
    while top > 0:
        levels.append(stage(_parents(levels[-1], fan_out), "nodes"))
        top //= fan_out
    return levels


def audit(ours: list[DataFrame], theirs: list[DataFrame], fan_out: int = FAN_OUT) -> DataFrame:
    """``file, position, state`` of every record in which two trees differ: changed, missing or extra in the second.

    Roots are compared first; a level below is joined only with the children of nodes that differ, so what is read of a
    sound replica beyond its roots shrinks with every level. Trees of unequal height are compared from the lower root up to
    the higher one as if missing levels were different. Two empty collections have no rows.
    """
    height = max(len(ours), len(theirs))
    bad = None
    for level in reversed(range(height)):
        if level >= min(len(ours), len(theirs)):
            continue
        a = ours[level].select("file", "node", F.col("hash").alias("a"))
        b = theirs[level].select("file", "node", F.col("hash").alias("b"))
        if bad is not None:
            up = bad.select(F.col("file").alias("in_file"), F.col("node").alias("up"))
            within = lambda side: side.join(up, (F.col("file") == F.col("in_file")) & (F.floor(F.col("node") / fan_out) == F.col("up")), "left_semi")
            a, b = within(a), within(b)
        differ = a.join(b, ["file", "node"], "full").filter(~F.col("a").eqNullSafe(F.col("b")))
        bad = stage(differ, "differ")
    state = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").otherwise("changed")
    return bad.select("file", F.col("node").alias("position"), state.alias("state"))


def damaged(replica: DataFrame, which: Column) -> DataFrame:
    """A replica in which the last byte of the records that ``which`` selects is another one (a record ends with CRLF)."""
    other = F.concat(F.substring("record", 1, F.octet_length("record") - 1), F.lit(" ").cast("binary"))
    return replica.withColumn("record", F.when(which, other).otherwise(F.col("record")))


def report(replica: DataFrame, found: DataFrame) -> DataFrame:
    """Every record of a replica with its place, its digest and its state in the other: ``sound`` or what the audit found."""
    states = found.select("file", "position", "state").filter("state <> 'extra'")
    joined = replica.drop("record").join(states, ["file", "position"], "left")
    return joined.select("page_id", "file", "position", "offset", "length", "sha256", F.coalesce("state", F.lit("sound")).alias("state"))
