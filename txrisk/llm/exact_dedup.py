"""Exact deduplication against a persistent digest index, bucketed and sorted by digest."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.llm.tables import flag_members
from txrisk.sources.workspace import new_folder, stage

#: The characters that do not count: space and U+0009 to U+000D.
BLANKS = " \t\n\x0b\x0c\r"
#: Buckets of an index. A bucket holds 40 bytes per different text, so raise it with the corpus: 4096 for 10^11 texts.
BUCKETS = 24


def digest(text: Column) -> Column:
    """SHA-256, as 32 bytes, of the text without blanks; NULL counts as empty."""
    return F.unhex(F.sha2(F.translate(F.coalesce(text, F.lit("")), BLANKS, ""), 256))


class DigestIndex:
    """A table ``(digest, keep_id, batch)`` of all texts seen so far, bucketed and sorted by digest; ``batch`` names the arrival
    that a text came with.

    It lives in a folder (by default a new one in the shared folder) under a name in the session's catalog, so a later
    session opens it again by ``DigestIndex(spark, folder)``.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, buckets: int = BUCKETS):
        self.spark, self.folder = spark, folder or new_folder(spark, "digests")
        self.name = f"digests_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.name} (digest BINARY, keep_id BIGINT, batch STRING) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{self.folder}'"
        )
        self.buckets = buckets

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, groups: DataFrame, batch: str) -> None:
        """Add ``(digest, keep_id)`` rows, whose digests are not in the index yet."""
        (
            groups.select("digest", "keep_id", F.lit(batch).alias("batch")).repartition(self.buckets, "digest")
            .write.bucketBy(self.buckets, "digest").sortBy("digest").format("parquet").mode("append").saveAsTable(self.name)
        )


def _decided(docs: DataFrame, index: DigestIndex | None, batch: str | None) -> tuple[DataFrame, DataFrame]:
    """``doc_id, digest, n`` of the rows, and ``digest, keep_id, keep_n, group_size, told`` of the groups in which one may go. What is
    new is appended to the index."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = stage(docs.select("doc_id", digest(F.col("text")).alias("digest"), F.length(text).alias("n")), "digested")
    first = F.min(F.struct((-F.col("n")).alias("n"), F.col("doc_id").isNull().alias("no_id"), "doc_id"))
    groups = stage(
        rows.groupBy("digest").agg(first.alias("first"), F.count("*").alias("group_size"))
        .select("digest", F.col("first.doc_id").alias("keep_id"), (-F.col("first.n")).alias("keep_n"), "group_size"),
        "groups",
    )
    index = index or DigestIndex(docs.sparkSession)
    batch = batch or uuid.uuid4().hex
    before, again = (index.read().filter(test) for test in (F.col("batch") != batch, F.col("batch") == batch))
    fresh = stage(groups.hint("merge").join(before.hint("merge").select("digest"), "digest", "left_anti"), "fresh")
    known = (
        groups.hint("merge").join(before.select("digest", F.col("keep_id").alias("known_id")), "digest")
        .select("digest", F.col("known_id").alias("keep_id"), F.lit(None).cast("int").alias("keep_n"), "group_size")
    )
    told = stage(fresh.filter("group_size > 1").unionByName(known), "told").withColumn("told", F.lit(True))
    index.append(fresh.hint("merge").join(again.hint("merge").select("digest"), "digest", "left_anti"), batch)
    return rows, told


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None, batch: str | None = None) -> DataFrame:
    """Decide for every document whether it stays.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256``, one row per row of ``docs`` (columns ``doc_id, text``;
    others are ignored). Texts are equal when their SHA-256 without blanks is. In a group of equal new texts the row
    with the most code points stays, then the smallest ``doc_id`` (NULL ids last); if several rows share that id
    and length, all are reported as kept. ``group_size`` counts the new rows. Texts that ``index`` knows already are
    dropped for the id it holds; the others are appended to it. NULL text is an empty one. An empty table gives no rows.
    The index is appended to before the result is written; a job that fails in between is repeated with the same name ``batch``, whose
    own texts do not count as known, and gives the same rows (by default each call is a batch of its own).

    New digests are written once, 56 bytes each. The group of a text is summed before it is shuffled; a sort-merge
    anti-join with the index finds what is new. Only groups of several rows, or known ones, are joined back to
    the rows, where adaptive execution can split the rows of one very frequent text.
    """
    rows, told = _decided(docs, index, batch)
    joined = rows.join(told, "digest", "left")
    alone = F.col("told").isNull()
    return joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("doc_id").eqNullSafe(F.col("keep_id")) & F.coalesce(F.col("n") == F.col("keep_n"), F.lit(False)))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_first(docs: DataFrame, index: DigestIndex | None = None, batch: str | None = None) -> DataFrame:
    """The rows of ``docs`` that :func:`exact_dedup` keeps, with all their columns; exactly one for each text that is new. Of
    rows that agree in id, length and text without blanks, one stays. Only rows that may have copies are shuffled."""
    _, told = _decided(docs, index, batch)
    rows = docs.select(F.struct("*").alias("row"), digest(F.col("text")).alias("key"))
    held = flag_members(rows, F.col("key"), told, F.col("digest"))
    some = held.filter("__maybe").join(told, F.col("key") == F.col("digest"), "left")
    is_first = F.col("row.doc_id").eqNullSafe(F.col("keep_id")) & (F.length(F.coalesce("row.text", F.lit(""))) == F.col("keep_n"))
    firsts = some.filter(F.col("told") & is_first).dropDuplicates(["key"])
    return held.filter("NOT __maybe").select("row.*").union(some.filter(F.col("told").isNull()).union(firsts).select("row.*"))
