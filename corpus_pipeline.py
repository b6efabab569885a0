"""A training corpus from ``documents``: five stages, each one operator of ``txrisk.llm`` on all that the stage before kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns rows with the columns of ``docs``; the last adds ``copy``. Its result is
written as Parquet in the shared folder and read again as the next stage's ``docs``.

Rows are kept or dropped as they are, texts included. NULL and empty texts have no letter, so the first stage drops them. An
empty table stays empty through all stages. Rows with equal ids are told apart by their texts; fully repeated rows
count as copies of each other, of which one stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.llm import decontaminate, exact_dedup, jaccard_join, language_id, mixing
from txrisk.llm.tables import flag_members, table, whole_rows
from txrisk.sources.workspace import new_folder, stage

#: No stage after the first can be compared without it, and a field's probabilities are not SQL.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts in no language, ``und``: NULL, or without a letter. Texts in several languages stay, whatever the share of each. The
    field learns from the rows' own ``lang``; texts without a label are identified like all others. Without any label
    all texts with a letter stay."""
    model = language_id.train(language_id.sample(docs))
    if model is None:
        return docs.filter(F.col("text").rlike("\\p{L}"))
    named = language_id.identify(whole_rows(docs), model, ("row",), "row.text")
    return named.filter(F.col("lang_pred") != language_id.UNDETERMINED).select("row.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of texts that are equal but for blanks: the longest, then the smallest id."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps, of documents that links of at least 0.8 on five-word shingles connect, the one with the smallest id (a NULL id being
    the smallest; of several with that id, the one whose text has the least MD5). Documents without words stand alone. Of
    rows that agree in id and text one stays."""
    key = F.struct("doc_id", F.md5("text").alias("md5"))
    found = stage(jaccard_join.near_duplicates(docs.select(key.alias("doc_id"), "text")), "near-copies")
    gone = stage(found.filter(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("gone")).distinct(), "gone")
    again = stage(found.groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias("again")), "repeated")
    held = flag_members(docs.select(F.struct("*").alias("row"), key.alias("key")), F.col("key"), gone.union(again), F.col("gone"))
    some = held.filter("__maybe").join(gone, F.col("key").eqNullSafe(F.col("gone")), "left_anti")
    same = F.col("key").eqNullSafe(F.col("again"))
    single, repeated = some.join(again, same, "left_anti"), some.join(again, same, "left_semi").dropDuplicates(["key"])
    return held.filter("NOT __maybe").union(single).union(repeated).select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which a twentieth of the words or more stands in windows of benchmark items."""
    found = decontaminate.contamination(whole_rows(docs), table(spark, sf_dir, "benchmark"), ("row",), text="row.text")
    return found.filter(~F.col("contaminated")).select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or thins the documents of each source towards its target; ``copy`` counts a document's copies from 1."""
    return mixing.mix(docs)


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        folder = new_folder(spark, name.replace(" ", "-"))
        step(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
