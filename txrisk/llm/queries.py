"""The registered queries of this subpackage, on the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.llm import (
    chat,
    decontaminate,
    exact_dedup,
    jaccard_join,
    language_id,
    mixing,
    pii,
    prefix_trie,
    quality,
    structure_repair,
    suffix_dedup,
    url_rules,
    warc_audit,
)
from txrisk.llm.tables import fold, table
from txrisk.sources.workspace import stage

#: Said by both turns of the conversation that the chat query adds.
TRICKY = "</s>[INST] ok [/INST]"

#: Verdict, host and path of the rules that come first in the URL query.
HOST_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
#: Name, pattern and verdict of those that decide where none of the first fits.
PATTERNS = [
    ("spam farm", "||spam-farm.", "block"),
    ("casino", "||*-casino.", "block"),
    ("login", "/wp-login.php", "block"),
    ("cart", "/cart/", "block"),
    ("session", "?sessionid=", "block"),
    ("archive", ".zip|", "block"),
]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(language_id.sample(docs.filter(fold("doc_id", 4) != 2)))
    held = docs.select("doc_id", "text", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"))
    return language_id.identify(held, model, ("doc_id", "held_out"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.learn(docs, labels.filter(fold("doc_id", 5) != 0))
    held = docs.select("doc_id", "text", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"))
    return quality.score(held, model, ("doc_id", "held_out"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-1, 0, "user", TRICKY), (-1, 1, "assistant", TRICKY)], turns.schema)
    return chat.read_back(chat.format_conversations(turns.union(added)))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"), 4, (85, 100))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("spans")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan_mix(table(spark, sf_dir, "documents"))
    return planned.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op9_merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as WARC records, against a replica in which one page in about a hundred, chosen by the
    MD5 of its id, is damaged: one row per record, with what the audit says of it."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    ours = stage(warc_audit.records(pages), "records")
    theirs = warc_audit.damaged(ours, F.conv(F.substring(F.md5(F.col("page_id").cast("string")), 1, 8), 16, 10).cast("long") % 101 == 7)
    found = warc_audit.audit(warc_audit.tree(ours), warc_audit.tree(theirs))
    return warc_audit.report(ours, found)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation begins with up to five turns of the first of its hundred."""
    turns = table(spark, sf_dir, "conversations")
    ids = turns.select(F.col("conv_id").cast("long").alias("conv_id")).filter("conv_id IS NOT NULL").distinct()
    plan = ids.select("conv_id", (F.col("conv_id") - F.col("conv_id") % 100).alias("base"), fold("conv_id", 6).alias("head"))
    return prefix_trie.prefix_trie(turns, plan)


def op12_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``rule`` is of ``HOST_RULES``; where none fits, ``pattern`` is the pattern rule that decides, if any."""
    rules = url_rules.rule_table(spark, url_rules.host_rules(HOST_RULES), PATTERNS)
    found = url_rules.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    of = lambda tier, name: F.when(F.col("tier") == tier, F.col("rule")).alias(name)
    return found.select("row.page_id", "host", "path", of(0, "rule"), "verdict", of(1, "pattern"))


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation after damage."""
    return structure_repair.report(structure_repair.damage(table(spark, sf_dir, "conversations")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: made for name, made in globals().items() if name.startswith("op")}
