"""The given test tables, shaped like card-transaction data.

Whole tables are used throughout. Ids of cards, users and codes are spread out a little, so that some
transactions find no card, no user or no category. The same shapes are written as SQL in ``oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2024-01-30"

ERRORS = ("Insufficient Balance", "Bad PIN", "Technical Glitch", "Card Expired")


SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string",
    "labels": "doc_id bigint, toxic int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def as_transactions(events: DataFrame) -> DataFrame:
    kind, k = F.col("event_type"), F.get_json_object("props", "$.k").cast("int")
    refund = (kind == "signup") & (k < 20)
    amount = (F.col("value").cast("decimal(12,2)") * 4).cast("decimal(12,2)").cast("string")
    failure = F.element_at(F.array(*[F.lit(text) for text in ERRORS]), k % 4 + 1)
    return events.select(
        F.col("event_id").alias("id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("date"),
        F.floor(F.col("user_id") / 3).cast("bigint").alias("client_id"),
        F.col("user_id").alias("card_id"),
        F.concat(F.when(refund, F.lit("$-")).otherwise(F.lit("$")), amount).alias("amount"),
        k.cast("bigint").alias("merchant_id"),
        F.when(kind == "view", F.lit("ONLINE"))
        .otherwise(F.concat(F.lit("NATION_"), (k % 25).cast("string")))
        .alias("merchant_city"),
        F.when(kind != "view", (k + 10000).cast("string")).alias("zip"),
        F.when(k != 99, k + 5000).alias("mcc"),
        F.when(kind == "error", failure).when(kind == "click", F.lit("")).alias("errors"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_transactions(table(spark, sf_dir, "events"))


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, nation, segment = F.col("c_custkey"), F.col("c_nationkey"), F.col("c_mktsegment")
    month = F.when(key % 7 == 0, F.lit("01/2024")).otherwise(
        F.concat(F.lpad((nation % 12 + 1).cast("string"), 2, "0"), F.lit("/"), (nation + 2000).cast("string"))
    )
    return table(spark, sf_dir, "customer").select(
        (key + F.floor(key / 9)).cast("bigint").alias("id"),
        F.element_at(F.array(F.lit("Visa"), F.lit("Mastercard"), F.lit("Amex")), nation % 3 + 1).alias("card_brand"),
        F.when(segment.isin("BUILDING", "MACHINERY"), F.lit("Debit"))
        .when(segment == "FURNITURE", F.lit("Debit (Prepaid)"))
        .otherwise(F.lit("Credit"))
        .alias("card_type"),
        F.when(nation % 2 == 0, F.lit("YES")).otherwise(F.lit("NO")).alias("has_chip"),
        F.concat(F.lit("$"), F.abs("c_acctbal").cast("decimal(12,2)").cast("string")).alias("credit_limit"),
        month.alias("acct_open_date"),
        (nation % 15 + 2005).cast("int").alias("year_pin_last_changed"),
        F.when(nation % 10 == 0, F.lit("Yes")).otherwise(F.lit("No")).alias("card_on_dark_web"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    balance_cents = (F.col("c_acctbal").cast("decimal(12,2)") * 100).cast("bigint")
    return table(spark, sf_dir, "customer").select(
        (key + F.floor(key / 4)).cast("bigint").alias("id"),
        (nation * 2 + 18).cast("int").alias("current_age"),
        F.when(key % 2 == 0, F.lit("Female")).otherwise(F.lit("Male")).alias("gender"),
        F.concat(F.lit("$"), (key * 7 + 20000).cast("string")).alias("yearly_income"),
        F.floor((balance_cents + 100000) * 350 / 1100000 + 500).cast("int").alias("credit_score"),
        (nation % 5 + 1).cast("int").alias("num_credit_cards"),
    )


def code_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON object per part, ``{"<code>": "<description>"}``."""
    code = (F.col("p_partkey") + F.floor(F.col("p_partkey") / 10) + 5000).cast("bigint").cast("string")
    return table(spark, sf_dir, "part").select(F.to_json(F.create_map(code, F.col("p_name"))).alias("value"))


def codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = (F.col("p_partkey") + F.floor(F.col("p_partkey") / 10) + 5000).cast("int")
    return table(spark, sf_dir, "part").select(code.alias("mcc_code"), F.col("p_name").alias("mcc_category"))


def label_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON object per label, ``{"<id>": "Yes"}`` or ``"No"``."""
    answer = F.when(F.col("toxic") == 1, F.lit("Yes")).otherwise(F.lit("No"))
    return table(spark, sf_dir, "labels").select(
        F.to_json(F.create_map(F.col("doc_id").cast("string"), answer)).alias("value")
    )


#: Text that a code's description ends with in :func:`code_members`.
HARD = ', "fine" {and} \\ other'


def _member(key: Column, value: Column) -> Column:
    """``"key":"value"``, escaped."""
    pair = F.to_json(F.create_map(key.cast("string"), value))
    return F.substr(pair, F.lit(2), F.length(pair) - 2)


def code_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The codes as members of an object, ``"<code>":"<description>"``, with commas, quotes and braces in the text."""
    return codes(spark, sf_dir).select(_member(F.col("mcc_code"), F.concat("mcc_category", F.lit(HARD))).alias("value"))


POSITIVE = ("1", "true", "Yes", 'Yes, "sure"')


def label_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels as members of an object: numbers, booleans, text, and text with commas and quotes."""
    key, yes = F.col("doc_id"), F.col("toxic") == 1
    plain = F.concat(F.lit('"'), key.cast("string"), F.lit('":'))
    number = F.concat(plain, F.when(yes, "1").otherwise("0"))
    boolean = F.concat(plain, F.when(yes, "true").otherwise("false"))
    text = _member(key, F.when(yes, "Yes").otherwise("No"))
    hard = _member(key, F.when(yes, POSITIVE[3]).otherwise("No, } {\"not\": 1"))
    kind = F.pmod(key, F.lit(4))
    value = F.when(kind == 0, number).when(kind == 1, boolean).when(kind == 2, text).otherwise(hard)
    return table(spark, sf_dir, "labels").select(value.alias("value"))


def write_objects(members: DataFrame, folder: str, begin: str, end: str, files: int = 4) -> None:
    """JSON objects, one per file: ``begin``, a comma and a member a line, ``end``."""
    bucket = F.pmod(F.xxhash64("value"), F.lit(files))
    rows = members.select(bucket.alias("bucket"), F.lit(1).alias("place"), F.concat(F.lit(", "), "value").alias("value"))
    for place, text in ((0, begin), (2, end)):
        rows = rows.union(members.sparkSession.range(files).select("id", F.lit(place), F.lit(text)))
    rows.repartition("bucket").sortWithinPartitions("bucket", "place").select("bucket", "value").write.partitionBy("bucket").text(folder)


def streamed_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.readStream.schema(SCHEMAS["events"])
    return as_transactions(events.option("pathGlobFilter", "events.parquet").parquet(sf_dir))

