"""JSON objects that hold a table as key/value pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.sources.json_members import scalar_members


def code_rows(objects: DataFrame, column: str = "value") -> DataFrame:
    """One row per key of every JSON object in ``column``: (``mcc_code``, ``mcc_category``).

    The value of a key is its description. A key that is no number gives a NULL code.
    """
    pairs = objects.select(F.explode(F.from_json(column, "map<string,string>")).alias("code", "text"))
    return pairs.select(
        F.col("code").try_cast("int").alias("mcc_code"),
        F.col("text").alias("mcc_category"),
    )


def label_rows(objects: DataFrame, column: str = "value", positive: str = "Yes", field: str | None = None) -> DataFrame:
    """One row per labelled transaction: (``transaction_id``, ``is_fraud``).

    ``field`` names the key under which the object of labels sits, if it is nested.
    """
    if field is None:
        parsed = F.from_json(column, "map<string,string>")
    else:
        parsed = F.from_json(column, f"struct<`{field}`: map<string,string>>").getField(field)
    pairs = objects.select(F.explode(parsed).alias("key", "label"))
    return pairs.select(
        F.col("key").try_cast("bigint").alias("transaction_id"),
        (F.col("label") == positive).alias("is_fraud"),
    )


def read_objects(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """The text of JSON objects: one per file (however many lines it has) or one per line."""
    return spark.read.text(path, wholetext=one_per_file)


def read_mcc_codes(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    return code_rows(read_objects(spark, path, one_per_file))


def read_code_pairs(spark: SparkSession, path: str) -> DataFrame:
    """The rows of :func:`code_rows` from an object of any size in each file, which many tasks read."""
    members = scalar_members(spark, path)
    return members.select(F.col("key").try_cast("int").alias("mcc_code"), F.col("value").alias("mcc_category"))


def read_label_pairs(
    spark: SparkSession, path: str, positive: str | Sequence[str] = "Yes", field: str | None = None
) -> DataFrame:
    """The rows of :func:`label_rows` from an object of any size in each file, which many tasks read.

    Labels are text, numbers or booleans; ``positive`` are those that mean fraud, as they are written. Without ``field`` the labels of nested
    objects count as well. What is no label is an error.
    """
    accepted = [positive] if isinstance(positive, str) else list(positive)
    members = scalar_members(spark, path, field)
    return members.select(
        F.col("key").try_cast("bigint").alias("transaction_id"),
        F.col("value").isin(accepted).alias("is_fraud"),
    )


def read_fraud_labels(
    spark: SparkSession,
    path: str,
    one_per_file: bool = True,
    positive: str = "Yes",
    field: str | None = None,
) -> DataFrame:
    return label_rows(read_objects(spark, path, one_per_file), positive=positive, field=field)
