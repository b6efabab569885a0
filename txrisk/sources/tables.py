"""Row-file inputs with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from txrisk import schemas

CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, schema: T.StructType, keep_corrupt: bool = False) -> DataFrame:
    """CSV with a header, matched to the schema by column name.

    The header of the first file gives the order of the columns; that is the only thing looked at before
    the scan. Spark compares every other file's header with it and fails on one that has another order. A value that does not fit its type becomes NULL, and ``keep_corrupt`` adds the whole line
    of it. Spark parses only the columns a query uses, so read all of them to see all such lines.
    """
    header = spark.read.option("header", True).csv(path).columns
    known = {field.name: field for field in schema}
    ordered = T.StructType([known.get(name, T.StructField(name, T.StringType())) for name in header])
    if keep_corrupt:
        ordered.add(CORRUPT, T.StringType())
    table = (
        spark.read.schema(ordered)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )
    return table.select(*[name for name in known if name in header], *([CORRUPT] if keep_corrupt else []))


def read_transactions(spark: SparkSession, path: str, keep_corrupt: bool = False) -> DataFrame:
    return read_csv(spark, path, schemas.TRANSACTIONS, keep_corrupt)


def read_cards(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.CARDS)


def read_users(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.USERS)
