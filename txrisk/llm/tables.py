"""Reading the given tables, and the folds that are cut by document id."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str, folds: int) -> Column:
    """CRC32 of the id as text, modulo ``folds``; NULL for a NULL id."""
    return F.crc32(F.col(doc_id).cast("string")) % folds


def extended(rows: DataFrame, keep: tuple[str, ...], made: str) -> StructType:
    """The schema of some columns of ``rows`` and of made ones."""
    return StructType([*(rows.schema[c] for c in keep), *StructType.fromDDL(made).fields])


def whole_rows(docs: DataFrame) -> DataFrame:
    """``row``, a struct of all columns: operators may then add columns of any name, and find the text in ``row.text``, so that it
    goes to Python once."""
    return docs.select(F.struct("*").alias("row"))


def column(batch: pa.RecordBatch, path: str) -> pa.Array:
    """A column of a batch, or the field of a struct without NULLs, as in ``row.text``."""
    first, *fields = path.split(".")
    found = batch[first]
    for name in fields:
        found = found.field(name)
    return found


#: Bits of a membership filter: 4 MB, whatever it is made from.
FILTER_BITS = 1 << 25


def flag_members(rows: DataFrame, key: Column, members: DataFrame, member: Column) -> DataFrame:
    """``rows``, which has no column that begins with ``__``, with a column ``__maybe`` that is false only where ``key`` is no ``member``.

    A bitmap of hashes is joined to the rows: 1024 rows of 4 KB at most, so broadcasting it has a fixed bound. What is not
    flagged needs no join with the members; when the bitmap is full, all rows are flagged and the join that follows does the work.
    """

    def place(value: Column) -> Column:
        return F.pmod(F.xxhash64(value), F.lit(FILTER_BITS)) + 1

    made = members.select(place(member).alias("p")).groupBy(F.bitmap_bucket_number("p").alias("__bucket"))
    bits = made.agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("__bits"))
    placed = rows.withColumn("__place", place(key))
    joined = placed.join(F.broadcast(bits), F.bitmap_bucket_number("__place") == F.col("__bucket"), "left")
    at = F.bitmap_bit_position("__place")
    byte = F.conv(F.hex(F.substr("__bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    maybe = F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    return joined.select(*rows.columns, maybe.alias("__maybe"))
