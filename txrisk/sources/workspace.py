"""The shared folder for written intermediate tables and streaming checkpoints."""

from __future__ import annotations

import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"

_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names. Only a local session may fall back to a folder of this machine."""
    folder = spark.conf.get(SETTING, None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder that every executor can reach")
    if context.applicationId not in _local:
        _local[context.applicationId] = tempfile.mkdtemp(prefix="txrisk-")
    return _local[context.applicationId]


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later steps start from files, whatever
    becomes of the executors that computed them, and several readers share one computation."""
    folder = new_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def stage_all(**tables: DataFrame) -> dict[str, DataFrame]:
    """:func:`stage` several tables, a few at the same time."""
    with ThreadPoolExecutor(4) as pool:
        return dict(zip(tables, pool.map(stage, tables.values(), tables)))
