"""Seconds per registered query, and per full run, on ``$BENCH_SF_DIR``. Prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession

from txrisk.plans import full_run
from txrisk.sources.workspace import new_folder
from verification import adapter
from verification.queries import queries

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "2"))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("txrisk-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def everything(spark: SparkSession, sf_dir: str) -> None:
    inputs = full_run.Inputs(*[make(spark, sf_dir) for make in (
        adapter.transactions, adapter.cards, adapter.users, adapter.codes
    )])
    full_run.run(inputs, full_run.Settings(as_of=adapter.AS_OF), new_folder(spark, "run"))


def seconds(work) -> float:
    started = time.perf_counter()
    work()
    return time.perf_counter() - started


def main() -> None:
    spark = session()
    jobs = {
        name: (lambda query=query: consume(query(spark, SF_DIR)))
        for name, query in queries().items()
        if not sys.argv[1:] or name in sys.argv[1:]
    }
    if not sys.argv[1:]:
        jobs["full_run"] = lambda: everything(spark, SF_DIR)
    next(iter(jobs.values()))()  # warms the session up
    times = {name: round(min(seconds(job) for _ in range(REPEATS)), 3) for name, job in jobs.items()}
    rows = adapter.transactions(spark, SF_DIR).count()
    print(
        json.dumps(
            {
                "metric": "total time of all registered queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "transactions": rows,
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
