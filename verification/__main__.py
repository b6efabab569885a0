"""``python -m verification [sf_dir] [query ...]``: compare registered queries with their SQL."""

from __future__ import annotations

import sys
import time

from pyspark.sql import SparkSession

from verification.compare import database, differences
from verification.oracle import oracle_sql
from verification.queries import queries


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, sql, failed = database(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            rows, problems = differences(query(spark, sf_dir), connection, sql[name])
        except Exception as error:  # noqa: BLE001
            rows, problems = -1, [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok':4} {name:28} {rows:8} rows {time.time() - started:6.2f} s", flush=True)
        for problem in problems:
            print("     ", problem, flush=True)
    spark.stop()
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(*sys.argv[1:])))
