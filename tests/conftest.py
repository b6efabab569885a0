from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from txrisk import schemas  # noqa: E402
from txrisk.operators.facts import clean, facts  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("txrisk-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


DEFAULTS = {
    "date": "2024-01-15 12:00:00",
    "client_id": 1,
    "card_id": 1,
    "amount": "$10.00",
    "merchant_id": 1,
    "merchant_city": "Paris",
    "zip": "01234",
    "mcc": 5812,
    "errors": None,
}


class Build:
    """Hand-written rows in the shape of the input tables; what is not given has a default."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def raw(self, *rows: dict):
        names = schemas.TRANSACTIONS.names
        filled = [{"id": i, **DEFAULTS, **row} for i, row in enumerate(rows)]
        return self.spark.createDataFrame([[r[n] for n in names] for r in filled], schemas.TRANSACTIONS)

    def facts(self, *rows: dict):
        return facts(clean(self.raw(*rows)))

    def cards(self, *rows: dict):
        default = dict.fromkeys(schemas.CARDS.names) | {"card_on_dark_web": "No", "credit_limit": "$1000"}
        return self.spark.createDataFrame(
            [[{**default, **r}[n] for n in schemas.CARDS.names] for r in rows], schemas.CARDS
        )

    def users(self, *rows: dict):
        default = dict.fromkeys(schemas.USERS.names)
        return self.spark.createDataFrame(
            [[{**default, **r}[n] for n in schemas.USERS.names] for r in rows], schemas.USERS
        )

    def codes(self, **named: str):
        rows = [(int(code.removeprefix("c")), text) for code, text in named.items()]
        return self.spark.createDataFrame(rows, schemas.CODES)

    def column(self, kind: str, *values):
        return self.spark.createDataFrame([(v,) for v in values], f"v {kind}")


@pytest.fixture(scope="session")
def build(spark):
    return Build(spark)


@pytest.fixture(scope="session")
def rows():
    """Result rows as plain tuples, sorted with NULL first."""

    def collected(df, *columns):
        found = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
        return sorted(found, key=lambda r: tuple((v is not None, v) for v in r))

    return collected
