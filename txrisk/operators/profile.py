"""Volume and quality of the loaded tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txrisk.functions import cleaning as C
from txrisk.functions.rounding import percent, ratio


def describe_schema(df: DataFrame) -> DataFrame:
    """One row per column: ordinal, name, type. Reads no data."""
    rows = [(i, field.name, field.dataType.simpleString()) for i, field in enumerate(df.schema, start=1)]
    return df.sparkSession.createDataFrame(rows, "ordinal int, name string, type string")


def preview(df: DataFrame, rows: int = 10, by: str | None = None) -> DataFrame:
    """Some rows, or the first ones by a column."""
    return (df if by is None else df.orderBy(by)).limit(rows)


def _distinct_with_null(name: str):
    """Distinct values, where NULL counts as one of them."""
    return F.count_distinct(name) + F.coalesce(F.max(F.col(name).isNull().cast("int")), F.lit(0))


def volumetry(tx: DataFrame) -> DataFrame:
    """Rows, distinct clients, cards and merchants, and rows per card and per client."""
    return tx.agg(
        F.count("*").alias("n_tx"),
        _distinct_with_null("client_id").alias("n_clients"),
        _distinct_with_null("card_id").alias("n_cards"),
        _distinct_with_null("merchant_id").alias("n_merchants"),
    ).select(
        "*",
        ratio(F.col("n_tx"), F.col("n_cards")).alias("tx_per_card"),
        ratio(F.col("n_tx"), F.col("n_clients")).alias("tx_per_client"),
    )


def summed_volumetry(daily: DataFrame, merchants: DataFrame) -> DataFrame:
    """As :func:`volumetry`, from :func:`txrisk.operators.indicators.daily` and a table with one row for each merchant.

    Every identity is counted by two sums, first per value and then over the values (NULL being one), so no row is copied for the other
    counts.
    """
    per = [
        (rows.groupBy(key).agg(*measure) if measure else rows.select(key).distinct()).agg(F.count("*").alias(name), *total)
        for rows, key, name, measure, total in (
            (daily, "client_id", "n_clients", [F.sum("n_tx").alias("n_tx")], [F.sum("n_tx").alias("n_tx")]),
            (daily, "card_id", "n_cards", [], []),
            (merchants, "merchant_id", "n_merchants", [], []),
        )
    ]
    rows = per[0].unionByName(per[1], allowMissingColumns=True).unionByName(per[2], allowMissingColumns=True)
    names = ("n_tx", "n_clients", "n_cards", "n_merchants")
    return rows.agg(*[F.coalesce(F.max(n), F.lit(0)).alias(n) for n in names]).select(
        *names,
        ratio(F.col("n_tx"), F.col("n_cards")).alias("tx_per_card"),
        ratio(F.col("n_tx"), F.col("n_clients")).alias("tx_per_client"),
    )


def _per_column(df: DataFrame, measures: dict[str, dict], names: list[str], labels: list[str]) -> DataFrame:
    """One aggregation over the table, laid out as one row per column name."""
    flat = [
        expression.alias(f"{measure}__{i}")
        for measure, columns in measures.items()
        for i, expression in enumerate(columns.values())
    ]
    rows = F.array(
        *[
            F.struct(
                F.lit(label).alias("column_name"),
                *[F.col(f"{measure}__{i}").alias(measure) for measure in measures],
            )
            for i, label in enumerate(labels)
        ]
    )
    return df.agg(F.count("*").alias("n_rows"), *flat).select("n_rows", F.inline(rows))


class Observed:
    """:func:`null_profile` and :func:`quality` of the rows that a job passes through anyway: no scan of their own.

    Give :attr:`rows` to the job that writes the table, then ask for the reports; before that they wait for it. One row of counts comes
    to the driver. Names of columns may be any.
    """

    def __init__(self, tx: DataFrame, columns: list[str], name: str = "profile"):
        self.spark, self.columns = tx.sparkSession, list(columns)
        self.observation = Observation(f"{name}-{uuid.uuid4().hex}")
        missing = [F.count_if(C.is_missing(_named(c))).alias(f"missing_{i}") for i, c in enumerate(self.columns)]
        issues = [F.count_if(F.coalesce(test, F.lit(False))).alias(f"issue_{name}") for name, test in _issues().items()]
        self.rows = tx.observe(self.observation, F.count(F.lit(1)).alias("n_rows"), *missing, *issues)

    def _report(self, key: str, count: str, share: str, counts: dict[str, int]) -> DataFrame:
        n = self.observation.get["n_rows"]
        made = self.spark.createDataFrame([(k, v, n) for k, v in counts.items()], f"{key} string, {count} bigint, n_rows bigint")
        return made.select(key, count, percent(F.col(count), F.col("n_rows")).alias(share))

    def null_profile(self) -> DataFrame:
        found = self.observation.get
        return self._report("column_name", "n_missing", "pct_missing", {c: found[f"missing_{i}"] for i, c in enumerate(self.columns)})

    def quality(self) -> DataFrame:
        found = self.observation.get
        return self._report("issue", "n_tx", "pct_tx", {name: found[f"issue_{name}"] for name in _issues()})


def _named(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def null_profile(df: DataFrame) -> DataFrame:
    """NULL or empty values of every column, in a single pass over the table."""
    names = df.columns
    counted = _per_column(
        df, {"n_missing": {name: F.count_if(C.is_missing(F.col(name))) for name in names}}, names, names
    )
    return counted.select(
        "column_name", "n_missing", percent(F.col("n_missing"), F.col("n_rows")).alias("pct_missing")
    )


def _issues() -> dict[str, Column]:
    return {
        "non_positive_amount": F.col("amount_clean") <= 0,
        "missing_mcc": C.is_missing(F.col("mcc")),
        "with_error": C.has_error(F.col("errors")),
        "unparsed_amount": ~C.is_missing(F.col("amount")) & F.col("amount_clean").isNull(),
        "unparsed_date": ~C.is_missing(F.col("date")) & F.col("tx_ts").isNull(),
    }


def quality(tx: DataFrame) -> DataFrame:
    """Counts of doubtful rows. ``tx`` is the cleaned table; bad text is text that did not parse."""
    issues = _issues()
    counted = _per_column(
        tx,
        {"n_tx": {name: F.count_if(F.coalesce(test, F.lit(False))) for name, test in issues.items()}},
        list(issues),
        list(issues),
    )
    return counted.select(
        F.col("column_name").alias("issue"), "n_tx", percent(F.col("n_tx"), F.col("n_rows")).alias("pct_tx")
    )


def type_suspects(df: DataFrame) -> DataFrame:
    """Columns whose type does not fit their values: money held as text, codes held as doubles."""
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    doubles = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    names = text + doubles
    misfits = {name: F.count_if(F.col(name).rlike(r"^-?\$")) for name in text}
    misfits |= {name: F.count_if(F.col(name) == F.floor(name)) for name in doubles}
    values = {name: F.count_if(~C.is_missing(F.col(name))) for name in names}
    counted = _per_column(df, {"n_values": values, "n_misfits": misfits}, names, names)
    kind = F.when(F.col("column_name").isin(*text), F.lit("money as text")).otherwise(F.lit("code as double"))
    suspect = F.when(kind == "money as text", F.col("n_misfits") > 0).otherwise(
        (F.col("n_values") > 0) & (F.col("n_misfits") == F.col("n_values"))
    )
    return counted.filter(suspect).select("column_name", kind.alias("suspicion"), "n_values", "n_misfits")
