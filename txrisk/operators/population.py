"""Clients of suspicious cards compared with all others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.functions.rounding import mean_amount, ratio
from txrisk.operators.enrich import user_attributes
from txrisk.operators.facts import totals

SUSPECT, NORMAL = "Suspect", "Normal"


def suspect_clients(facts: DataFrame, suspicious: DataFrame) -> DataFrame:
    """Clients who used a suspicious card at least once."""
    pairs = facts.filter(F.col("client_id").isNotNull()).groupBy("client_id", "card_id").agg(*totals("n_tx"))
    return pairs.join(suspicious.select("card_id"), "card_id", "left_semi").select("client_id").distinct()


def population_profile(facts: DataFrame, suspicious: DataFrame, users: DataFrame) -> DataFrame:
    """Two rows, also when one side is empty. Transactions without a client count as normal.

    The means are over transactions. The rows are summed once, by client and card, and these sums by client. The means
    are of one row per client, weighted by the client's transactions, so neither list nor client table meets the rows.
    """
    n, measures = F.col("n_tx"), totals("n_tx", "n_amount", "net_cents")
    is_suspect = F.col("client_id").isNotNull() & F.col("suspect").isNotNull()
    clients = (
        facts.groupBy("client_id", "card_id").agg(*measures)
        .join(suspicious.select("card_id", F.lit(True).alias("suspect")), "card_id", "left")
        .groupBy("client_id").agg(*measures, F.max("suspect").alias("suspect"))
        .withColumn("client_type", F.when(is_suspect, SUSPECT))
        .join(user_attributes(users), "client_id", "left")
    )

    def weighted(column):
        return F.sum(column * n), F.sum(F.when(column.isNotNull(), n))

    score, n_score = weighted(F.col("credit_score"))
    age, n_age = weighted(F.col("current_age"))
    income, n_income = weighted((F.col("yearly_income_clean") * 100).cast("bigint"))
    measured = clients.groupBy(F.coalesce("client_type", F.lit(NORMAL)).alias("client_type")).agg(
        F.sum(n).alias("n_tx"),
        mean_amount(F.sum("net_cents"), F.sum("n_amount")).alias("mean_amount"),
        ratio(score, n_score).alias("mean_credit_score"),
        ratio(age, n_age).alias("mean_age"),
        mean_amount(income, n_income).alias("mean_income"),
    )
    kinds = facts.sparkSession.range(1).select(
        F.explode(F.array(F.lit(SUSPECT), F.lit(NORMAL))).alias("client_type")
    )
    return kinds.join(measured, "client_type", "left").fillna(0, ["n_tx"])
