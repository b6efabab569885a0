"""One callable per registered query, over the tables of ``adapter.py``."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.operators import (
    activity,
    amounts,
    by_card,
    cards,
    categories,
    city_days,
    enrich,
    errors,
    features,
    identities,
    indicators,
    population,
    profile,
    rules,
    score,
    sequences,
    sketches,
    synthesis,
)
from txrisk.operators.facts import clean, facts, rollup
from txrisk.operators.summary import part, summary
from txrisk.params import CARD_ERROR_BANDS, CLIENT_ERROR_BANDS, BurstRules, DecisionRules, Thresholds
from txrisk.sources import code_maps, parquet, tables
from txrisk.sources.by_card import ByCard, write_by_card
from txrisk.sources.workspace import new_folder, stage, stage_all
from txrisk.streaming import bursts
from txrisk.streaming import cards as streaming
from verification import adapter

# The defaults flag nothing or everything on the test tables; these parameters flag some.
FLAGGED = Thresholds(max_tx=6)
STRICT = Thresholds(max_tx=7, max_cities=6, max_amount=2500)
BURSTS = BurstRules(velocity_tx=2, pin_errors=2, pin_seconds=86400, pin_lockout=2, dormant_days=3)
STREAM_BURSTS = BurstRules(velocity_tx=2, pin_errors=2, pin_seconds=3600)
DECISIONS = DecisionRules(merchant_max_tx=95)

Query = Callable[[SparkSession, str], DataFrame]


class Given:
    """The input tables of one query; only those that are asked for are opened."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def raw(self) -> DataFrame:
        return adapter.transactions(self.spark, self.sf_dir)

    @cached_property
    def tx(self) -> DataFrame:
        return clean(self.raw)

    @cached_property
    def facts(self) -> DataFrame:
        return facts(self.tx)

    @cached_property
    def cards(self) -> DataFrame:
        return adapter.cards(self.spark, self.sf_dir)

    @cached_property
    def users(self) -> DataFrame:
        return adapter.users(self.spark, self.sf_dir)

    @cached_property
    def codes(self) -> DataFrame:
        return adapter.codes(self.spark, self.sf_dir)

    @cached_property
    def card_days(self) -> DataFrame:
        return indicators.card_days(self.facts)

    @cached_property
    def moments(self) -> DataFrame:
        return sequences.moments(self.facts)

    @cached_property
    def stored(self) -> ByCard:
        """The transactions stored by card; so few make a card busy that some are."""
        folder = new_folder(self.spark, "by-card")
        return write_by_card(self.tx, "by_card_" + folder[-32:], folder, hot_rows=20)

    @cached_property
    def scores(self) -> DataFrame:
        return score.risk_scores(self.card_days)

    def suspicious(self, limits: Thresholds = FLAGGED) -> DataFrame:
        return rules.suspicious_cards(self.card_days, self.cards, limits)


def joined(suspicious: DataFrame) -> DataFrame:
    return suspicious.withColumn("reasons", F.array_join("reasons", ","))


def enriched_columns(enriched: DataFrame) -> DataFrame:
    return enriched.select(
        "id",
        "client_id",
        "card_id",
        F.col("amount_clean").cast("double").alias("amount"),
        "merchant_category",
        "card_brand",
        "card_type",
        "card_on_dark_web",
        F.col("credit_limit_clean").cast("double").alias("credit_limit"),
        "has_chip",
        "year_pin_last_changed",
        "current_age",
        "gender",
        "credit_score",
        F.col("yearly_income_clean").cast("double").alias("yearly_income"),
        "num_credit_cards",
    )


def inferred(g: Given) -> DataFrame:
    """The raw table as type inference would have read it: zip codes as doubles."""
    return g.raw.withColumn("zip", F.col("zip").cast("double"))


def all_features(g: Given) -> DataFrame:
    shared = stage_all(daily=indicators.daily(g.facts), moments=g.moments, per_code=rollup(g.facts, "mcc"))
    groups = features.feature_groups(
        g.facts, **shared, codes=g.codes, cards=g.cards, users=g.users, as_of=adapter.AS_OF
    )
    return features.transaction_features(g.facts, stage_all(**groups))


def csv_roundtrip(g: Given) -> DataFrame:
    """The raw table written as CSV, read with the declared schema and cleaned."""
    folder = new_folder(g.spark, "csv")
    g.raw.write.option("header", True).csv(folder)
    back = clean(tables.read_transactions(g.spark, folder))
    return back.select(
        "id",
        "tx_ts",
        "client_id",
        "card_id",
        F.col("amount_clean").cast("double").alias("amount"),
        "merchant_id",
        "merchant_city",
        "zip",
        "mcc",
        "errors",
    )


def parquet_roundtrip(g: Given) -> DataFrame:
    folder = new_folder(g.spark, "risk-scores")
    parquet.write_parquet(g.scores, folder)
    return parquet.read_scores(g.spark, folder, above=50)


def suspicious_saved(g: Given) -> DataFrame:
    folder = new_folder(g.spark, "suspicious-cards")
    parquet.write_parquet(g.suspicious(), folder)
    return joined(g.spark.read.parquet(folder))


def scores_appended(g: Given) -> DataFrame:
    folder, even = new_folder(g.spark, "risk-scores"), F.col("card_id") % 2 == 0
    parquet.write_parquet(g.scores.filter(even), folder)
    parquet.write_parquet(g.scores.filter(~even), folder, mode="append")
    return parquet.read_scores(g.spark, folder)


def scores_appended_once(g: Given) -> DataFrame:
    """Two batches, the second written twice, as by a job that is repeated."""
    folder, even = new_folder(g.spark, "risk-scores-once"), F.col("card_id") % 2 == 0
    parquet.append_once(g.scores.filter(even), folder, "even")
    for _ in range(2):
        parquet.append_once(g.scores.filter(~even), folder, "odd")
    return parquet.read_appended(g.spark, folder)


def observed(g: Given) -> profile.Observed:
    """Counted while the transactions are written."""
    seen = profile.Observed(g.tx, g.raw.columns)
    stage(seen.rows, "observed")
    return seen


def cards_csv(g: Given) -> DataFrame:
    folder = new_folder(g.spark, "cards")
    g.cards.write.option("header", True).csv(folder)
    return tables.read_cards(g.spark, folder)


def users_csv(g: Given) -> DataFrame:
    folder = new_folder(g.spark, "users")
    g.users.write.option("header", True).csv(folder)
    return tables.read_users(g.spark, folder)


def codes_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The code objects written as text, one per line, and read from there."""
    folder = new_folder(spark, "codes")
    adapter.code_objects(spark, sf_dir).write.text(folder)
    return code_maps.read_mcc_codes(spark, folder, one_per_file=False)


def labels_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels written as pairs that commas separate, as inside one object, and read from there."""
    folder = new_folder(spark, "labels")
    adapter.label_objects(spark, sf_dir).select(F.btrim("value", F.lit("{}"))).write.option("lineSep", ",").text(folder)
    return code_maps.read_label_pairs(spark, folder)


def codes_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes from whole objects, one per file, that many tasks may read."""
    folder = new_folder(spark, "codes-object")
    adapter.write_objects(adapter.code_members(spark, sf_dir), folder, '{ "no code": null', "}")
    return code_maps.read_code_pairs(spark, folder).filter("mcc_code IS NOT NULL")


def labels_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of several types from one field of whole objects that hold others as well."""
    folder = new_folder(spark, "labels-object")
    members = adapter.label_members(spark, sf_dir)
    adapter.write_objects(members, folder, '{"version": {"0": 1}, "target": {"no id": "Yes"', '}, "more": {"1": "Yes, 2"}}')
    labels = code_maps.read_label_pairs(spark, folder, adapter.POSITIVE, "target")
    return labels.filter("transaction_id IS NOT NULL")


def enriched_saved(g: Given) -> DataFrame:
    folder = new_folder(g.spark, "transactions-enriched")
    parquet.write_parquet(enrich.enrich(g.tx, g.codes, g.cards, g.users), folder, partition_by=["tx_date"])
    return (
        g.spark.read.parquet(folder)
        .groupBy("tx_date", "merchant_category")
        .agg(F.count("*").alias("n_tx"), F.sum("amount_clean").cast("double").alias("amount_net"))
    )


def _streamed(name: str, build: Callable[[DataFrame, Given], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        stream = streaming.timed(adapter.streamed_transactions(spark, sf_dir))
        return streaming.drain(build(stream, Given(spark, sf_dir)), name)

    return query


def amount_medians(g: Given) -> DataFrame:
    """Of the medians per code and over all, read off the summary's sketches: whether their ranks keep the stated error."""
    by_code = part(summary(g.facts), "code")
    everything = by_code.withColumn("mcc", F.lit(-1))
    quantiles = sketches.amount_quantiles(by_code.union(everything).filter("mcc IS NOT NULL"), ["mcc"])
    rows = g.facts.select("mcc", "n_pos", "pos_cents")
    off = sketches.off_by(rows.union(rows.withColumn("mcc", F.lit(-1))), quantiles, ["mcc"], "p50", 0.5)
    return quantiles.join(off, "mcc").select("mcc", "n_pos", (F.col("off_by") <= sketches.rank_error()).alias("within_error"))


def amount_stats_sketched(g: Given) -> DataFrame:
    """The statistics of the summary; of its median whether its rank keeps the stated error."""
    found = sketches.sketched_amount_stats(part(summary(g.facts), "amount"))
    off = sketches.off_by(g.facts.select("n_pos", "pos_cents"), found, [], "median_amount", 0.5)
    within = (off.scalar() <= sketches.rank_error()).alias("median_within_error")
    return found.select("mean_amount", "min_amount", "max_amount", within)


def suspects_by_month(g: Given) -> DataFrame:
    return identities.members_in_groups(identities.identity_rows(g.facts, "tx_month"), g.suspicious())


def city_spans(g: Given) -> DataFrame:
    daily = indicators.daily(g.facts)
    return city_days.city_days(daily, city_days.numbered_cities(daily))


def _exactly(name: str, build: Callable[[DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        with bursts.arbitrary_state(spark):
            return streaming.drain(build(streaming.timed(adapter.streamed_transactions(spark, sf_dir))), name)

    return query


BATCH: dict[str, Callable[[Given], DataFrame]] = {
    "volumetry": lambda g: profile.volumetry(g.tx),
    "summed_volumetry": lambda g: profile.summed_volumetry(indicators.daily(g.facts), categories.merchant_totals(g.facts)),
    "amount_medians": amount_medians,
    "amount_stats_sketched": amount_stats_sketched,
    "active_by_month": lambda g: identities.distinct_identities(identities.identity_rows(g.facts, "tx_month"), "tx_month"),
    "suspects_by_month": suspects_by_month,
    "card_lifetime_bitmaps": lambda g: city_days.card_lifetime(city_spans(g)),
    "weekly_cities": lambda g: city_days.weekly_cities(city_spans(g)),
    "null_profile": lambda g: profile.null_profile(g.raw),
    "quality": lambda g: profile.quality(g.tx),
    "type_suspects": lambda g: profile.type_suspects(inferred(g)),
    "amount_stats": lambda g: amounts.amount_stats(g.facts, exact=True),
    "amount_bands": lambda g: amounts.amount_bands(amounts.with_amount_band(g.facts)),
    "high_amount_share": lambda g: amounts.high_amount_share(g.facts),
    "by_hour": lambda g: activity.by_hour(g.facts),
    "by_dow": lambda g: activity.by_day_of_week(g.facts),
    "by_month": lambda g: activity.by_month(g.facts),
    "night_share": lambda g: activity.night_share(g.facts),
    "category_volume": lambda g: categories.category_volume(g.facts, g.codes),
    "category_volume_top": lambda g: categories.top_categories(g.facts, g.codes),
    "category_high_mean": lambda g: categories.top_category_means(g.facts, g.codes),
    "category_risk": lambda g: categories.category_risk(g.facts, g.codes),
    "merchant_reputation": lambda g: categories.merchants(g.facts),
    "suspicious_merchants": lambda g: categories.suspicious_merchants(g.facts, DECISIONS),
    "error_types": lambda g: errors.top_error_types(g.facts),
    "top_error_type": lambda g: errors.top_error_type(g.facts),
    "error_type_risk": lambda g: errors.error_type_risk(g.facts),
    "card_error_rate": lambda g: errors.card_error_rates(g.facts),
    "client_error_rate": lambda g: errors.client_error_rates(g.facts),
    "card_error_rate_sketched": lambda g: errors.card_error_rates(g.facts, bits=18),
    "client_error_rate_sketched": lambda g: errors.client_error_rates(g.facts, bits=18),
    "card_error_bands": lambda g: errors.error_rate_bands(g.facts, "card_id", CARD_ERROR_BANDS),
    "client_error_bands": lambda g: errors.error_rate_bands(g.facts, "client_id", CLIENT_ERROR_BANDS),
    "credit_band_errors": lambda g: errors.credit_band_errors(g.facts, g.users),
    "weak_profiles": lambda g: errors.weak_profiles(g.facts, g.users),
    "dominant_error": lambda g: errors.dominant_errors(g.facts),
    "error_concentration": lambda g: errors.error_concentration(g.facts),
    "card_type_brand": lambda g: cards.card_type_brand(g.facts, g.cards),
    "card_type_risk": lambda g: cards.card_type_risk(g.facts, g.cards),
    "dark_web_count": lambda g: cards.dark_web_count(g.facts, g.cards),
    "dark_web_cards": lambda g: cards.top_dark_web_cards(g.facts, g.cards),
    "card_age": lambda g: cards.card_ages(g.cards, adapter.AS_OF).select("card_id", "card_age_days"),
    "pin_recency": lambda g: cards.card_ages(g.cards, adapter.AS_OF).select("card_id", "pin_age_years"),
    "new_card_burst": lambda g: cards.new_card_bursts(g.facts, g.cards, adapter.AS_OF),
    "stale_pin": lambda g: cards.stale_pins(g.facts, g.cards, adapter.AS_OF),
    "enriched": lambda g: enriched_columns(enrich.enrich(g.tx, g.codes, g.cards, g.users)),
    "card_day_tx": lambda g: indicators.card_day_tx(g.facts),
    "card_day_tx_top": lambda g: indicators.top_indicators(g.facts)["transactions"],
    "card_day_spend": lambda g: indicators.card_day_spend(g.facts),
    "card_day_spend_top": lambda g: indicators.top_indicators(g.facts)["spend"],
    "card_day_cities": lambda g: indicators.card_day_cities(g.facts),
    "card_day_cities_top": lambda g: indicators.top_indicators(g.facts)["cities"],
    "card_error_ratio": lambda g: indicators.card_error_ratio(g.facts),
    "card_error_ratio_top": lambda g: indicators.top_indicators(g.facts)["errors"],
    "card_lifetime": lambda g: indicators.card_lifetime(g.facts),
    "card_day_indicators": lambda g: indicators.card_day_indicators(g.card_days),
    "weekly_tx": lambda g: indicators.weekly_tx(g.facts),
    "online_ratio": lambda g: indicators.online_ratio(g.facts),
    "suspicious_cards": lambda g: joined(g.suspicious()),
    "suspicious_cards_top": lambda g: joined(rules.top_suspicious_cards(g.suspicious())),
    "suspicious_count": lambda g: rules.suspicious_count(g.suspicious()),
    "suspicion_reasons": lambda g: rules.suspicion_reasons(g.suspicious()),
    "criteria_levels": lambda g: joined(rules.criteria_levels(g.suspicious())),
    "risk_score_card_day": lambda g: g.scores,
    "risk_score_top": lambda g: score.top_risk_scores(g.scores),
    "risk_score_bands": lambda g: score.score_bands(g.scores),
    "score_levels": lambda g: score.score_levels(g.scores),
    "population_profile": lambda g: population.population_profile(g.facts, g.suspicious(STRICT), g.users),
    "time_since_last_tx": lambda g: sequences.time_since_last(g.facts, g.moments),
    "amount_deviation": lambda g: features.amount_deviation(g.facts),
    "credit_limit_ratio": lambda g: features.credit_limit_ratio(g.facts, g.cards),
    "error_streaks": lambda g: sequences.error_streaks(g.moments),
    "consecutive_errors": lambda g: sequences.consecutive_errors(g.moments),
    "pin_lockout": lambda g: sequences.pin_lockouts(g.moments, BURSTS),
    "velocity_5min": lambda g: sequences.velocity_bursts(g.moments, BURSTS),
    "pin_burst": lambda g: sequences.pin_bursts(g.moments, BURSTS),
    "dormant_reactivation": lambda g: sequences.dormant_reactivations(g.moments, BURSTS),
    "synthesis_metrics": lambda g: synthesis.synthesis_metrics(g.facts, g.facts, g.card_days, g.cards, g.users),
    "transaction_features": all_features,
    "csv_roundtrip": csv_roundtrip,
    "parquet_roundtrip": parquet_roundtrip,
    "scores_appended": scores_appended,
    "scores_appended_once": scores_appended_once,
    "observed_null_profile": lambda g: observed(g).null_profile(),
    "observed_quality": lambda g: observed(g).quality(),
    "schema": lambda g: profile.describe_schema(g.raw),
    "preview": lambda g: profile.preview(g.raw, by="id").select("id", "client_id", "card_id", "merchant_id", "merchant_city", "zip", "mcc"),
    "cards_csv": cards_csv,
    "users_csv": users_csv,
    "suspicious_cards_saved": suspicious_saved,
    "enriched_saved": enriched_saved,
    "moments_by_card": lambda g: by_card.moments(g.stored).drop("second"),
    "card_error_ratio_by_card": lambda g: by_card.card_error_rates(g.stored),
    "enriched_by_card": lambda g: enriched_columns(by_card.enrich(g.stored, g.codes, g.cards, g.users)),
}

STREAMS: dict[str, Query] = {
    "stream_card_day": _streamed(
        "card-days", lambda stream, g: indicators.card_day_indicators(streaming.card_days(stream))
    ),
    "stream_velocity": _streamed("velocity", lambda stream, g: streaming.velocity_alerts(stream, STREAM_BURSTS)),
    "stream_pin_burst": _streamed("pins", lambda stream, g: streaming.pin_alerts(stream, STREAM_BURSTS)),
    "stream_velocity_exact": _exactly("velocity-exact", lambda stream: bursts.velocity_bursts(stream, BURSTS)),
    "stream_pin_exact": _exactly("pins-exact", lambda stream: bursts.pin_bursts(stream, BURSTS)),
    "stream_enrich": _streamed(
        "enriched",
        lambda stream, g: enriched_columns(streaming.enriched(stream, g.codes, g.cards, g.users)),
    ),
    "stream_sessions": _streamed("sessions", lambda stream, g: streaming.sessions(stream)),
}


def _on_given(build: Callable[[Given], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(Given(spark, sf_dir))


def queries() -> dict[str, Query]:
    sources: dict[str, Query] = {
        "code_map_unpivot": lambda spark, sf: code_maps.code_rows(adapter.code_objects(spark, sf)),
        "fraud_labels": lambda spark, sf: code_maps.label_rows(adapter.label_objects(spark, sf)),
        "codes_file": codes_file,
        "labels_file": labels_file,
        "codes_object": codes_object,
        "labels_object": labels_object,
    }
    return {name: _on_given(build) for name, build in BATCH.items()} | sources | STREAMS
