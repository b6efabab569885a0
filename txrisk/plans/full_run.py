"""All reports of one set of input tables, over a few shared tables.

The text input is parsed once, into typed Parquet. Three tables are then summed from it and written:
the small summary with its sketches, the daily table, the merchants and the moments; from the daily table come the
card-days and the bitmaps of cities. Most reports are sums over these. The column profile is counted while the
transactions are written. Only what needs every row reads them again: dominant errors, and the two exports of all transactions.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from txrisk.operators import (
    activity,
    amounts,
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
from txrisk.operators.facts import clean, facts, with_id
from txrisk.operators.summary import part, summary
from txrisk.params import CARD_ERROR_BANDS, CLIENT_ERROR_BANDS, BurstRules, DecisionRules, Floors, ScoreWeights, Thresholds
from txrisk.sources import code_maps, tables
from txrisk.sources.parquet import write_parquet
from txrisk.sources.workspace import stage, stage_all


@dataclass(frozen=True)
class Inputs:
    """The raw tables."""

    transactions: DataFrame
    cards: DataFrame
    users: DataFrame
    codes: DataFrame


@dataclass(frozen=True)
class Settings:
    as_of: str
    limits: Thresholds = field(default_factory=Thresholds)
    weights: ScoreWeights = field(default_factory=ScoreWeights)
    floors: Floors = field(default_factory=Floors)
    bursts: BurstRules = field(default_factory=BurstRules)
    decisions: DecisionRules = field(default_factory=DecisionRules)


def load(spark: SparkSession, paths: Mapping[str, str]) -> Inputs:
    """Read ``transactions``, ``cards`` and ``users`` (CSV) and ``codes`` (JSON) from the given paths."""
    return Inputs(
        tables.read_transactions(spark, paths["transactions"]),
        tables.read_cards(spark, paths["cards"]),
        tables.read_users(spark, paths["users"]),
        code_maps.read_mcc_codes(spark, paths["codes"]),
    )


def reports(inputs: Inputs, settings: Settings) -> dict[str, DataFrame]:
    """Every report by name. Writes the shared tables; the reports themselves are still to be run."""
    s = settings
    raw = inputs.transactions
    observed = profile.Observed(clean(raw), raw.columns)
    tx = stage(with_id(observed.rows), "transactions")
    rows = facts(tx)
    shared = stage_all(summary=summary(rows), daily=indicators.daily(rows), moments=sequences.moments(rows),
        merchants=categories.merchant_totals(rows), months=identities.identity_rows(rows, "tx_month"))
    small, daily, moments, by_merchant = (shared[n] for n in ("summary", "daily", "moments", "merchants"))
    by_time, by_code = part(small, "time"), part(small, "code")
    by_error, by_amount = part(small, "error"), part(small, "amount")
    groups = features.feature_groups(
        rows, daily, moments, by_code, inputs.codes, inputs.cards, inputs.users, s.as_of, s.decisions, s.floors
    )
    with_cities = city_days.city_days(daily, city_days.numbered_cities(daily))
    derived = stage_all(card_days=indicators.card_days(daily), cities=with_cities, **groups)
    card_days, days = derived.pop("card_days"), derived.pop("cities")
    scores = score.risk_scores(card_days, s.weights)
    suspicious = rules.suspicious_cards(card_days, inputs.cards, s.limits)
    named = {
        "volumetry": profile.summed_volumetry(daily, by_merchant),
        "null_profile": observed.null_profile(),
        "quality": observed.quality(),
        "type_suspects": profile.type_suspects(raw),
        "schema": profile.describe_schema(raw),
        "amount_stats": sketches.sketched_amount_stats(by_amount),
        "amount_quantiles": sketches.amount_quantiles(by_code, ["mcc"], (0.25, 0.5, 0.75, 0.95)),
        "active_by_month": identities.distinct_identities(shared["months"], "tx_month"),
        "suspects_by_month": identities.members_in_groups(shared["months"], suspicious),
        "amount_bands": amounts.amount_bands(by_amount),
        "high_amount_share": amounts.high_amount_share(by_amount),
        "by_hour": activity.by_hour(by_time),
        "by_dow": activity.by_day_of_week(by_time),
        "by_month": activity.by_month(by_time),
        "night_share": activity.night_share(by_time),
        "category_volume": categories.top_categories(by_code, inputs.codes),
        "category_high_mean": categories.top_category_means(by_code, inputs.codes, floors=s.floors),
        "category_risk": categories.category_risk(by_code, inputs.codes, s.decisions, s.floors),
        "suspicious_merchants": categories.suspicious_merchants(by_merchant, s.decisions),
        "merchant_reputation": categories.merchants(by_merchant),
        "dominant_error": errors.dominant_errors(rows),
        "error_concentration": errors.error_concentration(rows),
        "error_types": errors.top_error_types(by_error),
        "top_error_type": errors.top_error_type(by_error),
        "error_type_risk": errors.error_type_risk(by_error),
        "card_error_rate": errors.card_error_rates(daily, floors=s.floors),
        "client_error_rate": errors.client_error_rates(daily, floors=s.floors),
        "credit_band_errors": errors.credit_band_errors(daily, inputs.users, floors=s.floors),
        "weak_profiles": errors.weak_profiles(daily, inputs.users, s.decisions, s.floors),
        "card_type_brand": cards.card_type_brand(daily, inputs.cards),
        "card_type_risk": cards.card_type_risk(daily, inputs.cards),
        "dark_web_count": cards.dark_web_count(daily, inputs.cards),
        "dark_web_cards": cards.top_dark_web_cards(daily, inputs.cards),
        "new_card_burst": cards.new_card_bursts(daily, inputs.cards, s.as_of, s.decisions),
        "stale_pin": cards.stale_pins(daily, inputs.cards, s.as_of, s.decisions),
        "card_lifetime": city_days.card_lifetime(days),
        "weekly_cities": city_days.weekly_cities(days),
        "weekly_tx": indicators.weekly_tx(daily),
        "online_ratio": indicators.online_ratio(daily),
        "suspicious_count": rules.suspicious_count(suspicious),
        "suspicious_cards_top": rules.top_suspicious_cards(suspicious),
        "risk_score_top": score.top_risk_scores(scores),
        "error_streaks": sequences.error_streaks(moments),
        "card_error_bands": errors.error_rate_bands(daily, "card_id", CARD_ERROR_BANDS),
        "client_error_bands": errors.error_rate_bands(daily, "client_id", CLIENT_ERROR_BANDS),
        "suspicion_reasons": rules.suspicion_reasons(suspicious),
        "criteria_levels": rules.criteria_levels(suspicious),
        "risk_score_bands": score.score_bands(scores),
        "score_levels": score.score_levels(scores),
        "population_profile": population.population_profile(daily, suspicious, inputs.users),
        "velocity_bursts": sequences.velocity_bursts(moments, s.bursts),
        "pin_bursts": sequences.pin_bursts(moments, s.bursts),
        "pin_lockouts": sequences.pin_lockouts(moments, s.bursts),
        "dormant_reactivations": sequences.dormant_reactivations(moments, s.bursts),
        "consecutive_errors": sequences.consecutive_errors(moments),
        "synthesis_metrics": synthesis.synthesis_metrics(
            rows, daily, card_days, inputs.cards, inputs.users, s.decisions, s.limits
        ),
        "risk_scores": scores,
        "suspicious_cards": suspicious,
        "transactions_enriched": enrich.enrich(tx, inputs.codes, inputs.cards, inputs.users),
        "transaction_features": features.transaction_features(rows, derived),
    }
    tops = {f"top_{name}": frame for name, frame in indicators.top_indicators(daily).items()}
    return named | tops


def run(inputs: Inputs, settings: Settings, output: str, mode: str = "overwrite", at_once: int = 4) -> dict[str, str]:
    """Write every report as Parquet under ``output``; returns the folder of each.

    Most reports are small jobs over the shared tables, so a few are run at the same time.
    """
    named = reports(inputs, settings)
    folders = {name: f"{output}/{name}" for name in named}
    with ThreadPoolExecutor(at_once) as pool:
        list(pool.map(lambda name: write_parquet(named[name], folders[name], mode), named))
    return folders
