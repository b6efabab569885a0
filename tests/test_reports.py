from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from txrisk.operators import activity, amounts, cards, categories, errors, indicators, population, profile, rules, score
from txrisk.operators.facts import clean, rollup
from txrisk.operators.summary import part, summary
from txrisk.params import Floors, ScoreWeights, Thresholds

DAY = "2024-01-15 {:02d}:{:02d}:00"


def at(hour, minute=0):
    return DAY.format(hour, minute)


def test_volumetry_counts_null_as_a_value(build, rows):
    raw = build.raw({"card_id": 1}, {"card_id": 1}, {"card_id": None})
    assert rows(profile.volumetry(raw)) == [(3, 1, 2, 1, 1.5, 3.0)]


def test_null_profile_and_quality(build, rows):
    raw = build.raw(
        {"errors": "", "amount": "$-1", "mcc": None}, {"errors": "Bad PIN", "amount": "?", "date": "yesterday"}
    )
    profiled = {r[0]: r[1:] for r in rows(profile.null_profile(raw))}
    assert profiled["errors"] == (1, 50.0) and profiled["mcc"] == (1, 50.0) and profiled["id"] == (0, 0.0)
    found = {r[0]: r[1] for r in rows(profile.quality(clean(raw)))}
    assert found == {
        "non_positive_amount": 1,
        "missing_mcc": 1,
        "with_error": 1,
        "unparsed_amount": 1,
        "unparsed_date": 1,
    }


def test_profiles_of_an_empty_table(build, rows):
    empty = build.raw().limit(0)
    assert {r[1:] for r in rows(profile.null_profile(empty))} == {(0, None)}
    assert rows(profile.volumetry(empty)) == [(0, 0, 0, 0, None, None)]


def test_schema_preview_and_type_suspects(build, rows):
    raw = build.raw({"zip": "1234"}, {"zip": None}).withColumn("zip", F.col("zip").cast("double"))
    described = rows(profile.describe_schema(raw))
    assert described[1] == (2, "date", "string") and len(described) == len(raw.columns)
    assert profile.preview(raw, 1).count() == 1
    assert rows(profile.type_suspects(raw)) == [("amount", "money as text", 2, 2), ("zip", "code as double", 1, 1)]


@pytest.mark.parametrize("values", [[1], [1, 2], [1, 2, 3], [5] * 7 + [1], [1, 10**8, 10**9], [25_000, 10_001, 9_999]])
def test_exact_median_is_the_lower_middle(build, rows, values):
    facts = build.facts(*[{"amount": f"${v}"} for v in values], {"amount": "$-5"}, {"amount": "x"})
    expected = sorted(values)[(len(values) - 1) // 2]
    assert rows(amounts.exact_median(facts)) == [(expected * 100,)]
    [stats] = rows(amounts.amount_stats(facts, exact=True))
    assert stats[1:] == (expected, min(values), max(values))
    assert rows(amounts.amount_stats(facts)) == [stats]


def test_median_of_nothing(build, rows):
    facts = build.facts({"amount": "$-5"})
    assert rows(amounts.amount_stats(facts, exact=True)) == [(None, None, None, None)]


def test_band_shares_add_up(build, rows):
    facts = build.facts(*[{"amount": f"${v}"} for v in (9.99, 10, 49.99, 50, 199.99, 200, 200.01, -3, 0)])
    assert [r[2] for r in rows(amounts.amount_bands(amounts.with_amount_band(facts)))] == [1, 2, 2, 2]
    assert rows(amounts.high_amount_share(facts)) == [(1, 14.29)]


def test_activity(build, rows):
    facts = build.facts({"date": at(0)}, {"date": at(5, 59)}, {"date": at(6)}, {"date": "?"})
    assert rows(activity.by_hour(facts)) == [(None, 1), (0, 1), (5, 1), (6, 1)]
    assert rows(activity.night_share(facts)) == [(2, 50.0)]
    assert rows(activity.by_day_of_week(facts)) == [(None, 1), (2, 3)]
    assert rows(activity.by_month(facts)) == [(None, 1), (1, 3)]


def test_unmatched_codes_are_kept_as_unknown(build, rows):
    facts = build.facts({"mcc": 5812}, {"mcc": 9999, "amount": "$30"}, {"mcc": None, "amount": "x"})
    volume = categories.category_volume(facts, build.codes(c5812="Eating Places"))
    assert rows(volume) == [("Eating Places", 1, 10.0), ("Unknown", 2, 30.0)]


def test_category_floor_is_strict(build, rows):
    facts = build.facts(*[{"mcc": 1}] * 100, *[{"mcc": 2, "amount": "$300"}] * 101)
    codes = build.codes(c1="A", c2="B")
    assert rows(categories.category_risk(facts, codes)) == [("B", 101, 300.0, True)]


def test_error_rate_floors(build, rows):
    facts = build.facts(
        *[{"card_id": 49, "client_id": 99}] * 49,
        *[{"card_id": 50, "client_id": 99}] * 50,
        *[{"card_id": 100, "client_id": 100, "errors": "Bad PIN"}] * 100,
    )
    assert rows(errors.card_error_rates(facts), "card_id", "error_rate") == [(50, 0.0), (100, 100.0)]
    assert rows(errors.client_error_rates(facts)) == [(100, 100, 100, 100.0)]


def test_credit_bands_leave_out_unscored_clients(build, rows):
    facts = build.facts({"client_id": 1, "errors": "x"}, {"client_id": 1}, {"client_id": 2}, {"client_id": 3})
    users = build.users({"id": 1, "credit_score": 599}, {"id": 2, "credit_score": 800}, {"id": 3})
    found = errors.credit_band_errors(facts, users, floors=Floors(scored_client_tx=1))
    assert rows(found) == [(1, "< 600", 1, 50.0), (4, ">= 800", 1, 0.0)]


def test_error_texts_whole_or_split(build, rows):
    facts = build.facts({"errors": "Bad PIN,Technical Glitch"}, {"errors": "Bad PIN"}, {"errors": ""})
    assert rows(errors.error_types(facts)) == [("Bad PIN", 1), ("Bad PIN,Technical Glitch", 1)]
    assert rows(errors.error_types(facts, split_errors=True)) == [("Bad PIN", 2), ("Technical Glitch", 1)]
    assert rows(errors.error_type_risk(facts), "risk") == [("suspect",), ("unknown",)]
    assert rows(errors.dominant_errors(facts)) == [(1, "Bad PIN", 1)]


def test_worked_example_of_the_score(build, rows):
    """12 transactions, 4 cities, 2 errors, 1 at night, 1200 in total: 24 + 20 + 20 + 3 + 15."""
    transactions = [{"amount": "$100", "merchant_city": "ABCD"[i % 4], "date": at(12, i)} for i in range(12)]
    transactions[0]["date"] = at(3)
    for row in transactions[:2]:
        row["errors"] = "Bad PIN"
    days = indicators.card_days(build.facts(*transactions))
    scores = score.risk_scores(days)
    assert rows(scores, "risk_score") == [(82,)]
    assert rows(score.score_levels(scores), "level", "action") == [("critical (>= 50)", "block")]
    assert rows(score.score_bands(scores), "band_ord", "n_card_days") == [(4, 1)]
    none = ScoreWeights(0, 0, 0, 0, 1000, 0)
    assert rows(score.risk_scores(days, none), "risk_score") == [(0,)]


@pytest.mark.parametrize(("total", "bonus"), [("1000.00", 0), ("1000.01", 15), ("x", 0)])
def test_bonus_boundary(build, rows, total, bonus):
    days = indicators.card_days(build.facts({"amount": f"${total}"}))
    assert rows(score.risk_scores(days), "risk_score") == [(2 + 5 + bonus,)]


def test_two_counts_of_cities(build, rows):
    facts = build.facts(*[{"merchant_city": c} for c in ("A", "B", "C", "A", "ONLINE", None)])
    days = indicators.card_days(facts)
    assert rows(days, "n_cities_physical", "n_cities_all") == [(3, 4)]
    assert rows(indicators.card_day_cities(facts), "n_cities_physical") == [(3,)]
    assert rows(rules.suspicious_cards(days, build.cards({"id": 9}))) == []


def test_a_day_without_the_measured_thing_has_no_row(build, rows):
    facts = build.facts({"merchant_city": "ONLINE", "amount": "$-5"})
    assert rows(indicators.card_day_spend(facts)) == rows(indicators.card_day_cities(facts)) == []


def test_refunds_count_for_the_score_only(build, rows):
    days = indicators.card_days(build.facts({"amount": "$1200"}, {"amount": "$-300"}))
    assert rows(rules.suspicious_cards(days, build.cards({"id": 9}))) == [(1, ["high_amount"], 1, 1)]
    assert rows(score.risk_scores(days), "amount_net", "risk_score") == [(900.0, 9)]


def test_thresholds_are_strict(build, rows):
    def day(card, n, city=0, amount=1):
        return [
            {"card_id": card, "amount": f"${amount}", "merchant_city": str(i % (city or 1)), "date": at(9, i)}
            for i in range(n)
        ]

    facts = build.facts(
        *day(10, 10), *day(11, 11), *day(3, 4, 3), *day(4, 4, 4), *day(1000, 1, 0, 1000), *day(1001, 1, 0, 1000.01)
    )
    found = rules.suspicious_cards(indicators.card_days(facts), build.cards({"id": 3}))
    assert rows(found, "card_id", "reasons") == [(4, ["multi_city"]), (11, ["high_tx_count"]), (1001, ["high_amount"])]


def test_hits_count_days_and_criteria_count_reasons(build, rows):
    facts = build.facts(*[{"date": f"2024-01-{15 + i % 2} 10:00:00"} for i in range(6)], {"card_id": 2})
    cards_ = build.cards({"id": 1, "card_on_dark_web": "Yes"}, {"id": 7, "card_on_dark_web": "Yes"})
    found = rules.suspicious_cards(indicators.card_days(facts), cards_, Thresholds(max_tx=2))
    assert rows(found) == [(1, ["dark_web", "high_tx_count"], 3, 2)]
    assert rows(rules.criteria_levels(found), "level", "action") == [("medium", "alert analyst")]
    assert rows(rules.suspicion_reasons(found)) == [("dark_web", 1), ("high_tx_count", 1)]
    assert rows(rules.suspicious_count(found)) == [(1,)]


def test_an_empty_population_still_has_a_row(build, rows):
    facts = build.facts({"client_id": 1}, {"client_id": None, "amount": "$20"})
    nobody = rules.suspicious_cards(indicators.card_days(facts), build.cards({"id": 9}))
    users = build.users({"id": 1, "credit_score": 700, "current_age": 40, "yearly_income": "$1,000"})
    found = population.population_profile(facts, nobody, users)
    assert rows(found) == [("Normal", 2, 15.0, 700.0, 40.0, 1000.0), ("Suspect", 0, None, None, None, None)]


def test_transactions_without_client_are_normal(build, rows):
    facts = build.facts({"client_id": 1, "amount": "$2000"}, {"client_id": None, "amount": "$5000"}, {"client_id": 2, "card_id": 2})
    suspicious = rules.suspicious_cards(indicators.card_days(facts), build.cards({"id": 9}))
    found = population.population_profile(facts, suspicious, build.users({"id": 1}))
    assert rows(found, "client_type", "n_tx", "mean_amount") == [("Normal", 2, 2505.0), ("Suspect", 1, 2000.0)]


def test_card_reports(build, rows):
    facts = build.facts({"card_id": 1}, {"card_id": 1, "amount": "$30"}, {"card_id": 2}, {"card_id": 3})
    known = build.cards(
        {"id": 1, "card_type": "Debit (Prepaid)", "card_brand": "Visa", "card_on_dark_web": "Yes", "acct_open_date": "01/2024"},
        {"id": 2, "card_type": "Credit", "card_brand": "Amex", "year_pin_last_changed": 2014, "acct_open_date": "01/2010"},
    )
    assert rows(cards.card_type_risk(facts, known)) == [
        (None, 1, 10.0, "unknown"),
        ("Credit", 1, 10.0, "medium"),
        ("Debit (Prepaid)", 2, 20.0, "high"),
    ]
    assert rows(cards.dark_web_count(facts, known)) == [(1,)]
    assert rows(cards.top_dark_web_cards(facts, known)) == [(1, 2, 40.0)]
    assert rows(cards.new_card_bursts(facts, known, "2024-01-30"), "card_id") == []
    assert rows(cards.stale_pins(facts, known, "2024-01-30")) == [(2, 1, 10)]


def same(rows, left, right):
    assert rows(left) == rows(right)


def test_reports_are_the_same_on_rows_and_on_roll_ups(spark, rows):
    """Every report reads additive measures, so it may be given rows, the daily table or the summary."""
    from verification import adapter
    from txrisk.operators.facts import facts as measured

    sf = "/root/testdata/sf0.001"
    facts = measured(clean(adapter.transactions(spark, sf)))
    codes, known, users = (make(spark, sf) for make in (adapter.codes, adapter.cards, adapter.users))
    small, daily = summary(facts).cache(), indicators.daily(facts).cache()
    same(rows, activity.by_hour(facts), activity.by_hour(part(small, "time")))
    same(rows, activity.night_share(facts), activity.night_share(part(small, "time")))
    same(rows, categories.category_volume(facts, codes), categories.category_volume(part(small, "code"), codes))
    same(rows, errors.error_types(facts), errors.error_types(part(small, "error")))
    same(rows, amounts.high_amount_share(facts), amounts.high_amount_share(part(small, "amount")))
    banded = amounts.with_amount_band(facts)
    same(rows, amounts.amount_bands(banded), amounts.amount_bands(part(small, "amount")))
    same(rows, indicators.card_days(facts), indicators.card_days(daily))
    same(rows, indicators.card_lifetime(facts), indicators.card_lifetime(daily))
    same(rows, indicators.card_day_cities(facts), indicators.card_day_cities(daily))
    same(rows, cards.card_type_brand(facts, known), cards.card_type_brand(daily, known))
    same(rows, errors.client_error_rates(facts), errors.client_error_rates(daily))
    days = indicators.card_days(daily)
    suspicious = rules.suspicious_cards(days, known)
    same(
        rows,
        population.population_profile(facts, suspicious, users),
        population.population_profile(daily, suspicious, users),
    )
    assert rollup(facts).first()["n_tx"] == rollup(daily).first()["n_tx"] == 1000
    small.unpersist()
    daily.unpersist()


def test_score_is_at_least_its_transactions(spark):
    from verification.queries import queries

    scores = queries()["risk_score_card_day"](spark, "/root/testdata/sf0.001")
    assert scores.filter(F.col("risk_score") < 2 * F.col("n_tx")).isEmpty()
    found = queries()["criteria_levels"](spark, "/root/testdata/sf0.001")
    assert found.filter((F.col("n_criteria") > 4) | (F.col("n_criteria") < 1)).isEmpty()
