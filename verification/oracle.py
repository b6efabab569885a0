"""The same queries as SQL over the given tables, written independently of the Spark code.

Ratios are rounded half-up with whole numbers: ``//`` is integer division.
"""

from __future__ import annotations

# The shapes of ``adapter.py``.
VIEWS = """
WITH ev AS (
  SELECT event_id AS id, date_trunc('second', ts) AS ts, user_id // 3 AS client_id, user_id AS card_id, event_type,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
         CAST(CAST(value AS DECIMAL(12,2)) * 400 AS BIGINT) AS c4
  FROM events
), tx AS (
  SELECT id, ts, CAST(ts AS DATE) AS day, CAST(hour(ts) AS INTEGER) AS h, CAST(dayofweek(ts) AS INTEGER) + 1 AS dow,
         epoch(ts) AS sec, client_id, card_id, CAST(k AS BIGINT) AS merchant_id,
         CASE WHEN event_type = 'view' THEN 'ONLINE' ELSE 'NATION_' || (k % 25) END AS city,
         CASE WHEN event_type <> 'view' THEN CAST(10000 + k AS VARCHAR) END AS zip,
         CASE WHEN k <> 99 THEN 5000 + k END AS mcc,
         CASE WHEN event_type = 'error' THEN CASE k % 4 WHEN 0 THEN 'Insufficient Balance' WHEN 1 THEN 'Bad PIN'
                                                        WHEN 2 THEN 'Technical Glitch' ELSE 'Card Expired' END
              WHEN event_type = 'click' THEN '' END AS errors,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS err,
         CASE WHEN event_type = 'error' AND k % 4 = 1 THEN 1 ELSE 0 END AS pin,
         CASE WHEN hour(ts) < 6 THEN 1 ELSE 0 END AS night,
         CASE WHEN event_type = 'signup' AND k < 20 THEN -c4 ELSE c4 END AS cents
  FROM ev
), cards AS (
  SELECT c_custkey + c_custkey // 9 AS id,
         CASE c_nationkey % 3 WHEN 0 THEN 'Visa' WHEN 1 THEN 'Mastercard' ELSE 'Amex' END AS card_brand,
         CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'Debit'
              WHEN c_mktsegment = 'FURNITURE' THEN 'Debit (Prepaid)' ELSE 'Credit' END AS card_type,
         CASE WHEN c_nationkey % 2 = 0 THEN 'YES' ELSE 'NO' END AS has_chip,
         CAST(abs(CAST(c_acctbal AS DECIMAL(12,2))) * 100 AS BIGINT) AS limit_cents,
         CASE WHEN c_custkey % 7 = 0 THEN DATE '2024-01-01'
              ELSE make_date(2000 + c_nationkey, 1 + c_nationkey % 12, 1) END AS opened,
         2005 + c_nationkey % 15 AS pin_year,
         CASE WHEN c_nationkey % 10 = 0 THEN 'Yes' ELSE 'No' END AS dark
  FROM customer
), users AS (
  SELECT c_custkey + c_custkey // 4 AS id, 18 + 2 * c_nationkey AS age,
         CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
         20000 + 7 * c_custkey AS income,
         CAST(500 + (CAST(CAST(c_acctbal AS DECIMAL(12,2)) * 100 AS BIGINT) + 100000) * 350 // 1100000 AS INTEGER) AS score,
         1 + c_nationkey % 5 AS n_cards
  FROM customer
), codes AS (
  SELECT CAST(5000 + p_partkey + p_partkey // 10 AS INTEGER) AS mcc_code, p_name AS mcc_category FROM part
), tc AS (
  SELECT tx.*, coalesce(mcc_category, 'Unknown') AS category FROM tx LEFT JOIN codes ON mcc = mcc_code
), carddays AS (
  SELECT card_id, day, count(*) AS n, sum(cents) AS net, sum(CASE WHEN cents > 0 THEN cents ELSE 0 END) AS pos,
         count(DISTINCT city) AS cities, count(DISTINCT CASE WHEN city <> 'ONLINE' THEN city END) AS phys,
         sum(err) AS errs, sum(night) AS nights
  FROM tx GROUP BY card_id, day
), scores AS (
  SELECT *, n * 2 + cities * 5 + errs * 10 + nights * 3 + CASE WHEN net > 100000 THEN 15 ELSE 0 END AS score FROM carddays
)"""


def half_up(num: str, den: str, scale: int = 1) -> str:
    return f"(sign({num}) * ((2 * abs({num}) * {scale} + ({den})) // (2 * nullif({den}, 0))))"


def pct(num: str, den: str) -> str:
    return f"CAST({half_up(num, den, 10000)} AS DOUBLE) / CAST(100 AS DOUBLE)"


def ratio(num: str, den: str) -> str:
    return f"CAST({half_up(num, den, 100)} AS DOUBLE) / CAST(100 AS DOUBLE)"


def mean(cents: str, n: str) -> str:
    return f"CAST({half_up(cents, n)} AS DOUBLE) / CAST(100 AS DOUBLE)"


def units(cents: str) -> str:
    return f"CAST({cents} AS DOUBLE) / CAST(100 AS DOUBLE)"


def big(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def integer(expression: str) -> str:
    return f"CAST({expression} AS INTEGER)"


def suspicious(max_tx: int, max_cities: int, max_cents: int) -> str:
    """CTE ``hits`` (one row per broken rule) and ``susp`` (one row per suspicious card)."""
    return f"""{VIEWS}, hits AS (
  SELECT card_id, 'high_tx_count' AS reason FROM carddays WHERE n > {max_tx}
  UNION ALL SELECT card_id, 'multi_city' FROM carddays WHERE phys > {max_cities}
  UNION ALL SELECT card_id, 'high_amount' FROM carddays WHERE pos > {max_cents}
  UNION ALL SELECT DISTINCT card_id, 'dark_web' FROM tx JOIN cards ON card_id = cards.id WHERE dark = 'Yes'
), susp AS (
  SELECT card_id, string_agg(DISTINCT reason, ',' ORDER BY reason) AS reasons, count(*) AS n_rule_hits,
         {integer('count(DISTINCT reason)')} AS n_criteria
  FROM hits GROUP BY card_id
)"""


FLAGGED = suspicious(6, 3, 100000)
STRICT = suspicious(7, 6, 250000)

# Errors after the successes of the same second; a run lies between two successes.
RUNS = f"""{VIEWS}, stretched AS (
  SELECT *, sum(1 - err) OVER (PARTITION BY card_id ORDER BY ts, err, id ROWS UNBOUNDED PRECEDING) AS run FROM tx
), runs AS (
  SELECT card_id, run, sum(err) AS n_err, sum(pin) AS n_pin, min(CASE WHEN err = 1 THEN ts END) AS started,
         max(CASE WHEN err = 1 THEN ts END) AS ended
  FROM stretched GROUP BY card_id, run
)"""

ORDERED = "PARTITION BY card_id ORDER BY sec"


def level(value: str, cuts: tuple, labels: tuple) -> str:
    whens = " ".join(f"WHEN {value} < {cut} THEN '{label}'" for cut, label in zip(cuts, labels))
    return f"CASE {whens} ELSE '{labels[-1]}' END"


def order(value: str, cuts: tuple) -> str:
    whens = " ".join(f"WHEN {value} < {cut} THEN {i}" for i, cut in enumerate(cuts, start=1))
    return integer(f"CASE {whens} ELSE {len(cuts) + 1} END")


AMOUNT = ((1000, 5000, 20000), ("< 10", "10-50", "50-200", ">= 200"))
CREDIT = ((600, 700, 800), ("< 600", "600-700", "700-800", ">= 800"))
SCORE = ((10, 30, 50), ("low (< 10)", "medium (10-30)", "high (30-50)", "critical (>= 50)"))
ACTIONS = ("none", "watch", "alert analyst", "block")
CARD_ERROR = ((5, 15.01), ("normal", "elevated", "suspect"))
CLIENT_ERROR = ((5, 10.01, 20.01), ("low", "human", "high", "attack"))


def null_profile() -> str:
    columns = {
        "id": "id IS NULL",
        "date": "ts IS NULL",
        "client_id": "client_id IS NULL",
        "card_id": "card_id IS NULL",
        "amount": "cents IS NULL",
        "merchant_id": "merchant_id IS NULL",
        "merchant_city": "city IS NULL OR city = ''",
        "zip": "zip IS NULL OR zip = ''",
        "mcc": "mcc IS NULL",
        "errors": "errors IS NULL OR errors = ''",
    }
    parts = [
        f"SELECT '{name}' AS column_name, count(*) FILTER (WHERE {test}) AS n_missing, "
        f"{pct(f'count(*) FILTER (WHERE {test})', 'count(*)')} AS pct_missing FROM tx"
        for name, test in columns.items()
    ]
    return VIEWS + " UNION ALL ".join(["\n" + parts[0], *parts[1:]])


def quality() -> str:
    issues = {
        "non_positive_amount": "cents <= 0",
        "missing_mcc": "mcc IS NULL",
        "with_error": "err = 1",
        "unparsed_amount": "cents IS NULL",
        "unparsed_date": "ts IS NULL",
    }
    parts = [
        f"SELECT '{name}' AS issue, count(*) FILTER (WHERE {test}) AS n_tx, "
        f"{pct(f'count(*) FILTER (WHERE {test})', 'count(*)')} AS pct_tx FROM tx"
        for name, test in issues.items()
    ]
    return VIEWS + " UNION ALL ".join(["\n" + parts[0], *parts[1:]])


def type_suspects() -> str:
    return f"""{VIEWS}
SELECT 'amount' AS column_name, 'money as text' AS suspicion, count(cents) AS n_values, count(cents) AS n_misfits FROM tx
UNION ALL SELECT 'zip', 'code as double', count(zip), count(zip) FROM tx"""


def count_by(expression: str, name: str) -> str:
    return f"{VIEWS} SELECT {integer(expression)} AS {name}, count(*) AS n_tx FROM tx GROUP BY 1"


def error_rates(key: str, floor: int) -> str:
    return f"""SELECT {key}, count(*) AS n_tx, {big('sum(err)')} AS n_errors, {pct('sum(err)', 'count(*)')} AS error_rate
FROM tx GROUP BY {key} HAVING count(*) >= {floor}"""


def error_bands(key: str, bands: tuple) -> str:
    return f"""{VIEWS}, rates AS ({error_rates(key, 0)})
SELECT {order('error_rate', bands[0])} AS band_ord, {level('error_rate', *bands)} AS error_band, count(*) AS n_groups
FROM rates GROUP BY ALL"""


SCORED_CLIENTS = f"""{VIEWS}, rates AS ({error_rates('client_id', 50)}), scored AS (
  SELECT client_id, n_tx, n_errors, error_rate, score AS credit_score FROM rates JOIN users ON client_id = users.id
  WHERE score IS NOT NULL
)"""

CATEGORY = f"""{VIEWS}, means AS (
  SELECT category AS merchant_category, count(*) AS n_tx, {mean('sum(cents)', 'count(*)')} AS mean_amount
  FROM tc WHERE cents > 0 GROUP BY category HAVING count(*) > 100
)"""

MERCHANTS = f"""{VIEWS}, shops AS (
  SELECT merchant_id, count(*) AS n_tx,
         {mean('sum(CASE WHEN cents > 0 THEN cents ELSE 0 END)', 'count(*) FILTER (WHERE cents > 0)')} AS mean_amount,
         {pct('sum(err)', 'count(*)')} AS error_rate
  FROM tx GROUP BY merchant_id
)"""

DARK = f"""{VIEWS}, active AS (
  SELECT card_id, count(*) AS n_tx, {units('sum(cents)')} AS amount_net
  FROM tx JOIN cards ON card_id = cards.id WHERE dark = 'Yes' GROUP BY card_id
)"""

CARD_AGE = "date_diff('day', opened, DATE '2024-01-30')"

IN_USE = f"""{VIEWS}, used AS (
  SELECT card_id, count(*) AS n_tx, any_value({CARD_AGE}) AS age, any_value(2024 - pin_year) AS pin_age
  FROM tx JOIN cards ON card_id = cards.id GROUP BY card_id
)"""

TYPES = f"""{VIEWS}, typed AS (
  SELECT card_type, card_brand, cents FROM tx LEFT JOIN cards ON card_id = cards.id
)"""

ERROR_TYPES = f"""{VIEWS}, types AS (SELECT errors, count(*) AS n_tx FROM tx WHERE err = 1 GROUP BY errors)"""

SCORE_COLUMNS = f"""card_id, day AS tx_date, n AS n_tx, {units('net')} AS amount_net, cities AS n_cities_all,
{big('errs')} AS n_errors, {big('nights')} AS n_night"""

CLIENT_MEAN = f"""{VIEWS}, usual AS (
  SELECT client_id, CAST(sum(cents) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS cents_mean FROM tx GROUP BY client_id
)"""
DEVIATION = "abs(CAST(cents AS DOUBLE) - cents_mean) / CAST(100 AS DOUBLE)"

PREVIOUS = f"{VIEWS}, prev AS (SELECT *, lag(sec) OVER (PARTITION BY card_id ORDER BY ts, id) AS before FROM tx)"


def trailing(measure: str, seconds: int, at_least: int) -> str:
    return f"""{VIEWS}, recent AS (
  SELECT card_id, ts, {measure} AS here,
         sum({measure}) OVER ({ORDERED} RANGE BETWEEN {seconds} PRECEDING AND CURRENT ROW) AS n FROM tx
)
SELECT DISTINCT card_id, ts AS tx_ts, {big('n')} AS n_recent FROM recent WHERE here > 0 AND n >= {at_least}"""


def synthesis() -> str:
    pos = "count(*) FILTER (WHERE cents > 0)"

    def one(name: str, value: str, source: str) -> str:
        return f"SELECT '{name}' AS metric, CAST({value} AS DOUBLE) AS value FROM {source}"

    def share(name: str, test: str, base: str = "count(*)") -> str:
        return one(name, pct(f"count(*) FILTER (WHERE {test})", base), "tx")

    def credit(name: str, test: str) -> str:
        return one(name, pct("sum(err)", "count(*)"), f"tx JOIN users ON client_id = users.id WHERE {test}")

    def kind(name: str, text: str) -> str:
        return one(name, mean("sum(cents)", "count(*)"), f"tx JOIN cards ON card_id = cards.id WHERE card_type LIKE '%{text}%'")

    parts = [
        share("night_share", "h < 6"),
        share("daytime_share", "h >= 10 AND h < 20"),
        share("weekend_share", "dow IN (1, 7)"),
        share("online_share", "city = 'ONLINE'"),
        share("share_below_50", "cents > 0 AND cents < 5000", pos),
        share("share_above_200", "cents > 20000", pos),
        one("mean_amount", mean("sum(cents) FILTER (WHERE cents > 0)", pos), "tx"),
        share("insufficient_balance_share", "errors = 'Insufficient Balance'", "sum(err)"),
        share("bad_pin_share", "errors = 'Bad PIN'", "sum(err)"),
        one("median_amount", units("quantile_disc(cents, 0.5)"), "tx WHERE cents > 0"),
        one("top_error_share", pct("max(n_tx)", "sum(n_tx)"), "types"),
        one("cards_error_rate_above_10", "count(*)", "rates WHERE error_rate > 10"),
        kind("mean_amount_credit", "Credit"),
        kind("mean_amount_debit", "Debit"),
        one("dark_web_cards_active", "count(DISTINCT card_id)", "tx JOIN cards ON card_id = cards.id WHERE dark = 'Yes'"),
        one("card_days_above_3_cities", "count(*)", "carddays WHERE phys > 3"),
        credit("error_rate_low_credit", "score < 600"),
        credit("error_rate_other_credit", "score >= 600"),
    ]
    return f"{ERROR_TYPES}, rates AS ({error_rates('card_id', 0)})\n" + "\nUNION ALL ".join(parts)


def transaction_features() -> str:
    return f"""{RUNS}, cardruns AS (
  SELECT card_id, max(n_err) AS longest, arg_max(n_err, run) AS latest FROM runs GROUP BY card_id
), percard AS (
  SELECT card_id, {pct('sum(err)', 'count(*)')} AS error_ratio,
         {pct("count(*) FILTER (WHERE city = 'ONLINE')", 'count(*)')} AS online_pct FROM tx GROUP BY card_id
), mode AS (
  SELECT card_id, errors FROM (SELECT card_id, errors, count(*) AS n FROM tx WHERE err = 1 GROUP BY card_id, errors)
  QUALIFY row_number() OVER (PARTITION BY card_id ORDER BY n DESC, errors) = 1
), weeks AS (
  SELECT card_id, date_trunc('week', ts) AS week, count(*) AS n FROM tx GROUP BY ALL
), usual AS (
  SELECT client_id, CAST(sum(cents) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS cents_mean FROM tx GROUP BY client_id
), prev AS (
  SELECT id, lag(sec) OVER (PARTITION BY card_id ORDER BY ts, id) AS before FROM tx
), means AS (
  SELECT category, {mean('sum(cents)', 'count(*)')} AS m FROM tc WHERE cents > 0 GROUP BY category HAVING count(*) > 100
), shops AS (
  SELECT merchant_id, count(*) AS n, {pct('sum(err)', 'count(*)')} AS rate FROM tx GROUP BY merchant_id
)
SELECT tc.id, tc.client_id, tc.card_id, tc.merchant_id, {units('tc.cents')} AS amount,
       {big('tc.night')} AS is_night, {big('CASE WHEN tc.dow IN (1, 7) THEN 1 ELSE 0 END')} AS is_weekend,
       {big("CASE WHEN tc.city = 'ONLINE' THEN 1 ELSE 0 END")} AS is_online,
       carddays.n AS tx_per_day, weeks.n AS tx_per_week, carddays.phys AS cities_per_day,
       {units('carddays.pos')} AS spend_per_day, online_pct,
       abs(CAST(tc.cents AS DOUBLE) - cents_mean) / CAST(100 AS DOUBLE) AS amount_deviation,
       ({units('tc.cents')}) / nullif({units('limit_cents')}, 0) AS amount_to_limit,
       CAST(tc.sec - before AS DOUBLE) / CAST(60 AS DOUBLE) AS minutes_since_last,
       error_ratio AS card_error_ratio, {big('longest')} AS longest_run, {big('latest')} AS current_run,
       mode.errors AS dominant_error, {big("CASE WHEN dark = 'Yes' THEN 1 WHEN dark = 'No' THEN 0 END")} AS card_on_dark_web,
       users.score AS credit_score, {integer(CARD_AGE)} AS card_age_days, {integer('2024 - pin_year')} AS pin_age_years,
       means.m AS category_mean_amount, {big('CASE WHEN means.m > 200 THEN 1 WHEN means.m <= 200 THEN 0 END')} AS is_high_value_category,
       shops.n AS merchant_volume, shops.rate AS merchant_error_rate
FROM tc
JOIN carddays ON carddays.card_id = tc.card_id AND carddays.day = tc.day
JOIN weeks ON weeks.card_id = tc.card_id AND weeks.week = date_trunc('week', tc.ts)
JOIN percard ON percard.card_id = tc.card_id
JOIN cardruns ON cardruns.card_id = tc.card_id
JOIN usual ON usual.client_id = tc.client_id
JOIN prev ON prev.id = tc.id
JOIN shops ON shops.merchant_id = tc.merchant_id
LEFT JOIN mode ON mode.card_id = tc.card_id
LEFT JOIN cards ON cards.id = tc.card_id
LEFT JOIN users ON users.id = tc.client_id
LEFT JOIN means ON means.category = tc.category"""


# Streams only report windows that the watermark (one hour behind the newest transaction) has passed.
WATERMARK = "(SELECT max(ts) - INTERVAL 1 HOUR FROM tx)"


def sliding(measure: str, minutes: int, slide: int, at_least: int) -> str:
    """Windows of ``minutes`` starting every ``slide`` minutes."""
    return f"""{VIEWS}, placed AS (
  SELECT card_id, {measure} AS v, time_bucket(INTERVAL {slide} MINUTE, ts) - INTERVAL (i * {slide}) MINUTE AS started
  FROM tx, range({minutes // slide}) AS steps(i) WHERE {measure} > 0
)
SELECT card_id, started AS window_start, {big('sum(v)')} AS n_window FROM placed
WHERE started + INTERVAL {minutes} MINUTE <= {WATERMARK} GROUP BY card_id, started HAVING sum(v) >= {at_least}"""


def oracle_sql() -> dict[str, str]:
    per_category = f"""SELECT category AS merchant_category, count(*) AS n_tx, {mean('sum(cents)', 'count(*)')} AS mean_amount
FROM tc GROUP BY category"""
    day_tx = "SELECT card_id, day AS tx_date, n AS n_tx FROM carddays"
    day_spend = f"SELECT card_id, day AS tx_date, {units('pos')} AS spend_pos FROM carddays WHERE pos > 0"
    day_cities = "SELECT card_id, day AS tx_date, phys AS n_cities_physical FROM carddays WHERE phys > 0"
    ratios = f"""SELECT card_id, count(*) AS n_tx, {big('sum(err)')} AS n_errors, {pct('sum(err)', 'count(*)')} AS error_ratio
FROM tx GROUP BY card_id"""
    score_rows = f"SELECT {SCORE_COLUMNS}, {big('score')} AS risk_score FROM scores"
    enriched = f"""{VIEWS} SELECT tc.id, client_id, card_id, {units('cents')} AS amount, category AS merchant_category,
card_brand, card_type, dark AS card_on_dark_web, {units('limit_cents')} AS credit_limit, has_chip,
{integer('pin_year')} AS year_pin_last_changed, {integer('age')} AS current_age, gender, score AS credit_score,
CAST(income AS DOUBLE) AS yearly_income, {integer('n_cards')} AS num_credit_cards
FROM tc LEFT JOIN cards ON card_id = cards.id LEFT JOIN users ON client_id = users.id"""
    return {
        "volumetry": f"""{VIEWS} SELECT count(*) AS n_tx, count(DISTINCT client_id) AS n_clients,
count(DISTINCT card_id) AS n_cards, count(DISTINCT merchant_id) AS n_merchants,
{ratio('count(*)', 'count(DISTINCT card_id)')} AS tx_per_card,
{ratio('count(*)', 'count(DISTINCT client_id)')} AS tx_per_client FROM tx""",
        "summed_volumetry": f"""{VIEWS} SELECT count(*) AS n_tx, count(DISTINCT client_id) AS n_clients,
count(DISTINCT card_id) AS n_cards, count(DISTINCT merchant_id) AS n_merchants,
{ratio('count(*)', 'count(DISTINCT card_id)')} AS tx_per_card,
{ratio('count(*)', 'count(DISTINCT client_id)')} AS tx_per_client FROM tx""",
        "amount_medians": f"""{VIEWS} SELECT mcc, count(*) AS n_pos, true AS within_error FROM tx
WHERE cents > 0 AND mcc IS NOT NULL GROUP BY mcc
UNION ALL SELECT -1, count(*), true FROM tx WHERE cents > 0 HAVING count(*) > 0""",
        "amount_stats_sketched": f"""{VIEWS} SELECT {mean('sum(cents)', 'count(*)')} AS mean_amount,
{units('min(cents)')} AS min_amount, {units('max(cents)')} AS max_amount, true AS median_within_error FROM tx WHERE cents > 0""",
        "active_by_month": f"""{VIEWS} SELECT {integer('month(ts)')} AS tx_month, count(DISTINCT client_id) AS n_clients,
count(DISTINCT card_id) AS n_cards, count(DISTINCT merchant_id) AS n_merchants FROM tx GROUP BY 1""",
        "suspects_by_month": f"""{FLAGGED} SELECT {integer('month(ts)')} AS tx_month,
count(DISTINCT card_id) FILTER (card_id IN (SELECT card_id FROM susp)) AS n_cards_in,
count(DISTINCT card_id) FILTER (card_id NOT IN (SELECT card_id FROM susp)) AS n_cards_out FROM tx GROUP BY 1""",
        "weekly_cities": f"""{VIEWS} SELECT card_id, CAST(date_trunc('week', ts) AS DATE) AS week_start,
count(DISTINCT city) AS n_cities_all, count(DISTINCT city) FILTER (city <> 'ONLINE') AS n_cities_physical FROM tx GROUP BY 1, 2""",
        "null_profile": null_profile(),
        "quality": quality(),
        "type_suspects": type_suspects(),
        "amount_stats": f"""{VIEWS} SELECT {mean('sum(cents)', 'count(*)')} AS mean_amount,
{units('quantile_disc(cents, 0.5)')} AS median_amount, {units('min(cents)')} AS min_amount, {units('max(cents)')} AS max_amount
FROM tx WHERE cents > 0""",
        "amount_bands": f"""{VIEWS} SELECT {order('cents', AMOUNT[0])} AS band_ord, {level('cents', *AMOUNT)} AS amount_band,
count(*) AS n_tx, {pct('count(*)', '(SELECT count(*) FROM tx WHERE cents > 0)')} AS pct_tx
FROM tx WHERE cents > 0 GROUP BY 1, 2""",
        "high_amount_share": f"""{VIEWS} SELECT count(*) FILTER (WHERE cents > 20000) AS n_high,
{pct('count(*) FILTER (WHERE cents > 20000)', 'count(*)')} AS pct_high FROM tx WHERE cents > 0""",
        "by_hour": count_by("h", "tx_hour"),
        "by_dow": count_by("dow", "tx_dow"),
        "by_month": count_by("month(ts)", "tx_month"),
        "night_share": f"""{VIEWS} SELECT {big('sum(night)')} AS n_night, {pct('sum(night)', 'count(*)')} AS pct_night FROM tx""",
        "category_volume": f"{VIEWS} {per_category}",
        "category_volume_top": f"{VIEWS} {per_category} ORDER BY n_tx DESC, merchant_category NULLS LAST LIMIT 10",
        "category_high_mean": f"{CATEGORY} SELECT * FROM means ORDER BY mean_amount DESC, merchant_category LIMIT 10",
        "category_risk": f"{CATEGORY} SELECT *, mean_amount > 200 AS is_high_value FROM means",
        "merchant_reputation": f"{MERCHANTS} SELECT * FROM shops",
        "suspicious_merchants": f"{MERCHANTS} SELECT * FROM shops WHERE n_tx <= 95 AND mean_amount > 200",
        "error_types": f"{ERROR_TYPES} SELECT * FROM types ORDER BY n_tx DESC, errors LIMIT 10",
        "top_error_type": f"""{ERROR_TYPES} SELECT errors, n_tx, {pct('n_tx', 'CAST((SELECT sum(n_tx) FROM types) AS BIGINT)')} AS error_share
FROM types ORDER BY n_tx DESC, errors LIMIT 1""",
        "error_type_risk": f"""{ERROR_TYPES} SELECT errors, n_tx, CASE errors WHEN 'Bad PIN' THEN 'suspect'
WHEN 'Technical Glitch' THEN 'watch' ELSE 'normal' END AS risk FROM types""",
        "card_error_rate": f"{VIEWS} {error_rates('card_id', 50)} ORDER BY error_rate DESC, card_id LIMIT 10",
        "client_error_rate": f"{VIEWS} {error_rates('client_id', 100)} ORDER BY error_rate DESC, client_id LIMIT 10",
        "card_error_rate_sketched": f"{VIEWS} {error_rates('card_id', 50)} ORDER BY error_rate DESC, card_id LIMIT 10",
        "client_error_rate_sketched": f"{VIEWS} {error_rates('client_id', 100)} ORDER BY error_rate DESC, client_id LIMIT 10",
        "moments_by_card": f"""{VIEWS} SELECT card_id, ts AS tx_ts, count(*) AS n_tx, {big('sum(err)')} AS n_errors,
{big('sum(pin)')} AS n_pin, min(id) AS first_id FROM tx GROUP BY card_id, ts""",
        "card_error_ratio_by_card": f"{VIEWS} {error_rates('card_id', 0)}",
        "enriched_by_card": enriched,
        "card_error_bands": error_bands("card_id", CARD_ERROR),
        "client_error_bands": error_bands("client_id", CLIENT_ERROR),
        "credit_band_errors": f"""{SCORED_CLIENTS}
SELECT {order('credit_score', CREDIT[0])} AS band_ord, {level('credit_score', *CREDIT)} AS credit_band, count(*) AS n_clients,
{mean("sum(CAST(round(error_rate * 100) AS BIGINT))", 'count(*)')} AS mean_error_rate FROM scored GROUP BY 1, 2""",
        "weak_profiles": f"{SCORED_CLIENTS} SELECT * FROM scored WHERE credit_score < 600 AND error_rate > 15",
        "dominant_error": f"""{VIEWS} SELECT card_id, errors AS dominant_error, n AS n_dominant
FROM (SELECT card_id, errors, count(*) AS n FROM tx WHERE err = 1 GROUP BY card_id, errors)
QUALIFY row_number() OVER (PARTITION BY card_id ORDER BY n DESC, errors) = 1""",
        "error_concentration": f"""{VIEWS}, hourly AS (
  SELECT card_id, date_trunc('hour', ts) AS hour, count(*) AS n FROM tx WHERE err = 1 GROUP BY ALL
)
SELECT card_id, {big('sum(n)')} AS n_errors, max(n) AS n_worst_hour, {pct('max(n)', 'sum(n)')} AS worst_hour_share
FROM hourly GROUP BY card_id""",
        "card_type_brand": f"""{TYPES} SELECT card_type, card_brand, count(*) AS n_tx,
{mean('sum(cents)', 'count(*)')} AS mean_amount FROM typed GROUP BY 1, 2""",
        "card_type_risk": f"""{TYPES} SELECT card_type, count(*) AS n_tx, {mean('sum(cents)', 'count(*)')} AS mean_amount,
CASE card_type WHEN 'Debit' THEN 'low' WHEN 'Credit' THEN 'medium' WHEN 'Debit (Prepaid)' THEN 'high' ELSE 'unknown' END AS risk
FROM typed GROUP BY card_type""",
        "dark_web_count": f"{DARK} SELECT count(*) AS n_cards FROM active",
        "dark_web_cards": f"{DARK} SELECT * FROM active ORDER BY n_tx DESC, card_id LIMIT 10",
        "card_age": f"""{VIEWS} SELECT id AS card_id, {integer(CARD_AGE)} AS card_age_days FROM cards""",
        "pin_recency": f"""{VIEWS} SELECT id AS card_id, {integer('2024 - pin_year')} AS pin_age_years FROM cards""",
        "new_card_burst": f"{IN_USE} SELECT card_id, n_tx, {integer('age')} AS card_age_days FROM used WHERE age < 30 AND n_tx >= 10",
        "stale_pin": f"{IN_USE} SELECT card_id, n_tx, {integer('pin_age')} AS pin_age_years FROM used WHERE pin_age >= 10",
        "enriched": enriched,
        "card_day_tx": f"{VIEWS} {day_tx}",
        "card_day_tx_top": f"{VIEWS} {day_tx} ORDER BY n_tx DESC, card_id, tx_date LIMIT 5",
        "card_day_spend": f"{VIEWS} {day_spend}",
        "card_day_spend_top": f"{VIEWS} {day_spend} ORDER BY spend_pos DESC, card_id, tx_date LIMIT 5",
        "card_day_cities": f"{VIEWS} {day_cities}",
        "card_day_cities_top": f"{VIEWS} {day_cities} ORDER BY n_cities_physical DESC, card_id, tx_date LIMIT 5",
        "card_error_ratio": f"{VIEWS} {ratios}",
        "card_error_ratio_top": f"{VIEWS} {ratios} ORDER BY error_ratio DESC, card_id LIMIT 5",
        "card_lifetime": f"""{VIEWS} SELECT card_id, count(*) AS n_tx, {units('sum(cents)')} AS amount_net,
count(DISTINCT city) AS n_cities, count(DISTINCT day) AS n_days FROM tx GROUP BY card_id""",
        "card_lifetime_bitmaps": f"""{VIEWS} SELECT card_id, count(*) AS n_tx, {units('sum(cents)')} AS amount_net,
count(DISTINCT city) AS n_cities, count(DISTINCT day) AS n_days FROM tx GROUP BY card_id""",
        "card_day_indicators": f"{VIEWS} SELECT {SCORE_COLUMNS} FROM carddays",
        "weekly_tx": f"""{VIEWS} SELECT card_id, CAST(date_trunc('week', ts) AS DATE) AS week_start, count(*) AS n_tx
FROM tx GROUP BY 1, 2""",
        "online_ratio": f"""{VIEWS} SELECT card_id, count(*) AS n_tx, count(*) FILTER (WHERE city = 'ONLINE') AS n_online,
{pct("count(*) FILTER (WHERE city = 'ONLINE')", 'count(*)')} AS online_pct FROM tx GROUP BY card_id""",
        "suspicious_cards": f"{FLAGGED} SELECT * FROM susp",
        "suspicious_cards_top": f"{FLAGGED} SELECT * FROM susp ORDER BY n_rule_hits DESC, card_id LIMIT 20",
        "suspicious_count": f"{FLAGGED} SELECT count(*) AS n_cards FROM susp",
        "suspicion_reasons": f"{FLAGGED} SELECT reason, count(DISTINCT card_id) AS n_cards FROM hits GROUP BY reason",
        "criteria_levels": f"""{FLAGGED} SELECT *,
{level('n_criteria', (2, 3, 4), ('low', 'medium', 'high', 'critical'))} AS level,
{level('n_criteria', (2, 3, 4), ('watch', 'alert analyst', 'temporary block', 'block'))} AS action FROM susp""",
        "risk_score_card_day": f"{VIEWS} {score_rows}",
        "risk_score_top": f"{VIEWS} {score_rows} ORDER BY risk_score DESC, card_id, tx_date LIMIT 20",
        "risk_score_bands": f"""{VIEWS} SELECT {order('score', SCORE[0])} AS band_ord, {level('score', *SCORE)} AS score_band,
count(*) AS n_card_days FROM scores GROUP BY 1, 2""",
        "score_levels": f"""{VIEWS} SELECT card_id, day AS tx_date, {big('score')} AS risk_score,
{level('score', *SCORE)} AS level, {level('score', SCORE[0], ACTIONS)} AS action FROM scores""",
        "population_profile": f"""{STRICT}, sc AS (
  SELECT DISTINCT client_id FROM tx WHERE card_id IN (SELECT card_id FROM susp)
), sided AS (
  SELECT CASE WHEN client_id IN (SELECT client_id FROM sc) THEN 'Suspect' ELSE 'Normal' END AS client_type, *
  FROM tx LEFT JOIN users ON client_id = users.id
)
SELECT client_type, count(*) AS n_tx, {mean('sum(cents)', 'count(*)')} AS mean_amount,
{ratio('sum(score)', 'count(score)')} AS mean_credit_score, {ratio('sum(age)', 'count(age)')} AS mean_age,
{ratio('sum(income)', 'count(income)')} AS mean_income FROM sided GROUP BY client_type""",
        "time_since_last_tx": f"""{PREVIOUS} SELECT id, card_id, ts AS tx_ts,
CAST(sec - before AS DOUBLE) / CAST(60 AS DOUBLE) AS minutes_since_last FROM prev""",
        "amount_deviation": f"""{CLIENT_MEAN} SELECT id, client_id, {DEVIATION} AS amount_deviation
FROM tx JOIN usual USING (client_id)""",
        "credit_limit_ratio": f"""{VIEWS} SELECT tx.id, card_id,
({units('cents')}) / nullif({units('limit_cents')}, 0) AS amount_to_limit FROM tx LEFT JOIN cards ON card_id = cards.id""",
        "error_streaks": f"{RUNS} SELECT card_id, started, ended, {big('n_err')} AS n_errors FROM runs WHERE n_err >= 1",
        "consecutive_errors": f"""{RUNS} SELECT card_id, {big('max(n_err)')} AS longest_run,
{big('arg_max(n_err, run)')} AS current_run FROM runs GROUP BY card_id""",
        "pin_lockout": f"{RUNS} SELECT card_id, started, ended, {big('n_pin')} AS n_pin FROM runs WHERE n_pin >= 2",
        "velocity_5min": trailing("1", 300, 2),
        "pin_burst": trailing("pin", 86400, 2),
        "dormant_reactivation": f"""{VIEWS}, silent AS (
  SELECT card_id, ts, sec - lag(sec) OVER (PARTITION BY card_id ORDER BY ts, id) AS gap,
         count(*) OVER ({ORDERED} RANGE BETWEEN CURRENT ROW AND 86400 FOLLOWING) AS n_after FROM tx
)
SELECT card_id, ts AS tx_ts, CAST(gap AS DOUBLE) / CAST(86400 AS DOUBLE) AS gap_days, n_after FROM silent
WHERE gap > 3 * 86400 AND n_after >= 2""",
        "synthesis_metrics": synthesis(),
        "transaction_features": transaction_features(),
        "code_map_unpivot": f"{VIEWS} SELECT * FROM codes",
        "fraud_labels": "SELECT doc_id AS transaction_id, toxic = 1 AS is_fraud FROM labels",
        "csv_roundtrip": f"""{VIEWS} SELECT id, ts AS tx_ts, client_id, card_id, {units('cents')} AS amount, merchant_id,
city AS merchant_city, zip, mcc, nullif(errors, '') AS errors FROM tx""",
        "parquet_roundtrip": f"{VIEWS} {score_rows} WHERE score > 50",
        "codes_file": f"{VIEWS} SELECT * FROM codes",
        "codes_object": f"""{VIEWS} SELECT mcc_code, mcc_category || ', "fine" {{and}} \\ other' AS mcc_category FROM codes""",
        "labels_object": "SELECT doc_id AS transaction_id, toxic = 1 AS is_fraud FROM labels",
        "labels_file": "SELECT doc_id AS transaction_id, toxic = 1 AS is_fraud FROM labels",
        "cards_csv": f"""{VIEWS} SELECT id, card_brand, card_type, has_chip,
'$' || (limit_cents // 100) || '.' || lpad(CAST(limit_cents % 100 AS VARCHAR), 2, '0') AS credit_limit,
strftime(opened, '%m/%Y') AS acct_open_date, {integer('pin_year')} AS year_pin_last_changed, dark AS card_on_dark_web FROM cards""",
        "users_csv": f"""{VIEWS} SELECT id, {integer('age')} AS current_age, gender, '$' || income AS yearly_income,
score AS credit_score, {integer('n_cards')} AS num_credit_cards FROM users""",
        "scores_appended": f"{VIEWS} {score_rows}",
        "scores_appended_once": f"{VIEWS} {score_rows}",
        "observed_null_profile": null_profile(),
        "observed_quality": quality(),
        "schema": """SELECT CAST(o AS INTEGER) AS ordinal, n AS name, t AS type FROM (VALUES (1, 'id', 'bigint'), (2, 'date', 'string'),
(3, 'client_id', 'bigint'), (4, 'card_id', 'bigint'), (5, 'amount', 'string'), (6, 'merchant_id', 'bigint'), (7, 'merchant_city', 'string'),
(8, 'zip', 'string'), (9, 'mcc', 'int'), (10, 'errors', 'string')) AS listed(o, n, t)""",
        "preview": f"""{VIEWS} SELECT id, client_id, card_id, merchant_id, city AS merchant_city, zip, mcc FROM tx ORDER BY id LIMIT 10""",
        "suspicious_cards_saved": f"{FLAGGED} SELECT * FROM susp",
        "enriched_saved": f"""{VIEWS} SELECT day AS tx_date, category AS merchant_category, count(*) AS n_tx,
{units('sum(cents)')} AS amount_net FROM tc GROUP BY 1, 2""",
        "stream_card_day": f"""{VIEWS} SELECT {SCORE_COLUMNS} FROM carddays
WHERE CAST(day AS TIMESTAMP) + INTERVAL 1 DAY <= {WATERMARK}""",
        "stream_velocity": sliding("1", 5, 1, 2),
        "stream_pin_burst": sliding("pin", 60, 10, 2),
        "stream_velocity_exact": f"{trailing('1', 300, 2)} AND ts + INTERVAL 1 SECOND <= {WATERMARK}",
        "stream_pin_exact": f"{trailing('pin', 86400, 2)} AND ts + INTERVAL 1 SECOND <= {WATERMARK}",
        "stream_enrich": enriched,
        "stream_sessions": f"""{VIEWS}, marked AS (
  SELECT card_id, ts, cents, CASE WHEN ts - lag(ts) OVER (PARTITION BY card_id ORDER BY ts, id) <= INTERVAL 6 HOUR
                           THEN 0 ELSE 1 END AS is_new FROM tx
), numbered AS (
  SELECT card_id, ts, cents, sum(is_new) OVER (PARTITION BY card_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM marked
), closed AS (
  SELECT card_id, min(ts) AS session_start, max(ts) + INTERVAL 6 HOUR AS session_end, count(*) AS n_tx,
         {units('sum(cents)')} AS amount_net
  FROM numbered GROUP BY card_id, session
)
SELECT * FROM closed WHERE session_end <= {WATERMARK}""",
    }
