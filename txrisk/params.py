"""Parameters of the analyses. The defaults are the documented business values."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values.
ONLINE_CITY = "ONLINE"
UNKNOWN_CATEGORY = "Unknown"
DARK_WEB_YES = "Yes"
BAD_PIN = "Bad PIN"
INSUFFICIENT_BALANCE = "Insufficient Balance"
TIME_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
ERROR_RISK = {
    "Insufficient Balance": "normal",
    "Bad PIN": "suspect",
    "Technical Glitch": "watch",
    "Card Expired": "normal",
}
CARD_TYPE_RISK = {"Prepaid": "high", "Credit": "medium", "Debit": "low"}


@dataclass(frozen=True)
class Bands:
    """Half-open intervals: ``labels[i]`` covers values below ``cuts[i]``, the last label the rest."""

    cuts: tuple[float, ...]
    labels: tuple[str, ...]


AMOUNT_BANDS = Bands((10, 50, 200), ("< 10", "10-50", "50-200", ">= 200"))
CREDIT_BANDS = Bands((600, 700, 800), ("< 600", "600-700", "700-800", ">= 800"))
SCORE_BANDS = Bands((10, 30, 50), ("low (< 10)", "medium (10-30)", "high (30-50)", "critical (>= 50)"))
SCORE_ACTIONS = Bands((10, 30, 50), ("none", "watch", "alert analyst", "block"))
CRITERIA_LEVELS = Bands((2, 3, 4), ("low", "medium", "high", "critical"))
CRITERIA_ACTIONS = Bands((2, 3, 4), ("watch", "alert analyst", "temporary block", "block"))
# Error rates have two decimals: 15.01 is the first one above 15.
CARD_ERROR_BANDS = Bands((5, 15.01), ("normal", "elevated", "suspect"))
CLIENT_ERROR_BANDS = Bands((5, 10.01, 20.01), ("low", "human", "high", "attack"))


@dataclass(frozen=True)
class Thresholds:
    """A card-day is flagged when it is strictly above one of these."""

    max_tx: int = 10
    max_cities: int = 3
    max_amount: int = 1000


@dataclass(frozen=True)
class ScoreWeights:
    per_tx: int = 2
    per_city: int = 5
    per_error: int = 10
    per_night_tx: int = 3
    high_amount: int = 1000
    high_amount_bonus: int = 15


@dataclass(frozen=True)
class Floors:
    """Smallest group sizes for which a rate or a mean is reported."""

    category_tx_above: int = 100
    card_tx: int = 50
    scored_client_tx: int = 50
    client_tx: int = 100


@dataclass(frozen=True)
class BurstRules:
    velocity_tx: int = 10
    velocity_seconds: int = 300
    pin_errors: int = 3
    pin_seconds: int = 3600
    pin_lockout: int = 5
    dormant_days: int = 180
    wake_tx: int = 2  # the one that ends the silence included
    wake_seconds: int = 86400


@dataclass(frozen=True)
class DecisionRules:
    high_mean_amount: int = 200
    weak_credit_score: int = 600
    weak_error_rate: int = 15
    merchant_max_tx: int = 100
    merchant_min_mean: int = 200
    new_card_days: int = 30
    new_card_tx: int = 10
    stale_pin_years: int = 10
