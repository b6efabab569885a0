"""One pass that answers all small reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.operators.amounts import with_amount_band
from txrisk.operators.facts import totals
from txrisk.operators.sketches import positive_sketch

SLICES = {
    "time": ("tx_hour", "tx_dow", "tx_month"),
    "code": ("mcc",),
    "error": ("errors",),
    "amount": ("band_ord", "amount_band"),
}


def summary(facts: DataFrame) -> DataFrame:
    """All measures, and a sketch of the positive amounts, by time of activity, by category code, by error text and by amount band.

    Four groupings of a single scan. Each has few groups, so a task shuffles thousands of partial sums at
    most. Read one grouping with :func:`part`.
    """
    sets = [list(columns) for columns in SLICES.values()]
    columns = [name for names in SLICES.values() for name in names]
    marks = [F.grouping(names[0]).alias(f"without_{part}") for part, names in SLICES.items()]
    return with_amount_band(facts).groupingSets(sets, *columns).agg(*totals(), positive_sketch(), *marks)


def part(summarised: DataFrame, name: str) -> DataFrame:
    """The rows of one grouping. They stand in for the facts in every report over those columns."""
    marks = [f"without_{other}" for other in SLICES]
    others = [column for other, columns in SLICES.items() if other != name for column in columns]
    return summarised.filter(F.col(f"without_{name}") == 0).drop(*marks, *others)
