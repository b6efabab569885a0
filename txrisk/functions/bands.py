"""Cutting a number into labelled intervals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from txrisk.params import Bands


def _choose(value: Column, cuts, results) -> Column:
    *inner, last = results
    chain = reduce(
        lambda whens, step: whens.when(value < F.lit(step[0]), F.lit(step[1])),
        zip(cuts, inner),
        F.when(value.isNull(), F.lit(None)),
    )
    return chain.otherwise(F.lit(last))


def band_label(value: Column, bands: Bands) -> Column:
    return _choose(value, bands.cuts, bands.labels)


def band_order(value: Column, bands: Bands) -> Column:
    """1 for the lowest interval, so that reports sort by value and not by label."""
    return _choose(value, bands.cuts, range(1, len(bands.labels) + 1))
