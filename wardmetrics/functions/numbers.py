"""Row-wise arithmetic on metric columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_sum(columns: Sequence[Column]) -> Column:
    """Sum across columns; nulls are skipped and an all-null row sums to 0."""
    return reduce(lambda left, right: left + right, [F.coalesce(c.cast("double"), F.lit(0.0)) for c in columns])


def ratio(numerator: Column, denominator: Column, scale: float) -> Column:
    """``numerator / denominator * scale``; a zero denominator gives null."""
    below = denominator.cast("double")
    return numerator.cast("double") / F.nullif(below, F.lit(0.0)) * F.lit(float(scale))


def ratio_pct(numerator: Column, denominator: Column) -> Column:
    return ratio(numerator, denominator, 100)


def ratio_per_1k(numerator: Column, denominator: Column) -> Column:
    return ratio(numerator, denominator, 1000)


def annualised(total: Column, months: Column) -> Column:
    """Yearly rate of a total seen over ``months`` months."""
    return ratio(total, months, 12)


def pct_deviation(value: Column, mean: Column) -> Column:
    """Distance from the mean in percent; a zero mean gives null."""
    wide = value.cast("double")
    return (wide - mean) / F.nullif(mean, F.lit(0.0)) * F.lit(100.0)


def pct_change(value: Column, previous: Column) -> Column:
    """Change against the previous value in percent; never infinite."""
    return (value.cast("double") / F.nullif(previous.cast("double"), F.lit(0.0)) - F.lit(1.0)) * F.lit(100.0)
