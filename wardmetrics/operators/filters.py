"""Row filters. Each public factory returns a ``DataFrame -> DataFrame`` step."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Step = Callable[[DataFrame], DataFrame]


def keep_values(column: str, values: Iterable[object]) -> Step:
    """Rows whose column is one of the values; null is none of them."""
    listed = list(values)
    return lambda df: df.filter(F.col(f"`{column}`").isin(*listed))


def keep_listed(column: str, listed: DataFrame, listed_column: str | None = None) -> Step:
    """:func:`keep_values` where the list is itself a table."""
    other = listed.select(F.col(listed_column or column).alias(column)).distinct()
    return lambda df: df.join(other, column, "left_semi")


def drop_values(df: DataFrame, rules: Sequence[Mapping] | Mapping) -> DataFrame:
    """Drop rows whose column is one of the rule's values.

    Rows with a null there stay, and a rule on an absent column does nothing.
    """
    rules = [rules] if isinstance(rules, Mapping) else rules
    for rule in rules:
        if rule["column"] in df.columns and rule["values"]:
            hit = F.col(f"`{rule['column']}`").isin(*rule["values"])
            df = df.filter(~F.coalesce(hit, F.lit(False)))
    return df


def year_range(low: int = 2023, high: int = 2026, column: str = "year") -> Step:
    return lambda df: df.filter(F.col(column).between(low, high))


def anniversary(
    low: date = date(2021, 1, 1),
    high: date = date(2025, 12, 31),
    month: int = 1,
    day: int = 1,
    column: str = "date",
) -> Step:
    """Rows dated on one day of the year, between two dates (both included, at midnight)."""

    def step(df: DataFrame) -> DataFrame:
        moment = F.col(column)
        return df.filter(
            moment.between(F.lit(low).cast("timestamp_ntz"), F.lit(high).cast("timestamp_ntz"))
            & (F.month(moment) == month)
            & (F.dayofmonth(moment) == day)
        )

    return step
