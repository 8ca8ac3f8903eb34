"""Pivots, unpivots, year columns, unions and first-wins dedupes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmetrics.functions.text import slugify


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name; absent columns are null."""
    return reduce(lambda top, bottom: top.unionByName(bottom, allowMissingColumns=True), frames)


def ensure_year(df: DataFrame, source: str | None = None) -> DataFrame:
    """Integer ``year`` from ``year``, a date column, or ``year_name``.

    ``source`` names the column to use; left out, the first of ``year``,
    ``date`` and ``year_name`` that is present is taken.
    """
    source = source or next((c for c in ("year", "date", "year_name") if c in df.columns), None)
    if source is None or source not in df.columns:
        raise ValueError(f"cannot derive 'year': columns are {df.columns}")
    kind = dict(df.dtypes)[source]
    column = F.col(f"`{source}`")
    return df.withColumn("year", (F.year(column) if kind.startswith(("timestamp", "date")) else column).cast("int"))


def unpivot_years(df: DataFrame, var_name: str = "year", value_name: str = "net_additions") -> DataFrame:
    """Columns named by digits only become (year, value) rows; null values stay."""
    years = [c for c in df.columns if c.isdigit()]
    ids = [F.col(f"`{c}`") for c in df.columns if c not in years]
    if not years:
        raise ValueError("no column name consists of digits only")
    long = df.unpivot(ids, [F.col(f"`{c}`") for c in years], var_name, value_name)
    return long.withColumn(var_name, F.col(var_name).cast("int"))


def pivot_categories(
    df: DataFrame,
    values: Sequence[str],
    index: Sequence[str] = ("year", "borough"),
    category: str = "category",
    value: str = "annualised_rate",
) -> DataFrame:
    """One row per index, one ``{slug}_{value}`` column per listed category slug.

    The list is given, so no job runs to find it. Null values and null index
    keys take no part. Cells are means.
    """
    known = df.filter(F.col(value).isNotNull()).dropna(subset=list(index))
    cells = known.select(*index, slugify(F.col(category)).alias("_slug"), F.col(value))
    wide = cells.groupBy(*index).pivot("_slug", list(values)).agg(F.avg(value))
    return wide.select(*index, *[F.col(f"`{v}`").alias(f"{v}_{value}") for v in values])


def category_lookup(df: DataFrame, category: str = "category", group: str = "analytical_category") -> DataFrame:
    """Distinct (category, slug, group) rows."""
    return df.select(category, slugify(F.col(category)).alias(f"{category}_slug"), group).dropDuplicates()


def first_by_key(df: DataFrame, keys: str | Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row per key in the given order, by a map-side combined aggregate.

    No window: a hot key is reduced to one row per task before the shuffle.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    ranked = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(
        F.min_by(F.struct(*[F.col(f"`{c}`") for c in rest]), ranked).alias("_row")
    )
    return picked.select(*[F.col(f"`{c}`") if c in keys else F.col(f"_row.`{c}`").alias(c) for c in df.columns])


def latest(df: DataFrame, column: str = "year") -> DataFrame:
    """Rows of the greatest value of ``column``, by a scalar subquery."""
    newest = df.agg(F.max(column)).scalar()
    return df.filter(F.col(column) == newest)
