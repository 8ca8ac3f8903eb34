"""Grouped metrics. Everything is a map-side combined aggregate.

No group is ever gathered whole: distinct items are deduplicated under
(group, item) first, order-dependent picks go through ``min_by``/``max_by``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardmetrics.functions.numbers import annualised
from wardmetrics.session import written

UNKNOWN_ENTITY = "Unknown / Outside London"

# The grades an inspection average counts.
GRADES = (1, 4)


def graded_average(column: Column, low: int = GRADES[0], high: int = GRADES[1], when: Column | None = None) -> Column:
    """Mean of the values that read as a number within the grade bounds."""
    number = column.cast("string").try_cast("double")
    valid = number.between(low, high)
    return F.avg(F.when(valid if when is None else when & valid, number))


def _masked(column: Column, when: Column | None) -> Column:
    return column if when is None else F.when(when, column)


def _first(column: Column, when: Column | None, order: Column | None) -> Column:
    if order is None:
        raise ValueError("'first' and 'last' need an order column")
    value = _masked(column, when)
    return F.min_by(value, F.when(value.isNotNull(), order))


def _last(column: Column, when: Column | None, order: Column | None) -> Column:
    if order is None:
        raise ValueError("'first' and 'last' need an order column")
    value = _masked(column, when)
    return F.max_by(value, F.when(value.isNotNull(), order))


# name -> (column, subset condition or None, order column or None) -> aggregate
AGGREGATES: dict[str, Callable[[Column, Column | None, Column | None], Column]] = {
    "sum": lambda c, when, order: F.coalesce(F.sum(_masked(c, when)), F.lit(0)),
    "mean": lambda c, when, order: F.avg(_masked(c, when)),
    "min": lambda c, when, order: F.min(_masked(c, when)),
    "max": lambda c, when, order: F.max(_masked(c, when)),
    "count": lambda c, when, order: F.count(_masked(c, when)),
    "size": lambda c, when, order: F.count(F.lit(1)) if when is None else F.count_if(when),
    "nunique": lambda c, when, order: F.count_distinct(_masked(c, when)),
    "std": lambda c, when, order: F.stddev_samp(_masked(c, when)),
    "var": lambda c, when, order: F.var_samp(_masked(c, when)),
    "first": _first,
    "last": _last,
    "prod": lambda c, when, order: F.coalesce(F.product(_masked(c, when)), F.lit(1.0)),
    "any": lambda c, when, order: F.coalesce(F.bool_or(_masked(c, when).cast("boolean")), F.lit(False)),
    "all": lambda c, when, order: F.coalesce(F.bool_and(_masked(c, when).cast("boolean")), F.lit(True)),
    "ofsted_average": lambda c, when, order: graded_average(c, when=when),
    "graded_average": lambda c, when, order: graded_average(c, when=when),
}

# Aggregates planned on their own (see :func:`group_medians`).
MEDIAN = "median"


def register_aggregate(name: str, build: Callable[[Column, Column | None, Column | None], Column]) -> None:
    """Add a named aggregate; rules may use it at once."""
    AGGREGATES[name] = build


def named_aggregate(
    operation: str, column: Column, when: Column | None = None, order: Column | None = None, value: object = None
) -> Column:
    if operation == "count_where":
        match = column == F.lit(value)
        return F.count_if(match if when is None else when & match)
    if operation == MEDIAN:
        raise ValueError("'median' is planned on its own: see group_medians")
    if operation not in AGGREGATES:
        raise ValueError(f"unknown aggregate {operation!r}; known: {sorted([*AGGREGATES, 'count_where', MEDIAN])}")
    return AGGREGATES[operation](column, when, order)


def group_metrics(
    df: DataFrame,
    keys: Sequence[str],
    aggregations: Mapping[str, str | Sequence[str]],
    order_by: str | None = None,
) -> DataFrame:
    """``aggregations`` maps a column to one operation or several (``{col}_{op}``)."""
    if not aggregations:
        raise ValueError("no aggregations given")
    order = F.col(order_by) if order_by else None
    known = df.dropna(subset=list(keys))
    plain: list[Column] = []
    medians: dict[str, str] = {}
    names: list[str] = []
    for source, operations in aggregations.items():
        several = not isinstance(operations, str)
        for operation in operations if several else [operations]:
            name = f"{source}_{operation}" if several else source
            names.append(name)
            if operation == MEDIAN:
                medians[name] = source
            else:
                plain.append(named_aggregate(operation, F.col(f"`{source}`"), order=order).alias(name))
    # One row per group first: a group whose values are all null has no median row.
    frames = [known.groupBy(*keys).agg(*plain) if plain else known.select(*keys).distinct()]
    frames += [group_medians(known, keys, source, name) for name, source in medians.items()]
    joined = reduce(lambda left, right: left.join(right, list(keys), "left"), frames)
    return joined.select(*keys, *[f"`{n}`" for n in names])


def group_medians(df: DataFrame, keys: Sequence[str], column: str, name: str, buckets: int = 1024) -> DataFrame:
    """Exact median per group without gathering a group.

    An approximate quantile pair brackets each group's middle. Equal values are
    counted, the bracket is cut into buckets, and bucket counts tell which ones
    hold the middle ranks; only the distinct values of those are ranked. Bracket
    and buckets decide how few values get that far, never the result: values
    outside the bracket are buckets of their own.
    """
    keys = list(keys)
    values = df.filter(F.col(f"`{column}`").isNotNull()).select(*keys, F.col(f"`{column}`").cast("double").alias("_v"))
    counted = values.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n"))
    spans = values.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_total"), F.percentile_approx("_v", [0.499, 0.501], 10000).alias("_q")
    ).select(*keys, "_total", F.element_at("_q", 1).alias("_lo"), F.element_at("_q", 2).alias("_hi"))
    width = F.nullif(F.col("_hi") - F.col("_lo"), F.lit(0.0))
    inner = F.coalesce(F.floor((F.col("_v") - F.col("_lo")) / width * buckets), F.lit(0))
    placed = counted.join(spans, keys).withColumn(
        "_b",
        F.when(F.col("_v") < F.col("_lo"), F.lit(-1))
        .when(F.col("_v") > F.col("_hi"), F.lit(buckets))
        .otherwise(F.least(inner, F.lit(buckets - 1))),
    )
    sizes = placed.groupBy(*keys, "_b").agg(F.sum("_n").alias("_size"), F.max("_total").alias("_total"))
    by_bucket = Window.partitionBy(*keys).orderBy("_b")
    low, high = F.floor((F.col("_total") + 1) / 2), F.floor((F.col("_total") + 2) / 2)
    middle = (
        sizes.withColumn("_end", F.sum("_size").over(by_bucket))
        .withColumn("_start", F.col("_end") - F.col("_size"))
        .filter((F.col("_start") < high) & (F.col("_end") >= low))
        .select(*keys, "_b", "_start")
    )
    in_bucket = Window.partitionBy(*keys, "_b").orderBy("_v")
    ranked = (
        placed.join(middle, [*keys, "_b"])
        .withColumn("_end", F.sum("_n").over(in_bucket) + F.col("_start"))
        .filter((F.col("_end") - F.col("_n") < high) & (F.col("_end") >= low))
    )
    # One or two distinct values are left per group: the middle ranks.
    return ranked.groupBy(*keys).agg(((F.min("_v") + F.max("_v")) / 2).alias(name))


def group_size(df: DataFrame, keys: Sequence[str], name: str = "size", weight: str | None = None) -> DataFrame:
    """Rows per group; rows with a null key are left out. ``weight`` names a column saying how many rows a row stands for."""
    size = F.sum(weight) if weight else F.count(F.lit(1))
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(size.alias(name))


def comma_union(df: DataFrame, keys: Sequence[str], text: str, name: str, size: str | None = None, weight: str | None = None) -> DataFrame:
    """Distinct items of all comma lists of a group, sorted, as one comma list.

    With ``size`` the group's row count comes out of the same pass, ``weight``
    rows for each row where given. Items are made distinct under (group, item), so
    a large group is spread over tasks.
    """
    keys = list(keys)
    stands_for = F.col(weight) if weight else F.lit(1)
    items = df.dropna(subset=keys).select(*keys, stands_for.cast("bigint").alias("_for"), F.posexplode_outer(F.split(F.col(f"`{text}`"), ",")).alias("_pos", "_part"))
    rows = F.coalesce(F.sum(F.when(F.coalesce(F.col("_pos"), F.lit(0)) == 0, F.col("_for"))), F.lit(0))
    distinct = items.groupBy(*keys, F.trim("_part").alias("_item")).agg(rows.alias("_rows"))
    out = [F.array_join(F.array_sort(F.collect_list("_item")), ", ").alias(name)]
    if size:
        out.insert(0, F.sum("_rows").alias(size))
    return distinct.groupBy(*keys).agg(*out)


def counts_by_sets(df: DataFrame, sets: Mapping[str, Sequence[str]]) -> dict[str, DataFrame]:
    """Row counts of ``df`` by several sets of keys, in one pass over ``df``.

    One aggregate over grouping sets, combined before its shuffle and written; each
    result has its keys and ``count``. Null keys are groups of their own.
    """
    columns = list(dict.fromkeys(c for keys in sets.values() for c in keys))
    one = df.groupingSets([[F.col(f"`{c}`") for c in keys] for keys in sets.values()], *[F.col(f"`{c}`") for c in columns]).agg(
        F.count(F.lit(1)).alias("count"), F.grouping_id().alias("_set"))
    stored = written(one, "counts-by-sets")

    def away(keys: Sequence[str]) -> int:
        """The set's grouping id: one bit for each column it leaves out."""
        return sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in keys)

    return {name: stored.filter(F.col("_set") == away(keys)).select(*[F.col(f"`{c}`") for c in keys], "count") for name, keys in sets.items()}


def count_with_unknown(df: DataFrame, name: str, entity: str = "BOROUGH", unknown: str = UNKNOWN_ENTITY) -> DataFrame:
    """Rows per entity; a null entity is counted under ``unknown``."""
    return df.groupBy(F.coalesce(F.col(entity), F.lit(unknown)).alias(entity)).agg(F.count(F.lit(1)).alias(name))


def monthly_counts(
    df: DataFrame,
    entity: str = "borough",
    category: str = "category",
    year: str = "year",
    month: str = "month",
) -> DataFrame:
    """Rows per year, month, entity and category; null categories are not counted."""
    known = df.filter(F.col(category).isNotNull())
    return known.groupBy(year, month, entity, category).agg(F.count(F.lit(1)).alias("count"))


def annual_rollup(
    counts: DataFrame,
    entity: str = "borough",
    category: str = "category",
    year: str = "year",
    month: str = "month",
) -> DataFrame:
    """Yearly total, months present, and the rate per twelve months.

    A category's months are its own: a month without the category shortens its
    divisor.
    """
    yearly = counts.groupBy(year, entity, category).agg(
        F.sum("count").alias("total_count"), F.count_distinct(month).alias("months_present")
    )
    return yearly.withColumn("annualised_rate", annualised(F.col("total_count"), F.col("months_present")))
