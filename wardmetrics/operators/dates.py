"""The order of day and month in each source's date columns, learned from all of their cells."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmetrics.functions.cast import DAY_FIRST, MONTH_FIRST, NULL_TOKENS, YEAR_LAST, cast_columns, clean_text, order_of, possible_orders
from wardmetrics.functions.text import all_of
from wardmetrics.session import read_once, written

DATE_TYPES = ("DATE", "DATETIME", "TIMESTAMP")


def date_orders(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """``by`` columns, ``column``, ``order``: how each source writes the year-last dates of each column.

    One aggregate for all columns: the orders still possible, combined bit by bit
    over all cells. ``day`` or ``month`` where one is left, ``either`` where no
    cell decides (no day beyond 12), ``neither`` where cells contradict each
    other, null where there is no such date.
    """
    parts = []
    for i, name in enumerate(columns):
        text = clean_text(F.col(f"`{name}`"), tokens)
        parts += [F.bit_and(possible_orders(text)).alias(f"_b{i}"), F.count_if(text.rlike(YEAR_LAST)).alias(f"_n{i}")]
    learned = df.groupBy(*[F.col(f"`{c}`") for c in by]).agg(*parts)
    told = F.array(*[F.struct(F.lit(name).alias("column"), order_of(F.col(f"_b{i}"), F.col(f"_n{i}")).alias("order")) for i, name in enumerate(columns)])
    return learned.select(*[F.col(f"`{c}`") for c in by], F.inline(told))


def cast_by_order(
    df: DataFrame, types: Mapping[str, str], by: Sequence[str] = (), tokens: Sequence[str] = NULL_TOKENS
) -> tuple[DataFrame, DataFrame]:
    """:func:`cast_columns` with the dates of each source in the order its cells allow, and the orders themselves.

    Sources whose cells leave both orders, or neither, are read day first; the
    second frame tells which.
    """
    dates = [c for c, kind in types.items() if kind in DATE_TYPES]
    if not dates:
        raise ValueError("no date among the types")
    rows = read_once(df, "date-rows")
    # One row per source and column: small beside the rows, so its measured size makes the join a broadcast.
    learned = written(date_orders(rows, dates, by, tokens), "date-orders")
    first = [F.max(F.when((F.col("column") == c) & (F.col("order") == MONTH_FIRST), F.lit(MONTH_FIRST))).alias(f"_order_{i}") for i, c in enumerate(dates)]
    wide = learned.groupBy(*[F.col(f"`{c}`").alias(f"_by_{c}") for c in by]).agg(*first)
    if by:
        joined = rows.join(wide, all_of([F.col(f"`{c}`").eqNullSafe(F.col(f"`_by_{c}`")) for c in by]), "left")
        orders: dict[str, str | Column] = {c: F.coalesce(F.col(f"_order_{i}"), F.lit(DAY_FIRST)) for i, c in enumerate(dates)}
    else:
        joined, only = rows, wide.first()
        orders = {c: only[f"_order_{i}"] or DAY_FIRST for i, c in enumerate(dates)}
    cast = cast_columns(joined, types, tokens, orders=orders)
    return cast.select(*[F.col(f"`{c}`") for c in df.columns]), learned
