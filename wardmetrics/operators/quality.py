"""Constraint checks. Each returns the violations as rows; none stops a run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmetrics.functions.cast import NULL_TOKENS, cast_text, clean_text, text_to_float


def duplicate_keys(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row count ``n``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def orphan_keys(df: DataFrame, dimension: DataFrame, key: str, dimension_key: str | None = None) -> DataFrame:
    """Key values absent from the dimension, with their row count ``n``.

    Keys are counted before the anti join, so a hot key is one row of it.
    """
    known = dimension.select(F.col(dimension_key or key).alias(key)).distinct()
    counted = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counted.join(known, key, "left_anti")


def orphan_rows(df: DataFrame, dimension: DataFrame, key: str, dimension_key: str | None = None) -> DataFrame:
    """The rows behind :func:`orphan_keys`."""
    bad = orphan_keys(df, dimension, key, dimension_key)
    return df.join(bad.select(key), key, "left_semi")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n) for every listed column that holds nulls; one pass."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in columns])
    return counts.unpivot([], [F.col(f"`{c}`") for c in columns], "column", "n").filter("n > 0")


def null_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a null in one of the columns."""
    return df.filter(reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNull() for c in columns]))


def apply_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Column defaults where the value is null; absent columns are ignored."""
    return df.fillna({c: v for c, v in defaults.items() if c in df.columns})


def rule_counts(df: DataFrame, keys: Sequence[str], required: Sequence[str] = (), foreign: str | None = None) -> DataFrame:
    """Duplicate keys, nulls and foreign keys of a table, counted in one pass.

    Columns: ``rule`` (``unique``, ``not_null``, ``foreign_key``), ``column`` (of a
    ``not_null`` row), the keys, ``n``. Each row is expanded to what its rules
    count: its keys, its nulls, its foreign key; one aggregate, combined before
    the shuffle, counts them all. Keys held once are left out; foreign keys are
    counted whether or not their dimension has them.
    """
    keys = list(keys)
    kinds = dict(df.dtypes)
    absent = {k: F.lit(None).cast(kinds[k]) for k in keys}

    def entry(rule: str, column: str | None = None, held: Sequence[str] = (), when: Column | None = None):
        name = F.lit(rule) if when is None else F.when(when, F.lit(rule))
        return F.struct(name.alias("rule"), F.lit(column).cast("string").alias("column"), *[(F.col(f"`{k}`") if k in held else absent[k]).alias(k) for k in keys])

    entries = [entry("unique", held=keys)]
    entries += [entry("not_null", c, when=F.col(f"`{c}`").isNull()) for c in required]
    if foreign:
        entries.append(entry("foreign_key", held=[foreign], when=F.col(f"`{foreign}`").isNotNull()))
    expanded = df.select(F.inline(F.array(*entries))).filter(F.col("rule").isNotNull())
    counted = expanded.groupBy("rule", "column", *[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias("n"))
    return counted.filter((F.col("rule") != "unique") | (F.col("n") > 1))


def cast_report(raw: DataFrame, types: Mapping[str, str], tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """(column, raw_value, problem, n): cells a cast lost, and fractions it rounded.

    One scan for all columns. A value that is missing or a null token is no
    problem. Cells are judged where they stand and only problems leave their row,
    so what is shuffled grows with the problems, not with the cells.
    """
    cleaned = raw.select(*[clean_text(F.col(f"`{name}`"), tokens).alias(f"_t{i}") for i, name in enumerate(types)])
    numbered = cleaned.select("*", *[text_to_float(F.col(f"_t{i}")).alias(f"_x{i}") for i, kind in enumerate(types.values()) if kind in ("INTEGER", "FLOAT")])
    problems, cells = [], []
    for i, (name, kind) in enumerate(types.items()):
        text, number = F.col(f"_t{i}"), F.col(f"_x{i}")
        value = F.rint(number).try_cast("bigint") if kind == "INTEGER" else number if kind == "FLOAT" else cast_text(text, kind)
        problem = F.when(text.isNotNull() & value.isNull(), F.lit("failed"))
        if kind == "INTEGER":
            problem = problem.when(number != F.rint(number), F.lit("rounded"))
        problems.append(problem.alias(f"_p{i}"))
        cells.append(F.struct(F.lit(name).alias("column"), text.alias("raw_value"), F.col(f"_p{i}").alias("problem")))
    # Plain arrays and a filter behind: all of it is compiled, and sound cells end inside the task.
    judged = numbered.select("*", *problems).select(F.inline(F.array(*cells))).filter(F.col("problem").isNotNull())
    return judged.groupBy("column", "raw_value", "problem").agg(F.count(F.lit(1)).alias("n"))


def coerce_numeric(df: DataFrame, keep: Sequence[str] = ("borough_name",)) -> DataFrame:
    """Text columns whose every value reads as a number, cast to double.

    One aggregate over the text columns proves that the cast loses nothing.
    """
    texts = [c for c, kind in df.dtypes if kind == "string" and c not in keep]
    if not texts:
        return df
    lost = df.agg(*[
        F.count_if(F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast("double").isNull()).alias(c) for c in texts
    ]).first()
    return df.withColumns({c: F.col(f"`{c}`").cast("double") for c in texts if lost[c] == 0})
