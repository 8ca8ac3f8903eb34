"""Keyed merges with the null and collision rules of the metric tables.

No side is broadcast by hint: adaptive execution broadcasts a side it has
measured as small, and splits the hot keys of a sort-merge join otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmetrics.functions.text import all_of, standard_key

RIGHT = "_right_{}"


def _mark_right(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(RIGHT.format(c)) for c in df.columns])


def _right(name: str) -> Column:
    return F.col(f"`{RIGHT.format(name)}`")


def merge(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    suffixes: tuple[str, str] = ("_x", "_y"),
    null_keys_match: bool = True,
) -> DataFrame:
    """Join on equally named keys; other shared names get the suffixes.

    Null keys match each other unless ``null_keys_match`` is off.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if how not in ("left", "inner", "right", "outer"):
        raise ValueError(f"how={how!r}")
    shared = (set(left.columns) & set(right.columns)) - set(keys)
    marked = _mark_right(right)

    def same(key: str) -> Column:
        mine = F.col(f"`{key}`")
        return mine.eqNullSafe(_right(key)) if null_keys_match else mine == _right(key)

    joined = left.join(marked, all_of([same(k) for k in keys]), how)

    def key_value(key: str) -> Column:
        mine = F.col(f"`{key}`")
        if how in ("left", "inner"):
            return mine
        return _right(key).alias(key) if how == "right" else F.coalesce(mine, _right(key)).alias(key)

    out = []
    for name in left.columns:
        if name in keys:
            out.append(key_value(name).alias(name))
        else:
            out.append(F.col(f"`{name}`").alias(name + suffixes[0] if name in shared else name))
    for name in right.columns:
        if name not in keys:
            out.append(_right(name).alias(name + suffixes[1] if name in shared else name))
    return joined.select(*out)


def merge_chain(
    tables: Mapping[str, DataFrame],
    on: str | Sequence[str] = ("ons_code", "year"),
    how: str = "left",
    null_keys_match: bool = True,
) -> DataFrame:
    """Join tables left to right; a name already taken gets ``_{table}``."""
    names = list(tables)
    return reduce(
        lambda result, name: merge(result, tables[name], on, how, ("", f"_{name}"), null_keys_match),
        names[1:],
        tables[names[0]],
    )


def grain_merge(base: DataFrame, other: DataFrame, mapping: Mapping[str, str], how: str = "left") -> DataFrame:
    """Join metrics onto the grain table on standardised keys.

    ``mapping`` is base column -> metric column. Names agree up to case, outer
    blanks and ``and``/``&``; numbers agree across integer and decimal types;
    nulls agree with nulls. The metric side's key columns are dropped.
    """
    if how not in ("left", "inner", "right", "outer"):
        raise ValueError(f"how={how!r}")
    base_types, other_types = dict(base.dtypes), dict(other.dtypes)
    for mine, theirs in mapping.items():
        if mine not in base_types or theirs not in other_types:
            raise KeyError(f"join column missing: {mine!r} in the grain or {theirs!r} in the metrics")
    metric_keys = list(mapping.values())
    rest = [c for c in other.columns if c not in metric_keys]
    shared = set(base.columns) & set(rest)
    marked = _mark_right(other)
    condition = all_of([
        standard_key(F.col(f"`{mine}`"), base_types[mine]).eqNullSafe(standard_key(_right(theirs), other_types[theirs]))
        for mine, theirs in mapping.items()
    ])
    out = [F.col(f"`{c}`").alias(f"{c}_x" if c in shared else c) for c in base.columns]
    out += [_right(c).alias(f"{c}_y" if c in shared else c) for c in rest]
    return base.join(marked, condition, how).select(*out)


def merge_yearly(tables: Mapping[str, DataFrame], year_sources: Mapping[str, str] | None = None, **kwargs) -> DataFrame:
    """:func:`merge_chain` after each table got its integer ``year``."""
    from wardmetrics.operators.reshape import ensure_year

    sources = year_sources or {}
    return merge_chain({name: ensure_year(df, sources.get(name)) for name, df in tables.items()}, **kwargs)
