"""Query registry, and one output shape shared by a query and its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wardmetrics.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# Shape codes: text, 32-bit, 64-bit, date, timestamp, flag; d2, d4, d6 doubles by decimals.
_TYPES = {
    "s": ("string", "VARCHAR"),
    "i": ("int", "INTEGER"),
    "l": ("bigint", "BIGINT"),
    "t": ("date", "DATE"),
    "ts": ("timestamp_ntz", "TIMESTAMP"),
    "b": ("boolean", "BOOLEAN"),
}


def _columns(shape: str) -> list[tuple[str, str]]:
    return [tuple(item.rsplit(":", 1)) for item in shape.split()]


def shaped(df: DataFrame, shape: str) -> DataFrame:
    """Named columns in order, cast; doubles rounded so that sum order cannot show."""
    out = []
    for name, code in _columns(shape):
        if code[0] == "d":
            out.append(f"round(cast(`{name}` as double), {code[1:]}) + 0.0D as `{name}`")
        else:
            out.append(f"cast(`{name}` as {_TYPES[code][0]}) as `{name}`")
    return df.selectExpr(*out)


def shaped_sql(body: str, shape: str) -> str:
    """The same shape over the relation ``q`` that ``body`` (a WITH list) ends in."""
    out = []
    for name, code in _columns(shape):
        if code[0] == "d":
            out.append(f'round(CAST("{name}" AS DOUBLE), {code[1:]}) + 0.0 AS "{name}"')
        else:
            out.append(f'CAST("{name}" AS {_TYPES[code][1]}) AS "{name}"')
    return f"WITH {body.strip()} SELECT {', '.join(out)} FROM q"


def query(shape: str, sql: str | None = None, name: str | None = None):
    """Register a ``(spark, folder) -> DataFrame`` function under its name."""

    def add(function: Callable[[SparkSession, str], DataFrame]):
        key = name or function.__name__

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return shaped(function(tune(spark), folder), shape)

        run.__name__, run.__doc__ = key, function.__doc__
        QUERIES[key] = run
        if sql is not None:
            SQL[key] = shaped_sql(sql, shape)
        return function

    return add
