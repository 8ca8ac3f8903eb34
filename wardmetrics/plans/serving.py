"""Serving tables: the entity dimension, keyed upserts and their checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmetrics.operators.quality import apply_defaults, rule_counts
from wardmetrics.operators.reshape import union_all
from wardmetrics.plans.domains import SERVING_TABLES
from wardmetrics.session import written
from wardmetrics.sinks.upsert import entity_dimension, read_version, upsert_version


def constraint_report(
    df: DataFrame, table: str, dimension: DataFrame | None = None, tables: Mapping[str, Mapping] = SERVING_TABLES
) -> DataFrame:
    """(table, rule, subject, n) rows for every violated constraint of a serving table; the table is read once."""
    spec = tables[table]
    keys = list(spec["keys"])
    required = list(dict.fromkeys([*keys, *spec.get("required", [])]))
    # Stored: what is left are violations, and the distinct foreign keys.
    counts = written(rule_counts(df, keys, required, keys[0] if dimension is not None else None), "rule-counts")
    key_text = F.concat_ws("|", *[F.col(f"`{k}`").cast("string") for k in keys])
    subject = F.when(F.col("rule") == "not_null", F.col("column")).otherwise(key_text)
    found = counts.filter("rule <> 'foreign_key'")
    if dimension is not None:
        held = counts.filter("rule = 'foreign_key'")
        known = dimension.select(F.col(keys[0]).alias("_known")).distinct()
        found = found.unionByName(held.join(known, held[keys[0]] == known["_known"], "left_anti"))
    return found.select(F.lit(table).alias("table"), "rule", subject.alias("subject"), "n")


def sync_serving(
    spark: SparkSession,
    root: str,
    version: int,
    frames: Mapping[str, DataFrame],
    name_sources: Sequence[tuple[DataFrame, str, str]],
    newest_first: Mapping[str, Sequence[Column | str]] | None = None,
    tables: Mapping[str, Mapping] = SERVING_TABLES,
) -> tuple[dict[str, str], DataFrame]:
    """Upsert the dimension, then each table; returns the tables' folders, for ``read_version``, and all violations."""
    order = newest_first or {}
    paths = {
        "boroughs": upsert_version(spark, f"{root}/boroughs", entity_dimension(name_sources), "ons_code", version)
    }
    dimension = read_version(spark, paths["boroughs"], version)
    reports = [constraint_report(dimension, "boroughs", tables=tables)]
    for table, frame in frames.items():
        spec = tables[table]
        filled = apply_defaults(frame, spec.get("defaults", {}))
        paths[table] = upsert_version(spark, f"{root}/{table}", filled, spec["keys"], version, order.get(table))
        reports.append(constraint_report(read_version(spark, paths[table], version), table, dimension, tables))
    return paths, union_all(reports)
