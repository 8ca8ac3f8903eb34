"""Layer tables and the missing-source guard."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from wardmetrics.sources.raw import path_exists


def read_layer(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table by name, or a Parquet folder by path."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def source_exists(spark: SparkSession, name_or_path: str) -> bool:
    if "/" in name_or_path:
        return path_exists(spark, name_or_path)
    return spark.catalog.tableExists(name_or_path)


def read_present(spark: SparkSession, sources: Mapping[str, str]) -> tuple[dict[str, DataFrame], list[str]]:
    """Frames of the sources that exist, and the names of those that do not."""
    present: dict[str, DataFrame] = {}
    missing: list[str] = []
    for name, location in sources.items():
        if source_exists(spark, location):
            present[name] = read_layer(spark, location)
        else:
            missing.append(name)
    return present, missing


def missing_inputs(required: Sequence[str], present: Mapping[str, DataFrame]) -> list[str]:
    return [name for name in required if name not in present]
