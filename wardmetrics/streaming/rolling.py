"""Yearly totals that new batches are added to, without the events of old ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmetrics.functions.numbers import annualised
from wardmetrics.sinks.upsert import read_version, upsert_version, version_note, versions


def month_states(events: DataFrame, entity: str = "borough", category: str = "category", year: str = "year", month: str = "month") -> DataFrame:
    """``total_count`` and ``months`` (a bit for each month with a row) by year, entity and category.

    Two states of one key add up: counts as a sum, months as a union. Null
    categories are not counted, as in the monthly counts.
    """
    known = events.filter(F.col(f"`{category}`").isNotNull())
    bit = F.call_function("shiftleft", F.lit(1), F.col(f"`{month}`").cast("int") - 1)
    return known.groupBy(*[F.col(f"`{c}`") for c in (year, entity, category)]).agg(F.count(F.lit(1)).alias("total_count"), F.bit_or(bit).alias("months"))


def _added(old: DataFrame, new: DataFrame) -> DataFrame:
    keys = [c for c in new.columns if c not in ("total_count", "months")]
    return old.unionByName(new).groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.sum("total_count").alias("total_count"), F.bit_or("months").alias("months"))


def add_batch(spark: SparkSession, base: str, events: DataFrame, batch: str, entity: str = "borough", category: str = "category") -> bool:
    """Add the events of one load batch to the totals at ``base``; False where they are in already.

    The totals are a versioned table whose versions name the batches in them, so
    a batch counts once however often it is handed in, and a job that dies leaves
    the totals as they were. Only buckets with a key of the batch are rewritten.
    """
    counted = version_note(spark, base) or []
    if batch in counted:
        return False
    known = versions(spark, base)
    upsert_version(spark, base, month_states(events, entity, category), ["year", entity, category], known[-1] + 1 if known else 1, merge=_added, note=[*counted, batch])
    return True


def rolling_rates(spark: SparkSession, base: str) -> DataFrame:
    """The totals with ``months_present`` and the rate per twelve months, as the annual roll-up of all events has them."""
    state = read_version(spark, base)
    shown = state.withColumn("months_present", F.bit_count("months").cast("bigint")).drop("months")
    return shown.withColumn("annualised_rate", annualised(F.col("total_count"), F.col("months_present")))
