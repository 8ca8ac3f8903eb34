"""Keyed upserts and the entity dimension."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardmetrics.functions.text import all_of
from wardmetrics.operators.reshape import first_by_key
from wardmetrics.session import written
from wardmetrics.sinks.published import marker_names, marker_text, put_marker


def one_per_key(incoming: DataFrame, keys: Sequence[str], newest_first: Sequence[Column | str] | None = None) -> DataFrame:
    """One incoming row of each key, by the given order or else the largest values of the other columns."""
    rest = [c for c in incoming.columns if c not in keys]
    if newest_first:
        return first_by_key(incoming, keys, newest_first)
    if not rest:
        return incoming.dropDuplicates(list(keys))
    largest = incoming.groupBy(*keys).agg(F.max(F.struct(*[F.col(f"`{c}`") for c in rest])).alias("_row"))
    return largest.select(*[F.col(f"`{c}`") if c in keys else F.col(f"_row.`{c}`").alias(c) for c in incoming.columns])


def upsert(
    target: DataFrame, incoming: DataFrame, keys: str | Sequence[str], newest_first: Sequence[Column | str] | None = None
) -> DataFrame:
    """Target rows with incoming rows put over them by key.

    ``newest_first`` orders incoming rows of one key; the first one wins. Without
    it the row with the largest values wins, column by column, nulls last. Columns
    only one side has are null on the other. Null keys are equal to each other.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    fresh = one_per_key(incoming, keys, newest_first)
    changed = fresh.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    same = all_of([F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    return target.join(changed, same, "left_anti").unionByName(fresh, allowMissingColumns=True)


# Buckets of a new serving table. A batch rewrites the buckets its keys fall into, and no others.
BUCKETS = 32


def _marker(version: int) -> str:
    return f"v{version:010d}"


def _bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return df.withColumn("_bucket", F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("int"))


def _like(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns the table has already, in its types, so that equal keys fall into one bucket."""
    kinds = {f.name: f.dataType for f in schema.fields}
    return df.select(*[F.col(f"`{c}`").cast(kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`") for c in df.columns])


def versions(spark: SparkSession, base: str) -> list[int]:
    """Published versions of a serving table, oldest first."""
    return [int(name[1:]) for name in marker_names(spark, base) if name.startswith("v")]


def _read_parts(spark: SparkSession, base: str, parts: Mapping[str, str], schema: T.StructType) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{base.rstrip('/')}/data/{stage}/_bucket={bucket}" for bucket, stage in parts.items()])


def read_version(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    """A published version of a serving table, the newest unless one is named."""
    known = versions(spark, base)
    if not known or (version is not None and version not in known):
        raise FileNotFoundError(f"{base}: no published version {'' if version is None else version}; there are {known}")
    told = json.loads(marker_text(spark, base, _marker(known[-1] if version is None else version)))
    return _read_parts(spark, base, told["parts"], T.StructType.fromJson(told["schema"]))


def version_note(spark: SparkSession, base: str) -> object:
    """The note published with the newest version; None where there is none."""
    known = versions(spark, base)
    return json.loads(marker_text(spark, base, _marker(known[-1]))).get("note") if known else None


def upsert_version(
    spark: SparkSession, base: str, incoming: DataFrame, keys: str | Sequence[str], version: int,
    newest_first: Sequence[Column | str] | None = None, buckets: int = BUCKETS,
    merge: Callable[[DataFrame, DataFrame], DataFrame] | None = None, note: object = None,
) -> str:
    """Publish version ``version`` of a serving table: the version before it with ``incoming`` over it. Returns ``base``.

    Rows lie in buckets by the hash of their keys. Only buckets with an incoming
    key are read and written anew; for the others the version names the files of
    earlier ones, so what is written follows the batch. A version counts once its
    marker is there: a job that dies leaves the older ones as they were, and a
    rerun of a published version changes nothing. ``merge`` puts incoming rows
    and old rows of their buckets together where replacing is not enough.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if marker_text(spark, base, _marker(version)) is not None:
        return base
    before = [v for v in versions(spark, base) if v < version]
    told = json.loads(marker_text(spark, base, _marker(before[-1]))) if before else {"parts": {}, "buckets": buckets, "schema": None}
    schema = T.StructType.fromJson(told["schema"]) if told["schema"] else T.StructType([])
    if merge is None:
        incoming = one_per_key(incoming, keys, newest_first)
    fresh = written(_bucket(_like(incoming, schema), keys, told["buckets"]), "upsert-batch")
    touched = {str(r[0]) for r in fresh.select("_bucket").distinct().collect()}  # at most as many as there are buckets
    if schema.fields:
        old = _read_parts(spark, base, {b: s for b, s in told["parts"].items() if b in touched}, schema)
        rows = fresh.drop("_bucket")
        merged = merge(old, rows) if merge else upsert(old, rows, keys)
        fresh = _bucket(merged, keys, told["buckets"])
    stage = f"{_marker(version)}-{uuid.uuid4().hex}"
    if touched:
        fresh.hint("rebalance", "_bucket").write.partitionBy("_bucket").parquet(f"{base.rstrip('/')}/data/{stage}")
    told = {
        "parts": {**told["parts"], **dict.fromkeys(sorted(touched, key=int), stage)}, "buckets": told["buckets"],
        "schema": json.loads(fresh.drop("_bucket").schema.json()), "note": note,
    }
    put_marker(spark, base, _marker(version), json.dumps(told))
    return base


def entity_dimension(
    sources: Sequence[tuple[DataFrame, str, str]], key: str = "ons_code", name: str = "name", skip_null_names: bool = False
) -> DataFrame:
    """One row per key from (frame, key column, name column) sources in priority order.

    The first source holding a key decides, and keys or names that come out null
    are dropped: a null name in an earlier source hides a good one in a later,
    unless ``skip_null_names``. Within a source the smallest name wins, nulls
    first, so that the pick does not depend on row order.
    """
    parts = [
        frame.select(
            F.col(k).cast("string").alias(key), F.col(n).cast("string").alias(name), F.lit(rank).alias("_rank")
        )
        for rank, (frame, k, n) in enumerate(sources)
    ]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    if skip_null_names:
        stacked = stacked.dropna(subset=[name])
    first = first_by_key(stacked, key, ["_rank", F.col(name).isNotNull(), name])
    return first.select(key, name).dropna()
