"""Layer and table writers with dry runs."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardmetrics.functions.text import sanitise_name
from wardmetrics.operators.reshape import latest
from wardmetrics.sinks.published import marker_names, marker_text, put_marker, take_place

ORDER_NOTE = "Rows are not guaranteed to be in original order. Use ORDER BY _row_number to restore original row sequence."

# Spark type -> warehouse type name; every other type is STRING.
_LOGICAL = (
    ((T.ByteType, T.ShortType, T.IntegerType, T.LongType), "INTEGER"),
    ((T.FloatType, T.DoubleType, T.DecimalType), "FLOAT"),
    ((T.BooleanType,), "BOOLEAN"),
    ((T.TimestampType, T.TimestampNTZType), "TIMESTAMP"),
    ((T.DateType,), "DATE"),
    ((T.VariantType,), "JSON"),
)


def logical_type(data_type: T.DataType) -> str:
    return next((name for kinds, name in _LOGICAL if isinstance(data_type, kinds)), "STRING")


def logical_schema(df: DataFrame) -> list[tuple[str, str]]:
    """(column, warehouse type) pairs of a frame."""
    return [(f.name, logical_type(f.dataType)) for f in df.schema.fields]


@dataclass(frozen=True)
class WritePlan:
    """What a write would do; the result of a dry run."""

    target: str
    mode: str
    schema: tuple[tuple[str, str], ...]
    rows: int
    sample: tuple
    partition_by: str | None = None
    cluster_by: tuple[str, ...] = ()

    def describe(self) -> str:
        lines = [
            f"[DRY RUN] Would {self.mode} {self.rows} rows into {self.target}",
            f"[DRY RUN] Columns: {[name for name, _ in self.schema]}",
        ]
        if self.partition_by:
            lines.append(f"[DRY RUN] Partitioning by column: {self.partition_by}")
        if self.cluster_by:
            lines.append(f"[DRY RUN] Clustering by fields: {list(self.cluster_by)}")
        lines += [f"[DRY RUN] Sample: {row}" for row in self.sample]
        lines.append(f"[DRY RUN] table_id: {self.target}")
        return "\n".join(lines)


def sample_rows(df: DataFrame, n: int = 4) -> list:
    """First rows, in ``_row_number`` order where the frame has one (a bounded top-n)."""
    ordered = df.orderBy("_row_number") if "_row_number" in df.columns else df
    texts = [F.col(f"`{f.name}`").cast("string") if isinstance(f.dataType, T.VariantType) else F.col(f"`{f.name}`") for f in df.schema.fields]
    return ordered.select(*texts).limit(n).collect()


def plan_write(
    df: DataFrame, target: str, mode: str, sample: int = 4, partition_by: str | None = None, cluster_by: Sequence[str] = ()
) -> WritePlan:
    return WritePlan(
        target, mode, tuple(logical_schema(df)), df.count(), tuple(sample_rows(df, sample)), partition_by, tuple(cluster_by)
    )


def layer_path(root: str, layer: str, *names: str) -> str:
    return "/".join([root.rstrip("/"), layer, *[sanitise_name(n) for n in names]])


def write_layer(df: DataFrame, path: str, partition_by: str | None = None, cluster_by: Sequence[str] = (), dealt: bool = False) -> str:
    """Replace one layer table as Parquet, so types survive to the next layer; ``cluster_by`` sorts each file.

    ``dealt`` rows stay in the partitions they are in.

    The new table is written beside the old one and takes its place when it is
    whole: a job that dies while writing leaves the old table as it was, and a
    table may be rebuilt from its own rows.
    """
    path = path.rstrip("/")
    folder, name = path.rsplit("/", 1)
    staged = f"{folder}/_staged-{name}-{uuid.uuid4().hex}"
    if partition_by and partition_by in df.columns:
        placed = df.sortWithinPartitions(partition_by, *cluster_by) if dealt else spread(df, partition_by, cluster_by)
        placed.write.partitionBy(partition_by).parquet(staged)
    else:
        df.write.parquet(staged)
    take_place(df.sparkSession, staged, path)
    return path


def spread(df: DataFrame, partition_by: str, cluster_by: Sequence[str] = ()) -> DataFrame:
    """Rows of one partition value together, a large value split over several tasks."""
    gathered = df.hint("rebalance", partition_by)
    return gathered.sortWithinPartitions(partition_by, *cluster_by)


def load_table(
    spark: SparkSession, df: DataFrame, project: str, layer: str, table: str, dry_run: bool = True
) -> WritePlan | str:
    """Replace a catalog table ``layer.table``; a dry run only reports."""
    if dry_run:
        return plan_write(df, f"{project}.{layer}.{table}", "load")
    name = f"`{layer}`.`{sanitise_name(table).replace('.', '_').replace('-', '_')}`"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`")
    df.write.mode("overwrite").saveAsTable(name)
    if "_row_number" in df.columns:
        spark.sql(f"COMMENT ON TABLE {name} IS '{ORDER_NOTE}'")
    return name


def append_events(
    df: DataFrame,
    path: str,
    json_column: str | None = None,
    partition_by: str | None = None,
    cluster_by: str | Sequence[str] = (),
    dry_run: bool = True,
    batch: str | None = None,
) -> WritePlan | str:
    """Append to a partitioned, clustered Parquet table with a variant column.

    A JSON text column becomes a variant, the partition column a date. A named
    ``batch`` counts once: its rows lie in a folder of their own that counts from
    the moment its marker is there, and a rerun finds the marker and adds nothing.
    Read such a table with :func:`read_appended`.
    """
    clusters = [cluster_by] if isinstance(cluster_by, str) else list(cluster_by)
    typed = prepare_append(df, json_column, partition_by)
    if dry_run:
        return plan_write(typed, path, "append", 2, partition_by, clusters)
    if batch is not None and marker_text(df.sparkSession, path, batch) is not None:
        return path
    target, mode = (path, "append") if batch is None else (f"{path.rstrip('/')}/{_BATCH}={batch}", "overwrite")
    if partition_by:
        spread(typed, partition_by, clusters).write.mode(mode).partitionBy(partition_by).parquet(target)
    else:
        (typed.sortWithinPartitions(*clusters) if clusters else typed).write.mode(mode).parquet(target)
    if batch is not None:
        put_marker(df.sparkSession, path, batch, json.dumps(json.loads(typed.schema.json())))
    return path


_BATCH = "load_batch"


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the batches that were appended whole."""
    names = marker_names(spark, path)
    if not names:
        raise FileNotFoundError(f"{path}: no batch was appended")
    schema = T.StructType.fromJson(json.loads(marker_text(spark, path, names[-1])))
    base = path.rstrip("/")
    return spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/{_BATCH}={n}" for n in names])


def prepare_append(df: DataFrame, json_column: str | None, partition_by: str | None) -> DataFrame:
    changes: dict[str, Column] = {}
    if json_column and dict(df.dtypes)[json_column] == "string":
        changes[json_column] = F.parse_json(json_column)
    if partition_by and partition_by in df.columns:
        changes[partition_by] = F.col(partition_by).cast("date")
    return df.withColumns(changes) if changes else df


def export_name(project: str, layer: str, table: str, at: datetime | None = None) -> str:
    stamp = (at or datetime.now(timezone.utc)).strftime("%Y%m%d_%H%M%S")
    return f"{sanitise_name(project)}_{sanitise_name(layer)}_{sanitise_name(table)}_{stamp}"


def export_table(df: DataFrame, folder: str, project: str, layer: str, table: str, at: datetime | None = None) -> str:
    """Write a table as CSV with header under a time-stamped name."""
    path = f"{folder.rstrip('/')}/{export_name(project, layer, table, at)}"
    plain = df.select(*[
        F.col(f"`{f.name}`").cast("string").alias(f.name) if isinstance(f.dataType, T.VariantType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])
    plain.write.mode("errorifexists").option("header", True).csv(path)
    return path


def write_latest(df: DataFrame, path: str, column: str = "year") -> str | None:
    """Rows of the latest year beside the full table; None where there is no year."""
    if column not in df.columns:
        return None
    return write_layer(latest(df, column), path)
