"""Month calendar, pending work, processed-keys state and the event file loads."""

from __future__ import annotations

import hashlib
import logging
from collections.abc import Iterator
from datetime import date

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wardmetrics.operators.reshape import union_all
from wardmetrics.session import written
from wardmetrics.sinks.published import marker_names, put_marker
from wardmetrics.sinks.writers import spread
from wardmetrics.sources.events import WHOLE_FILE_BYTES, array_objects, entity_from_file, folder_number
from wardmetrics.sources.raw import path_exists

log = logging.getLogger(__name__)

REPORT_LAG_MONTHS = 2

FILE_FIELDS = "value string, year int, month int"


def month_calendar(spans: DataFrame, start: str = "start", as_of: str = "as_of", lag: int = REPORT_LAG_MONTHS) -> DataFrame:
    """Months (``yyyy-MM``) from ``start`` to ``as_of`` less the lag; none where start is later.

    ``spans`` holds date columns; the other columns are kept on every month.
    """
    first = F.trunc(F.col(start), "MM")
    last = F.trunc(F.add_months(F.col(as_of), -lag), "MM")
    months = F.when(first <= last, F.sequence(first, last, F.expr("interval 1 month")))
    rest = [c for c in spans.columns if c not in (start, as_of)]
    return spans.select(*rest, F.explode(months).alias("_month")).select(*rest, F.date_format("_month", "yyyy-MM").alias("month"))


def calendar_between(spark: SparkSession, start: date, as_of: date, lag: int = REPORT_LAG_MONTHS) -> DataFrame:
    """:func:`month_calendar` of one span."""
    span = spark.createDataFrame([(start, as_of)], "start date, as_of date")
    return month_calendar(span, lag=lag)


def batch_signature(entity: Column, month: Column) -> Column:
    return F.concat(entity, F.lit("_"), month)


def pending_batches(
    entities: DataFrame, processed: DataFrame, start: date, as_of: date, entity: str = "borough", lag: int = REPORT_LAG_MONTHS
) -> DataFrame:
    """Entity-month batches not processed yet.

    Each entity row is exploded by its own months; no cross join is planned.
    """
    spans = entities.select(entity).distinct().withColumns({"start": F.lit(start), "as_of": F.lit(as_of)})
    wanted = month_calendar(spans, lag=lag)
    signed = wanted.withColumn("signature", batch_signature(F.col(entity), F.col("month")))
    return signed.join(processed.select("signature").distinct(), "signature", "left_anti").select(entity, "month", "signature")


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """Processed keys; an absent state reads as empty."""
    if path_exists(spark, path):
        return spark.read.schema("signature string").parquet(path)
    return spark.createDataFrame([], "signature string")


def append_state(keys: DataFrame, path: str) -> None:
    """Record keys as processed. Call it only after their data is written."""
    keys.select("signature").distinct().write.mode("append").parquet(path)


def list_payload_files(spark: SparkSession, root: str) -> DataFrame:
    """Path, length, month and signature of the event files below ``root``; no file is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(root)
    return files.select(
        "path", "length", F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month"), _signature(F.col("_metadata.file_path")).alias("signature")
    )


def read_payload_files(spark: SparkSession, root: str, paths: list[str]) -> DataFrame:
    """The named event files whole, with ``year``/``month`` from the folders and the path below ``root``."""
    files = spark.read.schema(FILE_FIELDS).option("wholetext", True).option("basePath", root).text(paths)
    return _with_signature(files)


def _signature(path: Column) -> Column:
    return F.regexp_extract(path, r"(year=[^/]+/month=[^/]+/[^/]+)$", 1)


def _with_signature(files: DataFrame) -> DataFrame:
    path = F.col("_metadata.file_path")
    return files.select(
        "value", "year", "month", path.alias("path"),
        _signature(path).alias("signature"),
    )


def _lacks_id(record: Column) -> Column:
    """Whether a record is no object with an ``id``; an id of null is one."""
    return F.try_variant_get(record, "$.id", "variant").isNull()


def parse_payload(files: DataFrame, entity: str = "borough") -> DataFrame:
    """One row per file with its records as an array of variants; null where it is no JSON array of records with an ``id``."""
    parsed = files.select(F.from_json("value", "array<variant>").alias("_all"), "year", "month", "signature", entity_from_file(F.col("path")).alias(entity))
    return parsed.select(F.when(~F.exists("_all", _lacks_id), F.col("_all")).alias("_records"), "year", "month", "signature", entity)


def explode_records(parsed: DataFrame, entity: str = "borough", payload: str = "crime_details") -> DataFrame:
    """Records with id, month's first day, entity and the payload kept whole."""
    return parsed.select(entity, "year", "month", F.explode("_records").alias(payload)).select(
        F.variant_get(payload, "$.id", "string").alias("crime_id"),
        F.make_date("year", "month", F.lit(1)).alias("crime_date"),
        entity,
        payload,
    )


def _write_batch(records: DataFrame, table: str, batch: str, entity: str) -> None:
    """Overwrite one batch's own folder, so that a repeated batch adds nothing twice."""
    target = f"{table.rstrip('/')}/load_batch={batch}"
    spread(records, "crime_date", [entity]).write.mode("overwrite").partitionBy("crime_date").parquet(target)


FATES = "signature string, fate string, records int, batch string"

# Files of one batch. Larger months load in several batches; the driver holds the paths of one.
FILES_PER_BATCH = 5000


def _batches(pending: DataFrame) -> Iterator[tuple[str, list]]:
    """Named batches of pending files, month by month in order; a name follows from the files in the batch."""
    held: list = []

    def named():
        signatures = "|".join(r["signature"] for r in held)
        return f"{held[0]['year']:04d}-{held[0]['month']:02d}-{hashlib.sha1(signatures.encode(), usedforsecurity=False).hexdigest()[:12]}", held

    for row in pending.orderBy("year", "month", "signature").toLocalIterator():
        if held and (len(held) == FILES_PER_BATCH or (row["year"], row["month"]) != (held[0]["year"], held[0]["month"])):
            yield named()
            held = []
        held.append(row)
    if held:
        yield named()


def _log_of(table: str) -> str:
    return f"{table.rstrip('/')}_log"


def published_batches(spark: SparkSession, table: str) -> list[str]:
    """Batches of an event table that count; what else lies in its folder was staged by a job that died."""
    return marker_names(spark, table)


def _published_log(spark: SparkSession, table: str) -> DataFrame:
    names = published_batches(spark, table)
    return spark.read.schema(FATES).parquet(*[f"{_log_of(table)}/load_batch={n}" for n in names]) if names else spark.createDataFrame([], FATES)


def load_new_files(
    spark: SparkSession, root: str, table: str, state: str, dry_run: bool = True, entity: str = "borough", whole_bytes: int = WHOLE_FILE_BYTES,
) -> DataFrame:
    """Load files not loaded yet, month by month in order; returns this run's files, their fate and batch.

    Only the listing covers all files; a run opens those that are pending: in
    neither the state nor the log of a published batch. A batch's rows and log
    are staged in folders of its own, and one marker then publishes both: a job
    that dies in between leaves nothing that readers see, and its files stay
    pending. The state follows the marker. ``failed`` files hold no JSON array of
    records with an ``id``, or belong to a batch that could not be loaded; they
    stay pending, and later ones go on. Files over ``whole_bytes`` are read in
    ranges by many tasks.
    """
    done = read_state(spark, state).unionByName(_published_log(spark, table).filter("fate = 'loaded'").select("signature"))
    pending = written(list_payload_files(spark, root).join(done, "signature", "left_anti"), "pending-files")
    fates = spark.createDataFrame([], FATES)
    for name, files in _batches(pending):
        try:
            fates = fates.unionByName(_load_batch(spark, root, files, table, state, name, dry_run, entity, whole_bytes))
        except PySparkException as error:
            log.warning("batch %s stays pending: %s", name, error)
            fates = fates.unionByName(spark.createDataFrame([(f["signature"], "failed", 0, name) for f in files], FATES))
    return fates


def _large_files(spark: SparkSession, paths: list[str], entity: str) -> tuple[DataFrame, DataFrame]:
    """Records and fates of array files that are read in ranges."""
    path = F.col("_source_path")
    objects = array_objects(spark, paths).select(
        _signature(path).alias("signature"), folder_number(path, "year").alias("year"), folder_number(path, "month").alias("month"),
        entity_from_file(path).alias(entity), F.try_parse_json("record").alias("payload"), "fate",
    )
    objects = written(objects.withColumn("fate", F.when((F.col("fate") == "record") & _lacks_id(F.col("payload")), F.lit("bad")).otherwise(F.col("fate"))), "parsed-objects")
    sound = (F.count_if(F.col("fate") == "bad") == 0) & (F.count_if(F.col("fate") == "end") == 1)
    fate = objects.groupBy("signature").agg(F.when(sound, F.lit("loaded")).otherwise(F.lit("failed")).alias("fate"), F.count_if(F.col("fate") == "record").cast("int").alias("records"))
    fate = fate.withColumn("records", F.when(F.col("fate") == "loaded", F.col("records")).otherwise(F.lit(0)))
    kept = objects.filter("fate = 'record'").join(fate.filter("fate = 'loaded'").select("signature"), "signature", "left_semi")
    return kept, fate


def _as_records(parsed: DataFrame, entity: str, payload: str = "crime_details") -> DataFrame:
    return parsed.select(
        F.variant_get("payload", "$.id", "string").alias("crime_id"), F.make_date("year", "month", F.lit(1)).alias("crime_date"), entity, F.col("payload").alias(payload))


def _load_batch(spark: SparkSession, root: str, files: list, table: str, state: str, name: str, dry_run: bool, entity: str, whole_bytes: int) -> DataFrame:
    large = [f["path"] for f in files if f["length"] > whole_bytes]
    small = [f["path"] for f in files if f["length"] <= whole_bytes]
    parts = []
    if small:
        # Parsed once: fates and records are both read from what is written here.
        parsed = written(parse_payload(read_payload_files(spark, root, small), entity), "parsed-files")
        fate = parsed.select(
            "signature", F.when(F.col("_records").isNull(), F.lit("failed")).otherwise(F.lit("loaded")).alias("fate"), F.coalesce(F.size("_records"), F.lit(0)).alias("records"))
        parts.append((explode_records(parsed, entity), fate))
    if large:
        kept, fate = _large_files(spark, large, entity)
        parts.append((_as_records(kept, entity), fate))
    records, fates = (union_all([p[i] for p in parts]) for i in (0, 1))
    fates = fates.withColumn("batch", F.lit(name))
    if dry_run:
        return fates
    _write_batch(records, table, name, entity)
    staged = f"{_log_of(table)}/load_batch={name}"
    fates.write.mode("overwrite").parquet(staged)
    put_marker(spark, table, name, "")
    settled = spark.read.schema(FATES).parquet(staged)
    append_state(settled.filter("fate = 'loaded'"), state)
    return settled


def _event_rows(entity: str) -> str:
    return f"crime_id string, {entity} string, crime_details variant, crime_date date"


def read_batch(spark: SparkSession, table: str, batch: str, entity: str = "borough") -> DataFrame:
    """The rows of one batch; none where all its files were empty or failed."""
    return spark.read.schema(_event_rows(entity)).parquet(f"{table.rstrip('/')}/load_batch={batch}")


def read_events_table(spark: SparkSession, table: str, entity: str = "borough") -> DataFrame:
    """All rows of the published batches."""
    names, base = published_batches(spark, table), table.rstrip("/")
    if not names:
        return spark.createDataFrame([], _event_rows(entity))
    return spark.read.schema(_event_rows(entity)).option("basePath", base).parquet(*[f"{base}/load_batch={n}" for n in names])


def stream_new_files(
    spark: SparkSession, root: str, table: str, checkpoint: str, entity: str = "borough", max_files: int | None = None
) -> StreamingQuery:
    """The same load as a file stream: each run takes the files new since the last.

    The checkpoint holds which files are done. A batch overwrites its own folder,
    so a batch repeated after a failure leaves each record once. Files that are
    no JSON array are listed under ``{table}_failed``.
    """
    reader = (
        spark.readStream.format("text")
        .schema(FILE_FIELDS)
        .option("wholetext", True)
        .option("pathGlobFilter", "*.json")
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    parsed = parse_payload(_with_signature(reader.load(root)), entity)

    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = written(batch, "parsed-batch")  # read and parsed once for both writes
        _write_batch(explode_records(parsed, entity), table, str(batch_id), entity)
        put_marker(spark, table, str(batch_id), "")
        failed = parsed.filter(F.col("_records").isNull()).select("signature")
        failed.write.mode("overwrite").parquet(f"{table.rstrip('/')}_failed/load_batch={batch_id}")

    return (
        parsed.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
