"""Partitioned JSON event files: ``root/year=YYYY/month=MM/<entity>.json``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmetrics.session import written
from wardmetrics.sources.ranges import ArrayRecords, range_records

EVENT_FIELDS = "id string, category string"

# Array files up to this size are parsed whole, larger ones in byte ranges by many tasks. Both give the same records.
WHOLE_FILE_BYTES = 32 << 20


def entity_from_file(file_name: Column) -> Column:
    """File stem, URL decoding undone: ``Barking%20&%20Dagenham.json`` -> ``Barking & Dagenham``."""
    # A literal plus sign is legal in a file name but a blank to url_decode.
    encoded = F.replace(file_name, F.lit("+"), F.lit("%2B"))
    return F.url_decode(F.regexp_extract(encoded, r"([^/]+)\.json[l]?$", 1))


def folder_number(path: Column, name: str) -> Column:
    """``year`` or ``month`` of a file's folder as a number."""
    return F.regexp_extract(path, f"/{name}=([0-9]+)/", 1).try_cast("int")


def array_objects(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``_source_path``, ``record`` (one object's text) of array files read in ranges, and ``fate`` of the row.

    ``fate`` is ``record``, ``end`` for the one closing of a sound file, or
    ``bad`` for what cannot be in an array of objects: a wrong separator, an
    object that does not parse, text behind the end. A file is sound if it has an
    ``end`` and nothing ``bad``.
    """
    found = range_records(spark, paths, ArrayRecords)
    first = F.col("_row") == 0
    text = F.col("value")
    # The reader adds a brace behind the last piece; where the file itself ended in one, sizes agree.
    closed = F.col("_read") == F.col("_size") + 1
    is_end = closed & F.when(first, text.rlike(r"^\s*\[\s*\]\s*\}$")).otherwise(text.rlike(r"^\s*\]\s*\}$"))
    opened = F.when(first, text.rlike(r"^\s*\[\s*\{")).otherwise(text.rlike(r"^\s*,\s*\{"))
    record = F.when(opened, F.regexp_replace(text, r"^\s*[\[,]\s*", ""))
    fate = F.when(is_end, F.lit("end")).when(F.try_parse_json(record).isNotNull(), F.lit("record")).otherwise(F.lit("bad"))
    return found.select("_source_path", record.alias("record"), fate.alias("fate"))


def sound_files(objects: DataFrame) -> DataFrame:
    """``_source_path``, ``sound`` of each file of :func:`array_objects`."""
    return objects.groupBy("_source_path").agg(((F.count_if(F.col("fate") == "bad") == 0) & (F.count_if(F.col("fate") == "end") == 1)).alias("sound"))


def scan_events(
    spark: SparkSession, root: str, fields: str = EVENT_FIELDS, multi_line: bool = True, entity: str = "borough",
    whole_bytes: int = WHOLE_FILE_BYTES,
) -> DataFrame:
    """Event fields with ``year`` and ``month`` from the folders and the entity from the file name.

    Only the named fields are parsed. An empty file yields no rows. Files of one
    record per line (``multi_line=False``) split across tasks, and so do array
    files over ``whole_bytes``: their records are found by ranges. A file that is
    no array of objects gives one row without fields.
    """
    reader = spark.read.schema(f"{fields}, year int, month int").option("multiLine", multi_line)
    name = entity_from_file(F.col("_metadata.file_name"))
    if not multi_line:
        return reader.json(root).withColumn(entity, name)
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.json*").load(root)
    large = [r[0] for r in listed.filter(F.col("length") > whole_bytes).select("path").collect()]  # each is over whole_bytes, so few
    small = reader.json(root).filter(F.col("_metadata.file_size") <= whole_bytes).withColumn(entity, name)
    if not large:
        return small
    objects = written(array_objects(spark, large), "event-objects")
    kept = objects.join(sound_files(objects), "_source_path").filter((F.col("sound") & (F.col("fate") == "record")))
    broken = sound_files(objects).filter(~F.col("sound")).select("_source_path", F.lit(None).cast("string").alias("record"))
    path = F.col("_source_path")
    rows = kept.select("_source_path", "record").unionByName(broken)
    parsed = rows.select(F.from_json("record", fields).alias("_e"), folder_number(path, "year").alias("year"), folder_number(path, "month").alias("month"), entity_from_file(path).alias(entity))
    return small.unionByName(parsed.select("_e.*", "year", "month", entity))
