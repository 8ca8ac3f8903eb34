"""Headerless text grids: every cell a string, plus audit columns."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardmetrics.functions.cast import LOGICAL_TYPES, NULL_TOKENS, READER_NULL_TOKENS, cast_columns
from wardmetrics.sources.ranges import CellRecords, range_records

AUDIT_COLUMNS = ("_source_file", "_sheet_name", "_ingested_at", "_row_number")
NO_SHEET = "na"

# The year label travels under this name so that no filter can drop or rename it.
_YEAR_LABEL = "_year_label"


@dataclass(frozen=True)
class RawSource:
    """One raw file, or one sheet exported as a file; a folder or pattern counts as many files."""

    path: str
    table: str
    year: str | None = None
    sheet: str | None = None


@dataclass(frozen=True)
class Field:
    """Position, name and logical type of one column of a typed extract."""

    position: int
    name: str
    type: str = "STRING"

    def __post_init__(self) -> None:
        if self.type not in LOGICAL_TYPES:
            raise ValueError(f"{self.name}: unknown type {self.type!r}; use one of {sorted(LOGICAL_TYPES)}")


@dataclass(frozen=True)
class Layout:
    """Record range ``[start, end)`` and fields of one typed extract; without an end all records from ``start`` on.

    Records are counted in the written raw file, whose record 0 is its header,
    so record ``start`` is raw row ``start - 1``.
    """

    table: str
    start: int
    end: int | None
    fields: tuple[Field, ...]
    filters: tuple[Callable[[DataFrame], DataFrame], ...] = ()

    def __post_init__(self) -> None:
        if self.end is not None and self.start >= self.end:
            raise ValueError(f"{self.table}: empty record range [{self.start}, {self.end})")
        names = [f.name for f in self.fields]
        if len(names) != len(set(names)):
            raise ValueError(f"{self.table}: duplicate field names")


def layout(table: str, start: int, end: int | None, fields: Sequence[tuple], filters: Sequence[Callable] = ()) -> Layout:
    return Layout(table, start, end, tuple(Field(*f) for f in fields), tuple(filters))


@dataclass
class IngestReport:
    """What was read and what was skipped, and why."""

    loaded: list[tuple] = field(default_factory=list)
    skipped: list[tuple] = field(default_factory=list)


def _hadoop_path(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    jpath, fs = _hadoop_path(spark, path)
    found = fs.globStatus(jpath)
    return found is not None and len(found) > 0


def file_uris(spark: SparkSession, path: str) -> list[str]:
    """Files of a source (a file, folder or pattern), as ``_metadata.file_path`` spells them."""
    return [re.sub("^file:/+", "file:/", name) for name in spark.read.text(path).inputFiles()]


# A cell that begins with a quote, to its closing one. Quotes inside an unquoted cell are text.
_QUOTED_CELL = r'(^|,)"[^"]*+(?:""[^"]*+)*+'

_CELL_OPTIONS = {"header": "false", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}


def _separators(record: Column) -> Column:
    """Separators of a record outside its quoted cells."""

    def commas(text: Column) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit(","), F.lit("")))

    return F.when(F.contains(record, F.lit('"')), commas(F.regexp_replace(record, _QUOTED_CELL, "$1"))).otherwise(commas(record))


def scan_records(spark: SparkSession, paths: Sequence[str], multi_line: bool = False) -> DataFrame:
    """``_record`` (text), ``_source_path`` and 0-based ``_row_number`` of every record that is not blank.

    A record is a line, or with ``multi_line`` a line whose quoted cells may hold
    line breaks; then lines end in ``\\n`` or ``\\r\\n``, and breaks inside cells
    stay as they are. Either way a file is read by as many tasks as it has splits.
    """
    if multi_line:
        found = range_records(spark, paths, CellRecords)
        return found.select(F.regexp_replace("value", r"\r$", "").alias("_record"), "_source_path", F.col("_row").alias("_row_number"))
    return number_rows(spark.read.text(list(paths)).filter(F.col("value").rlike(r"[^\x00-\x20]"))).withColumnRenamed("value", "_record")


def grid_width(spark: SparkSession, paths: Sequence[str], multi_line: bool = False) -> int:
    """Width of the widest record over all files: one aggregate over the text; a single number reaches the driver."""
    if multi_line:
        records = range_records(spark, paths, CellRecords)
    else:
        records = spark.read.text(list(paths))
    found = records.agg(F.max(_separators(F.col("value")))).first()[0]
    return int(found or 0) + 1


def _within_width(records: DataFrame, width: int) -> DataFrame:
    """A wider record ends the job. A filter, which no column choice removes, over the text, so that empty cells count too."""
    told = F.raise_error(F.concat(F.lit(f"a record is wider than {width} cells: "), F.col("_source_path"), F.lit(", record "), F.col("_row_number"))).cast("boolean")
    return records.filter(F.when(_separators(F.col("_record")) < width, F.lit(True)).otherwise(told))


def _cells(records: DataFrame, width: int) -> DataFrame:
    schema = ", ".join(f"col_{i} string" for i in range(width))
    split = records.select("_source_path", "_row_number", F.from_csv("_record", schema, _CELL_OPTIONS).alias("_cells"))
    return split.select(*[F.col(f"_cells.col_{i}") for i in range(width)], "_source_path", "_row_number")


def number_rows(grid: DataFrame) -> DataFrame:
    """Add ``_source_path`` and the 0-based ``_row_number`` of each row in its file.

    ``grid`` must be a file scan, filtered at most. Rows keep their scan order
    inside a file split, so a row's number is its place in the split plus the rows
    of the file's earlier splits. Only the split counts are shuffled (one record
    per split), never the rows, and no file is gathered into one task. Where two
    scans of one job split a file differently the job ends; it can be run again.
    """
    data = list(grid.columns)
    scan = grid.select(
        *data,
        F.col("_metadata.file_path").alias("_source_path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_scan_id"),
    )
    blocks = scan.groupBy("_source_path", "_block").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_scan_id").alias("_first")
    )
    before = Window.partitionBy("_source_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        "_source_path", "_block", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift")
    )
    told = F.raise_error(F.lit("the splits of a file changed between two scans; run the job again")).cast("bigint")
    return scan.join(offsets, ["_source_path", "_block"], "left").select(
        *data, "_source_path", (F.col("_scan_id") + F.coalesce("_shift", told)).alias("_row_number")
    )


def with_audit(
    df: DataFrame,
    source_file: object,
    sheet: object = None,
    ingested_at: datetime | None = None,
    existing: bool = False,
) -> DataFrame:
    """Audit columns. The day of ingestion is fixed once, at UTC midnight.

    With ``existing`` the audit columns are overwritten in place, otherwise they
    are put behind the data columns. ``df`` must carry ``_row_number``.
    """
    now = ingested_at or datetime.now(timezone.utc)
    midnight = now.replace(hour=0, minute=0, second=0, microsecond=0, tzinfo=None)
    source = source_file if hasattr(source_file, "cast") else F.lit(str(source_file))
    if sheet is None:
        sheet_label = F.lit(NO_SHEET)
    else:
        sheet_label = sheet if hasattr(sheet, "cast") else F.lit(str(sheet))
    audit = {
        "_source_file": source.cast("string"),
        "_sheet_name": F.coalesce(sheet_label.cast("string"), F.lit(NO_SHEET)),
        "_ingested_at": F.lit(midnight.isoformat(sep=" ")).cast("timestamp_ntz"),
        "_row_number": F.col("_row_number").cast("bigint"),
    }
    if existing:
        return df.withColumns(audit)
    kept = [F.col(f"`{c}`") for c in df.columns if c not in AUDIT_COLUMNS]
    return df.select(*kept, *[column.alias(name) for name, column in audit.items()])


def scan_raw(
    spark: SparkSession,
    sources: Sequence[RawSource],
    width: int | None = None,
    multi_line: bool = False,
    null_cells: Sequence[str] = READER_NULL_TOKENS,
    ingested_at: datetime | None = None,
    report: IngestReport | None = None,
) -> DataFrame:
    """All cells of many raw files as strings, one scan, with audit columns.

    A missing source is reported and skipped, the others are read. Rows carry
    ``year_name`` of their source, and (source, sheet, year) stays apart even
    where two sheets share one year. Give ``width`` to save the pass that finds
    it; a record wider than that ends the job, whichever columns are read.
    """
    report = report if report is not None else IngestReport()
    found = []
    for src in sources:
        if path_exists(spark, src.path):
            found.append(src)
            report.loaded.append((src.path, src.sheet, src.year))
        else:
            report.skipped.append((src.path, src.sheet, src.year, "file not found"))
    if not found:
        raise FileNotFoundError(f"none of the {len(sources)} sources exists")
    paths = [src.path for src in found]
    width = width or grid_width(spark, paths, multi_line)
    numbered = _cells(_within_width(scan_records(spark, paths, multi_line), width), width)
    cells = [f"col_{i}" for i in range(width)]
    if null_cells:
        numbered = numbered.withColumns({c: F.when(~F.col(c).isin(*null_cells), F.col(c)) for c in cells})
    labels = {(src.table, src.sheet, src.year) for src in found}
    if len(labels) == 1:
        table, sheet, year = next(iter(labels))
        labelled = numbered.withColumns({
            "_table": F.lit(table), "_sheet": F.lit(sheet).cast("string"), "year_name": F.lit(year).cast("string"),
        })
    else:
        rows = [(uri, s.table, s.sheet, s.year) for s in found for uri in file_uris(spark, s.path)]
        files = spark.createDataFrame(rows, "_source_path string, _table string, _sheet string, year_name string")
        labelled = numbered.join(files, "_source_path", "left")
    audited = with_audit(labelled, F.col("_table"), F.col("_sheet"), ingested_at)
    return audited.select(*cells, *AUDIT_COLUMNS, "year_name")


def extract(raw: DataFrame, spec: Layout, year: str | None = None, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Typed extract of a raw grid: record range, positions, casts, filters, year.

    Positions past the grid's data columns address its audit columns, as they do
    in the written raw file. ``year_name`` is the source's own unless given.
    """
    kept = raw.filter(F.col("_row_number") >= spec.start - 1)
    if spec.end is not None:
        kept = kept.filter(F.col("_row_number") <= spec.end - 2)
    columns = [c for c in raw.columns if c != "year_name"]
    missing = [f.name for f in spec.fields if f.position >= len(columns)]
    if missing:
        raise ValueError(f"{spec.table}: no column at the position of {missing}; the grid has {len(columns)}")
    source_types = dict(raw.dtypes)
    picked, texts = [], {}
    for f in spec.fields:
        name = columns[f.position]
        if source_types[name] == "string":
            picked.append(F.col(name).alias(f.name))
            texts[f.name] = f.type
        else:
            picked.append(F.col(name).cast(LOGICAL_TYPES[f.type]).alias(f.name))
    year_column = F.lit(year) if year is not None or "year_name" not in raw.columns else F.col("year_name")
    typed = cast_columns(kept.select(*picked, year_column.cast("string").alias(_YEAR_LABEL)), texts, tokens)
    return compose(spec.filters)(typed).withColumnRenamed(_YEAR_LABEL, "year_name")


def row_ranges(table: DataFrame) -> DataFrame:
    """``file``, ``low``, ``high``: the least and greatest ``_row_number`` in each file of a written raw table."""
    path = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return table.groupBy(F.url_decode(path).alias("file")).agg(F.min("_row_number").alias("low"), F.max("_row_number").alias("high"))


def files_in_range(ranges: DataFrame, spec: Layout) -> list[str] | None:
    """Files that hold a record of the layout's range, by :func:`row_ranges`; None where all of them may."""
    if spec.start <= 1 and spec.end is None:
        return None
    kept = ranges.filter(F.col("high") >= spec.start - 1)
    if spec.end is not None:
        kept = kept.filter(F.col("low") <= spec.end - 2)
    return [r[0] for r in kept.select("file").orderBy("file").collect()]


def left_out(raw: DataFrame, spec: Layout) -> DataFrame:
    """Records of each source before and behind the layout's range: what an extract leaves out."""
    row = F.col("_row_number")
    behind = F.count_if(row > spec.end - 2) if spec.end is not None else F.lit(0).cast("bigint")
    return raw.groupBy("_source_file", "_sheet_name", "year_name").agg(F.count_if(row < spec.start - 1).alias("before"), behind.alias("behind"))


def compose(steps: Sequence[Callable[[DataFrame], DataFrame]]) -> Callable[[DataFrame], DataFrame]:
    """One step that applies all steps in order."""
    return lambda df: reduce(lambda current, step: current.transform(step), steps, df)


def skeleton(spark: SparkSession, path: str, grain: Sequence[str]) -> DataFrame:
    """First ``len(grain)`` columns of a CSV with header, as strings, renamed.

    Spark passes over files named ``_*`` or ``.*``, so the file needs another name.
    """
    if path.rstrip("/").rsplit("/", 1)[-1].startswith(("_", ".")):
        raise ValueError(f"{path}: Spark does not read files whose name starts with '_' or '.'; rename it")
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no skeleton file at {path}")
    header = spark.read.option("header", True).csv(path)
    if len(header.columns) < len(grain):
        raise ValueError(f"{path}: {len(header.columns)} columns, the grain needs {len(grain)}")
    return header.select(*[F.col(f"`{c}`") for c in header.columns[: len(grain)]]).toDF(*grain)
