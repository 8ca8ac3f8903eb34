"""Bronze and silver jobs: raw files to typed tables to joined tables."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmetrics.functions.text import category_group
from wardmetrics.operators.aggregate import annual_rollup, monthly_counts
from wardmetrics.operators.joins import merge, merge_yearly
from wardmetrics.operators.reshape import union_all
from wardmetrics.plans.domains import BUDGET_LAYOUT, CRIME_GROUPS, HOUSING_YEARS
from wardmetrics.plans.gold import RunReport
from wardmetrics.session import written as stored
from wardmetrics.sinks.writers import layer_path, load_table, write_layer
from wardmetrics.sources.events import scan_events
from wardmetrics.sources.raw import IngestReport, Layout, RawSource, extract, files_in_range, path_exists, row_ranges, scan_raw
from wardmetrics.sources.tables import missing_inputs, source_exists


@dataclass(frozen=True)
class SilverJoin:
    """A joined table built once, when all its inputs exist."""

    name: str
    tables: tuple[str, ...]
    build: Callable[[Mapping[str, DataFrame]], DataFrame]


def school_join(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Each school with its inspection; names both sides have get ``_ofsted``."""
    return merge(
        tables["school_location_data"], tables["school_ofsted_inspection"], "unique_reference_number", "left", ("", "_ofsted")
    )


EDUCATION_JOINS = (SilverJoin("school_with_ofsted", ("school_location_data", "school_ofsted_inspection"), school_join),)
HOUSING_JOINS = (
    SilverJoin("housing_merged", tuple(HOUSING_YEARS), lambda tables: merge_yearly(tables, HOUSING_YEARS)),
)


def run_bronze(
    spark: SparkSession,
    sources: Sequence[RawSource],
    root: str,
    domain: str,
    project: str = "local",
    dry_run: bool = True,
    multi_line: bool | Collection[str] = False,
    widths: Mapping[str, int] | None = None,
) -> RunReport:
    """Raw files of each table to one bronze table, partitioned by year label and sorted by row number.

    ``widths`` names the cells of a record by table and saves the pass that finds
    them; ``multi_line`` is for all tables or names those whose cells hold line
    breaks. A source that cannot be read is reported, and the other sources of its
    table and the other tables go on.
    """
    report = RunReport()
    by_table: dict[str, list[RawSource]] = {}
    for source in sources:
        by_table.setdefault(source.table, []).append(source)
    for table, group in by_table.items():
        ingest = IngestReport()
        try:
            lines = multi_line if isinstance(multi_line, bool) else table in multi_line
            path = layer_path(root, "bronze", domain, table)
            try:
                write_bronze(scan_raw(spark, group, (widths or {}).get(table), lines, report=ingest), path)
            except PySparkException:
                # One of the sources is at fault: each is read apart, and the sound ones make the table.
                ingest = IngestReport()
                write_bronze(_sound_sources(spark, group, (widths or {}).get(table), lines, ingest, report), path)
        except FileNotFoundError:
            report.missing += [s.path for s in group]
            continue
        except PySparkException as error:
            report.notes.append(f"{table} not read: {error}")
            continue
        report.missing += [entry[0] for entry in ingest.skipped]
        report.written[table] = path
        report.loads.append(load_table(spark, spark.read.parquet(path), project, "bronze_layer", f"{domain}_{table}", dry_run))
    return report


def _sound_sources(spark: SparkSession, group: Sequence[RawSource], width: int | None, lines: bool, ingest: IngestReport, report: RunReport) -> DataFrame:
    """The sources that can be read, as one table as wide as the widest; the others go to the report."""
    parts, failure = [], None
    for source in group:
        try:
            parts.append(stored(scan_raw(spark, [source], width, lines, report=ingest), "bronze-source"))
        except FileNotFoundError:
            continue
        except PySparkException as error:
            failure = error
            report.notes.append(f"{source.table} {source.path} not read: {error}")
    if not parts:
        raise failure or FileNotFoundError(f"none of the {len(group)} sources exists")
    widest = max(parts, key=lambda p: len(p.columns)).columns
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked.select(*widest)


# Beside a bronze table, in a folder its readers pass over.
_RANGES = "_row_ranges"


def write_bronze(raw: DataFrame, path: str) -> str:
    """A raw table by year label in files of disjoint row ranges, and beside it the range of each file.

    The rows are dealt out by ranges of (year label, row number), so a large
    source is many files, and an extract of some records opens only those with
    one of them.
    """
    ranged = raw.repartitionByRange("year_name", "_row_number")
    write_layer(ranged, path, "year_name", ["_row_number"], dealt=True)
    row_ranges(raw.sparkSession.read.parquet(path)).write.mode("overwrite").parquet(f"{path}/{_RANGES}")
    return path


def read_bronze(spark: SparkSession, path: str, spec: Layout | None = None) -> DataFrame:
    """A bronze table with its columns in file order; for a layout, of the files that hold a record of its range."""
    ranges = f"{path.rstrip('/')}/{_RANGES}"
    files = files_in_range(spark.read.parquet(ranges), spec) if spec is not None and path_exists(spark, ranges) else None
    if files:
        raw = spark.read.option("basePath", path).parquet(*files)
    else:
        raw = spark.read.parquet(path)
        raw = raw.limit(0) if files == [] else raw
    return raw.withColumn("year_name", F.col("year_name").cast("string"))


def run_silver(
    spark: SparkSession,
    layouts: Sequence[Layout],
    bronze: Mapping[str, str],
    root: str,
    domain: str,
    joins: Sequence[SilverJoin] = (),
    project: str = "local",
    dry_run: bool = True,
) -> RunReport:
    """Typed extract of each bronze table, then the joins, each run once."""
    report = RunReport()
    written: dict[str, DataFrame] = {}
    for spec in layouts:
        location = bronze.get(spec.table)
        if location is None or not source_exists(spark, location):
            report.missing.append(spec.table)
            continue
        path = write_layer(extract(read_bronze(spark, location, spec), spec), layer_path(root, "silver", domain, spec.table))
        written[spec.table] = spark.read.parquet(path)
        report.written[spec.table] = path
        report.loads.append(load_table(spark, written[spec.table], project, "silver_layer", f"{domain}_{spec.table}", dry_run))
    for join in joins:
        absent = missing_inputs(join.tables, written)
        if absent:
            report.notes.append(f"{join.name} skipped, missing {absent}")
            continue
        joined = join.build({t: written[t] for t in join.tables})
        path = write_layer(joined, layer_path(root, "silver", domain, join.name))
        report.written[join.name] = path
        report.loads.append(load_table(spark, spark.read.parquet(path), project, "silver_layer", f"{domain}_{join.name}", dry_run))
    return report


def rolled_up_events(
    events: DataFrame, groups: Mapping[str, str] = CRIME_GROUPS, entity: str = "borough", category: str = "category"
) -> DataFrame:
    """Yearly totals, months, annualised rate and category group of raw events."""
    return rolled_up_counts(monthly_counts(events, entity, category), groups, entity, category)


def rolled_up_counts(
    counts: DataFrame, groups: Mapping[str, str] = CRIME_GROUPS, entity: str = "borough", category: str = "category"
) -> DataFrame:
    """:func:`rolled_up_events` from monthly counts."""
    yearly = annual_rollup(counts, entity, category)
    return yearly.withColumn("analytical_category", category_group(F.col(category), groups))


def run_event_silver(
    spark: SparkSession, events_root: str, root: str, domain: str = "police", project: str = "local", dry_run: bool = True
) -> RunReport:
    """Partitioned event files to the rolled-up ``crimes`` table."""
    report = RunReport()
    path = write_layer(rolled_up_events(scan_events(spark, events_root)), layer_path(root, "silver", domain, "crimes"))
    report.written["crimes"] = path
    report.loads.append(load_table(spark, spark.read.parquet(path), project, "silver_layer", f"{domain}_crimes", dry_run))
    return report


@dataclass
class SheetFiles:
    """Bronze files of one sheet; names sort by date, the last is the latest."""

    sheet: str
    paths: list[str] = field(default_factory=list)

    @property
    def latest(self) -> str | None:
        return max(self.paths) if self.paths else None


def budget_tables(
    spark: SparkSession, sheets: Sequence[SheetFiles], spec: Layout = BUDGET_LAYOUT, report: RunReport | None = None
) -> DataFrame | None:
    """Latest file of each sheet, extracted, tagged with its sheet and stacked in sheet order."""
    report = report if report is not None else RunReport()
    parts = []
    for entry in sheets:
        if entry.latest is None:
            report.missing.append(entry.sheet)
            continue
        raw = spark.read.parquet(entry.latest)
        parts.append(extract(raw, spec).withColumn("source_sheet", F.lit(entry.sheet)))
    return union_all(parts) if parts else None
