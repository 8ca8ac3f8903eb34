"""Metric matrices: a grain table with every source's metrics joined on."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmetrics.functions.text import presence_text
from wardmetrics.operators.joins import grain_merge
from wardmetrics.operators.reshape import category_lookup, pivot_categories
from wardmetrics.plans.domains import NETWORK_LABELS
from wardmetrics.plans.metrics import MetricSpec, compute_metrics, only_counts
from wardmetrics.session import written
from wardmetrics.sinks.writers import layer_path, load_table, write_latest, write_layer
from wardmetrics.sources.raw import skeleton
from wardmetrics.sources.tables import read_present


class GoldGrain:
    """The grain table, growing with each merged source."""

    def __init__(self, base: DataFrame):
        self.base_df = base

    @classmethod
    def from_csv(cls, spark: SparkSession, path: str, grain: Sequence[str]) -> GoldGrain:
        return cls(skeleton(spark, path, grain))

    def merge_metric(self, other: DataFrame, mapping: Mapping[str, str], how: str = "left") -> GoldGrain:
        self.base_df = grain_merge(self.base_df, other, mapping, how)
        return self


def finalize_matrix(
    df: DataFrame, text_col: str = "transport_line_name", labels: Sequence[tuple[str, str]] = NETWORK_LABELS
) -> DataFrame:
    """Numeric counts filled with 0 as integers, and the text column extended by the labels of positive counts."""
    numeric = {c for c, kind in df.dtypes if kind.startswith(("tinyint", "smallint", "int", "bigint", "float", "double", "decimal"))}
    counts = {c: F.coalesce(F.col(f"`{c}`"), F.lit(0)).cast("bigint") for c in df.columns if "count" in c and c in numeric}
    filled = df.withColumns(counts) if counts else df
    base = F.coalesce(F.col(f"`{text_col}`"), F.lit("")) if text_col in df.columns else F.lit("")
    flags = [(F.col(f"`{c}`"), label) for c, label in labels if c in df.columns]
    return filled.withColumn(text_col, presence_text(base, flags))


@dataclass(frozen=True)
class Subset:
    """A source that is the rows of a table whose ``column`` has ``value``."""

    table: DataFrame
    column: str
    value: object

    @property
    def frame(self) -> DataFrame:
        return self.table.filter(F.col(f"`{self.column}`") == F.lit(self.value))


def _counted_subsets(sources: Mapping[str, DataFrame | Subset], config: Mapping) -> dict[str, DataFrame]:
    """Metrics of the subsets whose rules only count: one pass over each table they are cut from.

    The table is counted by (group, subset, text) once, whatever the number of
    its subsets, and each rule set goes on from those counts.
    """
    together: dict[tuple, list[tuple[Mapping, MetricSpec, Subset]]] = {}
    for rules in config["metric_sources"]:
        source = sources.get(rules["source"])
        if isinstance(source, Subset) and not rules.get("pivot"):
            spec = MetricSpec.from_dict(rules)
            if only_counts(spec):
                together.setdefault((id(source.table), source.column, tuple(spec.groupby_cols)), []).append((rules, spec, source))
    out = {}
    for (_, column, keys), members in together.items():
        place = F.col(f"`{column}`")
        texts: dict[str, list] = {}
        for _, spec, source in members:
            if spec.textual_col:
                texts.setdefault(spec.textual_col, []).append(source.value)
        # A text counts for the subsets whose rules unite it; elsewhere it would only make the counts finer.
        cut = members[0][2].table.filter(place.isin(*{source.value for _, _, source in members})).dropna(subset=list(keys))
        cut = cut.select(*[F.col(f"`{k}`") for k in keys], place.alias("_subset"), *[F.when(place.isin(*values), F.col(f"`{t}`")).alias(t) for t, values in texts.items()])
        counted = written(cut.groupBy(*keys, "_subset", *texts).agg(F.count(F.lit(1)).alias("_counted")), "counted-subsets")
        for rules, spec, source in members:
            out[rules["source"]] = compute_metrics(counted.filter(F.col("_subset") == F.lit(source.value)), spec, counted="_counted")
    return out


def build_matrix(grain: DataFrame, sources: Mapping[str, DataFrame | Subset], config: Mapping) -> DataFrame:
    """All sources of a config merged onto the grain, then its rules on the whole matrix."""
    gold = GoldGrain(grain)
    counted = _counted_subsets(sources, config)
    for rules in config["metric_sources"]:
        frame = sources.get(rules["source"])
        if frame is None:
            continue
        metrics = counted.get(rules["source"])
        if metrics is None:
            frame = frame.frame if isinstance(frame, Subset) else frame
            metrics = compute_metrics(pivot_categories(frame, rules["pivot"]) if rules.get("pivot") else frame, rules)
        gold.merge_metric(metrics, rules["join_on"], rules.get("how", "left"))
    matrix = gold.base_df
    if config.get("post_processing"):
        matrix = compute_metrics(matrix, config["post_processing"])
    if config.get("finalize"):
        matrix = finalize_matrix(matrix, config["finalize"])
    return matrix


def validate_config(config: Mapping) -> None:
    """Check every rule set of a gold config before any plan is built."""
    for rules in config["metric_sources"]:
        if not rules.get("join_on"):
            raise ValueError(f"source {rules.get('source')!r} has no join_on")
        MetricSpec.from_dict(rules)
    if config.get("post_processing"):
        MetricSpec.from_dict(config["post_processing"])


@dataclass
class RunReport:
    written: dict[str, str] = field(default_factory=dict)
    missing: list[str] = field(default_factory=list)
    loads: list = field(default_factory=list)
    notes: list[str] = field(default_factory=list)


def run_gold(
    spark: SparkSession,
    config: Mapping,
    root: str,
    domain: str,
    sources: Mapping[str, str],
    grain: DataFrame,
    project: str = "local",
    dry_run: bool = True,
) -> RunReport:
    """Read silver tables, write the matrix, its latest year and the category lookup."""
    validate_config(config)
    report = RunReport()
    frames, report.missing = read_present(spark, sources)
    table = config["table_name"]
    path = write_layer(build_matrix(grain, frames, config), layer_path(root, "gold", domain, table))
    report.written[table] = path
    matrix = spark.read.parquet(path)
    report.loads.append(load_table(spark, matrix, project, "gold_layer", f"{domain}_{table}", dry_run))
    for rules in config["metric_sources"]:
        if rules.get("pivot") and rules["source"] in frames:
            lookup = category_lookup(frames[rules["source"]])
            report.written["category_lookup"] = write_layer(lookup, layer_path(root, "gold", domain, "category_lookup"))
    if config.get("latest"):
        newest = write_latest(matrix, layer_path(root, "gold", domain, f"{table}_latest"))
        if newest:
            report.written[f"{table}_latest"] = newest
            report.loads.append(
                load_table(spark, spark.read.parquet(newest), project, "gold_layer", f"{domain}_{table}_latest", dry_run)
            )
        else:
            report.notes.append("no year column: latest-year table skipped")
    return report
