"""Metric rules of one source, compiled to a DataFrame plan in a fixed order.

Order: filter_out, conditional aggregates, row sums, text union, group
aggregates, ratios, rates per thousand, deviations, year-on-year changes,
renames, column choice, distinct rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmetrics.functions.numbers import ratio_pct, ratio_per_1k, row_sum
from wardmetrics.operators.aggregate import MEDIAN, comma_union, group_medians, group_metrics, group_size, named_aggregate
from wardmetrics.operators.compare import add_deviations, add_yoy_changes
from wardmetrics.operators.filters import drop_values
from wardmetrics.session import read_once, written

ROWS = "_rows"


def _as_list(rules: object) -> list:
    if not rules:
        return []
    return [rules] if isinstance(rules, Mapping) else list(rules)


@dataclass(frozen=True)
class Output:
    source: str
    operation: str
    name: str
    value: object = None


@dataclass(frozen=True)
class ConditionalRule:
    """Aggregates over the rows whose ``filter_column`` is one of ``values``."""

    filter_column: str
    values: tuple
    group_by: str
    outputs: tuple[Output, ...]
    count_name: str | None = None

    @classmethod
    def from_dict(cls, rule: Mapping) -> ConditionalRule:
        value = rule["filter_value"] if "filter_value" in rule else rule["filter_values"]
        outputs = [
            Output(source, op["operation"], op["output_name"], op.get("value"))
            for source, ops in rule.get("aggregations", {}).items()
            for op in _as_list(ops)
        ]
        values = tuple(value) if isinstance(value, (list, tuple)) else (value,)
        return cls(rule["filter_column"], values, rule["group_by"], tuple(outputs), rule.get("count_column_name"))

    @property
    def names(self) -> list[str]:
        return [o.name for o in self.outputs] + ([self.count_name] if self.count_name else [])


@dataclass(frozen=True)
class MetricSpec:
    """Rules of one metric source. Field names are the keys of the rule dict."""

    filter_out: Sequence[Mapping] = ()
    conditional_aggregations: Sequence[ConditionalRule] = ()
    sum_columns: Sequence[Mapping] = ()
    textual_col: str | None = None
    groupby_cols: Sequence[str] | None = None
    use_size: bool = False
    aggregations: Mapping = field(default_factory=dict)
    calculate_ratio: Sequence[Mapping] = ()
    calculate_ratio_per_1k: Sequence[Mapping] = ()
    calculate_deviation: Sequence[Mapping] = ()
    calculate_yoy_change: Sequence[Mapping] = ()
    rename_cols: Mapping[str, str] = field(default_factory=dict)
    keep_cols: Sequence[str] | None = None

    # Choices beyond the rule dict's own semantics.
    order_by: str | None = None
    strict_year: bool = False
    pad_nulls: bool = False
    tie_break: str | None = None
    fill: float | None = 0

    @classmethod
    def from_dict(cls, rules: Mapping, **options) -> MetricSpec:
        """Build and check a spec. Keys that steer the source itself are ignored."""
        known = {f.name for f in fields(cls)}
        picked = {k: v for k, v in rules.items() if k in known}
        for name in (
            "filter_out", "sum_columns", "calculate_ratio", "calculate_ratio_per_1k",
            "calculate_deviation", "calculate_yoy_change",
        ):
            picked[name] = tuple(_as_list(picked.get(name)))
        picked["conditional_aggregations"] = tuple(
            ConditionalRule.from_dict(r) for r in _as_list(rules.get("conditional_aggregations"))
        )
        group = picked.get("groupby_cols")
        if isinstance(group, str):
            picked["groupby_cols"] = [group]
        spec = cls(**{**picked, **options})
        spec.validate()
        return spec

    def validate(self) -> None:
        if self.groupby_cols is not None and not self.use_size and not self.aggregations:
            raise ValueError("groupby_cols needs use_size or aggregations")
        needed = {
            "filter_out": ("column", "values"),
            "sum_columns": ("inputs", "output_name"),
            "calculate_ratio": ("numerator_col", "denominator_col", "output_col"),
            "calculate_ratio_per_1k": ("numerator_col", "denominator_col", "output_col"),
            "calculate_deviation": ("target_col", "new_avg_col", "new_dev_col"),
            "calculate_yoy_change": ("target_col", "group_col", "year_col", "output_col"),
        }
        for name, keys in needed.items():
            for rule in getattr(self, name):
                absent = [k for k in keys if k not in rule]
                if absent:
                    raise ValueError(f"{name}: rule {dict(rule)} lacks {absent}")

    @property
    def derived(self) -> list[str]:
        """Columns kept whatever ``keep_cols`` says."""
        names = [n for r in self.calculate_deviation for n in (r["new_avg_col"], r["new_dev_col"])]
        names += [r["output_col"] for r in self.calculate_yoy_change]
        names += [r["output_col"] for r in self.calculate_ratio]
        names += [r["output_col"] for r in self.calculate_ratio_per_1k]
        return names


def only_counts(spec: MetricSpec) -> bool:
    """Whether the rules only count rows by group, with the text union, before ratios and what follows."""
    before = (spec.filter_out, spec.conditional_aggregations, spec.sum_columns, spec.aggregations)
    return spec.groupby_cols is not None and spec.use_size and not any(before)


def compute_metrics(df: DataFrame, spec: MetricSpec | Mapping, row_order: bool = False, counted: str | None = None) -> DataFrame:
    """Apply a rule set. A dict is checked and turned into a spec first.

    ``counted`` names a column saying how many rows each row of ``df`` stands for;
    it is for rules that :func:`only_counts`.

    Where every kept column is constant within the conditional rules' group, the
    plan stays at group grain and carries row counts as weights, instead of
    joining group values back to each row and removing the copies afterwards.
    """
    if not isinstance(spec, MetricSpec):
        spec = MetricSpec.from_dict(spec)
    if counted:
        if not only_counts(spec):
            raise ValueError("counted rows serve rules that only count")
        return _finish(df, spec, weight=None, counted=counted)
    kept = drop_values(df, spec.filter_out)
    key = group_grain_key(spec, kept.columns)
    if key is not None and not row_order:
        return _at_group_grain(kept, spec, key)
    return _finish(add_conditional(kept, spec.conditional_aggregations, spec), spec, weight=None)


def group_grain_key(spec: MetricSpec, columns: Sequence[str]) -> str | None:
    """The one group key of the conditional rules, if all later rules stay on its grain."""
    rules = [r for r in spec.conditional_aggregations if r.filter_column in columns]
    keys = {r.group_by for r in rules}
    if len(keys) != 1 or spec.groupby_cols is not None or spec.keep_cols is None or spec.calculate_yoy_change:
        return None
    key = next(iter(keys))
    constant = {key, *[n for r in rules for n in r.names]}
    if any(o.source in constant - {key} for r in rules for o in r.outputs):
        return None
    if any(r.filter_column in constant - {key} for r in rules) or constant & (set(columns) - {key}):
        return None
    for rule in spec.sum_columns:
        if not set(rule["inputs"]) <= constant:
            return None
        constant.add(rule["output_name"])
    for rule in (*spec.calculate_ratio, *spec.calculate_ratio_per_1k):
        if {rule["numerator_col"], rule["denominator_col"]} & (set(columns) - constant):
            return None
        constant.add(rule["output_col"])
    for rule in spec.calculate_deviation:
        group = rule.get("group_by") or []
        group = [group] if isinstance(group, str) else group
        if rule["target_col"] in set(columns) - constant or not set(group) <= {key}:
            return None
        constant |= {rule["new_avg_col"], rule["new_dev_col"]}
    renamed = {spec.rename_cols.get(c, c) for c in constant}
    untouched = {spec.rename_cols.get(c, c) for c in columns if c not in constant}
    if set(spec.keep_cols) & untouched - renamed:
        return None
    return key


def _subset(rule: ConditionalRule) -> Column:
    return F.coalesce(F.col(f"`{rule.filter_column}`").isin(*rule.values), F.lit(False))


def _group_table(df: DataFrame, key: str, rules: Sequence[ConditionalRule], spec: MetricSpec, *more: Column) -> DataFrame | None:
    """One row per value of ``key`` (as ``_key``) with all outputs of the rules; medians are joined to it."""
    outputs = [c for rule in rules for c in _rule_outputs(rule, df.columns, spec)]
    medians = [(rule, o) for rule in rules for o in rule.outputs if o.operation == MEDIAN and o.source in df.columns]
    if not outputs and not medians:
        return None
    # The null key's group is left in: it matches no row, and no key filter makes
    # the aggregate's input differ from the rows it is joined to.
    table = df.groupBy(F.col(f"`{key}`").alias("_key")).agg(*outputs, *(more or [F.count(F.lit(1)).alias("_size")]))
    for rule, o in medians:
        own = group_medians(df.filter(_subset(rule)).withColumn("_key", F.col(f"`{key}`")).dropna(subset=["_key"]), ["_key"], o.source, o.name)
        table = table.join(own, "_key", "left")
    return table if more else table.drop("_size")


def _rule_outputs(rule: ConditionalRule, columns: Sequence[str], spec: MetricSpec) -> list[Column]:
    """The rule's aggregates, each over its own subset of the same group; medians are planned apart."""
    subset = _subset(rule)
    order = F.col(spec.order_by) if spec.order_by else None
    out = []
    for o in rule.outputs:
        if o.source not in columns or o.operation == MEDIAN:
            continue
        value = named_aggregate(o.operation, F.col(f"`{o.source}`"), subset, order, o.value)
        if spec.fill is None:
            # A group without a row in the subset has no value at all.
            value = F.when(F.count_if(subset) > 0, value)
        out.append(value.alias(o.name))
    if rule.count_name:
        count = F.count_if(subset)
        out.append((F.when(count > 0, count) if spec.fill is None else count).alias(rule.count_name))
    return out


def _filled(name: str, kind: str, fill: float | None) -> Column:
    column = F.col(f"`{name}`")
    if fill is None or kind == "string":
        return column
    return F.coalesce(column, F.lit(fill).cast(kind))


def _grouped_rules(rules: Sequence[ConditionalRule], columns: Sequence[str]):
    """Runs of rules on one key that do not read or rewrite each other's outputs."""
    batch: list[ConditionalRule] = []
    written: set[str] = set()
    seen = set(columns)
    for rule in rules:
        if rule.filter_column not in seen | written:
            continue
        reads = {rule.filter_column, rule.group_by, *[o.source for o in rule.outputs]}
        if batch and (rule.group_by != batch[0].group_by or reads & written or set(rule.names) & written):
            yield batch
            seen |= written
            batch, written = [], set()
        batch.append(rule)
        written |= set(rule.names)
    if batch:
        yield batch


def add_conditional(df: DataFrame, rules: Sequence[ConditionalRule], spec: MetricSpec | None = None) -> DataFrame:
    """Conditional aggregates of each row's group, as new columns of the row.

    Rules on one key share one aggregate and one join. Rows with a null key, and
    groups with no row in the subset, get the fill value.
    """
    spec = spec or MetricSpec()
    for batch in _grouped_rules(rules, df.columns):
        key = batch[0].group_by
        df = read_once(df, "group-rows")
        table = _group_table(df, key, batch, spec)
        if table is None:
            continue
        # Written first, so that its measured size decides the join before the rows are dealt out by a key of few values.
        table = written(table, "group-values")
        names = [c for c in table.columns if c != "_key"]
        kinds = dict(table.dtypes)
        kept = [c for c in df.columns if c not in names]
        joined = df.select(*[f"`{c}`" for c in kept]).join(table, F.col(f"`{key}`") == F.col("_key"), "left")
        df = joined.select(*[f"`{c}`" for c in kept], *[_filled(n, kinds[n], spec.fill).alias(n) for n in names])
    return df


def _at_group_grain(df: DataFrame, spec: MetricSpec, key: str) -> DataFrame:
    rules = [r for r in spec.conditional_aggregations if r.filter_column in df.columns]
    table = _group_table(df, key, rules, spec, F.count(F.lit(1)).alias(ROWS)).withColumnRenamed("_key", key)
    kinds = dict(table.dtypes)
    names = [c for c in table.columns if c not in (key, ROWS)]

    def value(name: str) -> Column:
        # Rows with a null key belong to no group: they hold the fill value only.
        known = F.when(F.col(f"`{key}`").isNotNull(), F.col(f"`{name}`"))
        return known if spec.fill is None or kinds[name] == "string" else F.coalesce(known, F.lit(spec.fill).cast(kinds[name]))

    grouped = table.select(key, ROWS, *[value(n).alias(n) for n in names])
    return _finish(grouped, spec, weight=ROWS)


def _finish(df: DataFrame, spec: MetricSpec, weight: str | None, counted: str | None = None) -> DataFrame:
    for rule in spec.sum_columns:
        missing = [c for c in rule["inputs"] if c not in df.columns]
        if missing:
            raise KeyError(f"sum_columns: {rule['output_name']!r} needs absent columns {missing}")
    if spec.sum_columns:
        df = _staged(df, [(r["output_name"], r["inputs"], _sum_of) for r in spec.sum_columns])
    if spec.groupby_cols is not None:
        df = _grouped(df, spec, counted)
    df = _staged(df, [(r["output_col"], [r["numerator_col"], r["denominator_col"]], _pct_of) for r in spec.calculate_ratio])
    df = _staged(
        df, [(r["output_col"], [r["numerator_col"], r["denominator_col"]], _per_1k_of) for r in spec.calculate_ratio_per_1k]
    )
    if spec.calculate_deviation:
        df = add_deviations(df, spec.calculate_deviation, weight)
    if spec.calculate_yoy_change:
        df = add_yoy_changes(
            df, spec.calculate_yoy_change, spec.strict_year, "pad" if spec.pad_nulls else None, spec.tie_break
        )
    if weight:
        df = df.drop(weight)
    if spec.rename_cols:
        df = df.withColumnsRenamed({k: v for k, v in spec.rename_cols.items() if k in df.columns})
    if spec.keep_cols is not None:
        present = set(df.columns)
        wanted = dict.fromkeys([*spec.keep_cols, *spec.derived])
        df = df.select(*[f"`{c}`" for c in wanted if c in present])
    return df.dropDuplicates()


def _sum_of(inputs: Sequence[str]) -> Column:
    return row_sum([F.col(f"`{c}`") for c in inputs])


def _pct_of(inputs: Sequence[str]) -> Column:
    return ratio_pct(F.col(f"`{inputs[0]}`"), F.col(f"`{inputs[1]}`"))


def _per_1k_of(inputs: Sequence[str]) -> Column:
    return ratio_per_1k(F.col(f"`{inputs[0]}`"), F.col(f"`{inputs[1]}`"))


def _staged(df: DataFrame, steps: Sequence[tuple]) -> DataFrame:
    """Add columns in one projection per stage; a step reading an earlier output opens a new stage.

    Steps whose inputs are absent are left out.
    """
    stage: dict[str, Column] = {}
    for name, inputs, build in steps:
        if stage and (set(inputs) & set(stage) or name in stage):
            df, stage = df.withColumns(stage), {}
        if set(inputs) <= set(df.columns):
            stage[name] = build(inputs)
    return df.withColumns(stage) if stage else df


def _grouped(df: DataFrame, spec: MetricSpec, counted: str | None = None) -> DataFrame:
    keys = list(spec.groupby_cols)
    text = spec.textual_col
    if text and spec.use_size:
        return comma_union(df, keys, text, f"transport_{text}", size="size", weight=counted)
    grouped = group_size(df, keys, weight=counted) if spec.use_size else group_metrics(df, keys, spec.aggregations, spec.order_by)
    if text:
        grouped = grouped.join(comma_union(df, keys, text, f"transport_{text}"), keys, "left")
    return grouped
