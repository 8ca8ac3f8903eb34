"""Deviation from a mean and change against the previous year.

Means are aggregates joined back, not windows: a window would send each group,
or with no group the whole table, to one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardmetrics.functions.numbers import pct_change, pct_deviation
from wardmetrics.functions.text import all_of
from wardmetrics.session import read_once, written


def _batches(rules: Sequence[Mapping], place: Callable, outputs: Callable) -> Iterator[list[Mapping]]:
    """Runs of rules that share a place and do not read each other's outputs."""
    batch: list[Mapping] = []
    written: set[str] = set()
    for rule in rules:
        if batch and (place(rule) != place(batch[0]) or rule["target_col"] in written or outputs(rule) & written):
            yield batch
            batch, written = [], set()
        batch.append(rule)
        written |= outputs(rule)
    if batch:
        yield batch


def _group_of(rule: Mapping) -> tuple[str, ...]:
    group = rule.get("group_by")
    if not group:
        return ()
    return (group,) if isinstance(group, str) else tuple(group)


def _mean(column: str, weight: str | None):
    value = F.col(f"`{column}`").cast("double")
    if weight is None:
        return F.avg(value)
    counted = F.when(value.isNotNull(), F.col(weight))
    return F.sum(value * counted) / F.nullif(F.sum(counted).cast("double"), F.lit(0.0))


def add_deviations(df: DataFrame, rules: Sequence[Mapping], weight: str | None = None) -> DataFrame:
    """Per rule the mean (``new_avg_col``) and the percent distance from it (``new_dev_col``).

    A rule with ``group_by`` compares within the group, one without against all
    rows. Rules on absent columns do nothing. ``weight`` names a column saying
    how many rows a row stands for.
    """
    for batch in _batches(rules, _group_of, lambda r: {r["new_avg_col"], r["new_dev_col"]}):
        usable = [r for r in batch if r["target_col"] in df.columns]
        if usable:
            df = _deviate(df, _group_of(usable[0]), usable, weight)
    return df


def _deviate(df: DataFrame, group: tuple[str, ...], rules: list[Mapping], weight: str | None) -> DataFrame:
    if weight is None:
        # The means and the rows both read it; what stands below runs once.
        df = read_once(df, "deviation-rows")
    means = [_mean(r["target_col"], weight).alias(r["new_avg_col"]) for r in rules]
    taken = [c for c in df.columns if c not in {r["new_avg_col"] for r in rules}]
    if group:
        # Null-safe on purpose: no key filter is pushed under the aggregate, so its
        # input stays the same plan as the left side and its shuffles are reused.
        table = df.groupBy(*[F.col(g).alias(f"_by_{g}") for g in group]).agg(*means)
        if weight is None:
            # Rows, not groups: the means are written first, so that their measured size
            # decides the join before the rows are dealt out by a key of few values.
            table = written(table, "group-means")
        same = all_of([F.col(f"`{g}`").eqNullSafe(F.col(f"`_by_{g}`")) for g in group])
        joined = df.select(*[f"`{c}`" for c in taken]).join(table, same, "left")
        known = all_of([F.col(f"`{g}`").isNotNull() for g in group])
        both = joined.select(
            *[f"`{c}`" for c in taken], *[F.when(known, F.col(f"`{r['new_avg_col']}`")).alias(r["new_avg_col"]) for r in rules]
        )
    else:
        one = df.agg(F.struct(*means).alias("_means")).scalar()
        both = df.select(*[f"`{c}`" for c in taken], one.alias("_means"))
        both = both.select(*[f"`{c}`" for c in taken], *[F.col(f"_means.`{r['new_avg_col']}`") for r in rules])
    return both.withColumns({
        r["new_dev_col"]: pct_deviation(F.col(f"`{r['target_col']}`"), F.col(f"`{r['new_avg_col']}`")) for r in rules
    })


def add_yoy_changes(
    df: DataFrame,
    rules: Sequence[Mapping],
    strict_year: bool = False,
    fill: str | None = None,
    tie_break: str | None = None,
) -> DataFrame:
    """Percent change against the entity's previous row in year order.

    Per rule: ``target_col``, ``group_col``, ``year_col``, ``output_col``. Rules
    on absent columns do nothing.

    - ``strict_year``: compare with year - 1 only, null where it is absent.
    - ``fill="pad"``: a null value repeats the entity's last known one first.
    - ``tie_break``: a column ordering rows of one entity and year; else the
      compared values themselves order them.

    A prefix scan in two levels: rows are dealt out by ranges of (entity, year),
    compared inside each part, and a part's first row of an entity takes over the
    last row, the last known value and the last year of the earlier parts. So an
    entity of any size is spread over many tasks; the second level has one row
    per entity and part.
    """
    if fill not in (None, "pad"):
        raise ValueError(f"fill={fill!r}")
    if strict_year and tie_break:
        raise ValueError("strict_year compares entity-year rows; it takes no tie_break")
    for batch in _batches(rules, lambda r: (r["group_col"], r["year_col"]), lambda r: {r["output_col"]}):
        usable = [r for r in batch if {r["target_col"], r["group_col"], r["year_col"]} <= set(df.columns)]
        if usable:
            df = _scan_years(df, usable[0]["group_col"], usable[0]["year_col"], usable, fill, strict_year, tie_break)
    return df


def _scan_years(df, entity, year, rules, fill, strict_year, tie_break) -> DataFrame:
    targets = list(dict.fromkeys(r["target_col"] for r in rules))
    order = list(dict.fromkeys([year, *([tie_break] if tie_break else targets)]))
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    by_key = [F.col(f"`{c}`") for c in [entity, *[c for c in order if c != entity]]]
    ranged = df.repartitionByRange(parts, *by_key)
    # Written, so that both levels see the same parts.
    rows = written(ranged.withColumn("_part", F.spark_partition_id()), "yearly-parts")
    place = F.struct(*[F.col(f"`{c}`") for c in order])
    ends = rows.groupBy("_part", F.col(f"`{entity}`").alias("_entity")).agg(
        *[F.max_by(f"`{t}`", place).alias(f"_end_{t}") for t in targets],
        *[F.max_by(f"`{t}`", F.when(F.col(f"`{t}`").isNotNull(), place)).alias(f"_known_{t}") for t in targets],
        F.max_by(f"`{year}`", place).alias("_end_year"),
    )
    across = Window.partitionBy("_entity").orderBy("_part")
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        F.col("_part").alias("_p"), "_entity", F.lag("_end_year").over(across).alias("_year_carried"),
        *[F.lag(f"_end_{t}").over(across).alias(f"_end_carried_{t}") for t in targets],
        *[F.last(f"_known_{t}", ignorenulls=True).over(earlier).alias(f"_known_carried_{t}") for t in targets],
    )
    # Rows without an entity find nothing here and are compared with nothing.
    joined = rows.join(carried, (rows["_part"] == carried["_p"]) & (rows[entity] == carried["_entity"]), "left")
    inside = Window.partitionBy("_part", entity).orderBy(*[F.col(f"`{c}`") for c in order])
    to_here = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def current(target):
        value = F.col(f"`{target}`")
        return F.coalesce(F.last(value, ignorenulls=True).over(to_here), F.col(f"_known_carried_{target}")) if fill == "pad" else value

    staged = joined.withColumns({"_first": F.row_number().over(inside) == 1, **{f"_now_{t}": current(t) for t in targets}})
    taken_over = "_known_carried_" if fill == "pad" else "_end_carried_"
    before = {f"_before_{t}": F.when(F.col("_first"), F.col(f"{taken_over}{t}")).otherwise(F.lag(f"_now_{t}").over(inside)) for t in targets}
    if strict_year:
        before["_year_before"] = F.when(F.col("_first"), F.col("_year_carried")).otherwise(F.lag(f"`{year}`").over(inside))
    staged = staged.withColumns(before)
    if strict_year:
        next_door = F.col("_year_before") == F.col(f"`{year}`") - 1
        staged = staged.withColumns({f"_before_{t}": F.when(next_door, F.col(f"_before_{t}")) for t in targets})
    return _finish_yoy(staged, entity, rules, df.columns)


def _finish_yoy(staged, entity, rules, columns) -> DataFrame:
    out = {
        r["output_col"]: F.when(
            F.col(f"`{entity}`").isNotNull(),
            pct_change(F.col(f"`_now_{r['target_col']}`"), F.col(f"`_before_{r['target_col']}`")),
        )
        for r in rules
    }
    kept = [c for c in columns if c not in out]
    return staged.select(*[f"`{c}`" for c in kept], *[column.alias(name) for name, column in out.items()])
