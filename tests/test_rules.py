import random

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from wardmetrics.operators.aggregate import comma_union, group_medians, group_metrics, register_aggregate
from wardmetrics.operators.compare import add_deviations, add_yoy_changes
from wardmetrics.operators.filters import drop_values
from wardmetrics.plans.domains import EDUCATION_GOLD, HOUSING_GOLD, INFRASTRUCTURE_GOLD, POLICE_GOLD
from wardmetrics.plans.gold import finalize_matrix, validate_config
from wardmetrics.plans.metrics import MetricSpec, compute_metrics, group_grain_key

YOY = [{"target_col": "x", "group_col": "g", "year_col": "year", "output_col": "yoy"}]


def test_filter_out_keeps_nulls(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    assert rows(drop_values(df, {"column": "c", "values": ["a"]})) == [("b",), (None,)]
    assert drop_values(df, [{"column": "nope", "values": ["a"]}]).count() == 3


COND = {
    "filter_column": "kind", "filter_value": ["p", "q"], "group_by": "g", "count_column_name": "n",
    "aggregations": {
        "x": [{"operation": "sum", "output_name": "sx"}, {"operation": "mean", "output_name": "mx"}],
        "t": {"operation": "count_where", "value": "yes", "output_name": "ny"},
        "absent": {"operation": "sum", "output_name": "sa"},
    },
}


def test_conditional_aggregates_fill(spark):
    df = spark.createDataFrame(
        [("a", "p", 1, "yes"), ("a", "q", None, None), ("a", "r", 9, "yes"), ("b", "r", 5, "yes"), ("c", "p", None, "no"), (None, "p", 7, "yes")],
        "g string, kind string, x int, t string",
    )
    got = rows(compute_metrics(df, {"conditional_aggregations": COND}).select("g", "n", "sx", "mx", "ny").distinct())
    assert got == [("a", 2, 1, 1.0, 1), ("b", 0, 0, 0.0, 0), ("c", 1, 0, 0.0, 0), (None, 0, 0, 0.0, 0)]
    spec = MetricSpec.from_dict({"conditional_aggregations": COND}, fill=None)
    got = rows(compute_metrics(df, spec).select("g", "n", "sx", "mx", "ny").distinct())
    assert got == [("a", 2, 1, 1.0, 1), ("b", None, None, None, None), ("c", 1, 0, None, 0), (None, None, None, None, None)]


def test_rule_on_absent_filter_column_is_skipped(spark):
    df = spark.createDataFrame([("a", 1)], "g string, x int")
    assert compute_metrics(df, {"conditional_aggregations": COND}).columns == ["g", "x"]


def test_later_rule_reads_earlier_output(spark):
    df = spark.createDataFrame([("a", "p", 1), ("a", "p", 2), ("b", "p", 3)], "g string, kind string, x int")
    rules = [
        {"filter_column": "kind", "filter_value": "p", "group_by": "g", "count_column_name": "n"},
        {"filter_column": "n", "filter_value": 2, "group_by": "kind", "count_column_name": "twos"},
    ]
    assert rows(compute_metrics(df, {"conditional_aggregations": rules}), "x", "n", "twos") == [(1, 2, 2), (2, 2, 2), (3, 1, 2)]


def test_conditional_rules_share_one_aggregate(spark):
    df = spark.createDataFrame([("a", "p", 1, "yes")], "g string, kind string, x int, t string")
    rules = [COND, {**COND, "filter_value": "r", "count_column_name": "n2", "aggregations": {"x": {"operation": "max", "output_name": "top"}}}]
    spec = MetricSpec.from_dict({"conditional_aggregations": rules, "keep_cols": ["g", "n", "n2", "sx", "top"]})
    plan = compute_metrics(df, spec)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(g") == 1 and "Join" not in plan


FULL = {
    "filter_out": {"column": "status", "values": ["Closed"]},
    "conditional_aggregations": [COND, {**COND, "filter_value": "r", "count_column_name": "n2",
                                        "aggregations": {"x": {"operation": "graded_average", "output_name": "grade"}}}],
    "sum_columns": {"inputs": ["n", "n2"], "output_name": "total"},
    "calculate_ratio": {"numerator_col": "n", "denominator_col": "total", "output_col": "pct"},
    "calculate_ratio_per_1k": {"numerator_col": "sx", "denominator_col": "n", "output_col": "per_1k"},
    "calculate_deviation": [{"target_col": "grade", "new_avg_col": "mean_grade", "new_dev_col": "dev_grade"},
                            {"target_col": "pct", "new_avg_col": "mean_pct", "new_dev_col": "dev_pct"}],
    "rename_cols": {"g": "borough"},
    "keep_cols": ["borough", "n", "total", "pct"],
}


@pytest.mark.parametrize("seed", [1, 2])
def test_group_grain_equals_row_plan(spark, seed):
    rnd = random.Random(seed)
    data = [
        (rnd.choice(["a", "b", "c", None]), rnd.choice(["p", "q", "r", None]), rnd.choice([None, 0, 1, 2, 3, 4, 7]),
         rnd.choice(["yes", "no", None]), rnd.choice(["Open", "Closed", None]))
        for _ in range(200)
    ]
    df = spark.createDataFrame(data, "g string, kind string, x int, t string, status string")
    spec = MetricSpec.from_dict(FULL)
    assert group_grain_key(spec, df.columns) == "g"
    short, wide = compute_metrics(df, spec), compute_metrics(df, spec, row_order=True)
    assert short.columns == wide.columns

    def rounded(frame):
        return rows(frame.select(*[F.round(c, 9).alias(c) if k == "double" else c for c, k in frame.dtypes]))

    assert rounded(short) == rounded(wide)


def test_row_level_column_keeps_the_row_plan(spark):
    spec = MetricSpec.from_dict({**FULL, "keep_cols": ["borough", "n", "x"]})
    assert group_grain_key(spec, ["g", "kind", "x", "t", "status"]) is None


def test_missing_sum_input_and_bad_rules(spark):
    df = spark.createDataFrame([(1,)], "x int")
    with pytest.raises(KeyError):
        compute_metrics(df, {"sum_columns": {"inputs": ["x", "y"], "output_name": "z"}})
    with pytest.raises(ValueError):
        MetricSpec.from_dict({"groupby_cols": ["x"]})
    with pytest.raises(ValueError):
        MetricSpec.from_dict({"calculate_ratio": {"numerator_col": "x"}})
    with pytest.raises(ValueError):
        compute_metrics(df, {"groupby_cols": ["x"], "aggregations": {"x": "no_such"}})


def test_sums_ratios_and_absent_columns(spark):
    df = spark.createDataFrame([(None, None, 0), (1, 2, 4)], "a int, b int, d int")
    out = compute_metrics(df, {
        "sum_columns": {"inputs": ["a", "b"], "output_name": "s"},
        "calculate_ratio": [{"numerator_col": "s", "denominator_col": "d", "output_col": "r"},
                            {"numerator_col": "s", "denominator_col": "nope", "output_col": "r2"},
                            {"numerator_col": "r", "denominator_col": "d", "output_col": "rr"}],
    })
    assert out.columns == ["a", "b", "d", "s", "r", "rr"]
    assert rows(out, "s", "r", "rr") == [(0.0, None, None), (3.0, 75.0, 1875.0)]


def test_keep_columns_without_duplicates(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    out = compute_metrics(df, {"calculate_ratio": {"numerator_col": "a", "denominator_col": "b", "output_col": "r"},
                               "keep_cols": ["r", "a", "zz"]})
    assert out.columns == ["r", "a"]


def test_deviation_zero_mean_and_null_group(spark):
    df = spark.createDataFrame([(1, -1.0), (1, 1.0), (2, 3.0), (None, 5.0)], "year int, x double")
    rule = {"target_col": "x", "new_avg_col": "m", "new_dev_col": "d", "group_by": ["year"]}
    assert rows(add_deviations(df, [rule])) == [(1, -1.0, 0.0, None), (1, 1.0, 0.0, None), (2, 3.0, 3.0, 0.0), (None, 5.0, None, None)]
    plan = add_deviations(df, [rule])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    one = add_deviations(df, [{**rule, "group_by": None}])
    assert rows(one.select("x", "m", "d"))[0] == (-1.0, 2.0, -150.0)
    assert "Window" not in one._jdf.queryExecution().executedPlan().toString()


def test_yoy_previous_row_strict_and_pad(spark):
    df = spark.createDataFrame([("a", 2020, 0.0), ("a", 2021, 5.0), ("a", 2023, 10.0), ("a", 2024, None), (None, 2021, 1.0)], "g string, year int, x double")
    assert rows(add_yoy_changes(df, YOY), "year", "yoy") == [(2020, None), (2021, None), (2021, None), (2023, 100.0), (2024, None)]
    assert rows(add_yoy_changes(df, YOY, strict_year=True), "year", "yoy") == [(2020, None), (2021, None), (2021, None), (2023, None), (2024, None)]
    assert rows(add_yoy_changes(df, YOY, fill="pad"), "year", "yoy")[-1] == (2024, 0.0)
    assert add_yoy_changes(df.drop("year"), YOY).columns == ["g", "x"]


@pytest.mark.parametrize("fill", [None, "pad"])
def test_yoy_over_range_parts_equals_pandas(spark, fill):
    rnd = random.Random(5)
    data = [(rnd.choice("ab"), rnd.randint(2020, 2022), float(i), rnd.choice([None, 1.0, 2.0, 4.0])) for i in range(120)]
    df = spark.createDataFrame(data, "g string, year int, i double, x double")
    got = add_yoy_changes(df, YOY, tie_break="i", fill=fill).select("i", "yoy").toPandas().set_index("i")["yoy"].sort_index()
    frame = pd.DataFrame(data, columns=["g", "year", "i", "x"]).sort_values(["g", "year", "i"])
    if fill:
        frame["x"] = frame.groupby("g")["x"].ffill()
    want = frame.assign(p=(frame["x"].astype(float) / frame.groupby("g")["x"].shift().astype(float) - 1) * 100).set_index("i")["p"].sort_index()
    np.testing.assert_allclose(got.to_numpy(dtype=float), want.to_numpy(dtype=float))


def test_group_metrics_named_operations(spark):
    df = spark.createDataFrame([("a", 3, None), ("a", 1, 2), ("a", 2, 5), (None, 9, 9)], "g string, i int, x int")
    out = group_metrics(df, ["g"], {"x": ["sum", "first", "last", "nunique", "count", "median"]}, order_by="i")
    assert rows(out) == [("a", 7, 2, 5, 2, 2, 3.5)]
    with pytest.raises(ValueError):
        group_metrics(df, ["g"], {"x": "first"})
    register_aggregate("spread", lambda c, when, order: F.max(c) - F.min(c))
    assert rows(group_metrics(df, ["g"], {"x": "spread"})) == [("a", 3)]


@pytest.mark.parametrize("buckets", [1, 3, 64])
def test_exact_medians(spark, buckets):
    rnd = random.Random(buckets)
    data = [(rnd.choice("abc"), rnd.choice([None, 1.0, 2.0, rnd.random(), 1e6 * rnd.random()])) for _ in range(300)] + [("d", 5.0)]
    df = spark.createDataFrame(data, "g string, x double")
    got = dict(rows(group_medians(df, ["g"], "x", "m", buckets)))
    want = pd.DataFrame(data, columns=["g", "x"]).groupby("g")["x"].median().to_dict()
    assert got == pytest.approx(want)


def test_comma_union(spark):
    df = spark.createDataFrame([("a", "N, P"), ("a", "P,,C"), ("a", None), ("b", None), (None, "z")], "g string, t string")
    assert rows(comma_union(df, ["g"], "t", "u", "n")) == [("a", 3, ", C, N, P"), ("b", 1, "")]


def test_text_with_size_through_rules(spark):
    df = spark.createDataFrame([("a", "N"), ("a", "M")], "BOROUGH string, line_name string")
    rules = {"groupby_cols": ["BOROUGH"], "use_size": True, "textual_col": "line_name", "rename_cols": {"size": "tube_count"}}
    out = compute_metrics(df, rules)
    assert out.columns == ["BOROUGH", "tube_count", "transport_line_name"] and rows(out) == [("a", 2, "M, N")]


def test_finalize_creates_the_text(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("b", None, None)], "borough_name string, dlr_count double, bus_count int")
    out = finalize_matrix(df)
    assert rows(out) == [("a", 1, 0, "DLR"), ("b", 0, 0, "None")]


def test_domain_configs_are_valid():
    for config in (EDUCATION_GOLD, HOUSING_GOLD, INFRASTRUCTURE_GOLD, POLICE_GOLD):
        validate_config(config)
    assert len(POLICE_GOLD["post_processing"]["calculate_deviation"]) == 15


def test_police_rules_on_a_small_matrix(spark):
    from wardmetrics.plans.gold import build_matrix

    grain = spark.createDataFrame([("City and Docks", "E1"), ("Barnet", "E2")], "borough_name string, ons_code string")
    people = spark.createDataFrame([("E1", 2023, 1000), ("E1", 2024, 2000), ("E2", 2024, 0)], "ons_code string, year bigint, population bigint")
    crimes = spark.createDataFrame(
        [(2023, "City & Docks", "drugs", 12.0), (2024, "City & Docks", "drugs", 48.0), (2024, "City & Docks", "bicycle-theft", 4.0), (2024, "Barnet", "drugs", 5.0)],
        "year int, borough string, category string, annualised_rate double",
    )
    out = build_matrix(grain, {"population": people, "crimes": crimes}, POLICE_GOLD)
    got = rows(out, "borough_name", "year", "total_crimes_annualised", "total_crimes_per_1000", "lon_avg_total_crimes_per_1000", "yoy_pct_change_drugs_per_1000")
    assert got == [
        ("Barnet", 2024, 5.0, None, 26.0, None), ("City and Docks", 2023, 12.0, 12.0, 12.0, None), ("City and Docks", 2024, 52.0, 26.0, 26.0, 100.0),
    ]
    assert len(out.columns) == 4 + 14 + 1 + 15 + 30 + 15


def test_hot_group_is_spread(spark):
    """A group holding most rows: distinct items and firsts are combined before their shuffle."""
    from wardmetrics.operators.reshape import first_by_key

    df = spark.range(20000).select(F.when(F.col("id") % 10 != 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("g"),
                                   (F.col("id") % 7).cast("string").alias("t"), "id")
    plan = first_by_key(df, "g", ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Window" not in plan
    assert rows(comma_union(df, ["g"], "t", "u", "n").filter("g = 'hot'")) == [("hot", 18000, "0, 1, 2, 3, 4, 5, 6")]


def test_medians_keep_groups_without_values(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("a", 3.0, 2.0), ("b", None, 5.0)], "g string, x double, y double")
    assert rows(group_metrics(df, ["g"], {"x": "median"})) == [("a", 2.0), ("b", None)]
    assert rows(group_metrics(df, ["g"], {"x": "median", "y": "median"})) == [("a", 2.0, 1.5), ("b", None, 5.0)]


def test_median_in_a_conditional_rule(spark):
    df = spark.createDataFrame([(1, "a", "k", 1.0), (2, "a", "k", 4.0), (3, "a", "n", 9.0), (4, "b", "n", 7.0), (5, None, "k", 2.0)], "id int, g string, kind string, x double")
    rule = {"filter_column": "kind", "filter_value": ["k"], "group_by": "g", "count_column_name": "n", "aggregations": {"x": {"operation": "median", "output_name": "mid"}}}
    by_row = compute_metrics(df, {"conditional_aggregations": [rule]}, row_order=True)
    assert rows(by_row.select("id", "mid", "n")) == [(1, 2.5, 2), (2, 2.5, 2), (3, 2.5, 2), (4, 0.0, 0), (5, 0.0, 0)]
    at_group = compute_metrics(df, {"conditional_aggregations": [rule], "keep_cols": ["g", "mid", "n"]})
    assert rows(at_group) == [("a", 2.5, 2), ("b", 0.0, 0), (None, 0.0, 0)]


def test_rows_are_not_dealt_out_by_the_group_key(spark):
    df = spark.range(1000).selectExpr("id", "cast(id % 5 as string) as g", "cast(id % 2 as string) as kind", "cast(id as double) as x")
    rule = {"filter_column": "kind", "filter_value": ["1"], "group_by": "g", "count_column_name": "n", "aggregations": {"x": {"operation": "sum", "output_name": "t"}}}
    deviation = {"calculate_deviation": [{"target_col": "x", "new_avg_col": "m", "new_dev_col": "d", "group_by": ["g"]}]}
    # Both together: the rows with their group values are written between the two joins.
    for spec in ({"conditional_aggregations": [rule]}, deviation, {"conditional_aggregations": [rule], **deviation}):
        plan = compute_metrics(df, spec, row_order=True)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("BroadcastHashJoin") == 1 and not [line for line in plan.splitlines() if "hashpartitioning(g#" in line and ", id#" not in line]


@pytest.mark.parametrize("fill", [None, "pad"])
@pytest.mark.parametrize("strict", [False, True])
def test_yearly_changes_of_one_entity_over_many_parts(spark, fill, strict):
    rnd = random.Random(11)
    years = [y for y in range(1, 4000) if rnd.random() < 0.9]
    data = [("a", y, rnd.choice([None, None, None, 1.0, 2.0, 5.0])) for y in years] + [("b", 1, 3.0), ("b", 2, None), (None, 1, 1.0), (None, 2, 2.0)]
    df = spark.createDataFrame(data, "g string, year int, x double")
    changed = add_yoy_changes(df, YOY, strict_year=strict, fill=fill)
    got = {(r["g"], r["year"]): r["yoy"] for r in changed.collect()}
    last, known, want = {}, {}, {}
    for g, y, x in data:
        now = x if fill is None or x is not None else known.get(g)
        known[g] = now if fill else known.get(g)
        before = last.get(g)
        ok = g is not None and before and before[1] and now is not None and (not strict or before[0] == y - 1)
        want[g, y] = (now / before[1] - 1) * 100 if ok else None
        last[g] = (y, now)
    assert got.keys() == want.keys()
    assert all((got[k] is None) == (want[k] is None) and (want[k] is None or abs(got[k] - want[k]) < 1e-9) for k in want)
    plan = changed._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(g#" not in plan


def test_what_stands_below_a_deviation_runs_once(spark):
    from wardmetrics.session import is_plain_scan, read_once

    facts = spark.range(100).selectExpr("id % 7 as year", "cast(id as double) as x")
    assert is_plain_scan(facts.filter("x > 3").select("x")) and read_once(facts, "t") is facts
    grouped = facts.groupBy("year").agg(F.sum("x").alias("x"))
    assert not is_plain_scan(grouped) and not is_plain_scan(facts.join(grouped, "year"))
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rule = {"target_col": "x", "new_avg_col": "m", "new_dev_col": "d", "group_by": ["year"]}
    assert add_deviations(grouped.mapInArrow(count, grouped.schema), [rule, {**rule, "new_avg_col": "m2", "new_dev_col": "d2"}]).count() == 7
    assert seen.value == 7


def test_finalize_leaves_text_with_count_in_its_name(spark):
    df = spark.createDataFrame([("France", 2), ("Spain", None)], "country string, n_count int")
    assert rows(finalize_matrix(df).select("country", "n_count")) == [("France", 2), ("Spain", 0)]


def test_subsets_of_one_table_are_counted_in_one_pass(spark):
    from wardmetrics.plans.gold import Subset, build_matrix

    rnd = random.Random(3)
    data = [(rnd.choice(["A", "B", "C", None]), rnd.choice(["bus", "tube", "dlr", None]), rnd.choice(["N, P", "P", "", None])) for _ in range(300)]
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    facts = spark.createDataFrame(data, "BOROUGH string, kind string, line_name string")
    grain = spark.createDataFrame([("A",), ("B",), ("C",), ("D",)], "borough_name string")

    def source(kind, **more):
        return {"source": kind, "join_on": {"borough_name": "BOROUGH"}, "groupby_cols": ["BOROUGH"], "use_size": True, "rename_cols": {"size": f"{kind}_count"}, **more}

    config = {"metric_sources": [source("bus"), source("dlr"), source("tube", textual_col="line_name"), source("gone")], "finalize": "transport_line_name"}
    apart = build_matrix(grain, {k: facts.filter(F.col("kind") == k) for k in ("bus", "tube", "dlr")}, config)
    table = facts.mapInArrow(count, facts.schema)
    together = build_matrix(grain, {k: Subset(table, "kind", k) for k in ("bus", "tube", "dlr")}, config)
    assert together.columns == apart.columns and rows(together) == rows(apart)
    assert seen.value == 300


def test_counts_by_sets(spark):
    from wardmetrics.operators.aggregate import counts_by_sets

    df = spark.createDataFrame([("a", 1, None), ("a", 1, "x"), ("a", 2, "x"), (None, 2, "x")], "g string, y int, c string")
    got = counts_by_sets(df, {"one": ["g", "y"], "two": ["c"], "three": ["y", "c"]})
    for name, keys in (("one", ["g", "y"]), ("two", ["c"]), ("three", ["y", "c"])):
        assert rows(got[name]) == rows(df.groupBy(*keys).count())
