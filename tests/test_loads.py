import json
from datetime import date, datetime
from types import SimpleNamespace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from wardmetrics.operators.quality import apply_defaults, duplicate_keys, null_counts, orphan_keys
from wardmetrics.plans.gold import run_gold
from wardmetrics.plans.layers import HOUSING_JOINS, run_bronze, run_event_silver, run_silver
from wardmetrics.plans.serving import sync_serving
from wardmetrics.session import scratch_path
from wardmetrics.sinks.upsert import read_version, upsert_version, versions
from wardmetrics.sinks.writers import append_events, export_name, export_table, layer_path, load_table, logical_schema, write_latest
from wardmetrics.sources.raw import RawSource, layout
from wardmetrics.streaming.incremental import (
    append_state, calendar_between, load_new_files, pending_batches, read_events_table, read_state, stream_new_files,
)


def publish(root, month, name, records):
    folder = root / "year=2024" / f"month={month}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name}.json").write_text(records if isinstance(records, str) else json.dumps(records))


def test_calendar(spark):
    assert rows(calendar_between(spark, date(2023, 11, 15), date(2024, 3, 31))) == [("2023-11",), ("2023-12",), ("2024-01",)]
    assert rows(calendar_between(spark, date(2024, 3, 1), date(2024, 3, 31))) == []


def test_pending_batches(spark):
    entities = spark.createDataFrame([("A",), ("B",)], "borough string")
    done = spark.createDataFrame([("A_2024-01",)], "signature string")
    got = rows(pending_batches(entities, done, date(2024, 1, 1), date(2024, 4, 2)), "signature")
    assert got == [("A_2024-02",), ("B_2024-01",), ("B_2024-02",)]


def test_state(spark, tmp_path):
    path = str(tmp_path / "state")
    assert read_state(spark, path).count() == 0
    append_state(spark.createDataFrame([("x",), ("x",)], "signature string"), path)
    assert rows(read_state(spark, path)) == [("x",)]


def test_keyed_load_keeps_failed_files_pending(spark, tmp_path):
    root, table, state = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "s")
    publish(root, "01", "Barking & Dagenham", [{"id": 1, "a": {"b": 2}}, {"id": 2}])
    publish(root, "02", "Empty", [])
    publish(root, "02", "Broken", "[{oops")
    fates = rows(load_new_files(spark, str(root), table, state), "fate", "records")
    assert fates == [("failed", 0), ("loaded", 0), ("loaded", 2)] and read_state(spark, state).count() == 0
    load_new_files(spark, str(root), table, state, dry_run=False)
    assert read_state(spark, state).count() == 2
    publish(root, "02", "Broken", [{"id": 3}])
    again = load_new_files(spark, str(root), table, state, dry_run=False)
    assert rows(again, "fate", "records") == [("loaded", 1)]
    got = rows(read_events_table(spark, table), "crime_id", "crime_date", "borough")
    assert got == [("1", date(2024, 1, 1), "Barking & Dagenham"), ("2", date(2024, 1, 1), "Barking & Dagenham"), ("3", date(2024, 2, 1), "Broken")]
    inner = read_events_table(spark, table).select(F.variant_get("crime_details", "$.a.b", "int").alias("ab")).dropna().first()[0]
    assert inner == 2


def test_stream_load_runs_twice(spark, tmp_path):
    root, table, check = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "c")
    publish(root, "01", "A", [{"id": 1}])
    publish(root, "01", "Broken", "nope")
    stream_new_files(spark, str(root), table, check).awaitTermination()
    stream_new_files(spark, str(root), table, check).awaitTermination()
    assert rows(read_events_table(spark, table), "crime_id") == [("1",)]
    publish(root, "02", "A", [{"id": 2}, {"id": 3}])
    stream_new_files(spark, str(root), table, check).awaitTermination()
    assert rows(read_events_table(spark, table), "crime_id") == [("1",), ("2",), ("3",)]
    failed = spark.read.parquet(table + "_failed")
    assert rows(failed, "signature") == [("year=2024/month=01/Broken.json",)]


def test_dry_run_reports_and_writes_nothing(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "a bigint, b string")
    plan = load_table(spark, df, "test-project", "test_layer", "test_table")
    text = plan.describe()
    assert "[DRY RUN]" in text and "test-project.test_layer.test_table" in text and "3 rows" in text
    assert plan.schema == (("a", "INTEGER"), ("b", "STRING"))


def test_load_table_replaces_and_comments(spark, tmp_path):
    df = spark.createDataFrame([(1, 0)], "a int, _row_number bigint")
    for _ in range(2):
        name = load_table(spark, df, "p", "wm_test_layer", "My Table-x", dry_run=False)
    try:
        assert spark.table(name).count() == 1
        described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
        assert "_row_number" in described["Comment"]
    finally:
        spark.sql("DROP DATABASE wm_test_layer CASCADE")


def test_logical_types(spark):
    df = spark.sql("select 1 a, 1.5D b, true c, timestamp_ntz'2024-01-01' d, 'x' e, parse_json('1') f, date'2024-01-01' g")
    assert [t for _, t in logical_schema(df)] == ["INTEGER", "FLOAT", "BOOLEAN", "TIMESTAMP", "STRING", "JSON", "DATE"]


def test_append_twice_and_dry(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("1", datetime(2024, 1, 5, 3), "B", '{"x": [1]}')], "id string, day timestamp_ntz, borough string, j string")
    plan = append_events(df, path, "j", "day", "borough")
    assert plan.schema[1] == ("day", "DATE") and plan.schema[3] == ("j", "JSON") and "Partitioning by column: day" in plan.describe()
    for _ in range(2):
        append_events(df, path, "j", "day", "borough", dry_run=False)
    back = spark.read.parquet(path)
    assert back.count() == 2 and back.select(F.variant_get("j", "$.x[0]", "int")).first()[0] == 1


def test_hot_partition_is_split_on_write(spark, tmp_path):
    from wardmetrics.sinks.writers import spread

    plan = spread(spark.range(10).withColumn("d", F.lit(1)), "d")._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


def test_export_latest_paths(spark, tmp_path):
    at = datetime(2026, 1, 2, 3, 4, 5)
    assert export_name("My Project", "Gold", "t", at) == "my_project_gold_t_20260102_030405"
    df = spark.createDataFrame([(2020, "a"), (2021, "b")], "year int, v string")
    path = export_table(df, str(tmp_path), "p", "l", "t", at)
    assert spark.read.option("header", True).csv(path).count() == 2
    assert rows(spark.read.parquet(write_latest(df, str(tmp_path / "latest")))) == [(2021, "b")]
    assert write_latest(df.drop("year"), str(tmp_path / "none")) is None
    assert layer_path("/r/", "gold", "A b", "t") == "/r/gold/a_b/t"


def test_quality(spark):
    df = spark.createDataFrame([("E1", 1, None), ("E1", 1, 2), ("E9", 1, 3), (None, 1, 4)], "ons_code string, year int, n int")
    assert rows(duplicate_keys(df, ["ons_code", "year"])) == [("E1", 1, 2)]
    known = spark.createDataFrame([("E1",)], "ons_code string")
    assert rows(orphan_keys(df, known, "ons_code")) == [("E9", 1)]
    assert rows(null_counts(df, ["ons_code", "year", "n"])) == [("n", 1), ("ons_code", 1)]
    assert rows(apply_defaults(df, {"n": 0, "gone": 1}), "n") == [(0,), (2,), (3,), (4,)]


def test_upsert_versions_are_repeatable(spark, tmp_path):
    base = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    upsert_version(spark, base, first, "k", 1)
    for _ in range(2):
        upsert_version(spark, base, first.filter("k = 2").withColumn("v", F.lit("B")), "k", 2)
    assert rows(read_version(spark, base)) == [(1, "a"), (2, "B")]
    assert rows(read_version(spark, base, 1)) == [(1, "a"), (2, "b")]


def test_serving_violations(spark, tmp_path):
    names = [(spark.createDataFrame([("E1", "One")], "ons_code string, name string"), "ons_code", "name")]
    frame = spark.createDataFrame([("E1", 2020, 1.0), ("E2", 2020, 2.0), (None, 2020, 3.0)], "ons_code string, year int, x double")
    _, report = sync_serving(spark, str(tmp_path), 1, {"borough_housing_historical": frame}, names)
    assert rows(report) == [
        ("borough_housing_historical", "foreign_key", "E2", 1), ("borough_housing_historical", "not_null", "ons_code", 1),
    ]


def test_housing_layers_end_to_end(spark, tmp_path):
    """Bronze, silver with its join, gold with its latest year, from small files."""
    raw, root = tmp_path / "raw", str(tmp_path / "data")
    raw.mkdir()
    head = "t\n" * 2
    for year, total in (("2021", 100), ("2022", 110)):
        (raw / f"stock{year}.csv").write_text(head + f"E09000001,City,{total},[x]\nE99,Other,5,6\n")
        (raw / f"extra{year}.csv").write_text(head + f"E09000001,City,{total // 10}\n")
    sources = [RawSource(str(raw / f"stock{y}.csv"), "stock", y) for y in ("2021", "2022")]
    sources += [RawSource(str(raw / f"extra{y}.csv"), "extra", y) for y in ("2021", "2022")] + [RawSource(str(raw / "no.csv"), "extra", "2023")]
    bronze = run_bronze(spark, sources, root, "housing")
    assert bronze.missing == [str(raw / "no.csv")] and set(bronze.written) == {"stock", "extra"}
    from wardmetrics.operators.joins import merge_yearly
    from wardmetrics.plans.domains import by_code
    from wardmetrics.plans.layers import SilverJoin

    layouts = [
        layout("stock", 3, 9, [(0, "ons_code"), (2, "total_dwellings", "FLOAT")], [by_code]),
        layout("extra", 3, 9, [(0, "ons_code"), (2, "total", "INTEGER")], [by_code]),
        layout("gone", 3, 9, [(0, "ons_code")]),
    ]
    joins = [SilverJoin("housing_merged", ("stock", "extra"), merge_yearly), *HOUSING_JOINS]
    silver = run_silver(spark, layouts, bronze.written, root, "housing", joins)
    assert silver.missing == ["gone"] and "skipped" in silver.notes[0]
    config = {
        "table_name": "housing", "latest": True,
        "metric_sources": [{
            "source": "housing_merged", "join_on": {"ons_code": "ons_code"}, "keep_cols": ["year", "ons_code", "total_dwellings"],
            "calculate_yoy_change": {"target_col": "total_dwellings", "group_col": "ons_code", "year_col": "year", "output_col": "yoy"},
        }],
    }
    grain = spark.createDataFrame([("City", "E09000001"), ("Barnet", "E09000003")], "borough_name string, ons_code string")
    gold = run_gold(spark, config, root, "housing", {"housing_merged": silver.written["housing_merged"], "x": root + "/none"}, grain)
    assert gold.missing == ["x"]
    got = rows(spark.read.parquet(gold.written["housing"]), "borough_name", "year", "total_dwellings", "yoy")
    assert [r[:3] for r in got] == [("Barnet", None, None), ("City", 2021, 100.0), ("City", 2022, 110.0)]
    assert abs(got[2][3] - 10.0) < 1e-9
    assert rows(spark.read.parquet(gold.written["housing_latest"]), "year") == [(2022,)]


def test_event_silver(spark, tmp_path):
    publish(tmp_path / "in", "01", "Barnet", [{"id": 1, "category": "drugs"}, {"id": 2, "category": "drugs"}])
    publish(tmp_path / "in", "02", "Barnet", [{"id": 3, "category": "drugs"}, {"id": 4, "category": "new thing"}])
    report = run_event_silver(spark, str(tmp_path / "in"), str(tmp_path / "data"))
    got = rows(spark.read.parquet(report.written["crimes"]), "category", "total_count", "months_present", "annualised_rate", "analytical_category")
    assert got == [("drugs", 3, 2, 18.0, "Quality of Life & Public Order"), ("new thing", 1, 1, 12.0, "Other")]


def test_scratch_paths_are_shared_and_fresh(spark):
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
    for settings, root in (
        ({"spark.checkpoint.dir": "hdfs://store/shared/"}, "hdfs://store/shared/wardmetrics/a-"),
        ({"spark.sql.warehouse.dir": "hdfs://store/warehouse"}, "hdfs://store/warehouse/_scratch/wardmetrics/a-"),
    ):
        session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None, own=settings: own.get(key, default)))
        assert scratch_path(session, "a").startswith(root)
    for master, fails in (("local[2]", False), ("spark://host:7077", True)):
        own = {"spark.sql.warehouse.dir": "file:/home/me/warehouse", "spark.master": master}
        session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None, own=own: own.get(key, default)))
        if fails:
            with pytest.raises(ValueError, match="checkpoint"):
                scratch_path(session, "a")
        else:
            assert scratch_path(session, "a").startswith("file:/home/me/warehouse/_scratch")


def test_second_run_opens_only_new_files(spark, tmp_path, monkeypatch):
    from wardmetrics.streaming import incremental

    opened = []
    read = incremental.read_payload_files
    monkeypatch.setattr(incremental, "read_payload_files", lambda spark, root, paths: opened.append(sorted(paths)) or read(spark, root, paths))
    root, table, state = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "s")
    publish(root, "01", "A", [{"id": 1}])
    publish(root, "02", "Broken", "[{oops")
    publish(root, "03", "B", [{"id": 2}])
    load_new_files(spark, str(root), table, state, dry_run=False)
    assert [[p.rsplit("/", 1)[1] for p in batch] for batch in opened] == [["A.json"], ["Broken.json"], ["B.json"]]
    opened.clear()
    publish(root, "04", "C", [{"id": 3}])
    got = load_new_files(spark, str(root), table, state, dry_run=False)
    assert [[p.rsplit("/", 1)[1] for p in batch] for batch in opened] == [["Broken.json"], ["C.json"]]
    assert rows(got, "fate", "records") == [("failed", 0), ("loaded", 1)]
    assert rows(read_events_table(spark, table), "crime_id") == [("1",), ("2",), ("3",)]


def test_month_repeated_after_a_lost_state_adds_nothing_twice(spark, tmp_path):
    root, table = tmp_path / "in", str(tmp_path / "t")
    publish(root, "01", "A", [{"id": 1}])
    for state in ("s1", "s2"):  # the second run knows nothing of the first
        load_new_files(spark, str(root), table, str(tmp_path / state), dry_run=False)
    assert rows(read_events_table(spark, table), "crime_id") == [("1",)]


def test_incoming_rows_of_one_key_leave_one(spark, tmp_path):
    frame = spark.createDataFrame([("E1", 2020, 1.0), ("E1", 2020, 3.0), ("E1", 2021, None)], "ons_code string, year int, average_price double")
    for version in (1, 2):
        upsert_version(spark, str(tmp_path / "u"), frame, ["ons_code", "year"], version)
    assert rows(read_version(spark, str(tmp_path / "u"))) == [("E1", 2020, 3.0), ("E1", 2021, None)]


def test_bronze_goes_on_past_a_bad_table(spark, tmp_path):
    (tmp_path / "good.csv").write_text("a,1\nb,2\n")
    (tmp_path / "wide.csv").write_text("a,1\nb,2,3\n")
    sources = [RawSource(str(tmp_path / "wide.csv"), "wide", "2020"), RawSource(str(tmp_path / "good.csv"), "good", "2020")]
    report = run_bronze(spark, sources, str(tmp_path / "out"), "d", widths={"wide": 2, "good": 2})
    assert list(report.written) == ["good"] and report.notes and "wide" in report.notes[0]


def test_one_unreadable_source_leaves_the_others_of_its_table(spark, tmp_path):
    (tmp_path / "good.csv").write_text("a,1\nb,2\n")
    (tmp_path / "wide.csv").write_text("a,1\nb,2,3\n")
    (tmp_path / "more.csv").write_text("c\n")
    sources = [RawSource(str(tmp_path / f"{n}.csv"), "t", y) for n, y in (("good", "2020"), ("wide", "2021"), ("more", "2022"), ("gone", "2023"))]
    report = run_bronze(spark, sources, str(tmp_path / "out"), "d", widths={"t": 2})
    assert rows(spark.read.parquet(report.written["t"]), "col_0", "col_1", "_row_number", "year_name") == [("a", "1", 0, 2020), ("b", "2", 1, 2020), ("c", None, 0, 2022)]
    assert len(report.notes) == 1 and "wide.csv" in report.notes[0] and report.missing == [str(tmp_path / "gone.csv")]


def test_all_rules_of_a_table_in_one_pass(spark):
    from wardmetrics.plans.serving import constraint_report

    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    data = [("a|b", "c", 1), ("a", "b|c", 1), ("a", "b", None), ("a", "b", 2), (None, "b", 3), (None, "b", None), ("z", None, 4), ("", None, 5)]
    df = spark.createDataFrame(data, "k string, l string, v int")
    known = spark.createDataFrame([("a",), ("",), (None,)], "k string")
    spec = {"t": {"keys": ["k", "l"], "required": ["v"]}}
    report = constraint_report(df.mapInArrow(count, df.schema), "t", known, spec)
    assert rows(report, "rule", "subject", "n") == sorted([
        ("unique", "a|b", 2), ("unique", "b", 2), ("not_null", "k", 2), ("not_null", "l", 2), ("not_null", "v", 2), ("foreign_key", "a|b", 1), ("foreign_key", "z", 1),
    ])
    assert seen.value == len(data)
    assert rows(constraint_report(df, "t", None, spec), "rule").count(("foreign_key",)) == 0


def test_dry_run_samples_the_first_rows(spark):
    df = spark.createDataFrame([(i, f"v{i}") for i in (5, 3, 9, 1, 7)], "_row_number long, v string")
    plan = load_table(spark, df, "p", "l", "t")
    assert [r["_row_number"] for r in plan.sample] == [1, 3, 5, 7] and "v3" in plan.describe()


def test_a_batch_rewrites_only_its_buckets(spark, tmp_path):
    base = str(tmp_path / "t")
    first = spark.range(5000).selectExpr("id as k", "cast(id as string) as v")
    upsert_version(spark, base, first, "k", 1, buckets=16)

    def written_bytes():
        return sum(p.stat().st_size for p in (tmp_path / "t" / "data").rglob("*.parquet"))

    whole = written_bytes()
    upsert_version(spark, base, spark.createDataFrame([(7, "seven", 1.5)], "k int, v string, x double"), "k", 2)
    assert written_bytes() - whole < whole / 8
    now = read_version(spark, base)
    assert now.count() == 5000 and rows(now.filter("k in (7, 8)")) == [(7, "seven", 1.5), (8, "8", None)]
    assert read_version(spark, base, 1).columns == ["k", "v"] and rows(read_version(spark, base, 1).filter("k = 7")) == [(7, "7")]
    nulls = spark.createDataFrame([(None, "none"), (None, "other")], "k long, v string")
    for version in (3, 4):
        upsert_version(spark, base, nulls, "k", version)
    assert rows(read_version(spark, base).filter("k is null"), "v") == [("other",)]


def test_a_died_upsert_leaves_the_older_version(spark, tmp_path, monkeypatch):
    from wardmetrics.sinks import upsert as upserts

    base = str(tmp_path / "t")
    frame = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    upsert_version(spark, base, frame, "k", 1)

    def die(*args):
        raise KeyboardInterrupt

    monkeypatch.setattr(upserts, "put_marker", die)
    with pytest.raises(KeyboardInterrupt):
        upsert_version(spark, base, frame.withColumn("v", F.lit("lost")), "k", 2)
    monkeypatch.undo()
    assert versions(spark, base) == [1] and rows(read_version(spark, base)) == [(1, "a"), (2, "b")]
    upsert_version(spark, base, frame.filter("k = 1").withColumn("v", F.lit("again")), "k", 2)
    assert rows(read_version(spark, base)) == [(1, "again"), (2, "b")]
    with pytest.raises(FileNotFoundError):
        read_version(spark, base, 9)


def test_a_load_that_dies_before_its_marker_shows_nothing_and_doubles_nothing(spark, tmp_path, monkeypatch):
    from wardmetrics.streaming import incremental

    root, table, state = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "s")
    publish(root, "01", "A", [{"id": 1}])
    publish(root, "02", "B", [{"id": 2}])

    def die(*args):
        raise KeyboardInterrupt

    for step in ("put_marker", "append_state"):
        monkeypatch.setattr(incremental, step, die)
        with pytest.raises(KeyboardInterrupt):
            load_new_files(spark, str(root), table, state, dry_run=False)
        monkeypatch.undo()
        assert rows(read_events_table(spark, table), "crime_id") == ([] if step == "put_marker" else [("1",), ("put_marker",)])
        publish(root, "01", f"late {step}", [{"id": step}])  # the batch gets another name than the one that died
    load_new_files(spark, str(root), table, state, dry_run=False)
    assert rows(read_events_table(spark, table), "crime_id") == [("1",), ("2",), ("append_state",), ("put_marker",)]
    assert load_new_files(spark, str(root), table, state, dry_run=False).count() == 0


def test_records_without_an_id_fail_their_file_alone(spark, tmp_path):
    root, table, state = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "s")
    publish(root, "01", "A", [{"id": 1}, {"id": None}])
    publish(root, "01", "NoId", [{"id": 2}, {"no": 3}])
    publish(root, "01", "Number", [4])
    for whole_bytes in (0, 1 << 20):  # read in ranges, and whole
        fates = load_new_files(spark, str(root), table, state, whole_bytes=whole_bytes)
        assert rows(fates.withColumn("f", F.element_at(F.split("signature", "/"), -1)), "f", "fate", "records") == [("A.json", "loaded", 2), ("NoId.json", "failed", 0), ("Number.json", "failed", 0)]
    load_new_files(spark, str(root), table, state, dry_run=False, whole_bytes=0)
    assert rows(read_events_table(spark, table), "crime_id", "borough", "crime_date") == [("1", "A", date(2024, 1, 1)), (None, "A", date(2024, 1, 1))]


def test_a_month_of_many_files_loads_in_batches(spark, tmp_path, monkeypatch):
    from wardmetrics.streaming import incremental

    monkeypatch.setattr(incremental, "FILES_PER_BATCH", 3)
    root, table, state = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "s")
    for i in range(7):
        publish(root, "01", f"F{i}", [{"id": i}])
    got = load_new_files(spark, str(root), table, state, dry_run=False)
    assert got.select("batch").distinct().count() == 3 == len(incremental.published_batches(spark, table))
    assert rows(read_events_table(spark, table), "crime_id") == [(str(i),) for i in range(7)]


def test_rolling_totals_equal_the_roll_up_of_everything(spark, tmp_path):
    import random

    from wardmetrics.operators.aggregate import annual_rollup, monthly_counts
    from wardmetrics.streaming.rolling import add_batch, rolling_rates

    rnd = random.Random(2)
    kinds = "year int, month int, borough string, category string"
    batches = [[(rnd.choice([2023, 2024]), rnd.randint(1, 12), rnd.choice(["A", "B", None]), rnd.choice(["x", "y", None])) for _ in range(n)] for n in (40, 0, 60, 5)]
    base = str(tmp_path / "totals")
    for i, batch in enumerate(batches):
        frame = spark.createDataFrame(batch, kinds)
        assert add_batch(spark, base, frame, f"b{i}") and not add_batch(spark, base, frame, f"b{i}")
        so_far = spark.createDataFrame([r for b in batches[: i + 1] for r in b], kinds)
        columns = ["year", "borough", "category", "total_count", "months_present", "annualised_rate"]
        assert rows(rolling_rates(spark, base), *columns) == rows(annual_rollup(monthly_counts(so_far)), *columns)


def test_an_extract_opens_only_bronze_files_of_its_rows(spark, tmp_path):
    from wardmetrics.plans.layers import read_bronze
    from wardmetrics.sources.raw import extract

    for name in ("a +b", "c"):
        (tmp_path / f"{name}.csv").write_text("".join(f"{i},x\n" for i in range(20_000)))
    sources = [RawSource(str(tmp_path / "a +b.csv"), "t", "20/21 +"), RawSource(str(tmp_path / "c.csv"), "t", "2022")]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = run_bronze(spark, sources, str(tmp_path / "out"), "d", widths={"t": 2}).written["t"]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    spec = layout("t", 5_001, 5_011, [(0, "n", "INTEGER")])
    some, whole = read_bronze(spark, path, spec), read_bronze(spark, path)
    assert len(whole.inputFiles()) >= 8 and len(some.inputFiles()) <= 4
    assert rows(extract(some, spec)) == rows(extract(whole, spec)) == sorted([(i, y) for i in range(5_000, 5_010) for y in ("20/21 +", "2022")], key=str)
    assert read_bronze(spark, path, layout("t", 30_000, None, [(0, "n")])).count() == 0
    assert len(read_bronze(spark, path, layout("t", 1, None, [(0, "n")])).inputFiles()) == len(whole.inputFiles())


def test_a_layer_is_replaced_whole_or_not_at_all(spark, tmp_path):
    from wardmetrics.sinks.writers import write_layer

    path = str(tmp_path / "layer")
    frame = spark.createDataFrame([(2020, "a"), (2021, "b")], "year int, v string")
    write_layer(frame, path, "year")
    broken = frame.withColumn("v", F.when(F.col("year") == 2021, F.raise_error(F.lit("died"))).otherwise(F.col("v")).cast("string"))
    with pytest.raises(Exception, match="died"):
        write_layer(broken, path, "year")
    assert rows(spark.read.parquet(path), "year", "v") == [(2020, "a"), (2021, "b")]
    write_layer(spark.read.parquet(path).filter("year = 2021"), path)  # from its own rows
    assert rows(spark.read.parquet(path), "year", "v") == [(2021, "b")]
    assert [p.name for p in tmp_path.iterdir() if p.name.startswith("_old")] == []


def test_a_named_batch_is_appended_once(spark, tmp_path, monkeypatch):
    from wardmetrics.sinks import writers

    path = str(tmp_path / "t")
    df = spark.createDataFrame([("1", datetime(2024, 1, 5, 3), '{"x": 1}')], "id string, day timestamp_ntz, j string")

    def append(batch, frame=df):
        append_events(frame, path, "j", "day", dry_run=False, batch=batch)

    def die(*args):
        raise KeyboardInterrupt

    append("a")
    monkeypatch.setattr(writers, "put_marker", die)
    with pytest.raises(KeyboardInterrupt):
        append("b")
    monkeypatch.undo()
    assert writers.read_appended(spark, path).count() == 1
    for batch in ("b", "a", "b", "c"):
        append(batch, df if batch != "c" else df.filter("id = 'none'"))
    got = writers.read_appended(spark, path)
    assert rows(got, "id", "day") == [("1", date(2024, 1, 5))] * 2 and got.select(F.variant_get("j", "$.x", "int")).first()[0] == 1
    with pytest.raises(FileNotFoundError):
        writers.read_appended(spark, str(tmp_path / "none"))
