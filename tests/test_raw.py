import csv
import json
import random
from contextlib import contextmanager
from datetime import datetime

import pytest
from conftest import rows

from wardmetrics.operators.filters import keep_values
from wardmetrics.operators.reshape import unpivot_years
from pyspark.sql import functions as F

from wardmetrics.session import written
from wardmetrics.sources import ranges
from wardmetrics.sources.events import array_objects, scan_events, sound_files
from wardmetrics.sources.raw import IngestReport, RawSource, extract, grid_width, layout, left_out, scan_raw, skeleton, with_audit

SHEET = '''Title row,,
"a cell
of two lines, quoted ""so""",x,1
name,amount
E1,"1,234",NA
E2,[x],12-13,extra
E3,£5.5, nan
'''


@pytest.fixture
def sheet(tmp_path):
    path = tmp_path / "a b.csv"
    path.write_text(SHEET)
    return str(path)


def test_records_not_lines_and_ragged_rows(spark, sheet):
    report = IngestReport()
    raw = scan_raw(spark, [RawSource(sheet, "t", "2024", "S 1"), RawSource(sheet + ".gone", "t")], multi_line=True,
                   ingested_at=datetime(2026, 6, 13, 9), report=report)
    assert raw.columns == ["col_0", "col_1", "col_2", "col_3", "_source_file", "_sheet_name", "_ingested_at", "_row_number", "year_name"]
    got = [tuple(r) for r in raw.orderBy("_row_number").collect()]
    assert [r[7] for r in got] == [0, 1, 2, 3, 4, 5]
    assert got[1][0] == 'a cell\nof two lines, quoted "so"'
    assert got[3][:4] == ("E1", "1,234", None, None)
    assert got[4][3] == "extra" and got[4][4:7] == ("t", "S 1", datetime(2026, 6, 13))
    assert report.skipped[0][0].endswith(".gone") and len(report.loaded) == 1


def test_extract_range_types_filter_and_year(spark, sheet):
    raw = scan_raw(spark, [RawSource(sheet, "t", "2024")], multi_line=True)
    spec = layout("t", 4, 7, [(1, "amount", "INTEGER"), (0, "code"), (7, "_row_number", "INTEGER")], [keep_values("code", ["E1", "E3"])])
    out = extract(raw, spec)
    assert out.columns == ["amount", "code", "_row_number", "year_name"]
    assert rows(out) == [(1234, "E1", 3, "2024"), (6, "E3", 5, "2024")]
    assert rows(extract(raw, spec, year="9"), "year_name") == [("9",), ("9",)]


def test_layout_is_checked():
    with pytest.raises(ValueError):
        layout("t", 5, 5, [(0, "a")])
    with pytest.raises(ValueError):
        layout("t", 0, 5, [(0, "a", "MONEY")])
    with pytest.raises(ValueError):
        layout("t", 0, 5, [(0, "a"), (1, "a")])


def test_position_past_the_grid(spark, sheet):
    raw = scan_raw(spark, [RawSource(sheet, "t")], multi_line=True)
    with pytest.raises(ValueError, match="far"):
        extract(raw, layout("t", 0, 5, [(99, "far")]))


def test_row_numbers_over_many_splits(spark, tmp_path):
    big, small = tmp_path / "big.csv", tmp_path / "small.csv"
    big.write_text("".join(f"{i},v{i}\n" for i in range(60000)))
    small.write_text("".join(f"{i},w{i}\n" for i in range(500)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        raw = scan_raw(spark, [RawSource(str(big), "big", "1"), RawSource(str(small), "small", "1")])
        assert raw.count() == 60500
        assert raw.filter("cast(col_0 as bigint) <> _row_number").count() == 0
        assert rows(raw.groupBy("_source_file").count()) == [("big", 60000), ("small", 500)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_rows_are_not_shuffled_for_numbering(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("1,2\n3,4\n")
    plan = scan_raw(spark, [RawSource(str(path), "t")], width=2)._jdf.queryExecution().executedPlan().toString()
    main = plan.split("BroadcastExchange")[0]
    assert "Exchange hashpartitioning" not in main and "BroadcastHashJoin" in main


def test_two_sheets_of_one_year_are_both_kept(spark, tmp_path):
    for name in ("s1", "s2"):
        (tmp_path / f"{name}.csv").write_text("x,1\n")
    raw = scan_raw(spark, [RawSource(str(tmp_path / f"{s}.csv"), "t", "2024", s) for s in ("s1", "s2")])
    assert rows(raw, "_sheet_name", "year_name") == [("s1", "2024"), ("s2", "2024")]


def test_no_source_at_all(spark):
    with pytest.raises(FileNotFoundError):
        scan_raw(spark, [RawSource("/no/such/file.csv", "t")])


def test_width_counts_only_separators(spark, tmp_path):
    path = tmp_path / "w.csv"
    path.write_text('"a,b,c,d,e",1\n1,2,3\n')
    assert grid_width(spark, [str(path)]) == 3


def test_audit_overwrites_in_place(spark):
    df = spark.createDataFrame([(1, "old", 5)], "a int, _source_file string, _row_number bigint")
    out = with_audit(df, "new", existing=True)
    assert out.columns[:3] == ["a", "_source_file", "_row_number"]
    assert out.first()["_source_file"] == "new" and out.first()["_sheet_name"] == "na"


def test_skeleton(spark, tmp_path):
    path = tmp_path / "skeleton.csv"
    path.write_text("Borough,Code,Other\nBarnet,007,1\n")
    assert rows(skeleton(spark, str(path), ["borough_name", "ons_code"])) == [("Barnet", "007")]
    with pytest.raises(ValueError):
        skeleton(spark, str(path), ["a", "b", "c", "d"])
    with pytest.raises(FileNotFoundError):
        skeleton(spark, str(tmp_path / "none.csv"), ["a"])
    with pytest.raises(ValueError, match="rename"):
        skeleton(spark, str(tmp_path / "_skeleton.csv"), ["a"])


def test_event_files(spark, tmp_path):
    folder = tmp_path / "year=2024" / "month=03"
    folder.mkdir(parents=True)
    (folder / "Barking & Dagenham.json").write_text('[{"id": 1, "category": "x", "more": {"a": 1}}, {"id": 2, "category": null}]')
    (folder / "A+B.json").write_text('[{"id": 3, "category": "y"}]')
    (folder / "Empty.json").write_text("[]")
    got = rows(scan_events(spark, str(tmp_path)), "borough", "id", "category", "year", "month")
    assert got == [("A+B", "3", "y", 2024, 3), ("Barking & Dagenham", "1", "x", 2024, 3), ("Barking & Dagenham", "2", None, 2024, 3)]


def test_unpivot_keeps_null_values(spark):
    df = spark.createDataFrame([("a", 1.0, None)], "ons_code string, `2021` double, `2022` double")
    assert rows(unpivot_years(df)) == [("a", 2021, 1.0), ("a", 2022, None)]


def test_wide_budget_sheet(spark, tmp_path):
    """The 212-column sheet: title lines, a two-line cell, tokens, a header inside the data."""
    from wardmetrics.plans.domains import BUDGET_LAYOUT
    from wardmetrics.plans.layers import SheetFiles, budget_tables
    from wardmetrics.sinks.writers import write_layer

    width = 212
    lines = ["Title" + "," * (width - 1)] * 9 + ['"two\nlines"' + "," * (width - 1)]
    for n in range(413):
        cells = [""] * width
        cells[1] = f"E090000{n:02d}" if n < 34 else f"E07{n:06d}"
        cells[2], cells[12], cells[28] = f"Area {n}", f'"1,{n:03d}.5"' if n % 2 else "[x]", "-"
        lines.append(",".join(cells))
    lines.append("after" + "," * (width - 1))
    path = tmp_path / "sheet.csv"
    path.write_text("\n".join(lines) + "\n")
    raw = scan_raw(spark, [RawSource(str(path), "budget", sheet="3")], multi_line=True)
    assert len(raw.columns) == width + 5
    older, newer = str(tmp_path / "ingestion_3-2026-01-01"), write_layer(raw, str(tmp_path / "ingestion_3-2026-02-01"))
    out = budget_tables(spark, [SheetFiles("3", [newer, older]), SheetFiles("4")])
    assert out.count() == 33 and out.filter("total_highways_and_transport_services is not null").count() == 0
    got = rows(out.filter("ons_code = 'E09000001'"), "total_education_services", "_row_number", "_sheet_name", "source_sheet")
    assert got == [(1001.5, 11, "3", "3")]


def test_records_wider_than_given_are_not_cut(spark, tmp_path):
    (tmp_path / "f.csv").write_text("1,2,3\n4,5,6,7,8\n")
    raw = scan_raw(spark, [RawSource(str(tmp_path / "f.csv"), "t", "2020")], width=3)
    with pytest.raises(Exception, match="wider than 3"):
        raw.collect()
    assert scan_raw(spark, [RawSource(str(tmp_path / "f.csv"), "t", "2020")]).count() == 2


def test_layout_without_an_end_and_what_a_range_leaves_out(spark, tmp_path):
    (tmp_path / "f.csv").write_text("".join(f"{i}\n" for i in range(10)))
    raw = scan_raw(spark, [RawSource(str(tmp_path / "f.csv"), "t", "2020")], width=1)
    open_end, closed = layout("t", 3, None, [(0, "n", "INTEGER")]), layout("t", 3, 6, [(0, "n", "INTEGER")])
    assert rows(extract(raw, open_end).select("n")) == [(i,) for i in range(2, 10)]
    assert rows(extract(raw, closed).select("n")) == [(2,), (3,), (4,)]
    assert rows(left_out(raw, closed).select("before", "behind")) == [(2, 5)]
    assert rows(left_out(raw, open_end).select("before", "behind")) == [(2, 0)]


@pytest.mark.parametrize("select", [["*"], ["col_1", "col_2"], ["_row_number"]])
@pytest.mark.parametrize("record", ["4,5,6,,8", "4,5,6,7,8", "4,5,6,", '"4,4",5,6,"7"'])
def test_a_wide_record_ends_the_job_whatever_is_read(spark, tmp_path, record, select):
    (tmp_path / "f.csv").write_text(f"1,2,3\n{record}\n")
    for lines in (False, True):
        raw = scan_raw(spark, [RawSource(str(tmp_path / "f.csv"), "t", "2020")], width=3, multi_line=lines)
        with pytest.raises(Exception, match="wider than 3"):
            raw.select(*select).collect()
        spec = layout("t", 1, 3, [(1, "b")])
        with pytest.raises(Exception, match="wider than 3"):
            extract(raw, spec).collect()


def test_records_as_wide_as_given_and_quotes_inside_cells(spark, tmp_path):
    (tmp_path / "f.csv").write_text('1,2,3\n"a,b",5" pipe,"6 ""x"", y"\n7\n\n')
    raw = scan_raw(spark, [RawSource(str(tmp_path / "f.csv"), "t", "2020")], width=3)
    assert rows(raw, "col_0", "col_1", "col_2") == [("1", "2", "3"), ("7", None, None), ("a,b", '5" pipe', '6 "x", y')]


# ---- files cut anywhere

@contextmanager
def splits_of(spark, size):
    names = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def quoted_file(path, rng, end):
    cells = ['"a\nb, ""q""\n\nc"', '"x,y"', "", 'in 5" pipe', '"' + "long\n" * 40 + '"', '"open, ""', "7", '""', "plain text"]
    cells[5] = '"say ""yes"""'
    with open(path, "w", newline="") as out:
        for i in range(60):
            out.write(",".join([str(i), *rng.choices(cells, k=rng.randint(0, 4))]).replace("\n", end) + end)
            if rng.random() < 0.1:
                out.write(end)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [53, 900, 10_000_000])
def test_quoted_files_cut_anywhere_read_as_if_whole(spark, tmp_path, size, end):
    rng = random.Random(size)
    paths = [str(tmp_path / f"f{i}.csv") for i in range(3)]
    for path in paths:
        quoted_file(path, rng, end)
    with splits_of(spark, size):
        raw = scan_raw(spark, [RawSource(p, f"t{i}", str(i)) for i, p in enumerate(paths)], multi_line=True, null_cells=())
        cells = [c for c in raw.columns if c.startswith("col_")]
        found = {}
        for r in raw.select("_source_file", "_row_number", *cells).collect():
            found[r[0], r[1]] = [c or "" for c in r[2:]]
    for i, path in enumerate(paths):
        with open(path, newline="") as text:
            expected = [r for r in csv.reader(text) if r]
        got = [found[f"t{i}", n] for n in range(len(expected))]
        assert [[c.replace("\r\n", "\n") for c in g[: len(e)]] for g, e in zip(got, expected)] == [[c.replace("\r\n", "\n") for c in e] for e in expected]
    assert len(found) == 180


def test_ranges_give_the_cells_and_numbers_of_one_task(spark, tmp_path):
    quoted_file(tmp_path / "f.csv", random.Random(4), "\n")
    schema = ", ".join(f"col_{i} string" for i in range(5))
    whole = spark.read.schema(schema).option("multiLine", True).option("quote", '"').option("escape", '"').csv(str(tmp_path / "f.csv")).coalesce(1)
    whole = rows(whole.withColumn("_row_number", F.monotonically_increasing_id()))
    with splits_of(spark, 100):
        raw = scan_raw(spark, [RawSource(str(tmp_path / "f.csv"), "t")], width=5, multi_line=True, null_cells=())
        assert rows(raw, "col_0", "col_1", "col_2", "col_3", "col_4", "_row_number") == whole


def test_a_cell_longer_than_many_ranges_and_one_left_open(spark, tmp_path):
    (tmp_path / "a.csv").write_text('1,"' + "x\n" * 3000 + '",2\n3,4,5\n')
    (tmp_path / "b.csv").write_text('6,7,8\n9,"open\nto the end\n')
    with splits_of(spark, 64):
        raw = scan_raw(spark, [RawSource(str(tmp_path / "a.csv"), "a"), RawSource(str(tmp_path / "b.csv"), "b")], width=3, multi_line=True)
        got = {(r["_source_file"], r["_row_number"]): r["col_1"] for r in raw.collect()}
    assert got["a", 0] == "x\n" * 3000 and got["a", 1] == "4" and got["b", 0] == "7" and got["b", 1].startswith("open\nto the end") and len(got) == 4


def test_lines_of_a_quoted_file_stay_where_they_are_read(spark, tmp_path):
    quoted_file(tmp_path / "f.csv", random.Random(6), "\n")
    with splits_of(spark, 400):
        pieces = ranges._pieces(spark, [str(tmp_path / "f.csv")], "\n")
        states = written(ranges.range_states(ranges._facts(pieces, ranges.CellRecords)), "states")
        plan = ranges._cut(pieces, states, ranges.CellRecords)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "Sort" not in plan and "hashpartitioning" not in plan
        # What follows reads the records as they were cut, and scans no line again.
        records = ranges.range_records(spark, [str(tmp_path / "f.csv")], ranges.CellRecords)
        assert "MapInArrow" not in records._jdf.queryExecution().executedPlan().toString() and records.count() == 60


def nested(rng, deep=0):
    kind = rng.randint(0, 6)
    if kind == 0 and deep < 4:
        return {"a": nested(rng, deep + 1), "}{": nested(rng, deep + 1)}
    if kind == 1 and deep < 4:
        return [nested(rng, deep + 1) for _ in range(rng.randint(0, 3))]
    return rng.choice([1, None, "x}y", "{[", 'q"}\\', "\\\\", "é]}", "long " * rng.randint(0, 40)])


@pytest.mark.parametrize("size", [41, 700, 10_000_000])
def test_array_files_cut_anywhere(spark, tmp_path, size):
    rng = random.Random(size)
    expected = {}
    for i, n in enumerate((0, 1, 30, 30)):
        records = [{"id": k, "v": nested(rng)} for k in range(n)] or []
        (tmp_path / f"f{i}.json").write_text(json.dumps(records, indent=[None, 1][i % 2], ensure_ascii=False) + ["", "\n", " \n "][i % 3])
        expected[f"f{i}.json"] = records
    (tmp_path / "long.json").write_text(json.dumps([{"id": 0, "v": "}" * 900}, {"id": 1}]))
    expected["long.json"] = [{"id": 0, "v": "}" * 900}, {"id": 1}]
    broken = ['[{"a":1},{oops}]', '[{"a":1}', '[{"a":1}]}', '{"a":1}', '[{"a":1} {"b":2}]', "nope", '[{"a":1},]', '[{"a":"x}]', '[{"a":1}] [{"a":2}]', "[1, 2]", ',{"a":1}]', '[{"a":1}]]']
    for i, text in enumerate(broken):
        (tmp_path / f"broken{i}.json").write_text(text)
    with splits_of(spark, size):
        objects = array_objects(spark, [str(tmp_path)]).withColumn("f", F.element_at(F.split("_source_path", "/"), -1)).cache()
        got = {}
        for r in objects.filter("fate = 'record'").collect():
            got.setdefault(r["f"], []).append(json.loads(r["record"]))
        sound = {r["_source_path"].rsplit("/", 1)[1] for r in sound_files(objects).filter("sound").collect()}
        objects.unpersist()
    assert sound == set(expected)
    for name, records in expected.items():
        assert sorted(got.get(name, []), key=str) == sorted(records, key=str)


def test_events_of_large_files_equal_those_read_whole(spark, tmp_path):
    folder = tmp_path / "year=2024" / "month=03"
    folder.mkdir(parents=True)
    rng = random.Random(9)
    (folder / "Barking & Dagenham.json").write_text(json.dumps([{"id": i, "category": rng.choice(["x}", "[y", None]), "more": nested(rng)} for i in range(300)]))
    (folder / "A+B.json").write_text('[{"id": 3, "category": "y"}]')
    (folder / "Broken.json").write_text('[{"id": 3, "category": "y"},' + " " * 2000)
    columns = ["borough", "id", "category", "year", "month"]
    whole = rows(scan_events(spark, str(tmp_path)).filter("borough <> 'Broken'"), *columns)
    with splits_of(spark, 500):
        split = scan_events(spark, str(tmp_path), whole_bytes=1000)
        assert rows(split.filter("borough <> 'Broken'"), *columns) == whole and len(whole) == 301
        assert rows(split.filter("borough = 'Broken'"), *columns) == [("Broken", None, None, 2024, 3)]
