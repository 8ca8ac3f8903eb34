from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from wardmetrics.functions.cast import clean_cast
from wardmetrics.functions.text import category_group, presence_text, sanitise, sanitise_name, slugify, standardise
from wardmetrics.operators.quality import cast_report, coerce_numeric


def cast_all(spark, values, kind, **options):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.select(clean_cast(F.col("v"), kind, **options), "i").orderBy("i").collect()]


def test_integer_rules(spark):
    raw = ["1,234", "£5.5", "12-13", "1e5", " 2.5 ", "3.5", "[x]", "-", "nan", "", None, "(7)", "-8", "9.", "1" * 30]
    assert cast_all(spark, raw, "INTEGER") == [1234, 6, None, 15, 2, 4, None, None, None, None, None, 7, -8, 9, None]
    assert cast_all(spark, ["1e5", "£1,000"], "INTEGER", scientific=True) == [100000, 1000]


def test_float_and_string_rules(spark):
    assert cast_all(spark, ["£1,234.50", "[c]", "Null", "null", "-0.5%"], "FLOAT") == [1234.5, None, None, None, -0.5]
    assert cast_all(spark, ["  a ", " b\t", "[z]", "None", "none"], "STRING") == ["a", "b", None, None, "none"]


def test_dates_are_day_first_but_iso_is_iso(spark):
    raw = ["2021-03-04", "04/03/2021", "4/3/2021", "2021-03-04 10:11:12", "31/02/2021", "soon", "5 Mar 2021"]
    noon = datetime(2021, 3, 4)
    assert cast_all(spark, raw, "DATETIME") == [noon, noon, noon, datetime(2021, 3, 4, 10, 11, 12), None, None, datetime(2021, 3, 5)]
    assert cast_all(spark, ["04/03/2021"], "DATE") == [date(2021, 3, 4)]


def test_time_and_unknown_types(spark):
    assert cast_all(spark, ["23:59:59", "24:00:00", "1:02:03", "12:60:00"], "TIME") == ["23:59:59", None, None, None]
    with pytest.raises(ValueError):
        clean_cast(F.col("v"), "MONEY")
    assert cast_all(spark, [" x "], "MONEY", on_unknown="string") == ["x"]


def test_cast_report(spark):
    df = spark.createDataFrame([("12-13", "x"), ("12-13", "2020-01-01"), ("[x]", None), ("1.5", "-")], "n string, d string")
    got = rows(cast_report(df, {"n": "INTEGER", "d": "DATE"}))
    assert got == [("d", "x", "failed", 1), ("n", "1.5", "rounded", 1), ("n", "12-13", "failed", 2)]


def test_names(spark):
    df = spark.createDataFrame([("Barking and Dagenham ", "criminal-damage arson!")], "a string, b string")
    got = df.select(standardise(F.col("a")), sanitise(F.col("b")), slugify(F.col("b"))).first()
    assert tuple(got) == ("barking & dagenham", "criminal-damage_arson_", "criminal_damage_arson")
    assert sanitise_name("My  Project (v1.2)") == "my_project_v1.2_"


def test_category_group_and_presence(spark):
    df = spark.createDataFrame([("a", "x ", 1, 0), ("zz", None, 0, 2), (None, "", 0, None)], "c string, t string, n int, m int")
    text = presence_text(F.col("t"), [(F.col("n"), "N"), (F.col("m"), "M")])
    got = df.select(category_group(F.col("c"), {"a": "A"}), text).collect()
    assert [tuple(r) for r in got] == [("A", "x, N"), ("Other", "M"), ("Other", "None")]


def test_coerce_numeric_only_where_nothing_is_lost(spark):
    df = spark.createDataFrame([("1", "1", "a"), ("2.5", None, "b"), (None, "x", "3")], "n string, mixed string, borough_name string")
    assert coerce_numeric(df).dtypes == [("n", "double"), ("mixed", "string"), ("borough_name", "string")]


def test_date_shapes(spark):
    from datetime import datetime

    from wardmetrics.functions.cast import clean_cast

    cases = {
        "2024/03/05": datetime(2024, 3, 5), "2024-3-5": datetime(2024, 3, 5), "2024-03-05 10:20": datetime(2024, 3, 5, 10, 20), "05/03/24": datetime(2024, 3, 5),
        "05/03/69": datetime(1969, 3, 5), "5-3-68": datetime(2068, 3, 5), "2024-03-05T10:20:30.25": datetime(2024, 3, 5, 10, 20, 30, 250000),
        "2024-03-05 10:20:30.123456789": datetime(2024, 3, 5, 10, 20, 30, 123456), "2024-03-05T10:20:30Z": datetime(2024, 3, 5, 10, 20, 30),
        "2024-03-05T10:20:30+01:00": datetime(2024, 3, 5, 9, 20, 30), "2024/03/05 10:20 -0230": datetime(2024, 3, 5, 12, 50), "05/03/2024 23:59": datetime(2024, 3, 5, 23, 59),
        "5 Mar 2024": datetime(2024, 3, 5), "15 March 2024": datetime(2024, 3, 15), "31/02/2024": None, "13/13/2024": None, "2024-03/05": None, "5/3-2024": None,
        "5/3/202": None, "week 5": None, "2024-03-05T25:00:00": None, "12/25/2024": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r["t"]: r["d"] for r in df.select("t", clean_cast(F.col("t"), "DATETIME").alias("d")).collect()} == cases


def test_order_of_day_and_month_is_learned_per_source_and_column(spark):
    from datetime import date

    from wardmetrics.operators.dates import cast_by_order, date_orders

    data = [
        ("uk", "25/12/2020", "01/02/2020", "x"), ("uk", "01/02/2020", None, "y"), ("us", "12/25/2020", "1/2/20", "z"), ("us", "01/02/2020", "03/04/2020", "z"),
        ("iso", "2020-01-02", "[x]", "z"), ("mixed", "25/12/2020", "-", "z"), ("mixed", "12/25/2020", "5 Mar 2020", "z"), (None, "12/31/2020", "31/12/2020", "z"),
    ]
    df = spark.createDataFrame(data, "source string, a string, b string, c string")
    types = {"a": "DATE", "b": "DATE", "c": "STRING"}
    cast, learned = cast_by_order(df, types, ["source"])
    told = {(r["source"], r["column"]): r["order"] for r in learned.collect()}
    assert told == {
        ("uk", "a"): "day", ("uk", "b"): "either", ("us", "a"): "month", ("us", "b"): "either", ("iso", "a"): None, ("iso", "b"): None,
        ("mixed", "a"): "neither", ("mixed", "b"): None, (None, "a"): "month", (None, "b"): "day",
    }
    got = sorted(((r["source"] or "", r["a"], r["b"]) for r in cast.collect()), key=str)
    assert got == sorted([
        ("uk", date(2020, 12, 25), date(2020, 2, 1)), ("uk", date(2020, 2, 1), None), ("us", date(2020, 12, 25), date(2020, 2, 1)), ("us", date(2020, 1, 2), date(2020, 4, 3)),
        ("iso", date(2020, 1, 2), None), ("mixed", date(2020, 12, 25), None), ("mixed", None, date(2020, 3, 5)), ("", date(2020, 12, 31), date(2020, 12, 31)),
    ], key=str)
    assert cast.columns == df.columns
    whole, learned = cast_by_order(df.filter("source = 'us'"), types)
    assert sorted(r["a"] for r in whole.collect()) == [date(2020, 1, 2), date(2020, 12, 25)] and learned.columns == ["column", "order"]
    assert date_orders(df.limit(0), ["a"], ["source"]).count() == 0
