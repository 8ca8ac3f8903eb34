"""Casts, names, raw grids and typed extracts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from wardmetrics.catalogue.registry import query
from wardmetrics.catalogue.tables import MESSY_SQL, messy_cells, table
from wardmetrics.functions.cast import cast_columns
from wardmetrics.functions.text import sanitise, slugify, standardise
from wardmetrics.operators.quality import cast_report
from wardmetrics.operators.quality import coerce_numeric as coerce
from wardmetrics.plans.layers import read_bronze, run_bronze
from wardmetrics.plans.metrics import compute_metrics
from wardmetrics.session import scratch_path
from wardmetrics.operators.dates import cast_by_order, date_orders
from wardmetrics.sources.raw import RawSource, extract, layout, scan_raw, skeleton
from wardmetrics.sources.tables import read_layer

_LINE = "l_orderkey:l l_linenumber:i l_partkey:l l_suppkey:l"


def _clean(spark, folder, column, kind):
    return cast_columns(messy_cells(spark, folder).withColumnRenamed(column, "value"), {"value": kind})


@query(f"{_LINE} value:l", MESSY_SQL + ", q AS (SELECT *, round_even(number, 0) AS value FROM numbers)")
def clean_int(spark, folder):
    return _clean(spark, folder, "amount", "INTEGER")


@query(f"{_LINE} value:d4", MESSY_SQL + ", q AS (SELECT *, number AS value FROM numbers)")
def clean_float(spark, folder):
    return _clean(spark, folder, "amount", "FLOAT")


@query(f"{_LINE} value:s", MESSY_SQL + ", q AS (SELECT *, label_text AS value FROM numbers)")
def clean_string(spark, folder):
    return _clean(spark, folder, "label", "STRING")


_DAY_SQL = "coalesce(try_strptime(trim(day), '%d/%m/%Y'), try_strptime(trim(day), '%Y-%m-%d'))"


@query(f"{_LINE} value:ts", MESSY_SQL + f", q AS (SELECT *, {_DAY_SQL} AS value FROM numbers)")
def clean_datetime(spark, folder):
    return _clean(spark, folder, "day", "DATETIME")


@query(f"{_LINE} value:t", MESSY_SQL + f", q AS (SELECT *, CAST({_DAY_SQL} AS DATE) AS value FROM numbers)")
def clean_date(spark, folder):
    return _clean(spark, folder, "day", "DATE")


@query(f"{_LINE} value:s", MESSY_SQL + """, q AS (SELECT *, CASE WHEN regexp_matches(clock, '^([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]$')
    THEN clock END AS value FROM numbers)""")
def clean_time(spark, folder):
    return _clean(spark, folder, "clock", "TIME")


@query("column:s raw_value:s problem:s n:l", MESSY_SQL + f""",
bad AS (SELECT 'amount' AS "column", amount_text AS raw_value, CASE WHEN amount_text IS NOT NULL AND number IS NULL THEN 'failed'
        WHEN number <> round_even(number, 0) THEN 'rounded' END AS problem FROM numbers
    UNION ALL SELECT 'day', trim(day), CASE WHEN trim(day) IS NOT NULL AND {_DAY_SQL} IS NULL THEN 'failed' END FROM numbers
    UNION ALL SELECT 'clock', clock, CASE WHEN NOT regexp_matches(clock, '^([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]$') THEN 'failed' END FROM numbers),
q AS (SELECT "column", raw_value, problem, count(*) AS n FROM bad WHERE problem IS NOT NULL GROUP BY ALL)""")
def cast_failures(spark, folder):
    """Every cell a cast lost or rounded, all columns in one scan."""
    return cast_report(messy_cells(spark, folder), {"amount": "INTEGER", "day": "DATETIME", "clock": "TIME", "label": "STRING"})


@query("l_orderkey:l l_linenumber:i l_partkey:l l_suppkey:l size:d4 label:s", """q AS (SELECT *,
    CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS size, l_returnflag || '1' AS label FROM lineitem)""")
def numeric_net(spark, folder):
    """Text columns that are all numbers become numbers, others stay text."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_quantity").cast("int").cast("string").alias("size"), F.concat("l_returnflag", F.lit("1")).alias("label"),
    )
    return coerce(lines)


# ---- names ------------------------------------------------------------------------


@query("page_id:l name:s", "q AS (SELECT page_id, regexp_replace(regexp_replace(replace(lower(url), ' ', '_'), '[^a-zA-Z0-9._-]', '_', 'g'), '_{2,}', '_', 'g') AS name FROM pages)")
def sanitise_names(spark, folder):
    return table(spark, folder, "pages").select("page_id", sanitise(F.col("url")).alias("name"))


@query("doc_id:l name:s", "q AS (SELECT doc_id, trim(replace(lower(text), ' and ', ' & '), ' ') AS name FROM documents)")
def standardise_keys(spark, folder):
    """Whole document texts in join-key form."""
    return table(spark, folder, "documents").select("doc_id", standardise(F.col("text")).alias("name"))


@query("p_partkey:l slug:s", "q AS (SELECT p_partkey, trim(regexp_replace(lower('- ' || p_brand || '  ' || p_name || ' /'), '[^a-z0-9]+', '_', 'g'), '_') AS slug FROM part)")
def slugs(spark, folder):
    text = F.concat(F.lit("- "), F.col("p_brand"), F.lit("  "), F.col("p_name"), F.lit(" /"))
    return table(spark, folder, "part").select("p_partkey", slugify(text).alias("slug"))


# ---- dates whose order only the whole column tells ---------------------------------

_WRITTEN_SQL = """written AS (SELECT o_orderkey, o_orderkey % 5 AS source, CASE WHEN o_orderkey % 5 = 3 THEN make_date(year(o_orderdate), month(o_orderdate), (day(o_orderdate) - 1) % 12 + 1)
    ELSE CAST(o_orderdate AS DATE) END AS day, o_custkey % 24 AS hour FROM orders)"""


def _written_dates(spark, folder):
    """Order dates as five sources write them: day first, month first with two-digit years, year first, days up to 12 only, with a zone."""
    day, source, key = F.to_date("o_orderdate"), F.col("o_orderkey") % 5, F.col("o_orderkey")
    early = F.make_date(F.year(day), F.month(day), (F.dayofmonth(day) - 1) % 12 + 1)
    clock = F.concat(F.lpad((F.col("o_custkey") % 24).cast("string"), 2, "0"), F.lit(":30"))
    text = (
        F.when(source == 0, F.date_format(day, "dd/MM/yyyy")).when(source == 1, F.date_format(day, "M-d-yy"))
        .when(source == 2, F.concat(F.date_format(day, "yyyy/MM/dd "), clock, F.lit(":15.250"))).when(source == 3, F.date_format(early, "d/M/yyyy"))
        .otherwise(F.concat(F.date_format(day, "yyyy-MM-dd'T'"), clock, F.lit(":00+00:00")))
    )
    return table(spark, folder, "orders").select(key, source.alias("source"), text.alias("day"))


@query("o_orderkey:l source:l day:ts", _WRITTEN_SQL + """, q AS (SELECT o_orderkey, source, CASE source WHEN 2 THEN CAST(day AS TIMESTAMP) + to_hours(hour) + INTERVAL '30 minutes 15.25 seconds'
    WHEN 4 THEN CAST(day AS TIMESTAMP) + to_hours(hour) + INTERVAL 30 MINUTE ELSE CAST(day AS TIMESTAMP) END AS day FROM written)""")
def date_cast_by_order(spark, folder):
    """Dates of each source read in the one order that all its cells allow."""
    return cast_by_order(_written_dates(spark, folder), {"day": "DATETIME"}, ["source"])[0]


@query("source:l column:s order:s", """q AS (SELECT unnest([0, 1, 2, 3, 4]) AS source, 'day' AS "column", unnest(['day', 'month', NULL, 'either', NULL]) AS "order")""")
def date_column_orders(spark, folder):
    """What each source's cells say about the order of day and month; one source leaves both."""
    return date_orders(_written_dates(spark, folder), ["day"], ["source"])


# ---- raw grids ------------------------------------------------------------------------

_BLOCK = 2000
_INGESTED = datetime(2026, 6, 13, 15, 30)


def _publish_orders(spark, folder) -> str:
    """Orders as headerless CSV files of ``_BLOCK`` records, one file per source, in key order."""
    path = scratch_path(spark, "orders-csv")
    o = table(spark, folder, "orders")
    text = o.select(
        F.col("o_orderkey").cast("string"),
        F.concat(F.lit("£"), F.col("o_totalprice").cast("decimal(18,2)").cast("string")),
        F.date_format("o_orderdate", "dd/MM/yyyy"),
        F.when(F.col("o_orderstatus") == "P", F.lit("[x]")).otherwise(F.col("o_orderstatus")),
        F.when(F.col("o_custkey") % 9 == 0, F.lit("NA")).otherwise(F.concat(F.lit("a, \"b\" "), F.col("o_custkey").cast("string"))),
        F.concat(F.lit("y"), F.floor(F.col("o_orderkey") / _BLOCK).cast("string")).alias("source"),
    )
    (
        text.repartition("source").sortWithinPartitions("source", F.col("o_orderkey").cast("bigint"))
        .write.partitionBy("source").option("header", False).option("escape", '"').csv(path)
    )
    return path


def raw_orders(spark, folder):
    """The published files scanned back as a raw grid with audit columns."""
    path = _publish_orders(spark, folder)
    return scan_raw(spark, [RawSource(path, "orders")], width=5, ingested_at=_INGESTED)


_RAW_SQL = f"""cells AS (SELECT o_orderkey, floor(o_orderkey / {_BLOCK}) AS source,
    CAST(o_orderkey AS VARCHAR) AS col_0, '£' || printf('%.2f', o_totalprice) AS col_1, strftime(o_orderdate, '%d/%m/%Y') AS col_2,
    CASE WHEN o_orderstatus = 'P' THEN '[x]' ELSE o_orderstatus END AS col_3,
    CASE WHEN o_custkey % 9 = 0 THEN NULL ELSE 'a, "b" ' || o_custkey END AS col_4, o_totalprice, o_orderdate, o_orderstatus FROM orders),
raw AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY o_orderkey) - 1 AS _row_number FROM cells)"""


@query("col_0:s col_1:s col_2:s col_3:s col_4:s _source_file:s _sheet_name:s _ingested_at:ts _row_number:l", _RAW_SQL + """,
q AS (SELECT *, 'orders' AS _source_file, 'na' AS _sheet_name, TIMESTAMP '2026-06-13 00:00:00' AS _ingested_at FROM raw)""")
def raw_scan(spark, folder):
    """Text cells, audit columns and each row's number in its own file."""
    return raw_orders(spark, folder)


# Records of one file whose cells hold line breaks; a file is read in as many ranges as it has splits.
_LARGE_BLOCK = 1_000_000


@query("col_0:s col_1:s col_2:s col_3:s _row_number:l year_name:s", f"""cells AS (SELECT o_orderkey, floor(o_orderkey / {_LARGE_BLOCK}) AS source, CAST(o_orderkey AS VARCHAR) AS col_0,
    'status "' || o_orderstatus || '",' || chr(10) || chr(10) || o_orderpriority AS col_1, CASE WHEN o_custkey % 7 = 0 THEN 'in 5" steps' ELSE CAST(o_custkey AS VARCHAR) END AS col_2,
    CASE WHEN o_custkey % 5 > 0 THEN repeat('x' || chr(10), CAST(o_custkey % 40 AS INTEGER)) || 'end' END AS col_3 FROM orders),
q AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY o_orderkey) - 1 AS _row_number, '2026' AS year_name FROM cells)""")
def raw_scan_multiline(spark, folder):
    """Files whose quoted cells hold line breaks, read in ranges: cells, and each record's number in its file."""
    path = scratch_path(spark, "multiline-csv")
    key, customer = F.col("o_orderkey"), F.col("o_custkey")

    def quoted(text):
        return F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))

    line = F.concat_ws(
        ",", key.cast("string"), quoted(F.concat(F.lit('status "'), "o_orderstatus", F.lit('",\n\n'), "o_orderpriority")),
        F.when(customer % 7 == 0, F.lit('in 5" steps')).otherwise(customer.cast("string")),
        F.when(customer % 5 > 0, quoted(F.concat(F.repeat(F.lit("x\n"), (customer % 40).cast("int")), F.lit("end")))).otherwise(F.lit("")),
    )
    text = table(spark, folder, "orders").select(F.floor(key / _LARGE_BLOCK).alias("source"), key, line.alias("line"))
    text.repartition("source").sortWithinPartitions("source", "o_orderkey").select("source", "line").write.partitionBy("source").text(path)
    return scan_raw(spark, [RawSource(path, "orders", "2026")], width=4, multi_line=True)


_ORDER_LAYOUT_FIELDS = [
    (0, "id", "INTEGER"),
    (2, "date", "DATETIME"),
    (1, "price", "FLOAT"),
    (3, "status", "STRING"),
    (8, "_row_number", "INTEGER"),
]


@query("id:l date:ts price:d2 status:s _row_number:l year_name:s", _RAW_SQL + """,
q AS (SELECT o_orderkey AS id, o_orderdate AS date, o_totalprice AS price, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status,
    _row_number, '2026' AS year_name FROM raw WHERE _row_number >= 10 AND _row_number < 1990 AND o_totalprice > 1000)""")
def positional_extract(spark, folder):
    """Record range, positions, casts and a filter over raw files; the year label last."""
    spec = layout("orders", 11, 1991, _ORDER_LAYOUT_FIELDS, [lambda df: df.filter("price > 1000")])
    return extract(raw_orders(spark, folder), spec, year="2026")


@query("id:l date:ts price:d2 status:s _row_number:l year_name:s", _RAW_SQL + """,
q AS (SELECT o_orderkey AS id, o_orderdate AS date, o_totalprice AS price, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status,
    _row_number, '2026' AS year_name FROM raw WHERE _row_number >= 10 AND _row_number < 1990 AND o_totalprice > 1000)""")
def bronze_row_range(spark, folder):
    """The same extract from a bronze table, opening only files that hold a record of the range."""
    spec = layout("orders", 11, 1991, _ORDER_LAYOUT_FIELDS, [lambda df: df.filter("price > 1000")])
    bronze = run_bronze(spark, [RawSource(_publish_orders(spark, folder), "orders", "2026")], scratch_path(spark, "bronze"), "orders", widths={"orders": 5})
    return extract(read_bronze(spark, bronze.written["orders"], spec), spec)


@query("o_orderpriority:s orders:l", "q AS (SELECT o_orderpriority, count(*) AS orders FROM orders GROUP BY o_orderpriority)")
def layer_table_scan(spark, folder):
    """A layer table read by path, pruned to one column."""
    return compute_metrics(
        read_layer(spark, f"{folder.rstrip('/')}/orders.parquet"),
        {"groupby_cols": ["o_orderpriority"], "use_size": True, "rename_cols": {"size": "orders"}},
    )


@query("borough_name:s ons_code:s", "q AS (SELECT c_name AS borough_name, CAST(c_custkey AS VARCHAR) AS ons_code FROM customer)")
def skeleton_scan(spark, folder):
    """Leading columns of a CSV with header, by position, as strings, renamed."""
    path = scratch_path(spark, "skeleton")
    table(spark, folder, "customer").select("c_name", "c_custkey", "c_acctbal").write.option("header", True).csv(path)
    return skeleton(spark, path, ["borough_name", "ons_code"])
