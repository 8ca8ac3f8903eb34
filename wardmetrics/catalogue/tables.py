"""Test tables in the roles of the domains: entities, events, measures, points."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmetrics.session import written

PRIORITIES = ["urgent", "high", "medium", "not_specified", "low"]

PRIORITY_GROUPS = {"URGENT": "Pressing", "HIGH": "Pressing", "MEDIUM": "Routine", "LOW": "Routine"}

GROUP_SQL = """CASE category WHEN 'URGENT' THEN 'Pressing' WHEN 'HIGH' THEN 'Pressing'
    WHEN 'MEDIUM' THEN 'Routine' WHEN 'LOW' THEN 'Routine' ELSE 'Other' END"""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def entities(spark: SparkSession, folder: str) -> DataFrame:
    """Grain table: nations as boroughs."""
    return table(spark, folder, "nation").select(
        F.col("n_name").alias("borough_name"), F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("ons_code")
    )


ENTITIES_SQL = "entities AS (SELECT n_name AS borough_name, 'N' || n_nationkey AS ons_code FROM nation)"


def priority_events(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as dated, categorised events of a nation."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice",
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        F.regexp_replace("o_orderpriority", "^[0-9]-", "").alias("category"),
    )
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("borough"))
    return (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", "o_custkey", "o_totalprice", "year", "month", "category", "borough",
                F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("ons_code"))
    )


EVENTS_SQL = """order_events AS (
    SELECT o_orderkey, o_custkey, o_totalprice, year(o_orderdate) AS year, month(o_orderdate) AS month,
           regexp_replace(o_orderpriority, '^[0-9]-', '') AS category, n_name AS borough, 'N' || c_nationkey AS ons_code
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""

ROLLUP_SQL = EVENTS_SQL + """,
monthly AS (SELECT year, month, borough, category, count(*) AS n FROM order_events WHERE category IS NOT NULL
    GROUP BY year, month, borough, category),
rolled AS (SELECT year, borough, category, sum(n) AS total_count, count(DISTINCT month) AS months_present,
    CAST(sum(n) AS DOUBLE) / count(DISTINCT month) * 12 AS annualised_rate,
    """ + GROUP_SQL + """ AS analytical_category FROM monthly GROUP BY year, borough, category)"""


POPULATION_SQL = "population AS (SELECT ons_code, year, count(DISTINCT o_custkey) AS population FROM order_events GROUP BY ons_code, year)"


def yearly_measures(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Five measure tables per nation code and year, in the roles of the housing tables."""
    money = F.col("o_totalprice").cast("decimal(18,2)")
    year_name = F.col("year").cast("string").alias("year_name")
    # One pass over the events: all measures of a code and year, written once, then five projections.
    measures = written(priority_events(spark, folder).groupBy("ons_code", "year").agg(
        F.count(F.lit(1)).cast("double").alias("total_dwellings"),
        F.count_if(F.col("category") == "URGENT").alias("total"),
        F.floor(F.sum(money) / 1000000).cast("bigint").alias("band_d"),
        F.max(money).cast("double").alias("average_price"),
        (F.count_if(F.col("category").isin("HIGH", "LOW")) - 3).cast("double").alias("net_additions"),
    ), "yearly-measures")
    return {
        "housing_stock": measures.select("ons_code", "total_dwellings", year_name),
        "affordable_stock_additions": measures.select("ons_code", "total", year_name),
        "council_tax_bands": measures.select("ons_code", "band_d", year_name),
        "average_house_price": measures.select("ons_code", "average_price", F.make_date("year", F.lit(1), F.lit(1)).alias("date")),
        "net_housing_additions": measures.select("ons_code", "net_additions", "year"),
    }


MEASURES_SQL = EVENTS_SQL + """,
measures AS (SELECT ons_code, year, CAST(count(*) AS DOUBLE) AS total_dwellings,
    count(*) FILTER (WHERE category = 'URGENT') AS total,
    CAST(floor(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / 1000000) AS BIGINT) AS band_d,
    CAST(max(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS average_price,
    CAST(count(*) FILTER (WHERE category IN ('HIGH', 'LOW')) - 3 AS DOUBLE) AS net_additions
    FROM order_events GROUP BY ons_code, year)"""


def messy_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as the text cells of a published sheet: tokens, signs, separators, blanks."""
    n = F.col("l_linenumber")
    price = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    amount = (
        F.when(n == 1, F.concat(F.lit("£"), price))
        .when(n == 2, F.regexp_replace(price, "^([0-9]+)([0-9]{3}[.])", "$1,$2"))
        .when(n == 3, F.lit("[x]"))
        .when(n == 4, F.concat(F.lit("  "), price, F.lit(" ")))
        .when(n == 5, F.lit("-"))
        .when(n == 6, F.concat(F.lit("12-"), F.col("l_partkey").cast("string")))
        .otherwise(F.lit(" nan "))
    )
    day = (
        F.when(n % 3 == 0, F.date_format("l_shipdate", "dd/MM/yyyy"))
        .when(n % 3 == 1, F.date_format("l_shipdate", "yyyy-MM-dd"))
        .otherwise(F.concat(F.lit("week "), F.col("l_quantity").cast("int").cast("string")))
    )
    clock = F.concat_ws(":", *[
        F.lpad(part.cast("string"), 2, "0") for part in (F.col("l_quantity").cast("int") % 30, F.col("l_partkey") % 70, n)
    ])
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        amount.alias("amount"), day.alias("day"), clock.alias("clock"),
        F.concat(F.lit(" "), F.when(n == 7, F.lit("[c]")).otherwise(F.concat(F.col("l_returnflag"), F.col("l_linestatus"))), F.lit(" ")).alias("label"),
    )


MESSY_SQL = """messy AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CASE l_linenumber WHEN 1 THEN '£' || printf('%.2f', l_extendedprice)
        WHEN 2 THEN regexp_replace(printf('%.2f', l_extendedprice), '^([0-9]+)([0-9]{3}[.])', '\\1,\\2')
        WHEN 3 THEN '[x]' WHEN 4 THEN '  ' || printf('%.2f', l_extendedprice) || ' ' WHEN 5 THEN '-'
        WHEN 6 THEN '12-' || l_partkey ELSE ' nan ' END AS amount,
    CASE l_linenumber % 3 WHEN 0 THEN strftime(l_shipdate, '%d/%m/%Y') WHEN 1 THEN strftime(l_shipdate, '%Y-%m-%d')
        ELSE 'week ' || CAST(l_quantity AS INTEGER) END AS day,
    printf('%02d:%02d:%02d', CAST(l_quantity AS INTEGER) % 30, CAST(l_partkey % 70 AS INTEGER), l_linenumber) AS clock,
    ' ' || CASE l_linenumber WHEN 7 THEN '[c]' ELSE l_returnflag || l_linestatus END || ' ' AS label FROM lineitem),
tokens AS (SELECT *, CASE WHEN trim(amount) IN ('', 'nan', 'None', 'null', '[x]', '[c]', '[z]', '-') THEN NULL ELSE trim(amount) END AS amount_text,
    CASE WHEN trim(label) IN ('', 'nan', 'None', 'null', '[x]', '[c]', '[z]', '-') THEN NULL ELSE trim(label) END AS label_text FROM messy),
numbers AS (SELECT *, TRY_CAST(regexp_replace(amount_text, '[^0-9.-]', '', 'g') AS DOUBLE) AS number FROM tokens)"""


def grid_points(spark: SparkSession, folder: str) -> DataFrame:
    """Events as British grid points spread over a town's extent."""
    e = table(spark, folder, "events")
    return e.select(
        "event_id", "event_type",
        (F.lit(503000.0) + F.col("event_id") * 7919 % 58000).alias("X"),
        (F.lit(156000.0) + F.col("event_id") * 104729 % 44000).alias("Y"),
    )


POINTS_SQL = """points AS (SELECT event_id, event_type, 503000.0 + event_id * 7919 % 58000 AS "X",
    156000.0 + event_id * 104729 % 44000 AS "Y" FROM events)"""
