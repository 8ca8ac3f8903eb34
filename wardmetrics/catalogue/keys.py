"""Filters, keyed joins, reshapes, upserts and constraint checks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from wardmetrics.catalogue.registry import query
from wardmetrics.catalogue.tables import (
    ENTITIES_SQL, EVENTS_SQL, MEASURES_SQL, entities, priority_events, table, yearly_measures,
)
from wardmetrics.operators.filters import anniversary as on_anniversary
from wardmetrics.operators.filters import keep_listed, keep_values
from wardmetrics.operators.filters import year_range as in_years
from wardmetrics.operators.joins import grain_merge, merge, merge_yearly
from wardmetrics.operators.quality import apply_defaults, duplicate_keys, null_counts, null_rows, orphan_keys, orphan_rows
from wardmetrics.operators.reshape import ensure_year, first_by_key, latest, union_all, unpivot_years
from wardmetrics.plans.domains import HOUSING_YEARS
from wardmetrics.plans.layers import rolled_up_events
from wardmetrics.plans.serving import constraint_report
from wardmetrics.sinks.upsert import entity_dimension as dimension_of
from wardmetrics.sinks.upsert import upsert
from wardmetrics.sources.raw import compose

# ---- filters ---------------------------------------------------------------------

_SEGMENTS = ["BUILDING", "MACHINERY", "no such segment"]


@query("c_custkey:l c_mktsegment:s", "q AS (SELECT * FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'no such segment'))")
def code_filter(spark, folder):
    return keep_values("c_mktsegment", _SEGMENTS)(table(spark, folder, "customer"))


@query("c_custkey:l c_nationkey:i", """q AS (SELECT * FROM customer WHERE c_nationkey IN
    (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000))""")
def listed_filter(spark, folder):
    """The kept values come from a table."""
    listed = table(spark, folder, "supplier").filter("s_acctbal > 5000")
    return keep_listed("c_nationkey", listed, "s_nationkey")(table(spark, folder, "customer"))


@query("o_orderkey:l year:i", "q AS (SELECT o_orderkey, year(o_orderdate) AS year FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1998)")
def year_range(spark, folder):
    years = table(spark, folder, "orders").withColumn("year", F.year("o_orderdate"))
    return in_years(1996, 1998)(years)


@query("o_orderkey:l date:ts", """q AS (SELECT o_orderkey, o_orderdate AS date FROM orders
    WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '2000-12-31' AND month(o_orderdate) = 1 AND day(o_orderdate) = 1)""")
def anniversary(spark, folder):
    dated = table(spark, folder, "orders").withColumnRenamed("o_orderdate", "date")
    return on_anniversary(date(1996, 1, 1), date(2000, 12, 31))(dated)


@query("borough:s o_orderkey:l year:i", EVENTS_SQL + ", q AS (SELECT * FROM order_events WHERE year BETWEEN 1997 AND 1999 AND borough IN ('NATION_3', 'NATION_4', 'NATION_21'))")
def filter_chain(spark, folder):
    """Filters composed and applied in order."""
    steps = [in_years(1997, 1999), keep_values("borough", ["NATION_3", "NATION_4", "NATION_21"])]
    return compose(steps)(priority_events(spark, folder))


@query("l_returnflag:s l_linestatus:s l_shipmonth:i", "q AS (SELECT DISTINCT l_returnflag, l_linestatus, month(l_shipdate) AS l_shipmonth FROM lineitem)")
def distinct_rows(spark, folder):
    lines = table(spark, folder, "lineitem")
    return lines.select("l_returnflag", "l_linestatus", F.month("l_shipdate").alias("l_shipmonth")).dropDuplicates()


# ---- joins -------------------------------------------------------------------------


@query("borough_name:s ons_code:s year:i total:d2 weight:l", EVENTS_SQL + ", " + ENTITIES_SQL + """,
grain AS (SELECT upper(replace(borough_name, '_', ' and ')) AS borough_name, ons_code, year FROM entities
    LEFT JOIN (SELECT DISTINCT year FROM order_events) years ON ons_code <> 'N7'),
metric AS (SELECT lower(replace(borough, '_', ' & ')) AS place, CAST(CASE WHEN borough <> 'NATION_9' THEN year END AS DOUBLE) + CASE WHEN borough = 'NATION_5' THEN 0.5 ELSE 0 END AS year,
    count(*) AS total FROM order_events GROUP BY 1, 2),
q AS (SELECT borough_name, ons_code, grain.year, total, 1 AS weight FROM grain LEFT JOIN metric
    ON trim(replace(lower(borough_name), ' and ', ' & ')) = trim(place) AND CAST(grain.year AS DOUBLE) IS NOT DISTINCT FROM metric.year)""")
def grain_merge_composite(spark, folder):
    """Standardised two-part key: and/&, letter case, int against double years, fractions matching nothing, null against null."""
    events = priority_events(spark, folder)
    years = events.select("year").distinct()
    grain = entities(spark, folder).join(years, F.col("ons_code") != "N7", "left").select(
        F.upper(F.replace("borough_name", F.lit("_"), F.lit(" and "))).alias("borough_name"), "ons_code", "year"
    )
    metric = events.groupBy(
        F.lower(F.replace("borough", F.lit("_"), F.lit(" & "))).alias("place"),
        (F.when(F.col("borough") != "NATION_9", F.col("year")).cast("double") + F.when(F.col("borough") == "NATION_5", 0.5).otherwise(0.0)).alias("yr"),
    ).agg(F.count(F.lit(1)).alias("total"), F.lit(1).alias("weight_"))
    merged = grain_merge(grain, metric, {"borough_name": "place", "year": "yr"})
    return merged.withColumn("weight", F.lit(1))


@query("ons_code:s year:i total_dwellings:d2 total:l band_d:l average_price:d2 net_additions:d2",
       MEASURES_SQL + ", q AS (SELECT * FROM measures)")
def merge_chain_yearly(spark, folder):
    """Five yearly tables, three kinds of year column, one left chain."""
    return merge_yearly(yearly_measures(spark, folder), HOUSING_YEARS)


@query("c_custkey:l key:l name:s name_supplier:s s_suppkey:l", """q AS (SELECT c_custkey, c.key, c.name, s.name AS name_supplier, s_suppkey
    FROM (SELECT c_custkey, CASE WHEN c_custkey > 3 THEN c_custkey END AS key, c_name AS name FROM customer) c
    LEFT JOIN (SELECT CASE WHEN s_suppkey > 2 THEN s_suppkey // 2 * 2 END AS key, s_name AS name, s_suppkey FROM supplier) s
    ON c.key IS NOT DISTINCT FROM s.key)""")
def enrich_suffix(spark, folder):
    """Two-table enrich: null keys match, a shared name gets the suffix, copies fan out."""
    c = table(spark, folder, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") > 3, F.col("c_custkey")).alias("key"), F.col("c_name").alias("name")
    )
    s = table(spark, folder, "supplier").select(
        F.when(F.col("s_suppkey") > 2, F.expr("s_suppkey div 2 * 2")).alias("key"), F.col("s_name").alias("name"), "s_suppkey"
    )
    return merge(c, s, "key", "left", ("", "_supplier"))


@query("c_custkey:l key:l s_suppkey:l", """q AS (SELECT c_custkey, c.key, s_suppkey
    FROM (SELECT c_custkey, CASE WHEN c_custkey > 3 THEN c_custkey END AS key FROM customer) c
    LEFT JOIN (SELECT CASE WHEN s_suppkey > 2 THEN s_suppkey // 2 * 2 END AS key, s_suppkey FROM supplier) s ON c.key = s.key)""")
def enrich_null_keys_apart(spark, folder):
    """The same enrich with null keys matching nothing."""
    c = table(spark, folder, "customer").select("c_custkey", F.when(F.col("c_custkey") > 3, F.col("c_custkey")).alias("key"))
    s = table(spark, folder, "supplier").select(F.when(F.col("s_suppkey") > 2, F.expr("s_suppkey div 2 * 2")).alias("key"), "s_suppkey")
    return merge(c, s, "key", "left", null_keys_match=False)


@query("key:l c_name:s o_orderstatus:s", """q AS (SELECT coalesce(c_custkey, o_orderkey) AS key, c_name, o_orderstatus
    FROM customer FULL JOIN orders ON c_custkey = o_orderkey)""")
def merge_outer(spark, folder):
    """Outer merge: the key is kept from whichever side has it."""
    c = table(spark, folder, "customer").select(F.col("c_custkey").alias("key"), "c_name")
    o = table(spark, folder, "orders").select(F.col("o_orderkey").alias("key"), "o_orderstatus")
    return merge(c, o, "key", "outer")


@query("ons_code:s year:i average_price:d2 _source_file_x:s total_dwellings:d2 _source_file_y:s", MEASURES_SQL + """,
q AS (SELECT ons_code, year, average_price, 'prices' AS _source_file_x, total_dwellings, 'stock' AS _source_file_y FROM measures)""")
def price_stock_join(spark, folder):
    """Prices with stock by code and year; shared audit names get _x and _y."""
    measures = yearly_measures(spark, folder)
    prices = ensure_year(measures["average_house_price"]).drop("date").withColumn("_source_file", F.lit("prices"))
    stock = ensure_year(measures["housing_stock"]).drop("year_name").withColumn("_source_file", F.lit("stock"))
    return merge(prices, stock, ["ons_code", "year"], "inner")


# ---- reshapes ---------------------------------------------------------------------------

@query("borough:s year:i net_additions:l", EVENTS_SQL + """,
q AS (SELECT borough, y.year, nullif(count(*) FILTER (WHERE e.year = y.year), 0) AS net_additions
    FROM order_events e, (SELECT DISTINCT year FROM order_events) y GROUP BY borough, y.year)""")
def unpivot_year_columns(spark, folder):
    """Digit-named columns become rows; null values stay."""
    events = priority_events(spark, folder)
    years = sorted(r["year"] for r in events.select("year").distinct().collect())
    wide = events.groupBy("borough").agg(*[F.nullif(F.count_if(F.col("year") == y), F.lit(0)).alias(str(y)) for y in years])
    return unpivot_years(wide)


@query("key:l year:i origin:s", """q AS (SELECT o_orderkey AS key, year(o_orderdate) AS year, 'date' AS origin FROM orders
    UNION ALL SELECT l_orderkey, year(l_shipdate), 'year_name' FROM lineitem)""")
def year_columns(spark, folder):
    """A year from a date and from a label, stacked."""
    dated = ensure_year(table(spark, folder, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_orderdate").alias("date")))
    labelled = ensure_year(
        table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("key"), F.year("l_shipdate").cast("string").alias("year_name"))
    )
    return union_all([dated.withColumn("origin", F.lit("date")), labelled.withColumn("origin", F.lit("year_name"))])


@query("key:l name:s balance:d2 segment:s", """q AS (SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier)""")
def union_by_name(spark, folder):
    c = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")
    )
    s = table(spark, folder, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")
    )
    return union_all([c, s])


@query("user_id:l event_id:l event_type:s value:d2", """q AS (SELECT user_id, event_id, event_type, value FROM
    (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1)""")
def first_per_key(spark, folder):
    """First event of each user, by aggregate instead of a window."""
    events = table(spark, folder, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return first_by_key(events, "user_id", ["ts", "event_id"])


@query("borough:s category:s year:i total_count:l", EVENTS_SQL + """,
q AS (SELECT borough, category, year, count(*) AS total_count FROM order_events
    WHERE year = (SELECT max(year) FROM order_events) GROUP BY borough, category, year)""")
def latest_year(spark, folder):
    return latest(rolled_up_events(priority_events(spark, folder), {}))


@query("low:i high:i orders:l", "q AS (SELECT min(year(o_orderdate)) AS low, max(year(o_orderdate)) AS high, count(*) AS orders FROM orders)")
def year_extremes(spark, folder):
    return ensure_year(table(spark, folder, "orders").withColumnRenamed("o_orderdate", "date")).agg(
        F.min("year").alias("low"), F.max("year").alias("high"), F.count(F.lit(1)).alias("orders")
    )


# ---- upserts ------------------------------------------------------------------------------


@query("user_id:l day:t event_id:l value:d2", """stamped AS (SELECT user_id, CAST(ts AS DATE) AS day, event_id, value,
    ts >= TIMESTAMP '2024-01-16' OR event_type = 'purchase' AS late, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE),
    (ts >= TIMESTAMP '2024-01-16' OR event_type = 'purchase') ORDER BY event_id DESC) AS rn FROM events),
incoming AS (SELECT * FROM stamped WHERE late AND rn = 1), target AS (SELECT * FROM stamped WHERE NOT late AND rn = 1),
q AS (SELECT user_id, day, event_id, value FROM incoming UNION ALL SELECT user_id, day, event_id, value FROM target
    WHERE (user_id, day) NOT IN (SELECT (user_id, day) FROM incoming))""")
def upsert_by_key(spark, folder):
    """Newest incoming row per (user, day) over the older table."""
    events = table(spark, folder, "events").select("user_id", F.to_date("ts").alias("day"), "event_id", "value", "event_type")
    late = (F.col("day") >= F.lit(date(2024, 1, 16))) | (F.col("event_type") == "purchase")
    keys, newest = ["user_id", "day"], [F.col("event_id") * -1]
    target = first_by_key(events.filter(~late).drop("event_type"), keys, newest)
    return upsert(target, events.filter(late).drop("event_type"), keys, newest)


@query("ons_code:s name:s", """stacked AS (SELECT 'K' || c_custkey AS ons_code, CASE WHEN c_acctbal > 0 THEN c_name END AS name, 0 AS rank FROM customer
    UNION ALL SELECT 'K' || s_suppkey, s_name, 1 FROM supplier UNION ALL SELECT 'K' || p_partkey, p_name, 2 FROM part),
q AS (SELECT ons_code, name FROM (SELECT *, row_number() OVER (PARTITION BY ons_code ORDER BY rank) AS rn FROM stacked) WHERE rn = 1 AND name IS NOT NULL)""")
def entity_dimension(spark, folder):
    """First source per key decides, then rows without a name go."""
    c = table(spark, folder, "customer").select(
        F.concat(F.lit("K"), F.col("c_custkey").cast("string")).alias("code"), F.when(F.col("c_acctbal") > 0, F.col("c_name")).alias("label")
    )
    s = table(spark, folder, "supplier").select(F.concat(F.lit("K"), F.col("s_suppkey").cast("string")).alias("code"), F.col("s_name").alias("label"))
    p = table(spark, folder, "part").select(F.concat(F.lit("K"), F.col("p_partkey").cast("string")).alias("code"), F.col("p_name").alias("label"))
    return dimension_of([(c, "code", "label"), (s, "code", "label"), (p, "code", "label")])


# ---- constraints ------------------------------------------------------------------------------


@query("o_custkey:l day:t n:l", """q AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY ALL HAVING count(*) > 1)""")
def quality_unique(spark, folder):
    return duplicate_keys(table(spark, folder, "orders").withColumn("day", F.to_date("o_orderdate")), ["o_custkey", "day"])


_STRAY_SQL = "stray AS (SELECT l_orderkey, l_linenumber, l_suppkey, CASE WHEN l_orderkey % 50 = 3 THEN NULL WHEN l_partkey % 40 = 7 THEN -l_partkey ELSE l_partkey END AS l_partkey FROM lineitem)"


def _stray(spark, folder):
    """Lines of which some have no part, and some a part number that no part has."""
    part = F.col("l_partkey")
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", F.when(F.col("l_orderkey") % 50 != 3, F.when(part % 40 == 7, -part).otherwise(part)).alias("l_partkey"),
    )


@query("l_partkey:l n:l", _STRAY_SQL + ", q AS (SELECT l_partkey, count(*) AS n FROM stray WHERE l_partkey NOT IN (SELECT p_partkey FROM part) GROUP BY l_partkey)")
def quality_fk(spark, folder):
    return orphan_keys(_stray(spark, folder), table(spark, folder, "part"), "l_partkey", "p_partkey")


@query("l_orderkey:l l_linenumber:i l_partkey:l l_suppkey:l", _STRAY_SQL + ", q AS (SELECT * FROM stray WHERE l_partkey NOT IN (SELECT p_partkey FROM part))")
def quality_fk_rows(spark, folder):
    return orphan_rows(_stray(spark, folder), table(spark, folder, "part"), "l_partkey", "p_partkey")


_GAPS_SQL = "gaps AS (SELECT event_id, CASE WHEN value > 5 THEN value END AS value, CASE WHEN event_type <> 'error' THEN event_type END AS event_type, user_id FROM events)"


def _gaps(spark, folder):
    return table(spark, folder, "events").select(
        "event_id", F.when(F.col("value") > 5, F.col("value")).alias("value"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("event_type"), "user_id",
    )


@query("column:s n:l", _GAPS_SQL + """, q AS (SELECT 'value' AS "column", count(*) - count(value) AS n FROM gaps
    UNION ALL SELECT 'event_type', count(*) - count(event_type) FROM gaps)""")
def quality_notnull(spark, folder):
    return null_counts(_gaps(spark, folder), ["value", "event_type", "user_id"])


@query("event_id:l value:d2 event_type:s", _GAPS_SQL + ", q AS (SELECT * FROM gaps WHERE value IS NULL OR event_type IS NULL)")
def quality_null_rows(spark, folder):
    return null_rows(_gaps(spark, folder), ["value", "event_type"])


@query("event_id:l value:d2 event_type:s", _GAPS_SQL + """,
q AS (SELECT event_id, coalesce(value, 0) AS value, coalesce(event_type, 'none') AS event_type FROM gaps)""")
def column_defaults(spark, folder):
    """Defaults where the value is null; a default for an absent column is ignored."""
    return apply_defaults(_gaps(spark, folder), {"value": 0.0, "event_type": "none", "absent": 1})


_RULES = {"orders": {"keys": ["ons_code", "year"], "required": ["value"]}}


@query("table:s rule:s subject:s n:l", EVENTS_SQL + ", " + ENTITIES_SQL + """,
served AS (SELECT CASE WHEN o_orderkey % 50 <> 0 THEN CASE WHEN o_orderkey % 40 = 7 THEN 'X' || ons_code ELSE ons_code END END AS ons_code, o_custkey AS year, CASE WHEN category <> 'LOW' THEN category END AS value FROM order_events),
q AS (SELECT 'orders' AS "table", 'unique' AS rule, concat_ws('|', ons_code, year) AS subject, count(*) AS n FROM served GROUP BY ons_code, year HAVING count(*) > 1
    UNION ALL SELECT 'orders', 'not_null', 'ons_code', count(*) FROM served WHERE ons_code IS NULL
    UNION ALL SELECT 'orders', 'not_null', 'value', count(*) FROM served WHERE value IS NULL
    UNION ALL SELECT 'orders', 'foreign_key', ons_code, count(*) FROM served WHERE ons_code NOT IN (SELECT ons_code FROM entities) GROUP BY ons_code)""")
def constraint_summary(spark, folder):
    """All constraints of a serving table in one report."""
    served = priority_events(spark, folder).select(
        F.when(F.col("o_orderkey") % 50 != 0, F.when(F.col("o_orderkey") % 40 == 7, F.concat(F.lit("X"), "ons_code")).otherwise(F.col("ons_code"))).alias("ons_code"),
        F.col("o_custkey").alias("year"),
        F.when(F.col("category") != "LOW", F.col("category")).alias("value"),
    )
    return constraint_report(served, "orders", entities(spark, folder), _RULES)
