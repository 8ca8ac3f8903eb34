"""Metric rules one by one: conditional aggregates, ratios, deviations, changes."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardmetrics.catalogue.registry import query
from wardmetrics.catalogue.tables import ENTITIES_SQL, EVENTS_SQL, priority_events, table
from wardmetrics.functions.numbers import ratio_pct, ratio_per_1k, row_sum
from wardmetrics.operators.aggregate import (
    comma_union, count_with_unknown, graded_average as graded, group_medians, group_metrics, group_size,
)
from wardmetrics.operators.compare import add_deviations, add_yoy_changes
from wardmetrics.operators.filters import drop_values
from wardmetrics.plans.gold import finalize_matrix
from wardmetrics.plans.metrics import MetricSpec, compute_metrics

# ---- customers as rated places ------------------------------------------------


def rated_places(spark, folder):
    """Customers with a nation, a group, a status, a grade text and two amounts."""
    c = table(spark, folder, "customer")
    cents = F.rint(F.col("c_acctbal") * 100).cast("bigint")
    return c.select(
        "c_custkey",
        F.when(cents % 11 != 0, F.concat(F.lit("N"), F.col("c_nationkey").cast("string"))).alias("area"),
        F.col("c_mktsegment").alias("segment"),
        F.when(cents % 7 == 0, F.lit(None)).when(cents % 5 == 0, F.lit("Closed")).otherwise(F.lit("Open")).alias("status"),
        F.when(cents % 6 == 5, F.lit("n/a")).otherwise((cents % 6).cast("string")).alias("grade"),
        F.when(cents % 13 != 0, F.floor(cents / 100)).alias("capacity"),
        F.floor(cents / 150).alias("pupils"),
    )


PLACES_SQL = """cents AS (SELECT *, CAST(round_even(c_acctbal * 100, 0) AS BIGINT) AS cents FROM customer),
places AS (SELECT c_custkey, CASE WHEN cents % 11 <> 0 THEN 'N' || c_nationkey END AS area, c_mktsegment AS segment,
    CASE WHEN cents % 7 = 0 THEN NULL WHEN cents % 5 = 0 THEN 'Closed' ELSE 'Open' END AS status,
    CASE WHEN cents % 6 = 5 THEN 'n/a' ELSE CAST(cents % 6 AS VARCHAR) END AS grade,
    CASE WHEN cents % 13 <> 0 THEN CAST(floor(cents / 100) AS BIGINT) END AS capacity,
    CAST(floor(cents / 150) AS BIGINT) AS pupils FROM cents)"""

PLACE_RULES = [
    {
        "filter_column": "segment",
        "filter_value": "BUILDING",
        "group_by": "area",
        "count_column_name": "private_count",
        "aggregations": {
            "capacity": {"operation": "sum", "output_name": "private_capacity"},
            "pupils": {"operation": "sum", "output_name": "private_pupils"},
        },
    },
    {
        "filter_column": "segment",
        "filter_value": ["HOUSEHOLD", "MACHINERY", "FURNITURE"],
        "group_by": "area",
        "count_column_name": "public_count",
        "aggregations": {
            "capacity": {"operation": "sum", "output_name": "public_capacity"},
            "pupils": {"operation": "sum", "output_name": "public_pupils"},
            "status": [
                {"operation": "count_where", "value": "Open", "output_name": "public_open"},
                {"operation": "count_where", "value": "Closed", "output_name": "public_closed"},
            ],
            "grade": {"operation": "graded_average", "output_name": "avg_grade"},
        },
    },
]

_PUBLIC = "segment IN ('HOUSEHOLD', 'MACHINERY', 'FURNITURE')"
COND_SQL = f"""cond AS (SELECT area AS area_key, count(*) FILTER (WHERE segment = 'BUILDING') AS private_count,
    coalesce(sum(capacity) FILTER (WHERE segment = 'BUILDING'), 0) AS private_capacity,
    coalesce(sum(pupils) FILTER (WHERE segment = 'BUILDING'), 0) AS private_pupils,
    count(*) FILTER (WHERE {_PUBLIC}) AS public_count,
    coalesce(sum(capacity) FILTER (WHERE {_PUBLIC}), 0) AS public_capacity,
    coalesce(sum(pupils) FILTER (WHERE {_PUBLIC}), 0) AS public_pupils,
    count(*) FILTER (WHERE {_PUBLIC} AND status = 'Open') AS public_open,
    count(*) FILTER (WHERE {_PUBLIC} AND status = 'Closed') AS public_closed,
    avg(TRY_CAST(grade AS DOUBLE)) FILTER (WHERE {_PUBLIC} AND TRY_CAST(grade AS DOUBLE) BETWEEN 1 AND 4) AS avg_grade
    FROM kept WHERE area IS NOT NULL GROUP BY area),
attached AS (SELECT kept.*, coalesce(private_count, 0) AS private_count, coalesce(private_capacity, 0) AS private_capacity,
    coalesce(private_pupils, 0) AS private_pupils, coalesce(public_count, 0) AS public_count,
    coalesce(public_capacity, 0) AS public_capacity, coalesce(public_pupils, 0) AS public_pupils,
    coalesce(public_open, 0) AS public_open, coalesce(public_closed, 0) AS public_closed, coalesce(avg_grade, 0) AS avg_grade
    FROM kept LEFT JOIN cond ON kept.area = cond.area_key)"""

_COND_SHAPE = ("private_count:l private_capacity:l private_pupils:l public_count:l public_capacity:l "
               "public_pupils:l public_open:l public_closed:l avg_grade:d6")

FILTERS = [{"column": "status", "values": ["Closed"]}, {"column": "absent", "values": ["x"]}]
KEPT_SQL = PLACES_SQL + ", kept AS (SELECT * FROM places WHERE NOT coalesce(status IN ('Closed'), false))"


@query("c_custkey:l area:s segment:s status:s grade:s", KEPT_SQL + ", q AS (SELECT * FROM kept)")
def filter_out_rules(spark, folder):
    """Drop listed values; null rows stay, a rule on an absent column does nothing."""
    return drop_values(rated_places(spark, folder), FILTERS)


@query(f"c_custkey:l area:s {_COND_SHAPE}", PLACES_SQL + ", kept AS (SELECT * FROM places), " + COND_SQL + ", q AS (SELECT * FROM attached)")
def cond_agg_multi(spark, folder):
    """Two subsets, nine aggregates, one shuffle, joined back to every row."""
    return compute_metrics(rated_places(spark, folder), {"conditional_aggregations": PLACE_RULES})


@query("c_custkey:l area:s private_count:l private_pupils:l avg_grade:d6", PLACES_SQL + ", kept AS (SELECT * FROM places), " + COND_SQL + """,
bare AS (SELECT kept.*, nullif(private_count, 0) AS private_count, CASE WHEN private_count > 0 THEN private_pupils END AS private_pupils, avg_grade
    FROM kept LEFT JOIN cond ON kept.area = cond.area_key), q AS (SELECT * FROM bare)""")
def cond_agg_unfilled(spark, folder):
    """The same rules with "no data" left null."""
    spec = MetricSpec.from_dict({"conditional_aggregations": PLACE_RULES}, fill=None)
    return compute_metrics(rated_places(spark, folder), spec)


SCHOOL_RULES = {
    "filter_out": FILTERS,
    "conditional_aggregations": PLACE_RULES,
    "sum_columns": {"inputs": ["private_count", "public_count"], "output_name": "total_count"},
    "calculate_ratio": [
        {"numerator_col": "private_count", "denominator_col": "total_count", "output_col": "pct_private"},
        {"numerator_col": "public_pupils", "denominator_col": "public_capacity", "output_col": "public_pct_filled"},
    ],
    "calculate_deviation": {"target_col": "avg_grade", "new_avg_col": "mean_grade", "new_dev_col": "pct_diff_grade"},
    "keep_cols": ["area", "private_count", "public_count", "avg_grade", "total_count", "pct_private"],
}

SCHOOL_SHAPE = ("area:s private_count:l public_count:l avg_grade:d6 total_count:d2 pct_private:d6 mean_grade:d6 "
                "pct_diff_grade:d6 public_pct_filled:d6")

SCHOOL_SQL = KEPT_SQL + ", " + COND_SQL + """,
summed AS (SELECT *, private_count + public_count AS total_count FROM attached),
school_rules AS (SELECT DISTINCT area, private_count, public_count, avg_grade, total_count,
    CAST(private_count AS DOUBLE) / nullif(total_count, 0) * 100 AS pct_private,
    CAST(public_pupils AS DOUBLE) / nullif(public_capacity, 0) * 100 AS public_pct_filled,
    (SELECT avg(avg_grade) FROM summed) AS mean_grade,
    (avg_grade - (SELECT avg(avg_grade) FROM summed)) / nullif((SELECT avg(avg_grade) FROM summed), 0) * 100 AS pct_diff_grade
    FROM summed)"""


@query(SCHOOL_SHAPE, SCHOOL_SQL + ", q AS (SELECT * FROM school_rules)")
def deviation_weighted(spark, folder):
    """The whole rule set at group grain, rows carried as weights."""
    return compute_metrics(rated_places(spark, folder), SCHOOL_RULES)


@query(SCHOOL_SHAPE, SCHOOL_SQL + ", q AS (SELECT * FROM school_rules)")
def deviation_by_rows(spark, folder):
    """The same rule set over rows, copies removed at the end."""
    return compute_metrics(rated_places(spark, folder), SCHOOL_RULES, row_order=True)


@query("area:s grade:d6", PLACES_SQL + """, q AS (SELECT area, avg(TRY_CAST(grade AS DOUBLE))
    FILTER (WHERE TRY_CAST(grade AS DOUBLE) BETWEEN 1 AND 4) AS grade FROM places GROUP BY area)""")
def graded_average(spark, folder):
    return rated_places(spark, folder).groupBy("area").agg(graded(F.col("grade")).alias("grade"))


@query("area:s size:l", PLACES_SQL + ", q AS (SELECT area, count(*) AS size FROM places WHERE area IS NOT NULL GROUP BY area)")
def size_by_entity(spark, folder):
    return group_size(rated_places(spark, folder), ["area"])


@query("area:s places:l", PLACES_SQL + """, q AS (SELECT coalesce(area, 'Unknown / Outside London') AS area, count(*) AS places
    FROM places GROUP BY 1)""")
def count_by_entity_unknown(spark, folder):
    return count_with_unknown(rated_places(spark, folder), "places", "area")


# ---- comma lists -----------------------------------------------------------------

_PARTS_SQL = "parts AS (SELECT p_brand, CASE WHEN p_size % 10 <> 0 THEN replace(p_name, ' ', ', ') END AS words FROM part)"


def _parts(spark, folder):
    words = F.when(F.col("p_size") % 10 != 0, F.replace("p_name", F.lit(" "), F.lit(", ")))
    return table(spark, folder, "part").select("p_brand", "p_size", words.alias("words"))


@query("p_brand:s transport_words:s size:l", _PARTS_SQL + """,
items AS (SELECT DISTINCT p_brand, trim(item) AS item FROM (SELECT p_brand, unnest(string_split(words, ',')) AS item FROM parts)),
lists AS (SELECT p_brand, string_agg(item, ', ' ORDER BY item) AS words FROM items GROUP BY p_brand),
q AS (SELECT parts.p_brand, coalesce(any_value(lists.words), '') AS transport_words, count(*) AS size
    FROM parts LEFT JOIN lists ON parts.p_brand = lists.p_brand GROUP BY parts.p_brand)""")
def comma_list_union(spark, folder):
    """Distinct items of all lists of a brand, and the row count, in one pass."""
    return comma_union(_parts(spark, folder), ["p_brand"], "words", "transport_words", size="size")


@query("p_brand:s p_size:d6 transport_words:s", _PARTS_SQL.replace("p_brand,", "p_brand, p_size,") + """,
items AS (SELECT DISTINCT p_brand, trim(item) AS item FROM (SELECT p_brand, unnest(string_split(words, ',')) AS item FROM parts)),
lists AS (SELECT p_brand, string_agg(item, ', ' ORDER BY item) AS words FROM items GROUP BY p_brand),
q AS (SELECT parts.p_brand, avg(p_size) AS p_size, coalesce(any_value(lists.words), '') AS transport_words
    FROM parts LEFT JOIN lists ON parts.p_brand = lists.p_brand GROUP BY parts.p_brand)""")
def text_beside_aggregates(spark, folder):
    rules = {"groupby_cols": ["p_brand"], "aggregations": {"p_size": "mean"}, "textual_col": "words"}
    return compute_metrics(_parts(spark, folder), rules)


# ---- row arithmetic ------------------------------------------------------------------

_LINES = "l_orderkey:l l_linenumber:i"


@query(f"{_LINES} l_partkey:l l_suppkey:l total:d6", """q AS (SELECT *, coalesce(CASE WHEN l_returnflag <> 'R' THEN l_quantity END, 0)
    + coalesce(CASE WHEN l_linestatus = 'O' THEN l_tax END, 0) AS total FROM lineitem)""")
def row_total(spark, folder):
    lines = table(spark, folder, "lineitem")
    open_tax = F.when(F.col("l_linestatus") == "O", F.col("l_tax"))
    kept = F.when(F.col("l_returnflag") != "R", F.col("l_quantity"))
    return lines.withColumn("total", row_sum([kept, open_tax]))


@query(f"{_LINES} l_partkey:l l_suppkey:l pct:d6", "q AS (SELECT *, l_quantity / nullif(l_discount, 0) * 100 AS pct FROM lineitem)")
def ratio_percent(spark, folder):
    return table(spark, folder, "lineitem").withColumn("pct", ratio_pct(F.col("l_quantity"), F.col("l_discount")))


@query(f"{_LINES} l_partkey:l l_suppkey:l rate:d6", "q AS (SELECT *, l_quantity / nullif(l_tax, 0) * 1000 AS rate FROM lineitem)")
def ratio_per_thousand(spark, folder):
    return table(spark, folder, "lineitem").withColumn("rate", ratio_per_1k(F.col("l_quantity"), F.col("l_tax")))


# ---- deviations -----------------------------------------------------------------------


@query("o_orderkey:l mean_price:d4 pct_diff:d6", """q AS (SELECT o_orderkey, avg(o_totalprice) OVER () AS mean_price,
    (o_totalprice - avg(o_totalprice) OVER ()) / nullif(avg(o_totalprice) OVER (), 0) * 100 AS pct_diff FROM orders)""")
def deviation_global(spark, folder):
    rule = {"target_col": "o_totalprice", "new_avg_col": "mean_price", "new_dev_col": "pct_diff"}
    return add_deviations(table(spark, folder, "orders"), [rule])


@query("o_orderkey:l mean_price:d4 pct_diff:d6", EVENTS_SQL + """,
q AS (SELECT o_orderkey, avg(o_totalprice) OVER (PARTITION BY year) AS mean_price,
    (o_totalprice - avg(o_totalprice) OVER (PARTITION BY year)) / nullif(avg(o_totalprice) OVER (PARTITION BY year), 0) * 100 AS pct_diff
    FROM order_events)""")
def deviation_by_year(spark, folder):
    rule = {"target_col": "o_totalprice", "new_avg_col": "mean_price", "new_dev_col": "pct_diff", "group_by": ["year"]}
    return add_deviations(priority_events(spark, folder), [rule])


# ---- year on year ------------------------------------------------------------------------

_YEARLY_SQL = EVENTS_SQL + """,
yearly AS (SELECT borough, CASE WHEN year > 1996 THEN year + 1 ELSE year END AS year, CASE WHEN count(*) FILTER (WHERE category = 'URGENT') % 4 <> 0
    THEN count(*) FILTER (WHERE category = 'URGENT') END AS n FROM order_events GROUP BY borough, year)"""


def _yearly(spark, folder):
    """Counts per nation and year with gaps in years and in values."""
    urgent = F.count_if(F.col("category") == "URGENT")
    grouped = priority_events(spark, folder).groupBy("borough", "year").agg(urgent.alias("urgent"))
    moved = F.when(F.col("year") > 1996, F.col("year") + 1).otherwise(F.col("year"))
    return grouped.select("borough", moved.alias("year"), F.when(F.col("urgent") % 4 != 0, F.col("urgent")).alias("n"))


_YOY = [{"target_col": "n", "group_col": "borough", "year_col": "year", "output_col": "yoy"}]
_YOY_SHAPE = "borough:s year:i n:l yoy:d6"


@query(_YOY_SHAPE, _YEARLY_SQL + """, q AS (SELECT *, (CAST(n AS DOUBLE)
    / nullif(lag(n) OVER (PARTITION BY borough ORDER BY year), 0) - 1) * 100 AS yoy FROM yearly)""")
def yoy_change(spark, folder):
    return add_yoy_changes(_yearly(spark, folder), _YOY)


@query(_YOY_SHAPE, _YEARLY_SQL + """, q AS (SELECT a.*, (CAST(a.n AS DOUBLE) / nullif(b.n, 0) - 1) * 100 AS yoy FROM yearly a
    LEFT JOIN yearly b ON a.borough = b.borough AND a.year = b.year + 1)""")
def yoy_strict(spark, folder):
    return add_yoy_changes(_yearly(spark, folder), _YOY, strict_year=True)


@query(_YOY_SHAPE, _YEARLY_SQL + """, padded AS (SELECT *, last_value(n IGNORE NULLS) OVER (PARTITION BY borough ORDER BY year
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS now FROM yearly),
q AS (SELECT *, (CAST(now AS DOUBLE) / nullif(lag(now) OVER (PARTITION BY borough ORDER BY year), 0) - 1) * 100 AS yoy FROM padded)""")
def yoy_pad(spark, folder):
    return add_yoy_changes(_yearly(spark, folder), _YOY, fill="pad")


@query("o_orderkey:l yoy:d4", EVENTS_SQL + """, q AS (SELECT o_orderkey, (o_totalprice
    / nullif(lag(o_totalprice) OVER (PARTITION BY borough ORDER BY year, o_orderkey), 0) - 1) * 100 AS yoy FROM order_events)""")
def yoy_by_rows(spark, folder):
    """Previous row over all order rows of a nation, compared in blocks of rows."""
    rules = [{"target_col": "o_totalprice", "group_col": "borough", "year_col": "year", "output_col": "yoy"}]
    return add_yoy_changes(priority_events(spark, folder), rules, tie_break="o_orderkey")


# ---- named aggregates -----------------------------------------------------------------------

_OPERATIONS = ["sum", "mean", "min", "max", "count", "nunique", "first", "last", "median", "std", "var"]


@query("area:s " + " ".join(f"capacity_{op}:d4" for op in _OPERATIONS) + " pupils:l", PLACES_SQL + """,
q AS (SELECT area, coalesce(sum(capacity), 0) AS capacity_sum, avg(capacity) AS capacity_mean, min(capacity) AS capacity_min,
    max(capacity) AS capacity_max, count(capacity) AS capacity_count, count(DISTINCT capacity) AS capacity_nunique,
    arg_min(capacity, c_custkey) AS capacity_first, arg_max(capacity, c_custkey) AS capacity_last,
    median(capacity) AS capacity_median, stddev_samp(capacity) AS capacity_std, var_samp(capacity) AS capacity_var,
    sum(pupils) AS pupils FROM places WHERE area IS NOT NULL GROUP BY area)""")
def numeric_named_aggs(spark, folder):
    return group_metrics(rated_places(spark, folder), ["area"], {"capacity": _OPERATIONS, "pupils": "sum"}, order_by="c_custkey")


@query("l_returnflag:s l_linestatus:s mid:d4", """q AS (SELECT l_returnflag, l_linestatus, median(l_extendedprice) AS mid
    FROM lineitem GROUP BY l_returnflag, l_linestatus)""")
def exact_group_median(spark, folder):
    """Exact medians of few, large groups."""
    return group_medians(table(spark, folder, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice", "mid")


@query("area:s capacity:d4 pupils:d4", PLACES_SQL + """, q AS (SELECT area, median(CASE WHEN area <> (SELECT min(area) FROM places) THEN capacity END) AS capacity,
    median(pupils) AS pupils FROM places WHERE area IS NOT NULL GROUP BY area)""")
def group_medians_sparse(spark, folder):
    """Medians where one group holds no value of a column: the group stays."""
    places = rated_places(spark, folder)
    least = places.agg(F.min("area").alias("least"))
    bare = places.join(F.broadcast(least), F.col("area") == F.col("least"), "left")
    return group_metrics(bare.withColumn("capacity", F.when(F.col("least").isNull(), F.col("capacity"))), ["area"], {"capacity": "median", "pupils": "median"})


# ---- finished matrix ---------------------------------------------------------------------------

_NETWORKS = [("signup_count", "Signup"), ("error_count", "Error"), ("click_count", "Click")]


@query("user_id:l signup_count:l error_count:l click_count:l country:s transport_line_name:s", """counts AS (SELECT user_id,
    nullif(count(*) FILTER (WHERE event_type = 'signup'), 0) AS signup_count, nullif(count(*) FILTER (WHERE event_type = 'error'), 0) AS error_count,
    nullif(count(*) FILTER (WHERE event_type = 'click'), 0) AS click_count,
    'c' || user_id AS country, CASE WHEN count(*) FILTER (WHERE event_type = 'view') > 1 THEN 'View ' END AS line FROM events GROUP BY user_id),
q AS (SELECT user_id, coalesce(signup_count, 0) AS signup_count, coalesce(error_count, 0) AS error_count, coalesce(click_count, 0) AS click_count, country,
    coalesce(nullif(concat_ws(', ', nullif(trim(coalesce(line, '')), ''), CASE WHEN signup_count > 0 THEN 'Signup' END,
    CASE WHEN error_count > 0 THEN 'Error' END, CASE WHEN click_count > 0 THEN 'Click' END), ''), 'None') AS transport_line_name FROM counts)""")
def finalize_counts(spark, folder):
    """Counts filled, and the text extended by the labels of positive counts."""
    events = table(spark, folder, "events")
    counts = events.groupBy("user_id").agg(
        *[F.nullif(F.count_if(F.col("event_type") == kind), F.lit(0)).alias(f"{kind}_count") for kind in ("signup", "error", "click")],
        F.when(F.count_if(F.col("event_type") == "view") > 1, F.lit("View ")).alias("transport_line_name"),
    )
    named = counts.withColumn("country", F.concat(F.lit("c"), F.col("user_id").cast("string")))
    return finalize_matrix(named, "transport_line_name", _NETWORKS)


@query("borough_name:s urgent:l pct:d6 label:s", EVENTS_SQL + ", " + ENTITIES_SQL + """,
counted AS (SELECT borough, count(*) FILTER (WHERE category = 'URGENT') AS urgent, count(*) AS everything FROM order_events GROUP BY borough),
q AS (SELECT borough AS borough_name, urgent, CAST(urgent AS DOUBLE) / nullif(everything, 0) * 100 AS pct, '7' AS label FROM counted)""")
def rename_and_keep(spark, folder):
    """Ratios on old names, then renames, then the kept and derived columns."""
    events = priority_events(spark, folder)
    counted = events.groupBy("borough").agg(
        F.count_if(F.col("category") == "URGENT").alias("n"), F.count(F.lit(1)).alias("everything"), F.lit("7").alias("label")
    )
    spec = MetricSpec.from_dict({
        "calculate_ratio": {"numerator_col": "n", "denominator_col": "everything", "output_col": "pct"},
        "rename_cols": {"n": "urgent", "borough": "borough_name"},
        "keep_cols": ["borough_name", "urgent", "label", "pct", "no_such_column"],
    })
    return compute_metrics(counted, spec)


