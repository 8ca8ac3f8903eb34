"""Event roll-ups, pivots and the full event matrix."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardmetrics.catalogue.registry import query
from wardmetrics.catalogue.tables import (
    ENTITIES_SQL, EVENTS_SQL, GROUP_SQL, POPULATION_SQL, PRIORITIES, PRIORITY_GROUPS, ROLLUP_SQL,
    entities, priority_events,
)
from wardmetrics.functions.text import category_group
from wardmetrics.operators.aggregate import annual_rollup, counts_by_sets, monthly_counts
from wardmetrics.operators.reshape import category_lookup, pivot_categories
from wardmetrics.plans.domains import event_gold_rules
from wardmetrics.plans.gold import build_matrix
from wardmetrics.plans.layers import rolled_up_counts, rolled_up_events

_MEASURES = ["total_orders_per_1000", *[f"{p}_per_1000" for p in PRIORITIES]]

EVENT_GOLD = {
    "table_name": "orders",
    "metric_sources": [
        {"source": "population", "join_on": {"ons_code": "ons_code"}, "keep_cols": ["ons_code", "population", "year"]},
        {
            "source": "rolled",
            "join_on": {"borough_name": "borough", "year": "year"},
            "pivot": PRIORITIES,
            "keep_cols": ["borough", "year", *[f"{p}_annualised_rate" for p in PRIORITIES]],
        },
    ],
    "post_processing": event_gold_rules(PRIORITIES, "borough_name", what="orders", prefix="avg"),
}

MATRIX_SHAPE = " ".join([
    "borough_name:s ons_code:s year:i population:l",
    *[f"{p}_annualised_rate:d6" for p in PRIORITIES],
    "total_orders_annualised:d6",
    *[f"{m}:d6" for m in _MEASURES],
    *[f"avg_{m}:d6 pct_diff_{m}:d6" for m in _MEASURES],
    *[f"yoy_pct_change_{m}:d6" for m in _MEASURES],
])


def _slug_sql(column: str) -> str:
    return f"trim(regexp_replace(lower({column}), '[^a-z0-9]+', '_', 'g'), '_')"


PIVOT_SQL = "pivoted AS (SELECT year, borough, " + ", ".join(
    f"avg(CASE WHEN {_slug_sql('category')} = '{p}' THEN annualised_rate END) AS {p}_annualised_rate" for p in PRIORITIES
) + " FROM rolled GROUP BY year, borough)"

MATRIX_SQL = ROLLUP_SQL + ", " + PIVOT_SQL + ", " + ENTITIES_SQL + ", " + POPULATION_SQL + f""",
joined AS (SELECT e.borough_name, e.ons_code, p.year, p.population, {', '.join(f'{p}_annualised_rate' for p in PRIORITIES)}
    FROM entities e LEFT JOIN population p ON e.ons_code = p.ons_code
    LEFT JOIN pivoted v ON e.borough_name = v.borough AND p.year IS NOT DISTINCT FROM v.year),
summed AS (SELECT *, {' + '.join(f'coalesce({p}_annualised_rate, 0.0)' for p in PRIORITIES)} AS total_orders_annualised FROM joined),
rated AS (SELECT *, total_orders_annualised / nullif(population, 0) * 1000 AS total_orders_per_1000,
    {', '.join(f'{p}_annualised_rate / nullif(population, 0) * 1000 AS {p}_per_1000' for p in PRIORITIES)} FROM summed),
averaged AS (SELECT *, {', '.join(f'CASE WHEN year IS NOT NULL THEN avg({m}) OVER (PARTITION BY year) END AS avg_{m}' for m in _MEASURES)},
    {', '.join(f'lag({m}) OVER (PARTITION BY borough_name ORDER BY year) AS before_{m}' for m in _MEASURES)} FROM rated),
q AS (SELECT *, {', '.join(f'({m} - avg_{m}) / nullif(avg_{m}, 0) * 100 AS pct_diff_{m}' for m in _MEASURES)},
    {', '.join(f'({m} / nullif(before_{m}, 0) - 1) * 100 AS yoy_pct_change_{m}' for m in _MEASURES)} FROM averaged)"""


@query(MATRIX_SHAPE, MATRIX_SQL)
def gold_event_matrix(spark, folder):
    """Roll-up, rate, pivot, entity join, per-1,000, deviation by year, yearly change."""
    counts = counts_by_sets(priority_events(spark, folder), {
        "monthly": ["year", "month", "borough", "category"], "customers": ["ons_code", "year", "o_custkey"],
    })
    active = counts["customers"].groupBy("ons_code", "year").agg(F.count("o_custkey").alias("population"))
    sources = {"population": active, "rolled": rolled_up_counts(counts["monthly"].dropna(subset=["category"]), PRIORITY_GROUPS)}
    return build_matrix(entities(spark, folder), sources, EVENT_GOLD)


@query("year:i month:i borough:s category:s count:l",
       ROLLUP_SQL + ", q AS (SELECT year, month, borough, category, n AS count FROM monthly)")
def value_counts_monthly(spark, folder):
    return monthly_counts(priority_events(spark, folder))


@query("year:i borough:s category:s total_count:l months_present:l annualised_rate:d6", ROLLUP_SQL + ", q AS (SELECT * FROM rolled)")
def annualised_rate(spark, folder):
    return annual_rollup(monthly_counts(priority_events(spark, folder)))


@query("year:i borough:s category:s total_count:l months_present:l annualised_rate:d6 analytical_category:s",
       ROLLUP_SQL + ", q AS (SELECT * FROM rolled)")
def event_rollup_grouped(spark, folder):
    return rolled_up_events(priority_events(spark, folder), PRIORITY_GROUPS)


@query("year:i borough:s " + " ".join(f"{p}_annualised_rate:d6" for p in PRIORITIES),
       ROLLUP_SQL + ", " + PIVOT_SQL + ", q AS (SELECT * FROM pivoted)")
def pivot_category_rate(spark, folder):
    return pivot_categories(annual_rollup(monthly_counts(priority_events(spark, folder))), PRIORITIES)


@query("category:s category_slug:s analytical_category:s",
       EVENTS_SQL + f", q AS (SELECT DISTINCT category, {_slug_sql('category')} AS category_slug, {GROUP_SQL} AS analytical_category FROM order_events)")
def lookup_of_categories(spark, folder):
    events = priority_events(spark, folder)
    return category_lookup(events.withColumn("analytical_category", category_group(F.col("category"), PRIORITY_GROUPS)))


@query("analytical_category:s events:l",
       EVENTS_SQL + f", q AS (SELECT {GROUP_SQL} AS analytical_category, count(*) AS events FROM order_events GROUP BY 1)")
def category_groups(spark, folder):
    """Category map with a default group, counted."""
    events = priority_events(spark, folder)
    grouped = events.withColumn("analytical_category", category_group(F.col("category"), PRIORITY_GROUPS))
    return grouped.groupBy("analytical_category").agg(F.count(F.lit(1)).alias("events"))
