"""The domain rule sets over stand-in tables, and the layer jobs end to end."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardmetrics.catalogue.places import LONLAT_SQL
from wardmetrics.catalogue.registry import query
from wardmetrics.catalogue.tables import (
    ENTITIES_SQL, EVENTS_SQL, MEASURES_SQL, entities, grid_points, priority_events, table, yearly_measures,
)
from wardmetrics.operators.joins import merge_yearly
from wardmetrics.operators.spatial import grid_to_lonlat, points_in_polygons
from wardmetrics.plans.domains import (
    EDUCATION_GOLD, GRADED, HOUSING_DEVIATIONS, HOUSING_GOLD, HOUSING_YEARS, INFRASTRUCTURE_GOLD,
)
from wardmetrics.plans.gold import Subset, build_matrix
from wardmetrics.plans.layers import SheetFiles, SilverJoin, budget_tables, run_bronze, run_silver
from wardmetrics.plans.serving import sync_serving
from wardmetrics.session import scratch_path
from wardmetrics.sinks.upsert import read_version
from wardmetrics.sinks.writers import write_layer
from wardmetrics.sources.polygons import ring_layer
from wardmetrics.sources.raw import RawSource, layout, scan_raw

# ---- schools ---------------------------------------------------------------------

_GROUPS = {
    "BUILDING": "Independent schools", "HOUSEHOLD": "Academies", "MACHINERY": "Free Schools",
    "FURNITURE": "Special schools", "AUTOMOBILE": "Colleges",
}


def _schools(spark, folder):
    cents = F.rint(F.col("c_acctbal") * 100).cast("bigint")
    groups = F.create_map(*[F.lit(x) for pair in _GROUPS.items() for x in pair])
    nations = table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("borough_name"))
    c = table(spark, folder, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    phase = F.when(cents % 4 == 0, "Nursery").when(cents % 4 == 1, "Primary").when(cents % 4 == 2, "Secondary")
    return c.select(
        "borough_name",
        F.when(cents % 5 == 0, F.lit("Closed")).otherwise(F.lit("Open")).alias("status"),
        F.element_at(groups, F.col("c_mktsegment")).alias("establishment_group"),
        F.when(cents % 17 == 0, F.lit("Pupil referral unit")).otherwise(F.lit("School")).alias("type_of_establishment"),
        F.when(cents % 13 != 0, F.floor(cents / 100)).alias("pupil_capacity"),
        F.floor(cents / 150).alias("current_pupils"),
        phase.alias("ofsted_phase"),
        *[F.pmod(F.floor(cents / (7 + i)), F.lit(6)).alias(g) for i, g in enumerate(GRADED)],
    )


_PUB = "establishment_group IN ('Academies', 'Free Schools', 'Colleges')"
_IND = "establishment_group = 'Independent schools'"
_AVG = ", ".join(f"coalesce(avg({g}) FILTER (WHERE {_PUB} AND {g} BETWEEN 1 AND 4), 0) AS avg_{g}" for g in GRADED)

SCHOOLS_SQL = f"""cents AS (SELECT *, CAST(round_even(c_acctbal * 100, 0) AS BIGINT) AS cents FROM customer JOIN nation ON c_nationkey = n_nationkey),
schools AS (SELECT n_name AS borough, CASE WHEN cents % 5 = 0 THEN 'Closed' ELSE 'Open' END AS status,
    CASE c_mktsegment {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in _GROUPS.items())} END AS establishment_group,
    cents % 17 = 0 AS unit, CASE WHEN cents % 13 <> 0 THEN CAST(floor(cents / 100) AS BIGINT) END AS pupil_capacity,
    CAST(floor(cents / 150) AS BIGINT) AS current_pupils,
    CASE cents % 4 WHEN 0 THEN 'Nursery' WHEN 1 THEN 'Primary' WHEN 2 THEN 'Secondary' END AS ofsted_phase,
    {', '.join(f'((CAST(floor(cents / {7 + i}) AS BIGINT) % 6) + 6) % 6 AS {g}' for i, g in enumerate(GRADED))} FROM cents),
kept AS (SELECT * FROM schools WHERE status <> 'Closed' AND NOT unit AND coalesce(establishment_group <> 'Special schools', true)),
grouped AS (SELECT borough, count(*) AS rows, count(*) FILTER (WHERE {_IND}) AS independent_school_count,
    coalesce(sum(pupil_capacity) FILTER (WHERE {_IND}), 0) AS independent_pupil_capacity,
    coalesce(sum(current_pupils) FILTER (WHERE {_IND}), 0) AS independent_current_pupils,
    count(*) FILTER (WHERE {_PUB}) AS public_funded_school_count,
    coalesce(sum(pupil_capacity) FILTER (WHERE {_PUB}), 0) AS public_funded_pupil_capacity,
    coalesce(sum(current_pupils) FILTER (WHERE {_PUB}), 0) AS public_funded_current_pupils,
    {', '.join(f"count(*) FILTER (WHERE {_PUB} AND ofsted_phase = '{p}') AS public_funded_{p.lower()}" for p in ('Nursery', 'Primary', 'Secondary'))},
    {_AVG} FROM kept GROUP BY borough),
means AS (SELECT {', '.join(f'sum(avg_{g} * rows) / sum(rows) AS lon_avg_{g}' for g in GRADED)} FROM grouped),
rated AS (SELECT *, independent_school_count + public_funded_school_count AS total_school_count,
    {', '.join(f'(avg_{g} - lon_avg_{g}) / nullif(lon_avg_{g}, 0) * 100 AS pct_diff_{g}' for g in GRADED)},
    CAST(independent_school_count AS DOUBLE) / nullif(independent_school_count + public_funded_school_count, 0) * 100 AS pct_of_total_schools_private,
    CAST(public_funded_current_pupils AS DOUBLE) / nullif(public_funded_pupil_capacity, 0) * 100 AS public_funded_pct_capacity_filled,
    CAST(independent_current_pupils AS DOUBLE) / nullif(independent_pupil_capacity, 0) * 100 AS independent_pct_capacity_filled FROM grouped, means),
{ENTITIES_SQL},
q AS (SELECT * FROM entities LEFT JOIN rated ON borough_name = borough)"""

SCHOOLS_SHAPE = " ".join([
    "borough_name:s ons_code:s independent_pupil_capacity:l independent_current_pupils:l independent_school_count:l",
    "public_funded_pupil_capacity:l public_funded_current_pupils:l public_funded_nursery:l public_funded_primary:l public_funded_secondary:l",
    *[f"avg_{g}:d6 lon_avg_{g}:d6 pct_diff_{g}:d6" for g in GRADED],
    "public_funded_school_count:l total_school_count:d2 pct_of_total_schools_private:d6",
    "public_funded_pct_capacity_filled:d6 independent_pct_capacity_filled:d6",
])


@query(SCHOOLS_SHAPE, SCHOOLS_SQL)
def gold_schools(spark, folder):
    """The education rules at group grain, joined onto the entities."""
    return build_matrix(entities(spark, folder), {"school_with_ofsted": _schools(spark, folder)}, EDUCATION_GOLD)


# ---- yearly housing measures ----------------------------------------------------------

YEARLY_SHAPE = " ".join([
    "borough_name:s ons_code:s year:i total_dwellings:d2 affordable_additions:l band_d:l average_price:d2 net_additions:d2",
    *[f"{mean}:d6 {dev}:d6" for mean, dev in HOUSING_DEVIATIONS.values()],
    "yoy_pct_change_average_price:d6 yoy_pct_change_total_dwellings:d6 ratio_of_total_new_house_affordable:d6",
])

YEARLY_SQL = MEASURES_SQL + ", " + ENTITIES_SQL + f""",
averaged AS (SELECT *, {', '.join(f'avg({c}) OVER (PARTITION BY year) AS {mean}' for c, (mean, _) in HOUSING_DEVIATIONS.items())},
    lag(average_price) OVER (PARTITION BY ons_code ORDER BY year) AS price_before,
    lag(total_dwellings) OVER (PARTITION BY ons_code ORDER BY year) AS stock_before FROM measures),
q AS (SELECT borough_name, e.ons_code, a.* EXCLUDE (ons_code), total AS affordable_additions,
    {', '.join(f'({c} - {mean}) / nullif({mean}, 0) * 100 AS {dev}' for c, (mean, dev) in HOUSING_DEVIATIONS.items())},
    (average_price / nullif(price_before, 0) - 1) * 100 AS yoy_pct_change_average_price,
    (total_dwellings / nullif(stock_before, 0) - 1) * 100 AS yoy_pct_change_total_dwellings,
    CAST(total AS DOUBLE) / nullif(net_additions, 0) * 100 AS ratio_of_total_new_house_affordable
    FROM entities e LEFT JOIN averaged a ON e.ons_code = a.ons_code)"""


def yearly_matrix(spark, folder):
    merged = merge_yearly(yearly_measures(spark, folder), HOUSING_YEARS)
    return build_matrix(entities(spark, folder), {"housing_merged": merged}, HOUSING_GOLD)


@query(YEARLY_SHAPE, YEARLY_SQL)
def gold_yearly(spark, folder):
    """Five yearly tables merged, the housing rules, one row per entity and year."""
    return yearly_matrix(spark, folder)


# ---- located stops -------------------------------------------------------------------------

# Entities as a five-by-five block of rectangles in degrees.
_WEST, _SOUTH, _WIDE, _HIGH = -0.5, 51.25, 0.17, 0.08


def _boroughs(spark, folder):
    key = F.col("n_nationkey")
    west, south = F.lit(_WEST) + (key % 5) * F.lit(_WIDE), F.lit(_SOUTH) + F.floor(key / 5) * F.lit(_HIGH)
    east, north = west + F.lit(_WIDE), south + F.lit(_HIGH)
    return ring_layer(table(spark, folder, "nation").select(
        F.col("n_name").alias("BOROUGH"), F.array(west, east, east, west).alias("xs"), F.array(south, south, north, north).alias("ys")
    ))


def _stops(spark, folder):
    points = grid_points(spark, folder).withColumn(
        "line_name",
        F.when(F.col("event_id") % 3 == 0, "Northern, Piccadilly").when(F.col("event_id") % 3 == 1, "Central"),
    )
    return points_in_polygons(grid_to_lonlat(points), _boroughs(spark, folder), ["BOROUGH"])


_STOP_KINDS = {
    "bus_stop_data": "view", "dlr_stop_data": "signup", "elizabeth_stop_data": "purchase", "tramlink_stop_data": "error", "tube_stop_data": "click",
}

STOPS_SQL = LONLAT_SQL + f""",
rects AS (SELECT n_name AS place, {_WEST} + (n_nationkey % 5) * {_WIDE} AS west, {_SOUTH} + floor(n_nationkey / 5) * {_HIGH} AS south FROM nation),
placed AS (SELECT place, event_type, event_id FROM located JOIN rects ON lon > west AND lon < west + {_WIDE} AND lat > south AND lat < south + {_HIGH}),
counts AS (SELECT place, count(*) FILTER (WHERE event_type = 'view') AS bus, count(*) FILTER (WHERE event_type = 'signup') AS dlr,
    count(*) FILTER (WHERE event_type = 'purchase') AS elizabeth, count(*) FILTER (WHERE event_type = 'error') AS tramlink,
    count(*) FILTER (WHERE event_type = 'click') AS tube,
    count(*) FILTER (WHERE event_type = 'click' AND event_id % 3 = 1) AS central, count(*) FILTER (WHERE event_type = 'click' AND event_id % 3 = 0) AS mixed
    FROM placed GROUP BY place),
access AS (SELECT n_name AS place, avg(c_acctbal) AS avg_ptal, CAST(count(*) AS VARCHAR) || 'b' AS ptal FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name),
mean AS (SELECT avg(avg_ptal) AS m FROM access), {ENTITIES_SQL},
q AS (SELECT borough_name, ons_code, avg_ptal, ptal, CASE WHEN access.place IS NOT NULL THEN m END AS lon_avg_ptal_score,
    (avg_ptal - m) / nullif(m, 0) * 100 AS pct_diff_from_avg,
    coalesce(bus, 0) AS bus_count, coalesce(elizabeth, 0) AS elizabeth_count, coalesce(tramlink, 0) AS tramlink_count, coalesce(dlr, 0) AS dlr_count,
    coalesce(tube, 0) AS tube_count, coalesce(nullif(concat_ws(', ', CASE WHEN central > 0 THEN 'Central' END, CASE WHEN mixed > 0 THEN 'Northern, Piccadilly' END,
    CASE WHEN dlr > 0 THEN 'DLR' END, CASE WHEN tramlink > 0 THEN 'Tramlink' END, CASE WHEN elizabeth > 0 THEN 'Elizabeth' END,
    CASE WHEN bus > 0 THEN 'Bus' END), ''), 'None') AS transport_line_name
    FROM entities LEFT JOIN access ON borough_name = access.place LEFT JOIN counts ON borough_name = counts.place, mean)"""


@query("borough_name:s ons_code:s avg_ptal:d4 ptal:s lon_avg_ptal_score:d4 pct_diff_from_avg:d6 bus_count:l elizabeth_count:l "
       "tramlink_count:l dlr_count:l tube_count:l transport_line_name:s", STOPS_SQL)
def gold_stops(spark, folder):
    """Stops from grid points to boroughs, counted by kind, labelled; one absent source is skipped."""
    # Each kind is a subset of the located points, and all of them are counted in one pass.
    stops = _stops(spark, folder)
    sources = {name: Subset(stops, "event_type", kind) for name, kind in _STOP_KINDS.items()}
    nations = table(spark, folder, "nation")
    sources["ptal_data"] = (
        table(spark, folder, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_name").alias("BOROUGH"))
        .agg(F.avg("c_acctbal").alias("avg_ptal"), F.concat(F.count(F.lit(1)).cast("string"), F.lit("b")).alias("ptal"))
    )
    return build_matrix(entities(spark, folder), sources, INFRASTRUCTURE_GOLD)


# ---- layer jobs ---------------------------------------------------------------------------------

def _sheet_years(spark, path) -> list[str]:
    """The sheets there are: one folder each."""
    return sorted(str(r[0]) for r in spark.read.csv(path).select("sheet").distinct().collect())


def _publish_sheets(spark, folder) -> str:
    """Nation-year order counts as text, one folder per year."""
    path = scratch_path(spark, "sheets")
    counts = priority_events(spark, folder).groupBy("year", "ons_code").agg(F.count(F.lit(1)).alias("n"))
    text = counts.select(
        F.col("ons_code"), F.when(F.col("n") % 7 == 0, F.lit("[c]")).otherwise(F.concat(F.lit("£"), F.col("n").cast("string"), F.lit(".50"))),
        F.col("year").alias("sheet"),
    )
    text.repartition("sheet").sortWithinPartitions("sheet", "ons_code").write.partitionBy("sheet").csv(path)
    return path


_STOCK = layout("stock", 1, None, [(0, "ons_code", "STRING"), (1, "amount", "FLOAT"), (5, "_row_number", "INTEGER")])
_RATES = layout("rates", 1, None, [(0, "ons_code", "STRING"), (1, "rounded", "INTEGER")])

_SHEETS_SQL = EVENTS_SQL + """,
sheets AS (SELECT year, ons_code, CASE WHEN count(*) % 7 <> 0 THEN count(*) + 0.5 END AS amount,
    row_number() OVER (PARTITION BY year ORDER BY ons_code) - 1 AS _row_number FROM order_events GROUP BY year, ons_code)"""


@query("ons_code:s year_name:s amount:d2 _row_number:l rounded:l", _SHEETS_SQL + """,
q AS (SELECT ons_code, year AS year_name, amount, _row_number, round_even(amount, 0) AS rounded FROM sheets)""")
def bronze_to_silver(spark, folder):
    """Files per year to a bronze table, two typed tables, and their join."""
    path, root = _publish_sheets(spark, folder), scratch_path(spark, "layers")
    sources = [RawSource(f"{path}/sheet={y}", "orders", y) for y in _sheet_years(spark, path)]
    bronze = run_bronze(spark, sources, root, "orders", widths={"orders": 2}).written["orders"]
    join = SilverJoin("stock_rates", ("stock", "rates"), lambda t: merge_yearly(
        {"stock": t["stock"], "rates": t["rates"].withColumnRenamed("year_name", "year")}, {"stock": "year_name", "rates": "year"}
    ))
    silver = run_silver(spark, [_STOCK, _RATES], {"stock": bronze, "rates": bronze}, root, "orders", [join])
    return spark.read.parquet(silver.written["stock_rates"])


@query("source_sheet:s ons_code:s amount:d2 _row_number:l", _SHEETS_SQL + """,
q AS (SELECT 'Sheet_' || year AS source_sheet, ons_code, amount, _row_number FROM sheets)""")
def budget_sheets(spark, folder):
    """Latest file of each sheet, extracted, tagged and stacked."""
    path, root = _publish_sheets(spark, folder), scratch_path(spark, "budget")
    sheets = []
    for year in _sheet_years(spark, path):
        raw = scan_raw(spark, [RawSource(f"{path}/sheet={year}", "budget", sheet=str(year))], width=2)
        files = SheetFiles(f"Sheet_{year}")
        files.paths.append(write_layer(raw, f"{root}/ingestion_Sheet_{year}-2026-06-13"))
        sheets.append(files)
    return budget_tables(spark, [*sheets, SheetFiles("absent")], _STOCK)


_SERVED = ("ons_code:s year:i total_dwellings:d2 affordable_additions:l band_d:l average_price:d2 net_additions:d2 "
           "yoy_pct_change_average_price:d6 yoy_pct_change_total_dwellings:d6")


@query(_SERVED, YEARLY_SQL)
def serving_sync(spark, folder):
    """Dimension and yearly table upserted in two versions: early years first, then all."""
    root = scratch_path(spark, "serving")
    matrix = spark.read.parquet(write_layer(yearly_matrix(spark, folder), scratch_path(spark, "serving-input")))
    rows = matrix.drop("borough_name")
    names = [(matrix.select("ons_code", "borough_name").distinct(), "ons_code", "borough_name")]
    sync_serving(spark, root, 1, {"borough_housing_historical": rows.filter("year < 1999")}, names)
    paths, _ = sync_serving(spark, root, 2, {"borough_housing_historical": rows}, names)
    return read_version(spark, paths["borough_housing_historical"])


