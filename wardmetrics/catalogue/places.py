"""Grid conversion, polygon text and point-in-polygon joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardmetrics.catalogue.registry import query
from wardmetrics.catalogue.tables import POINTS_SQL, grid_points, table
from wardmetrics.functions import geo
from wardmetrics.operators.spatial import grid_to_lonlat, points_in_polygons
from wardmetrics.sources.polygons import decode_polygon_text, encode_polygon_text, ring_layer

_A, _B = geo.AIRY_1830.a, geo.AIRY_1830.b
_E2, _N, _W2 = geo.AIRY_1830.e2, geo.AIRY_1830.n, geo.WGS84.e2
_S = geo.SCALE
_LAT0, _LON0 = geo.ORIGIN_LAT, geo.ORIGIN_LON


def _arc_sql(lat: str) -> str:
    d, s = f"({lat} - {_LAT0})", f"({lat} + {_LAT0})"
    return (
        f"{_B * _S} * ({1 + _N + 1.25 * _N**2 + 1.25 * _N**3} * {d} - {3 * _N + 3 * _N**2 + 2.625 * _N**3} * sin({d}) * cos({s})"
        f" + {1.875 * _N**2 + 1.875 * _N**3} * sin(2 * {d}) * cos(2 * {s}) - {35 / 24 * _N**3} * sin(3 * {d}) * cos(3 * {s}))"
    )


def _lonlat_sql() -> str:
    """Closed-form grid conversion, one CTE per step."""
    steps = [f"""g0 AS (SELECT *, ("Y" + 100000.0) / {_A * _S} + {_LAT0} AS lat0, "X" - 400000.0 AS d FROM points)"""]
    for i in range(4):
        steps.append(f"""g{i + 1} AS (SELECT *, lat{i} + ("Y" + 100000.0 - {_arc_sql(f'lat{i}')}) / {_A * _S} AS lat{i + 1} FROM g{i})""")
    steps.append(f"""h1 AS (SELECT *, {_A * _S} / sqrt(1 - {_E2} * sin(lat4) ** 2) AS nu,
        {_A * _S * (1 - _E2)} / (1 - {_E2} * sin(lat4) ** 2) ** 1.5 AS rho, tan(lat4) AS t, 1 / cos(lat4) AS sc FROM g4)""")
    steps.append(f"""h2 AS (SELECT *, lat4 - t / (2 * rho * nu) * d ** 2
            + t / (24 * rho * nu ** 3) * (5 + 3 * t ** 2 + nu / rho - 1 - 9 * t ** 2 * (nu / rho - 1)) * d ** 4
            - t / (720 * rho * nu ** 5) * (61 + 90 * t ** 2 + 45 * t ** 4) * d ** 6 AS phi,
        {_LON0} + sc / nu * d - sc / (6 * nu ** 3) * (nu / rho + 2 * t ** 2) * d ** 3
            + sc / (120 * nu ** 5) * (5 + 28 * t ** 2 + 24 * t ** 4) * d ** 5
            - sc / (5040 * nu ** 7) * (61 + 662 * t ** 2 + 1320 * t ** 4 + 720 * t ** 6) * d ** 7 AS lam FROM h1)""")
    steps.append(f"h3 AS (SELECT *, {_A} / sqrt(1 - {_E2} * sin(phi) ** 2) AS k FROM h2)")
    steps.append(f"h4 AS (SELECT *, k * cos(phi) * cos(lam) AS x1, k * cos(phi) * sin(lam) AS y1, {1 - _E2} * k * sin(phi) AS z1 FROM h3)")
    sec = "0.00000484813681109536"
    rx, ry, rz = (f"({seconds} * {sec})" for seconds in geo.SHIFT_SECONDS)
    tx, ty, tz = geo.SHIFT_METRES
    grow = f"(1 + {geo.SHIFT_PPM} * 1e-6)"
    steps.append(f"""h5 AS (SELECT *, {tx} + {grow} * x1 - {rz} * y1 + {ry} * z1 AS x2, {ty} + {rz} * x1 + {grow} * y1 - {rx} * z1 AS y2,
        {tz} - {ry} * x1 + {rx} * y1 + {grow} * z1 AS z2 FROM h4)""")
    steps.append(f"w0 AS (SELECT *, sqrt(x2 ** 2 + y2 ** 2) AS p, atan2(z2, sqrt(x2 ** 2 + y2 ** 2) * {1 - _W2}) AS f0 FROM h5)")
    for i in range(4):
        steps.append(f"""w{i + 1} AS (SELECT *, atan2(z2 + {_W2} * {geo.WGS84.a} / sqrt(1 - {_W2} * sin(f{i}) ** 2) * sin(f{i}), p) AS f{i + 1} FROM w{i})""")
    steps.append("""located AS (SELECT event_id, event_type, "X", "Y", degrees(atan2(y2, x2)) AS lon, degrees(f4) AS lat FROM w4)""")
    return ", ".join(steps)


LONLAT_SQL = POINTS_SQL + ", " + _lonlat_sql()


@query("event_id:l X:d2 Y:d2 lon:d6 lat:d6", LONLAT_SQL + ", q AS (SELECT * FROM located)")
def grid_to_lonlat_points(spark, folder):
    return grid_to_lonlat(grid_points(spark, folder))


# ---- polygon layers from the part table: a rectangle or a triangle per part ------------------


def _shapes(spark, folder):
    """Parts as shapes on a strip that widens with them: squares and right triangles of side 10 + p_size, every second one a triangle."""
    left, low = F.col("p_partkey") * 37, F.col("p_partkey") * 91 % 150
    side = F.col("p_size") + 10
    right, top = left + side, low + side
    triangle = F.col("p_partkey") % 2 == 1
    xs = F.when(triangle, F.array(left, right, left)).otherwise(F.array(left, right, right, left))
    ys = F.when(triangle, F.array(low, low, top)).otherwise(F.array(low, low, top, top))
    return table(spark, folder, "part").select(
        "p_partkey", F.transform(xs, lambda v: v.cast("double")).alias("xs"), F.transform(ys, lambda v: v.cast("double")).alias("ys")
    )


_SHAPES_SQL = """shapes AS (SELECT p_partkey, CAST(p_partkey * 37 AS DOUBLE) AS x0, CAST(p_partkey * 91 % 150 AS DOUBLE) AS y0,
    CAST(p_size + 10 AS DOUBLE) AS side, p_partkey % 2 = 1 AS triangle FROM part)"""

_DOTS_SQL = """dots AS (SELECT event_id, CASE WHEN event_type <> 'error' AND event_id % 50 <> 7 THEN CAST(event_id * 74 // 5 AS DOUBLE) / 2 END AS px,
    CAST(event_id * 104729 % 423 AS DOUBLE) / 2 AS py FROM events)"""


def _dots(spark, folder):
    """Events as points along the same strip; some lie on edges, some nowhere, some have no place (null or NaN)."""
    e = table(spark, folder, "events")
    return e.select(
        "event_id",
        F.when(F.col("event_id") % 50 == 7, F.lit(float("nan"))).otherwise(
            F.when(F.col("event_type") != "error", F.expr("event_id * 74 div 5").cast("double") / 2)
        ).alias("px"),
        ((F.col("event_id") * 104729 % 423).cast("double") / 2).alias("py"),
    )


_INSIDE_SQL = """px > x0 AND py > y0 AND px < x0 + side AND py < y0 + side AND (NOT triangle OR (px - x0) + (py - y0) < side)"""


@query("event_id:l px:d2 py:d2 p_partkey:l", _SHAPES_SQL + ", " + _DOTS_SQL + f""", hits AS (SELECT event_id, px, py, p_partkey FROM dots JOIN shapes ON {_INSIDE_SQL}),
q AS (SELECT * FROM hits UNION ALL SELECT event_id, px, py, NULL FROM dots WHERE event_id NOT IN (SELECT event_id FROM hits))""")
def points_in_polygons_grid(spark, folder):
    """Points within overlapping shapes through their quadtrees; unmatched points stay."""
    layer = ring_layer(_shapes(spark, folder))
    placed = points_in_polygons(_dots(spark, folder), layer, ["p_partkey"], "px", "py")
    return placed.withColumn("px", F.nanvl("px", F.lit(None).cast("double")))


@query("event_id:l px:d2 py:d2 p_partkey:l", _SHAPES_SQL + ", " + _DOTS_SQL + f", q AS (SELECT * FROM dots JOIN shapes ON {_INSIDE_SQL})")
def points_in_polygons_coarse(spark, folder):
    """The same layer, matched points only."""
    layer = ring_layer(_shapes(spark, folder))
    return points_in_polygons(_dots(spark, folder), layer, ["p_partkey"], "px", "py", how="inner")


@query("p_partkey:l polygon:s", _SHAPES_SQL + """, q AS (SELECT p_partkey, CASE WHEN triangle
    THEN concat_ws(':', y0 || ',' || x0, y0 || ',' || (x0 + side), (y0 + side) || ',' || x0)
    ELSE concat_ws(':', y0 || ',' || x0, y0 || ',' || (x0 + side), (y0 + side) || ',' || (x0 + side), (y0 + side) || ',' || x0) END AS polygon FROM shapes)""")
def polygon_text_encode(spark, folder):
    """Rings as lat,lon text."""
    return encode_polygon_text(_shapes(spark, folder))


@query("p_partkey:l corners:l x_sum:d2 y_sum:d2", _SHAPES_SQL + """, q AS (SELECT p_partkey, CASE WHEN triangle THEN 3 ELSE 4 END AS corners,
    CASE WHEN triangle THEN 3 * x0 + side ELSE 4 * x0 + 2 * side END AS x_sum, CASE WHEN triangle THEN 3 * y0 + side ELSE 4 * y0 + 2 * side END AS y_sum FROM shapes)""")
def polygon_text_decode(spark, folder):
    """Text back to coordinate arrays; axis order is swapped on both ways."""
    back = decode_polygon_text(encode_polygon_text(_shapes(spark, folder)))

    def total(name):
        return F.aggregate(name, F.lit(0.0), lambda acc, v: acc + v)

    return back.select("p_partkey", F.size("xs").alias("corners"), total("xs").alias("x_sum"), total("ys").alias("y_sum"))
