"""Grid coordinates, polygon text and the point-in-ring test."""

from __future__ import annotations

from dataclasses import dataclass
from math import radians

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Ellipsoid:
    a: float
    b: float

    @property
    def e2(self) -> float:
        return 1.0 - (self.b * self.b) / (self.a * self.a)

    @property
    def n(self) -> float:
        return (self.a - self.b) / (self.a + self.b)


# Published parameters of the British National Grid.
AIRY_1830 = Ellipsoid(6377563.396, 6356256.909)
WGS84 = Ellipsoid(6378137.0, 6356752.314245)
FALSE_EASTING = 400000.0
FALSE_NORTHING = -100000.0
ORIGIN_LAT = radians(49.0)
ORIGIN_LON = radians(-2.0)
SCALE = 0.9996012717

# Published seven-parameter shift OSGB36 -> WGS84
# (metres, parts per million, arc seconds).
SHIFT_METRES = (446.448, -125.157, 542.060)
SHIFT_PPM = -20.4894
SHIFT_SECONDS = (0.1502, 0.2470, 0.8421)

# Latitude rounds until the residual is zero in doubles.
LATITUDE_ROUNDS = 4
HEIGHT_ROUNDS = 4


def _meridian_arc(lat: Column) -> Column:
    """Length along the meridian from the origin latitude."""
    n = AIRY_1830.n
    diff, total = lat - ORIGIN_LAT, lat + ORIGIN_LAT
    return (AIRY_1830.b * SCALE) * (
        (1 + n + 1.25 * n**2 + 1.25 * n**3) * diff
        - (3 * n + 3 * n**2 + 2.625 * n**3) * F.sin(diff) * F.cos(total)
        + (1.875 * n**2 + 1.875 * n**3) * F.sin(2 * diff) * F.cos(2 * total)
        - (35.0 / 24.0 * n**3) * F.sin(3 * diff) * F.cos(3 * total)
    )


def grid_steps(easting: Column, northing: Column) -> list[dict[str, Column]]:
    """Staged columns that take a grid point to WGS84 ``lon``/``lat`` in degrees.

    Each stage only reads columns of earlier stages, so every intermediate is
    computed once per row instead of being expanded into one giant expression.
    """
    c = F.col
    stages: list[dict[str, Column]] = [
        {"_e": easting.cast("double"), "_n": northing.cast("double")},
        {"_lat": (c("_n") - FALSE_NORTHING) / (AIRY_1830.a * SCALE) + ORIGIN_LAT},
    ]
    for _ in range(LATITUDE_ROUNDS):
        missing = c("_n") - FALSE_NORTHING - _meridian_arc(c("_lat"))
        stages.append({"_lat": c("_lat") + missing / (AIRY_1830.a * SCALE)})

    s2 = 1 - AIRY_1830.e2 * F.sin(c("_lat")) * F.sin(c("_lat"))
    stages.append({
        "_nu": AIRY_1830.a * SCALE / F.sqrt(s2),
        "_rho": AIRY_1830.a * SCALE * (1 - AIRY_1830.e2) / (s2 * F.sqrt(s2)),
        "_t": F.tan(c("_lat")),
        "_sec": 1 / F.cos(c("_lat")),
        "_de": c("_e") - FALSE_EASTING,
    })
    nu, rho, t, sec, d = c("_nu"), c("_rho"), c("_t"), c("_sec"), c("_de")
    t2, d2 = t * t, d * d
    eta2 = nu / rho - 1
    nu3, nu5, nu7 = nu * nu * nu, nu * nu * nu * nu * nu, nu * nu * nu * nu * nu * nu * nu
    stages.append({
        "_phi": c("_lat")
        - t / (2 * rho * nu) * d2
        + t / (24 * rho * nu3) * (5 + 3 * t2 + eta2 - 9 * t2 * eta2) * d2 * d2
        - t / (720 * rho * nu5) * (61 + 90 * t2 + 45 * t2 * t2) * d2 * d2 * d2,
        "_lam": ORIGIN_LON
        + sec / nu * d
        - sec / (6 * nu3) * (nu / rho + 2 * t2) * d2 * d
        + sec / (120 * nu5) * (5 + 28 * t2 + 24 * t2 * t2) * d2 * d2 * d
        - sec / (5040 * nu7) * (61 + 662 * t2 + 1320 * t2 * t2 + 720 * t2 * t2 * t2) * d2 * d2 * d2 * d,
    })

    # Earth-centred coordinates on the old ellipsoid, shifted to the new one.
    stages.append({
        "_k": AIRY_1830.a / F.sqrt(1 - AIRY_1830.e2 * F.sin(c("_phi")) * F.sin(c("_phi"))),
    })
    stages.append({
        "_x": c("_k") * F.cos(c("_phi")) * F.cos(c("_lam")),
        "_y": c("_k") * F.cos(c("_phi")) * F.sin(c("_lam")),
        "_z": (1 - AIRY_1830.e2) * c("_k") * F.sin(c("_phi")),
    })
    grow = 1 + SHIFT_PPM * 1e-6
    rx, ry, rz = (radians(seconds / 3600.0) for seconds in SHIFT_SECONDS)
    tx, ty, tz = SHIFT_METRES
    x, y, z = c("_x"), c("_y"), c("_z")
    stages.append({
        "_x2": tx + grow * x - rz * y + ry * z,
        "_y2": ty + rz * x + grow * y - rx * z,
        "_z2": tz - ry * x + rx * y + grow * z,
    })
    stages.append({"_p": F.sqrt(c("_x2") * c("_x2") + c("_y2") * c("_y2"))})
    stages.append({"_phi2": F.atan2(c("_z2"), c("_p") * (1 - WGS84.e2))})
    for _ in range(HEIGHT_ROUNDS):
        k2 = WGS84.a / F.sqrt(1 - WGS84.e2 * F.sin(c("_phi2")) * F.sin(c("_phi2")))
        stages.append({"_phi2": F.atan2(c("_z2") + WGS84.e2 * k2 * F.sin(c("_phi2")), c("_p"))})
    stages.append({"lon": F.degrees(F.atan2(c("_y2"), c("_x2"))), "lat": F.degrees(c("_phi2"))})
    return stages


def polygon_text_to_rings(text: Column) -> Column:
    """``lat,lon:lat,lon`` -> struct of ``xs`` (lon) and ``ys`` (lat)."""
    points = F.split(text, ":")
    return F.struct(
        F.transform(points, lambda p: F.element_at(F.split(p, ","), 2).try_cast("double")).alias("xs"),
        F.transform(points, lambda p: F.element_at(F.split(p, ","), 1).try_cast("double")).alias("ys"),
    )


def rings_to_polygon_text(xs: Column, ys: Column) -> Column:
    """``xs`` (lon) and ``ys`` (lat) -> ``lat,lon:lat,lon``."""
    pairs = F.zip_with(ys, xs, lambda lat, lon: F.concat_ws(",", lat.cast("string"), lon.cast("string")))
    return F.array_join(pairs, ":")


def ring_edges(xs: Column, ys: Column) -> Column:
    """Edges of a ring as an array of structs; the ring closes itself."""
    size = F.size(xs)
    return F.transform(
        F.sequence(F.lit(1), size),
        lambda i: F.struct(
            F.element_at(xs, i).alias("x1"),
            F.element_at(ys, i).alias("y1"),
            F.element_at(xs, F.when(i == size, F.lit(1)).otherwise(i + 1)).alias("x2"),
            F.element_at(ys, F.when(i == size, F.lit(1)).otherwise(i + 1)).alias("y2"),
        ),
    )


def crossings_right(edges: Column, x: Column, y: Column) -> Column:
    """How many edges a ray from (x, y) towards larger x crosses."""
    return F.size(
        F.filter(
            edges,
            lambda e: ((e.y1 > y) != (e.y2 > y)) & (x < (e.x2 - e.x1) * (y - e.y1) / F.nullif(e.y2 - e.y1, F.lit(0.0)) + e.x1),
        )
    )


def on_edge(edges: Column, x: Column, y: Column) -> Column:
    """True where (x, y) lies on one of the edges."""
    return F.exists(
        edges,
        lambda e: (x >= F.least(e.x1, e.x2))
        & (x <= F.greatest(e.x1, e.x2))
        & (y >= F.least(e.y1, e.y2))
        & (y <= F.greatest(e.y1, e.y2))
        & ((e.x2 - e.x1) * (y - e.y1) == (x - e.x1) * (e.y2 - e.y1)),
    )


def within_edges(edges: Column, x: Column, y: Column) -> Column:
    """Even-odd test over all rings' edges; points on the boundary are outside."""
    return (crossings_right(edges, x, y) % 2 == 1) & ~on_edge(edges, x, y)
