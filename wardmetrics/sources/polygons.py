"""Polygon layers as two coordinate arrays per ring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmetrics.functions.geo import polygon_text_to_rings, ring_edges, rings_to_polygon_text


def scan_geojson(spark: SparkSession, path: str, properties: str, keep: list[str] | None = None) -> DataFrame:
    """Features of a GeoJSON file: the properties, and ``edges`` over all rings.

    ``properties`` is a DDL string of the attributes to read. Coordinates are
    lon, lat. Polygon and MultiPolygon features are read; holes count as rings
    of the even-odd test.
    """
    schema = (
        "features array<struct<properties: struct<" + _as_struct(properties) + ">, "
        "geometry: struct<type: string, coordinates: variant>>>"
    )
    features = spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("features").alias("f"))
    rings = F.when(
        F.col("f.geometry.type") == "MultiPolygon",
        F.flatten(F.expr("cast(f.geometry.coordinates as array<array<array<array<double>>>>)")),
    ).otherwise(F.expr("try_cast(f.geometry.coordinates as array<array<array<double>>>)"))
    layer = features.select("f.properties.*", rings.alias("_rings"))
    edges = F.flatten(
        F.transform(
            "_rings",
            lambda ring: ring_edges(
                F.transform(ring, lambda p: F.element_at(p, 1)), F.transform(ring, lambda p: F.element_at(p, 2))
            ),
        )
    )
    wanted = keep or [c for c in layer.columns if c != "_rings"]
    return layer.select(*wanted, edges.alias("edges"))


def _as_struct(ddl: str) -> str:
    parts = []
    for item in ddl.split(","):
        name, kind = item.strip().rsplit(" ", 1)
        parts.append(f"{name}: {kind}")
    return ", ".join(parts)


def decode_polygon_text(df: DataFrame, text: str = "polygon") -> DataFrame:
    """Replace ``lat,lon:lat,lon`` text by ``xs`` (lon) and ``ys`` (lat)."""
    ring = polygon_text_to_rings(F.col(text))
    rest = [c for c in df.columns if c != text]
    return df.select(*rest, ring.alias("_ring")).select(*rest, "_ring.xs", "_ring.ys")


def encode_polygon_text(df: DataFrame, text: str = "polygon") -> DataFrame:
    rest = [c for c in df.columns if c not in ("xs", "ys")]
    return df.select(*rest, rings_to_polygon_text(F.col("xs"), F.col("ys")).alias(text))


def ring_layer(df: DataFrame, xs: str = "xs", ys: str = "ys") -> DataFrame:
    """Layer in the shape the spatial join reads, from one ring per row."""
    rest = [c for c in df.columns if c not in (xs, ys)]
    return df.select(*rest, ring_edges(F.col(xs), F.col(ys)).alias("edges"))
