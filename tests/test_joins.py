import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from wardmetrics.operators.joins import grain_merge, merge, merge_chain
from wardmetrics.operators.reshape import ensure_year, first_by_key, latest, pivot_categories
from wardmetrics.operators.spatial import drop_layer_attributes, grid_to_lonlat, points_in_polygons
from wardmetrics.plans.gold import GoldGrain
from wardmetrics.sinks.upsert import entity_dimension, upsert
from wardmetrics.sources.polygons import decode_polygon_text, encode_polygon_text, ring_layer, scan_geojson


def test_merge_null_keys_and_suffixes(spark):
    a = spark.createDataFrame([(1, "x"), (None, "y")], "k int, v string")
    b = spark.createDataFrame([(None, "n"), (2, "m")], "k int, v string")
    assert rows(merge(a, b, "k")) == [(1, "x", None), (None, "y", "n")]
    assert merge(a, b, "k").columns == ["k", "v_x", "v_y"]
    assert rows(merge(a, b, "k", null_keys_match=False)) == [(1, "x", None), (None, "y", None)]
    assert rows(merge(a, b, "k", "outer", ("", "_b"))) == [(1, "x", None), (2, None, "m"), (None, "y", "n")]
    assert rows(merge(a, b, "k", "right", ("", "_b"))) == [(2, None, "m"), (None, "y", "n")]


def test_merge_chain_suffix_and_fan_out(spark):
    frames = {n: spark.createDataFrame([(1, i)] * (i + 1), "k int, v int") for i, n in enumerate(["a", "b", "c"])}
    out = merge_chain(frames, "k")
    assert out.columns == ["k", "v", "v_b", "v_c"] and out.count() == 6


def test_grain_merge_keys(spark):
    base = spark.createDataFrame([("Barking and Dagenham", 2023), ("Barnet", None), ("Brent", 2023)], "borough_name string, year int")
    other = spark.createDataFrame([(" barking & dagenham", 2023.0, 7), ("BARNET", None, 8), ("Camden", 2023.0, 9)], "b string, y double, m int")
    got = grain_merge(base, other, {"borough_name": "b", "year": "y"})
    assert got.columns == ["borough_name", "year", "m"]
    assert rows(got) == [("Barking and Dagenham", 2023, 7), ("Barnet", None, 8), ("Brent", 2023, None)]
    assert grain_merge(base, other, {"borough_name": "b", "year": "y"}, "outer").count() == 4
    assert grain_merge(base, other, {"borough_name": "b", "year": "y"}, "inner").count() == 2
    with pytest.raises(KeyError):
        grain_merge(base, other, {"borough_name": "nope"})
    grain = GoldGrain(base).merge_metric(other.drop("y"), {"borough_name": "b"})
    assert grain.base_df.columns == ["borough_name", "year", "m"]


def test_grain_merge_collision(spark):
    base = spark.createDataFrame([("a", 1)], "k string, year int")
    other = spark.createDataFrame([("a", 2)], "k2 string, year int")
    assert grain_merge(base, other, {"k": "k2"}).columns == ["k", "year_x", "year_y"]


def test_pivot_drops_nulls(spark):
    df = spark.createDataFrame([(2020, "x", "A-b", 1.0), (2020, "x", "A-b", 3.0), (2020, "y", "A-b", None), (None, "z", "c", 1.0)], "year int, borough string, category string, annualised_rate double")
    out = pivot_categories(df, ["a_b", "c"])
    assert out.columns == ["year", "borough", "a_b_annualised_rate", "c_annualised_rate"]
    assert rows(out) == [(2020, "x", 2.0, None)]


def test_year_and_latest_and_first(spark):
    df = spark.createDataFrame([("2021", 1), ("2023", 2)], "year_name string, v int")
    assert rows(latest(ensure_year(df)), "year", "v") == [(2023, 2)]
    with pytest.raises(ValueError):
        ensure_year(df.drop("year_name"))
    assert rows(first_by_key(ensure_year(df).withColumn("k", F.lit(1)), "k", [F.col("year") * -1]), "v") == [(2,)]


def test_upsert_and_dimension(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    new = spark.createDataFrame([(2, "B1", 1), (2, "B2", 2), (None, "C", 1), (3, "D", 1)], "k int, v string, t int")
    assert rows(upsert(old, new, "k", [F.col("t") * -1]), "k", "v") == [(1, "a"), (2, "B2"), (3, "D"), (None, "C")]
    first = spark.createDataFrame([("E1", None), ("E2", "Two")], "c string, n string")
    second = spark.createDataFrame([("E1", "One"), ("E3", "Three")], "c string, n string")
    sources = [(first, "c", "n"), (second, "c", "n")]
    assert rows(entity_dimension(sources)) == [("E2", "Two"), ("E3", "Three")]
    assert rows(entity_dimension(sources, skip_null_names=True)) == [("E1", "One"), ("E2", "Two"), ("E3", "Three")]


def test_grid_to_lonlat_known_point(spark):
    # The worked example of the published projection guide; its WGS84 place is metre-level public knowledge.
    df = spark.createDataFrame([(651409.903, 313177.270, "keep")], "easting double, northing double, z string")
    out = grid_to_lonlat(df).first()
    assert out["lat"] == pytest.approx(52.65798, abs=2e-5) and out["lon"] == pytest.approx(1.71605, abs=2e-5)
    assert out["z"] == "keep"
    first_two = grid_to_lonlat(df.toDF("a", "b", "z")).first()
    assert first_two["lat"] == out["lat"]


def brute_force(ring_sets, x, y):
    inside = False
    for ring in ring_sets:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2) and (x2 - x1) * (y - y1) == (x - x1) * (y2 - y1):
                return False
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                inside = not inside
    return inside


@pytest.mark.parametrize("unit", [1.0, 1e5, 1e-7])
def test_points_in_polygons_against_brute_force(spark, unit, monkeypatch):
    rnd = random.Random(3)
    polygons = []
    for p in range(12):
        cx, cy, r = rnd.uniform(-5, 5), rnd.uniform(-5, 5), rnd.uniform(0.5, 4)
        turns = sorted(rnd.uniform(0, 2 * math.pi) for _ in range(rnd.randint(3, 9)))
        polygons.append((p, [(cx + r * rnd.uniform(0.4, 1) * math.cos(t), cy + r * rnd.uniform(0.4, 1) * math.sin(t)) for t in turns]))
    polygons.append((99, [(-1.0, -1.0), (1.0, -1.0), (1.0, 1.0), (-1.0, 1.0)]))
    # A star of 300 corners and a dot-sized square beside it: quadtrees of many levels.
    polygons.append((77, [(5 * rnd.uniform(0.3, 1) * math.cos(t / 300 * math.tau), 5 * rnd.uniform(0.3, 1) * math.sin(t / 300 * math.tau)) for t in range(300)]))
    polygons.append((88, [(0.5, 0.5), (0.51, 0.5), (0.51, 0.51), (0.5, 0.51)]))
    polygons = [(p, [(x * unit, y * unit) for x, y in r]) for p, r in polygons]
    layer = ring_layer(spark.createDataFrame([(p, [x for x, _ in r], [y for _, y in r]) for p, r in polygons], "poly int, xs array<double>, ys array<double>"))
    points = [(i, rnd.uniform(-7, 7), rnd.uniform(-7, 7)) for i in range(400)] + [(900, 1.0, 0.0), (901, 0.0, -1.0), (902, -1.0, -1.0), (903, None, 2.0), (904, 0.505, 0.505), (905, 1e30, 1e30)]
    points = [(i, x if x is None else x * unit, y * unit) for i, x, y in points]
    df = spark.createDataFrame(points, "id int, lon double, lat double")
    got = set(rows(points_in_polygons(df, layer, ["poly"]), "id", "poly"))
    assert set(rows(points_in_polygons(df, layer, ["poly"], how="inner"), "id", "poly")) == {g for g in got if g[1] is not None}
    want = set()
    for i, x, y in points:
        hits = [p for p, r in polygons if x is not None and brute_force([r], x, y)]
        want |= {(i, p) for p in hits} or {(i, None)}
    assert got == want
    assert (903, None) in got and (900, 99) not in got


def test_geojson_with_hole_and_multipolygon(spark, tmp_path):
    square = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]
    hole = [[1, 1], [3, 1], [3, 3], [1, 3], [1, 1]]
    far = [[10, 10], [11, 10], [11, 11], [10, 11], [10, 10]]
    import json

    path = tmp_path / "layer.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": [
        {"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [square, hole]}, "properties": {"BOROUGH": "A", "X": 1}},
        {"type": "Feature", "geometry": {"type": "MultiPolygon", "coordinates": [[far], [[[20, 20], [21, 20], [21, 21], [20, 20]]]]}, "properties": {"BOROUGH": "B", "X": 2}},
    ]}))
    layer = scan_geojson(spark, str(path), "BOROUGH string, X long", keep=["BOROUGH"])
    df = spark.createDataFrame([(0.5, 0.5), (2.0, 2.0), (10.5, 10.5), (20.8, 20.2), (9.0, 9.0)], "lon double, lat double")
    got = rows(points_in_polygons(df, layer, ["BOROUGH"]), "lon", "BOROUGH")
    assert dict(got) == {0.5: "A", 2.0: None, 10.5: "B", 20.8: "B", 9.0: None}
    with pytest.raises(ValueError):
        points_in_polygons(df.withColumn("BOROUGH", F.lit(1)), layer, ["BOROUGH"])


def test_polygon_text_swaps_axes(spark):
    df = spark.createDataFrame([("A", "51.5,-0.1:51.6,0.25")], "b string, polygon string")
    ring = decode_polygon_text(df)
    assert tuple(ring.select("xs", "ys").first()) == ([-0.1, 0.25], [51.5, 51.6])
    assert encode_polygon_text(ring).first()["polygon"] == "51.5,-0.1:51.6,0.25"


def test_drop_layer_attributes(spark):
    df = spark.createDataFrame([(1, 2, 3)], "X int, CODE int, year_name int")
    assert drop_layer_attributes(df).columns == ["X"]


def test_fractional_and_huge_keys_keep_apart(spark):
    left = spark.createDataFrame([(1.7,), (2.0,), (1e30,), (None,)], "k double")
    right = spark.createDataFrame([(1.2, "a"), (1.9, "b"), (2.0, "c"), (1e30, "d")], "k2 double, v string")
    got = rows(grain_merge(left, right, {"k": "k2"}).select("k", "v"))
    assert got == [(1.7, None), (1e30, "d"), (2.0, "c"), (None, None)]


def test_points_at_nan_are_in_no_polygon(spark):
    layer = ring_layer(spark.createDataFrame([("A", [-1.0, 1.0, 1.0, -1.0], [-1.0, -1.0, 1.0, 1.0])], "name string, xs array<double>, ys array<double>"))
    nan = float("nan")
    points = spark.createDataFrame([(1, 0.3, 0.3), (2, nan, nan), (3, nan, 0.3), (4, None, 0.3)], "id int, lon double, lat double")
    assert rows(points_in_polygons(points, layer, ["name"]).select("id", "name")) == [(1, "A"), (2, None), (3, None), (4, None)]
    assert rows(points_in_polygons(points, layer, ["name"], how="inner").select("id", "name")) == [(1, "A")]


def test_a_layer_in_metres_needs_no_more_cells_than_one_in_degrees(spark):
    from wardmetrics.operators.spatial import cover_cells

    ring = [(math.cos(t / 500 * math.tau), math.sin(t / 500 * math.tau)) for t in range(500)]
    counts = []
    for unit in (1.0, 1e6, 3e-5):
        layer = ring_layer(spark.createDataFrame([("A", [x * unit for x, _ in ring], [y * unit for _, y in ring])], "name string, xs array<double>, ys array<double>"))
        counts.append(cover_cells(layer, ["name"]).count())
    assert max(counts) <= 4 * min(counts) and max(counts) < 2000


def test_layers_without_polygons_and_many_edges_at_one_corner(spark):
    points = spark.createDataFrame([(1, 0.3, 0.3), (2, 0.7, 0.1)], "id int, lon double, lat double")
    kinds = "name string, xs array<double>, ys array<double>"
    empty = ring_layer(spark.createDataFrame([], kinds))
    assert rows(points_in_polygons(points, empty, ["name"]).select("id", "name")) == [(1, None), (2, None)]
    assert points_in_polygons(points, empty, ["name"], how="inner").count() == 0
    nan = float("nan")
    # A fan of forty spikes that all touch the origin, a ring with a NaN, a ring that is one point.
    fan = [p for k in range(40) for p in ((0.0, 0.0), (math.cos(k / 30), math.sin(k / 30)), (math.cos(k / 30 + 0.01), math.sin(k / 30 + 0.01)))]
    layer = ring_layer(spark.createDataFrame([("fan", [x for x, _ in fan], [y for _, y in fan]), ("nan", [0.0, nan, 1.0], [0.0, 1.0, 1.0]), ("dot", [0.3] * 3, [0.3] * 3)], kinds))
    many = spark.createDataFrame([(i, math.cos(i / 100) * 0.5, math.sin(i / 100) * 0.5) for i in range(150)], "id int, lon double, lat double")
    got = dict(rows(points_in_polygons(many, layer, ["name"]), "id", "name"))
    assert got == {i: "fan" if brute_force([fan], math.cos(i / 100) * 0.5, math.sin(i / 100) * 0.5) else None for i in range(150)}
