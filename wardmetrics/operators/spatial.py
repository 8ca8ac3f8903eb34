"""Point-in-polygon joins over quadtrees of cells."""

from __future__ import annotations

import math
import sys
from collections import deque
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardmetrics.functions.geo import grid_steps, within_edges
from wardmetrics.session import read_once, written

# The cover of a layer travels with its code: workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

EASTING_NAMES = ("easting", "x", "X")
NORTHING_NAMES = ("northing", "y", "Y")

# Attributes of the borough layer that are dropped after the join.
LAYER_ATTRIBUTES = (
    "geometry", "index_right", "NUMBER_", "CODE", "HECTARES",
    "DESCRIPT0", "X_right", "Y_right", "AREA", "OBJECTID",
    "FILE_NAME", "Shape__Are", "Shape__Len", "GlobalID", "year_name",
)


def grid_to_lonlat(df: DataFrame, easting: str | None = None, northing: str | None = None) -> DataFrame:
    """Add WGS84 ``lon`` and ``lat`` to British National Grid points.

    Without names the usual ones are looked for, then the first two columns are
    taken. The datum shift is the published seven-parameter one: metre level
    against grid-based conversions.
    """
    x = easting or next((c for c in EASTING_NAMES if c in df.columns), None)
    y = northing or next((c for c in NORTHING_NAMES if c in df.columns), None)
    if x is None or y is None:
        x, y = df.columns[0], df.columns[1]
    kept = [c for c in df.columns if c not in ("lon", "lat")]
    out = df
    for stage in grid_steps(F.col(f"`{x}`"), F.col(f"`{y}`")):
        out = out.withColumns(stage)
    # The one-element explode keeps later predicates on lon or lat above the stages;
    # pushed through them they would be expanded stage by stage. Predicates on the
    # other columns still pass.
    pair = F.explode(F.array(F.struct("lon", "lat"))).alias("_place")
    return out.select(*[f"`{c}`" for c in kept], pair).select(*[f"`{c}`" for c in kept], "_place.lon", "_place.lat")


# A cell that more edges enter is cut into four by four, as long as the polygon has no more cells than this and four for each edge.
EDGES_IN_CELL = 8
FEW_CELLS = 64


class _Shapes:
    """The polygons of a batch: edges end to end, boxes, and the square each one begins with."""

    def __init__(self, lists: pa.ListArray):
        flat, offsets = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
        self.first = offsets[:-1] - offsets[0]
        self.size = np.where(lists.is_null().to_numpy(zero_copy_only=False), 0, np.diff(offsets))
        x1, y1, x2, y2 = self.corners = tuple(flat.field(c).to_numpy(zero_copy_only=False).astype(float) for c in _CORNERS)
        self.left, self.right, self.low, self.high = np.minimum(x1, x2), np.maximum(x1, x2), np.minimum(y1, y2), np.maximum(y1, y2)
        some = np.flatnonzero(self.size)
        box = np.full((4, len(self.size)), np.nan)
        for i, (values, pick) in enumerate(((self.left, np.minimum), (self.right, np.maximum), (self.low, np.minimum), (self.high, np.maximum))):
            if len(some):
                box[i, some] = pick.reduceat(values, self.first[some])
        self.box = box
        # Polygons without an edge, or with one that is nowhere, have no cells.
        self.placed = np.isfinite(box).all(0)
        known = np.where(self.placed, box, 0.0)
        self.reach = np.maximum(abs(known).max(0), 1e-300)
        # Not so small beside the coordinates that a cell's number would lose digits.
        self.finest = np.frexp(self.reach)[1].astype(np.int64) - 48
        span = np.maximum(known[1] - known[0], known[3] - known[2])
        level = np.maximum(np.where(span > 0, np.frexp(span)[1], self.finest), self.finest).astype(np.int64)
        self.level = level + level % 2
        side = np.exp2(self.level.astype(float))
        self.at = np.floor(known / side).astype(np.int64)  # first and last column, first and last row

    def simple(self) -> tuple[np.ndarray, ...]:
        """(polygon, level, column, row) of polygons of few edges: the squares they begin with, at most four."""
        few = np.flatnonzero(self.placed & (self.size <= EDGES_IN_CELL))
        wide, high = (self.at[1] - self.at[0] + 1)[few], (self.at[3] - self.at[2] + 1)[few]
        each = wide * high
        n = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        of, per_row = np.repeat(few, each), np.repeat(wide, each)
        return of, self.level[of], self.at[0][of] + n % per_row, self.at[2][of] + n // per_row


def _cover(shapes: _Shapes, n: int) -> Iterator[tuple[int, int, int, np.ndarray | None]]:
    """(level, column, row, edges) of the cells of one polygon; no edges where the cell lies wholly inside.

    A cell of level k is a square of side 2**k, so its borders are exact. A cell
    no edge enters is settled here; others keep the edges a ray to the right can
    meet. Cells outside are left out.
    """
    own = slice(shapes.first[n], shapes.first[n] + shapes.size[n])
    x1, y1, x2, y2 = (c[own] for c in shapes.corners)
    left_of, right_of, low_of, high_of = (v[own] for v in (shapes.left, shapes.right, shapes.low, shapes.high))
    dx, dy = x2 - x1, y2 - y1
    # What rounding can do to the side of a line that a corner is on.
    doubt = 1e-12 * (abs(dx) + abs(dy)) * shapes.reach[n]
    columns, rows = (range(int(shapes.at[i, n]), int(shapes.at[i + 1, n]) + 1) for i in (0, 2))
    queue = deque((int(shapes.level[n]), i, j, np.arange(len(x1))) for i in columns for j in rows)
    cells, most = len(queue), FEW_CELLS + 4 * len(x1)
    while queue:
        level, i, j, edges = queue.popleft()
        side = 2.0**level
        left, low = i * side, j * side
        edges = edges[(high_of[edges] >= low) & (low_of[edges] <= low + side) & (right_of[edges] >= left)]
        near = edges[left_of[edges] <= left + side]
        turns = [dx[near] * (low + b - y1[near]) - dy[near] * (left + a - x1[near]) for a in (0.0, side) for b in (0.0, side)]
        entered = np.count_nonzero((np.min(turns, 0) <= doubt[near]) & (np.max(turns, 0) >= -doubt[near]))
        if not entered:
            x, y = left + side / 2, low + side / 2
            a, b = y1[edges], y2[edges]
            across = edges[(a > y) != (b > y)]
            if np.count_nonzero(x < (x2[across] - x1[across]) * (y - y1[across]) / (y2[across] - y1[across]) + x1[across]) % 2:
                yield level, i, j, None
        elif entered <= EDGES_IN_CELL or cells > most or level - 2 < shapes.finest[n]:
            yield level, i, j, edges
        else:
            cells += 15
            queue.extend((level - 2, 4 * i + di, 4 * j + dj, edges) for di in range(4) for dj in range(4))


_CORNERS = ("x1", "y1", "x2", "y2")
_EDGE = pa.struct([(c, pa.float64()) for c in _CORNERS])


def cover_cells(layer: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """The cells of each polygon of a layer: its own quadtree, as deep as its edges are dense.

    Columns: the attributes, ``_level``, ``_cx``, ``_cy``, the polygon's box, and
    ``_inside`` or the ``_edges`` a point of the cell is tested with. A polygon
    begins with at most four cells of its own size, whatever its unit, so small
    and large polygons of one layer each have few.
    """
    source = layer.select(*[F.col(f"`{a}`") for a in attributes], F.col("edges"))
    box = ("_xlo", "_xhi", "_ylo", "_yhi")
    edge = "array<struct<" + ",".join(f"{c}:double" for c in _CORNERS) + ">>"
    new = T.StructType.fromDDL("_level int, _cx long, _cy long, " + ", ".join(f"{b} double" for b in box) + f", _inside boolean, _edges {edge}")
    out = T.StructType([*[source.schema[a] for a in attributes], *new.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 2048):
                batch = whole.slice(start, 2048)
                shapes = _Shapes(batch.column(len(attributes)))
                of, level, i, j = shapes.simple()
                if len(of):
                    yield made(batch, shapes, of, level, i, j, np.zeros(len(of), bool), shapes.size[of], ranges(shapes.first[of], shapes.size[of]))
                for n in np.flatnonzero(shapes.placed & (shapes.size > EDGES_IN_CELL)):
                    cells = list(_cover(shapes, n))
                    for first in range(0, len(cells), 4096):
                        levels, columns, rows, edges = zip(*cells[first : first + 4096])
                        inside = np.array([e is None for e in edges])
                        kept = [np.empty(0, np.int64) if e is None else e + shapes.first[n] for e in edges]
                        yield made(batch, shapes, np.full(len(levels), n), levels, columns, rows, inside, [len(k) for k in kept], np.concatenate(kept))

    def ranges(first, size):
        return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())

    def made(batch, shapes, of, level, i, j, inside, sizes, at):
        own = [batch.column(c).take(pa.array(of)) for c in range(len(attributes))]
        edges = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.StructArray.from_arrays([pa.array(c[at]) for c in shapes.corners], fields=list(_EDGE)))
        cells = [pa.array(level, pa.int32()), pa.array(i, pa.int64()), pa.array(j, pa.int64())]
        return pa.RecordBatch.from_arrays([*own, *cells, *[pa.array(b[of]) for b in shapes.box], pa.array(inside), edges], names=out.names)

    return source.mapInArrow(run, out)


def points_in_polygons(
    points: DataFrame,
    layer: DataFrame,
    attributes: Sequence[str],
    x: str = "lon",
    y: str = "lat",
    how: str = "left",
) -> DataFrame:
    """Attributes of the polygons each point lies within.

    ``layer`` has ``edges`` and the attributes, in the unit of the points. Each
    polygon is covered by a quadtree of its own; a point looks up the cell it is
    in on each level that some polygon uses, an equi-join, and the ring test runs
    only in cells that edges enter. A point in no polygon keeps nulls (one at
    null or NaN is in none), a point in several is repeated, a point on a
    boundary is outside. Point columns are never renamed or dropped.
    """
    clash = set(attributes) & set(points.columns)
    if clash:
        raise ValueError(f"rename the layer attributes {sorted(clash)}; the points have columns of that name")
    if how not in ("left", "inner"):
        raise ValueError(f"how={how!r}")
    cells = written(cover_cells(layer, attributes), "layer-cells")
    # Levels are exponents of two: some dozens at most, whatever the layer.
    known = cells.agg(F.collect_set("_level").alias("levels"), F.min("_xlo"), F.max("_xhi"), F.min("_ylo"), F.max("_yhi")).first()
    levels, box = sorted(known["levels"]), known[1:]
    names = [F.col(f"`{c}`") for c in points.columns]
    kinds = dict(layer.dtypes)
    nothing = [F.lit(None).cast(kinds[a]).alias(a) for a in attributes]
    if not levels:
        return points.select(*names, *nothing) if how == "left" else points.select(*names, *nothing).limit(0)
    px, py = F.col(f"`{x}`").cast("double"), F.col(f"`{y}`").cast("double")
    # A NaN is above all numbers, and so outside of every box.
    in_box = F.coalesce((px > box[0]) & (px < box[1]) & (py > box[2]) & (py < box[3]), F.lit(False))
    # The box test is compiled code and spares most ring tests near a boundary.
    boxed = (px > F.col("_xlo")) & (px < F.col("_xhi")) & (py > F.col("_ylo")) & (py < F.col("_yhi"))

    def place(value: Column, side: Column) -> Column:
        return F.floor(value / side)

    hit = (F.col("_px") == F.col("_cx")) & (F.col("_py") == F.col("_cy")) & boxed & (F.col("_inside") | within_edges(F.col("_edges"), px, py))
    if len(levels) == 1:
        side = F.lit(2.0 ** levels[0])
        one = points.filter(in_box).withColumns({"_px": place(px, side), "_py": place(py, side)}).join(cells, hit, how).select(*names, *attributes)
        return one.unionByName(points.filter(~in_box).select(*names, *nothing)) if how == "left" else one
    points = read_once(points, "points") if how == "left" else points
    asked = F.explode(F.array(*[F.struct(F.lit(k).alias("level"), F.lit(2.0**k).alias("side")) for k in levels]))
    probes = points.filter(in_box).withColumn("_asked", asked).withColumns({"_px": place(px, F.col("_asked.side")), "_py": place(py, F.col("_asked.side"))})
    found = probes.join(cells, (F.col("_asked.level") == F.col("_level")) & hit).select(*names, *attributes)
    if how == "inner":
        return found
    # Who is in no polygon of any level: level by level, as a point would otherwise be missed once per level.
    alone = points.filter(in_box)
    for k in levels:
        side = F.lit(2.0**k)
        alone = alone.withColumns({"_px": place(px, side), "_py": place(py, side)}).join(cells.filter(F.col("_level") == k), hit, "left_anti").select(*names)
    return found.unionByName(alone.unionByName(points.filter(~in_box)).select(*names, *nothing))


def drop_layer_attributes(df: DataFrame, names: Sequence[str] = LAYER_ATTRIBUTES) -> DataFrame:
    return df.drop(*[n for n in names if n in df.columns])

