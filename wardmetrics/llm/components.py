"""Connected components of a graph held in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmetrics.session import written

# A graph of any size settles in far fewer rounds; more means a fault.
MOST_ROUNDS = 60


def _mark(edges: DataFrame) -> tuple:
    """Count and an order-free hash sum of the edges."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _star(arcs: DataFrame, small: bool) -> DataFrame:
    """One star step over arcs (u, v), each edge in the directions the step looks at.

    Every node's neighbours are linked to the least of them: to nodes above it
    (large star), or all nodes below it and itself (small star). The least one is
    combined before the shuffle; a node with very many neighbours is a hot key of
    a sort-merge join, which adaptive execution splits.
    """
    least = arcs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("u", "m").alias("m"))
    joined = arcs.join(least.hint("merge"), arcs["u"] == least["n"])
    moved = joined.select(F.col("v").alias("a"), F.col("m").alias("b"))
    if small:
        moved = moved.unionByName(least.select(F.col("n").alias("a"), F.col("m").alias("b")))
    else:
        moved = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.filter(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``root``) for every node of ``edges`` (``a``, ``b``): the least node reachable.

    Large and small star steps take turns until the edges stay as they are; then
    each component is one star. Each round's edges are written to the shared
    folder, so a lost executor costs one round at most. Loops and repeated edges
    do no harm; nodes without an edge have no row.
    """
    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "links")
    mark = _mark(now)
    for _ in range(MOST_ROUNDS):
        if not mark[0]:
            break
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        wide = written(_star(both, small=False), "links-large")
        now = written(_star(wide.select(F.col("a").alias("u"), F.col("b").alias("v")), small=True), "links-small")
        last, mark = mark, _mark(now)
        if mark == last:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
    if mark[0]:
        raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
