"""Exact top-k inner products: vectors by descending length, rotated partial sums, residual bounds."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardmetrics.session import written

SCALE = 256
# Rows of a group of queries and of a group of candidates: what one task holds at a time.
QUERY_ROWS = 8_192
CANDIDATE_ROWS = 32_768
# The longest vectors, against which every query gets its first threshold.
SEED_ROWS = 4_096
# Candidates are met in slices of so many, queries in tiles; between slices the thresholds rise.
SLICE, TILE = 2_048, 1_024
# Sums of whole numbers below this are exact in double precision.
EXACT = float(1 << 53)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of lists as doubles, padded with zeros to ``width``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy()
    out = np.zeros((len(column), width))
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def whole_vectors(df: DataFrame, key: str, vector: str, scale: int = SCALE) -> DataFrame:
    """``id``, ``v`` (floor of ``scale`` times each component, as doubles) and ``norm2`` of all usable vectors.

    Vectors that are null, or hold a null or a component that is not finite, are left out.
    """
    raw = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("x"))
    sound = F.col("x").isNotNull() & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    grown = raw.filter(sound & F.col("id").isNotNull()).select("id", F.transform("x", lambda c: F.floor(c * scale).cast("double")).alias("v"))
    return grown.withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c))


def rotation(vectors: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Right singular vectors of all rows, strongest first, and where partial sums stop.

    The rows' Gram matrix is summed over tasks (``width`` squared sums in all);
    its eigenvectors are the singular vectors.
    """

    def run(batches):
        total = np.zeros((width, width))
        for batch in batches:
            m = _matrix(batch.column(0), width)
            total += m.T @ m
        i, j = np.indices((width, width)).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], names=["i", "j", "s"])

    sums = vectors.select("v").mapInArrow(run, "i long, j long, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).toPandas()
    gram = np.zeros((width, width))
    gram[sums["i"], sums["j"]] = sums["s"]
    values, axes = np.linalg.eigh((gram + gram.T) / 2)
    values, axes = np.maximum(values[::-1], 0), axes[:, ::-1]
    held = np.cumsum(values) / max(values.sum(), 1e-300)
    stops = sorted({min(width, int(np.searchsorted(held, share)) + 1) for share in (0.6, 0.9)})
    return axes, np.array(stops)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties to the smaller id."""
    return np.lexsort((ids, -scores))[:k]


def _products(q: np.ndarray, c: np.ndarray, bound: float) -> np.ndarray:
    """Inner products of whole vectors, exact: in doubles where sums stay below 2**53, else in Python's integers."""
    if bound < EXACT:
        return q @ c.T
    return np.array([[int(x) for x in row] for row in q], object) @ np.array([[int(x) for x in row] for row in c], object).T


class Search:
    """Top ``k`` of a set of queries over candidates that come in slices. A query is a row, known by its place."""

    def __init__(self, places: np.ndarray, vectors: np.ndarray, axes: np.ndarray, stops: np.ndarray, k: int, least: np.ndarray | None = None):
        self.places, self.vectors, self.axes, self.stops, self.k = places, vectors, axes, stops, k
        self.turned = vectors @ axes
        self.norms = np.linalg.norm(vectors, axis=1)
        self.rest = {s: np.linalg.norm(self.turned[:, s:], axis=1) for s in stops.tolist()}
        self.least = np.full(len(places), -np.inf) if least is None else least.astype(float)
        self.found = [(np.empty(0), np.empty(0, np.int64)) for _ in places]

    def meet(self, ids: np.ndarray, places: np.ndarray, vectors: np.ndarray) -> None:
        """Candidates in descending length. A query goes on while its bound reaches its threshold: first by the
        lengths alone, then by a partial sum over the strongest rotated coordinates plus the product of the lengths of
        the rests, which no inner product exceeds; only survivors are multiplied out."""
        norms = np.linalg.norm(vectors, axis=1)
        turned = vectors @ self.axes
        rests = {s: np.linalg.norm(turned[:, s:], axis=1) for s in self.stops.tolist()}
        for at in range(0, len(ids), SLICE):
            own = slice(at, at + SLICE)
            longest = norms[own].max(initial=0)
            for first in range(0, len(self.places), TILE):
                q = np.arange(first, min(first + TILE, len(self.places)))
                slack = 1e-9 * (1 + self.norms[q] * longest)
                q = q[self.norms[q] * longest + slack >= self.least[q]]
                if not len(q):
                    continue
                slack = (1e-9 * (1 + self.norms[q] * longest))[:, None]
                open_ = np.ones((len(q), len(ids[own])), bool)
                done, partial = 0, np.zeros(open_.shape)
                for stop in self.stops.tolist():
                    partial += self.turned[q, done:stop] @ turned[own, done:stop].T
                    done = stop
                    open_ &= partial + np.outer(self.rest[stop][q], rests[stop][own]) + slack >= self.least[q][:, None]
                rows = np.flatnonzero(open_.any(axis=1))
                if not len(rows):
                    continue
                columns = np.flatnonzero(open_.any(axis=0))
                exact = _products(self.vectors[q[rows]], vectors[own][columns], float(self.norms[q].max() * longest) + 1)
                names, others = ids[own][columns], places[own][columns]
                for r, row in zip(rows.tolist(), exact):
                    i = q[r]
                    take = np.flatnonzero((row >= self.least[i]) & open_[r, columns] & (others != self.places[i]))
                    if len(take):
                        scores = np.concatenate((self.found[i][0], row[take]))
                        whom = np.concatenate((self.found[i][1], names[take]))
                        top = best(scores, whom, self.k)
                        self.found[i] = (scores[top], whom[top])
                        if len(top) == self.k:
                            self.least[i] = max(self.least[i], float(scores[top[-1]]))

    def rows(self) -> pa.RecordBatch:
        sizes = [len(f[0]) for f in self.found]
        scores = [int(s) for f in self.found for s in f[0]]
        whom = np.concatenate([f[1] for f in self.found]) if self.found else np.empty(0, np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(self.places, sizes), pa.int64()), pa.array(whom, pa.int64()), pa.array(scores, pa.int64())], names=["place", "vec_id", "score"]
        )


def top_inner_products(df: DataFrame, asks: Callable[[Column], Column], k: int = 5, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: for each row whose key ``asks`` selects its ``k`` best other rows.

    Scores are inner products of whole-number vectors, exact; ties go to the
    smaller key. Queries and candidates are dealt into groups of bounded size,
    and each pair of groups is one task's work: a query group travels once per
    candidate group and the other way round, so neither side is ever whole in a
    task or on the driver. A first pass against the longest vectors gives each
    query its threshold, which all groups start from.

    Null keys and unusable vectors take no part; vectors of fewer components
    count as padded with zeros. A query is a row: rows of one key are queries
    with answers and ranks of their own, and answers to each other; a query with
    fewer than ``k`` others gets all; an empty table gives no rows. Scores must
    fit a long.
    """
    spark = df.sparkSession
    vectors = written(whole_vectors(df, key, vector, scale).withColumn("_place", F.monotonically_increasing_id()), "topk-vectors")
    found = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("w")).first()
    if not found["n"] or not found["w"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    width = found["w"]
    axes, stops = rotation(vectors, width)
    seed = vectors.orderBy(F.desc("norm2"), "id", "_place").limit(SEED_ROWS).select("id", "_place", "v").toArrow()
    seed_ids, seed_places, seed_rows = seed["id"].to_numpy(), seed["_place"].to_numpy(), _matrix(seed["v"], width)

    asked = vectors.filter(asks(F.col("id"))).select("id", F.col("_place").alias("place"), "v")

    def first_pass(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, QUERY_ROWS):
                own = batch.slice(at, QUERY_ROWS)
                search = Search(own["place"].to_numpy(), _matrix(own["v"], width), axes, stops, k)
                search.meet(seed_ids, seed_places, seed_rows)
                yield pa.RecordBatch.from_arrays([own["id"], own["place"], own["v"], pa.array(search.least)], names=["id", "place", "v", "least"])

    started = written(asked.mapInArrow(first_pass, "id long, place long, v array<double>, least double"), "topk-queries")
    n_queries = started.count()
    query_groups = max(1, -(-n_queries // QUERY_ROWS))
    candidate_groups = max(1, -(-found["n"] // CANDIDATE_ROWS), min(2 * spark.sparkContext.defaultParallelism, -(-found["n"] // SLICE)))
    group = lambda n: F.pmod(F.xxhash64("place"), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    ours = started.select(group(query_groups).alias("a"), every(candidate_groups).alias("b"), F.lit(True).alias("asks"), "id", "place", "v", "least", F.lit(0.0).alias("norm2"))
    theirs = vectors.withColumnRenamed("_place", "place").select(every(query_groups).alias("a"), group(candidate_groups).alias("b"), F.lit(False).alias("asks"), "id", "place", "v", F.lit(0.0).alias("least"), "norm2")
    cells = ours.unionByName(theirs)

    def cell(table: pa.Table) -> pa.Table:
        asks = table["asks"].to_numpy(zero_copy_only=False)
        own, others = table.filter(pa.array(asks)), table.filter(pa.array(~asks))
        others = others.take(pa.array(np.argsort(-others["norm2"].to_numpy(), kind="stable")))
        search = Search(own["place"].to_numpy(), _matrix(own["v"], width), axes, stops, k, own["least"].to_numpy())
        search.meet(others["id"].to_numpy(), others["place"].to_numpy(), _matrix(others["v"], width))
        return pa.Table.from_batches([search.rows()])

    answers = cells.groupBy("a", "b").applyInArrow(cell, "place long, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("place").orderBy(F.desc("score"), "vec_id"))
    ranked = answers.withColumn("rank", rank).filter(F.col("rank") <= k)
    names = started.select(F.col("id").alias("query_id"), F.col("place").alias("_of"))
    return ranked.join(names, ranked["place"] == names["_of"]).select("query_id", "rank", "vec_id", "score")
