"""Quality classifier: random-indexing word vectors and a small calibrated network."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmetrics.llm.texts import SPACE, Block, blocks, in_small_batches, per_block, smallest_ids
from wardmetrics.session import written

# At most so many labelled rows are learned from.
TRAIN_ROWS = 20_000
BUCKETS = 1 << 15
DIMENSIONS = 64
NONZERO = 4
WINDOW = 2
# Neighbours are summed for so many words at a time.
PIECE_TOKENS = 1 << 15
HIDDEN = 32
# Pooled figures beside the mean vector.
POOLED = 5

# 0 white space, 1 letters, digits and bytes beyond ASCII, 2 other marks.
_KIND = np.full(256, 2, np.uint8)
_KIND[0x80:] = 1
for _first, _last in (b"09", b"AZ", b"az"):
    _KIND[_first : _last + 1] = 1
_KIND[SPACE] = 0

_BASE = np.uint64(0x9E3779B97F4A7C15)


def token_buckets(block: Block, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Hash bucket of each token, and the first token of each row (one more entry than rows).

    A token is a run of word characters or a run of marks; case counts.
    """
    n = len(block.data)
    if not n:
        return np.empty(0, np.int64), np.zeros(len(block) + 1, np.int64)
    kind = _KIND[block.data]
    new = np.concatenate(([True], kind[1:] != kind[:-1]))
    new[block.offsets[:-1][block.sizes > 0]] = True
    edges = np.append(np.flatnonzero(new), n)
    real = kind[edges[:-1]] > 0
    starts, ends = edges[:-1][real], edges[1:][real]
    # A token's hash is the sum of its bytes times powers of an odd number by place, from prefix sums modulo 2**64.
    with np.errstate(over="ignore"):
        powers = np.full(n, _BASE, np.uint64)
        powers[0] = 1
        np.cumprod(powers, out=powers)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(powers * (block.data.astype(np.uint64) + np.uint64(1)))))
        inverse = np.full(n, np.uint64(pow(int(_BASE), -1, 1 << 64)), np.uint64)
        inverse[0] = 1
        np.cumprod(inverse, out=inverse)
        h = (sums[ends] - sums[starts]) * inverse[starts]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return (h % np.uint64(buckets)).astype(np.int64), np.searchsorted(starts, block.offsets)


def index_entries(buckets: int = BUCKETS, dimensions: int = DIMENSIONS, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sparse random index vectors: for each bucket the places of a few entries, and their signs."""
    rng = np.random.default_rng(seed)
    places, signs = [], []
    for _ in range(NONZERO):
        places.append(rng.integers(0, dimensions, buckets))
        signs.append(rng.choice(np.array([-1, 1], np.float32), buckets))
    return np.stack(places, 1), np.stack(signs, 1).astype(np.float64)


@dataclass
class QualityModel:
    """Word vectors by bucket, the network's weights, the temperature."""

    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    temperature: float
    prior: float

    def scores(self, features: np.ndarray) -> np.ndarray:
        if not self.layers:
            return np.full(len(features), self.prior)
        z = forward(self.layers, (features - self.mean) / self.scale)[1]
        return 1 / (1 + np.exp(-np.clip(z / self.temperature, -50, 50)))


def forward(layers: list[np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w1, b1, w2, b2 = layers
    hidden = np.maximum(x @ w1 + b1, 0)
    return hidden, (hidden @ w2 + b2)[:, 0]


def pooled(block: Block, vectors: np.ndarray) -> np.ndarray:
    """Mean word vector of each row, and its length, the mean squared length of the word vectors, the log of the token
    count, and the shares of tokens that are distinct and that repeat the one before."""
    buckets, first = token_buckets(block, len(vectors))
    out = np.zeros((len(block), vectors.shape[1] + POOLED), np.float32)
    lengths = np.einsum("ij,ij->i", vectors, vectors)
    for i in range(len(block)):
        own = buckets[first[i] : first[i + 1]]
        if len(own):
            words, counts = np.unique(own, return_counts=True)
            share = (counts / len(own)).astype(np.float32)
            m = share @ vectors[words]
            again = np.count_nonzero(own[1:] == own[:-1]) / len(own)
            out[i] = np.concatenate((m, [np.sqrt(m @ m), share @ lengths[words], np.log1p(len(own)), len(words) / len(own), again]))
    return out


def neighbour_sums(words: np.ndarray, row: np.ndarray, entries: tuple[np.ndarray, np.ndarray], dimensions: int, piece: int = PIECE_TOKENS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """What neighbours add to the context table, as flat places and signs, ``piece`` words at a time: a long text needs no more memory."""
    places, signs = entries
    for first in range(0, len(words), piece):
        last = min(first + piece + WINDOW, len(words))
        w, r = words[first:last], row[first:last]
        own, near = [], []
        for step in range(1, WINDOW + 1):
            # Pairs whose left word lies in this piece; the right one may lie behind it.
            pairs = np.flatnonzero(r[step:][:piece] == r[:-step][:piece])
            left, right = w[pairs], w[pairs + step]
            own += [left, right]
            near += [right, left]
        own, near = np.concatenate(own), np.concatenate(near)
        yield (own[:, None] * dimensions + places[near]).ravel(), signs[near].ravel()


def learn_vectors(docs: DataFrame, buckets: int = BUCKETS, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Context vectors of all words of ``docs`` (column ``text``), summed over Spark tasks.

    A word's vector adds the index vectors of its neighbours up to ``WINDOW``
    away. Tasks hold one table of fixed size; the sums by bucket are shuffled
    combined, and the result has ``buckets`` rows whatever the input.
    """

    def run(batches):
        entries = index_entries(buckets, dimensions)
        total = np.zeros(buckets * dimensions, np.float64)
        seen = np.zeros(buckets, np.int64)
        for block in blocks(batches, "text", 1 << 18):
            words, first = token_buckets(block, buckets)
            if not len(words):
                continue
            row = np.repeat(np.arange(len(block)), np.diff(first))
            for at, signs in neighbour_sums(words, row, entries, dimensions):
                total += np.bincount(at, signs, len(total))
            seen += np.bincount(words, minlength=buckets)
        found = np.flatnonzero(seen)
        total = total.reshape(buckets, dimensions)
        for some in np.split(found, range(4096, len(found), 4096)):
            values = pa.FixedSizeListArray.from_arrays(pa.array(total[some].ravel().astype(np.int64)), dimensions).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(seen[some]), values], names=["bucket", "n", "v"])

    parts = in_small_batches(docs.select("text")).mapInArrow(run, "bucket long, n long, v array<long>")
    sums = [F.sum(F.col("v")[d]).alias(f"v{d}") for d in range(dimensions)]
    table = parts.groupBy("bucket").agg(F.sum("n").alias("n"), *sums).toPandas()  # at most `buckets` rows
    vectors = np.zeros((buckets, dimensions))
    counts = np.zeros(buckets)
    if len(table):
        at = table["bucket"].to_numpy()
        counts[at] = table["n"].to_numpy()
        vectors[at] = table[[f"v{d}" for d in range(dimensions)]].to_numpy(float)
    # Neighbours of every word share the frequent ones: the mean context goes, and rare words count in full.
    mean = vectors.sum(0) / max(counts.sum(), 1)
    vectors -= counts[:, None] * mean
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-6)
    share = counts / max(counts.sum(), 1)
    return (vectors * np.sqrt(1e-3 / (1e-3 + share))[:, None]).astype(np.float32)


def train_network(x: np.ndarray, y: np.ndarray, hidden: int = HIDDEN, epochs: int = 40, seed: int = 3) -> tuple[list[np.ndarray], float]:
    """Two layers by Adam on the logistic loss, then a temperature on a fifth of the rows that was kept apart."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(x))
    apart, own = order[: len(x) // 5], order[len(x) // 5 :]
    layers = [
        rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden),
        rng.normal(0, np.sqrt(1 / hidden), (hidden, 1)), np.zeros(1),
    ]
    first, second = [np.zeros_like(w) for w in layers], [np.zeros_like(w) for w in layers]
    step, size = 0, 256
    for _ in range(epochs):
        mixed = rng.permutation(own)
        for start in range(0, len(mixed), size):
            rows = mixed[start : start + size]
            h, z = forward(layers, x[rows])
            g = ((1 / (1 + np.exp(-np.clip(z, -50, 50))) - y[rows]) / len(rows))[:, None]
            back = (g @ layers[2].T) * (h > 0)
            grads = [x[rows].T @ back + 1e-4 * layers[0], back.sum(0), h.T @ g + 1e-4 * layers[2], g.sum(0)]
            step += 1
            for k, grad in enumerate(grads):
                first[k] = 0.9 * first[k] + 0.1 * grad
                second[k] = 0.999 * second[k] + 0.001 * grad * grad
                layers[k] = layers[k] - 0.003 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    if not len(apart):
        return layers, 1.0
    z = forward(layers, x[apart])[1]
    tried = np.exp(np.linspace(np.log(0.2), np.log(8), 60))
    losses = [np.mean(np.logaddexp(0, z / t) - y[apart] * z / t) for t in tried]
    return layers, float(tried[int(np.argmin(losses))])


def fit_quality(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, key: str = "doc_id", text: str = "text", label: str = "quality") -> QualityModel:
    """Fit the network on at most ``train_rows`` labelled rows, those whose keys hash lowest; word vectors on all texts of ``docs``.

    Only ``text`` and ``label`` are learned from. Labels other than 0 and 1, null
    labels and null keys are passed over; a key labelled twice counts once (the
    larger label), and so does a key of several rows (the smallest text). Without both labels the model answers with their share, or a
    half where there is none.
    """
    known = labels.filter(F.col(label).isin(0, 1)).groupBy(F.col(key).alias("_key")).agg(F.max(label).alias("_label"))
    chosen = smallest_ids(known, train_rows, "_key")
    labelled = docs.select(F.col(key).alias("_key"), F.col(text).alias("text")).join(F.broadcast(chosen), "_key")
    sample = written(labelled.groupBy("_key").agg(F.min("text").alias("text"), F.max("_label").alias("_label")).select("text", "_label"), "quality-sample")
    vectors = learn_vectors(docs.select(F.col(text).alias("text")))

    def work(block):
        return {"x": pa.array([r.tobytes() for r in pooled(block, vectors)], pa.binary())}

    rows = per_block(sample, work, "x binary", ["_label"], "text").orderBy("x", "_label").toPandas()  # bounded by train_rows
    width = vectors.shape[1] + POOLED
    x = np.frombuffer(b"".join(rows["x"]), np.float32).reshape(-1, width).astype(float)
    y = rows["_label"].to_numpy(float)
    if len(np.unique(y)) < 2:
        return QualityModel(vectors, np.zeros(width), np.ones(width), [], 1.0, float(y.mean()) if len(y) else 0.5)
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    layers, temperature = train_network((x - mean) / scale, y)
    return QualityModel(vectors, mean, scale, layers, temperature, float(y.mean()))


def score_quality(docs: DataFrame, model: QualityModel, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns and ``score`` (0 to 1, higher: better) of every whole text.

    The score depends on the text alone. Null and empty texts and texts of white
    space pool to zeros and get the network's answer to those; equal texts get
    equal scores; an empty table gives no rows.
    """

    def work(block):
        # Rounded, as the last digits depend on which texts share a block.
        return {"score": pa.array(np.round(model.scores(pooled(block, model.vectors)), 9), pa.float64())}

    return per_block(docs, work, "score double", keep, text)
