"""Quality rules: counts of each text, then robust multivariate outliers by language and source."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmetrics.llm.texts import SPACE, Block, per_block, word_spans
from wardmetrics.session import written

LEAST_WORDS = 10
MOST_REPEATED = 20  # percent of words in repeated windows
RUN = 5

# Share of a group's rows that the covariance of least determinant is taken over.
CORE = 0.75
STEPS = 5
# A group's shape weighs as many rows as it has, its parent's as many as this.
PARENT_ROWS = 50
# Squared distances of a normal cloud of five dimensions: its median, the 97.5 % point, and the point that one row in
# ten million is beyond. Fixed values of the chi-squared distribution.
MEDIAN_5, INNER_5, CUT_5 = 4.351, 12.833, 42.0
# A coordinate's deviation counts as this much at least, so that groups where nearly all rows agree keep an inverse.
FLOORS = (0.35, 0.08, 0.7, 0.7, 0.08)
GRAIN = 1024  # statistics are held in whole 1024ths: sums are exact, in any order
BINS = 64  # squared distances are ranked in steps of 1/64 of their logarithm

_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[list(b"#*$%&|<>")] = 1
_BLANK = b" \t\n\r\x0b\x0c"


def _by_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))[offsets])


def repeated_words(words: list[bytes], first: np.ndarray, run: int = RUN) -> np.ndarray:
    """Words of each row inside ``run``-word windows that occur twice or more in that row.

    Windows are numbered exactly: equal numbers of words, then of growing windows, by sorting.
    """
    out = np.zeros(len(first) - 1, np.int64)
    n = len(words) - run + 1
    if n < 1:
        return out
    codes = pd.factorize(np.array([*words, None], dtype=object)[:-1])[0].astype(np.int64)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    starts = np.flatnonzero(row[:n] == row[run - 1 :])
    window = row[starts]
    for step in range(run):
        # After each step only windows whose beginning repeats are followed further.
        width = int(codes.max()) + 1
        _, number, count = np.unique(window * width + codes[starts + step], return_inverse=True, return_counts=True)
        again = count[number] > 1
        starts, window = starts[again], number[again]
        if not len(starts):
            return out
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + run, -1)
    return _by_row(np.cumsum(edge[:-1]) > 0, first)


def text_counts(block: Block) -> dict[str, np.ndarray]:
    """Base counts of each whole text."""
    starts, ends, first = word_spans(block)
    lead = (block.data & 0xC0) != 0x80
    words: list[bytes] = []
    doubles = np.zeros(len(block), np.int64)
    for i in range(len(block)):
        text = block.text(i)
        words += text.split()  # bytes split at the same six characters
        lines = [line for line in text.split(b"\n") if line.strip(_BLANK)]
        doubles[i] = len(lines) - len(set(lines))
    return {
        "n_words": np.diff(first),
        "word_chars": _by_row(lead & ~SPACE[block.data], block.offsets),
        "n_symbols": _by_row(_SYMBOL[block.data], block.offsets),
        "n_dup_lines": doubles,
        "n_repeat_words": repeated_words(words, first),
    }


def count_texts(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep``, the base counts and ``base_failed`` of every whole text; a null text has no words."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    counted = per_block(docs, lambda b: {k: pa.array(v, pa.int64()) for k, v in text_counts(b).items()}, ", ".join(f"{n} long" for n in names), keep, text)
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)
    return counted.withColumn("base_failed", failed)


def statistic_vector() -> list:
    """The five transformed statistics, in whole 1024ths."""
    n = F.col("n_words") + 1
    raw = [
        F.log1p("n_words"),
        F.log((F.col("word_chars") + 1) / n),
        F.log1p(F.col("n_symbols") * 200 / n),
        F.log1p("n_dup_lines"),
        F.col("n_repeat_words") / n,
    ]
    return [F.round(x * GRAIN).cast("long").alias(f"_z{i}") for i, x in enumerate(raw)]


def _distance() -> F.Column:
    """Squared Mahalanobis distance from the group's ``_mu`` under its whitening matrix ``_w`` (row by row)."""
    gaps = [(F.col(f"_z{i}") / GRAIN - F.col("_mu")[i]) for i in range(5)]
    total = F.lit(0.0)
    for i in range(5):
        side = F.lit(0.0)
        for j in range(i + 1):
            side = side + F.col("_w")[i * 5 + j] * gaps[j]
        total = total + side * side
    return total


def _bin(distance) -> F.Column:
    return F.floor(F.log(distance + 1e-6) * BINS).cast("int")


def _shapes(moments: DataFrame) -> DataFrame:
    """Centre and whitening matrix of each group from exact sums; one row per group goes through Python."""

    def run(frames):
        for pdf in frames:
            centres, whites = [], []
            for row in pdf.itertuples(index=False):
                n = max(row.n, 1)
                mu = np.array(row.s, float) / n
                cov = np.zeros((5, 5))
                cov[np.tril_indices(5)] = np.array(row.p, float) / n
                cov = cov + np.tril(cov, -1).T - np.outer(mu, mu)
                cov = cov / GRAIN**2 + np.diag(np.square(FLOORS))
                centres.append((mu / GRAIN).tolist())
                whites.append(np.linalg.inv(np.linalg.cholesky(cov)).ravel().tolist())
            yield pd.DataFrame({"_g": pdf["_g"], "_mu": centres, "_w": whites})

    return moments.mapInPandas(run, "_g string, _mu array<double>, _w array<double>")


def _moments(rows: DataFrame) -> DataFrame:
    pairs = [F.sum(F.col(f"_z{i}") * F.col(f"_z{j}")).cast("double") for i in range(5) for j in range(i + 1)]
    sums = [F.sum(f"_z{i}").cast("double") for i in range(5)]
    return rows.groupBy("_g").agg(F.count(F.lit(1)).alias("n"), F.array(*sums).alias("s"), F.array(*pairs).alias("p"))


def group_shapes(rows: DataFrame) -> DataFrame:
    """Minimum-covariance-determinant centre and shape of each group ``_g`` of ``rows`` (``_z0`` to ``_z4``).

    Start: medians and median absolute deviations. Each step takes the CORE share
    of the group's rows that lie nearest under the present shape and computes
    their mean and covariance anew, which lowers the determinant. Then the shape
    is scaled so that the median distance is that of a normal cloud, and mean and
    covariance are taken once more over all rows within its 97.5 % point.

    All rows take part. A step is two groupings whose partial states are small
    (sums, and counts of distinct whole numbers for the quantile), combined
    before the shuffle, so a group with a third of all rows is no heavier at the
    end than another. Shapes, one row per group, are written before each join so
    that their size is known; only small ones are then broadcast.
    """
    middles = rows.groupBy("_g").agg(*[F.expr(f"percentile(_z{i}, 0.5)").alias(f"_m{i}") for i in range(5)])
    middles = written(middles, "mcd-medians")
    away = [F.expr(f"percentile(cast(abs(_z{i} - _m{i}) as long), 0.5)") for i in range(5)]
    spread = rows.join(middles, "_g").groupBy("_g").agg(
        *[F.first(f"_m{i}").alias(f"_m{i}") for i in range(5)], *[a.alias(f"_a{i}") for i, a in enumerate(away)]
    )
    sides = [F.sqrt(F.pow(F.col(f"_a{i}") * 1.4826 / GRAIN, 2) + FLOORS[i] ** 2) for i in range(5)]
    white = [1 / sides[i] if i == j else F.lit(0.0) for i in range(5) for j in range(5)]
    shapes = spread.select("_g", F.array(*[F.col(f"_m{i}") / GRAIN for i in range(5)]).alias("_mu"), F.array(*white).alias("_w"))
    for step in range(STEPS + 1):
        shapes = written(shapes, "mcd-shapes")
        ranked = rows.join(shapes, "_g").withColumn("_d", _bin(_distance()))
        share = CORE if step < STEPS else 0.5
        cuts = written(ranked.groupBy("_g").agg(F.expr(f"percentile(_d, {share})").alias("_cut")), "mcd-cuts")
        near = ranked.join(cuts, "_g")
        if step < STEPS:
            near = near.filter(F.col("_d") <= F.col("_cut"))
            shapes = _shapes(_moments(near))
        else:
            # The core's shape is too narrow by the ratio of the median distances.
            ratio = F.greatest(F.exp(F.col("_cut") / BINS) / MEDIAN_5, F.lit(1e-3))
            near = near.filter(F.col("_d") <= _bin(ratio * INNER_5))
            shapes = _shapes(_moments(near))
    return written(shapes, "mcd-final")


def shrunk_shapes(rows: DataFrame, levels: list[str]) -> DataFrame:
    """``_g``, ``_mu``, ``_w`` of the finest level's groups, each drawn towards its parents by row count.

    ``levels`` names the label columns of ``rows`` from the finest on. Every level
    has its own minimum-covariance-determinant shapes, found together; then a
    centre and covariance of n rows count n, the parent's (drawn to its own parent
    first, the last one to the floors) count ``PARENT_ROWS``. One rule at every
    size: a large group keeps its shape, a group of one row has its parent's.
    """
    labels = F.explode(F.array(*[F.concat(F.lit(f"{i}:"), F.col(name)) for i, name in enumerate(levels)]))
    marked = written(rows.select(labels.alias("_g"), *[f"_z{i}" for i in range(5)]), "mcd-rows")
    shapes = group_shapes(marked).join(written(marked.groupBy("_g").agg(F.count(F.lit(1)).alias("_n")), "mcd-sizes"), "_g")
    shapes = written(shapes, "mcd-levels")
    chain = written(rows.select(*levels).distinct(), "mcd-groups")
    for i, name in enumerate(levels):
        own = shapes.select(F.col("_g").alias("_key"), *[F.col(c).alias(f"{c}{i}") for c in ("_n", "_mu", "_w")])
        chain = chain.join(own, F.concat(F.lit(f"{i}:"), F.col(name)) == own["_key"]).drop("_key")

    def run(frames):
        for pdf in frames:
            centres, whites = [], []
            for row in pdf.itertuples(index=False):
                mu = cov = None
                for i in reversed(range(len(levels))):
                    n, own = row[1 + 3 * i], np.array(row[2 + 3 * i])
                    spread = np.linalg.inv(np.array(row[3 + 3 * i]).reshape(5, 5))
                    mu = own if mu is None else mu
                    cov = np.diag(np.square(FLOORS)) if cov is None else cov
                    mu, cov = (n * own + PARENT_ROWS * mu) / (n + PARENT_ROWS), (n * spread @ spread.T + PARENT_ROWS * cov) / (n + PARENT_ROWS)
                centres.append(mu.tolist())
                whites.append(np.linalg.inv(np.linalg.cholesky(cov)).ravel().tolist())
            yield pd.DataFrame({"_g": pdf.iloc[:, 0], "_mu": centres, "_w": whites})

    ordered = chain.select(levels[0], *[f"{c}{i}" for i in range(len(levels)) for c in ("_n", "_mu", "_w")])
    return written(ordered.mapInPandas(run, "_g string, _mu array<double>, _w array<double>"), "mcd-shrunk")


def judge_texts(docs: DataFrame, keep: list[str], text: str = "text", lang: str = "lang", source: str = "source", cut: float = CUT_5) -> DataFrame:
    """``keep``, the base counts, ``base_failed``, ``distance`` and ``kept`` of every row.

    Rows that fail a base rule are out. Of the others, each language and source
    (null being a value like any other) gets a robust centre and shape, drawn
    towards its language's and that towards all rows' by row count, and rows whose
    squared Mahalanobis distance is above ``cut`` are out. Equal texts of a group
    share a verdict; null and empty texts fail the base rule; an empty table gives
    no rows.
    """
    names = [n for n in dict.fromkeys([*keep, lang, source])]
    counted = count_texts(docs, names, text)
    levels = {
        "_own": F.to_json(F.struct(F.col(f"`{lang}`").alias("l"), F.col(f"`{source}`").alias("s"))),
        "_lang": F.to_json(F.struct(F.col(f"`{lang}`").alias("l"))), "_all": F.lit("all"),
    }
    rows = written(counted.withColumns(levels).select("*", *statistic_vector()), "text-counts")
    shapes = shrunk_shapes(rows.filter(~F.col("base_failed")), list(levels))
    judged = rows.join(shapes, rows["_own"] == shapes["_g"], "left").withColumn("distance", F.when(~F.col("base_failed"), _distance()))
    kept = ~F.col("base_failed") & (F.coalesce(F.col("distance"), F.lit(0.0)) <= cut)
    return judged.select(*[F.col(f"`{k}`") for k in keep], "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance", kept.alias("kept"))
