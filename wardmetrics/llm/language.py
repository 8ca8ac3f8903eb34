"""Language identification: family first, then one-versus-one linear machines within it."""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmetrics.llm.texts import Block, per_block, smallest_ids
from wardmetrics.session import written

# About so many labelled rows are learned from, at most twice as many.
TRAIN_ROWS = 6_000
FEATURES = 2048
UNKNOWN = "und"

# Families of ISO 639-1 codes; a code not listed is a family of its own.
FAMILIES = {
    "germanic": "de en nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk pl cs sk bg sr hr sl mk be bs",
    "turkic": "tr az kk uz ky tt",
    "uralic": "fi hu et",
    "indic": "hi bn ur pa mr gu ne",
    "semitic": "ar he mt am",
    "sinitic": "zh yue",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

_LETTER = re.compile(r"[^\W\d_]")


def family_of(lang: str) -> str:
    return _FAMILY.get(lang, f"only {lang}")


def gram_features(block: Block, features: int = FEATURES) -> np.ndarray:
    """Root counts of hashed byte pairs and triples of each row, lower-cased in ASCII, of length one."""
    data = block.data.astype(np.uint32)
    upper = (data >= 65) & (data <= 90)
    data[upper] += 32
    data[(data < 97) & (data >= 33)] = 33  # digits and ASCII marks are one sign
    data[data < 33] = 32
    row = np.repeat(np.arange(len(block)), block.sizes)
    total = np.zeros(len(block) * features, np.float32)
    for n in (2, 3):
        if len(data) >= n:
            h = np.zeros(len(data) - n + 1, np.uint32)
            with np.errstate(over="ignore"):
                for k in range(n):
                    h = h * np.uint32(0x01000193) + data[k : len(data) - n + 1 + k]
                h = (h * np.uint32(0x9E3779B1)) >> np.uint32(16)
            own = row[: len(h)] == row[n - 1 :]
            total += np.bincount(row[: len(h)][own] * features + (h[own] % np.uint32(features)), minlength=len(total))
    x = np.sqrt(total.reshape(len(block), features))
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-6)


@dataclass
class Machine:
    """A linear machine between two labels: positive margins speak for ``yes``."""

    yes: str
    no: str
    weights: np.ndarray
    bias: float
    slope: float

    def margins(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights + self.bias


def train_machine(x: np.ndarray, positive: np.ndarray, yes: str, no: str, cost: float = 4.0, steps: int = 150) -> Machine:
    """Squared-hinge support vector machine by accelerated full gradients; classes weigh alike."""
    y = np.where(positive, 1.0, -1.0).astype(np.float32)
    weight = np.where(positive, 0.5 / positive.sum(), 0.5 / (~positive).sum()).astype(np.float32) * cost * 100
    x1 = np.concatenate((x, np.ones((len(x), 1), np.float32)), axis=1)
    w = np.zeros(x1.shape[1], np.float32)
    ahead, rate = w.copy(), 1 / (1 + 4 * weight.sum())
    for step in range(steps):
        slack = np.maximum(1 - y * (x1 @ ahead), 0)
        new = ahead - rate * (ahead - 2 * (x1.T @ (weight * slack * y)))
        ahead = new + step / (step + 3) * (new - w)
        w = new
    margins = y * (x1 @ w)
    # One slope for the logistic curve of the margins, by the mean loss over a fixed row of tries.
    tried = np.exp(np.linspace(np.log(0.5), np.log(20), 40))
    slope = tried[int(np.argmin([np.mean(np.logaddexp(0, -s * margins)) for s in tried]))]
    return Machine(yes, no, w[:-1], float(w[-1]), float(slope))


def vote(machines: list[Machine], names: list[str], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the name with most pair wins (then the larger sum of margins) and the product of its pair probabilities."""
    wins = np.zeros((len(x), len(names)))
    sums = np.zeros((len(x), len(names)))
    logs = np.zeros((len(x), len(names)))
    at = {name: i for i, name in enumerate(names)}
    for m in machines:
        z = m.margins(x)
        a, b = at[m.yes], at[m.no]
        wins[:, a] += z >= 0
        wins[:, b] += z < 0
        sums[:, a] += z
        sums[:, b] -= z
        logs[:, a] -= np.logaddexp(0, -m.slope * z)
        logs[:, b] -= np.logaddexp(0, m.slope * z)
    best = np.argmax(wins + np.tanh(sums) / 4, axis=1)
    return best, np.exp(logs[np.arange(len(x)), best])


@dataclass
class LanguageModel:
    families: list[str]
    between: list[Machine]
    languages: dict[str, list[str]]
    within: dict[str, list[Machine]]
    features: int = FEATURES

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        names, scores = [UNKNOWN] * len(x), np.zeros(len(x))
        if not self.families:
            return names, scores
        family, sure = vote(self.between, self.families, x)
        for i, f in enumerate(self.families):
            rows = np.flatnonzero(family == i)
            if len(rows):
                best, own = vote(self.within[f], self.languages[f], x[rows])
                for r, b in zip(rows, best):
                    names[r] = self.languages[f][b]
                scores[rows] = sure[rows] * own
        return names, scores


def _pairs(names: list[str], label: np.ndarray, x: np.ndarray) -> list[Machine]:
    out = []
    for a, b in combinations(names, 2):
        rows = np.flatnonzero((label == a) | (label == b))
        out.append(train_machine(x[rows], label[rows] == a, a, b))
    return out


def fit_languages(docs: DataFrame, train_rows: int = TRAIN_ROWS, key: str = "doc_id", text: str = "text", lang: str = "lang") -> LanguageModel:
    """Fit on about ``train_rows`` rows with a language, twice as many at most.

    Each language gets an equal share of them: the rows whose keys hash lowest,
    or all it has. Rows with a null language, key or text are passed over, and a
    key that repeats in a language counts once (its smallest text). One language
    is always answered; without any the answer is ``und``.
    """
    known = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(key).isNotNull())
    keys = known.select(F.col(key).alias("_key"), F.col(lang).alias("_lang"))
    counts = written(keys.groupBy("_lang").agg(F.count(F.lit(1)).alias("_n")), "language-counts")
    langs = counts.count()
    if not langs:
        return LanguageModel([], [], {}, {})
    share = F.least(F.lit(1.0), F.lit(max(train_rows / langs, 1.0)) / F.col("_n"))
    drawn = keys.join(counts, "_lang").filter(F.pmod(F.xxhash64("_key", F.lit(7)), F.lit(1 << 30)) < share * (1 << 30))
    picked = written(smallest_ids(drawn.select("_key", "_lang").distinct(), 2 * train_rows, "_key"), "language-keys")
    body = known.select(F.col(key).alias("_key"), F.col(lang).alias("_lang"), F.col(text).alias("text"))
    sample = body.join(F.broadcast(picked), ["_key", "_lang"]).groupBy("_key", "_lang").agg(F.min("text").alias("text"))

    def work(block):
        return {"x": pa.array([r.astype(np.float16).tobytes() for r in gram_features(block)], pa.binary())}

    rows = per_block(sample, work, "x binary", ["_lang"], "text").orderBy("_lang", "x").toPandas()  # bounded by train_rows
    x = np.frombuffer(b"".join(rows["x"]), np.float16).reshape(-1, FEATURES).astype(np.float32)
    label = rows["_lang"].to_numpy(str)
    names = sorted(set(label.tolist()))
    family = np.array([family_of(n) for n in label])
    families = sorted(set(family.tolist()))
    languages = {f: [n for n in names if family_of(n) == f] for f in families}
    within = {}
    for f in families:
        own = np.flatnonzero(family == f)
        within[f] = _pairs(languages[f], label[own], x[own])
    return LanguageModel(families, _pairs(families, family, x), languages, within)


def predict_languages(docs: DataFrame, model: LanguageModel, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns, ``lang_pred`` and ``score`` (0 to 1) of every whole text.

    The answer depends on the text alone, so equal texts agree. Null texts and
    texts without a letter (empty ones too) are ``und`` with score 0; an empty
    table gives no rows.
    """

    def work(block):
        names, scores = model.predict(gram_features(block, model.features))
        for i in range(len(block)):
            if not _LETTER.search(block.text(i).decode("utf-8", "replace")):
                names[i], scores[i] = UNKNOWN, 0.0
        # Rounded, as the last digits depend on which texts share a block.
        return {"lang_pred": pa.array(names, pa.string()), "score": pa.array(np.round(scores, 6), pa.float64())}

    return per_block(docs, work, "lang_pred string, score double", keep, text)
