"""Spelling variants by a variable-length gram index: a word's gram lists are merged under bounds on affected grams."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardmetrics.llm.texts import blocks
from wardmetrics.session import written

LEAST_LENGTH, LEAST_COUNT = 5, 3
# Gram lengths. With one mark at both ends a word of LEAST_LENGTH has six grams, and one edit touches at most five.
SHORT_GRAM, LONG_GRAM = 2, 5
# A gram is extended while more places than this share it, and than one in DICTIONARY_SHARE of all places; so at most
# DICTIONARY_SHARE grams of one length are extended, and the dictionary has at most three times that.
FREQUENT = 64
DICTIONARY_SHARE = 1 << 16
# List lengths are known by hash bucket, a table of fixed size. They only order the lists, so shared buckets cost time, not results.
LIST_BUCKETS = 1 << 18
# Long texts are cut into stretches of about so many bytes, between words.
STRETCH = 1 << 20
# A task hands its counts on when it holds so many words.
HELD_WORDS = 200_000
# One in so many (document, word) loses a code point.
SLIP = 97

FRONT, BACK = "^", "$"
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_RUN = re.compile("[a-zÀ-ÿ]+")
# In UTF-8 the letters are these bytes and no others share them, so a cut before any other byte cuts no run.
_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

PAIRS = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])


def stretches(data: np.ndarray, size: int = STRETCH) -> Iterator[bytes]:
    """The bytes of a text in pieces of about ``size``, cut at bytes that belong to no word; a longer run stays whole."""
    first = 0
    while first < len(data):
        last = first + size
        while last < len(data):
            free = np.flatnonzero(~_INSIDE[data[last : last + size]])
            if len(free):
                last += int(free[0])
                break
            last += size
        yield data[first : min(last, len(data))].tobytes()
        first = last


def slipped(word: str, key: str, slip: int) -> str:
    """The word without one code point where the CRC-32 of ``key:word`` is a multiple of ``slip``."""
    h = zlib.crc32(f"{key}:{word}".encode())
    if h % slip:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def _handed_on(counts: dict) -> Iterator[pa.RecordBatch]:
    """Counts as batches of bounded size: words may be very long."""
    words, held = [], 0
    for word in list(counts):
        words.append(word)
        held += len(word)
        if held >= 1 << 22 or len(words) >= 1 << 15:
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([counts.pop(w) for w in words], pa.int64())], names=["word", "n"])
            words, held = [], 0
    if words:
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([counts.pop(w) for w in words], pa.int64())], names=["word", "n"])


def word_table(docs: DataFrame, key: str = "doc_id", text: str = "text", slip: int = SLIP, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word``, ``n``: the lower-cased runs of letters of all whole texts, with slips, that are long and frequent enough.

    Whether a run slips depends on document and run alone, so a stretch of a text
    is counted first and its distinct runs are tried once. Tasks add up their
    words and hand them on combined. A null text has no runs; a null key counts
    as empty.
    """
    source = docs.select(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("_key"), F.col(f"`{text}`").alias("_text")).filter("_text is not null")

    def run(batches):
        total: dict[str, int] = {}
        size = 0
        for block in blocks(batches, "_text"):
            keys = block.rows.column(0).to_pylist()
            for i, own in enumerate(keys):
                for piece in stretches(block.data[block.offsets[i] : block.offsets[i + 1]]):
                    found = Counter(_RUN.findall(piece.translate(_LOWER).decode("utf-8", "replace")))
                    for word, n in found.items():
                        if len(word) >= least_length:
                            word = slipped(word, own, slip)
                            if len(word) >= least_length:
                                before = total.get(word, 0)
                                size += 0 if before else 1 + len(word) // 64
                                total[word] = before + n
                    if size >= HELD_WORDS:
                        yield from _handed_on(total)
                        size = 0
        yield from _handed_on(total)

    return source.mapInArrow(run, PAIRS).groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def frequent_grams(words: DataFrame, least: int = FREQUENT, share: int = DICTIONARY_SHARE) -> set[str]:
    """The gram dictionary: grams shorter than ``LONG_GRAM`` that so many places share that longer ones are kept as well.

    A prefix tree: what follows an infrequent gram is pruned, as no word is cut
    into anything longer there. Counts are combined in the tasks; at most
    ``share`` grams of each length reach the driver.
    """

    def run(batches):
        total: Counter = Counter()
        for batch in batches:
            for word in batch.column(0).to_pylist():
                marked = FRONT + word + BACK
                for q in range(SHORT_GRAM, LONG_GRAM):
                    total.update([marked[p : p + q] for p in range(len(marked) - q + 1)])
                if len(total) >= HELD_WORDS:
                    yield from _handed_on(total)
        yield from _handed_on(total)

    counts = written(words.select("word").mapInArrow(run, PAIRS).groupBy(F.col("word").alias("gram")).agg(F.sum("n").alias("n")), "gram-counts")
    places = counts.filter(F.length("gram") == SHORT_GRAM).agg(F.sum("n")).first()[0] or 0
    most = max(least, places // share)
    return {r["gram"] for r in counts.filter(F.col("n") > most).select("gram").toLocalIterator()}


def decomposed(word: str, frequent: set[str]) -> list[str]:
    """The word's grams, one from each place but the last: the shortest that is not frequent, or of full length, or up to the word's end."""
    marked = FRONT + word + BACK
    out = []
    for p in range(len(marked) - 1):
        q = SHORT_GRAM
        while q < LONG_GRAM and p + q < len(marked) and marked[p : p + q] in frequent:
            q += 1
        out.append(marked[p : p + q])
    return out


def affected(grams: list[str]) -> int:
    """The most grams that one inserted, deleted or replaced code point can change: those that cover one place of the word."""
    change = np.zeros(len(grams) + 2, np.int64)
    first = np.arange(len(grams))
    np.add.at(change, first, 1)
    np.add.at(change, np.minimum(first + [len(g) for g in grams], len(grams) + 1), -1)
    return int(np.cumsum(change)[1:-1].max())


def numbered(grams: list[str]) -> list[str]:
    """Grams with their occurrence in the word, so that equal ones count one by one."""
    seen: Counter = Counter()
    out = []
    for g in grams:
        out.append(f"{g}{seen[g]}" if seen[g] else g)
        seen[g] += 1
    return out


def bucket_of(token: str) -> int:
    return zlib.crc32(token.encode()) % LIST_BUCKETS


def list_lengths(words: DataFrame, frequent: set[str]) -> np.ndarray:
    """How many words have a token of each hash bucket."""

    def run(batches):
        total = np.zeros(LIST_BUCKETS, np.int64)
        for batch in batches:
            for word in batch.column(0).to_pylist():
                np.add.at(total, [bucket_of(t) for t in numbered(decomposed(word, frequent))], 1)
        found = np.flatnonzero(total)
        for some in np.split(found, range(1 << 15, len(found), 1 << 15)):
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], names=["bucket", "n"])

    parts = words.select("word").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()  # at most LIST_BUCKETS rows
    out = np.zeros(LIST_BUCKETS, np.int64)
    out[parts["bucket"].to_numpy(np.int64)] = parts["n"].to_numpy(np.int64)
    return out


def shortest_lists(words: DataFrame, frequent: set[str], lengths: np.ndarray) -> DataFrame:
    """``token``, ``word``, ``n``, ``size``: each word in the lists it must be looked up in.

    One edit changes at most A grams of a word of G, so a near word shares G - A
    of them or more. All words order their tokens alike, shorter lists first; then
    near words meet in one of the A + 1 first tokens of both, and the longest
    G - A - 1 lists of a word are never merged.
    """
    out = T.StructType([T.StructField("token", T.StringType()), *PAIRS.fields, T.StructField("size", T.IntegerType())])

    def run(batches):
        for batch in batches:
            rows, held = [], 0
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                grams = decomposed(word, frequent)
                tokens = sorted(numbered(grams), key=lambda t: (lengths[bucket_of(t)], t))
                rows += [(t, word, n, len(word)) for t in tokens[: affected(grams) + 1]]
                held += len(word)
                if held > 1 << 20 or len(rows) > 1 << 16:
                    yield _batch(rows)
                    rows, held = [], 0
            if rows:
                yield _batch(rows)

    def _batch(rows):
        arrays = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), pa.int64(), pa.int32()))]
        return pa.RecordBatch.from_arrays(arrays, names=out.names)

    return words.select("word", "n").mapInArrow(run, out)


def near_pairs(words: DataFrame) -> DataFrame:
    """``a``, ``b``, ``n_a``, ``n_b``: each two words that differ by one inserted, deleted or replaced code point, once.

    Lists meet by token and length: a word looks for words of its own length and
    one longer. Every candidate is verified in the join, so a list makes no rows
    but near pairs; a long list is a skewed join that adaptive execution splits.
    """
    frequent = frequent_grams(words)
    lists = written(shortest_lists(words, frequent, list_lengths(words, frequent)), "gram-lists")
    asks = lists.select(F.col("token").alias("t"), F.col("word").alias("a"), F.col("n").alias("n_a"), "size", F.explode(F.array(F.col("size"), F.col("size") + 1)).alias("wanted"))
    has = lists.select(F.col("token").alias("t2"), F.col("word").alias("b"), F.col("n").alias("n_b"), F.col("size").alias("size_b"))
    met = asks.join(has.hint("merge"), (asks["t"] == has["t2"]) & (asks["wanted"] == has["size_b"]) & ((F.col("size") < F.col("size_b")) | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "b", "n_a", "n_b").distinct()


def follow(forms: DataFrame) -> DataFrame:
    """``word``, ``root``: each word of ``forms`` (``word``, ``form``) with the last word its forms lead to.

    Each round doubles the steps taken. A form occurs at least twice as often as
    its word, so there are no circles and at most 63 steps: seven rounds.
    """
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        joined = now.join(ahead, now["root"] == ahead["_w"], "left")
        now = written(joined.select("word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("_moved")), "roots")
        if now.filter("_moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text", slip: int = SLIP) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of every word of ``docs``.

    A word's form is its near word of largest ``n`` (ties: first in code-point
    order) where that is at least twice its own, and null otherwise; ``root``
    follows the forms to the last. Null texts have no words, null keys count as
    empty text, repeated rows count one by one, texts and words of any length are
    taken whole, other columns take no part, an empty table gives no rows.
    """
    words = written(word_table(docs, key, text, slip), "spelling-words")
    pairs = written(near_pairs(words), "spelling-pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("n_a").alias("n"), F.col("b").alias("other"), F.col("n_b").alias("m")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("n_b").alias("n"), F.col("a").alias("other"), F.col("n_a").alias("m")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), F.col("other"))).alias("_best"), F.max("n").alias("_n"))
    formed = F.col("_best.less") <= -2 * F.col("_n")
    judged = written(best.select(
        F.col("word").alias("_word"), "n_near", F.when(formed, F.col("_best.other")).alias("form"), F.when(formed, -F.col("_best.less")).alias("form_n")), "spelling-forms")
    roots = follow(judged.filter("form is not null").select(F.col("_word").alias("word"), "form")).select(F.col("word").alias("_own"), "root")
    joined = words.join(judged, words["word"] == judged["_word"], "left").join(roots, words["word"] == roots["_own"], "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")
