"""Secret scans: fixed patterns, and character Markov models of random strings against ordinary identifiers.

Everything here is DataFrame functions; the models are trained by Spark
aggregates over character pairs.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmetrics.llm.texts import free_prefix, smallest_ids
from wardmetrics.session import written

# The base kinds in their order, their patterns, the group that must be long enough, and its length.
# (?i: ) covers ASCII letters. A run of 24 hex digits or of AKIA and 16 more is the run the shorter pattern finds.
BASE_KINDS = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    "access": (r"AKIA[A-Z0-9]{16,}", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),
}
MARKOV = "markov"
# Candidates of the models: long runs of key characters.
CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
IDENTIFIER = r"[A-Za-z_][A-Za-z0-9_-]{7,}"

# At most so many documents give the labelled samples.
SAMPLE_ROWS = 20_000
# How many observed pairs the fall-back weighs.
BACK_OFF = 10.0
# The least log-likelihood ratio of a secret, in all and for each character.
LEAST_RATIO, LEAST_EACH = 8.0, 1.3
# A rule or a filler of few different characters is no secret.
LEAST_DISTINCT = 6
PLACEHOLDER = "<secret>"
# Matches of a text are walked in blocks of so many.
BLOCK = 128


def _once(value: Column, make: Callable[[Column], Column]) -> Column:
    """``make`` of a value that is computed once, however often it is used and inside whatever loop."""
    return F.element_at(F.transform(F.array(value), make), 1)


def _blocks(items: Column) -> Column:
    """``items`` in blocks of ``BLOCK`` in order: an array grown entry by entry is copied each time, so none grows longer than a block."""

    def cut(own: Column) -> Column:
        last = F.floor((F.size(own) - 1) / BLOCK).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.slice(own, i * BLOCK + 1, F.lit(BLOCK)))
        return F.when(F.size(own) > 0, blocks).otherwise(F.slice(blocks, 1, 0))

    return _once(items, cut)


def _carried(values: Column, start: Column, step, kind: str) -> Column:
    """What ``step`` has made of ``start`` and the values before each value: one entry per block, a short array."""
    none = F.expr(f"cast(array() as array<{kind}>)")
    walk = F.aggregate(
        values, F.struct(start.cast(kind).alias("now"), none.alias("out")),
        lambda acc, v: F.struct(step(acc["now"], v).cast(kind).alias("now"), F.concat(acc["out"], F.array(acc["now"])).alias("out")),
    )
    return walk["out"]


def _find(text: Column, pattern: str) -> Column:
    """Start, end and text of each match, from left to right; positions count code points.

    Pieces between matches and the matches themselves add up to the positions,
    first inside blocks of matches, then over the blocks, so a text full of
    matches costs little more for each of them. Texts without a match pay one scan.
    """
    pieces = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.filter(F.zip_with(pieces, found, lambda p, m: F.struct(F.length(p).alias("gap"), m.alias("m"))), lambda x: x["m"].isNotNull())
    none = F.expr("cast(array() as array<struct<s:int,e:int,m:string>>)")

    def inside(block: Column) -> Column:
        return F.aggregate(
            block, F.struct(F.lit(0).alias("at"), none.alias("out")),
            lambda acc, x: F.struct(
                (acc["at"] + x["gap"] + F.length(x["m"])).alias("at"),
                F.concat(acc["out"], F.array(F.struct((acc["at"] + x["gap"]).alias("s"), (acc["at"] + x["gap"] + F.length(x["m"])).alias("e"), x["m"].alias("m")))).alias("out"),
            ),
        )

    def shifted(walked: Column) -> Column:
        starts = _carried(F.transform(walked, lambda w: w["at"]), F.lit(0), lambda now, size: now + size, "int")
        return F.flatten(F.zip_with(walked, starts, lambda w, o: F.transform(w["out"], lambda x: F.struct((x["s"] + o).alias("s"), (x["e"] + o).alias("e"), x["m"].alias("m")))))

    walked = F.transform(_blocks(steps), inside)
    return F.when(text.rlike(pattern), _once(walked, shifted)).otherwise(none)


def _apart(candidates: Column, base: Column) -> Column:
    """Candidates (s, e, m) that touch no base span; both are in order of start.

    Merged in order and cut into blocks: a candidate is compared with the spans of
    its block, the furthest end of the blocks before and the next start behind.
    """
    mark = F.lit(None).cast("string")
    merged = F.array_sort(F.concat(
        F.transform(base, lambda b: F.struct(b["s"].alias("s"), F.lit(0).alias("own"), b["e"].alias("e"), mark.alias("m"))),
        F.transform(candidates, lambda x: F.struct(x["s"].alias("s"), F.lit(1).alias("own"), x["e"].alias("e"), x["m"].alias("m"))),
    ))

    def told(blocks: Column) -> Column:
        spans = F.transform(blocks, lambda b: F.filter(b, lambda x: x["own"] == 0))
        ends = F.transform(spans, lambda b: F.coalesce(F.array_max(F.transform(b, lambda x: x["e"])), F.lit(-1)))
        firsts = F.transform(spans, lambda b: F.coalesce(F.array_min(F.transform(b, lambda x: x["s"])), F.lit(2147483647)))
        before = _carried(ends, F.lit(-1), lambda now, e: F.greatest(now, e), "int")
        behind = F.reverse(_carried(F.reverse(firsts), F.lit(2147483647), lambda now, s: F.least(now, s), "int"))
        return F.arrays_zip(blocks.alias("items"), spans.alias("spans"), before.alias("before"), behind.alias("behind"))

    def kept(b: Column) -> Column:
        free = F.filter(b["items"], lambda x: (x["own"] == 1) & (b["before"] <= x["s"]) & (b["behind"] >= x["e"])
                        & ~F.exists(b["spans"], lambda y: (y["s"] < x["e"]) & (x["s"] < y["e"])))
        return F.transform(free, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m")))

    whole = F.flatten(F.transform(_once(_blocks(merged), told), kept))
    return F.when((F.size(candidates) > 0) & (F.size(base) > 0), whole).otherwise(candidates)


def _base(text: Column, kind: str) -> Column:
    pattern, group, least = BASE_KINDS[kind]
    found = _find(text, pattern)
    return F.filter(found, lambda x: F.length(F.regexp_extract(x["m"], pattern, group)) >= least) if group else found


def _characters(token: Column) -> Column:
    return F.filter(F.split(token, ""), lambda c: c != "")


def _place(character: Column) -> Column:
    """Place of a character in the alphabet from 1, or 0."""
    return F.instr(F.lit(ALPHABET), character)


@dataclass
class SecretModel:
    """Log-likelihood ratios of character pairs: entry width * (place before) + place; place 0 before the first."""

    weights: list[float]

    def ratio(self, token: Column) -> Column:
        """Log-likelihood ratio of ``token``, random against ordinary; its characters are of the alphabet."""
        width = len(ALPHABET) + 1
        table = F.split(F.lit(",".join(f"{w:.4f}" for w in self.weights)), ",").cast("array<double>")

        def step(acc, character):
            at = _place(character)
            return F.struct(at.alias("before"), (acc["sum"] + F.element_at(table, acc["before"] * width + at + 1)).alias("sum"))

        return F.aggregate(_characters(token), F.struct(F.lit(0).alias("before"), F.lit(0.0).alias("sum")), step, lambda acc: acc["sum"])


def fit_secrets(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, key: str = "doc_id", text: str = "text") -> SecretModel:
    """Train both models on labelled strings of at most ``sample_rows`` documents, those whose keys hash lowest.

    Random strings are what the base patterns find there; ordinary identifiers
    are long words of the rest of the texts. Only the counts of character pairs
    (at most two for each pair of the alphabet) reach the driver. Without samples
    the models are uniform and no candidate is called a secret.
    """
    chosen = smallest_ids(docs.select(F.col(key).alias("_key")).distinct(), sample_rows, "_key")
    texts = docs.select(F.col(key).alias("_key"), F.col(text).alias("text")).join(F.broadcast(chosen), "_key")
    texts = written(texts.filter(F.col("text").isNotNull()).groupBy("_key").agg(F.min("text").alias("text")).select("text"), "secret-sample")
    values, rest = [], F.col("text")
    for pattern, group, least in BASE_KINDS.values():
        found = F.regexp_extract_all(F.col("text"), F.lit(pattern), F.lit(group))
        values.append(F.filter(found, lambda v, n=least: F.length(v) >= n))
        rest = F.regexp_replace(rest, pattern, " ")
    ordinary = F.regexp_extract_all(rest, F.lit(IDENTIFIER), F.lit(0))
    strings = texts.select(F.lit(1).alias("random"), F.explode(F.concat(*values)).alias("t")).unionByName(
        texts.select(F.lit(0).alias("random"), F.explode(ordinary).alias("t"))
    )
    places = strings.select("random", F.transform(_characters(F.col("t")), _place).alias("p"))
    before = F.concat(F.array(F.lit(0)), F.slice("p", 1, F.greatest(F.size("p") - 1, F.lit(0))))
    pairs = places.select("random", F.inline(F.arrays_zip(before.alias("a"), F.col("p").alias("b")))).toDF("random", "a", "b")
    counts = pairs.filter("b > 0").groupBy("random", "a", "b").count().collect()
    width = len(ALPHABET) + 1
    logs = []
    for label in (0, 1):
        table = [[0] * width for _ in range(width)]
        for r in counts:
            if r["random"] == label:
                table[r["a"]][r["b"]] = r["count"]
        # Pairs not met fall back on how often the character is met at all, and that on all characters alike.
        single = [sum(row[b] for row in table) + 0.5 for b in range(width)]
        single = [c / (sum(single) - single[0]) for c in single]
        logs.append([math.log((row[b] + BACK_OFF * single[b]) / (sum(row) + BACK_OFF)) if b else 0.0 for row in table for b in range(width)])
    return SecretModel([r - o for o, r in zip(*logs)])


def scan_secrets(docs: DataFrame, model: SecretModel, text: str = "text") -> DataFrame:
    """``docs`` with ``n_assign``, ``n_access``, ``n_hex``, ``base`` and ``spans``; columns of these names are replaced.

    ``base`` and ``spans`` are arrays of (s, rank, e, kind) in order of start and
    kind, in code points, ends exclusive. ``base`` has the matches of the fixed
    patterns; ``spans`` also has the candidates that the models call random and
    that touch no base match. A null text counts as empty: empty arrays. Equal
    texts agree; an empty table gives no rows; texts are scanned whole.
    """
    kinds = list(BASE_KINDS)
    rows = docs.drop(*[f"n_{kind}" for kind in kinds], "base", "spans")
    tag = free_prefix(rows)
    body, long, random = f"{tag}body", f"{tag}long", f"{tag}random"
    rows = rows.withColumn(body, F.coalesce(F.col(f"`{text}`"), F.lit("")))
    rows = rows.withColumns({**{tag + kind: _base(F.col(body), kind) for kind in kinds}, long: _find(F.col(body), CANDIDATE)})

    def of(column, kind, rank):
        return F.transform(F.col(column), lambda x: F.struct(x["s"].alias("s"), F.lit(rank).alias("rank"), x["e"].alias("e"), F.lit(kind).alias("kind")))

    rows = rows.withColumns({
        **{f"n_{kind}": F.size(tag + kind).cast("long") for kind in kinds},
        "base": F.array_sort(F.concat(*[of(tag + kind, kind, rank) for rank, kind in enumerate(kinds)])),
    })
    apart = _apart(F.col(long), F.col("base"))
    least = lambda x: F.greatest(F.lit(LEAST_RATIO), F.length(x["m"]) * LEAST_EACH)
    varied = lambda x: F.size(F.array_distinct(_characters(x["m"]))) >= LEAST_DISTINCT
    rows = rows.withColumn(random, F.filter(apart, lambda x: varied(x) & (model.ratio(x["m"]) >= least(x))))
    rows = rows.withColumn("spans", F.array_sort(F.concat(F.col("base"), of(random, MARKOV, len(kinds)))))
    return rows.drop(body, long, random, *[tag + kind for kind in kinds])


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with each span (or run of overlapping spans) replaced by a placeholder.

    Blocks of spans cut their stretch out of the text once and rebuild it alone;
    the stretches are joined at the end.
    """

    def stretch(block: Column) -> Column:
        # The text from where the earlier spans end to where those of this block end; positions count from its start.
        own = F.substring(text, block["before"] + 1, F.greatest(block["upto"] - block["before"], F.lit(0)))

        def step(acc, x):
            put = F.concat(acc["out"], F.substring(acc["own"], acc["at"] - block["before"] + 1, x["s"] - acc["at"]), F.lit(PLACEHOLDER))
            return F.struct(acc["own"].alias("own"), F.greatest(acc["at"], x["e"]).alias("at"), F.when(x["s"] >= acc["at"], put).otherwise(acc["out"]).alias("out"))

        start = F.struct(own.alias("own"), block["before"].alias("at"), F.lit("").alias("out"))
        return F.aggregate(block["items"], start, step, lambda acc: acc["out"])

    def told(blocks: Column) -> Column:
        ends = F.transform(blocks, lambda b: F.array_max(F.transform(b, lambda x: x["e"])))
        return F.arrays_zip(blocks.alias("items"), _carried(ends, F.lit(0), lambda now, e: F.greatest(now, e), "int").alias("before"), ends.alias("upto"))

    parts = F.transform(_once(_blocks(spans), told), stretch)
    tail = F.substring(text, F.array_max(F.transform(spans, lambda x: x["e"])) + 1, F.length(text))
    return F.when(F.size(spans) > 0, F.concat(F.array_join(parts, ""), tail)).otherwise(text)
