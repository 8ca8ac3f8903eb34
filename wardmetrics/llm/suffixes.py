"""Removal of repeated passages: sampled suffixes, range-partitioned, sorted and compared.

A passage of LENGTH bytes that starts at two places of the corpus contains the
same least gram at the same distance from its start, so only suffixes that begin
at such grams (about one in eighty) need to meet each other. They are dealt by
sampled splitters on their leading bytes, sorted by multikey quicksort to both
sides of the gram, and compared with their neighbours.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmetrics.llm.texts import Block, added, blocks, in_small_batches
from wardmetrics.session import written

LENGTH = 200
GRAM = 32
# Grams that occur this often are compared window by window, counted before the shuffle.
HOT_GRAM = 20_000
# The filter of repeated grams has at most so many bits (32 MB); it only saves work, a false hit costs a comparison.
FILTER_BITS = 28
# Tasks fill it in pages of so many bits (4 kB), so that the driver takes over bytes and no row for each of its words.
PAGE_BITS = 15
# Suffix groups are compared in chunks of about so many rows.
CHUNK_ROWS = 30_000

_BASE = 0x9E3779B97F4A7C15
# Long texts are sampled in stretches of so many window starts, so that a place fits in 24 bits.
STRETCH = 1 << 23


@dataclass
class Anchors:
    """Where windows of one least gram begin: ``first`` to ``last`` (inclusive), the gram at ``at``, its hash."""

    at: np.ndarray
    first: np.ndarray
    last: np.ndarray
    hash: np.ndarray


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes at each place, from prefix sums modulo 2**64."""
    n = len(data)
    with np.errstate(over="ignore"):
        powers = np.full(n, np.uint64(_BASE), np.uint64)
        powers[0] = 1
        np.cumprod(powers, out=powers)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(powers * (data.astype(np.uint64) + np.uint64(1)))))
        inverse = np.full(n - gram + 1, np.uint64(pow(_BASE, -1, 1 << 64)), np.uint64)
        inverse[0] = 1
        np.cumprod(inverse, out=inverse)
        h = (sums[gram:] - sums[: n - gram + 1]) * inverse
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    return h


def _sample(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> Anchors:
    """Anchors of all windows that end by ``ends`` (the end of the text, for each window start)."""
    h = gram_hashes(data, gram)
    width = length - gram + 1  # grams in a window
    windows = len(data) - length + 1
    key = (h & np.uint64(0xFFFFFFFFFF000000)) | np.arange(len(h), dtype=np.uint64)
    rest = -len(key) % width
    grid = np.concatenate((key, np.full(rest, np.iinfo(np.uint64).max, np.uint64))).reshape(-1, width)
    upto = np.minimum.accumulate(grid, axis=1).ravel()
    onward = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(onward[:windows], upto[width - 1 : width - 1 + windows])
    place = (least & np.uint64(0xFFFFFF)).astype(np.int64)
    start = np.flatnonzero(np.arange(windows) + length <= ends[:windows])
    if not len(start):
        return Anchors(*(np.empty(0, np.int64) for _ in range(3)), np.empty(0, np.uint64))
    at = place[start]
    cut = np.flatnonzero((at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)) + 1
    head, tail = np.concatenate(([0], cut)), np.concatenate((cut, [len(start)])) - 1
    return Anchors(at[head], start[head], start[tail], h[at[head]])


def anchors(block: Block, length: int = LENGTH, gram: int = GRAM) -> Anchors:
    """Anchors of a block of whole texts; windows never cross texts."""
    found = []
    if len(block.data) <= STRETCH:
        if len(block.data) >= length:
            found.append(_sample(block.data, np.repeat(block.offsets[1:], block.sizes), length, gram))
    else:  # one long text, in stretches that overlap by a window
        for begin in range(0, len(block.data) - length + 1, STRETCH):
            part = block.data[begin : begin + STRETCH + length - 1]
            own = _sample(part, np.full(len(part), len(part)), length, gram)
            found.append(Anchors(own.at + begin, own.first + begin, own.last + begin, own.hash))
    if not found:
        return Anchors(*(np.empty(0, np.int64) for _ in range(3)), np.empty(0, np.uint64))
    return Anchors(*(np.concatenate([getattr(f, k) for f in found]) for k in ("at", "first", "last", "hash")))


def hash_filter(hashes: DataFrame, rows: int) -> tuple[np.ndarray, int]:
    """A bit set of the hashes ``h`` (as words) and its size as a power of two, at most FILTER_BITS.

    The driver gets the pages that tasks have filled: as many bytes as the filter has, however many hashes there are.
    """
    bits = int(min(max(np.ceil(np.log2(max(rows, 1) * 16)), 10), FILTER_BITS))
    page = min(bits, PAGE_BITS)
    slots = hashes.select(F.col("h").bitwiseAND(F.lit((1 << bits) - 1)).alias("slot"))

    def fill(batches):
        held: dict = {}
        for batch in batches:
            slot = np.sort(batch.column(0).to_numpy())
            for own in np.split(slot, np.flatnonzero(np.diff(slot >> page)) + 1):
                if len(own):
                    words = held.setdefault(int(own[0]) >> page, np.zeros(1 << (page - 5), np.uint32))
                    np.bitwise_or.at(words, own >> 5 & (1 << (page - 5)) - 1, np.uint32(1) << (own & 31).astype(np.uint32))
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([w.tobytes() for w in held.values()], pa.binary())], names=["page", "words"])

    out = np.zeros((1 << (bits - page), 1 << (page - 5)), np.uint32)
    for row in slots.repartition(F.shiftright("slot", page)).mapInArrow(fill, "page int, words binary").collect():
        out[row["page"]] = np.frombuffer(row["words"], np.uint32)
    return out.ravel(), bits


def in_filter(table: tuple[np.ndarray, int], h: np.ndarray) -> np.ndarray:
    words, bits = table
    slot = h & np.uint64((1 << bits) - 1)
    return (words[(slot >> np.uint64(5)).astype(np.int64)] >> (slot & np.uint64(31)).astype(np.uint32)) & 1 == 1


def multikey_order(words: np.ndarray, length: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in order of (group, words, length), and how many bytes each shares with the row before it in its group.

    Multikey quicksort, all segments of a depth at a time: only rows that still
    tie go down to their next eight bytes. Across groups, and for the first row,
    the shared length is 0.
    """
    n = len(group)
    order = np.argsort(group, kind="stable")
    shared = np.full(n, -1, np.int64)
    shared[np.concatenate(([True], group[order][1:] != group[order][:-1]))] = 0
    for depth in range(words.shape[1] + 1):
        tied = shared < 0
        member = tied | np.concatenate((tied[1:], [False]))  # a row of a segment of two or more
        at = np.flatnonzero(member)
        if not len(at):
            break
        segment = np.cumsum(~tied)[at]
        value = words[order[at], depth] if depth < words.shape[1] else length[order[at]].astype(np.uint64)
        inner = np.lexsort((value, segment))
        order[at] = order[at][inner]
        if depth == words.shape[1]:
            shared[tied] = 8 * depth
            break
        value = value[inner]
        parted = np.flatnonzero((segment[1:] == segment[:-1]) & (value[1:] != value[:-1])) + 1
        mixed = value[parted] ^ value[parted - 1]
        same = sum((mixed >> np.uint64(64 - 8 * k) == 0).astype(np.int64) for k in range(1, 8))
        shared[at[parted]] = 8 * depth + same
    cap = np.minimum(length[order], np.concatenate(([0], length[order][:-1])))
    return order, np.minimum(shared, cap)


def _side(data: np.ndarray, start: np.ndarray, length: np.ndarray, width: int, step: int) -> np.ndarray:
    """Bytes from ``start`` on (``step`` 1) or back (-1), up to ``length`` of each row, as big-endian words of eight."""
    width = -(-width // 8) * 8
    reach = np.arange(width)
    at = np.clip(start[:, None] + step * reach, 0, max(len(data) - 1, 0))
    grid = np.where(reach < length[:, None], data[at], 0).astype(np.uint8) if len(data) else np.zeros((len(start), width), np.uint8)
    return grid.view(">u8").astype(np.uint64)


def repeated_windows(data: np.ndarray, begin: np.ndarray, end: np.ndarray, at: np.ndarray, group: np.ndarray, times: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """For each row and window start in its stretch, whether that window's bytes occur twice or more in its group.

    A row is the stretch ``data[begin:end]`` of windows around a gram at ``at``,
    met ``times`` times. Windows are equal if they start equally far before the
    gram and agree on both sides of it; each side's rows are sorted as suffixes
    (the left one backwards), so rows that agree over some length are neighbours
    with that much in common. Rows of one group must all be given.
    """
    back, ahead = at - begin, end - at
    most = length - gram
    right, right_shared = multikey_order(_side(data, at, ahead, length, 1), ahead, group)
    left, left_shared = multikey_order(_side(data, at - 1, back, most, -1), back, group)
    out = np.zeros((len(begin), most + 1), bool)
    right_class, left_class = np.empty(len(begin), np.int64), np.empty(len(begin), np.int64)
    for offset in range(most + 1):
        rows = np.flatnonzero((back >= offset) & (ahead >= length - offset))
        if len(rows):
            right_class[right] = np.cumsum(right_shared < length - offset)
            left_class[left] = np.cumsum(left_shared < offset)
            _, number = np.unique(left_class[rows] * (len(begin) + 1) + right_class[rows], return_inverse=True)
            again = np.bincount(number, times[rows])[number] > 1
            out[rows[again], back[rows[again]] - offset] = True
    return out


def _scan(docs: DataFrame, work, schema) -> DataFrame:
    def run(batches):
        for block in blocks(batches, "_body"):
            yield from work(block)

    return in_small_batches(docs).mapInArrow(run, schema)


def _leading(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The first eight bytes from ``at`` on as a signed number in their order."""
    return (_side(data, at, np.full(len(at), 8), 8, 1)[:, 0] ^ np.uint64(1 << 63)).view(np.int64)


def gram_counts(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """Hash, count and leading bytes of every sampled gram that occurs at two places or more."""

    def work(block):
        found = anchors(block, length, gram)
        yield pa.RecordBatch.from_arrays([pa.array(found.hash.view(np.int64)), pa.array(_leading(block.data, found.at))], names=["h", "lead"])

    grams = _scan(docs, work, "h long, lead long").groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("lead").alias("lead"))
    return grams.filter("n > 1")


def splitters(grams: DataFrame, rows: int, parts: int, sample: int = 20_000) -> np.ndarray:
    """Leading bytes that cut the suffixes of ``rows`` grams into ``parts`` ranges of about equal numbers, from a bounded sample.

    It holds the grams below a bound on their hash, about ``sample`` of them: each task drops the others by itself.
    """
    bound = -(1 << 63) + min(sample * (1 << 64) // max(rows, 1), 1 << 64) - 1
    drawn = grams.filter(F.xxhash64("h") <= F.lit(bound)).select("lead", "n").toPandas().sort_values("lead")
    if not len(drawn):
        return np.empty(0, np.int64)
    upto = np.cumsum(drawn["n"].to_numpy(float))
    cuts = np.searchsorted(upto, upto[-1] * np.arange(1, parts) / parts)
    return np.unique(drawn["lead"].to_numpy(np.int64)[np.minimum(cuts, len(drawn) - 1)])


def _owner(block: Block, at: np.ndarray) -> np.ndarray:
    return np.searchsorted(block.offsets, at, "right") - 1


def suffix_spans(docs: DataFrame, table, hot: np.ndarray, cuts: np.ndarray, parts: int, length: int, gram: int) -> DataFrame:
    """Spans (``_key``, ``_sum``, ``start``, ``end``) from suffixes of the grams in ``table``, a broadcast filter, but not in ``hot``.

    A suffix row carries the bytes of its windows only. Stretches that repeat
    within a text travel once, with all their places.
    """

    def cut(block):
        found = anchors(block, length, gram)
        use = in_filter(table.value, found.hash)
        if len(hot):
            use &= ~np.isin(found.hash, hot)
        at, first, last, h = found.at[use], found.first[use], found.last[use] + length, found.hash[use]
        row = _owner(block, first)
        raw = block.data.tobytes()
        seen: dict = {}
        for i, (r, a, b, g) in enumerate(zip(row.tolist(), first.tolist(), last.tolist(), at.tolist())):
            seen.setdefault((r, g - a, raw[a:b]), []).append(i)
        if not seen:
            return
        lead = np.array([v[0] for v in seen.values()])
        rows = pa.RecordBatch.from_arrays(
            [
                pa.array(np.searchsorted(cuts, _leading(block.data, at[lead]), "right").astype(np.int32)),
                pa.array(h[lead].view(np.int64)),
                pa.array([k[1] for k in seen], pa.int32()),
                pa.array([k[2] for k in seen], pa.binary()),
                pa.array([(first[v] - block.offsets[row[v[0]]]).tolist() for v in seen.values()], pa.list_(pa.int64())),
            ],
            names=["range", "h", "back", "bytes", "places"],
        )
        owner = block.rows.select(["_key", "_sum"]).take(pa.array(row[lead]))
        yield pa.RecordBatch.from_arrays([*owner.columns, *rows.columns], names=["_key", "_sum", *rows.schema.names])

    kind = dict(docs.dtypes)["_key"]
    suffixes = _scan(docs, cut, f"_key {kind}, _sum long, range int, h long, back int, bytes binary, places array<long>")
    dealt = suffixes.repartition(parts, "range").sortWithinPartitions("range", "h")

    def settle(rows: pa.Table):
        h = rows["h"].to_numpy()
        group = np.cumsum(np.concatenate(([0], h[1:] != h[:-1])))
        places = rows["places"].combine_chunks()
        times = places.value_lengths().to_numpy()
        alone = np.bincount(group, times)[group] < 2  # false hits of the filter
        rows, group, times = rows.filter(pa.array(~alone)), group[~alone], times[~alone]
        if not rows.num_rows:
            return
        column = rows["bytes"].combine_chunks()
        edge = np.frombuffer(column.buffers()[1], np.int32, len(column) + column.offset + 1)[column.offset :].astype(np.int64)
        data = np.frombuffer(column.buffers()[2], np.uint8)
        back = rows["back"].to_numpy()
        again = repeated_windows(data, edge[:-1], edge[1:], edge[:-1] + back, group, times, length, gram)
        wide = np.zeros((len(again), again.shape[1] + 2), np.int8)
        wide[:, 1:-1] = again
        turn = np.diff(wide, axis=1)
        at, start = np.nonzero(turn == 1)
        end = np.nonzero(turn == -1)[1] - 1 + length
        places = rows["places"].combine_chunks()
        n = times[at]
        offset = np.repeat(np.concatenate(([0], np.cumsum(times)))[:-1][at] - np.cumsum(n) + n, n) + np.arange(n.sum())
        place = places.flatten().to_numpy()[offset]
        owner = rows.select(["_key", "_sum"]).take(pa.array(np.repeat(at, n))).combine_chunks()
        start, end = pa.array(place + np.repeat(start, n)), pa.array(place + np.repeat(end, n))
        for batch in pa.table([*owner.columns, start, end], names=["_key", "_sum", "start", "end"]).to_batches():
            yield batch

    def run(batches):
        held, count = [], 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count < CHUNK_ROWS:
                continue
            rows = pa.Table.from_batches(held)
            h = rows["h"].to_numpy()
            turn = np.flatnonzero(h[1:] != h[:-1])
            if len(turn):  # whole groups only; the last may go on
                yield from settle(rows.slice(0, turn[-1] + 1))
                rows = rows.slice(turn[-1] + 1)
            held, count = rows.to_batches(), rows.num_rows if len(turn) else 0
        if held:
            yield from settle(pa.Table.from_batches(held))

    return dealt.mapInArrow(run, f"_key {kind}, _sum long, start long, end long")


def hot_spans(docs: DataFrame, hot: np.ndarray, length: int, gram: int) -> DataFrame:
    """Spans from windows of the grams in ``hot``: windows are counted by a 128-bit digest, combined before the shuffle."""

    def cut(block):
        found = anchors(block, length, gram)
        use = np.isin(found.hash, hot)
        raw = block.data.tobytes()
        starts = np.concatenate([np.arange(a, b + 1) for a, b in zip(found.first[use], found.last[use])] or [np.empty(0, np.int64)])
        row = _owner(block, starts)
        owner = block.rows.select(["_key", "_sum"]).take(pa.array(row))
        digest = pa.array([hashlib.md5(raw[a : a + length], usedforsecurity=False).digest() for a in starts.tolist()], pa.binary())
        yield pa.RecordBatch.from_arrays([*owner.columns, digest, pa.array(starts - block.offsets[row])], names=["_key", "_sum", "w", "start"])

    kind = dict(docs.dtypes)["_key"]
    windows = written(_scan(docs, cut, f"_key {kind}, _sum long, w binary, start long"), "hot-windows")
    again = windows.groupBy("w").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("w")
    found = windows.join(again.hint("merge"), "w", "left_semi").select("_key", "_sum", "start", (F.col("start") + length).alias("end"))
    return written(found, "hot-spans")  # nothing shuffles behind the join, so adaptive execution may split a hot window


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, hot_gram: int = HOT_GRAM, digests: bool = False) -> DataFrame:
    """Every row's text without the bytes covered by a passage of ``length`` bytes that starts elsewhere too.

    Returns ``key``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed
    runs) and ``kept`` (the remaining bytes), or ``kept_sha256`` with
    ``digests``. Passages are compared as UTF-8 bytes, exactly; overlaps count;
    all are judged on the input; a passage may start elsewhere in the same text
    but never crosses texts. Null and empty texts and those under ``length``
    bytes keep everything. Repeated rows are copies of each other and lose what
    is long enough; null keys are a key; an empty table gives no rows.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    source = docs.select(F.col(f"`{key}`").alias("_key"), body.alias("_body"), F.xxhash64(body).alias("_sum"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    grams = written(gram_counts(source, length, gram), "repeat-grams")
    n_grams = grams.count()
    table = spark.sparkContext.broadcast(hash_filter(grams, n_grams))
    # One hash for more than ``hot_gram`` places: few, and named exactly, since a false hit costs all its windows.
    hot = grams.filter(F.col("n") > hot_gram).select("h").toPandas()["h"].to_numpy(np.int64).view(np.uint64)
    spans = suffix_spans(source, table, hot, splitters(grams, n_grams, 4 * parts), parts, length, gram)
    if len(hot):
        spans = spans.unionByName(hot_spans(source, hot, length, gram))
    # Copies of a row (same key, same text) name the same spans; the set holds them once.
    marks = spans.groupBy("_key", "_sum").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    marks = written(marks.withColumnRenamed("_key", "_of").withColumnRenamed("_sum", "_text"), "repeat-spans")
    # Only texts that lose something meet their spans; the others pass by the shuffle. A false hit meets none.
    touched = spark.sparkContext.broadcast(hash_filter(marks.select(F.col("_text").alias("h")), marks.count()))

    def losing(block):
        sums = block.rows.column(2).to_numpy().view(np.uint64)
        yield block.rows.filter(pa.array(in_filter(touched.value, sums)))

    def result(rows, sizes, removed, runs, kept):
        last = {"kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())} if digests else {"kept": pa.array(kept, pa.binary())}
        return added(rows, ["_key"], n_bytes=pa.array(sizes), n_removed=pa.array(removed), n_spans=pa.array(runs), **last)

    def keeping(block):
        alone = ~in_filter(touched.value, block.rows.column(2).to_numpy().view(np.uint64))
        none = np.zeros(np.count_nonzero(alone), np.int64)
        yield result(block.rows.filter(pa.array(alone)), block.sizes[alone], none, none, [block.text(i) for i in np.flatnonzero(alone)])

    meeting = _scan(source, losing, source.schema)
    joined = meeting.join(marks.hint("shuffle_hash"), meeting["_key"].eqNullSafe(marks["_of"]) & (meeting["_sum"] == marks["_text"]), "left")
    joined = joined.select("_key", "_body", F.col("spans.start").alias("starts"), F.col("spans.end").alias("ends"))

    def run(batches):
        for block in blocks(batches, "_body"):
            starts, ends = block.rows.column(2), block.rows.column(3)
            edge = np.zeros(len(block.data) + 1, np.int64)
            row = np.repeat(np.arange(len(block)), starts.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            np.add.at(edge, starts.flatten().to_numpy() + block.offsets[row], 1)
            np.add.at(edge, ends.flatten().to_numpy() + block.offsets[row], -1)
            gone = np.cumsum(edge[:-1]) > 0
            before = np.concatenate(([False], gone[:-1]))
            before[block.offsets[:-1][block.sizes > 0]] = False
            total = lambda flags: np.diff(np.concatenate(([0], np.cumsum(flags)))[block.offsets])  # noqa: E731, B023
            kept = [block.data[a:b][~gone[a:b]].tobytes() for a, b in zip(block.offsets[:-1], block.offsets[1:])]
            yield result(block.rows, block.sizes, total(gone), total(gone & ~before), kept)

    kind = dict(source.dtypes)["_key"]
    schema = f"_key {kind}, n_bytes long, n_removed long, n_spans long, " + ("kept_sha256 string" if digests else "kept binary")
    out = joined.mapInArrow(run, schema).unionByName(_scan(source, keeping, schema))
    return out.withColumnRenamed("_key", key)
