"""SimHash near-duplicates: candidate pairs thinned by distances to reference fingerprints, then verified."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmetrics.llm.components import components
from wardmetrics.llm.texts import per_block
from wardmetrics.session import written

SHINGLE_WORDS = 3
MOST_BITS = 2
PIVOTS = 24
# A bucket with more fingerprints than this is settled by masked sorting instead of pairs.
PAIR_LIMIT = 8192

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of a text's word shingles, A-Z in lower case; 0 without a word.

    A bit is set if it is set in over half of the shingles' hashes (XXH64, seed 42), repeats counting.
    """
    import xxhash

    own = text.lower().split()  # bytes: only A-Z change, and the six ASCII spaces split
    if not own:
        return 0
    whole = b" ".join(own)
    ends = np.cumsum([len(w) + 1 for w in own]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    run = min(words, len(own))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(whole[a:b], 42) for a, b in zip(starts[: len(own) - run + 1].tolist(), ends[run - 1 :].tolist())], np.uint64)
    parts = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    out = 0
    for k in range(8):
        votes = np.bincount(parts[:, k], minlength=256) @ _BITS
        out |= int(np.packbits(2 * votes > len(hashes), bitorder="little")[0]) << (8 * k)
    return out


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """``keep`` and ``fp`` (the fingerprint's 64 bits as a long) of every whole text; a null text has no words."""

    def work(block):
        found = np.array([fingerprint(block.text(i), words) for i in range(len(block))], np.uint64)
        return {"fp": pa.array(found.view(np.int64))}

    return per_block(docs, work, "fp long", keep, text)


def reference_fingerprints(count: int = PIVOTS, seed: int = 17) -> list[int]:
    """Random reference fingerprints, signed."""
    return np.random.default_rng(seed).integers(0, 1 << 64, count, np.uint64, endpoint=False).view(np.int64).tolist()


def _masks(bits: int) -> list[int]:
    """Masks of all choices of two out of ``bits`` + 2 blocks: fingerprints that differ in ``bits`` places agree on one."""
    edges = np.linspace(0, 64, bits + 3).astype(int)
    blocks = [(1 << int(b)) - (1 << int(a)) for a, b in zip(edges[:-1], edges[1:])]
    return [a | b for a, b in combinations(blocks, 2)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


class _Forest:
    """Union of numbered rows by the least, over arrays of pairs."""

    def __init__(self, size: int):
        self.root = np.arange(size)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.root[a], self.root[b]
            open_ = x != y
            if not open_.any():
                return
            a, b, x, y = a[open_], b[open_], x[open_], y[open_]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            self.settle()

    def settle(self) -> None:
        while True:
            up = self.root[self.root]
            if np.array_equal(up, self.root):
                return
            self.root = up


def link_bucket_rows(bucket: np.ndarray, free: np.ndarray, fp: np.ndarray, table: np.ndarray, bits: int) -> np.ndarray:
    """Least row linked to each row, over links of at most ``bits`` bits inside buckets.

    Rows are sorted by bucket and first pivot distance. ``table`` has each row's
    distances to the reference fingerprints; a pair is discarded as soon as one
    coordinate differs by more than ``bits``, for no pair that close can; what
    survives is verified on the fingerprints. Rows already linked are not paired
    again. ``free`` is the mask of the bits on which a bucket's rows may differ;
    buckets over PAIR_LIMIT rows are sorted once for each choice of ``bits`` free
    bits with these cleared, which finds the same links in order of their size.
    """
    forest = _Forest(len(fp))
    edge = np.concatenate((np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))), [len(bucket)]))
    size = np.repeat(np.diff(edge), np.diff(edge))
    at = np.flatnonzero((size > 1) & (size <= PAIR_LIMIT))
    step = 1
    while len(at):
        at = at[at + step < len(fp)]
        at = at[(bucket[at] == bucket[at + step]) & (table[at + step, 0] - table[at, 0] <= bits)]
        pair = at[forest.root[at] != forest.root[at + step]]
        for c in range(1, table.shape[1]):
            if not len(pair):
                break
            pair = pair[np.abs(table[pair, c] - table[pair + step, c]) <= bits]
        pair = pair[np.bitwise_count(fp[pair] ^ fp[pair + step]) <= bits]
        forest.join(pair, pair + step)
        step += 1
    for first, last in zip(edge[:-1], edge[1:]):
        if last - first > PAIR_LIMIT:
            own = fp[first:last]
            places = [b for b in range(64) if int(free[first]) >> b & 1]
            for chosen in combinations(places, bits):
                cleared = own & np.uint64(~sum(1 << b for b in chosen) & (1 << 64) - 1)
                order = np.argsort(cleared, kind="stable")
                same = np.flatnonzero(cleared[order[1:]] == cleared[order[:-1]])
                forest.join(first + order[same], first + order[same + 1])
    forest.settle()
    return forest.root


def near_links(distinct: DataFrame, bits: int = MOST_BITS) -> DataFrame:
    """Links (``a``, ``b``) that connect all fingerprints ``fp`` within ``bits`` bits of each other.

    Blocks of bits give equal join keys: each fingerprint goes to one bucket per
    choice of two blocks, and each close pair meets in a bucket. A bucket gives
    each of its fingerprints one link to the least it is connected with there,
    never all its pairs. The pivot table is computed once per fingerprint.
    """
    masks = _masks(bits)
    pivots = reference_fingerprints()
    table = distinct.select("fp", F.array(*[F.bit_count(F.col("fp").bitwiseXOR(F.lit(p))).cast("tinyint") for p in pivots]).alias("near"))
    kinds = F.array(*[F.struct(F.lit(i).alias("kind"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bucket")) for i, m in enumerate(masks)])
    spread = table.select("fp", "near", F.inline(kinds))
    parts = max(int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = spread.repartition(parts, "kind", "bucket").sortWithinPartitions("kind", "bucket", F.col("near")[0])

    def run(batches):
        held: list[pa.RecordBatch] = []

        def settle(rows: pa.Table):
            kind = rows["kind"].to_numpy()
            bucket, fp = rows["bucket"].to_numpy(), rows["fp"].to_numpy().view(np.uint64)
            new = np.concatenate(([True], (kind[1:] != kind[:-1]) | (bucket[1:] != bucket[:-1])))
            near = rows["near"].combine_chunks().flatten().to_numpy().reshape(len(fp), -1).astype(np.int16)
            free = np.array([~m & (1 << 64) - 1 for m in masks], np.uint64)[kind]
            root = link_bucket_rows(np.cumsum(new), free, fp, near, bits)
            linked = np.flatnonzero(root != np.arange(len(root)))
            signed = fp.view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(signed[linked]), pa.array(signed[root[linked]])], names=["a", "b"])

        count = 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count < 50_000:
                continue
            rows = pa.Table.from_batches(held)
            kind, bucket = rows["kind"].to_numpy(), rows["bucket"].to_numpy()
            turn = np.flatnonzero((kind[1:] != kind[:-1]) | (bucket[1:] != bucket[:-1]))
            if len(turn):  # whole buckets only; the last may go on
                yield settle(rows.slice(0, turn[-1] + 1))
                rows = rows.slice(turn[-1] + 1)
            held, count = rows.to_batches(), rows.num_rows if len(turn) else 0
        if held:
            rows = pa.Table.from_batches(held)
            if rows.num_rows:
                yield settle(rows)

    return dealt.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, bits: int = MOST_BITS) -> DataFrame:
    """``key``, ``fp`` and ``component_id`` of every row.

    Rows whose fingerprints differ in at most ``bits`` bits are linked; a
    component is all that links reach, named by its smallest key. Equal
    fingerprints are one node, so a group of copies of any size costs one row in
    the search. Null texts and texts without a word have fingerprint 0 and link
    like others; null keys name no component unless it has no other key; repeated
    rows share a component; an empty table gives no rows.
    """
    rows = written(fingerprints(docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_body")), ["_key"], "_body", words), "simhash")
    distinct = written(rows.groupBy("fp").agg(F.min("_key").alias("least")), "simhash-distinct")
    found = components(near_links(distinct, bits))
    placed = written(distinct.join(found, distinct["fp"] == found["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "simhash-placed")
    names = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = written(placed.join(names, "root").select("fp", "component_id"), "simhash-named")
    return rows.join(named, "fp").select(F.col("_key").alias(key), "fp", "component_id")
