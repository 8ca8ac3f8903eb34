"""Trie of conversation prefixes by van Emde Boas recursion: cut at half depth, name the cut prefixes, graft totals upward."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardmetrics.session import written

# Turns of one block are named in one task row; the recursion goes over tables down to this depth (a power of two).
BLOCK_TURNS = 64
# Lists of conversation keys travel in pieces of about so many characters.
PIECE_CHARS = 1 << 16
# The rebuilding rule of the query: groups of so many conversations share the head of their first one, of 0 to 5 turns.
GROUP, HEADS = 100, 6

SALTS = (17, 29)


def ranked_turns(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv``, ``pos`` (from 1), ``symbol`` (SHA-256 of role and text), ``chars``: the turns of each conversation in order.

    Null turns come first; a null role or text is empty; equal turns follow their
    symbols, so an order is the same on every run. Only symbols are shuffled,
    never texts. The order is a range partitioning, so a conversation with a
    third of all rows is spread over many tasks: rows are numbered inside each
    part, and a part begins behind the earlier parts' counts.
    """
    who, what = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text))
    symbol = F.unhex(F.sha2(F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, what).cast("binary"), 256))
    rows = turns.select(F.col(f"`{key}`").cast("long").alias("conv"), F.col(f"`{turn}`").alias("_turn"), symbol.alias("symbol"), F.length(what).cast("long").alias("chars")).filter("conv is not null")
    order = [F.col("conv"), F.col("_turn").asc_nulls_first(), F.col("symbol")]
    parts = max(int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    ranged = written(written(rows, "turns").repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), "turns-ranged")
    counts = ranged.groupBy("_part", "conv").agg(F.count(F.lit(1)).alias("_n"))
    # A conversation has at most one row per part here.
    earlier = W.partitionBy("conv").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(F.col("_part").alias("_p"), F.col("conv").alias("_c"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = F.row_number().over(W.partitionBy("_part", "conv").orderBy(F.col("_turn").asc_nulls_first(), "symbol"))
    numbered = ranged.withColumn("_i", inside)
    joined = numbered.join(starts, (numbered["_part"] == starts["_p"]) & (numbered["conv"] == starts["_c"]))
    return joined.select("conv", (F.col("_i") + F.col("_before")).alias("pos"), "symbol", "chars")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sequences under the rebuilding rule, and all conversation keys.

    The first h turns of conversation c - c % 100, then c's own behind its first
    h; h is the CRC-32 of c in decimal, modulo 6. Heads are arrays of at most
    five turns, so a conversation meets one row there.
    """
    ids = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("_n")).select("conv")
    h = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(HEADS)).cast("int")
    base = F.col("conv") - F.col("conv") % GROUP
    heads = turns.filter((F.col("conv") % GROUP == 0) & (F.col("pos") < HEADS)).groupBy(F.col("conv").alias("_base")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "symbol", "chars"))).alias("_head"))
    asked = ids.select("conv", base.alias("_b"), h.alias("_h"))
    given = asked.join(heads, asked["_b"] == heads["_base"], "left").select("conv", F.coalesce(F.slice("_head", 1, F.col("_h")), F.array().cast(heads.schema["_head"].dataType)).alias("_head"))
    given = written(given, "conversation-heads")
    front = given.select("conv", F.explode("_head").alias("_t")).select("conv", "_t.pos", "_t.symbol", "_t.chars")
    sizes = given.select(F.col("conv").alias("_c"), F.size("_head").alias("_k"))
    own = turns.filter(F.col("pos") > h)
    behind = own.join(sizes, own["conv"] == sizes["_c"]).select("conv", (F.col("pos") - h + F.col("_k")).alias("pos"), "symbol", "chars")
    return front.unionByName(behind), ids


def _blocks(turns: DataFrame) -> DataFrame:
    """``conv``, ``block``, ``turns`` (in order, at most ``BLOCK_TURNS``), and the block's name ``x1``, ``x2``.

    A turn's name mixes its place and symbol, a prefix's name is the exclusive or
    of its turns' names: halves of a sequence are named apart and joined later.
    """
    x = [F.xxhash64(F.lit(s), "pos", "symbol").alias(f"x{i + 1}") for i, s in enumerate(SALTS)]
    named = turns.select("conv", F.col("pos").cast("long").alias("pos"), "chars", *x, F.floor((F.col("pos") - 1) / BLOCK_TURNS).cast("long").alias("block"))
    return named.groupBy("conv", "block").agg(
        F.array_sort(F.collect_list(F.struct("pos", "x1", "x2", "chars"))).alias("turns"), F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"))


UP = "array<struct<depth: bigint, n1: bigint, n2: bigint>>"


def _with_roots(blocks: DataFrame) -> DataFrame:
    """Blocks with the name of the prefix before them (``r1``, ``r2``) and the cut prefixes on their way (``up``).

    The recursion over whole blocks: a piece of ``size`` blocks is cut at half
    depth; the left half's names, combined, name the cut prefix, which is the
    root of all sequences of the right half. Then both halves are pieces of half
    the size, all in one table. Conversations of one block are done at once.
    """
    start = blocks.select("conv", "block", "turns", "x1", "x2", F.lit(0).cast("long").alias("r1"), F.lit(0).cast("long").alias("r2"), F.array().cast(UP).alias("up"))
    most = blocks.agg(F.max("block")).first()[0]
    if not most:
        return start
    long_ones = blocks.filter("block > 0").select(F.col("conv").alias("_c")).distinct()
    start = written(start, "blocks")
    alone = start.join(long_ones, start["conv"] == long_ones["_c"], "left_anti")
    now = written(start.join(long_ones, start["conv"] == long_ones["_c"], "left_semi").select("conv", "block", "x1", "x2", "r1", "r2", "up"), "cut-blocks")
    size = 1 << int(most).bit_length()
    while size > 1:
        half = size // 2
        right = (F.col("block") % size) >= half
        left = now.filter(~right).groupBy(F.col("conv").alias("_c"), F.floor(F.col("block") / size).alias("_piece")).agg(
            F.bit_xor("x1").alias("_l1"), F.bit_xor("x2").alias("_l2"))
        joined = now.filter(right).join(left, (now["conv"] == left["_c"]) & (F.floor(now["block"] / size) == left["_piece"]))
        r1, r2 = F.col("r1").bitwiseXOR(F.col("_l1")), F.col("r2").bitwiseXOR(F.col("_l2"))
        depth = ((F.floor(F.col("block") / size) * size + half) * BLOCK_TURNS).cast("long")
        cut = F.array(F.struct(depth.alias("depth"), r1.alias("n1"), r2.alias("n2")))
        moved = joined.select("conv", "block", "x1", "x2", r1.alias("r1"), r2.alias("r2"), F.concat("up", cut).alias("up"))
        now = written(now.filter(~right).unionByName(moved), "cut-blocks")
        size = half
    roots = now.select(F.col("conv").alias("_c"), F.col("block").alias("_b"), "r1", "r2", "up")
    whole = start.select("conv", "block", "turns", "x1", "x2")
    back = whole.join(roots, (whole["conv"] == roots["_c"]) & (whole["block"] == roots["_b"])).select(*start.columns)
    return alone.unionByName(back)


PREFIXES = ["conv", "depth", "n1", "n2", "p1", "p2", "chars"]


def prefixes(turns: DataFrame) -> DataFrame:
    """One row per conversation and prefix: its name (``depth``, ``n1``, ``n2``), its parent's, the last turn's ``chars``, and
    the names of the cut prefixes it lies below (``up``), one for each cut of the recursion that has it in the lower half."""
    rooted = _with_roots(_blocks(turns)).select("conv", "r1", "r2", "up", "turns")
    item = pa.struct([("depth", pa.int64()), ("n1", pa.int64()), ("n2", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 1 << 12):
                batch = whole.slice(first, 1 << 12)
                lists = batch.column(4)
                counts = np.diff(lists.offsets.to_numpy())
                flat = lists.flatten()
                pos, x1, x2, chars = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("pos", "x1", "x2", "chars"))
                row = np.repeat(np.arange(len(counts)), counts)
                begin = (np.cumsum(counts) - counts)[row]
                names, parents = [], []
                for x, root in ((x1, 1), (x2, 2)):
                    run_xor = np.bitwise_xor.accumulate(x) if len(x) else x
                    before = run_xor ^ x
                    name = run_xor ^ before[begin] ^ batch.column(root).to_numpy(zero_copy_only=False)[row] if len(x) else x
                    names.append(name)
                    parents.append(name ^ x)
                # Cuts inside the block: each bit set in (depth - 1) below the block size is a level with this row in its lower half.
                depths, owners, at = [], [], []
                below = (pos - 1) % BLOCK_TURNS
                for k in range(BLOCK_TURNS.bit_length() - 1):
                    hit = np.flatnonzero(below >> k & 1)
                    cut = ((pos[hit] - 1) >> k) << k
                    owners.append(hit)
                    depths.append(cut)
                    at.append(begin[hit] + (cut - pos[begin[hit]]))
                owners, depths, at = (np.concatenate(v) if v else np.empty(0, np.int64) for v in (owners, depths, at))
                # Cuts at whole blocks: those of the row's block.
                ups = batch.column(3)
                up_counts = np.diff(ups.offsets.to_numpy())
                up_flat = ups.flatten()
                up_depth, up_1, up_2 = (up_flat.field(c).to_numpy(zero_copy_only=False) for c in ("depth", "n1", "n2"))
                up_begin = np.cumsum(up_counts) - up_counts
                each = up_counts[row]
                from_block = np.repeat(np.arange(len(pos)), each)
                step = np.arange(len(from_block)) - np.repeat(np.cumsum(each) - each, each)
                src = up_begin[row][from_block] + step
                owner = np.concatenate((owners, from_block)).astype(np.int64)
                order = np.argsort(owner, kind="stable")
                fields = [np.concatenate((depths, up_depth[src]))[order], np.concatenate((names[0][at], up_1[src]))[order], np.concatenate((names[1][at], up_2[src]))[order]]
                offsets = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(pos)))))
                up = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([pa.array(f, pa.int64()) for f in fields], fields=list(item)))
                conv = batch.column(0).to_numpy(zero_copy_only=False)[row]
                arrays = [conv, pos, *names, *parents, chars]
                yield pa.RecordBatch.from_arrays([*(pa.array(a, pa.int64()) for a in arrays), up], names=[*PREFIXES, "up"])

    return rooted.mapInArrow(run, ", ".join(f"{c} long" for c in PREFIXES) + f", up {UP}")


NAME = ["depth", "n1", "n2"]


def _matches(left: DataFrame, right: DataFrame, names: list[str], others: list[str]) -> Column:
    out = F.lit(True)
    for a, b in zip(names, others):
        out = out & (left[a] == right[b])
    return out


def ends_digest(ends: DataFrame) -> DataFrame:
    """``_ed``, ``_e1``, ``_e2``, ``ends_sha256``: the digest of each node's ending conversations, ascending, comma-joined.

    A node may end a third of all conversations. Its keys are sorted over many
    tasks by range and joined to pieces there; a digest takes its bytes in order,
    so one task then reads a node's pieces one after the other, and holds one.
    """
    ranged = ends.select(*NAME, "conv").repartitionByRange(*NAME, "conv").sortWithinPartitions(*NAME, "conv")

    def join(batches):
        name, first, held, size, out = None, None, [], 0, []

        def piece():
            return (*name, first, ",".join(held))

        for batch in batches:
            for *own, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if own != name or size >= PIECE_CHARS:
                    if held:
                        out.append(piece())
                    name, first, held, size = own, conv, [], 0
                held.append(str(conv))
                size += len(held[-1]) + 1
                if len(out) >= 1000:
                    yield rows(out)
                    out = []
        if held:
            out.append(piece())
        if out:
            yield rows(out)

    def rows(out):
        arrays = [pa.array(c, pa.string() if i == 4 else pa.int64()) for i, c in enumerate(zip(*out))]
        return pa.RecordBatch.from_arrays(arrays, names=[*NAME, "first", "piece"])

    def digest(batches):
        name, state, out = None, None, []
        for batch in batches:
            for d, n1, n2, _, text in zip(*(c.to_pylist() for c in batch.columns)):
                if (d, n1, n2) != name:
                    if state:
                        out.append((*name, state.hexdigest()))
                    name, state = (d, n1, n2), hashlib.sha256()
                else:
                    state.update(b",")
                state.update(text.encode())
            if len(out) >= 1000:
                yield digests(out)
                out = []
        if state:
            out.append((*name, state.hexdigest()))
        if out:
            yield digests(out)

    def digests(out):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if i == 3 else pa.int64()) for i, c in enumerate(zip(*out))], names=["_ed", "_e1", "_e2", "ends_sha256"])

    pieces = ranged.mapInArrow(join, "depth long, n1 long, n2 long, first long, piece string")
    return pieces.repartition(*NAME).sortWithinPartitions(*NAME, "first").mapInArrow(digest, "_ed long, _e1 long, _e2 long, ends_sha256 string")


def subtree_sums(nodes: DataFrame, columns: list[str], deepest: int) -> DataFrame:
    """``_sd``, ``_s1``, ``_s2`` and per column the sum over all nodes strictly below: one row for each node with any.

    Nodes carry ``up``. A cut's lower forests add up to their roots, for all cuts
    of the recursion in one aggregate. What the grafts of deeper cuts brought to
    the last level of a forest is passed on from the coarsest cut to the finest:
    a node at depth d takes it from its descendants at d plus its lowest bit, so
    rounds are as many as the depth has bits and each reads half as many nodes
    as the next. The root takes the sum of all.
    """
    sums = [F.sum(c).alias(c) for c in columns]
    edges = written(nodes.select(*NAME, *columns, F.explode("up").alias("_u")).select(
        F.col("_u.depth").alias("_sd"), F.col("_u.n1").alias("_s1"), F.col("_u.n2").alias("_s2"), *NAME, *columns), "trie-cuts")
    target = ["_sd", "_s1", "_s2"]
    own = written(edges.groupBy(*target).agg(*sums), "trie-forests")
    zero = F.lit(0).cast("long")
    total = nodes.filter("depth > 0").agg(F.count(F.lit(1)).alias("_n"), *sums).filter("_n > 0").select(zero.alias("_sd"), zero.alias("_s1"), zero.alias("_s2"), *columns)
    done = total
    bit = 1 << max(deepest, 1).bit_length() - 1
    carried: DataFrame | None = None
    while bit:
        here = own.filter((F.col("_sd") % (2 * bit)) == bit)
        if carried is not None:
            passing = edges.filter((F.col("depth") % (2 * bit) == 0) & (F.col("_sd") == F.col("depth") - bit)).select(*target, *NAME)
            source = carried.select(F.col("_sd").alias("_cd"), F.col("_s1").alias("_c1"), F.col("_s2").alias("_c2"), *columns)
            brought = passing.join(source, _matches(passing, source, NAME, ["_cd", "_c1", "_c2"]))
            here = here.unionByName(brought.select(*target, *columns)).groupBy(*target).agg(*sums)
        here = written(here, "trie-grafts")
        carried = here if carried is None else carried.unionByName(here)
        bit //= 2
    return carried.unionByName(done) if carried is not None else done


def trie(sequences: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per node of the trie of ``sequences`` (``conv``, ``pos``, ``symbol``, ``chars``) of the conversations ``ids``.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``. Members are
    counted by name and combined before the shuffle, so a first turn that a third
    of all conversations share is one row there. Without conversations there is
    no node; a conversation without turns is a member of the root.
    """
    zero = F.lit(0).cast("long")
    tops = ids.select("conv", zero.alias("depth"), zero.alias("n1"), zero.alias("n2"), F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"), zero.alias("chars"), F.array().cast(UP).alias("up"))
    rows = written(prefixes(sequences).unionByName(tops), "trie-prefixes")
    counted = rows.groupBy(*NAME).agg(F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
    counted = counted.select(F.col("depth").alias("_d"), F.col("n1").alias("_1"), F.col("n2").alias("_2"), "conv_id", "n_convs")
    # The smallest member's own row tells what all members share.
    nodes = rows.join(counted, _matches(rows, counted, NAME, ["_d", "_1", "_2"]) & (rows["conv"] == counted["conv_id"])).select(
        "conv_id", *NAME, "p1", "p2", "n_convs", "up", ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    nodes = written(nodes, "trie-nodes")
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("_cd"), F.col("p1").alias("_c1"), F.col("p2").alias("_c2")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, _matches(nodes, children, NAME, ["_cd", "_c1", "_c2"]), "left").select(
        *nodes.columns, F.coalesce("n_children", zero).alias("n_children")).withColumn("leaf", (F.col("n_children") == 0).cast("long"))
    nodes = written(nodes, "trie-nodes")
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    below = subtree_sums(nodes, ["leaf", "saved"], deepest).select("_sd", "_s1", "_s2", F.col("leaf").alias("_leaf"), F.col("saved").alias("_saved"))
    lengths = rows.groupBy("conv").agg(F.max("depth").alias("_len")).select(F.col("conv").alias("_c"), "_len")
    ends = ends_digest(rows.join(lengths, (rows["conv"] == lengths["_c"]) & (rows["depth"] == lengths["_len"])).select(*NAME, "conv"))
    parents = nodes.select((F.col("depth") + 1).alias("_pd"), F.col("n1").alias("_p1"), F.col("n2").alias("_p2"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(below, _matches(nodes, below, NAME, ["_sd", "_s1", "_s2"]), "left")
    out = out.join(ends, _matches(nodes, ends, NAME, ["_ed", "_e1", "_e2"]), "left")
    out = out.join(parents, _matches(nodes, parents, ["depth", "p1", "p2"], ["_pd", "_p1", "_p2"]), "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        (F.col("leaf") + F.coalesce("_leaf", zero)).alias("n_leaves"), (F.col("saved") + F.coalesce("_saved", zero)).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def conversation_trie(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", rebuild: bool = True) -> DataFrame:
    """The prefix trie of the conversations in ``turns``, rebuilt by the query's rule unless ``rebuild`` is off: see :func:`trie`.

    Rows with a null key take no part; null turns come first; null roles and
    texts are empty; equal turns of a conversation follow their role and text by
    digest; repeated rows are turns of their own; texts and conversations of any
    length are taken whole; other columns take no part, whatever their names; an
    empty table gives no rows.
    """
    ranked = written(ranked_turns(turns, key, turn, role, text), "turns-ranked")
    if rebuild:
        return trie(*rebuilt(ranked))
    return trie(ranked, ranked.select("conv").distinct())
