"""Records of text files that are read in byte ranges, where a range may begin inside a quoted cell or a nested value.

A range is scanned once under every state it may begin in. The outcomes are
composed over a file's ranges in order, so each range learns its true state, and
a second scan cuts out the records, which are written where they are cut. Lines
and whole records are never shuffled; only the ends of ranges are, to be put together.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardmetrics.session import written

# Task functions travel with their code: workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_BATCH_ROWS, _BATCH_BYTES = 8192, 4 << 20

_FACTS = "_file long, _range long, _bytes long, e0 int, e1 int, n0 long, n1 long, d0 long, d1 long, low0 long, low1 long, at0 array<long>, at1 array<long>"
_CUT = "_file long, _row long, _range long, whole boolean, value binary"


# ---- what a range does to the state -------------------------------------------------------------

_IN_CELL = re.compile(rb'[^"]*+(?:""[^"]*+)*+')


def quoted_after(line: bytes, quoted: bool) -> bool:
    """Whether a quoted cell is open behind ``line``. A quote opens a cell only where the cell begins; doubled ones stay inside."""
    at = 0
    if not quoted:
        at = 0 if line.startswith(b'"') else line.find(b',"') + 1
        if not at and not line.startswith(b'"'):
            return False
        at += 1
    while True:
        at = _IN_CELL.match(line, at).end()
        if at == len(line):
            return True
        at = line.find(b',"', at + 1)
        if at < 0:
            return False
        at += 2


def _blank(lines: pa.Array) -> np.ndarray:
    """Which lines hold nothing, or the carriage return of an ending."""
    return (_sizes(lines) == 0) | pc.equal(lines, pa.scalar(b"\r", lines.type)).to_numpy(zero_copy_only=False)


def _sizes(pieces: pa.Array) -> np.ndarray:
    return pc.binary_length(pieces).to_numpy(zero_copy_only=False).astype(np.int64)


def _quoted_lines(lines: pa.Array) -> tuple[np.ndarray, list[bytes]]:
    """Places and texts of the lines with a quote: no other line changes the state."""
    places = pc.indices_nonzero(pc.match_substring(lines, b'"'))
    return places.to_numpy(zero_copy_only=False).astype(np.int64), lines.take(places).to_pylist()


def _open_before(n: int, places: np.ndarray, after: list[bool], state: bool) -> np.ndarray:
    """Whether a quoted cell is open before each of ``n`` lines, from the states behind the lines with a quote."""
    edges = np.concatenate(([-1], places, [n - 1]))
    return np.repeat(np.array([state, *after], bool), np.diff(edges))


def _states_after(texts: list[bytes], state: bool) -> list[bool]:
    after = []
    for text in texts:
        state = quoted_after(text, state)
        after.append(state)
    return after


class CellRecords:
    """Records of a delimited file: the state is whether a quoted cell is open; pieces are lines."""

    separator = "\n"

    class Facts:
        """Outcome of a range begun outside (0) and inside (1) a quoted cell: the state behind it and the records begun."""

        def __init__(self):
            self.bytes, self.ends, self.begun = 0, [False, True], [0, 0]

        def take(self, lines: pa.Array) -> None:
            self.bytes += int(_sizes(lines).sum()) + len(lines)
            places, texts = _quoted_lines(lines)
            filled = ~_blank(lines)
            # Once both outcomes agree they stay the same.
            same = self.ends[0] == self.ends[1]
            for h in (0,) if same else (0, 1):
                after = _states_after(texts, self.ends[h])
                begun = int(np.count_nonzero(filled & ~_open_before(len(lines), places, after, self.ends[h])))
                self.ends[h] = after[-1] if after else self.ends[h]
                self.begun[h] += begun
            if same:
                self.ends[1] = self.ends[0]
                self.begun[1] += begun

        def row(self) -> tuple:
            return (self.bytes, *map(int, self.ends), *self.begun, 0, 0, 0, 0, [], [])

    @staticmethod
    def cut(pieces: Iterator[pa.Array], state: int, depth: int, first: int) -> Iterator[tuple]:
        """(rows, whole, texts) of the records of one range, some at a time; ``first`` records were begun in the file before it."""
        quoted, row, held, whole = bool(state), first - 1, [], False
        for lines in pieces:
            places, texts = _quoted_lines(lines)
            after = _states_after(texts, quoted)
            inside = _open_before(len(lines), places, after, quoted)
            quoted = after[-1] if after else quoted
            keep = inside | ~_blank(lines)
            lines, begins = lines.filter(pa.array(keep)), np.flatnonzero(~inside[keep])
            # Lines before the first that begins a record belong to the one left open; the last one stays open if its cell is.
            head = int(begins[0]) if len(begins) else len(lines)
            if head:
                held.append(lines.slice(0, head))
            if held and (len(begins) or not quoted):
                yield [row], [whole], _joined(pa.concat_arrays(held), [0])
                held = []
            closed = begins[:-1] if quoted else begins
            if len(closed):
                last = int(begins[-1]) if quoted else len(lines)
                yield range(row + 1, row + 1 + len(closed)), [True] * len(closed), _joined(lines.slice(head, last - head), closed - head)
            row += len(begins)
            if len(begins) and quoted:
                held, whole = [lines.slice(int(begins[-1]))], True
        if held:
            yield [row], [False], _joined(pa.concat_arrays(held), [0])


def _joined(lines: pa.Array, begins: Sequence[int]) -> pa.Array:
    """The records that begin at these lines, the first at line 0, with the breaks between their lines."""
    edges = pa.array(np.append(np.asarray(begins, np.int32), np.int32(len(lines))))
    return pc.binary_join(pa.ListArray.from_arrays(edges, lines), pa.scalar(b"\n", lines.type))


_STRING = re.compile(rb'[^"\\]*+(?:\\.[^"\\]*+)*+', re.DOTALL)


def nested_after(piece: bytes, inside: bool) -> tuple[bool, int]:
    """Whether a string is open behind ``piece`` and its closing brace, and the change of the depth of brackets."""
    at, change = 0, 0
    while True:
        if inside:
            at = _STRING.match(piece, at).end()
            if at >= len(piece) or piece[at : at + 1] != b'"':
                return True, change
            at += 1
            inside = False
        quote = piece.find(b'"', at)
        stop = len(piece) if quote < 0 else quote
        change += piece.count(b"{", at, stop) + piece.count(b"[", at, stop) - piece.count(b"]", at, stop)
        if quote < 0:
            return False, change - 1
        at, inside = quote + 1, True


class ArrayRecords:
    """Objects of JSON array files: the state is string and depth; pieces end with a closing brace.

    Under either string state the depth is known but for where it began, so a
    range counts its braces by relative depth, at the three lowest levels: in an
    array file no brace closes below the objects but one read behind the end.
    """

    separator = "}"

    class Facts:
        def __init__(self):
            self.bytes, self.ends = 0, [False, True]
            self.depth, self.low, self.at = [0, 0], [1 << 40, 1 << 40], [[0, 0, 0], [0, 0, 0]]

        def take(self, pieces: pa.Array) -> None:
            for value in pieces.to_pylist():
                self.bytes += len(value) + 1
                for h in (0, 1):
                    self.ends[h], change = nested_after(value, self.ends[h])
                    self.depth[h] += change
                    if self.ends[h]:
                        continue
                    down = self.low[h] - self.depth[h]
                    if down > 0:
                        self.at[h] = ([0] * min(down, 3) + self.at[h])[:3]
                        self.low[h] = self.depth[h]
                    if self.depth[h] - self.low[h] < 3:
                        self.at[h][self.depth[h] - self.low[h]] += 1

        def row(self) -> tuple:
            return (self.bytes, *map(int, self.ends), 0, 0, *self.depth, *self.low, *self.at)

    @staticmethod
    def cut(pieces: Iterator[pa.Array], state: int, depth: int, first: int) -> Iterator[tuple]:
        """As for cells; what follows a range's last record begins the next one, or ends the file."""
        inside, row, held, whole = bool(state), first, [], depth == 1 and not state and first > 0
        rows, wholes, texts, size = [], [], [], 0
        for piece in (p for some in pieces for p in some.to_pylist()):
            held.append(piece + b"}")
            inside, change = nested_after(piece, inside)
            depth += change
            if depth == 1 and not inside:
                rows.append(row)
                wholes.append(whole)
                texts.append(b"".join(held))
                size += len(texts[-1])
                row, held, whole = row + 1, [], True
                if len(rows) >= _BATCH_ROWS or size >= _BATCH_BYTES:
                    yield rows, wholes, pa.array(texts, pa.binary())
                    rows, wholes, texts, size = [], [], [], 0
        if held:
            rows, wholes, texts = [*rows, row], [*wholes, False], [*texts, b"".join(held)]
        if rows:
            yield rows, wholes, pa.array(texts, pa.binary())


# ---- ranges, their states, their records ---------------------------------------------------------


def _pieces(spark: SparkSession, paths: Sequence[str], separator: str) -> DataFrame:
    text = spark.read.option("lineSep", separator).text(list(paths))
    return text.select(
        F.xxhash64("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_range"),
        F.monotonically_increasing_id().alias("_scan"), F.col("value").cast("binary").alias("value"),
    )


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """The batch cut where the file or the range changes."""
    if not batch.num_rows:
        return
    files, ranges = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    edges = [0, *(np.flatnonzero((files[1:] != files[:-1]) | (ranges[1:] != ranges[:-1])) + 1).tolist(), batch.num_rows]
    for first, last in zip(edges[:-1], edges[1:]):
        yield (int(files[first]), int(ranges[first])), batch.slice(first, last - first)


def _facts(pieces: DataFrame, kind: type) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, facts, out = None, None, []
        names = [c.split()[0] for c in _FACTS.split(", ")]
        types = [pa.int64()] * 3 + [pa.int32()] * 2 + [pa.int64()] * 6 + [pa.list_(pa.int64())] * 2
        for batch in batches:
            for place, some in _runs(batch):
                if place != now:
                    if facts:
                        out.append((*now, *facts.row()))
                    now, facts = place, kind.Facts()
                facts.take(some.column(2))
        if facts:
            out.append((*now, *facts.row()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    return pieces.select("_file", "_range", "value").mapInArrow(run, _FACTS)


def range_states(facts: DataFrame) -> DataFrame:
    """``_file``, ``_range``, ``_state``, ``_depth``, ``_first`` (records before the range) and the range's ``_bytes``.

    What a range does to a two-valued state is to keep, swap or set it. So the
    state before a range is the last one set, swapped as often as later ranges
    swap. Windows run over the ranges of one file, never over its rows.
    """
    order = Window.partitionBy("_file").orderBy("_range")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    is_set = F.col("e0") == F.col("e1")
    swaps = facts.withColumn("_swaps", F.sum(((F.col("e0") == 1) & (F.col("e1") == 0)).cast("int")).over(order))
    known = swaps.withColumns({
        "_value": F.coalesce(F.last(F.when(is_set, F.col("e0")), ignorenulls=True).over(earlier), F.lit(0)),
        "_then": F.coalesce(F.last(F.when(is_set, F.col("_swaps")), ignorenulls=True).over(earlier), F.lit(0)),
        "_now": F.coalesce(F.lag("_swaps").over(order), F.lit(0)),
    }).withColumn("_state", ((F.col("_value") + F.col("_now") - F.col("_then")) % 2).cast("int"))

    def own(name: str):
        return F.when(F.col("_state") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))

    deep = known.withColumns({"_n": own("n"), "_low": own("low"), "_at": own("at"), "_depth": F.coalesce(F.sum(own("d")).over(earlier), F.lit(0))})
    level = 1 - F.col("_depth") - F.col("_low")
    closed = F.when((F.size("_at") > 0) & level.between(0, 2), F.get("_at", level.cast("int")))
    counted = deep.withColumn("_n", F.when(F.size("_at") > 0, F.coalesce(closed, F.lit(0))).otherwise(F.col("_n")))
    return counted.select("_file", "_range", "_bytes", "_state", "_depth", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_first"))


def _cut(pieces: DataFrame, states: DataFrame, kind: type) -> DataFrame:
    """Records and ends of ranges: ``whole`` are those that lie in one range.

    The states, one row for each split of the files, are broadcast to the scan: its lines stay where and as they are read.
    """
    own = states.select(F.col("_file").alias("_f"), F.col("_range").alias("_r"), "_state", "_depth", "_first")
    told = F.raise_error(F.lit("the ranges of a file changed between two scans; run the job again")).cast("int")
    joined = pieces.join(F.broadcast(own), (pieces["_file"] == own["_f"]) & (pieces["_range"] == own["_r"]), "left").select(
        "_file", "_range", "_scan", "value", F.coalesce("_state", told).alias("_state"), "_depth", "_first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            last = -1
            for batch in batches:
                scan = batch.column(2).to_numpy(zero_copy_only=False)
                if len(scan) and (scan[0] <= last or (np.diff(scan) <= 0).any()):
                    raise ValueError("the lines of a file are out of order")
                last = scan[-1] if len(scan) else last
                yield from _runs(batch)

        runs = rows()
        ahead = next(runs, None)
        while ahead:
            place, some = ahead
            start = [some.column(i)[0].as_py() for i in (4, 5, 6)]

            def values():
                nonlocal ahead
                while ahead and ahead[0] == place:
                    yield ahead[1].column(3)
                    ahead = next(runs, None)

            for numbers, whole, texts in kind.cut(values(), *start):
                n = len(texts)
                columns = [pa.array([place[0]] * n, pa.int64()), pa.array(numbers, pa.int64()), pa.array([place[1]] * n, pa.int64()), pa.array(whole, pa.bool_()), texts]
                yield pa.RecordBatch.from_arrays(columns, names=["_file", "_row", "_range", "whole", "value"])

    return joined.mapInArrow(run, _CUT)


def range_records(spark: SparkSession, paths: Sequence[str], kind: type) -> DataFrame:
    """``_source_path``, ``_row`` (from 0 in its file), ``value`` (text) of each record, and of its file ``_read`` and ``_size`` in bytes.

    ``kind`` is :class:`CellRecords` or :class:`ArrayRecords`. Files are read in
    as many tasks as they have splits, once for their states and once for the
    records; both run here and are written to the shared folder. A file without
    a byte has no row.
    """
    pieces = _pieces(spark, paths, kind.separator)
    states = written(range_states(_facts(pieces, kind)), "range-states")
    cut = written(_cut(pieces, states, kind).select("_file", "_row", "_range", "whole", F.col("value").cast("string").alias("value")), "range-records")
    link = "\n" if kind is CellRecords else ""
    ends = cut.filter(~F.col("whole")).groupBy("_file", "_row").agg(F.array_sort(F.collect_list(F.struct("_range", F.col("value").alias("v")))).alias("_parts"))
    mended = ends.select("_file", "_row", F.array_join(F.transform("_parts", lambda p: p.v), link).alias("value"))
    records = cut.filter("whole").select("_file", "_row", "value").unionByName(mended)
    listed = spark.read.format("binaryFile").load(list(paths)).select(F.col("_metadata.file_path").alias("_source_path"), F.col("_metadata.file_size").alias("_size"))
    read = states.groupBy(F.col("_file").alias("_f")).agg(F.sum("_bytes").alias("_read"))
    # Written, a row a file: its true size, not that of the files, tells whether it is broadcast.
    files = written(listed.join(read, F.xxhash64("_source_path") == F.col("_f")), "range-files")
    return records.join(files, F.col("_file") == F.col("_f")).select("_source_path", "_row", "value", "_read", "_size")
