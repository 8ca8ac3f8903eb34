"""Shared helpers: whole texts as byte blocks inside Arrow tasks, and stable keys."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardmetrics.session import written

# Texts are worked on in blocks of about this many bytes; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20

# Rows travel to Python in batches of about this many bytes, or of one row: a batch is held several times over, by the
# JVM and by the worker, and the session's limit of 10,000 rows says nothing of the length of texts.
ARROW_BYTES = "4m"

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


@dataclass
class Block:
    """Some whole rows of a batch: their bytes end to end, and where each text begins."""

    rows: pa.RecordBatch
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.offsets)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and 64-bit offsets of a string array; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, places, values = column.buffers()
    offsets = np.frombuffer(places, np.int64 if wide else np.int32, len(column) + column.offset + 1) if places else np.zeros(1, np.int32)
    offsets = offsets[column.offset :].astype(np.int64)
    data = np.frombuffer(values, np.uint8)[offsets[0] : offsets[-1]] if values and offsets[-1] > offsets[0] else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut batches into blocks of at most ``size`` bytes of text, or of one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = utf8(batch.column(batch.schema.get_field_index(column)))
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
            yield Block(batch.slice(first, last - first), data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
            first = last


def word_spans(block: Block, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the index of the first word of each row (one more entry than rows)."""
    if not len(block.data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(block) + 1, np.int64)
    inside = ~space[block.data]
    before = np.concatenate(([False], inside[:-1]))
    after = np.concatenate((inside[1:], [False]))
    full = block.sizes > 0
    before[block.offsets[:-1][full]] = False
    after[block.offsets[1:][full] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, block.offsets)


def added(rows: pa.RecordBatch, keep: list[str], **columns) -> pa.RecordBatch:
    """The kept columns of ``rows`` with new ones behind them."""
    names = [*keep, *columns]
    arrays = [rows.column(rows.schema.get_field_index(k)) for k in keep]
    return pa.RecordBatch.from_arrays([*arrays, *(c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values())], names=names)


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session sends rows to Python in batches of ``ARROW_BYTES``, or of fewer where it already does."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if _bytes(conf.get(name)) > _bytes(ARROW_BYTES):
        conf.set(name, ARROW_BYTES)
    return df


def _bytes(size: str) -> int:
    """A size as Spark writes it: a number and perhaps a unit."""
    number, unit = re.fullmatch(r"(-?\d+)([kmgtp]?)b?", size.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def per_block(df: DataFrame, work: Callable[[Block], dict], schema: str, keep: list[str], column: str = "text") -> DataFrame:
    """``keep`` columns plus what ``work`` returns for each block of texts; ``schema`` lists the new columns.

    Any other column of ``df`` is left behind before the rows reach Python.
    """
    new = T.StructType.fromDDL(schema)
    source = df.select(*[F.col(f"`{k}`") for k in keep], F.col(column).alias("_text"))
    out = T.StructType([*[source.schema[k] for k in keep], *new.fields])

    def run(batches):
        for block in blocks(batches, "_text"):
            yield added(block.rows, keep, **work(block))

    return in_small_batches(source).mapInArrow(run, out)


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``; a null key counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def free_prefix(df: DataFrame) -> str:
    """A prefix that no column of ``df`` begins with, for helper columns beside them."""
    prefix = "_"
    while any(c.startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


def smallest_ids(df: DataFrame, rows: int, key: str = "doc_id", seed: int = 7) -> DataFrame:
    """At most ``rows`` rows with the smallest hashes of a non-null key: a bounded sample, the same on every run."""
    return df.filter(F.col(key).isNotNull()).orderBy(F.xxhash64(F.col(key), F.lit(seed)), F.col(key)).limit(rows)


def placed(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """``df`` with ``_row``: a key of each single row that sorts by ``key``, null last.

    ``_row.place`` follows from the row's file split, and splits follow from the cores registered when a scan is
    planned. So the rows are written with their places, and all who read the result see the same ones.
    """
    own = F.col(f"`{key}`")
    return written(df.withColumn("_row", F.struct(own.isNull().alias("none"), own.alias("key"), F.monotonically_increasing_id().alias("place"))), "placed")
