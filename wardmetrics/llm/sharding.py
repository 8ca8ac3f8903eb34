"""Placement of rows on shards through a permutation-filled lookup table."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmetrics.llm.texts import free_prefix

SHARDS = 64
SLOTS = 6553  # prime, about a hundred slots for each shard


def key_number(key: Column) -> Column:
    """The first 15 hex digits of the key's MD5 as a number; a null key counts as empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def lookup_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """For each slot the index of its shard.

    Shard ``s`` prefers the slots offset, offset + skip, ... modulo the prime
    ``slots``. Shards take turns, each claiming its next preferred slot that is
    still free, until all slots are taken; so no shard holds over one slot more
    than another, and a lost shard moves few keys of the others.
    """
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards need distinct names")
    if slots < len(shards) or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("slots must be a prime of at least the number of shards")
    place = [_number(f"{s}|offset") % slots for s in shards]
    skip = [_number(f"{s}|skip") % (slots - 1) + 1 for s in shards]
    table, free = [-1] * slots, slots
    while True:
        for i in range(len(shards)):
            while table[place[i]] >= 0:
                place[i] = (place[i] + skip[i]) % slots
            table[place[i]] = i
            free -= 1
            if not free:
                return table


def assign_shards(df: DataFrame, key: str = "doc_id", shards: int | list[str] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """``df`` with ``slot`` and ``shard``; columns of these names are replaced.

    The table has ``slots`` entries whatever the input, so it is broadcast. Rows
    of equal keys (copies, ties, repeated rows) share a shard; a null key is
    placed as empty text; an empty table gives no rows.
    """
    names = [f"shard-{i:05d}" for i in range(shards)] if isinstance(shards, int) else list(shards)
    table = lookup_table(names, slots)
    placed = df.drop("slot", "shard").withColumn("slot", F.pmod(key_number(F.col(f"`{key}`")), F.lit(slots)))
    own = free_prefix(placed) + "slot"
    rows = df.sparkSession.createDataFrame([(slot, names[i]) for slot, i in enumerate(table)], f"{own} long, shard string")
    return placed.join(F.broadcast(rows), F.col("slot") == F.col(own), "left").drop(own)
