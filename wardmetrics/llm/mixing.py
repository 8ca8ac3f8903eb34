"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardmetrics.llm.texts import per_block, word_spans
from wardmetrics.session import written

WEIGHTS = (5.0, 2.0, 1.0)
MOST_COPIES = 3
# Expected copies are whole multiples of this fraction, so prefix sums are exact.
UNIT = 1 << 40


def word_counts(df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and ``size``, the number of words of the whole text; null has none."""

    def work(block):
        return {"size": pa.array(np.diff(word_spans(block)[2]), pa.int64())}

    return per_block(df, work, "size long", keep, text)


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """One row per source (``source``, ``source_size``, ``n_docs``, ``target``).

    Sources by code point, null last, weigh ``weights`` in turn. They share the
    sum of all sizes; a target stops at ``most`` times its source's size and the
    excess goes to the others by weight. The level where that ends is found at
    once: sources ordered by cap over weight, the first ``k`` are at their caps
    and the rest share what is left. Windows here run over one row per source.
    """
    by_code = W.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    table = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    table = table.withColumn("_w", F.element_at(cycle, (F.pmod(F.row_number().over(by_code) - 1, F.lit(len(weights))) + 1).cast("int")))
    table = table.withColumn("_cap", (F.col("source_size") * most).cast("double"))
    everything = W.partitionBy()
    upward = W.orderBy((F.col("_cap") / F.col("_w")).asc(), F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    table = table.withColumns({
        "_total": F.sum("source_size").over(everything).cast("double"),
        "_weight": F.sum("_w").over(everything),
        "_capped": F.coalesce(F.sum("_cap").over(upward), F.lit(0.0)),
        "_gone": F.coalesce(F.sum("_w").over(upward), F.lit(0.0)),
    })
    level = (F.col("_total") - F.col("_capped")) / (F.col("_weight") - F.col("_gone"))
    # The first source whose cap is above the level of the rest sets the level.
    table = table.withColumn("_level", F.min(F.when(F.col("_cap") >= level * F.col("_w"), F.struct(F.col("_capped"), level.alias("at")))).over(everything)["at"])
    return table.select("source", "source_size", "n_docs", F.least(F.col("_level") * F.col("_w"), F.col("_cap")).alias("target"))


def offset_of(source: Column, seed: int) -> Column:
    """A source's random offset below ``UNIT``: the first ten hex digits of an MD5."""
    name = F.concat(F.lit(f"{seed}|"), F.coalesce(F.concat(F.lit("s"), source), F.lit("n")))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 10), 16, 10).cast("decimal(38,0)")


def mix(df: DataFrame, weights: tuple[float, ...] = WEIGHTS, seed: int = 11, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``key``, ``size``, ``source``, ``source_size``, ``target`` and ``copies`` for every row.

    Within a source each row expects target / source_size copies. In the order of
    (size, key) these are prefix-summed, one random offset per source is added,
    and a row is emitted once for each whole number its interval crosses. The
    order by size makes every stretch of sizes get its share, so taken words come
    near the target. A row gets at most ``MOST_COPIES`` copies.

    The order is a range partitioning, so a source with a third of all rows is
    split over many tasks: rows are numbered inside each part, and parts get the
    sum of the earlier parts' counts. Null texts and texts without a word have
    size 0; null sources are one source; repeated rows and ties count one by one
    and a null key sorts first; an empty table gives no rows. Runs on the same
    rows agree, however they are partitioned.
    """
    sizes = word_counts(df.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{source}`").alias("source"), F.col(f"`{text}`").alias("_body")), ["_key", "source"], "_body")
    sizes = written(sizes, "mix-sizes")
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    ranged = sizes.repartitionByRange(parts, F.col("source").asc_nulls_last(), "size", F.col("_key"))
    ranged = written(ranged.withColumn("_part", F.spark_partition_id()), "mix-ranges")
    counts = ranged.groupBy("_part", "source").agg(F.count(F.lit(1)).alias("_n"))
    earlier = W.partitionBy("source").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("_part", F.col("source").alias("_of"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    targets = source_targets(sizes, weights).withColumnRenamed("source", "_of")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    bounds = starts.join(targets, starts["_of"].eqNullSafe(targets["_of"])).select(
        "_part", starts["_of"], "_before", "source_size", "target",
        F.least(F.floor(rate * UNIT), F.lit(MOST_COPIES * UNIT)).cast("decimal(20,0)").alias("_rate"),
        offset_of(starts["_of"], seed).alias("_offset"),
    )
    inside = F.row_number().over(W.partitionBy("_part", "source").orderBy("size", "_key"))
    ranked = ranged.withColumn("_row", inside)
    joined = ranked.join(bounds, (ranked["_part"] == bounds["_part"]) & ranked["source"].eqNullSafe(bounds["_of"]))
    place = (F.col("_row") + F.col("_before")).cast("decimal(17,0)")
    placed = joined.select(
        F.col("_key").alias(key), "size", ranked["source"], "source_size", "target",
        (place * F.col("_rate") + F.col("_offset")).alias("_upto"), "_rate",
    )
    copies = F.expr(f"int((_upto div {UNIT}BD) - ((_upto - _rate) div {UNIT}BD))")
    return placed.select(key, "size", "source", "source_size", "target", copies.alias("copies"))
