"""A training corpus in five stages, from ``documents``: what is poor, copied or secret goes, sources are mixed, texts encoded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmetrics.llm import mixing, pieces, quality_net, secret_scan, simhash
from wardmetrics.llm.queries import PIECE_MODEL, piece_model_path, table
from wardmetrics.llm.texts import placed, remainder
from wardmetrics.session import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LEAST_SCORE = 0.3


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier scores at ``LEAST_SCORE`` or more.

    A null text counts as empty and gets the network's answer to that; texts of any length are scored whole; equal texts
    share a verdict and repeated rows stay or go together; a null key is scored but never learned from; without labels
    of both kinds every row gets one score. An empty table stays empty. Other columns take no part, whatever their names.
    """
    labels = table(spark, sf_dir, "labels").filter(remainder(F.col("doc_id"), 5) != 0)
    model = quality_net.fit_quality(docs, labels)
    return quality_net.score_quality(docs, model, COLUMNS).filter(F.col("score") >= LEAST_SCORE).select(*COLUMNS)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one row stays: that of the smallest key, rows without a key last.

    Null texts, empty ones and texts without a word are near-duplicates of each other; texts of any length count whole;
    of rows with one key, repeated rows included, the first by place stays. An empty table stays empty; other columns
    take no part.
    """
    rows = placed(docs.select(*COLUMNS))
    found = simhash.near_duplicates(rows, "_row").filter(F.col("_row.place") == F.col("component_id.place"))
    first = found.select(F.col("_row.place").alias("_place"))
    return rows.join(first.hint("shuffle_hash"), rows["_row.place"] == first["_place"], "left_semi").select(*COLUMNS)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with a placeholder for each secret; ``n_chars`` follows.

    A null text stays null and an empty one empty, as nothing is found there; texts of any length are scanned whole,
    their matches in blocks; overlapping secrets share a placeholder; equal texts and repeated rows are changed alike.
    A row without a secret is as it was. An empty table stays empty; other columns take no part.
    """
    found = secret_scan.scan_secrets(docs, secret_scan.fit_secrets(docs))
    clean = found.withColumn("text", secret_scan.redacted(F.col("text"), F.col("spans")))
    return clean.withColumn("n_chars", F.when(F.size("spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as many times as the mix of sources takes it.

    A null text and one without a word have size 0; null sources are one source; rows of one size are ordered by key,
    null first, and repeated rows count one by one; texts of any length count whole. Copies are equal rows. An empty
    table stays empty; other columns take no part.
    """
    rows = placed(docs.select(*COLUMNS))
    taken = mixing.mix(rows, key="_row").filter("copies > 0").select(F.col("_row.place").alias("_place"), "copies")
    joined = rows.join(taken.hint("shuffle_hash"), rows["_row.place"] == taken["_place"])
    return joined.select(*COLUMNS, F.explode(F.sequence(F.lit(1), "copies")).alias("_copy")).select(*COLUMNS)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``source`` and the encoded text of each row: ids, spans in bytes, and the text they decode to.

    A null text is encoded as an empty one; texts of any length are encoded whole; repeated rows give equal rows, a null
    key stays null; an empty table gives no rows; other columns are left out.
    """
    return pieces.encode_texts(docs, pieces.model_bytes(piece_model_path()), ["doc_id", "source"])


STAGES = [
    ("quality classifier", quality_stage),
    ("SimHash near-dedup", simhash_stage),
    ("secret scans", secret_stage),
    ("mixing sources to target weights", mixing_stage),
    ("SentencePiece encoding", encoding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)


# SQL has neither the trained network nor the 64-bit hash of the fingerprints; tests hold the stages against brute force.
ORACLE_SQL = None
