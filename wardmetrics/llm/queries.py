"""One query for each operator, with production parameters over its whole table, and its SQL where there is one."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmetrics.llm import language, mixing, outliers, pieces, prefix_trie, quality_net, secret_scan, sharding, simhash, spelling, suffixes, topk, warc
from wardmetrics.llm.texts import remainder

PIECE_MODEL = "piece_bpe_32k.model"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def piece_model_path() -> str:
    """The vocabulary file of the installed public tokenizers; ``PIECE_MODEL_PATH`` names another."""
    if "PIECE_MODEL_PATH" in os.environ:
        return os.environ["PIECE_MODEL_PATH"]
    import public_tokenizers

    return public_tokenizers.path(PIECE_MODEL)


def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = secret_scan.scan_secrets(docs, secret_scan.fit_secrets(docs))
    base = F.sha2(secret_scan.joined(F.col("base")).cast("binary"), 256)
    return found.select("doc_id", "n_assign", "n_access", "n_hex", base.alias("base_sha256"), secret_scan.joined(F.col("spans")).alias("spans"))


def op2_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encode_texts(table(spark, folder, "documents"), pieces.model_bytes(piece_model_path()), ["doc_id"], digests=True)


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = quality_net.fit_quality(docs, labels.filter(remainder(F.col("doc_id"), 5) != 0))
    scored = quality_net.score_quality(docs, model, ["doc_id"])
    return scored.select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_inner_products(table(spark, folder, "embeddings"), lambda key: key % 50 == 0)


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return outliers.judge_texts(table(spark, folder, "documents"), ["doc_id"])


def op6_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign_shards(table(spark, folder, "documents").select("doc_id"))


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language.fit_languages(docs.filter(remainder(F.col("doc_id"), 4) != 2))
    predicted = language.predict_languages(docs, model, ["doc_id"])
    return predicted.select("doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, folder, "documents"), digests=True)


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, folder, "conversations"))


def op12_warc(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.archived(table(spark, folder, "pages"))
    return found.select(F.col("key").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


def op13_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


MIX_SQL = r"""WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
weighed AS (
    SELECT source, sum(size)::DOUBLE AS source_size, 3 * sum(size)::DOUBLE AS cap,
           [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w
    FROM sized GROUP BY source),
ranked AS (
    SELECT *, sum(source_size) OVER () AS total, sum(w) OVER () AS all_w,
           coalesce(sum(cap) OVER upward, 0) AS capped, coalesce(sum(w) OVER upward, 0) AS gone
    FROM weighed
    WINDOW upward AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levelled AS (
    SELECT (total - capped) / (all_w - gone) AS level FROM ranked
    WHERE cap >= (total - capped) / (all_w - gone) * w ORDER BY capped, level LIMIT 1),
targets AS (
    SELECT source, source_size, least(level * w, cap) AS target,
           CASE WHEN source_size > 0 THEN least(floor(least(level * w, cap) / source_size * 1099511627776), 3 * 1099511627776) ELSE 0 END::HUGEINT AS rate,
           ('0x' || substr(md5('11|' || coalesce('s' || source, 'n')), 1, 10))::BIGINT::HUGEINT AS shift
    FROM ranked, levelled),
placed AS (
    SELECT doc_id, source, size, (row_number() OVER (PARTITION BY source ORDER BY size, doc_id NULLS FIRST))::HUGEINT AS n FROM sized)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
       (size * ((n * rate + shift) // 1099511627776 - ((n - 1) * rate + shift) // 1099511627776))::BIGINT AS taken
FROM placed JOIN targets ON placed.source IS NOT DISTINCT FROM targets.source"""

SHARD_SQL = """WITH RECURSIVE names AS (
    SELECT i, 'shard-' || lpad(i::VARCHAR, 5, '0') AS name FROM range(64) t(i)),
prefs AS (
    SELECT list(('0x' || substr(md5(name || '|offset'), 1, 15))::BIGINT % 6553 ORDER BY i) AS starts,
           list(('0x' || substr(md5(name || '|skip'), 1, 15))::BIGINT % 6552 + 1 ORDER BY i) AS skips FROM names),
turns AS (
    SELECT 0::BIGINT AS n, list_transform(range(6553), lambda x: NULL::BIGINT) AS slots
    UNION ALL
    SELECT n + 1, slots[:free] || [n % 64] || slots[free + 2:]
    FROM (SELECT n, slots, list_filter(list_transform(range(6553), lambda j: (starts[n % 64 + 1] + j * skips[n % 64 + 1]) % 6553),
                                       lambda p: slots[p + 1] IS NULL)[1] AS free
          FROM turns, prefs WHERE n < 6553)),
filled AS (SELECT unnest(range(6553)) AS slot, unnest(slots) AS i FROM turns WHERE n = 6553),
placed AS (
    SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % 6553 AS slot FROM documents)
SELECT doc_id, placed.slot, name AS shard FROM placed JOIN filled USING (slot) JOIN names USING (i)"""

QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_quality": op3_quality,
    "op4_topk": op4_topk,
    "op5_quality_rules": op5_quality_rules,
    "op6_sharding": op6_sharding,
    "op7_language": op7_language,
    "op8_mixing": op8_mixing,
    "op9_simhash": op9_simhash,
    "op10_repeats": op10_repeats,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_warc": op12_warc,
    "op13_spelling": op13_spelling,
}
TOPK_SQL = """WITH grown AS MATERIALIZED (
    SELECT vec_id, row_number() OVER () AS place, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, q.place AS own, c.vec_id AS vec_id, list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
    FROM grown q JOIN grown c ON q.place <> c.place WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY own ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""

# The remainders of the CRC-32 polynomial by byte, and the checksum of the bytes ``b`` from them.
CRC_TABLE = """polynomial AS (
    SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) ORDER BY i) AS t
    FROM range(256) r(i))"""
CRC = "xor(list_reduce([4294967295::BIGINT] || b, lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)), 4294967295)"

TRIE_SQL = f"""WITH {CRC_TABLE},
turns AS (
    SELECT conv_id AS c, coalesce(text, '') AS txt, sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS s, turn
    FROM conversations WHERE conv_id IS NOT NULL),
ranked AS (SELECT c, s, length(txt) AS chars, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, s) AS p FROM turns),
ids AS (
    SELECT c, {CRC} % 6 AS h
    FROM (SELECT DISTINCT c, list_transform(string_split(c::VARCHAR, ''), lambda x: ord(x)::BIGINT) AS b FROM turns), polynomial),
parts AS (
    SELECT ids.c, 0 AS half, p, s, chars FROM ids JOIN ranked ON ranked.c = ids.c - ids.c % 100 AND p <= h
    UNION ALL SELECT ids.c, 1, p, s, chars FROM ids JOIN ranked ON ranked.c = ids.c AND p > h),
built AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY half, p) AS d, s, chars FROM parts),
prefixes AS (
    SELECT c, d, chars, string_agg(s, '') OVER (PARTITION BY c ORDER BY d) AS k FROM built
    UNION ALL SELECT c, 0, 0, '' FROM ids),
nodes AS (SELECT d, k, min(c) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars FROM prefixes GROUP BY d, k),
children AS (SELECT d - 1 AS d, left(k, length(k) - 64) AS k, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
counted AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (d, k)),
totals AS (
    SELECT prefixes.d, prefixes.k, sum((n_children = 0)::INT)::BIGINT AS n_leaves, sum((n_convs - 1) * counted.chars)::BIGINT AS saved_tokens
    FROM counted JOIN prefixes ON prefixes.c = counted.conv_id AND prefixes.d <= counted.d GROUP BY ALL),
lengths AS (SELECT c, max(d) AS d FROM prefixes GROUP BY c),
ends AS (
    SELECT d, k, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends_sha256 FROM prefixes JOIN lengths USING (c, d) GROUP BY d, k)
SELECT n.conv_id, n.d AS depth, up.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves, saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM counted n JOIN totals USING (d, k) LEFT JOIN ends USING (d, k)
LEFT JOIN nodes up ON up.d = n.d - 1 AND up.k = left(n.k, greatest(length(n.k) - 64, 0))"""

WARC_SQL = """WITH paid AS (SELECT page_id, coalesce(html, '') AS p FROM pages),
ranked AS (
    SELECT page_id, p, strlen(p) AS payload_bytes, row_number() OVER same AS r, first_value(page_id) OVER same AS top
    FROM paid WINDOW same AS (PARTITION BY p ORDER BY page_id DESC NULLS LAST))
SELECT page_id, payload_bytes, sha1(p) AS payload_digest, CASE WHEN payload_bytes >= 1000 AND r > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND r > 1 THEN top END AS refers_to
FROM ranked"""

SPELLING_SQL = f"""WITH RECURSIVE {CRC_TABLE},
runs AS (
    SELECT key, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS m
    FROM (SELECT coalesce(doc_id::VARCHAR, '') AS key, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL),
hashed AS (
    SELECT w, m, {CRC} AS h
    FROM (SELECT w, m, flatten(list_transform(string_split(key || ':' || w, ''), lambda x: CASE WHEN ord(x) >= 192 THEN [195::BIGINT, ord(x)::BIGINT - 64] ELSE [ord(x)::BIGINT] END)) AS b
          FROM runs WHERE length(w) >= 5), polynomial),
words AS (
    SELECT CASE WHEN h % 97 = 0 THEN left(w, (h % length(w))::INT) || substr(w, (h % length(w))::INT + 2) ELSE w END AS word, sum(m)::BIGINT AS n
    FROM hashed GROUP BY 1 HAVING length(word) >= 5 AND n >= 3),
shorter AS (SELECT word, p, left(word, p::INT - 1) || substr(word, p::INT + 1) AS v FROM (SELECT word, unnest(range(1, length(word) + 1)) AS p FROM words)),
pairs AS (
    SELECT a.word AS a, b.word AS b FROM shorter a JOIN shorter b ON a.p = b.p AND a.v = b.v AND a.word <> b.word
    UNION SELECT s.word, w.word FROM shorter s JOIN words w ON s.v = w.word
    UNION SELECT w.word, s.word FROM shorter s JOIN words w ON s.v = w.word),
near AS (SELECT a AS word, count(*) AS n_near, min((-n, b)) AS best FROM pairs JOIN words ON b = word GROUP BY a),
formed AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best[1] >= 2 * n THEN best[2] END AS form, CASE WHEN -best[1] >= 2 * n THEN -best[1] END AS form_n
    FROM words LEFT JOIN near USING (word)),
steps AS (
    SELECT word, word AS at FROM formed
    UNION ALL SELECT steps.word, formed.form FROM steps JOIN formed ON steps.at = formed.word WHERE formed.form IS NOT NULL)
SELECT f.word, f.form, g.word AS root, f.n, f.n_near, f.form_n FROM formed f JOIN steps ON f.word = steps.word JOIN formed g ON steps.at = g.word AND g.form IS NULL"""

SQL = {"op4_topk": TOPK_SQL, "op6_sharding": SHARD_SQL, "op8_mixing": MIX_SQL, "op11_prefix_trie": TRIE_SQL, "op12_warc": WARC_SQL, "op13_spelling": SPELLING_SQL}
