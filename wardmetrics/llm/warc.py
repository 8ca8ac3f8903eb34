"""WARC archives written by Spark's text writer and read back as a chunked record table."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmetrics.session import scratch_path, written

# A payload over this many bytes is stored as segments, and read as rows, of so many bytes.
CHUNK_BYTES = 1 << 20
# Equal payloads of at least this many bytes are stored once.
LEAST_REVISIT = 1000
# A batch of chunk rows holds about so many bytes of payload, or so many rows.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 4096

END = "\r\n"
VERSION = "WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_DATE = "2024-01-01T00:00:00Z"

CHUNKS = (
    "record_id string, chunk_no int, record_type string, key string, uri string, refers_to string, declared string, "
    "data binary, payload_bytes long, payload_digest string, last boolean"
)


def _line(name: str, value: Column | str) -> Column:
    """A header line; null, and so left out, where the value is null."""
    return F.concat(F.lit(f"{name}: "), value if isinstance(value, Column) else F.lit(value))


def _urn(*parts: Column) -> Column:
    """A name-based record identifier."""
    text = F.concat_ws("|", *[F.concat(F.length(p).cast("string"), F.lit(":"), p) for p in parts])
    h = F.md5(text.cast("binary"))
    cut = [F.substring(h, first, size) for first, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _shown(value: Column) -> Column:
    """A URI as a header value: blanks and control characters would end or split the line."""
    return F.regexp_replace(value, r"[\x00-\x20\x7F]", "%20")


def record_rows(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """One row per record to write: ``_type``, ``_id``, ``_key``, ``_url``, ``_payload`` (binary), ``_sha1``, ``_refers``.

    Of the rows with one payload of at least ``least`` bytes, the largest (key,
    url), nulls lowest, is the response and the others are revisits without a
    payload; smaller payloads are responses all. Payloads meet by SHA-256 counts,
    combined before the shuffle, so thousands of copies are one row there; only
    payloads that occur twice are joined back, and a hot one of them is a skewed
    join that adaptive execution splits. Rows equal in key, url and payload are
    one response and revisits of it.
    """
    rows = pages.select(
        F.col(f"`{key}`").alias("_k"), F.col(f"`{url}`").cast("string").alias("_u"),
        F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit("")).cast("binary").alias("_p"),
    ).withColumn("_d", F.when(F.octet_length("_p") >= least, F.sha2("_p", 256)))
    counted = rows.filter(F.col("_d").isNotNull()).groupBy("_d", "_k", "_u").agg(F.count(F.lit(1)).alias("_c"))
    top = counted.groupBy("_d").agg(F.max(F.struct("_k", "_u", "_c")).alias("_top"), F.sum("_c").alias("_all"))
    groups = written(top.filter("_all > 1").select(F.col("_d").alias("_g"), "_top"), "warc-copies")

    def identifier(k: Column, u: Column, d: Column, more: Column) -> Column:
        return _urn(*[F.coalesce(c.cast("string"), F.lit("")) for c in (k, u, d, more)])

    none = F.lit("")
    keeper = identifier(F.col("_top._k"), F.col("_top._u"), F.col("_g"), none)
    is_top = F.col("_k").eqNullSafe(F.col("_top._k")) & F.col("_u").eqNullSafe(F.col("_top._u"))
    joined = rows.join(groups, rows["_d"] == groups["_g"], "left").filter(F.col("_g").isNull() | ~is_top | (F.col("_top._c") == 1))
    copy = F.col("_g").isNotNull() & ~is_top
    # Only a kept copy is referred to, so the other identifiers need not be the same on a rerun.
    own = identifier(F.col("_k"), F.col("_u"), F.col("_d"), F.monotonically_increasing_id())
    out = joined.select(
        F.when(copy, F.lit("revisit")).otherwise(F.lit("response")).alias("_type"),
        F.when(F.col("_g").isNotNull() & is_top, keeper).otherwise(own).alias("_id"),
        F.col("_k").alias("_key"), F.col("_u").alias("_url"),
        F.when(~copy, F.col("_p")).alias("_payload"), F.sha1("_p").alias("_sha1"),
        F.when(copy, keeper).alias("_refers"),
    )
    repeated = groups.filter("_top._c > 1")
    if repeated.isEmpty():
        return out
    same = rows.join(repeated, rows["_d"] == repeated["_g"]).filter(is_top).groupBy("_g").agg(F.first("_p").alias("_p"), F.first("_top").alias("_top"))
    spread = same.select("_g", "_top", "_p", F.sha1("_p").alias("_sha1")).select("*", F.explode(F.expr("sequence(1L, _top._c)")).alias("_copy"))
    again = F.col("_copy") > 1
    return out.unionByName(spread.select(
        F.when(again, F.lit("revisit")).otherwise(F.lit("response")).alias("_type"),
        F.when(again, identifier(F.col("_top._k"), F.col("_top._u"), F.col("_g"), F.col("_copy").cast("string"))).otherwise(keeper).alias("_id"),
        F.col("_top._k").alias("_key"), F.col("_top._u").alias("_url"),
        F.when(~again, F.col("_p")).alias("_payload"), "_sha1", F.when(again, keeper).alias("_refers"),
    ))


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html", least: int = LEAST_REVISIT, chunk: int = CHUNK_BYTES) -> None:
    """Write a WARC record per row of ``pages`` as compressed archives below ``path``.

    A null payload is empty. A payload over ``chunk`` bytes becomes a first
    segment and ``continuation`` records behind it, so no record in the archive
    is longer and none is built whole. Records are rows of Spark's text writer
    whose line separator is the blank lines behind a record; the commit is the
    writer's, so a lost executor leaves no half archive. Keys travel as text in a
    ``Row-Key`` field; a null key or url has no field. Blanks and control
    characters of a url become ``%20``. An empty table writes no record.
    """
    rows = record_rows(pages, key, url, payload, least).withColumn("_n", F.coalesce(F.octet_length("_payload"), F.lit(0)).cast("long"))
    last = F.greatest(F.ceil(F.col("_n") / chunk) - 1, F.lit(0))
    cut = rows.withColumn("_last", last.cast("int")).select("*", F.explode(F.sequence(F.lit(0), "_last")).alias("_i"))
    first, response = F.col("_i") == 0, F.col("_type") == "response"
    part = F.coalesce(F.substring("_payload", F.col("_i") * chunk + 1, F.lit(chunk)), F.lit(b""))
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), F.col("_n").cast("string"), F.lit(END * 2))
    block = F.concat(F.when(first & response, head).otherwise(F.lit("")), part.cast("string"))
    segmented = F.col("_last") > 0
    fields = [
        F.lit(VERSION),
        _line("WARC-Type", F.when(first, F.col("_type")).otherwise(F.lit("continuation"))),
        _line("WARC-Record-ID", F.when(first, F.col("_id")).otherwise(_urn(F.col("_id"), F.col("_i").cast("string")))),
        _line("WARC-Date", RECORD_DATE),
        _line("WARC-Target-URI", _shown(F.col("_url"))),
        _line("Row-Key", F.url_encode(F.col("_key").cast("string"))),
        F.when(first, _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("_sha1")))),
        _line("WARC-Refers-To", F.col("_refers")),
        F.when(~response, _line("WARC-Profile", SAME_PAYLOAD)),
        F.when(segmented, _line("WARC-Segment-Number", (F.col("_i") + 1).cast("string"))),
        F.when(~first, _line("WARC-Segment-Origin-ID", F.col("_id"))),
        F.when(segmented & (F.col("_i") == F.col("_last")), _line("WARC-Segment-Total-Length", (F.col("_n") + F.octet_length(head)).cast("string"))),
        F.when(first & response, _line("Content-Type", "application/http; msgtype=response")),
        _line("Content-Length", F.octet_length(block).cast("string")),
    ]
    record = cut.select(F.concat(F.concat_ws(END, *fields), F.lit(END * 2), block).alias("value"))
    record.write.option("lineSep", END * 2).option("compression", "gzip").text(path)


class RecordStream:
    """Splits the bytes of archives into chunk rows; holds one header or one chunk at a time.

    The digest of a record goes on from chunk to chunk and over its
    continuations, so each row tells the digest of the payload so far.
    """

    def __init__(self, chunk: int, with_data: bool):
        self.chunk, self.with_data = chunk, with_data
        self.left = b""
        self.want = None  # bytes of the block still to come; None between records
        self.http = False
        self.fields: dict[str, str] = {}
        self.open = False  # a segmented record waits for its continuation
        self.rows: list[tuple] = []

    def feed(self, data: bytes) -> None:
        buf, at = self.left + data, 0
        while True:
            if self.want is None:
                end = buf.find(b"\r\n\r\n", at)
                if end < 0:
                    break
                self._begin(buf[at:end])
                at = end + 4
            elif self.http:
                end = buf.find(b"\r\n\r\n", at)
                if end < 0:
                    break
                self.want -= end + 4 - at
                at, self.http = end + 4, False
            elif self.want:
                some = buf[at : at + min(self.want, self.chunk - len(self.body) if self.with_data else self.want)]
                if not some:
                    break
                at += len(some)
                self.want -= len(some)
                self.digest.update(some)
                self.bytes += len(some)
                if self.with_data:
                    self.body += some
                    if len(self.body) >= self.chunk and self.want:
                        self._put(False)
            else:
                if len(buf) < at + 4:
                    break
                if buf[at : at + 4] != b"\r\n\r\n":
                    raise ValueError(f"{self.id}: the record does not end where its length says")
                at += 4
                self._end()
        self.left = buf[at:]

    def close(self) -> None:
        if self.left or self.want is not None or self.open:
            raise ValueError(f"{getattr(self, 'id', 'archive')}: ends inside a record")

    def _begin(self, head: bytes) -> None:
        lines = head.decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record begins with {lines[0][:40]!r}")
        self.fields = own = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}
        self.want = int(own["content-length"])
        more = own["warc-type"] == "continuation"
        if more != self.open or (more and own.get("warc-segment-origin-id") != self.id):
            raise ValueError(f"{own['warc-record-id']}: segments of a record must follow each other")
        self.http = own.get("content-type", "").startswith("application/http")
        if not more:
            self.id, self.number, self.bytes, self.body = own["warc-record-id"], 0, 0, bytearray()
            self.first, self.digest = own, hashlib.sha1(usedforsecurity=False)
        self.open = "warc-segment-number" in own and "warc-segment-total-length" not in own

    def _end(self) -> None:
        self.want = None
        if not self.open:
            self._put(True)
        elif self.body and len(self.body) >= self.chunk:
            self._put(False)

    def _put(self, last: bool) -> None:
        said = self.first.get("warc-payload-digest", "").removeprefix("sha1:") or None
        so_far = self.digest.hexdigest()
        if last and said and self.first["warc-type"] != "revisit" and said != so_far:
            raise ValueError(f"{self.id}: the payload has another digest than its header says")
        own = self.first
        self.rows.append((
            self.id, self.number, own["warc-type"], own.get("row-key"), own.get("warc-target-uri"), own.get("warc-refers-to"), said,
            bytes(self.body) if self.with_data else None, self.bytes, so_far, last,
        ))
        self.number += 1
        self.body = bytearray()


_ARROW = pa.schema([
    ("record_id", pa.string()), ("chunk_no", pa.int32()), ("record_type", pa.string()), ("key", pa.string()), ("uri", pa.string()), ("refers_to", pa.string()),
    ("declared", pa.string()), ("data", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("last", pa.bool_()),
])


def read_chunks(spark: SparkSession, path: str, chunk: int = CHUNK_BYTES, with_data: bool = True) -> DataFrame:
    """The chunked record table of the archives (``*.gz``) below ``path``: see ``CHUNKS``.

    One row per record and chunk of at most ``chunk`` bytes; ``payload_bytes`` and
    ``payload_digest`` (SHA-1) tell the payload up to and with this chunk, and a
    record without a payload has one empty chunk. Compressed archives are not
    split, so a task streams whole files, line by line, and holds a batch of
    lines, a header and a chunk, never a whole record. A digest or a length that
    differs from the header, and a segment without its origin, end the job.
    Without ``with_data`` only the last row of each record comes, without bytes.
    """
    lines = spark.read.option("lineSep", "\n").option("pathGlobFilter", "*.gz").schema("value string").text(path).select(F.col("value").cast("binary").alias("value"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = RecordStream(chunk, with_data)

        def ready(least_bytes: int, least_rows: int) -> Iterator[pa.RecordBatch]:
            rows = stream.rows
            while rows and (len(rows) >= least_rows or sum(len(r[7] or b"") for r in rows) >= least_bytes):
                cut, held = 0, 0
                while cut < len(rows) and cut < BATCH_ROWS and held <= BATCH_BYTES:
                    held += len(rows[cut][7] or b"")
                    cut += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[:cut]), _ARROW.types)], schema=_ARROW)
                del rows[:cut]

        for batch in batches:
            held = []
            size = 0
            for line in batch.column(0):
                held.append(line.as_py())
                size += len(held[-1])
                if size >= BATCH_BYTES:
                    stream.feed(b"\n".join(held) + b"\n")
                    held, size = [], 0
                    yield from ready(BATCH_BYTES, BATCH_ROWS)
            if held:
                stream.feed(b"\n".join(held) + b"\n")
            yield from ready(BATCH_BYTES, BATCH_ROWS)
        stream.close()
        yield from ready(0, 0)

    return lines.mapInArrow(run, CHUNKS)


def records(chunks: DataFrame) -> DataFrame:
    """One row per record (``record_id``, ``record_type``, ``key``, ``uri``, ``payload_bytes``, ``payload_digest``, ``refers_to``).

    A revisit gets length and digest of the response it refers to, and that
    one's key as ``refers_to``; a revisit of a record that is not in the archives
    keeps the digest its header declares, a null length and a null key.
    """
    whole = chunks.filter("last").select(
        "record_id", "record_type", F.url_decode("key").alias("key"), "uri", F.col("refers_to").alias("_to"), "declared", "payload_bytes", "payload_digest",
    )
    responses = whole.filter("record_type = 'response'")
    kept = responses.select(F.col("record_id").alias("_id"), F.col("key").alias("_key"), F.col("payload_bytes").alias("_bytes"), F.col("payload_digest").alias("_digest"))
    revisits = whole.filter("record_type <> 'response'")
    found = revisits.join(kept, revisits["_to"] == kept["_id"], "left")
    out = ["record_id", "record_type", "key", "uri", "payload_bytes", "payload_digest", "refers_to"]
    return responses.withColumn("refers_to", F.lit(None).cast("string")).select(*out).unionByName(
        found.select("record_id", "record_type", "key", "uri", F.col("_bytes").alias("payload_bytes"), F.coalesce("_digest", "declared").alias("payload_digest"), F.col("_key").alias("refers_to"))
    )


def archived(pages: DataFrame, path: str | None = None, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Write ``pages`` as archives (to a fresh shared folder unless ``path`` is given) and read their records back.

    Nulls: a null payload is empty, a null key or url has no header field and
    reads as null. Rows equal in all three are one response and revisits of it.
    Texts of any length are stored and read in chunks. Columns beside the three
    named ones take no part, whatever their names. An empty table gives no rows.
    """
    path = path or scratch_path(pages.sparkSession, "warc")
    write_archives(pages, path, key, url, payload)
    # Read twice, by responses and by revisits, so the record table is stored once.
    return records(written(read_chunks(pages.sparkSession, path, with_data=False), "warc-records"))
