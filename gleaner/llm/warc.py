"""WARC archives: written from pages, read back, and put together by transaction.

Every capture is three records: a request, a response (or a revisit, where an
equal payload is stored already) and metadata. Request and metadata name their
response or revisit in ``WARC-Concurrent-To``; captures are built by joining on
it. Archives are plain text files for Spark: a record's two closing line ends
are the writer's line separator. They are compressed as a whole and so are read
by one task each, in order, line by line; nothing holds a whole archive.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.functions.skew import broadcast_checked
from gleaner.llm.native import stored

END = "\r\n"
CLOSE = END + END
VERSION = "WARC/1.1"
# Payloads below this many bytes are always stored.
LEAST_SHARED = 100
_FETCHED = "2024-01-01T00:00:00Z"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: "
_SAME = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORDS = (
    "record_id string, record_type string, concurrent_to string, refers_to string, target_uri string, date string, "
    "stated_digest string, http_header string, payload binary"
)


def _id(kind: str, *parts: Column) -> Column:
    """A record's id, made from what identifies its capture, so a repeated task writes the same."""
    h = F.md5(F.concat_ws("|", F.lit(kind), *[F.coalesce(p.cast("string"), F.lit("\\N")) for p in parts]))
    cut = [F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _record(kind: Column | str, record_id: Column, uri: Column, media: str, block: Column, *more: Column) -> Column:
    """A record's text without its closing line ends; ``more`` are header lines or null."""
    header = F.concat_ws(
        END,
        F.lit(VERSION),
        F.concat(F.lit("WARC-Type: "), F.lit(kind) if isinstance(kind, str) else kind),
        F.concat(F.lit("WARC-Record-ID: "), record_id),
        F.lit(f"WARC-Date: {_FETCHED}"),
        F.concat(F.lit("WARC-Target-URI: "), uri),
        *more,
        F.lit(f"Content-Type: {media}"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    )
    return F.concat(header, F.lit(CLOSE), block)


def write_archives(pages: DataFrame, folder: str) -> None:
    """Write request, response or revisit, and metadata records of every page as .gz archives.

    Of pages with equal payloads of at least 100 bytes, those with the smallest
    page_id are responses (repeated rows of that page_id all are), the others
    revisit it; null page_ids come last. A null html is an empty payload, a
    null url is replaced by a URN of the page. Other columns are not read. An
    empty table writes archives without records. Hot payloads are grouped with
    map-side sums; the digests that occur twice are sent to the pages by
    broadcast if their counted number allows it, else joined by shuffle.
    """
    body = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", body.alias("html")).withColumn("digest", F.sha2(F.col("html"), 256))
    shared = F.octet_length("html") >= LEAST_SHARED
    firsts = (
        rows.filter(shared)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("pages"))
        .filter(F.col("pages") > 1)
        .select("digest", "first")
    )
    firsts, _ = broadcast_checked(firsts)
    marked = rows.join(firsts, "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id")) & shared

    head = _id("head", F.col("page_id"), F.col("digest"))
    uri = F.coalesce(
        F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20"),
        F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none"))),
    )
    concurrent = F.concat(F.lit("WARC-Concurrent-To: "), head)
    http = F.concat(F.lit(_HTTP), F.octet_length("html").cast("string"), F.lit(CLOSE))
    refers = F.when(again, F.concat(F.lit("WARC-Refers-To: "), _id("head", F.col("first"), F.col("digest"))))
    request = _record(
        "request", _id("request", F.col("page_id"), F.col("digest")), uri, "application/http; msgtype=request",
        F.concat(F.lit("GET "), uri, F.lit(" HTTP/1.1"), F.lit(CLOSE)), concurrent,
    )
    capture = _record(
        F.when(again, F.lit("revisit")).otherwise(F.lit("response")), head, uri, "application/http; msgtype=response",
        F.concat(http, F.when(again, F.lit("")).otherwise(F.col("html"))),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
        F.when(again, F.lit(f"WARC-Profile: {_SAME}")), refers,
    )
    page = F.concat(F.lit("page_id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(END))
    metadata = _record("metadata", _id("metadata", F.col("page_id"), F.col("digest")), uri, "application/warc-fields", page, concurrent)
    marked.select(F.explode(F.array(request, capture, metadata)).alias("value")).write.text(
        folder, compression="gzip", lineSep=CLOSE
    )
    firsts.unpersist()


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all archives in a folder, one row each, in the columns of ``RECORDS``.

    Archives must be compressed (``.gz``), as then one task reads each from its
    beginning. Records are cut by their Content-Length, so a payload may hold
    any bytes, record headers included. The payload of HTTP records is what
    follows their own header. An archive that ends inside a record is an error.
    """
    lines = spark.read.text(folder, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("line")
    )
    schema = pa.schema([(n, pa.string()) for n in [f.split()[0] for f in RECORDS.split(", ")][:-1]] + [("payload", pa.binary())])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, file = _Lines(), None
        for batch in batches:
            names, found = batch.column(0), reader.found
            runs = [names[0].as_py()] if len(names) else []
            one = len(names) and names[-1].as_py() == runs[0]
            files = runs * len(names) if one else names.to_pylist()
            for name, line in zip(files, batch.column(1).to_pylist()):
                if name != file:
                    reader.end(file)
                    file = name
                reader.line(line)
                if reader.size > 4_000_000:
                    yield reader.batch(schema)
            if found:
                yield reader.batch(schema)
        reader.end(file)
        if reader.found:
            yield reader.batch(schema)

    return lines.mapInArrow(parse, RECORDS)


class _Lines:
    """Cuts the lines of one archive after the other into records; holds one record at a time."""

    def __init__(self):
        self.found: list[tuple] = []
        self.size = 0
        self.reset()

    def reset(self) -> None:
        self.header: dict[str, str] | None = None
        self.block: list[bytes] = []
        self.left = -1  # bytes that the block still lacks; -1 before the block

    def line(self, line: bytes) -> None:
        if self.left >= 0:  # inside a block: the line and the line end cut off behind it
            self.block.append(line)
            self.left -= len(line) + 1
            if self.left <= -1:
                self.close()
        elif self.header is None:
            if line.strip():
                if not line.startswith(b"WARC/"):
                    raise ValueError(f"no record begins with {line[:40]!r}")
                self.header = {}
        elif line in (b"\r", b""):
            self.left = int(self.header["content-length"])
            if self.left == 0:
                self.close()
        else:
            name, _, value = line.rstrip(b"\r").partition(b":")
            self.header[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()

    def close(self) -> None:
        block = b"\n".join(self.block)[: int(self.header["content-length"])]
        get, http, payload = self.header.get, None, block
        if get("content-type", "").startswith("application/http"):
            head, cut, payload = block.partition(b"\r\n\r\n")
            http = head.decode("latin-1")
        digest = get("warc-payload-digest")
        self.found.append(
            (
                get("warc-record-id"), get("warc-type"), get("warc-concurrent-to"), get("warc-refers-to"),
                get("warc-target-uri"), get("warc-date"), digest and digest.partition(":")[2], http, payload,
            )
        )
        self.size += len(payload) + 200
        self.reset()

    def end(self, file: str | None) -> None:
        if self.header is not None:
            raise ValueError(f"{file} ends inside a record")
        self.reset()

    def batch(self, schema: pa.Schema) -> pa.RecordBatch:
        columns = list(zip(*self.found))
        self.found.clear()
        self.size = 0
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _named(reference: str, own: str) -> Column:
    """A join key for a reference that most records lack: those get keys of their own, which match nothing."""
    return F.coalesce(F.col(reference), F.concat(F.lit("none "), F.col(own)))


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture, requests, metadata, original.

    ``capture`` is the response or revisit record; ``requests`` and
    ``metadata`` are the records concurrent to it, sorted by id; ``original``
    is the response a revisit refers to, null for responses and where it is
    missing. A capture without request or metadata has null lists. Repeated
    records stay. Records concurrent to no capture are not part of any row.
    Columns are those of the given records, so payloads move only if kept.
    """
    fields = [F.col(c) for c in records.columns]
    heads = records.filter(F.col("record_type").isin("response", "revisit"))

    def concurrent(kind: str, name: str) -> DataFrame:
        return (
            records.filter((F.col("record_type") == kind) & F.col("concurrent_to").isNotNull())
            .groupBy(F.col("concurrent_to").alias("id"))
            .agg(F.sort_array(F.collect_list(F.struct(*fields))).alias(name))
        )

    originals = (
        heads.filter("record_type = 'response'").groupBy(F.col("record_id").alias("of")).agg(F.first(F.struct(*fields)).alias("original"))
    )
    return (
        heads.select(F.col("record_id").alias("id"), _named("refers_to", "record_id").alias("of"), F.struct(*fields).alias("capture"))
        .join(concurrent("request", "requests"), "id", "left")
        .join(concurrent("metadata", "metadata"), "id", "left")
        .join(originals, "of", "left")
        .select("capture", "requests", "metadata", "original")
    )


def page_digests(records: DataFrame) -> DataFrame:
    """What became of every page, read from the archives: page_id, payload_bytes, payload_digest, record_type, refers_to.

    The archives are parsed once: lengths, digests and references are written
    as narrow rows, and the joins read those. Payloads are not shuffled.
    Length and digest of a revisit are those of the response it refers to. A
    page whose page_id was null has a null page_id here.
    """
    narrow = records.select(
        "record_id", "record_type", "concurrent_to", "refers_to",
        F.when(F.col("record_type") == "metadata", F.regexp_extract(F.col("payload").cast("string"), r"page_id: (-?\d*)", 1)).alias("page"),
        F.octet_length("payload").cast("long").alias("bytes"),
        F.sha2("payload", 256).alias("digest"),
    )
    narrow = stored(narrow, "records")
    page = lambda c: F.when(F.col(c) != "", F.col(c).cast("long"))
    captures = assemble(narrow).select("capture", F.col("metadata")[0]["page"].alias("page"), "original")
    named = captures.select(F.col("capture.record_id").alias("id"), F.col("page").alias("first")).groupBy("id").agg(F.min("first").alias("first"))
    again = F.col("capture.record_type") == "revisit"
    return (
        captures.withColumn("id", _named("capture.refers_to", "capture.record_id"))
        .join(named, "id", "left")
        .select(
            page("page").alias("page_id"),
            F.when(again, F.col("original.bytes")).otherwise(F.col("capture.bytes")).alias("payload_bytes"),
            F.when(again, F.col("original.digest")).otherwise(F.col("capture.digest")).alias("payload_digest"),
            F.col("capture.record_type").alias("record_type"),
            F.when(again, page("first")).alias("refers_to"),
        )
    )


PAGES_SQL = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {LEAST_SHARED} AND first IS DISTINCT FROM page_id AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {LEAST_SHARED} AND first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM f
"""
