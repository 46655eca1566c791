"""WARC archives with segmented records: written, read back and reassembled.

A page becomes a ``response`` record whose block is an HTTP message with a chunked body, or a
``revisit`` of an equal page. A long block is cut into segments: the first keeps the type and
all headers, the others are ``continuation`` records that name the first one's identifier
and their number; the last of them has the total length. Every record is a gzip member of its
own, and segments of different records are interleaved in an archive.

Reading parses the records of every archive in a stream, groups them by origin identifier,
orders them by segment number, checks that none is missing and that the lengths add up to the
total, and decodes the chunked framing of the body.

Defined cases: NULL html is an empty payload; NULL url becomes an empty target; a NULL page_id
is written with an empty page number and read back as NULL, and is never the one that others
refer to; repeated rows are records of their own, all alike; an empty
table gives no archives and no rows; other columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlane.llm.files import new_file, open_folder, table
from starlane.sources.scratch import scratch_folder

#: Shorter payloads are never written as revisits.
REVISIT_BYTES = 1000
SEGMENT_BYTES = 16_384
CHUNK_BYTES = 4_096
ARCHIVE_BYTES = 32 << 20
OPEN_RECORDS = 4

HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAYLOADS = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
PIECES = "origin string, segment int, total long, record_type string, page_id long, url string, digest string, refers_to long, payload_bytes long, block binary"


def chunked(body: bytes, size: int) -> bytes:
    parts = [b"%x\r\n%s\r\n" % (len(part), part) for part in (body[i : i + size] for i in range(0, len(body), size))]
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(data: bytes) -> bytes:
    """The body of a chunked message; extensions and trailers are allowed and dropped."""
    out, at = [], 0
    while True:
        end = data.index(b"\r\n", at)
        size = int(data[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(out)
        if data[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk does not end where it should")
        out.append(data[at : at + size])
        at += size + 2


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    return gzip.compress(b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n", 3, mtime=0)


def records_of(page_id, url, body: bytes, digest: str, refers_to, segment_bytes: int, chunk_bytes: int) -> list[bytes]:
    """The records of one page, one for each segment."""
    origin = f"<urn:uuid:{uuid.uuid4()}>"
    page = "" if page_id is None else str(page_id)
    shared = [("WARC-Target-URI", "".join((url or "").split())), ("WARC-Date", "2024-01-01T00:00:00Z"), ("X-Page-Id", page)]
    if refers_to is not None:
        return [record([("WARC-Type", "revisit"), ("WARC-Record-ID", origin), *shared, ("WARC-Payload-Digest", f"sha1:{digest}"),
                        ("WARC-Profile", PROFILE), ("X-Refers-To-Page-Id", str(refers_to)), ("X-Payload-Length", str(len(body)))], b"")]
    block = HTTP_HEAD + chunked(body, chunk_bytes)
    parts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    first = [("WARC-Type", "response"), ("WARC-Record-ID", origin), *shared, ("WARC-Payload-Digest", f"sha1:{digest}")]
    if len(parts) == 1:
        return [record(first, block)]
    out = [record([*first, ("WARC-Segment-Number", "1")], parts[0])]
    for number, part in enumerate(parts[1:], 2):
        headers = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), *shared[:2],
                   ("WARC-Segment-Origin-ID", origin), ("WARC-Segment-Number", str(number))]
        if number == len(parts):
            headers.append(("WARC-Segment-Total-Length", str(len(block))))
        out.append(record(headers, part))
    return out


def with_revisits(pages: DataFrame, least: int) -> DataFrame:
    """page_id, url, html, digest and the page a revisit refers to."""
    body = F.coalesce("html", F.lit(""))
    pages = pages.select("page_id", "url", body.alias("html"), F.sha1(body.cast("binary")).alias("digest"), F.octet_length(body).alias("bytes"))
    known = pages.where((F.col("bytes") >= least) & F.col("page_id").isNotNull())
    equal = known.groupBy("digest", "bytes").agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return pages.join(equal, ["digest", "bytes"], "left").select(
        "page_id", "url", "html", "digest", F.when(~F.col("page_id").eqNullSafe(F.col("keeper")), F.col("keeper")).alias("refers_to")
    )


def write_archives(pages: DataFrame, folder: str, least: int = REVISIT_BYTES, segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Write every page to archives; the table of them (name, n_records)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for at in range(0, batch.num_rows, 64) for row in zip(*[c.to_pylist() for c in batch.slice(at, 64).columns]))
        row = next(rows, None)
        while row is not None:
            with new_file(folder, "pages") as (stream, name):
                written, n = 0, 0
                waiting: list[list[bytes]] = []
                while row is not None and written < ARCHIVE_BYTES:
                    page_id, url, html, digest, refers_to = row
                    waiting.append(records_of(page_id, url, html.encode(), digest, refers_to, segment_bytes, chunk_bytes)[::-1])
                    row = next(rows, None)
                    # Records wait for each other, so their segments lie between one another.
                    while len(waiting) >= OPEN_RECORDS or (row is None and waiting):
                        for parts in waiting:
                            raw = parts.pop()
                            stream.write(raw)
                            written += len(raw)
                            n += 1
                        waiting = [parts for parts in waiting if parts]
                for parts in waiting:
                    for raw in parts[::-1]:
                        stream.write(raw)
                        n += 1
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], ["name", "n_records"])

    written = with_revisits(pages, least).mapInArrow(run, "name string, n_records long")
    index = f"{folder}/index"
    written.write.parquet(index)
    return pages.sparkSession.read.schema(written.schema).parquet(index)


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of an archive, one gzip member in memory at a time."""
    rest = b""
    while True:
        if not rest:
            rest = stream.read(1 << 20)
            if not rest:
                return
        member, raw = zlib.decompressobj(31), []
        while not member.eof:
            raw.append(member.decompress(rest))
            rest = member.unused_data
            if not member.eof:
                rest = stream.read(1 << 20)
                if not rest:
                    raise ValueError("an archive ends within a record")
        data = io.BytesIO(b"".join(raw))
        if not data.readline().startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        headers = {}
        while (line := data.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        yield headers, data.read(int(headers["content-length"]))


def read_segments(index: DataFrame, folder: str) -> DataFrame:
    """One row for each record of the archives."""

    def number(text: str | None) -> int | None:
        return int(text) if text else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = open_folder(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, size = [], 0
                with system.open_input_stream(f"{path}/{name}") as stream:
                    for h, block in read_records(stream):
                        rows.append((
                            h.get("warc-segment-origin-id", h["warc-record-id"]), int(h.get("warc-segment-number", 1)),
                            number(h.get("warc-segment-total-length")) if "warc-segment-number" in h else len(block),
                            h["warc-type"], number(h.get("x-page-id")), h.get("warc-target-uri"),
                            h.get("warc-payload-digest", "").removeprefix("sha1:") or None, number(h.get("x-refers-to-page-id")), number(h.get("x-payload-length")), block,
                        ))
                        size += len(block)
                        if size >= 4 << 20:
                            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=arrow)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=arrow)

    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    arrow = pa.schema([(n, kinds[k]) for n, k in (part.split() for part in PIECES.split(", "))])
    names = arrow.names
    return index.select("name").repartition(max(1, index.count()), "name").mapInArrow(run, PIECES)


def reassembled(segments: DataFrame) -> DataFrame:
    """One row for each original record, with the blocks of all its segments in order."""
    whole = segments.where("segment = 1 and total is not null")
    parts = segments.where("segment > 1 or total is null")
    # A group holds the segments of one record.
    joined = parts.groupBy("origin").agg(
        F.array_sort(F.collect_list(F.struct("segment", "block"))).alias("parts"), F.max("total").alias("total"),
        *[F.max_by(c, -F.col("segment")).alias(c) for c in ("record_type", "page_id", "url", "digest", "refers_to", "payload_bytes")],
    )
    numbers = F.transform("parts", lambda p: p["segment"])
    length = F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + F.octet_length(p["block"]))
    complete = (numbers == F.sequence(F.lit(1), F.size("parts"))) & (length == F.col("total"))
    joined = joined.withColumn("blocks", F.transform("parts", lambda p: p["block"])).withColumn("complete", F.coalesce(complete, F.lit(False)))
    columns = ["record_type", "page_id", "url", "digest", "refers_to", "payload_bytes", "blocks", "complete"]
    return whole.withColumn("blocks", F.array("block")).withColumn("complete", F.lit(True)).select(columns).unionByName(joined.select(columns))


def payloads(records: DataFrame) -> DataFrame:
    """Decode every record's payload; a record that is incomplete or whose digest differs raises."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            rows = (row for at in range(0, batch.num_rows, 64) for row in zip(*[c.to_pylist() for c in batch.slice(at, 64).columns]))
            for kind, page_id, url, digest, refers_to, size, blocks, complete in rows:
                if not complete:
                    raise ValueError(f"segments of page {page_id} are missing or their lengths differ from the total")
                body = None
                if kind == "response":
                    head, _, framed = b"".join(blocks).partition(b"\r\n\r\n")
                    body = unchunked(framed) if b"transfer-encoding: chunked" in head.lower() else framed
                    if hashlib.sha1(body).hexdigest() != digest:
                        raise ValueError(f"the payload of page {page_id} differs from its digest")
                out.append((page_id, url, len(body) if body is not None else size, digest, kind, refers_to, body))
            columns = zip(*out) if out else [[]] * 7
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], PAYLOADS)

    return records.mapInArrow(run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def round_trip(pages: DataFrame, folder: str) -> DataFrame:
    """Write the pages as archives and read them back: one row per record with its payload (NULL for revisits)."""
    return payloads(reassembled(read_segments(write_archives(pages, folder), folder)))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages"), scratch_folder(spark, "warc")).drop("url", "payload")


#: The same rows from the table itself.
OP6_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest FROM p),
k AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS keeper FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> keeper THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> keeper THEN keeper END AS refers_to
FROM k
"""
