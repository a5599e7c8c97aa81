"""WARC archives of pages: writer, and a reader that reassembles segmented records.

Written are WARC/1.1 records, one text-sink row per record (``\\r\\n\\r\\n`` ends a record), gzip-compressed: a
``response`` with the payload in chunked transfer framing, or a ``revisit`` without payload for a page whose
payload of at least ``MIN_REVISIT`` bytes equals that of a page with a larger id. A response longer than
``SEGMENT_BYTES`` is cut into a first segment and ``continuation`` records that name their origin.

The reader streams the files line by line (``\\r\\n``), frames records by Content-Length, so payload bytes that
look like record borders do no harm, groups continuation records by origin id, orders them by segment
number, verifies the total length, decodes the chunked framing and verifies the payload digest. A record that
fails a check is an error and not a lost row. A task holds one record at a time; a record's segments meet in
one row, because a payload is one value.

Edge cases: a null payload is empty; a null page id is smaller than all others and comes back null; a null
URL is written without target. Equal rows are written as records of their own; when rows share the largest id
of a payload, all of them are responses. Payloads of any length are written whole. Other columns are not read.
An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import new_table_root
from ._tables import _CLEANUP, schema

MIN_REVISIT = 1000       # payload bytes from which an equal payload is a revisit
SEGMENT_BYTES = 16_384   # block bytes of a segment
CHUNK_BYTES = 4_096      # bytes of a transfer chunk
RECORDS_PER_FILE = 20_000
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

PARTS = schema("record_id string, segment int, total long, page_id long, record_type string, refers_to long, "
               "payload_bytes long, payload_digest string, block binary")


def _cut(data: bytes, size: int) -> list[bytes]:
    """Pieces of about ``size`` bytes that do not split a UTF-8 character."""
    out, a = [], 0
    while a < len(data):
        b = min(a + size, len(data))
        while b < len(data) and b > a + 1 and data[b] & 0xC0 == 0x80:
            b -= 1
        out.append(data[a:b])
        a = b
    return out


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in headers if v is not None)
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block


def page_records(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool,
                 record_id: str) -> list[bytes]:
    """The records of a page, without the closing line ends."""
    digest = hashlib.sha1(payload).hexdigest()
    target = None if url is None else "".join(url.split())
    common = [("WARC-Record-ID", f"<urn:uuid:{record_id}>"), ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Target-URI", target or None),
              ("WARC-Page-ID", page_id), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if revisit:
        block = _HTTP + b"Content-Length: %d\r\n\r\n" % len(payload)
        return [_record([("WARC-Type", "revisit"), *common, ("WARC-Profile", _PROFILE), ("WARC-Refers-To-Page-ID", refers_to),
                         ("Content-Type", "application/http;msgtype=response")], block)]
    chunks = b"".join(b"%x\r\n%s\r\n" % (len(c), c) for c in _cut(payload, CHUNK_BYTES))
    block = _HTTP + b"Transfer-Encoding: chunked\r\n\r\n" + chunks + b"0\r\n\r\n"
    pieces = _cut(block, SEGMENT_BYTES) if len(block) > SEGMENT_BYTES else [block]
    cut = len(pieces) > 1
    out = [_record([("WARC-Type", "response"), *common, ("WARC-Segment-Number", 1 if cut else None),
                    ("Content-Type", "application/http;msgtype=response")], pieces[0])]
    for k, piece in enumerate(pieces[1:], 2):
        own = uuid.uuid5(uuid.UUID(record_id), str(k))
        out.append(_record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:uuid:{own}>"), ("WARC-Date", "1970-01-01T00:00:00Z"),
                            ("WARC-Segment-Origin-ID", f"<urn:uuid:{record_id}>"), ("WARC-Segment-Number", k),
                            ("WARC-Segment-Total-Length", len(block) if k == len(pieces) else None)], piece))
    return out


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Write the pages' records to gzip files under ``path`` (any Spark file system)."""
    src = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                       F.coalesce(F.col(html_col).cast("binary"), F.lit(b"")).alias("payload"))
    src = src.withColumn("key", F.when(F.octet_length("payload") >= MIN_REVISIT, F.sha2("payload", 256)))
    # Only narrow rows meet by payload (map-side combined); the join splits a hot payload between tasks.
    last = (src.where(F.col("key").isNotNull()).groupBy("key")
            .agg(F.max(F.coalesce("id", F.lit(-1 << 63))).alias("last"), F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1).select("key", "last"))
    src = src.join(last, "key", "left").select("id", "url", "payload", "last")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            rows, size = [], 0
            for page_id, url, payload, target in zip(*(c.to_pylist() for c in batch.columns)):
                n += 1
                revisit = target is not None and target != (-1 << 63 if page_id is None else page_id)
                made = page_records(page_id, url, payload, target if revisit else None, revisit,
                                    str(uuid.uuid5(uuid.NAMESPACE_OID, f"{task}:{n}:{page_id}")))
                rows += made
                size += sum(map(len, made))
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(rows, type=pa.binary())], names=["value"])
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(rows, type=pa.binary())], names=["value"])

    spark = pages.sparkSession
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        (src.mapInArrow(run, schema("value binary")).select(F.col("value").cast("string"))
         .write.options(lineSep="\r\n\r\n", compression="gzip", maxRecordsPerFile=RECORDS_PER_FILE).text(path))
    finally:
        spark.conf.set(_CLEANUP, before)


def read_records(lines: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of a stream of lines that ``\\r\\n`` ended."""
    for line in lines:
        if not line:
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers = {}
        for line in lines:
            if not line:
                break
            k, _, v = line.decode().partition(":")
            headers[k.strip().lower()] = v.strip()
        size = int(headers["content-length"])
        parts = [next(lines, b"")]
        have = len(parts[0])
        while have < size:
            line = next(lines, None)
            if line is None:
                raise ValueError("the archive ends within a record")
            parts.append(line)
            have += 2 + len(line)
        if have != size:
            raise ValueError(f"record length {have}, announced {size}")
        yield headers, b"\r\n".join(parts)


def dechunk(body: bytes) -> bytes:
    """The payload of a body in chunked transfer framing (extensions and trailers are skipped)."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if not size:
            return b"".join(out)
        out.append(body[at:at + size])
        if len(out[-1]) != size or body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("broken chunk")
        at += size + 2


def http_payload(block: bytes) -> tuple[bytes, dict[str, str]]:
    """Payload and lower-cased header fields of an HTTP response block."""
    head, _, body = block.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode().split("\r\n")[1:])}
    return (dechunk(body) if fields.get("transfer-encoding", "").lower() == "chunked" else body), fields


def _checked(block: bytes, digest: str | None) -> tuple[int, str]:
    payload, _ = http_payload(block)
    found = hashlib.sha1(payload).hexdigest()
    if digest is not None and found != digest:
        raise ValueError(f"payload digest {found}, announced {digest}")
    return len(payload), found


def _parts(headers: dict[str, str], block: bytes) -> tuple:
    """A record as a row of PARTS: decoded if it is whole, else its segment."""
    kind, number = headers["warc-type"], headers.get("warc-segment-number")
    number_of = lambda name: int(headers[name]) if name in headers else None
    page, total = number_of("warc-page-id"), number_of("warc-segment-total-length")
    digest = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if kind == "continuation":
        return headers["warc-segment-origin-id"], int(number), total, None, None, None, None, None, block
    if number is not None:
        return headers["warc-record-id"], int(number), total, page, kind, None, None, digest, block
    if kind == "revisit":
        return headers["warc-record-id"], None, None, page, kind, number_of("warc-refers-to-page-id"), int(http_payload(block)[1]["content-length"]), digest, None
    size, digest = _checked(block, digest)
    return headers["warc-record-id"], None, None, page, kind, None, size, digest, None


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per page of the archives: ``page_id, payload_bytes, payload_digest, record_type, refers_to``."""
    lines = spark.read.option("lineSep", "\r\n").text(path).select(F.col("value").cast("binary").alias("value"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for headers, block in read_records(x for batch in batches for x in batch.column(0).to_pylist()):
            rows.append(_parts(headers, block))
            size += len(rows[-1][-1] or b"") + 200
            if size > 4 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), types)], names=PARTS.names)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), types)], names=PARTS.names)

    types = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    parts = lines.mapInArrow(parse, PARTS)
    first = lambda c: F.first(c, ignorenulls=True).alias(c)
    whole = parts.groupBy("record_id").agg(
        *(first(c) for c in ("page_id", "record_type", "refers_to", "payload_bytes", "payload_digest")), F.max("total").alias("total"),
        F.sort_array(F.collect_list(F.when(F.col("segment").isNotNull(), F.struct("segment", "block")))).alias("segments"))
    out = schema("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = {n: batch.column(n) for n in batch.schema.names}
            sizes, digests = cols["payload_bytes"].to_pylist(), cols["payload_digest"].to_pylist()
            for i, segments in enumerate(cols["segments"]):
                if len(segments):
                    pieces = segments.as_py()
                    block = b"".join(p["block"] for p in pieces)
                    if [p["segment"] for p in pieces] != list(range(1, len(pieces) + 1)) or len(block) != cols["total"][i].as_py():
                        raise ValueError(f"segments of {cols['record_id'][i]} are not whole")
                    sizes[i], digests[i] = _checked(block, digests[i])
            yield pa.RecordBatch.from_arrays([cols["page_id"], pa.array(sizes, pa.int64()), pa.array(digests, pa.string()),
                                              cols["record_type"], cols["refers_to"]], names=out.names)

    return whole.mapInArrow(join, out)


def archive_round_trip(pages: DataFrame, **columns) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back."""
    path = new_table_root(pages.sparkSession, "llm-warc")
    write_archives(pages, path, **columns)
    return read_archives(pages.sparkSession, path)
