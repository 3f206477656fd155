"""WARC archives with segmented records (operator 9).

Writer: one record for each page. Payloads of at least ``MIN_REVISIT`` bytes that occur more than once are stored
with their smallest page_id and revisited by the others. A record's HTTP message is sent in chunked transfer coding;
a message longer than ``segment`` bytes is cut into a first record and continuation records, which may land in any
archive. Archives are text files of Spark's own writer whose line separator is the blank line that ends a WARC record,
so any store that Spark writes to will do.

Reader: archives are read whole (their size is the writer's choice) and parsed by Content-Length. Segments are
grouped by the identifier of their origin, ordered by segment number and checked against the total length; then the
chunked framing is decoded and the payload digest compared.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .stage import Stage, parts_for

MIN_REVISIT = 100
SEGMENT = 32 << 10
CHUNK = 8 << 10
ARCHIVE = 16 << 20
DATE = "2024-06-07T00:00:00Z"
CRLF = b"\r\n"
END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _cuts(data: bytes, limit: int) -> Iterator[bytes]:
    """Pieces of at most ``limit`` bytes (one character at least) that end between characters."""
    i = 0
    while i < len(data):
        j = min(len(data), i + limit)
        while j < len(data) and data[j] & 0xC0 == 0x80 and j > i + 1:
            j -= 1
        while j < len(data) and data[j] & 0xC0 == 0x80:
            j += 1
        yield data[i:j]
        i = j


def chunked(payload: bytes, limit: int = CHUNK) -> bytes:
    out = [b"%x\r\n%b\r\n" % (len(c), c) for c in _cuts(payload, limit)]
    return b"".join(out) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """Decode chunked transfer framing; chunk extensions and trailers are skipped."""
    out, i = [], 0
    while True:
        j = body.index(CRLF, i)
        size = int(body[i:j].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        out.append(body[j + 2:j + 2 + size])
        if body[j + 2 + size:j + 4 + size] != CRLF:
            raise ValueError("a chunk does not end where its size says")
        i = j + 4 + size


def record_id(page_id: int | None, row: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page {page_id} {row}')}>"


def _header(fields: list[tuple[str, object]]) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields if v is not None)]
    return "\r\n".join(lines).encode() + b"\r\n\r\n"


def page_records(page_id, url, payload: bytes, digest: str, refers, segment: int) -> Iterator[bytes]:
    """The record of a page and its continuations, without the blank line at their end."""
    url = " ".join((url or "").split()) or None
    rid = record_id(page_id, digest)
    common = [("WARC-Date", DATE), ("WARC-Target-URI", url), ("WARC-Payload-Digest", f"sha256:{digest}"),
              ("X-Page-ID", "" if page_id is None else page_id)]
    if refers is not None:
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
        yield _header([("WARC-Type", "revisit"), ("WARC-Record-ID", rid), *common, ("WARC-Profile", REVISIT_PROFILE),
                       ("WARC-Refers-To", record_id(refers, digest)), ("Content-Length", len(block))]) + block
        return
    message = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    blocks = list(_cuts(message, segment))
    for n, block in enumerate(blocks, 1):
        last = ("WARC-Segment-Total-Length", len(message) if n == len(blocks) > 1 else None)
        number = ("WARC-Segment-Number", n if len(blocks) > 1 else None)
        size = ("Content-Length", len(block))
        if n == 1:
            yield _header([("WARC-Type", "response"), ("WARC-Record-ID", rid), *common, number, size]) + block
        else:
            own = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{rid} {n}')}>"
            yield _header([("WARC-Type", "continuation"), ("WARC-Record-ID", own), ("WARC-Segment-Origin-ID", rid), ("WARC-Date", DATE), number, last, size]) + block


def _writer(segment: int):
    schema = pa.schema([("place", pa.string()), ("record", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            places, records, size = [], [], 0
            for page_id, url, html, digest, refers in zip(*(c for c in b.columns)):
                key = page_id.as_py()
                for n, r in enumerate(page_records(key, url.as_py(), (html.as_py() or "").encode(), digest.as_py(), refers.as_py(), segment)):
                    places.append(f"{key} {n}")
                    records.append(r.decode())
                    size += len(r)
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(records)], schema=schema)
                    places, records, size = [], [], 0
            if records:
                yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(records)], schema=schema)
    return run


def write_archives(spark: SparkSession, pages: DataFrame, path: str, segment: int = SEGMENT, archive: int = ARCHIVE,
                   compression: str = "gzip") -> None:
    """Write ``pages`` (page_id, url, html) as WARC archives of about ``archive`` bytes each below ``path``.

    A null html is an empty payload. A page without a page_id is a response and is never revisited. Of repeated rows
    with the smallest page_id of their payload each is a response, under one identifier. An empty table writes archives without records.
    """
    st = Stage(spark, "warc")
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumn("digest", F.sha2(F.encode("html", "UTF-8"), 256)).withColumn("bytes", F.octet_length("html"))
    small = st.put("digests", rows.select("page_id", "digest", "bytes"))
    total = small.agg(F.sum("bytes")).first()[0] or 0
    first = st.put("first", small.where(F.col("bytes") >= MIN_REVISIT).groupBy("digest")
                   .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 AND first IS NOT NULL").select("digest", "first"))
    refers = F.when(F.col("page_id") > F.col("first"), F.col("first"))
    marked = rows.join(first, "digest", "left").select("page_id", "url", "html", "digest", refers.alias("refers"))
    parts = parts_for(spark, total, archive)
    records = marked.mapInArrow(_writer(segment), "place string, record string").repartition(parts, F.xxhash64("place"))
    records.select("record").write.mode("overwrite").option("lineSep", END).option("compression", compression).text(path)


RECORD_DDL = ("origin string, segment int, total long, type string, page_id long, refers_id string, digest string, "
              "found string, payload_bytes long, block binary")
_RECORD = pa.schema([("origin", pa.string()), ("segment", pa.int32()), ("total", pa.int64()), ("type", pa.string()),
                     ("page_id", pa.int64()), ("refers_id", pa.string()), ("digest", pa.string()),
                     ("found", pa.string()), ("payload_bytes", pa.int64()), ("block", pa.binary())])


def payload_of(message: bytes) -> bytes:
    """The body of an HTTP message, chunked framing decoded."""
    head, _, body = message.partition(b"\r\n\r\n")
    return unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def parse_archive(data: bytes) -> Iterator[tuple]:
    """Rows of ``RECORD_DDL``, one for each record, found by their Content-Length. A message in one record is decoded
    here: it has ``found`` (its payload's digest) and ``payload_bytes``, and no block."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    i = 0
    while i < len(data):
        j = data.index(b"\r\n\r\n", i)
        version, *lines = data[i:j].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError("a record does not begin where the one before ends")
        f = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        size = int(f["content-length"])
        rid = f["warc-record-id"]
        page = f.get("x-page-id")
        block, found, payload_bytes = data[j + 4:j + 4 + size], None, None
        if "warc-segment-number" not in f:
            if f["warc-type"] == "response":
                payload = payload_of(block)
                found, payload_bytes = hashlib.sha256(payload).hexdigest(), len(payload)
            block = None
        yield (f.get("warc-segment-origin-id", rid), int(f.get("warc-segment-number", 1)),
               int(f["warc-segment-total-length"]) if "warc-segment-total-length" in f else None, f["warc-type"],
               int(page) if page else None, f.get("warc-refers-to"), f.get("warc-payload-digest", "").partition(":")[2] or None,
               found, payload_bytes, block)
        i = j + 4 + size + len(END)


def _parser(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for content in b.column(0):
            rows, size = [], 0
            for r in parse_archive(content.as_py()):
                rows.append(r)
                size += len(r[-1] or b"") + 300
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _RECORD.types)], schema=_RECORD)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _RECORD.types)], schema=_RECORD)


def reassemble(numbers: list[int], blocks: list[bytes], total: int | None) -> tuple[bytes, bool]:
    """The message of ordered segments, and whether these are complete: numbered from 1 and as long as stated."""
    message = b"".join(blocks)
    whole = numbers == list(range(1, len(numbers) + 1)) and (len(numbers) == 1 if total is None else len(message) == total)
    return message, whole


def _assembler(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("record_id", pa.string()), ("page_id", pa.int64()), ("type", pa.string()), ("refers_id", pa.string()),
                        ("digest", pa.string()), ("payload_bytes", pa.int64()), ("verified", pa.bool_()), ("copies", pa.int64())])
    for b in batches:
        rows = []
        for origin, page, kind, refers, digest, total, segments in zip(*b.columns):
            parts = segments.as_py()
            copies = max((p["n"] for p in parts if p["segment"] == 1), default=1)
            whole = all(p["same"] and p["n"] == copies for p in parts)
            bytes_, found = parts[0]["payload_bytes"], parts[0]["found"]
            if parts[0]["block"] is not None or len(parts) > 1:
                message, complete = reassemble([p["segment"] for p in parts], [p["block"] or b"" for p in parts], total.as_py())
                whole = whole and complete
                if whole:
                    payload = payload_of(message)
                    bytes_, found = len(payload), hashlib.sha256(payload).hexdigest()
            if kind.as_py() == "revisit":
                rows.append((origin.as_py(), page.as_py(), "revisit", refers.as_py(), digest.as_py(), None, whole, copies))
            else:
                rows.append((origin.as_py(), page.as_py(), kind.as_py(), None, found, bytes_,
                             whole and found is not None and found == digest.as_py(), copies))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, verified of every record in the archives.

    A message with missing or surplus segments, a wrong total length or a digest that differs comes back with
    verified = false; its bytes and digest are null where the message is incomplete. A revisit has the bytes of the
    response it refers to, null if that is absent. Repeated records with one identifier come back as often as they
    stand; they are counted before they meet, so that many copies are no large group.
    """
    st = Stage(spark, "warc-read")
    content = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    records = content.mapInArrow(_parser, RECORD_DDL)
    head = F.when(F.col("segment") == 1, F.col("type"))
    print_ = F.xxhash64("block", "found")
    segments = (records.groupBy("origin", "segment").agg(
        F.max("page_id").alias("page_id"), F.max(head).alias("type"), F.max("refers_id").alias("refers_id"), F.max("digest").alias("digest"),
        F.max("total").alias("total"), F.count(F.lit(1)).alias("n"), (F.min(print_) == F.max(print_)).alias("same"), F.max("found").alias("found"),
        F.max("payload_bytes").alias("payload_bytes"), F.min("block").alias("block")))
    joined = (segments.groupBy("origin").agg(
        F.max("page_id").alias("page_id"), F.max("type").alias("type"), F.max("refers_id").alias("refers_id"),
        F.max("digest").alias("digest"), F.max("total").alias("total"),
        F.sort_array(F.collect_list(F.struct("segment", "n", "same", "found", "payload_bytes", "block"))).alias("segments"))
        .select("origin", "page_id", "type", "refers_id", "digest", "total", "segments"))
    ddl = "record_id string, page_id long, type string, refers_id string, digest string, payload_bytes long, verified boolean, copies long"
    found = st.put("messages", joined.mapInArrow(_assembler, ddl))
    target = found.where("type = 'response'").select(F.col("record_id").alias("refers_id"), F.col("page_id").alias("to_page"),
                                                     F.col("payload_bytes").alias("to_bytes"), F.col("digest").alias("to_digest"))
    again = found.where("type = 'revisit'").join(target, "refers_id", "left")
    own = found.where("type IS NULL OR type <> 'revisit'")
    every = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return own.select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"),
                      F.lit(None).cast("long").alias("refers_to"), "verified", every.alias("_copy")).unionByName(
        again.select("page_id", F.col("to_bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
                     F.col("type").alias("record_type"), F.col("to_page").alias("refers_to"),
                     F.coalesce(F.col("verified") & (F.col("digest") == F.col("to_digest")), F.lit(False)).alias("verified"),
                     every.alias("_copy"))).drop("_copy")
