"""WARC archives: writing with revisits and segmentation, reading with segment reassembly.

Archives are gzip files of WARC 1.1 records in the shared folder.  A payload is carried as an HTTP response
in chunked transfer framing; a block above the segment size is split into a first ``response`` segment and
``continuation`` records.  Reading groups continuations by their origin id, orders them by segment number,
verifies numbers and total length, and decodes the framing.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowguard.llm.common import arrow_rows, bounded_batches, broadcast_if_small, materialize, scratch_path

SEGMENT = 64 << 10  #: bytes of a record's block at most
CHUNK = 16 << 10  #: bytes of a transfer chunk
FILE_RECORDS = 2_000  #: records of one archive file at most, so that a file is at most about 128 MB
REVISIT_BYTES = 1_000  #: payloads from this size on are stored once
DATE = "2024-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(name: str) -> str:
    return f"<urn:page:{name}>"


def named(pages: DataFrame) -> DataFrame:
    """Pages with ``name``, the text that their record is known by: the page_id, with ``#`` and a number where the
    page_id is null or occurs again.

    Only those rows are written down with their numbers, so that a task that runs again finds the same ones.
    """
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    again = pages.where("page_id is not null").groupBy("page_id").agg(F.count("*").alias("n")).where("n > 1").select("page_id")
    again = broadcast_if_small(again, 16)
    missing = F.col("page_id").isNull()
    several = materialize(pages.where(missing).unionByName(pages.join(again, "page_id", "left_semi"))
                          .withColumn("name", F.concat(F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit("#"),
                                                       F.monotonically_increasing_id().cast("string"))))
    one = pages.where(~missing).join(again, "page_id", "left_anti").withColumn("name", F.col("page_id").cast("string"))
    return one.unionByName(several)


def framed(payload: bytes) -> bytes:
    """An HTTP response whose body is the payload in chunked transfer framing."""
    parts = [HTTP]
    for at in range(0, len(payload), CHUNK):
        piece = payload[at:at + CHUNK]
        parts += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unframed(block: bytes) -> bytes | None:
    """The payload of an HTTP response; None where the framing is broken."""
    head, sep, body = block.partition(b"\r\n\r\n")
    if not sep:
        return None
    if b"transfer-encoding: chunked" not in head.lower():
        return body
    parts, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        try:
            size = int(body[at:line].split(b";")[0], 16) if line >= 0 else -1
        except ValueError:
            size = -1
        if size < 0:
            return None
        if size == 0:
            return b"".join(parts)
        at = line + 2
        if body[at + size:at + size + 2] != b"\r\n":
            return None
        parts.append(body[at:at + size])
        at += size + 2


def _record(kind: str, rid: str, block: bytes, **more) -> bytes:
    head = [b"WARC/1.1", f"WARC-Type: {kind}".encode(), f"WARC-Record-ID: {rid}".encode(), f"WARC-Date: {DATE}".encode()]
    head += [f"{k.replace('_', '-')}: {v}".encode() for k, v in more.items() if v is not None]
    if kind in ("response", "revisit"):
        head.append(b"Content-Type: application/http; msgtype=response")
    return b"\r\n".join([*head, b"Content-Length: %d" % len(block), b"", block])


def page_records(name: str, url: str, payload: bytes, segment: int = SEGMENT) -> Iterator[bytes]:
    """The records that carry a page: one response, or its first segment and the continuations."""
    block, rid = framed(payload), record_id(name)
    what = {"WARC_Target_URI": url, "WARC_Payload_Digest": "sha1:" + hashlib.sha1(payload).hexdigest()}
    if len(block) <= segment:
        yield _record("response", rid, block, **what)
        return
    for n, at in enumerate(range(0, len(block), segment), 1):
        piece, last = block[at:at + segment], at + segment >= len(block)
        if n == 1:
            yield _record("response", rid, piece, **what, WARC_Segment_Number=1)
        else:
            yield _record("continuation", record_id(f"{name};{n}"), piece, WARC_Segment_Number=n, WARC_Segment_Origin_ID=rid,
                          WARC_Segment_Total_Length=len(block) if last else None)


def revisits(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """``name, refers_to, digest`` of pages ``page_id, name, html`` whose payload of at least ``least`` bytes another
    page carries that is last by page_id (null first), then name.

    Only digests are shuffled; a payload that a third of all pages share is pre-aggregated by the aggregate
    and splits as a skewed join side.
    """
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    d = (pages.where(F.octet_length("html") >= least)
         .select("page_id", "name", F.sha1(body).alias("digest"), F.octet_length("html").alias("size")))
    last = (d.groupBy("digest", "size").agg(F.max(F.struct("page_id", "name")).alias("last"), F.count("*").alias("n"))
            .where("n > 1").select("digest", "size", F.col("last.name").alias("refers_to")))
    return d.join(last, ["digest", "size"]).where("name <> refers_to").select("name", "refers_to", "digest")


def write_archives(pages: DataFrame, path: str, segment: int = SEGMENT, least: int = REVISIT_BYTES) -> None:
    """Write one record (or segments) per row of ``pages(page_id, url, html)`` below ``path``.

    Null html is an empty payload, a null url is written as an empty target.  Rows of null or repeated page_id are
    records of their own, whose ids hold a number.  Extra columns are ignored.
    """
    spark = pages.sparkSession
    bounded_batches(spark, 256)
    pages = named(pages).select("page_id", "name", F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "").alias("url"), "html")
    again = broadcast_if_small(revisits(pages, least), 128)
    bodies = pages.join(again.select("name"), "name", "left_anti").select("name", "url", "html")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in arrow_rows(batches):
            out = [r for k, u, h in zip(*(b.column(i).to_pylist() for i in range(3)))
                   for r in page_records(k, u, (h or "").encode(), segment)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    def refer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in arrow_rows(batches, 4096):
            out = [_record("revisit", record_id(k), HTTP, WARC_Profile=PROFILE, WARC_Refers_To=record_id(r),
                           WARC_Payload_Digest=f"sha1:{d}") for k, r, d in zip(*(b.column(i).to_pylist() for i in range(3)))]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    records = bodies.mapInArrow(build, "record binary").unionByName(again.mapInArrow(refer, "record binary"))
    # the text writer puts out a value's bytes as they are; the line separator ends a WARC record
    (records.select(F.col("record").cast("string").alias("value")).write.mode("errorifexists")
     .option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(path))


class _Stream:
    """Records of one gzip file, inflated piece by piece."""

    def __init__(self, data: bytes):
        self.data, self.at, self.buffer = memoryview(data), 0, bytearray()
        self.inflate = zlib.decompressobj(31)

    def more(self) -> bool:
        while self.at < len(self.data):
            piece = self.inflate.decompress(self.data[self.at:self.at + 65536])
            self.at += 65536
            if self.inflate.eof and (left := self.inflate.unused_data):  # members may follow one another
                self.at -= len(left)
                self.inflate = zlib.decompressobj(31)
            if piece:
                self.buffer += piece
                return True
        return False

    def records(self) -> Iterator[tuple[dict[str, str], bytes]]:
        while True:
            while self.buffer[:2] == b"\r\n":
                del self.buffer[:2]
            while (end := self.buffer.find(b"\r\n\r\n")) < 0 or self.buffer[:2] == b"\r\n":
                if self.buffer[:2] == b"\r\n" and len(self.buffer) >= 4:
                    del self.buffer[:2]
                    continue
                if not self.more():
                    return
            lines = self.buffer[:end].decode("utf-8", "replace").split("\r\n")
            head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
            size = int(head["content-length"])
            while len(self.buffer) < end + 4 + size and self.more():
                pass
            yield head, bytes(self.buffer[end + 4:end + 4 + size])
            del self.buffer[:end + 4 + size]


_FIELDS = pa.schema([("record_id", pa.string()), ("kind", pa.string()), ("uri", pa.string()), ("refers_to", pa.string()),
                     ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("status", pa.string()),
                     ("origin", pa.string()), ("segment", pa.int64()), ("total", pa.int64()), ("digest", pa.string()), ("block", pa.binary())])
_TYPES = {pa.string(): "string", pa.int64(): "long", pa.binary(): "binary"}


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of the archives below ``path``: ``record_id, kind, uri, refers_to, payload, payload_bytes,
    payload_digest, status, origin, segment, total, digest, block``.

    A record in one piece is decoded at once, its payload left out where not asked for; of a revisit the digest is
    that of its header; a segment has its origin, number, total length and block instead.  Other records are left
    out.  Files are read whole by Spark (the writer bounds their size) and inflated in small pieces.
    """
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0
        for b in batches:
            for i in range(b.num_rows):
                for h, block in _Stream(b.column(0)[i].as_buffer()).records():
                    kind, n, rid = h.get("warc-type"), h.get("warc-segment-number"), h.get("warc-record-id")
                    digest = (h.get("warc-payload-digest") or "").removeprefix("sha1:") or None
                    head = (rid, kind, h.get("warc-target-uri"), h.get("warc-refers-to"))
                    if n is not None:
                        total = h.get("warc-segment-total-length")
                        rows.append((*head, None, None, None, None, h.get("warc-segment-origin-id") or rid, int(n), int(total) if total else None, digest, block))
                        held += len(block)
                    elif kind == "response":
                        body, size, sum_, status = decoded(block, digest)
                        rows.append((*head, body if payloads else None, size, sum_, status, None, None, None, None, None))
                        held += len(body or b"") if payloads else 200
                    elif kind == "revisit":
                        rows.append((*head, None, None, digest, "ok", None, None, None, None, None))
                        held += 200
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _FIELDS)], schema=_FIELDS)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _FIELDS)], schema=_FIELDS)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(parse, ", ".join(f"{f.name} {_TYPES[f.type]}" for f in _FIELDS))


def decoded(block: bytes | None, digest: str | None) -> tuple[bytes | None, int | None, str | None, str]:
    """The payload of a whole block, its size and digest, and the status."""
    body = None if block is None else unframed(block)
    if body is None:
        return None, None, None, "broken"
    sum_ = hashlib.sha1(body).hexdigest()
    return body, len(body), sum_, "ok" if digest in (None, sum_) else "digest differs"


_RESULT = ("record_id", "kind", "uri", "refers_to", "payload", "payload_bytes", "payload_digest", "status")


def reassembled(pieces: DataFrame, payloads: bool = True) -> DataFrame:
    """The records whose segments ``record_id, kind, uri, refers_to, origin, segment, total, digest, block`` meet by origin.

    They are ordered by number; numbers must run from 1 without a gap or a double, and the lengths must add up to
    the total, or the record is ``broken``.  A group is as large as its payload.
    """
    numbered = (pieces.groupBy("origin", "segment")
                .agg(F.count("*").alias("copies"), F.max(F.when(F.col("segment") == 1, F.col("uri"))).alias("uri"),
                     F.max(F.when(F.col("segment") == 1, F.col("digest"))).alias("digest"), F.max("refers_to").alias("refers_to"),
                     F.max("total").alias("total"), F.max("block").alias("block")))
    joined = numbered.groupBy("origin").agg(
        F.max("uri").alias("uri"), F.max("digest").alias("digest"), F.max("refers_to").alias("refers_to"), F.max("total").alias("total"),
        F.min("segment").alias("first"), F.max("segment").alias("last"), F.count("*").alias("n"), F.max("copies").alias("copies"),
        F.sum(F.octet_length("block")).alias("size"), F.array_sort(F.collect_list(F.struct("segment", "block"))).alias("parts"))
    whole = F.expr("coalesce(total = size and first = 1 and last = n and copies = 1, false)")
    blocks = joined.select(F.col("origin").alias("record_id"), F.lit("response").alias("kind"), "uri", "refers_to", "digest",
                           F.when(whole, F.array_join(F.transform("parts", lambda p: p["block"].cast("string")), "").cast("binary")).alias("block"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in arrow_rows(batches):
            got = [decoded(x, d) for x, d in zip(b.column("block").to_pylist(), b.column("digest").to_pylist())]
            body, size, sums, status = zip(*got) if got else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in _RESULT[:4]), pa.array(body if payloads else [None] * len(body), pa.binary()), pa.array(size, pa.int64()),
                 pa.array(sums, pa.string()), pa.array(status, pa.string())], list(_RESULT))

    return blocks.mapInArrow(run, ", ".join(f"{f.name} {_TYPES[f.type]}" for f in list(_FIELDS)[:8]))


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per response: ``record_id, kind, uri, refers_to, payload, payload_bytes, payload_digest, status``;
    and one per revisit, with a null payload and the digest of its header.

    status: ``ok``; ``broken`` where segments are missing, doubled or of another total length, or the framing
    is wrong (payload null); ``digest differs``.  Segments of a record meet in one group, which is as large
    as the payload itself; records in one piece are not shuffled.  Without payloads the archives are inflated once
    and what was read is kept; with them once for records in one piece and once for segments.
    """
    rows = read_records(spark, path, payloads)
    if not payloads:
        rows = materialize(rows)
    return rows.where("segment is null").select(*_RESULT).unionByName(reassembled(rows.where("segment is not null"), payloads))


def page_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per page: page_id, payload_bytes, payload_digest, record_type, refers_to, status.

    A revisit takes size and digest from the response that it refers to; where that is missing or has another
    digest its status is ``unresolved`` and the two are null.
    """
    page = lambda c: F.expr(f"try_cast(regexp_extract({c}, '^<urn:page:(-?[0-9]*)(#[0-9]+)?>$', 1) as long)")
    rows = materialize(read_archives(spark, path, payloads=False).select(
        "record_id", page("record_id").alias("page_id"), "kind", "refers_to", "payload_bytes", "payload_digest", "status"))
    bodies, marks = rows.where("kind = 'response'"), rows.where("kind = 'revisit'")
    known = bodies.select(F.col("record_id").alias("refers_to"), F.col("payload_bytes").alias("size"), F.col("payload_digest").alias("sum"))
    found = marks.join(known, "refers_to", "left").select(
        "page_id", F.expr("if(sum = payload_digest, size, null)").alias("payload_bytes"),
        F.expr("if(sum = payload_digest, sum, null)").alias("payload_digest"), F.lit("revisit").alias("record_type"),
        page("refers_to").alias("refers_to"), F.expr("if(coalesce(sum = payload_digest, false), 'ok', 'unresolved')").alias("status"))
    return bodies.select("page_id", "payload_bytes", "payload_digest", F.lit("response").alias("record_type"),
                         F.lit(None).cast("long").alias("refers_to"), "status").unionByName(found)


def archive_pages(pages: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Write the pages as archives in the shared folder and read them back."""
    path = scratch_path(pages.sparkSession, "warc")
    write_archives(pages, path, segment)
    return page_digests(pages.sparkSession, path)
