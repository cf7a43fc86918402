"""WARC archives: pages to records, long records in segments, and back.

Writing. Each page is one record whose block is an HTTP response in chunked transfer framing. Of pages with one payload of
1,000 bytes or more, that with the largest id is the response and the others are revisits without a payload. A block over
``SEGMENT_BYTES`` goes into several records: the first one, and continuations that name it as their origin, number themselves
and, the last, tell the total length. Spark's text writer puts records into gzip files in a shared folder, ``FILE_RECORDS`` a
file, so segments of a page may lie in several files.

Reading. Files are streamed record by record inside tasks, and records leave the task in batches of bounded bytes. A whole record is
decoded there; segments are grouped by origin,
ordered by number, checked for gaps and total length, joined, and then decoded. A revisit takes the size of its payload from the
response it refers to. A record that fails its checks comes back as ``incomplete``, without payload.

Nulls: a null html is empty; a null url is recorded as none; a page without an id is a record without one. Rows that repeat are
records of their own; if they share the largest id, each is a response. An empty table gives archives without records and no rows.
Only ``page_id``, ``url`` and ``html`` are read. One page is one row, so a page's payload is the largest unit in memory.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from simsearch.llm.common import SLICE_BYTES, bounded_broadcast, map_slices, shared_folder, stored, table
from simsearch.session import checkpoint

REVISIT_BYTES = 1000
HOT_COPIES = 10_000
SEGMENT_BYTES, CHUNK_BYTES = 64 << 10, 8 << 10
FILE_RECORDS = 2048  # of a segment's length at most: 128 MB before compression
# Fixed values of the format.
VERSION, LINE, RECORD_END = "WARC/1.1", "\r\n", "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
READ_BYTES = 1 << 20


def decide(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest, refers_to (null for a response)."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.select("*", F.sha1("payload").alias("digest"), F.length("payload").alias("size"))
    groups = (
        rows.where(F.col("size") >= REVISIT_BYTES)
        .groupBy(F.col("digest").alias("g_digest"), F.col("size").alias("g_size"))
        .agg(F.max("page_id").alias("owner"), F.count("*").alias("n"))
        .where("n > 1")
    )
    groups = stored(groups)
    same = (F.col("digest") == F.col("g_digest")) & (F.col("size") == F.col("g_size"))
    # payloads that very many pages share are few, one for HOT_COPIES rows at most: they are sent to the rows, and these stay where they are
    hot = groups.where(F.col("n") > HOT_COPIES)
    hot = bounded_broadcast(hot, hot.count())
    rest = rows.join(hot, same, "left_anti").join(groups.where(F.col("n") <= HOT_COPIES), same, "left")
    joined = rest.unionByName(rows.join(hot, same))
    other = F.col("owner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("owner"))
    return joined.select("page_id", "url", "payload", "digest", F.when(other, F.col("owner")).alias("refers_to"))


def cuts(data: bytes, size: int) -> Iterator[bytes]:
    """Parts of about ``size`` bytes that end between characters."""
    at = 0
    while at < len(data):
        end = min(len(data), at + size)
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end += 1
        yield data[at:end]
        at = end


def chunked(payload: bytes) -> bytes:
    parts = [b"%x\r\n%s\r\n" % (len(c), c) for c in cuts(payload, CHUNK_BYTES)]
    return HTTP_HEAD + b"".join(parts) + b"0\r\n\r\n"


def dechunked(block: bytes) -> bytes:
    """The payload of an HTTP block; raises ValueError on broken framing."""
    at = block.index(b"\r\n\r\n") + 4
    parts = []
    while True:
        end = block.index(b"\r\n", at)
        size = int(block[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(parts)
        if block[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk without its end")
        parts.append(block[at : at + size])
        at += size + 2


def _record(headers: list[tuple[str, object]], block: bytes) -> str:
    lines = [VERSION, *[f"{k}: {v}" for k, v in headers if v is not None], f"Content-Length: {len(block)}"]
    return LINE.join(lines) + RECORD_END + block.decode()


def _records(number: int, page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> Iterator[str]:
    own = f"<urn:record:{number}>"
    safe = None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    common = [("WARC-Record-ID", own), ("WARC-Page-ID", page_id), ("WARC-Target-URI", safe), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if refers_to is not None:
        yield _record([("WARC-Type", "revisit"), *common, ("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")], b"")
        return
    block = chunked(payload)
    parts = list(cuts(block, SEGMENT_BYTES))
    if len(parts) == 1:
        yield _record([("WARC-Type", "response"), *common], block)
        return
    for i, part in enumerate(parts, 1):
        last = len(block) if i == len(parts) else None
        if i == 1:
            yield _record([("WARC-Type", "response"), *common, ("WARC-Segment-Number", 1)], part)
        else:
            yield _record(
                [
                    ("WARC-Type", "continuation"),
                    ("WARC-Record-ID", f"<urn:record:{number}:{i}>"),
                    ("WARC-Segment-Origin-ID", own),
                    ("WARC-Segment-Number", i),
                    ("WARC-Segment-Total-Length", last),
                ],
                part,
            )


def write(pages: DataFrame, path: str) -> None:
    """The pages as gzip archives in ``path``."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = zip(*[batch.column(c).to_pylist() for c in ("number", "page_id", "url", "payload", "digest", "refers_to")], strict=True)
        return pa.RecordBatch.from_arrays([pa.array([r for row in rows for r in _records(*row)], pa.string())], ["value"])

    rows = decide(pages).select("*", F.monotonically_increasing_id().alias("number"))
    records = map_slices(rows, "payload", work, "value string")
    records.write.option("lineSep", RECORD_END).option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(path)


def _parsed(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of a gzip file; holds one record and a read-ahead at a time."""
    source, held, at = _inflated(content), b"", 0

    def more() -> bool:
        nonlocal held, at
        piece = next(source, None)
        if piece is None:
            return False
        held, at = held[at:] + piece, 0
        return True

    while True:
        while (end := held.find(b"\r\n\r\n", at)) < 0:
            if not more():
                if held[at:].strip():
                    raise ValueError("an archive ends inside a record's header")
                return
        lines = held[at:end].decode().split(LINE)
        if lines[0] != VERSION:
            raise ValueError(f"no record starts here: {lines[0][:40]!r}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        size = int(fields["Content-Length"])
        at = end + 4
        while len(held) - at < size + 4:
            if not more():
                raise ValueError("an archive ends inside a record")
        yield fields, held[at : at + size]
        at += size + 4


def _inflated(content: bytes) -> Iterator[bytes]:
    machine, rest = zlib.decompressobj(31), content
    while rest:
        piece = machine.decompress(rest, READ_BYTES)
        if piece:
            yield piece
        rest = machine.unconsumed_tail
        if machine.eof:
            rest = machine.unused_data
            machine = zlib.decompressobj(31)


FIELDS = (
    "origin string, page_id bigint, record_type string, refers_to bigint, payload_digest string, segment int, total bigint, "
    "block binary, payload binary, payload_bytes bigint, computed string"
)


def read(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """page_id, record_type, refers_to, payload_bytes, payload_digest and, if asked for, payload: one row a page."""
    number = lambda x: None if x is None else int(x.rsplit(":", 1)[1].rstrip(">"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for content in (c.as_py() for batch in batches for c in batch.column("content")):
            for f, block in _parsed(content):
                kind, segment = f["WARC-Type"], f.get("WARC-Segment-Number")
                origin = f.get("WARC-Segment-Origin-ID", f["WARC-Record-ID"])
                page = f.get("WARC-Page-ID")
                row = [origin, page and int(page), None if kind == "continuation" else kind, number(f.get("WARC-Refers-To")),
                       f.get("WARC-Payload-Digest", "").removeprefix("sha1:") or None, segment and int(segment),
                       f.get("WARC-Segment-Total-Length") and int(f["WARC-Segment-Total-Length"])]
                if segment:
                    row += [block, None, None, None]
                elif kind == "response":
                    row += [None, *_decoded(block)]
                else:
                    row += [None, None, None, None]
                rows.append(row)
                held += len(row[7] or row[8] or b"") + 200
                if held >= SLICE_BYTES:
                    yield _batch(rows)
                    rows, held = [], 0
        yield _batch(rows)

    def _decoded(block: bytes) -> tuple[bytes | None, int, str]:
        payload = dechunked(block)
        return payload if with_payload else None, len(payload), hashlib.sha1(payload).hexdigest()

    def _batch(rows: list[list]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.string()]
        names = [f.split()[0] for f in FIELDS.split(", ")]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    records = files.mapInArrow(parse, FIELDS)
    part = F.when(F.col("segment").isNotNull(), F.struct("segment", "block"))
    pages = records.groupBy("origin").agg(
        *[F.max(c).alias(c) for c in ("page_id", "record_type", "refers_to", "payload_digest", "total", "payload_bytes", "computed")],
        F.first("payload", ignorenulls=True).alias("payload"),
        F.sort_array(F.collect_list(part)).alias("parts"),
    )

    def rejoin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                out = []
                for r in batch.slice(at, 256).to_pylist():
                    kind, payload, size, computed = r["record_type"], r["payload"], r["payload_bytes"], r["computed"]
                    if r["parts"]:
                        block = b"".join(p["block"] for p in r["parts"])
                        whole = [p["segment"] for p in r["parts"]] == list(range(1, len(r["parts"]) + 1)) and len(block) == r["total"]
                        try:
                            payload, size, computed = _decoded(block) if whole else (None, None, None)
                        except ValueError:
                            payload, size, computed = None, None, None
                    if kind != "revisit" and (computed is None or computed != r["payload_digest"]):
                        kind, payload, size = "incomplete", None, None
                    out.append((r["page_id"], kind, r["refers_to"], size, r["payload_digest"], payload))
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
                names = ["page_id", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    schema = "page_id bigint, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary"
    done = pages.mapInArrow(rejoin, schema)
    return done if with_payload else done.drop("payload")


def resolve(records: DataFrame) -> DataFrame:
    """Gives each revisit the payload size of the response it refers to; sizes are counted once per response."""
    records = checkpoint(records)
    sizes = (
        records.where((F.col("record_type") == "response") & (F.col("payload_bytes") >= REVISIT_BYTES))
        .groupBy(F.col("page_id").alias("r_page"), F.col("payload_digest").alias("r_digest"))
        .agg(F.max("payload_bytes").alias("r_bytes"))
    )
    revisits = records.where("record_type = 'revisit'")
    told = revisits.join(sizes, (F.col("refers_to") == F.col("r_page")) & (F.col("payload_digest") == F.col("r_digest")), "left")
    told = told.select(*[F.coalesce("payload_bytes", "r_bytes").alias(c) if c == "payload_bytes" else F.col(c) for c in records.columns])
    return records.where("record_type <> 'revisit'").unionByName(told)


def op10_warc(spark, sf_dir):
    path = shared_folder(spark, "warc")
    write(table(spark, sf_dir, "pages"), path)
    found = resolve(read(spark, path, with_payload=False))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages),
o AS (SELECT d, max(page_id) AS owner FROM p WHERE n >= 1000 GROUP BY d)
SELECT page_id, n::BIGINT AS payload_bytes, p.d AS payload_digest,
    CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM owner THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM owner THEN owner END AS refers_to
FROM p LEFT JOIN o ON p.d = o.d
"""
