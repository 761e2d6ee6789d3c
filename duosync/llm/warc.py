"""WARC archives: writing with segmentation, and reading with segment reassembly.

Writing. Each page becomes a record whose block is an HTTP response in chunked transfer coding.
A block longer than ``segment_bytes`` is cut: the first segment keeps the record's own type, the rest are
``continuation`` records that name the first one's id and their number; the last carries the
total length. Segments may stand in any archive, before or after each other. A payload that
another record holds already is written as a ``revisit`` that names the record.

Reading. Archives are read one by one and give a row per record. Continuations are grouped with
their first segment by its id, put in the order of their numbers and checked against the total
length; then the transfer coding is taken off and the payload checked against its digest.

Archives are written by Spark's text writer, so they can be in any store that Spark writes to:
a row is one archive's bytes, the line separator is the separator that ends a WARC record.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duosync.llm.common import Scratch

END = b"\r\n\r\n"
SEGMENT_BYTES = 64 << 10
ARCHIVE_BYTES = 16 << 20
CHUNK_BYTES = 8 << 10
# Payloads shorter than this are always stored.
REVISIT_BYTES = 1000
DATE = "1970-01-01T00:00:00Z"
SPACE = uuid.UUID("5b1f0e0e-3f0c-5d58-9a4e-0d8f6ce0c0de")

RECORD = (
    "type string, id string, origin string, number int, total long, uri string, page_id long,"
    " digest string, payload_type string, block binary"
)


def record_id(*parts: object) -> str:
    """A record's name, the same whenever the job runs again."""
    return f"<urn:uuid:{uuid.uuid5(SPACE, ' '.join(map(str, parts)))}>"


def header(fields: list[tuple[str, object]]) -> bytes:
    """A record's header; values keep to one line."""
    lines = [f"{k}: {' '.join(str(v).split())}\r\n" for k, v in fields if v is not None]
    return ("WARC/1.1\r\n" + "".join(lines) + "\r\n").encode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer coding."""
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """The payload under chunked transfer coding; chunk extensions and trailers are left out."""
    out, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        if line < 0:
            raise ValueError("a chunk without a size line")
        size = int(body[at:line].split(b";")[0].strip(), 16)
        at = line + 2
        if not size:
            return b"".join(out)
        if len(body) < at + size + 2 or body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk that is shorter than its size")
        out.append(body[at : at + size])
        at += size + 2


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response."""
    head, found, body = block.partition(END)
    if not found:
        raise ValueError("an HTTP response without an end of its header")
    fields = dict(
        (k.strip().lower(), v.strip().lower())
        for k, _, v in (line.partition(b":") for line in head.split(b"\r\n")[1:])
    )
    return dechunked(body) if fields.get(b"transfer-encoding") == b"chunked" else body


def records_of(page: dict, segment_bytes: int) -> Iterator[bytes]:
    """A page's records as bytes, each without the separator that ends it."""
    uri, page_id, place = page["url"], page["page_id"], page["place"]
    name = record_id("record", place)
    digest = "sha1:" + base64.b32encode(bytes.fromhex(page["payload_digest"])).decode()
    common = [("WARC-Target-URI", uri or "urn:none"), ("WARC-Date", DATE)]
    first = [("X-Page-Id", page_id), ("WARC-Payload-Digest", digest)]
    if page["refers_to"] is not None:
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8" + END
        kind = [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To-Target-URI", page["refers_uri"] or "urn:none"),
        ]
        yield header(
            [
                ("WARC-Type", "revisit"),
                ("WARC-Record-ID", name),
                *common,
                *first,
                *kind,
                ("Content-Type", "application/http;msgtype=response"),
                ("Content-Length", len(block)),
            ]
        ) + block
        return
    block = (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        b"Transfer-Encoding: chunked" + END + chunked((page["html"] or "").encode())
    )
    starts = range(0, len(block), segment_bytes)
    for number, start in enumerate(starts, 1):
        part = block[start : start + segment_bytes]
        fields = [("WARC-Type", "response" if number == 1 else "continuation")]
        fields += [("WARC-Record-ID", name if number == 1 else record_id("part", place, number))]
        fields += common
        if number == 1:
            fields += [*first, ("Content-Type", "application/http;msgtype=response")]
        if len(starts) > 1:
            fields += [("WARC-Segment-Number", number)]
        if number > 1:
            fields += [("WARC-Segment-Origin-ID", name)]
        if len(starts) == number > 1:
            fields += [("WARC-Segment-Total-Length", len(block))]
        yield header([*fields, ("Content-Length", len(part))]) + part


def _archives(segment_bytes: int, archive_bytes: int):
    """Pages to archives of about ``archive_bytes``, each one row without its last separator."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, made, parts, size, place = TaskContext.get().partitionId(), 0, [], 0, 0

        def flush():
            nonlocal made, parts, size
            info = header(
                [
                    ("WARC-Type", "warcinfo"),
                    ("WARC-Record-ID", record_id("info", task, made)),
                    ("WARC-Date", DATE),
                    ("Content-Type", "application/warc-fields"),
                    ("Content-Length", len(text := b"format: WARC File Format 1.1\r\n")),
                ]
            )
            raw = pa.array([END.join([info + text, *parts])], pa.binary())
            made, parts, size = made + 1, [], 0
            return pa.RecordBatch.from_arrays([raw], ["value"])

        for batch in batches:
            for page in batch.to_pylist():
                # A retry writes the whole task's archives anew, so places name one record each.
                place += 1
                page["place"] = f"{task} {place}"
                for record in records_of(page, segment_bytes):
                    parts.append(record)
                    size += len(record)
                    if size >= archive_bytes:
                        yield flush()
        if parts:
            yield flush()

    return run


def write_archives(
    records: DataFrame,
    path: str,
    segment_bytes: int = SEGMENT_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """Write ``plan_records`` rows as gzip WARC files in folder ``path``."""
    raw = records.mapInArrow(_archives(segment_bytes, archive_bytes), "value binary")
    (
        raw.select(F.col("value").cast("string"))
        .write.option("lineSep", END.decode())
        .option("compression", "gzip")
        .option("maxRecordsPerFile", 1)
        .text(path)
    )


def plan_records(pages: DataFrame, scratch: Scratch, least: int = REVISIT_BYTES) -> DataFrame:
    """Pages with their digest and, where a page is to be a revisit, the page it refers to.

    Digests are grouped without the pages' texts, with a maximum that is taken before the
    shuffle; only groups of two or more come back to their pages. The one shuffle of texts is by
    page and digest, so a payload that a third of all pages have is spread over all tasks.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    source = pages.select(
        F.col("page_id").cast("long"),
        F.col("url").cast("string"),
        F.sha1(html.cast("binary")).alias("payload_digest"),
        html.alias("html"),
    )
    keys = source.filter(F.octet_length("html") >= least).select("page_id", "url", "payload_digest")
    keys = scratch(keys)
    last = (
        keys.groupBy("payload_digest")
        .agg(F.max(F.struct("page_id", "url")).alias("last"), F.count("*").alias("n"))
        .filter("n > 1")
        .selectExpr("payload_digest", "last.page_id AS refers_to", "last.url AS refers_uri")
    )
    revisits = (
        keys.join(last, "payload_digest")
        .filter("refers_to IS NOT NULL AND NOT page_id <=> refers_to")
        .select(
            F.col("page_id").alias("_page"),
            F.col("payload_digest").alias("_digest"),
            "refers_to",
            "refers_uri",
        )
        .distinct()
    )
    same = F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("payload_digest") == F.col("_digest"))
    return source.join(revisits, same, "left").drop("_page", "_digest")


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Archives (binary files) to records; memory holds one archive's compressed bytes."""
    names = [f.split()[0] for f in RECORD.split(", ")]
    kinds = [
        pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64(),
        pa.string(), pa.string(), pa.binary(),
    ]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
        )

    for batch in batches:
        for content in batch.column(0):
            rows, size = [], 0
            for fields, block in read_records(content.as_py()):
                number, total = (
                    fields.get("warc-segment-number"),
                    fields.get("warc-segment-total-length"),
                )
                page = fields.get("x-page-id")
                rows.append(
                    (
                        fields.get("warc-type"),
                        fields.get("warc-record-id"),
                        fields.get("warc-segment-origin-id"),
                        number and int(number),
                        total and int(total),
                        fields.get("warc-target-uri"),
                        page and int(page),
                        fields.get("warc-payload-digest"),
                        fields.get("content-type"),
                        block,
                    )
                )
                size += len(block)
                if size >= 4 << 20:
                    yield batch_of(rows)
                    rows, size = [], 0
            if rows:
                yield batch_of(rows)


def read_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of an archive, plain or gzip of any members.

    Blocks are cut by their declared length, so a block may hold what looks like a record.
    """
    buffer, at = memoryview(content), 0
    zipped = content[:2] == b"\x1f\x8b"
    reader = _Inflated(content) if zipped else None

    def take(n: int) -> bytes:
        nonlocal at
        if reader:
            return reader.read(n)
        at += n
        return bytes(buffer[at - n : at])

    def line() -> bytes:
        nonlocal at
        if reader:
            return reader.line()
        end = content.find(b"\n", at) + 1 or len(content)
        at, start = end, at
        return content[start:end]

    while True:
        version = line()
        while version in (b"\r\n", b"\n"):
            version = line()
        if not version:
            return
        if not version.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {version[:40]!r}")
        fields: dict[str, str] = {}
        while (text := line()).strip():
            key, _, value = text.decode("utf-8", "replace").partition(":")
            fields[key.strip().lower()] = value.strip()
        length = int(fields.get("content-length", -1))
        block = take(max(length, 0))
        if len(block) != length:
            raise ValueError(f"record {fields.get('warc-record-id')} is cut short")
        yield fields, block


class _Inflated:
    """Lines and bytes of a gzip file, unpacked as they are needed."""

    STEP = 1 << 18

    def __init__(self, content: bytes):
        self.rest, self.buffer, self.at = content, b"", 0
        self.unzip = zlib.decompressobj(31)

    def more(self) -> bool:
        while self.rest:
            out = self.unzip.decompress(self.rest, self.STEP)
            self.rest = self.unzip.unconsumed_tail
            if self.unzip.eof:
                self.rest = self.unzip.unused_data
                self.unzip = zlib.decompressobj(31)
            if out:
                self.buffer = self.buffer[self.at :] + out
                self.at = 0
                return True
        return False

    def read(self, n: int) -> bytes:
        parts, need = [], n
        while need:
            part = self.buffer[self.at : self.at + need]
            self.at += len(part)
            need -= len(part)
            parts.append(part)
            if need and not self.more():
                break
        return b"".join(parts)

    def line(self) -> bytes:
        parts = []
        while True:
            end = self.buffer.find(b"\n", self.at) + 1
            if end:
                parts.append(self.buffer[self.at : end])
                self.at = end
                return b"".join(parts)
            parts.append(self.buffer[self.at :])
            self.at = len(self.buffer)
            if not self.more():
                return b"".join(parts)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives in a folder, segments as they stand: see ``RECORD``."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_parse, RECORD)


def reassemble(records: DataFrame) -> DataFrame:
    """Whole records: (id, type, uri, page_id, digest, block, fault).

    Records in one piece pass through. Segments are grouped by their origin's id and joined in
    the order of their numbers; a copy of a segment counts once. ``fault`` says why a record
    isn't whole: no first segment, a missing number, no last segment or another total length;
    its block is then null. A group holds the segments of one record.
    """
    whole = records.filter("origin IS NULL AND number IS NULL")
    parts = records.filter("origin IS NOT NULL OR number IS NOT NULL")
    segment = F.struct(F.coalesce("number", F.lit(1)).alias("number"), F.col("block").alias("block"))
    first = [
        F.max(F.when(F.col("origin").isNull(), F.col(c))).alias(c)
        for c in ("type", "uri", "page_id", "digest")
    ]
    groups = (
        parts.groupBy(F.coalesce("origin", "id").alias("id"))
        .agg(
            F.array_sort(F.collect_set(segment)).alias("parts"), F.max("total").alias("total"), *first
        )
        # Strings join in one pass, and a cast leaves the bytes as they are.
        .withColumn(
            "joined",
            F.expr("CAST(array_join(transform(parts, p -> CAST(p.block AS STRING)), '') AS BINARY)"),
        )
        .withColumn(
            "fault",
            F.expr(
                "CASE WHEN parts[0].number <> 1 OR type IS NULL THEN 'no first segment'"
                " WHEN total IS NULL THEN 'no last segment'"
                " WHEN element_at(parts, -1).number <> size(parts) THEN 'missing segment'"
                " WHEN octet_length(joined) <> total THEN 'wrong total length' END"
            ),
        )
        .withColumn("block", F.expr("IF(fault IS NULL, joined, NULL)"))
    )
    columns = ["id", "type", "uri", "page_id", "digest", "block", "fault"]
    return whole.withColumn("fault", F.lit(None).cast("string")).select(columns).unionByName(
        groups.select(columns)
    )


PAYLOAD = "id string, type string, uri string, page_id long, payload_bytes long"
PAYLOAD += ", payload_digest string, fault string"


def _payloads(keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                declared = (r["digest"] or "").removeprefix("sha1:")
                declared = base64.b32decode(declared).hex() if declared else None
                size, payload, fault = None, None, r["fault"]
                if r["type"] == "response" and not fault:
                    try:
                        payload = payload_of(r["block"])
                        size = len(payload)
                        found = hashlib.sha1(payload).hexdigest()
                        if declared not in (None, found):
                            fault = "wrong digest"
                        declared = found
                    except ValueError as error:
                        fault = str(error)
                row = [r["id"], r["type"], r["uri"], r["page_id"], size, declared]
                out.append((*row, fault, *([payload] if keep else [])))
            names = [f.split()[0] for f in PAYLOAD.split(", ")] + ["payload"] * keep
            text, number = pa.string(), pa.int64()
            kinds = [text, text, text, number, number, text, text] + [pa.binary()] * keep
            columns = zip(*out, strict=True) if out else [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
            )

    return run


def payloads(records: DataFrame, keep: bool = True) -> DataFrame:
    """Decode whole ``response`` and ``revisit`` records; with ``keep`` the payload's bytes too.

    The payload comes out of its transfer coding and is checked against the declared digest; a
    record that can't be decoded has a ``fault`` and no payload. A revisit has none of its own.
    """
    found = records.filter("type IN ('response', 'revisit')")
    return found.mapInArrow(_payloads(keep), PAYLOAD + ", payload binary" * keep)


def archive_pages(pages: DataFrame, scratch: Scratch, least: int = REVISIT_BYTES) -> DataFrame:
    """Write all pages as WARC records, read the archives back, and report each page.

    Of pages with an equal payload of at least ``least`` bytes the one with the largest page_id
    is stored and the others refer to it; rows that repeat that page are each stored. A revisit
    finds its page by the digest. Null html is an empty payload. Rows that share a page_id are records of
    their own; a null id counts as the smallest. An empty table gives no rows. Only ``page_id``, ``url`` and ``html`` are read.
    """
    spark = pages.sparkSession
    path = f"{scratch.folder}/warc"
    write_archives(plan_records(pages, scratch, least), path)
    decoded = scratch(payloads(reassemble(read_archives(spark, path)), keep=False))
    faults = decoded.filter("fault IS NOT NULL").select("id", "fault").take(5)
    if faults:
        raise ValueError(f"archives do not read back whole: {faults}")
    own = decoded.filter("type = 'response'")
    held = (
        own.filter(F.col("payload_bytes") >= least)
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias("refers_to"), F.max("payload_bytes").alias("payload_bytes"))
    )
    revisit = (
        decoded.filter("type = 'revisit'")
        .select("page_id", "payload_digest", F.col("type").alias("record_type"))
        .join(held, "payload_digest", "left")
        .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    )
    response = own.selectExpr(
        "page_id",
        "payload_bytes",
        "payload_digest",
        "type AS record_type",
        "CAST(NULL AS BIGINT) AS refers_to",
    )
    return response.unionByName(revisit)


