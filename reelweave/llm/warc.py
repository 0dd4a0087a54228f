"""Writing pages as WARC archives, and reading archives back with segment reassembly.

Method: pages with equal payloads are grouped by digest; the one with the largest id is stored, the others revisit it. A page's
block is an HTTP response with chunked transfer framing; a block longer than a segment becomes a first record and
continuation records, which name the first as their origin. Reading cuts archives by record lengths, groups continuation
records by origin identifier, orders them by segment number, verifies the total length, and decodes the chunked framing.

Archives are written by Spark's text writer, whose commit protocol drops the files of lost tasks; the two line ends behind
every record are its line separator, and each file is one gzip stream.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelweave.session import handoff

SEGMENT_BYTES = 1 << 16
CHUNK_BYTES = 1 << 13
RECORDS_PER_FILE = 4000
DATE = "2024-01-01T00:00:00Z"  # pages carry no date of their own; reruns write the same archives
END = b"\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DIGITS, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_digest(payload: Column) -> Column:
    """Base32 of the SHA-1 of a binary column: 20 bits of the hexadecimal digest are four letters."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), DIGITS, BASE32)


def clean_uri(uri: str | None) -> str:
    """A header value cannot hold control characters or spaces; they are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", uri or "")


def record_id(page_id: int | None, uri: str | None, digest: str) -> str:
    name = hashlib.sha1(f"{uri}\n{digest}".encode()).hexdigest()[:16]
    return f"<urn:page:{'' if page_id is None else page_id}:{name}>"


def chunked(payload: bytes) -> bytes:
    parts = [payload[k : k + CHUNK_BYTES] for k in range(0, len(payload), CHUNK_BYTES)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes | None:
    """The payload of a chunked body, or None if the framing is broken. Extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        line = body.find(END, at)
        size = re.match(rb"\s*([0-9A-Fa-f]+)\s*(;|$)", body[at:line]) if line >= 0 else None
        if not size:
            return None
        length, at = int(size[1], 16), line + 2
        if length == 0:
            return b"".join(out)
        if body[at + length : at + length + 2] != END:
            return None
        out.append(body[at : at + length])
        at += length + 2


def record(headers: dict[str, str], block: bytes) -> bytes:
    """A record without the two line ends behind it."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers.items()), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + END + END + block


def page_records(page: dict, segment_bytes: int) -> Iterator[bytes]:
    uri, payload, digest = clean_uri(page["url"]), page["payload"], page["digest"]
    own = record_id(page["page_id"], page["url"], digest)
    common = {"WARC-Date": DATE, "WARC-Target-URI": uri, "WARC-Payload-Digest": f"sha1:{digest}"}
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if page["stored"] is not None:
        stored = page["stored"]
        yield record(
            {"WARC-Type": "revisit", "WARC-Record-ID": own, **common, "WARC-Profile": PROFILE,
             "WARC-Refers-To": record_id(stored["page_id"], stored["url"], digest),
             "WARC-Refers-To-Target-URI": clean_uri(stored["url"]), "Content-Type": "application/http; msgtype=response"},
            f"{http}Content-Length: {len(payload)}\r\n\r\n".encode(),
        )
        return
    block = f"{http}Transfer-Encoding: chunked\r\n\r\n".encode() + chunked(payload)
    parts = [block[k : k + segment_bytes] for k in range(0, len(block), segment_bytes)]
    first = {"WARC-Type": "response", "WARC-Record-ID": own, **common, "Content-Type": "application/http; msgtype=response"}
    if len(parts) == 1:
        yield record(first, block)
        return
    yield record({**first, "WARC-Segment-Number": "1"}, parts[0])
    for number, part in enumerate(parts[1:], 2):
        headers = {
            "WARC-Type": "continuation", "WARC-Record-ID": f"{own[:-1]}:{number}>", "WARC-Date": DATE, "WARC-Target-URI": uri,
            "WARC-Segment-Origin-ID": own, "WARC-Segment-Number": str(number),
        }
        if number == len(parts):
            headers["WARC-Segment-Total-Length"] = str(len(block))
        yield record(headers, part)


def write_archives(
    pages: DataFrame, path: str, min_bytes: int = 0, segment_bytes: int = SEGMENT_BYTES, records_per_file: int = RECORDS_PER_FILE
) -> None:
    """Writes ``page_id, url, html`` rows as archives below a new folder; other columns are ignored.

    A null html is an empty payload, a null url an empty target. Payloads of at least ``min_bytes`` are stored once: by the
    row with the largest page_id, of equal ids the one with the largest url; fully equal rows of that kind are all stored.
    A null page_id is smaller than all others. An empty table writes no record.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumn("digest", base32_digest(F.col("payload")))
    same = rows.where(F.length("payload") >= min_bytes).groupBy("digest")
    # no null in front of the comparison: a struct with null fields is smaller than one without
    stored = same.agg(F.max(F.struct("page_id", "url")).alias("stored"), F.count("*").alias("n")).where(F.col("n") > 1)
    joined = rows.join(handoff(stored.select("digest", "stored")), "digest", "left")
    is_stored = F.col("page_id").eqNullSafe(F.col("stored.page_id")) & F.col("url").eqNullSafe(F.col("stored.url"))
    reference = F.when(F.col("stored").isNotNull() & ~is_stored, F.col("stored"))
    joined = joined.select("page_id", "url", "payload", "digest", reference.alias("stored"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            for k in range(batch.num_rows):
                for item in page_records(batch.slice(k, 1).to_pylist()[0], segment_bytes):
                    out.append(item)
                    size += len(item)
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])
                    out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    records = joined.mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value"))
    writer = records.write.option("lineSep", "\r\n\r\n").option("compression", "gzip")
    writer.option("maxRecordsPerFile", records_per_file).text(path)


def unzipped(content: bytes) -> bytes:
    """All members of a gzip file; other content as it is."""
    out = []
    while content[:2] == b"\x1f\x8b":
        stream = zlib.decompressobj(wbits=31)
        out.append(stream.decompress(content))
        content = stream.unused_data
    return b"".join(out) if out else content


def cut_records(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of every record, by the lengths that the records state."""
    at = 0
    while True:
        while archive[at : at + 2] == END:
            at += 2
        if at >= len(archive):
            return
        head = archive.find(END + END, at)
        if not archive.startswith(b"WARC/", at) or head < 0:
            raise ValueError(f"no record at byte {at}")
        lines = archive[at:head].decode("utf-8", "replace").split("\r\n")[1:]
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        at = head + 4
        length = int(headers["content-length"])
        yield headers, archive[at : at + length]
        at += length


FIELDS = pa.schema(
    [
        ("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("refers_to", pa.string()),
        ("declared_digest", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("complete", pa.bool_()),
    ]
)
SCHEMA = (
    "record_id string, record_type string, target_uri string, refers_to string, declared_digest string, payload binary, "
    "payload_bytes bigint, complete boolean"
)
SEGMENTS = pa.schema(
    [
        ("origin", pa.string()), ("number", pa.int32()), ("total", pa.int64()), ("block", pa.binary()), ("record_type", pa.string()),
        ("target_uri", pa.string()), ("declared_digest", pa.string()),
    ]
)


def _payload(block: bytes) -> tuple[bytes | None, int | None]:
    """Payload of an HTTP response, decoded if chunked, and the length its header states."""
    head, _, body = block.partition(END + END)
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in head.split(END)[1:])}
    length = int(fields[b"content-length"]) if fields.get(b"content-length", b"").isdigit() else None
    if b"chunked" in fields.get(b"transfer-encoding", b"").lower():
        return dechunked(body), length
    return body, length


def _whole(headers: dict[str, str], block: bytes) -> tuple:
    payload, length = _payload(block)
    kind = headers.get("warc-type")
    digest = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if kind == "revisit":
        payload = None
    size = length if payload is None else len(payload)
    complete = kind == "revisit" or payload is not None
    return (headers.get("warc-record-id"), kind, headers.get("warc-target-uri"), headers.get("warc-refers-to"), digest, payload, size, complete)


def _batches(rows: Iterator[tuple], schema: pa.Schema, place: int) -> Iterator[pa.RecordBatch]:
    out, size = [], 0
    for row in rows:
        out.append(row)
        size += len(row[place] or b"")
        if size > 4 << 20 or len(out) >= 5000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
            out, size = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)


def _reassemble(segments: pd.DataFrame) -> pd.DataFrame:
    """The record of one origin. If every segment came equally often, so does the record; else it is not complete."""
    segments = segments.sort_values("number")
    first = segments.iloc[0]
    parts = segments.drop_duplicates("number")
    copies = segments.groupby("number").size()
    block = b"".join(parts["block"])
    total = parts["total"].dropna()
    whole = (
        parts["number"].tolist() == list(range(1, len(parts) + 1))
        and len(total) == 1 and pd.notna(parts["total"].iloc[-1]) and int(total.iloc[0]) == len(block) and copies.nunique() == 1
    )
    payload = _payload(block)[0] if whole else None
    row = (
        first["origin"], first["record_type"], first["target_uri"], None, first["declared_digest"], payload,
        None if payload is None else len(payload), payload is not None,
    )
    return pd.DataFrame([row] * (int(copies.iloc[0]) if whole else 1), columns=FIELDS.names)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per stored or revisiting record of the archives below a folder, with its payload.

    ``refers_to`` is the identifier of the record that a revisit refers to; a revisit has no payload, and as
    ``payload_bytes`` what its HTTP header states. ``complete`` is false, and the payload null, where segments are missing,
    the total length differs, or the chunked framing is broken. Only segments are shuffled.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict[str, str], bytes]]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield from cut_records(unzipped(batch.column(0)[k].as_py()))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        single = ((h, b) for h, b in archives(batches) if "warc-segment-number" not in h and h.get("warc-type") in ("response", "revisit"))
        yield from _batches((_whole(h, b) for h, b in single), FIELDS, 5)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            (
                h.get("warc-segment-origin-id", h.get("warc-record-id")), int(h["warc-segment-number"]),
                int(h["warc-segment-total-length"]) if "warc-segment-total-length" in h else None, b, h.get("warc-type"),
                h.get("warc-target-uri"), h.get("warc-payload-digest", "").removeprefix("sha1:") or None,
            )
            for h, b in archives(batches)
            if "warc-segment-number" in h
        )
        yield from _batches(rows, SEGMENTS, 3)

    kinds = "origin string, number int, total bigint, block binary, record_type string, target_uri string, declared_digest string"
    joined = files.mapInArrow(segments, kinds).groupBy("origin").applyInPandas(_reassemble, SCHEMA)
    return files.mapInArrow(whole, SCHEMA).unionByName(joined)


def page_digests(records: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of the complete records that pages wrote."""

    def page(name: str) -> Column:
        found = F.regexp_extract(name, r"^<urn:page:(-?\d+):", 1)
        return F.when(found != "", found).cast("bigint")

    digest = F.when(F.col("payload").isNotNull(), base32_digest(F.col("payload"))).otherwise(F.col("declared_digest"))
    return records.where("complete").select(
        page("record_id").alias("page_id"), "payload_bytes", digest.alias("payload_digest"), "record_type", page("refers_to").alias("refers_to")
    )
