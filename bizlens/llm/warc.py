"""WARC archives of web pages, with revisits and segmented records, written and read back."""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bizlens.llm.common import chunks
from bizlens.session import materialize, new_folder

SEGMENT_BYTES = 16_384
CHUNK_BYTES = 4_096
RECORDS_PER_FILE = 1_000
MIN_REVISIT_BYTES = 0
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, row: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{row}')}>"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """HTTP chunked transfer framing."""
    cut = [payload[k : k + size] for k in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%s\r\n" % (len(c), c) for c in cut) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes | None:
    """The payload within chunked framing; None if the framing is broken."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            return None
        try:
            size = int(body[at:end].split(b";")[0], 16)
        except ValueError:
            return None
        at = end + 2
        if size == 0:
            return b"".join(out)
        if size < 0 or body[at + size : at + size + 2] != b"\r\n":
            return None
        out.append(body[at : at + size])
        at += size + 2


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """A record but for its last line end, which the text writer adds."""
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n"


def response_records(page_id, row, url, payload: bytes, segment_bytes: int = SEGMENT_BYTES):
    """The records of one page: a response, with continuation records if its block is longer than a segment."""
    block = HTTP + chunked(payload)
    cut = [block[k : k + segment_bytes] for k in range(0, len(block), segment_bytes)]
    own = record_id(page_id, row)
    whole = [
        ("WARC-Type", "response"), ("WARC-Record-ID", own), ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", url), ("X-Page-ID", page_id), ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest_of(payload)}"),
    ]
    yield _record([*whole, ("WARC-Segment-Number", 1 if len(cut) > 1 else None)], cut[0])
    for k, part in enumerate(cut[1:], 2):
        yield _record(
            [
                ("WARC-Type", "continuation"), ("WARC-Record-ID", f"{own[:-1]}.{k}>"), ("WARC-Date", "1970-01-01T00:00:00Z"),
                ("WARC-Target-URI", url), ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", k),
                ("WARC-Segment-Total-Length", len(block) if k == len(cut) else None),
            ],
            part,
        )


def _uri(pages: DataFrame):
    """The address on one line; a page without one gets a made-up address."""
    url = F.regexp_replace(F.coalesce(F.col("url").cast("string"), F.lit("")), r"[\x00-\x20\x7f]+", "%20")
    return F.when(url == "", F.lit("about:blank")).otherwise(url)


def write(pages: DataFrame, folder: str, min_revisit_bytes: int = MIN_REVISIT_BYTES, segment_bytes: int = SEGMENT_BYTES) -> None:
    """Write ``pages(page_id, url, html)`` as gzipped WARC files to ``folder``.

    The payload is the html in UTF-8; null is empty. Of pages with equal payloads of at least ``min_revisit_bytes`` the
    one with the smallest page_id (nulls last; of repeated rows the first) is a response, the others are revisits of it.
    Shorter pages are all responses. Pages meet by their SHA-1: copies fold before the shuffle, and revisits carry no html.
    """
    rows = pages.select(
        F.monotonically_increasing_id().alias("row"), F.col("page_id").cast("long").alias("page_id"),
        _uri(pages).alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.unhex(F.sha1("payload")))
    long, short = rows, None
    if min_revisit_bytes > 0:
        long, short = rows.filter(F.octet_length("payload") >= min_revisit_bytes), rows.filter(F.octet_length("payload") < min_revisit_bytes)
    meta = materialize(long.select("row", "page_id", "url", "digest"), "pages")
    place = F.struct(F.col("page_id").isNull().alias("bare"), "page_id", "row", "url")
    firsts = meta.groupBy("digest").agg(F.min(place).alias("first"))
    payloads = long.groupBy("digest").agg(F.first("payload").alias("payload"))
    responses = payloads.join(firsts, "digest").select("first.page_id", "first.row", "first.url", "payload")
    if short is not None:
        responses = responses.unionByName(short.select("page_id", "row", "url", "payload"))
    revisits = meta.join(firsts, "digest").filter(F.col("row") != F.col("first.row")).select(
        "page_id", "row", "url", "digest", F.col("first.page_id").alias("to_page"), F.col("first.row").alias("to_row")
    )

    def write_responses(batches):
        for batch in chunks(batches, "payload", 4 << 20):
            yield _values(r for x in batch.to_pylist() for r in response_records(x["page_id"], x["row"], x["url"], x["payload"], segment_bytes))

    def write_revisits(batches):
        head = HTTP.split(b"\r\n\r\n")[0] + b"\r\n\r\n"
        for batch in batches:
            yield _values(
                _record(
                    [
                        ("WARC-Type", "revisit"), ("WARC-Record-ID", record_id(x["page_id"], x["row"])), ("WARC-Date", "1970-01-01T00:00:00Z"),
                        ("WARC-Target-URI", x["url"]), ("X-Page-ID", x["page_id"]), ("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(x["to_page"], x["to_row"])),
                        ("WARC-Payload-Digest", f"sha1:{base64.b32encode(x['digest']).decode()}"), ("Content-Type", "application/http;msgtype=response"),
                    ],
                    head,
                )
                for x in batch.to_pylist()
            )

    records = responses.mapInArrow(write_responses, "value binary").unionByName(revisits.mapInArrow(write_revisits, "value binary"))
    # The text writer puts bytes out as they are, and adds the line end that closes a record.
    (records.select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\r\n")
     .option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(folder))


def _values(records) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(records), pa.binary())], ["value"])


def parse(data: bytes):
    """``(headers, block)`` of each record of an archive; header names in lower case. A cut-off last record is left out."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            return
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        at, size = end + 4, int(headers.get("content-length", "0"))
        if at + size > len(data):
            return
        yield headers, data[at : at + size]
        at += size + 4


PARSED = (
    "record_id string, kind string, page_id long, refers_to string, digest string, segment int, origin string, "
    "total long, block binary, bytes long, found string, status string"
)


def _decoded(block: bytes, digest: str | None) -> tuple:
    """(bytes, digest, status) of the payload in an HTTP message."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        return None, None, "no HTTP header"
    payload = unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body
    if payload is None:
        return None, None, "broken chunk"
    found = digest_of(payload)
    return len(payload), found, "ok" if digest in (None, found) else "other digest"


def _parse_files(batches):
    schema = pa.schema([(n, {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}[t]) for n, t in (x.split() for x in PARSED.split(", "))])
    for batch in batches:
        for content in batch.column("content"):
            raw, out = content.as_py(), []
            for h, block in parse(gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw):
                kind, segment = h.get("warc-type"), h.get("warc-segment-number")
                page = h.get("x-page-id")
                row = {
                    "record_id": h.get("warc-record-id"), "kind": kind, "page_id": int(page) if page else None,
                    "refers_to": h.get("warc-refers-to"), "digest": h.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                    "segment": int(segment) if segment else None, "total": int(h["warc-segment-total-length"]) if "warc-segment-total-length" in h else None,
                    "origin": None, "block": None, "bytes": None, "found": None, "status": None,
                }
                if segment:
                    row |= {"origin": h.get("warc-segment-origin-id", row["record_id"]), "block": block}
                elif kind == "response":
                    row["bytes"], row["found"], row["status"] = _decoded(block, row["digest"])
                out.append(row)
            yield pa.RecordBatch.from_pylist(out, schema=schema)


def _join_segments(batches):
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            parts, total = row["parts"], row["total"]
            block = b"".join(p["block"] for p in parts)
            size, found, status = None, None, "ok"
            if [p["segment"] for p in parts] != list(range(1, len(parts) + 1)):
                status = "missing segment"
            elif total is None or total != len(block):
                status = "wrong length"
            else:
                size, found, status = _decoded(block, row["digest"])
            out.append({"record_id": row["origin"], "page_id": row["page_id"], "digest": row["digest"], "bytes": size, "found": found, "status": status})
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("record_id", pa.string()), ("page_id", pa.int64()), ("digest", pa.string()), ("bytes", pa.int64()), ("found", pa.string()), ("status", pa.string())]))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Read archives: ``page_id, record_type, payload_bytes, payload_digest, refers_to, status`` for each page.

    Continuation records are grouped by the record they continue, put in order of segment number, and their total length is
    verified before the chunked framing is decoded. A revisit takes its size from the response it refers to; its digest
    is the record's own. ``status`` is "ok", or says what is wrong ("missing segment", "wrong length", "broken chunk",
    "no HTTP header", "other digest", "missing response"); the payload columns are null where nothing could be decoded.
    """
    files = spark.read.format("binaryFile").load(folder).select("content")
    records = materialize(files.mapInArrow(_parse_files, PARSED), "records")
    narrow = ["record_id", "page_id", "digest", "bytes", "found", "status"]
    groups = records.filter("origin is not null").groupBy("origin").agg(
        F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts"), F.max("total").alias("total"),
        F.max("page_id").alias("page_id"), F.max("digest").alias("digest"),
    )
    joined = groups.mapInArrow(_join_segments, "record_id string, page_id long, digest string, bytes long, found string, status string")
    responses = records.filter("kind = 'response' and origin is null").select(*narrow).unionByName(joined)
    responses = materialize(responses, "responses")
    sizes = responses.select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("to_page"), "bytes", F.col("status").alias("to_status"))
    revisits = records.filter("kind = 'revisit'").select("page_id", "digest", "refers_to").join(sizes, "refers_to", "left")
    first = responses.select(
        "page_id", F.lit("response").alias("record_type"), F.col("bytes").alias("payload_bytes"),
        F.col("found").alias("payload_digest"), F.lit(None).cast("long").alias("refers_to"), "status",
    )
    return first.unionByName(revisits.select(
        "page_id", F.lit("revisit").alias("record_type"), F.col("bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"), F.col("to_page").alias("refers_to"),
        F.coalesce("to_status", F.lit("missing response")).alias("status"),
    ))


def round_trip(pages: DataFrame, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back (see ``write`` and ``read``).

    Null and empty html are equal payloads of no bytes. Repeated rows are separate pages. Other columns are ignored; an
    empty table gives no rows.
    """
    folder = new_folder(pages.sparkSession, "warc")
    write(pages, folder, min_revisit_bytes)
    return read(pages.sparkSession, folder)
