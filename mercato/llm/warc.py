"""WARC archives written and read by Spark: revisits by payload, segmented records, chunked transfer framing.

Records are written by Spark's text sink with CRLF CRLF as its line end, which is the end of a WARC record, so archives
go wherever Spark can write. They are read as whole files of bounded size. Blocks beyond ``segment_bytes`` are cut into
a first record and continuation records; the reader groups these by origin, orders them by number, and checks the total.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.common import store

SEGMENT_BYTES = 32 * 1024
CHUNK_BYTES = 8 * 1024
FILE_RECORDS = 4000  # with SEGMENT_BYTES this bounds a file, which one task reads whole
END = b"\r\n\r\n"
_ID = re.compile(r"<urn:page:(null|-?\d+):(\d+)>")
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def frame_chunks(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing; the empty payload is the closing chunk alone."""
    out = []
    for at in range(0, len(payload), size):
        piece = payload[at : at + size]
        out += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*out, b"0\r\n\r\n"])


def unframe_chunks(body: bytes) -> bytes:
    """The payload of a chunked body; ValueError when a size line, a chunk or the closing chunk is missing."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk size missing")
        size = int(body[at:end].split(b";")[0], 16)
        if size == 0:
            return b"".join(out)
        at = end + 2
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk cut short")
        out.append(body[at : at + size])
        at += size + 2


def _record(kind: str, record_id: str, uri: str, date: str, block: bytes, extra: list[str]) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", f"WARC-Date: {date}", f"WARC-Target-URI: {uri}", *extra]
    if kind in ("response", "revisit"):
        lines.append("Content-Type: application/http;msgtype=response")
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + END + block


def _uri(url: str | None, record_id: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else record_id.strip("<>")


def _formatter(segment_bytes: int, date: str):
    def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out: list[bytes] = []
            for rec, url, payload, first in zip(pdf["record"], pdf["url"], pdf["payload"], pdf["first"], strict=True):
                rid, uri = f"<urn:page:{rec}>", _uri(url, rec)
                if first is not None:
                    extra = [
                        f"WARC-Refers-To: <urn:page:{first}>", f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
                        "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                    ]
                    out.append(_record("revisit", rid, uri, date, _HTTP, extra))
                    continue
                block = _HTTP + frame_chunks(payload)
                digest = f"WARC-Payload-Digest: sha1:{payload_digest(payload)}"
                if len(block) <= segment_bytes:
                    out.append(_record("response", rid, uri, date, block, [digest]))
                    continue
                out.append(_record("response", rid, uri, date, block[:segment_bytes], [digest, "WARC-Segment-Number: 1"]))
                for n, at in enumerate(range(segment_bytes, len(block), segment_bytes), 2):
                    extra = [f"WARC-Segment-Origin-ID: {rid}", f"WARC-Segment-Number: {n}"]
                    if at + segment_bytes >= len(block):
                        extra.append(f"WARC-Segment-Total-Length: {len(block)}")
                    out.append(_record("continuation", f"<urn:page:{rec}:segment:{n}>", uri, date, block[at : at + segment_bytes], extra))
            yield pd.DataFrame({"value": out})

    return records


def write_archives(
    pages: DataFrame,
    path: str,
    *,
    min_revisit_bytes: int = 0,
    segment_bytes: int = SEGMENT_BYTES,
    file_records: int = FILE_RECORDS,
    date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Write a record per row of ``pages`` (page_id, url, html) as gzip WARC files under ``path``.

    Of rows with equal payloads of at least ``min_revisit_bytes``, the one with the smallest page_id is a response, the
    others revisit it; shorter payloads are all responses. A null page_id comes after all others, of rows equal in both
    the earlier row is the response; null html is the empty payload. ``pages`` is a table scan, whose row numbers are
    the same each time it is read.
    """
    rows = pages.select(
        F.monotonically_increasing_id().alias("uid"), F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"), F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8").alias("payload"),
    )
    # the uid is taken where the scan is; equality of payloads is that of both digests and the length
    keyed = rows.withColumn("key", F.struct(F.sha1("payload"), F.sha2("payload", 256), F.octet_length("payload").alias("n")))
    first = keyed.groupBy("key").agg(F.min(F.struct(F.col("page_id").isNull(), "page_id", "uid")).alias("f"))
    name = lambda page, uid: F.concat(F.coalesce(page.cast("string"), F.lit("null")), F.lit(":"), uid.cast("string"))
    revisit = (F.col("f.uid") != F.col("uid")) & (F.col("key.n") >= min_revisit_bytes)
    typed = keyed.join(first, "key").select(
        name(F.col("page_id"), F.col("uid")).alias("record"), "url", "payload", F.when(revisit, name(F.col("f.page_id"), F.col("f.uid"))).alias("first")
    )
    records = typed.mapInPandas(_formatter(segment_bytes, date), "value binary")
    text = records.select(F.col("value").cast("string").alias("value"))
    text.write.option("lineSep", END.decode()).option("compression", "gzip").option("maxRecordsPerFile", file_records).text(path)


_RAW = "record string, kind string, digest string, refers string, number int, total long, origin string, block binary"


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Records of whole files, in batches of bounded bytes."""
    names = [c.split()[0] for c in _RAW.split(", ")]
    for pdf in batches:
        for content in pdf["content"]:
            stream = gzip.GzipFile(fileobj=io.BytesIO(content))
            out: list[tuple] = []
            held = 0
            while (line := stream.readline()) != b"":
                if not line.strip():
                    continue
                if not line.startswith(b"WARC/"):
                    raise ValueError(f"no WARC record where one must start: {line[:40]!r}")
                head: dict[str, str] = {}
                while (line := stream.readline()).strip():
                    key, _, value = line.decode().partition(":")
                    head[key.strip().lower()] = value.strip()
                block = stream.read(int(head["content-length"]))
                if len(block) != int(head["content-length"]):
                    raise ValueError(f"record {head.get('warc-record-id')} cut short")
                number, total = head.get("warc-segment-number"), head.get("warc-segment-total-length")
                out.append((
                    head["warc-record-id"], head["warc-type"], head.get("warc-payload-digest", "").removeprefix("sha1:") or None, head.get("warc-refers-to"),
                    int(number) if number else 0, int(total) if total else None, head.get("warc-segment-origin-id", head["warc-record-id"]), block,
                ))
                held += len(block)
                if held > 4 << 20:
                    yield pd.DataFrame(out, columns=names).astype({"total": "Int64"})
                    out, held = [], 0
            if out:
                yield pd.DataFrame(out, columns=names).astype({"total": "Int64"})


_READ = "record string, page_id long, record_type string, refers string, payload_bytes long, payload_digest string, status string, payload binary"


def _decode(record: str, kind: str, digest: str | None, refers: str | None, block: bytes, whole: bool, keep: bool) -> tuple:
    page = (m := _ID.match(record)) and m[1] != "null" and int(m[1])
    page = None if page is False or m is None else page
    if kind == "revisit":
        return record, page, kind, refers, None, digest, "ok", None
    payload, status = None, "ok" if whole else "incomplete"
    if whole:
        try:
            head, _, body = block.partition(END)
            payload = unframe_chunks(body) if b"transfer-encoding: chunked" in head.lower() else body
            if digest and payload_digest(payload) != digest:
                status = "digest differs"
        except ValueError as e:
            status = str(e)
    size = None if payload is None else len(payload)
    found = None if payload is None else payload_digest(payload)
    return record, page, kind, refers, size, found, status, payload if keep else None


def _as_frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in _READ.split(", ")]).astype({"page_id": "Int64", "payload_bytes": "Int64"})


def read_archives(spark: SparkSession, path: str, *, with_payload: bool = True) -> DataFrame:
    """One row per response or revisit under ``path``: page_id, record_type, refers_to, payload_bytes, payload_digest, status, payload.

    Both figures are of the full payload as read: a revisit takes its length from the response it refers to, and its
    status says when that response is missing or has another digest. Segments that are missing, or whose bytes do not
    add up to the stated total, and broken chunk framing give a null payload and a status other than ``ok``.
    """
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("content")
    raw = files.mapInPandas(_parse, _RAW)

    def single(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield _as_frame([_decode(r.record, r.kind, r.digest, r.refers, r.block, True, with_payload) for r in pdf.itertuples()])

    def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.itertuples():
                block = b"".join(s["block"] for s in r.segments)
                whole = [s["number"] for s in r.segments] == list(range(1, len(r.segments) + 1)) and r.total == len(block)
                rows.append(_decode(r.origin, "response", r.digest, None, block, whole, with_payload))
            yield _as_frame(rows)

    singles = raw.where("number = 0 and kind in ('response', 'revisit')").mapInPandas(single, _READ)
    segments = raw.where("number > 0").groupBy("origin").agg(
        F.sort_array(F.collect_list(F.struct("number", "block"))).alias("segments"), F.max("digest").alias("digest"), F.max("total").alias("total")
    )
    rows = store(singles.unionByName(segments.mapInPandas(joined, _READ)), "warc-rows")
    ours = rows.where("record_type = 'revisit'")
    theirs = rows.where("record_type = 'response'").select(
        F.col("record").alias("refers"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("n"), F.col("payload_digest").alias("d")
    )
    status = F.when(F.col("n").isNull(), F.lit("response missing")).when(F.col("d") != F.col("payload_digest"), F.lit("digest differs")).otherwise(F.col("status"))
    resolved = ours.join(theirs, "refers", "left").withColumn("payload_bytes", F.col("n")).withColumn("status", status).drop("n", "d")
    both = resolved.unionByName(rows.where("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("long")))
    return both.select("page_id", "record_type", "refers_to", "payload_bytes", "payload_digest", "status", "payload")
