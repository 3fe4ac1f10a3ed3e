"""WARC transaction assembly.

Writing: every page becomes a request, a response (or a revisit of an equal payload captured under a
smaller id) and a metadata record, as WARC/1.1 text in gzipped archive files. Reading: archives are
read as binary files of bounded size, cut by Content-Length, and the records of a transaction are joined through
WARC-Concurrent-To into one nested row per capture.

Payload digests are bare upper-case base32 SHA-1 over the full payload. A revisit record has no
payload of its own; its HTTP header keeps the full payload's length.

Defined cases: a null html is an empty payload; a null or odd url is written percent-encoded where
control characters would break a header; repeated rows of one page id are one capture; a row with a
null id is a capture named by the digest of its url and html, a revisit if a page with an id has the
same payload and a response if none has; payloads may contain anything, also what looks like a record,
and be of any length, an archive ending with the record that takes it past ARCHIVE_BYTES; an empty
table gives no archives and an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import removed_at_exit, shared_dir, small_batches, spread_join

#: Bytes after which an archive file ends, so that it fits in a task's memory; and of records that a reader hands on at once.
ARCHIVE_BYTES, BATCH_BYTES = 32 << 20, 8 << 20
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, ident: str, block: bytes, **headers: str | None) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {ident}", f"WARC-Date: {DATE}"]
    lines += [f"{k.replace('_', '-')}: {v}" for k, v in headers.items() if v is not None]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def header_safe(text: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", text or "")


def transaction(name: str, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """The three records of one capture."""
    uri = header_safe(url)
    ident = f"<urn:capture:{name}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    common = {"WARC_Target_URI": uri, "WARC_Payload_Digest": f"sha1:{digest}", "Content_Type": "application/http; msgtype=response"}
    if refers_to is None:
        main = record("response", ident, http + payload, **common)
    else:
        main = record("revisit", ident, http, WARC_Refers_To=f"<urn:capture:{refers_to}>", WARC_Profile=REVISIT, **common)
    request = record("request", f"<urn:request:{name}>", f"GET {uri} HTTP/1.1\r\n\r\n".encode("utf-8", "surrogatepass"), WARC_Concurrent_To=ident, WARC_Target_URI=uri, Content_Type="application/http; msgtype=request")
    metadata = record("metadata", f"<urn:metadata:{name}>", f"via: {uri}\r\n".encode("utf-8", "surrogatepass"), WARC_Concurrent_To=ident, WARC_Target_URI=uri, Content_Type="application/warc-fields")
    return request + main + metadata


def with_references(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, html, refers_to: equal payloads refer to the smallest page id.

    Only digests that occur more than once enter the join. A payload that a thousandth of all pages
    have is salted, so its pages don't meet in one task.
    """
    hex_sha1 = F.sha1(F.encode(F.coalesce("html", F.lit("")), "UTF-8"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("sha1", hex_sha1).withColumn("n", F.octet_length("html"))
    first = rows.where(F.col("n") >= least_bytes).groupBy("sha1", "n").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies")).where("first is not null and copies > 1")
    first = first.select(F.col("sha1").alias("f_sha1"), F.col("n").alias("f_n"), "first", "copies")
    found = spread_join(rows, first, {"sha1": "f_sha1", "n": "f_n"}, "first", "copies", pages.count(), F.col("url"))
    return found.select("page_id", "url", "html", F.when(F.col("page_id").isNull() | (F.col("first") < F.col("page_id")), F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Gzipped WARC files under `path`, written by Spark's text sink, so to any store that Spark can write.

    The sink ends each row with the two line breaks that end a record. A task numbers its archives and
    begins a new one when enough bytes are in the last.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = filled = 0
        for batch in batches:
            out, numbers, held = [], [], 0
            for page_id, url, html, refers_to in zip(*(batch.column(c) for c in ("page_id", "url", "html", "refers_to"))):
                page_id, url, payload = page_id.as_py(), url.as_py(), html.as_py().encode("utf-8", "surrogatepass")
                name = str(page_id) if page_id is not None else "none-" + hashlib.sha1(header_safe(url).encode("utf-8", "surrogatepass") + b" " + payload).hexdigest()
                out.append(transaction(name, url, payload, base32_sha1(payload), refers_to.as_py())[:-4].decode("utf-8", "surrogatepass"))
                numbers.append(number)
                filled, held = filled + len(out[-1]), held + len(out[-1])
                if filled >= ARCHIVE_BYTES:
                    number, filled = number + 1, 0
                if held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), pa.array(numbers, pa.int32())], names=["value", "archive"])
                    out, numbers, held = [], [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), pa.array(numbers, pa.int32())], names=["value", "archive"])

    small_batches(pages.sparkSession)
    texts = with_references(pages, least_bytes).mapInArrow(run, "value string, archive int")
    texts.write.partitionBy("archive").option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


def records_of(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an archive, gzipped or not."""
    data = gzip.decompress(archive) if archive[:2] == b"\x1f\x8b" else archive
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "surrogatepass").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record begins at byte {at}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        begin = end + 4
        block = data[begin : begin + int(headers["content-length"])]
        yield headers, block
        at = begin + len(block) + 4


FIELDS = "record_id string, record_type string, concurrent_to string, refers_to string, target_uri string, warc_date string, http_header string, payload_digest string, payload_bytes long, digest_ok boolean"


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """A row per record. Response payloads are hashed again and compared with their header."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in FIELDS.split(", ")] + ["payload"] * payloads
        for batch in batches:
            for archive in batch.column("content"):
                rows, held = [], 0
                for h, block in records_of(archive.as_py()):
                    held += len(block)
                    if held > BATCH_BYTES and rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c) if c else pa.array([]) for c in map(list, zip(*rows))], names=names).cast(_arrow(payloads))
                        rows, held = [], len(block)
                    kind, http, payload, n, digest, ok = h["warc-type"], None, None, None, None, None
                    if kind in ("response", "revisit"):
                        head, _, payload = block.partition(b"\r\n\r\n")
                        http, digest = head.decode("utf-8", "replace"), h.get("warc-payload-digest", "").removeprefix("sha1:")
                        if kind == "response":
                            n, own = len(payload), base32_sha1(payload)
                            ok, digest = own == digest, own
                        else:
                            length = re.search(r"(?im)^content-length:\s*(\d+)", http)
                            n, payload = int(length[1]) if length else None, None
                    elif kind == "request":
                        http = block.decode("utf-8", "replace")
                    elif kind == "metadata":
                        payload = block
                    rows.append((h["warc-record-id"], kind, h.get("warc-concurrent-to"), h.get("warc-refers-to"), h.get("warc-target-uri"), h.get("warc-date"), http, digest, n, ok, *([payload] if payloads else [])))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c) if c else pa.array([]) for c in map(list, zip(*rows))], names=names).cast(_arrow(payloads))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").option("recursiveFileLookup", True).load(path).select("content")
    return files.mapInArrow(run, FIELDS + ", payload binary" * payloads)


def _arrow(payloads: bool) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
    return pa.schema([(n, kinds[t]) for n, t in (f.split() for f in FIELDS.split(", "))] + ([("payload", pa.binary())] if payloads else []))


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, response, request, metadata.

    `response` is a struct of the response or revisit record. Records that are concurrent to one that
    isn't there are kept with a null response; of several of one kind the smallest record id counts.
    """
    fields = [c for c in records.columns if c != "concurrent_to"]
    row = F.struct(*fields)
    pick = lambda *kinds: F.min(F.when(F.col("record_type").isin(*kinds), row))
    return records.withColumn("capture_id", F.coalesce("concurrent_to", "record_id")).groupBy("capture_id").agg(
        pick("response", "revisit").alias("response"), pick("request").alias("request"), pick("metadata").alias("metadata"))


def urn_number(c: Column) -> Column:
    return F.regexp_extract(c, r"<urn:capture:(-?\d+)>", 1).try_cast("long")


def page_captures(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write `pages` as archives to the shared folder, read them back and assemble the captures."""
    spark = pages.sparkSession
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, path, least_bytes)
    removed_at_exit(spark, path)
    found = captures(read_archives(spark, path))
    return found.select(
        urn_number(F.col("capture_id")).alias("page_id"), F.col("response.payload_bytes").alias("payload_bytes"), F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.record_type").alias("record_type"), urn_number(F.col("response.refers_to")).alias("refers_to"),
        F.col("response.target_uri").alias("target_uri"), F.col("response.digest_ok").alias("digest_ok"), F.col("request.record_id").alias("request_id"), F.col("metadata.record_id").alias("metadata_id"),
    )


#: The op1 query's rows in DuckDB SQL; five hexadecimal digits make four of base 32.
ORACLE = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS s FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (((('0x' || substr(s, 5 * (i // 4) + 1, 5))::INTEGER >> (15 - 5 * (i % 4))::INTEGER) & 31)), 1) for i in range(32)], '') AS payload_digest,
  CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to,
  url AS target_uri, CASE WHEN first = page_id THEN true END AS digest_ok, '<urn:request:' || page_id || '>' AS request_id, '<urn:metadata:' || page_id || '>' AS metadata_id
FROM f
"""
