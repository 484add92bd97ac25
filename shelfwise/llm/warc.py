"""WARC archives: write captures, read them back, assemble transactions.

Writing makes three records per capture: a request, a response or revisit, and a metadata record; request and
metadata name the response or revisit as WARC-Concurrent-To. Of captures with equal payloads of at least
``least_bytes`` the one with the largest identifier is the response, the others are revisits that refer to it and carry
no payload; smaller payloads are always responses. Every record is a gzip member of its own, so archives can be cut at
any record.

Equal payloads are found by SHA-1 and length. Groups are formed by an aggregate with partial sums and reach their
captures through ``attach``, so one payload in a third of all pages is never shuffled to one task.

Reading parses the archives record by record. Assembly joins request and metadata to the response or revisit by
their concurrent-to identifier and emits one nested row per capture.

Nulls: a null payload is empty; a null URL is written without WARC-Target-URI and read as null. Pages with a null
identifier are captures without one, revisits if a page with an identifier has their payload. Repeated rows are captures of their own: record identifiers are drawn from the
identifier, the digest and a number among rows that share both. An empty table gives no rows. Columns other than the
three named are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import attach, scratch
from shelfwise.llm.files import contents, writing
from shelfwise.scale import cut_lineage

#: Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
FEED = 1 << 14


def base32(sha1_hex: Column) -> Column:
    """Base32 of a SHA-1 in hex: 160 bits are 32 digits of 5 bits, without padding."""
    digits = []
    for k in range(32):
        # 5 bits lie in at most two hex digits, taken as one number of 8 bits
        lo = k * 5 // 4
        pair = F.conv(F.rpad(F.substring(sha1_hex, lo + 1, 2), 2, "0"), 16, 10).cast("int")
        value = F.floor(pair / (1 << (3 - (k * 5 - lo * 4)))).cast("int") % 32
        digits.append(F.substring(F.lit(ALPHABET), value + 1, F.lit(1)))
    return F.concat(*digits)


def captures(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, payload_bytes, sha1): one row per page, without the payload."""
    raw = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    return pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.octet_length(raw).cast("long").alias("payload_bytes"),
        F.sha1(raw).alias("sha1"),
    )


def roles(pages: DataFrame, least_bytes: int = 0, **names) -> DataFrame:
    """(page_id, sha1, payload_bytes, refers_to): refers_to is null for responses."""
    rows = cut_lineage(captures(pages, **names))
    key = ["sha1", "payload_bytes"]
    groups = cut_lineage(rows.groupBy(*key).agg(F.max("page_id").alias("largest"), F.count(F.lit(1)).alias("n")))
    placed = attach(rows.select("page_id", *key), groups, key, "n")
    revisit = (F.col("payload_bytes") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("largest"))
    return placed.select("page_id", *key, F.when(revisit, F.col("largest")).alias("refers_to")).distinct()


def record_name(kind: str, *parts) -> str:
    """Record identifier of a capture, the same in every run."""
    return f"<urn:uuid:{uuid.uuid5(SPACE, kind + chr(0) + chr(0).join(map(str, parts)))}>"


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member."""
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in headers), b"Content-Length: %d" % len(block)]
    return gzip.compress(b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n", compresslevel=1, mtime=0)


def transaction(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, copy: int) -> list[bytes]:
    """Request, response or revisit, and metadata of one capture."""
    target = [] if url is None else [("WARC-Target-URI", re.sub(r"[\r\n]", "", url))]
    common = [("WARC-Date", DATE), *target]
    main = record_name("main", page_id, digest, copy)
    state = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    about = [
        ("WARC-Record-ID", main), *common, ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Page-ID", str(page_id)), ("X-Payload-Length", str(len(payload))),
    ]
    if refers_to is None:
        body = record([("WARC-Type", "response"), *about], state + payload)
    else:
        about += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_name("main", refers_to, digest, 0)), ("X-Refers-To-Page", str(refers_to))]
        body = record([("WARC-Type", "revisit"), *about], state)
    path = "/" if url is None else re.sub(r"^[a-z]+://[^/?#]*", "", url).partition("#")[0] or "/"
    ask = [("WARC-Type", "request"), ("WARC-Record-ID", record_name("request", page_id, digest, copy)), *common,
           ("WARC-Concurrent-To", main), ("Content-Type", "application/http; msgtype=request")]
    note = [("WARC-Type", "metadata"), ("WARC-Record-ID", record_name("metadata", page_id, digest, copy)), *common,
            ("WARC-Concurrent-To", main), ("Content-Type", "application/warc-fields")]
    return [
        record(ask, f"GET {path} HTTP/1.1\r\n\r\n".encode("utf-8", "replace")),
        body,
        record(note, f"page-id: {page_id}\r\npayload-crc32: {zlib.crc32(payload)}\r\n".encode()),
    ]


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write the archives; returns (part, n_captures), and writes when that is read."""
    named = {"id_col": id_col, "url_col": url_col, "html_col": html_col}
    role = roles(pages, least_bytes, **named)
    full = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary").alias("payload"),
    )
    full = full.withColumn("sha1", F.sha1("payload")).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    same = ["sha1", "payload_bytes"]
    on = full["page_id"].eqNullSafe(role["page_id"]) & (full["sha1"] == role["sha1"]) & (full["payload_bytes"] == role["payload_bytes"])
    rows = full.join(role, on).select(full["page_id"], "url", "payload", *[full[c] for c in same], "refers_to")
    rows = rows.withColumn("digest", base32(F.col("sha1"))).select("page_id", "url", "payload", "digest", "refers_to")
    # equal captures meet in the join's partitions; the payload moves once
    dealt = rows.sortWithinPartitions("page_id", "digest", "url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        n, last, copy, out, opened = 0, None, 0, None, None
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    opened = writing(folder, f"part-{part:06d}.warc.gz")
                    out = opened.__enter__()
                same = (row["page_id"], row["digest"])
                copy = copy + 1 if n and same == last else 0
                last = same
                for data in transaction(row["page_id"], row["url"], row["payload"], row["digest"], row["refers_to"], copy):
                    out.write(data)
                n += 1
        if opened is not None:
            opened.__exit__(None, None, None)
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "n_captures": pa.array([n], pa.int64())})

    return dealt.mapInArrow(run, "part long, n_captures long")


def members(data: bytes) -> Iterator[bytes]:
    """The gzip members of an archive, one at a time; fed in small pieces, so nothing is copied twice."""
    view, at = memoryview(data), 0
    while at < len(view):
        one, parts = zlib.decompressobj(wbits=31), []
        while not one.eof:
            piece = view[at : at + FEED]
            if not piece:
                raise ValueError("archive is cut short")
            parts.append(one.decompress(piece))
            at += len(piece) - len(one.unused_data)
        yield b"".join(parts)


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of a record; raises if it is cut short."""
    head, _, rest = member.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    size = int(headers["content-length"])
    if len(rest) < size:
        raise ValueError("record is cut short")
    return headers, rest[:size]


RECORD = (
    "type string, record_id string, concurrent_to string, url string, date string, page_id long, payload_digest string, "
    "payload_bytes long, refers_to long, payload_ok boolean, block string"
)


def read_archives(spark: SparkSession, folder: str, blocks: bool = True) -> DataFrame:
    """One row per record. ``payload_ok``: digest and length of a response agree with its payload. ``block`` is the
    text of requests and metadata and, if ``blocks``, the payload of responses."""

    def number(text: str | None) -> int | None:
        return None if text in (None, "None") else int(text)

    def row(headers: dict[str, str], block: bytes) -> dict:
        kind = headers["warc-type"]
        payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else b""
        digest = headers.get("warc-payload-digest", "").rpartition(":")[2] or None
        size = number(headers.get("x-payload-length"))
        good = None
        if kind == "response":
            good = base64.b32encode(hashlib.sha1(payload).digest()).decode() == digest and len(payload) == size
        text = payload if kind == "response" and blocks else block if kind in ("request", "metadata") else b""
        return {
            "type": kind, "record_id": headers["warc-record-id"], "concurrent_to": headers.get("warc-concurrent-to"),
            "url": headers.get("warc-target-uri"), "date": headers.get("warc-date"), "page_id": number(headers.get("x-page-id")),
            "payload_digest": digest, "payload_bytes": size, "refers_to": number(headers.get("x-refers-to-page")),
            "payload_ok": good, "block": text.decode("utf-8", "replace"),
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("content"):
                held, size = [], 0
                for member in members(data.as_py()):
                    held.append(row(*parse(member)))
                    size += len(held[-1]["block"])
                    if len(held) >= 3000 or size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema=shape)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=shape)

    shape = pa.schema([
        ("type", pa.string()), ("record_id", pa.string()), ("concurrent_to", pa.string()), ("url", pa.string()),
        ("date", pa.string()), ("page_id", pa.int64()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
        ("refers_to", pa.int64()), ("payload_ok", pa.bool_()), ("block", pa.string()),
    ])
    return contents(spark, folder, "*.warc.gz").mapInArrow(run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture (of the response or revisit), request, metadata.

    Identifiers are unique, so no key is hot. Of several requests or metadata records that name one response, the
    smallest identifier counts; a response without them has nulls there.
    """
    main = records.filter(F.col("type").isin("response", "revisit"))
    main = main.select(F.col("record_id").alias("id"), F.struct(*[c for c in main.columns if c != "concurrent_to"]).alias("capture"))
    about = records.filter(F.col("type").isin("request", "metadata")).filter(F.col("concurrent_to").isNotNull())
    part = F.struct("record_id", "url", "date", "block")
    sides = about.groupBy(F.col("concurrent_to").alias("id")).agg(
        F.min(F.when(F.col("type") == "request", part)).alias("request"),
        F.min(F.when(F.col("type") == "metadata", part)).alias("metadata"),
    )
    return main.join(sides, "id", "left").select("capture", "request", "metadata")


def warc_report(pages: DataFrame, least_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Write, read back and assemble: page_id, payload_bytes, payload_digest, record_type, refers_to, complete."""
    spark = pages.sparkSession
    folder = folder or scratch(spark, "warc")
    written = write_archives(pages, folder, least_bytes).agg(F.sum("n_captures")).first()[0]
    columns = ["page_id", "payload_bytes", "payload_digest"]
    if not written:
        return spark.createDataFrame(
            [], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, complete boolean"
        )
    rows = assemble(read_archives(spark, folder, blocks=False))
    complete = F.col("request").isNotNull() & F.col("metadata").isNotNull() & F.coalesce("capture.payload_ok", F.lit(True))
    return rows.select(
        *[f"capture.{c}" for c in columns],
        F.col("capture.type").alias("record_type"),
        "capture.refers_to",
        complete.alias("complete"),
    )
