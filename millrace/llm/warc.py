"""WARC archives: write captures as request, response or revisit, and metadata records; read archives back into captures.

``write_archives`` makes one text row per page that holds its three records and lets Spark's text writer put them into
compressed part files with the end of a WARC record as line separator, so the usual commit rules guard against lost tasks.
Pages are written by classes of size, and a file of a class has as many pages as keep it near FILE_BYTES before compression;
only a page larger than that makes a larger file, its own.
Of pages with equal payloads the one with the smallest id is a response, the others are revisits that refer to its record.

``read_records`` reads archives as streams and cuts them into records by their Content-Length, so that a task holds one packed
file, and as many unpacked records as fit BATCH_BYTES, or one; ``assemble`` joins the records of one capture through
WARC-Concurrent-To in either direction, also through a second record (metadata that names the request), and gives one
nested row per capture.

Defined results: a NULL payload is empty; NULL ids come last when the response of a group is chosen, ties go to the first
row; repeated rows are captures of their own; a NULL URL gives records without a target; line breaks and blanks of a URL are
percent-encoded; records that lead to no response or revisit belong to no capture and are left out; no rows give no rows.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator
from functools import reduce
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import numbered, stage_table
from millrace.session import scratch_path

END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes of a file before compression, the least class of size (a class has pages of up to eight times the one before), and
#: bytes of unpacked records sent on at once.
FILE_BYTES, LEAST_CLASS, BATCH_BYTES = 64_000_000, 32_000, 8_000_000
RECORD = (
    "record_id string, kind string, target string, concurrent_to array<string>, refers_to string, digest string, "
    "payload_bytes bigint, page string, payload binary"
)


def base32(hex_digest: Column) -> Column:
    """40 hexadecimal digits as 32 digits of RFC 4648 base 32: five digits are four."""
    parts = [F.lpad(F.conv(F.substring(hex_digest, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _record_id(kind: str, row: Column) -> Column:
    h = F.md5(F.concat(F.lit(f"{kind}:"), row.cast("string")))
    cuts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def _record(headers: list[tuple[str, Column | str]], block: Column) -> Column:
    """Header lines, those whose value is NULL left out, and the block; without the end of the record."""
    lines = [F.concat(F.lit(f"{name}: "), v if isinstance(v, Column) else F.lit(v)) for name, v in headers]
    length = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))
    return F.concat(F.concat_ws("\r\n", F.lit("WARC/1.1"), *lines, length), F.lit(END), block)


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 0, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write a capture per page; equal payloads of fewer than ``least`` bytes are all responses."""
    rows = numbered(pages.select(*dict.fromkeys((id_col, url_col, payload_col))), payload_col)
    payload = F.coalesce("text", F.lit(""))
    rows = rows.select(
        "row", F.col(f"doc.{id_col}").cast("string").alias("page"), F.col(f"doc.{id_col}").alias("id"), F.col(f"doc.{url_col}").cast("string").alias("url"),
        payload.alias("payload"), base32(F.sha1(payload.cast("binary"))).alias("digest"), F.octet_length(payload).alias("n"),
    )
    named = rows.where(F.col("n") >= least).select("digest", F.struct(F.col("id").isNull().alias("no"), "id", "row").alias("who"))
    groups = named.groupBy("digest").agg(F.min("who").alias("who"), F.count("*").alias("many")).where("many > 1")
    groups = stage_table(groups.select(F.col("digest").alias("of"), F.col("who.row").alias("response")))
    told = rows.join(groups, (F.col("digest") == F.col("of")) & (F.col("n") >= least), "left")
    revisit = F.col("response").isNotNull() & (F.col("response") != F.col("row"))
    url = F.regexp_replace(F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A"), " ", "%20")
    host = F.regexp_extract(url, "^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)
    own = _record_id("response", F.col("row"))
    about = [("WARC-Target-URI", url), ("WARC-Date", date)]
    get = F.concat(F.lit("GET "), F.coalesce(url, F.lit("/")), F.lit(" HTTP/1.1\r\nHost: "), F.coalesce(host, F.lit("")), F.lit(END))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n").cast("string"), F.lit(END))
    digest = F.concat(F.lit("sha1:"), F.col("digest"))
    request = _record(
        [("WARC-Type", "request"), ("WARC-Record-ID", _record_id("request", F.col("row"))), ("WARC-Concurrent-To", own), *about, ("Content-Type", "application/http; msgtype=request")], get
    )
    capture = _record(
        [
            ("WARC-Type", F.when(revisit, "revisit").otherwise("response")), ("WARC-Record-ID", own), *about,
            ("WARC-Payload-Digest", digest), ("WARC-Profile", F.when(revisit, PROFILE)), ("WARC-Refers-To", F.when(revisit, _record_id("response", F.col("response")))),
            ("Content-Type", "application/http; msgtype=response"),
        ],
        F.concat(http, F.when(revisit, "").otherwise(F.col("payload"))),
    )
    metadata = _record(
        [("WARC-Type", "metadata"), ("WARC-Record-ID", _record_id("metadata", F.col("row"))), ("WARC-Concurrent-To", own), *about, ("Content-Type", "application/warc-fields")],
        F.concat_ws("\r\n", F.concat(F.lit("page: "), F.col("page")), F.lit("")),
    )
    # What is written of a page: its payload unless it is a revisit, and heads that hold the target up to five times.
    heads = 5 * F.coalesce(F.octet_length("url"), F.lit(0)) + 2_000
    bounds = [LEAST_CLASS]
    while bounds[-1] < FILE_BYTES:
        bounds.append(bounds[-1] * 8)

    def size_class(written: Column) -> Column:
        return reduce(lambda so_far, k: F.when(written <= bounds[k], k).otherwise(so_far), reversed(range(len(bounds))), F.lit(len(bounds)))

    told = told.withColumn("size", size_class(F.when(revisit, heads).otherwise(heads + F.col("n"))))
    possible = F.explode(F.array(size_class(heads), size_class(heads + F.col("n"))))
    present = sorted(r[0] for r in rows.select(possible.alias("size")).distinct().collect())  # one of few classes each
    for k in present or [0]:
        lines = told.where(F.col("size") == k).select(F.concat_ws(END, request, capture, metadata).alias("value"))
        pages_per_file = max(1, FILE_BYTES // bounds[k]) if k < len(bounds) else 1
        lines.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", pages_per_file).text(f"{path}/{k}")


def cut_records(source: bytes | BinaryIO) -> Iterator[dict]:
    """The records of an archive as rows of the schema RECORD; a stream is read record by record."""
    source = io.BytesIO(source) if isinstance(source, bytes) else source
    while first := source.readline():
        if not first.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {first[:40]!r}")
        fields: dict[str, list[str]] = {}
        while (line := source.readline()) != b"\r\n":
            if not line:
                raise ValueError("an archive ends amid the head of a record")
            name, _, value = line.decode().partition(":")
            fields.setdefault(name.strip().lower(), []).append(value.strip())
        one = {k: v[0] for k, v in fields.items()}
        length = int(one["content-length"])
        block = source.read(length)
        if len(block) < length or source.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {one.get('warc-record-id')} does not have its Content-Length")
        kind = one["warc-type"]
        row = {
            "record_id": one["warc-record-id"], "kind": kind, "target": one.get("warc-target-uri"), "concurrent_to": fields.get("warc-concurrent-to", []),
            "refers_to": one.get("warc-refers-to"), "digest": one.get("warc-payload-digest", "").removeprefix("sha1:") or None,
            "payload_bytes": None, "page": None, "payload": None,
        }
        if kind in ("response", "revisit"):
            head, _, body = block.partition(b"\r\n\r\n")
            lengths = [x.partition(b":")[2] for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")]
            row["payload_bytes"] = len(body) if kind == "response" else int(lengths[0]) if lengths else None
            row["payload"] = body if kind == "response" else None
        elif kind == "metadata":
            pages = [x[6:] for x in block.decode().split("\r\n") if x.startswith("page: ")]
            row["page"] = pages[0] if pages else None
        yield row


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of all archives below ``path``; payloads that do not have the digest of their record raise."""
    import base64
    import hashlib

    names = [part.split(" ")[0] for part in RECORD.split(", ")]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [(n, pa.list_(pa.string()) if n == "concurrent_to" else pa.int64() if n == "payload_bytes" else pa.binary() if n == "payload" else pa.string()) for n in names]
        )
        for batch in batches:
            for content in batch.column("content"):
                source = pa.BufferReader(content.as_buffer())
                packed = content.as_buffer()[:2].to_pybytes() == b"\x1f\x8b"
                rows, held = [], 0
                for r in cut_records(io.BufferedReader(gzip.GzipFile(fileobj=source) if packed else source, 1 << 20)):
                    if r["kind"] == "response" and r["digest"] not in (None, base64.b32encode(hashlib.sha1(r["payload"]).digest()).decode()):
                        raise ValueError(f"the payload of {r['record_id']} is not what its digest says")
                    size = len(r["payload"] or b"")
                    if rows and (len(rows) == 500 or held + size > BATCH_BYTES):
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                    rows.append(r)
                    held += size
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").load(path)
    return files.select("content").mapInArrow(parse, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """(capture, request, metadata) as structs, one row per response or revisit; several requests or metadata: the least id."""
    captures = records.where(F.col("kind").isin("response", "revisit"))
    others = records.where(~F.col("kind").isin("response", "revisit")).select("record_id", "kind", "target", "concurrent_to", "page")
    ids = captures.select(F.col("record_id").alias("to"), F.col("record_id").alias("capture_id"))
    named = captures.select(F.explode("concurrent_to").alias("record_id"), F.col("record_id").alias("capture_id"))
    links = others.select("record_id", F.explode("concurrent_to").alias("to"))
    direct = links.join(ids, "to").select("record_id", "capture_id").union(named.join(others.select("record_id"), "record_id").select("record_id", "capture_id"))
    second = links.join(direct.select(F.col("record_id").alias("to"), "capture_id"), "to").select("record_id", "capture_id")
    members = others.join(direct.union(second).distinct(), "record_id")

    def least(kind: str) -> Column:
        return F.min(F.when(F.col("kind") == kind, F.struct("record_id", "target", "page"))).alias(kind)

    gathered = members.groupBy("capture_id").agg(least("request"), least("metadata"))
    whole = F.struct("record_id", "kind", "target", "digest", "payload_bytes", "refers_to", "payload").alias("capture")
    return captures.select("record_id", whole).join(gathered, F.col("record_id") == F.col("capture_id"), "left").select("capture", "request", "metadata")


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 0) -> DataFrame:
    """Write the pages to archives in the shared folder and return the captures read back from them."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, id_col, url_col, payload_col, least)
    return assemble(stage_table(read_records(spark, path), "zstd"))
