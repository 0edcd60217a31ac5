import base64
import gzip
import hashlib

import pytest

import __spark_entry__ as entry
from check import compare, connect
from millrace.llm import warc
from millrace.session import scratch_path

FOLDER = "/root/testdata/sf0.01"
ODD_PAGES = [
    (3, "http://a.b/c", "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"), (1, None, None), (2, "http://a b\r\nX: y", ""), (5, "u", "same ü"), (4, "u", "same ü"),
    (None, "u", "same ü"), (4, "u", "same ü"), (9, "http://h", "y" * 70_000), (None, None, None),
]


def test_query_equals_sql(spark):
    assert compare(entry.queries()["op8_warc_transactions"](spark, FOLDER), connect(FOLDER), entry.oracle_sql()["op8_warc_transactions"]) == ""


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(*r, "extra", None) for r in ODD_PAGES]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, row string, payload string")


def test_odd_pages(spark, pages):
    got = warc.round_trip(pages).collect()
    assert len(got) == len(ODD_PAGES)
    assert all(r.request and r.metadata for r in got)
    payloads = {}
    for page, _, html in ODD_PAGES:
        payloads.setdefault((html or "").encode(), []).append(page)
    for payload, owners in payloads.items():
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        group = [r for r in got if r.capture.digest == digest]
        assert len(group) == len(owners)
        (response,) = [r for r in group if r.capture.kind == "response"]
        known = [o for o in owners if o is not None]
        assert response.metadata.page == (str(min(known)) if known else None)
        assert bytes(response.capture.payload) == payload
        assert all(r.capture.payload_bytes == len(payload) for r in group)
        assert all(r.capture.refers_to == response.capture.record_id for r in group if r is not response)


def test_small_payloads_are_responses(spark, pages):
    got = warc.round_trip(pages, least=8).collect()
    assert sum(r.capture.kind == "revisit" for r in got) == 0
    assert sum(r.capture.kind == "revisit" for r in warc.round_trip(pages, least=7).collect()) == 3


def test_no_pages(spark, pages):
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_archives_are_plain_records(spark, pages):
    path = scratch_path(spark, "warc")
    warc.write_archives(pages, path)
    data = b"".join(gzip.decompress(bytes(r.content)) for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").load(path).collect())
    kinds = [r["kind"] for r in warc.cut_records(data)]
    assert kinds.count("request") == kinds.count("metadata") == len(ODD_PAGES) == kinds.count("response") + kinds.count("revisit")


def test_files_are_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 600_000)
    rows = [(k, "u", chr(97 + k % 26) * (200 if k % 3 else 70_000 + 1_000 * k)) for k in range(60)] + [(99, "u", "z" * 900_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    path = scratch_path(spark, "warc")
    warc.write_archives(pages.coalesce(1), path)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").load(path).collect()
    sizes = sorted(len(gzip.decompress(bytes(r.content))) for r in files)
    assert [s for s in sizes if s > 600_000] == sizes[-1:] and 900_000 < sizes[-1] < 910_000
    assert len(files) < 40
    monkeypatch.setattr(warc, "BATCH_BYTES", 100_000)
    records = warc.read_records(spark, path)
    got = {int(r.metadata.page): (r.capture.payload_bytes, r.capture.kind) for r in warc.assemble(records).collect()}
    assert {k: n for k, (n, _) in got.items()} == {k: len(text) for k, _, text in rows}


def test_archives_without_compression(spark, pages, tmp_path):
    path = scratch_path(spark, "warc")
    warc.write_archives(pages, path)
    packed = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").load(path)
    for k, r in enumerate(packed.collect()):
        (tmp_path / f"part-{k}").write_bytes(gzip.decompress(bytes(r.content)))
    assert warc.assemble(warc.read_records(spark, str(tmp_path))).count() == len(ODD_PAGES)


def test_a_long_payload(spark):
    text = "".join(f"{k} é\r\n\r\nWARC/1.1\r\n" for k in range(300_000))
    pages = spark.createDataFrame([(1, "u", text), (2, "u", text), (3, "u", "short")], "page_id bigint, url string, html string")
    got = {r.metadata.page: r.capture for r in warc.round_trip(pages).collect()}
    assert bytes(got["1"].payload).decode() == text and got["2"].refers_to == got["1"].record_id and bytes(got["3"].payload) == b"short"


def test_records_meet_in_either_direction_and_over_two_links(spark):
    def record(i, kind, to=(), page=None):
        return (i, kind, None, list(to), None, None, None, page, None)

    rows = [record("r1", "response", ["q1"]), record("q1", "request"), record("m1", "metadata", ["q1"], "7"), record("r2", "response"), record("q2", "request", ["r2"]), record("lost", "request", ["nobody"])]
    got = {r.capture.record_id: r for r in warc.assemble(spark.createDataFrame(rows, warc.RECORD)).collect()}
    assert set(got) == {"r1", "r2"}
    assert got["r1"].request.record_id == "q1" and got["r1"].metadata.page == "7"
    assert got["r2"].request.record_id == "q2" and got["r2"].metadata is None


def test_broken_archives_raise():
    with pytest.raises(ValueError):
        list(warc.cut_records(b"WARC/1.1\r\nWARC-Type: request\r\nWARC-Record-ID: <x>\r\nContent-Length: 3\r\n\r\nabcdef\r\n\r\n"))
    with pytest.raises(ValueError):
        list(warc.cut_records(b"WARC/1.1\r\nWARC-Type: request\r\n"))
    with pytest.raises(ValueError):
        list(warc.cut_records(b"HTTP/1.1 200 OK\r\n\r\n"))
