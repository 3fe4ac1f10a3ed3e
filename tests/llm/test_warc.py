import gzip
import glob
from collections import Counter

from lanemesh.llm import warc

DDL = "page_id long, url string, html string, digest string, n long"


def corpus():
    tricky = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    docs = [(i, f"http://h/{i}", f"<p>{i % 40}</p>" + ("é" * (i % 7)), "d", 1) for i in range(300)]
    return docs + [(500, None, None, None, None), (501, "http://a b\r\nX: y", "", None, None), (502, "u", tricky, None, None), (503, "u", tricky, None, None), (504, "u", "big" * 400_000, None, None), docs[7], docs[7], (None, "u", "no id", None, None), (None, "v", "no id", None, None), (None, "v", "no id", None, None), (None, None, docs[7][2], None, None), (None, None, None, None, None)]


def brute(docs, least=0):
    """A capture for each id, and for each url and html without one."""
    first = {}
    for i, _, html, *_ in sorted((d for d in docs if d[0] is not None), key=lambda d: d[0]):
        first.setdefault(html or "", i)
    out = {}
    for i, url, html, *_ in docs:
        payload = (html or "").encode()
        lead = first.get(html or "", i) if len(payload) >= least else i
        out[(i,) if i is not None else (url, html)] = (i, len(payload), warc.base32_sha1(payload), "response" if lead == i else "revisit", None if lead == i else lead)
    return Counter(map(repr, out.values()))


def test_round_trip(spark, monkeypatch):
    docs = corpus()
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 20_000)
    monkeypatch.setattr(warc, "BATCH_BYTES", 5_000)
    for least in (0, 14):
        rows = warc.page_captures(spark.createDataFrame(docs, DDL).repartition(3), least).collect()
        assert Counter(repr((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in rows) == brute(docs, least)
        assert all(r.request_id and r.metadata_id and (r.page_id is None or r.request_id == f"<urn:request:{r.page_id}>") for r in rows)
        assert all(r.digest_ok for r in rows if r.record_type == "response")


def test_archives_are_plain_warc(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 20_000)
    warc.write_archives(spark.createDataFrame(corpus(), DDL).repartition(1), f"file://{tmp_path}/w")
    files = glob.glob(f"{tmp_path}/w/**/*.gz", recursive=True)
    sizes = [len(gzip.decompress(open(f, "rb").read())) for f in files]
    assert len(files) > 3 and sum(x > 25_000 for x in sizes) == 1  # a single record is longer than that
    records = [h for f in files for h, _ in warc.records_of(gzip.decompress(open(f, "rb").read()))]
    assert {h["warc-type"] for h in records} == {"request", "response", "revisit", "metadata"}
    assert all(h["warc-concurrent-to"].startswith("<urn:capture:") for h in records if h["warc-type"] in ("request", "metadata"))


def test_payloads_come_back(spark, tmp_path):
    warc.write_archives(spark.createDataFrame(corpus(), DDL), f"file://{tmp_path}/w")
    got = {r.record_id: bytes(r.payload) for r in warc.read_archives(spark, f"file://{tmp_path}/w", payloads=True).where("record_type = 'response'").collect()}
    assert got["<urn:capture:502>"] == corpus()[302][2].encode() and got["<urn:capture:500>"] == b""


def test_empty_table(spark):
    assert warc.page_captures(spark.createDataFrame([], DDL)).count() == 0
