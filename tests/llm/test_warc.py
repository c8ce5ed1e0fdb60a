import hashlib
import json

import pytest

from ledgerlake.llm import warc

PAGE = "<html><head><title> A &amp; B </title><script>x<y</script></head><body><p>One&nbsp;two</p><a href='/x?a=1&amp;b'>l</a><br>three</body>"


def test_links_headers_and_digests(spark):
    df = spark.createDataFrame([(1, "http://h/\r\nX: y", PAGE, "c"), (2, None, None, "c"), (2, None, None, "c"), (3, "u", "é" * 50000, "c")],
                               "page_id long, url string, html string, record string")
    sources = {r["page_id"]: r["record"] for r in warc.responses(df).collect()}
    got = warc.derive(warc.responses(df)).collect()
    assert len(got) == 8
    for r in got:
        source, block, end = warc.read_record(sources[r["page_id"]])
        headers, data, _ = warc.read_record(r["record"])
        assert headers["WARC-Refers-To"] == source["WARC-Record-ID"] == r["refers_to"] and headers["WARC-Record-ID"] == r["record_id"]
        assert headers["WARC-Type"] == r["kind"] and headers["WARC-Block-Digest"] == r["block_digest"]
        if r["kind"] == "metadata":
            facts = json.loads(data)
            assert facts["source"] == source and facts["http"]["Content-Type"].startswith("text/html")
            if r["page_id"] == 1:
                assert facts["title"] == "A & B" and facts["links"] == ["/x?a=1&b"]
        elif r["page_id"] == 1:
            assert data.decode() == "A & B\nOne two\nl\nthree"
    assert warc.derive(warc.responses(df.limit(0))).collect() == []


def test_files_round_trip(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    derived = warc.derive(warc.responses(df))
    want = sorted(bytes(r["record"]) for r in derived.collect())
    out = warc.files(derived, most_bytes=20000).collect()
    assert len(out) > 1 and len({r["name"] for r in out}) == len(out)
    assert sorted(warc.record(list(h.items())[:-1], b) for r in out for h, b in warc.read_records(r["content"])) == want


def test_damaged_records_raise():
    good = warc.response("http://h/", "page")
    for bad in (good.replace(b"page", b"pagf"), good[:-6], b"x" + good):
        with pytest.raises(ValueError):
            warc.derivatives(bad)
    with pytest.raises(ValueError):
        warc.derivatives(warc.derivatives(good)[0][4])


def test_whole_table(spark):
    from ledgerlake.llm.queries import QUERIES
    d = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{d}/pages.parquet").collect()}
    got = QUERIES["op10_warc"](spark, d).collect()
    assert len(got) == 2 * len(pages)
    for r in got:
        import base64
        p = pages[r["page_id"]]
        assert r["source_payload_digest"] == "sha1:" + base64.b32encode(hashlib.sha1(p["html"].encode()).digest()).decode()
        assert r["target_uri"] == p["url"]


def test_damaged_and_sparse_records_get_rows(spark):
    good = warc.response("http://h/", "page <p>two")
    block = b"HTTP/1.1 200 OK\r\nSet-Cookie:a=1\r\nSet-Cookie: b=2\r\nX:y\r\n\r\n<p>hi"
    sparse = warc.record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:x>"), ("WARC-Date", "2024-01-01T00:00:00Z"),
                          ("WARC-Target-URI", "http://h/2")], block).replace(b"WARC-Type: ", b"WARC-Type:")
    rows = [(1, good), (2, None), (3, good[:-9]), (4, b""), (5, sparse), (6, warc.derivatives(good)[0][4])]
    got = {}
    for r in warc.derive(spark.createDataFrame([(k, None if b is None else bytearray(b)) for k, b in rows], "page_id long, record binary")).collect():
        got.setdefault(r.page_id, []).append(r)
    assert {k: [r.kind for r in v] for k, v in got.items()} == {
        1: ["metadata", "conversion"], 2: ["damaged"], 3: ["damaged"], 4: ["damaged"], 5: ["metadata", "conversion"], 6: ["damaged"]}
    assert all((r.reason is None) == (r.kind != "damaged") for v in got.values() for r in v)
    facts = json.loads(warc.read_record(got[5][0].record)[1])
    assert facts["http"] == {"Set-Cookie": ["a=1", "b=2"], "X": "y"} and facts["payload_digest"] == warc.sha1(b"<p>hi")
