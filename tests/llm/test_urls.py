import duckdb
import numpy as np

from ledgerlake.llm import urls

SCHEMA = "page_id long, url string, host string"


def rows(df):
    return {r["page_id"]: tuple(r)[1:] for r in df.collect()}


CASES = ["https://A.Example.com/en/x?q#f", "http://www.example.com/en/", "https://x.net/es/1", "https://net/fr/", "https://notnet.org/es/",
         "ftp://ads-track.org?x=/en/", "no scheme", None, "", "https://spam-farm.example.org/a://b", "x://y://z", "http://EXÄ.com", "//", "http://cheap-pills.net/fr/a"]
WANT = [("a.example.com", "/en/x", "example.com/en/", "block", False), ("www.example.com", "/en/", "www.example.com/en/", "allow", False),
        ("x.net", "/es/1", "net/es/", "block", False), ("net", "/fr/", "net/fr/", "block", False), ("notnet.org", "/es/", None, "allow", False),
        ("ads-track.org", "", None, "block", True), ("", "", None, "allow", False), ("", "", None, "allow", False), ("", "", None, "allow", False),
        ("spam-farm.example.org", "/a://b", None, "block", True), ("y:", "//z", None, "allow", False), ("exÄ.com", "", None, "allow", False),
        ("", "", None, "allow", False), ("cheap-pills.net", "/fr/a", "net/fr/", "block", True)]


def test_cases_both_ways(spark):
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(CASES)] + [(0, CASES[0], None)], SCHEMA)
    for most in (urls.MOST_BYTES, -1):
        got = urls.judge(df, most_bytes=most, per_shard=5)
        assert got.count() == len(CASES) + 1
        assert rows(got) == dict(enumerate(WANT))


def test_cascade_is_exact_over_its_universe():
    rng = np.random.default_rng(4)
    for n, share in ((1, 1.0), (1000, 0.5), (20000, 0.01), (20000, 0.9), (5000, 0.0)):
        h1, h2 = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for _ in range(2))
        listed = rng.random(n) < share
        levels = urls.compile_levels(h1, h2, listed)
        assert (urls.is_listed(levels, h1, h2) == listed).all()
        if share == 0.01:
            assert sum(len(b) for b, _ in levels) < n // 8  # far below a bit a key


def test_listed_paths(spark):
    df = spark.createDataFrame([(1, "http://h.org/a", ""), (2, "http://h.org/b", ""), (3, "http://i.org/a", "")], SCHEMA)
    listed = spark.createDataFrame([("h.org/a",), ("i.org",), ("absent",)], "key string")
    assert {k: v[3] for k, v in rows(urls.judge(df, listed)).items()} == {1: "block", 2: "allow", 3: "block"}


def test_empty(spark):
    assert urls.judge(spark.createDataFrame([], SCHEMA)).collect() == []


def test_oracle(spark):
    from ledgerlake.llm.queries import ORACLE, QUERIES
    from oracle_compare import compare
    con = duckdb.connect()
    con.execute("create view pages as select * from '/root/testdata/sf0.1/pages.parquet'")
    ok, message = compare(QUERIES["op4_urls"](spark, "/root/testdata/sf0.1"), con, ORACLE["op4_urls"])
    assert ok, message
