"""Operator 11: interval reads against full sums, and the search against a plain loop."""

import math
import os
import re
import sys
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlake.llm import ranked
from ledgerlake.llm.queries import ORACLE, QUERIES

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from oracle_compare import compare, duck_connect  # noqa: E402

SF = "/root/testdata/sf0.001"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOW = {i: i + 32 for i in range(65, 91)}


def brute(docs, items, k=50):
    """item_id, rank, doc_id, score by a loop over all documents."""
    words = [(d, Counter(TERM.findall((t or "").translate(LOW)))) for d, t in docs]
    words = [(d, c) for d, c in words if c]
    total, length, df = len(words), sum(sum(c.values()) for _, c in words), Counter(t for _, c in words for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in words:
            m = 50 + 50 * sum(c.values()) * total // length
            s = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                    for t in set(TERM.findall((text or "").translate(LOW))) if c[t])
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out += [(item, r, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def rows(frame):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in frame.collect()), key=str)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.dictionaries(st.integers(0, 40), st.integers(0, 6), max_size=30), min_size=1, max_size=6),
       st.integers(1, 8), st.integers(1, 4), st.integers(1, 12))
def test_intervals_settle_on_the_exact_best(columns, k, step, floor):
    lists, sums = [], np.zeros(41, np.int64)
    for column in columns:
        d, x = np.array(list(column), np.int64), np.array(list(column.values()), np.int64)
        order = np.argsort(-x, kind="stable")
        lists.append((d[order], x[order]))
        sums[d] += x
    found, scores = ranked.nra(lists, 41, k, floor, step)
    assert (scores == sums[found]).all() and len(set(found.tolist())) == len(found)
    want = sorted((-s, d) for d, s in enumerate(sums.tolist()) if s >= floor)[:k]
    assert sorted((-s, d) for s, d in zip(scores.tolist(), found.tolist()))[:k] == want


def test_query_equals_sql_and_loop(spark):
    out = QUERIES["op11_ranked"](spark, SF)
    assert out.columns == ["item_id", "rank", "doc_id", "score"] and dict(out.dtypes)["rank"] == "int"
    ok, said = compare(out, duck_connect(SF), ORACLE["op11_ranked"])
    assert ok, said
    read = lambda n, *c: [tuple(r) for r in spark.read.parquet(f"{SF}/{n}.parquet").select(*c).collect()]
    assert rows(out) == brute(read("documents", "doc_id", "text"), read("benchmark", "item_id", "text"))


EDGES = [(1, "Alpha beta-beta GAMMA"), (2, "alpha beta"), (3, "alpha beta"), (3, "alpha beta"), (None, "alpha beta"),
         (None, "delta"), (4, None), (5, ""), (6, " ,;\x7f\x00-"), (7, "été ÉTÉ alpha_beta 10² x y"), (8, "beta " * 50_000),
         (9, "gamma " + "filler " * 3000)]
ITEMS = [(1, "alpha, BETA"), (1, "alpha, BETA"), (2, None), (3, "!?"), (4, "absent"), (None, "été gamma"), (5, "delta alpha " * 400)]


@pytest.mark.parametrize("parts", [1, 5])
def test_edges_against_the_loop(spark, monkeypatch, parts):
    docs = spark.createDataFrame(EDGES, "doc_id long, text string").withColumn("item", F.lit(0)).withColumn("n", F.lit("clash"))
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("rank", F.lit("clash"))
    for k in (3, 50):
        assert rows(ranked.search(docs.repartition(parts), items, k)) == brute(EDGES, ITEMS, k)


def test_many_blocks_and_pieces_give_the_same(spark, monkeypatch):
    docs, items = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "benchmark"))
    whole = rows(ranked.search(docs, items))
    monkeypatch.setattr(ranked, "BLOCK_ITEMS", 9)
    assert rows(ranked.search(docs.repartition(3), items)) == whole


def test_shards_cut_into_pieces(monkeypatch):
    rng, got = np.random.default_rng(5), []
    n = rng.integers(1, 50, 5000)
    pairs = np.unique(rng.integers(0, 5000 * 20, 30_000))
    for cells in (1 << 24, 1):
        monkeypatch.setattr(ranked, "CELLS", cells)
        shards = ranked.Shards(np.arange(20) * 100, [np.arange(20), np.array([3, 7])], 5000, int(n.sum()), 50)
        for a in range(0, 5000, 2500):
            own = (pairs // 20 >= a) & (pairs // 20 < a + 2500)
            shards.add(np.arange(a, a + 2500), np.zeros(2500, bool), n[a:a + 2500], pairs[own] // 20 - a, pairs[own] % 20,
                       np.ones(own.sum(), np.int64))
        got.append({i: [x.tolist() for x in t] for i, t in shards.tops.items()})
    assert got[0] == got[1] and len(got[0][0][0]) == 50


def test_products_beyond_64_bits():
    tf, n, w = np.array([1, 2]), np.array([10**7, 1]), np.array([5, 5])
    m = [50 + 50 * 10**7 * 5 * 10**10 // 10**13, 50 + 50 * 5 * 10**10 // 10**13]
    assert ranked.impacts(tf, n, w, 5 * 10**10, 10**13).tolist() == [
        5 * (10**9 * t // (1000 * t + 20 * x)) for t, x in zip([1, 2], m)]


def test_empty_tables(spark):
    docs, items = spark.createDataFrame(EDGES, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")
    assert ranked.search(docs.limit(0), items).count() == 0
    assert ranked.search(docs, items.limit(0)).count() == 0
