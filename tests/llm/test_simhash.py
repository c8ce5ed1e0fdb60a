import itertools
import random

import numpy as np
import xxhash

from ledgerlake.llm import simhash

SCHEMA = "doc_id long, text string, fp string"


def brute_fp(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    root = {d: d for d in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in itertools.combinations(fps, 2):
        if (fps[a] ^ fps[b]).bit_count() <= 2:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {d: find(d) for d in fps}


def test_trie_against_all_pairs():
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(30)]
    f = set(base)
    for b in base[:12]:
        for _ in range(60):
            x = b
            for _ in range(rng.randint(1, 4)):
                x ^= 1 << rng.randrange(64)
            f.add(x)
    f = np.array(sorted(f), np.uint64)
    want = {(i, j) for i, j in itertools.combinations(range(len(f)), 2) if int(f[i] ^ f[j]).bit_count() <= 2}
    for leaf in (0, 1, 64):
        got = [(int(i), int(j)) for a, b in simhash.near_pairs(f, 0, 2, leaf, 50) for i, j in zip(a, b)]
        assert len(got) == len(set(got)) and set(got) == want


def test_whole_table_against_brute_force(spark):
    from ledgerlake.llm.queries import QUERIES
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    fps = {d: brute_fp(t) for d, t in docs.items()}
    want = brute_components(fps)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op6_simhash"](spark, "/root/testdata/sf0.001").collect()}
    assert got == {d: (f"{fps[d]:016x}", want[d]) for d in docs}


def test_chains_ties_nulls_and_repeats(spark, monkeypatch):
    texts = ["", None, " \n ", "One", "one", "one two", "ONE\ttwo", "a b c d", "a b c d"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(3, "One", "x"), (None, "a b c d", "x")], SCHEMA)
    fps = {i: brute_fp(t) for i, t in enumerate(texts)}
    want = brute_components(fps)
    got = simhash.digest(simhash.near_duplicates(docs)).collect()
    assert len(got) == 11
    for r in got:
        if r["doc_id"] is not None:
            assert r["component_id"] == want[r["doc_id"]] and int(r["fingerprint"], 16) == fps[r["doc_id"]]
        else:
            assert r["component_id"] == 7
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want.values()))


def test_keep_one_judges_rows(spark):
    """Null ids and one id with unlike texts: every group keeps exactly one row, the one with the smallest id."""
    one, two, three, four, five = (" ".join(random.Random(k).choices("abcdefghijklmnopqrstuvwxyz", k=80)) for k in range(5))
    docs = [(None, one, "unique null"), (None, two, "nulls only"), (None, two, "nulls only"), (7, three, "repeated id"),
            (7, four, "larger id"), (3, four, "smaller id"), (None, four, "null id"), (9, five, "copies"), (9, five, "copies")]
    kept = simhash.keep_one(spark.createDataFrame(docs, SCHEMA))
    assert kept.columns == ["doc_id", "text", "fp"]
    assert sorted(map(str, map(tuple, kept.collect()))) == sorted(map(str, (docs[k] for k in (0, 1, 3, 5, 7))))


def test_long_chain_is_one_component(spark):
    chain, x = [0], 0
    for b in range(40):
        x |= 1 << b
        chain.append(x)
    df = spark.createDataFrame([(v,) for v in chain], "fp long")
    found = simhash.components(simhash.trie_links(df)).collect()
    assert {r["node"] for r in found} == set(chain) and {r["root"] for r in found} == {0}


def test_empty(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
