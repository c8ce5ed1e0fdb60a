import hashlib
import random

import numpy as np

from ledgerlake.llm import substrings
from ledgerlake.llm.suffixarray import permuted_common_prefixes, suffix_array

SCHEMA = "doc_id long, text string, spans string"


def brute(texts, length):
    """Rows of the contract from a dictionary of all strings."""
    seen = {}
    for d, t in texts:
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            seen[b[i:i + length]] = seen.get(b[i:i + length], 0) + 1
    out = []
    for d, t in texts:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        n_spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((d, len(b), int(gone.sum()), n_spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_suffix_array_against_sorting():
    rng = random.Random(3)
    for case in range(60):
        n = rng.randint(1, 200)
        t = [rng.randint(1, rng.choice([1, 2, 3, 50, 6000])) for _ in range(n)] + [0]
        want = sorted(range(len(t)), key=lambda i: t[i:])
        assert suffix_array(np.array(t)).tolist() == want, t
    t = np.array(list(b"abracadabra" * 30) + [0])
    sa = suffix_array(t)
    plcp = permuted_common_prefixes(t.astype(np.uint8), sa, 20)
    for a, b in zip(sa[:-1], sa[1:]):
        n = 0
        while n < 20 and b + n < len(t) and a + n < len(t) and t[a + n] == t[b + n]:
            n += 1
        assert min(20, int(plcp[b])) >= n and (plcp[b] == n or n + max(a, b) >= len(t))


def shared_texts(seed, n=40):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdéß ") for _ in range(rng.randint(2, 9)))
    text = lambda k: " ".join(word() for _ in range(k))
    shared = [text(rng.randint(6, 25)) for _ in range(6)]
    out = []
    for d in range(n):
        parts = [text(rng.randint(0, 15)) for _ in range(3)]
        for _ in range(rng.randint(0, 2)):
            parts.insert(rng.randint(0, len(parts)), rng.choice(shared))
        out.append((d, "".join(parts)))
    return out


def test_against_brute_force(spark):
    for length, gram, hot in ((30, 8, 2000), (30, 8, 2), (17, 5, 2000)):
        texts = shared_texts(length + hot) + [(100, None), (101, ""), (102, "a" * 300), (103, "ab" * 90 + "c" + "ab" * 90),
                                              (104, "x\x00y" * 40), (105, "é" * 100)]
        df = spark.createDataFrame([(d, t, "clash") for d, t in texts], SCHEMA)
        got = substrings.digest(df, length=length, gram=gram, hot=hot)
        assert rows(got) == brute(texts, length), (length, gram, hot)


def test_repeated_and_missing_ids(spark):
    texts = [(1, "abcdefghijklmnopqrstuvwxyz" * 2), (1, "other text " * 3), (None, "abcdefghijklmnopqrstuvwxyz"), (None, None)]
    df = spark.createDataFrame([(d, t, "x") for d, t in texts], SCHEMA)
    assert rows(substrings.digest(df, length=20, gram=6)) == brute(texts, 20)
    out = substrings.cut(df, length=20, gram=6)
    assert out.columns == df.columns and out.count() == 4


def test_cut_leaves_valid_text(spark):
    df = spark.createDataFrame([(1, "é" * 7 + "abcdefghij" * 3, "x"), (2, "ü" + "abcdefghij" * 3, "y"), (3, "alone", "z"),
                                (4, "oné0123456789klmnopqrstuvwxyz", "x"), (5, "twĩ0123456789klmnopqrstuvwxyz", "x")], SCHEMA)
    got = {r["doc_id"]: r["text"] for r in substrings.cut(df, length=25, gram=6).collect()}
    assert got == {1: "é" * 7, 2: "ü", 3: "alone", 4: "on", 5: "tw"}


def test_empty(spark):
    assert rows(substrings.digest(spark.createDataFrame([], SCHEMA))) == []


def test_whole_table(spark):
    from ledgerlake.llm.queries import QUERIES
    d = "/root/testdata/sf0.001"
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    assert rows(QUERIES["op7_substrings"](spark, d)) == brute(texts, 200)


def test_few_keys_hold_most_rows(spark, monkeypatch):
    passage = "".join(random.Random(8).choice("abcdefgh") for _ in range(70))
    texts = [(d, f"{d:04d}" * 6 + passage + f"{d * 7:05d}" * 5) for d in range(120)] + [(d, passage * 2) for d in range(200, 260)]
    texts += shared_texts(9, 20)
    df = spark.createDataFrame([(d, t, "x") for d, t in texts], SCHEMA)
    for heavy in (1, 5, 2000):
        monkeypatch.setattr(substrings, "HEAVY", heavy)
        for hot in (10, 2000):
            assert rows(substrings.digest(df, length=30, gram=8, hot=hot)) == brute(texts, 30), (heavy, hot)


def test_recursion_over_many_names():
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(6000)]
    t = np.frombuffer(" ".join(rng.choices(words, k=20_000)).encode(), np.uint8).astype(np.int32)
    t = np.concatenate([t, t[:3000], [0]])
    sa = suffix_array(t)
    whole = bytes(t.astype(np.uint8))
    assert sorted(sa.tolist()) == list(range(len(t)))
    assert all(whole[a:a + 4000] < whole[b:b + 4000] for a, b in zip(sa[:-1].tolist(), sa[1:].tolist()))
