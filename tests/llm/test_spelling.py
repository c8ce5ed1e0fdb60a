"""Operator 13: trees, letter order, the noise's hash, and the whole against deletion keys over all words."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import spelling as S
from ledgerlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
LOW = {i: i + 32 for i in range(65, 91)}


def brute(rows):
    """{word: (form, root, n, n_near, form_n)} by shared deletion keys."""
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'null' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near, keys = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            keys[w[:i] + "*" + w[i + 1:]].add(w)
            if (less := w[:i] + w[i + 1:]) in words:
                near[w].add(less)
                near[less].add(w)
    for group in keys.values():
        for w in group:
            near[w] |= group - {w}
    forms = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        if best and words[best] >= 10 * n:
            forms[w] = best

    def root(w):
        while w in forms:
            w = forms[w]
        return w
    return {w: (forms.get(w), root(w), n, len(near[w]), words.get(forms.get(w))) for w, n in words.items()}


def found(frame):
    rows = frame.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_query_equals_brute_force(spark):
    out = QUERIES["op13_spelling"](spark, SF)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert found(out) == brute(rows)


def test_joined_crcs():
    rng, shifts = np.random.default_rng(1), S.Shifts()
    a = [rng.bytes(int(n)) for n in rng.integers(0, 30, 200)]
    b = [rng.bytes(int(n)) for n in rng.integers(0, 400, 200)]
    crcs = [np.array([zlib.crc32(x) for x in side], np.uint32) for side in (a, b)]
    assert shifts.joined(*crcs, np.array([len(x) for x in b])).tolist() == [zlib.crc32(x + y) for x, y in zip(a, b)]


def as_rows(words):
    return S.matrix(pa.array([w.encode("latin-1") for w in words], pa.binary()))


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


@pytest.mark.parametrize("letters, size", [("ab", 60), ("abcÿé", 200), ("abcdefgh", 300)])
@pytest.mark.parametrize("less", [0, 1])
def test_cell_finds_every_near_word(letters, size, less):
    rng = np.random.default_rng(7)
    words = sorted({"".join(rng.choice(list(letters), 8)) for _ in range(size)})
    asked = sorted({"".join(rng.choice(list(letters), 8 - less)) for _ in range(size)})
    row, number = S.Cell(as_rows(words)).near(as_rows(asked))
    got = list(zip(row.tolist(), number.tolist()))
    assert len(got) == len(set(got))
    assert set(got) == {(i, j) for i, a in enumerate(asked) for j, b in enumerate(words) if one_edit(a, b)}


def test_large_class_of_equal_letters():
    """Many words of the same letters are met by the search word's own edits."""
    rng = np.random.default_rng(2)
    words = sorted({"".join(rng.permutation(list("aabbccddee"))) for _ in range(3000)})
    asked = [w[:3] + "f" + w[4:] for w in words[:40]] + [w[1:] for w in words[:40]]
    for group in (asked[:40], asked[40:]):
        row, number = S.Cell(as_rows(words)).near(as_rows(group))
        assert set(zip(row.tolist(), number.tolist())) == {
            (i, j) for i, a in enumerate(group) for j, b in enumerate(words) if one_edit(a, b)}


EDGES = [(1, "Kitchen kitchen KITCHEN kitchen " * 3 + "kitchan kitchan kitchens kitchens"), (2, "kitchèn kitchèn ÀÀÀÀÀÀÀ ÀÀÀÀÀÀÀ àààÀÀÀÀ"),
         (None, "kitchen nullword nullword"), (None, "nullword"), (3, None), (4, ""), (5, "short words too"), (6, "x×÷Ð×÷Ðx x×÷Ð×÷Ðx"),
         (7, "zz" * 30_000 + " " + "zz" * 30_000 + " " + "zz" * 30_000 + "z " + "zz" * 30_000 + "z"), (8, "日本kitchen語kitchen kitchen’kitchen"),
         (8, "日本kitchen語kitchen kitchen’kitchen"), (9, "anagram nagaram anagram nagaram anagran anagran " + "kitchen " * 300)]


@pytest.mark.parametrize("cell, sample", [(S.CELL, S.SAMPLE), (2, 8), (2, 100)])
def test_edges_and_small_cells(spark, monkeypatch, cell, sample):
    monkeypatch.setattr(S.plan_cells, "__defaults__", (cell, sample))
    docs = spark.createDataFrame(EDGES, "doc_id long, text string").repartition(3)
    clash = docs.select("*", *[F.lit(1).alias(c) for c in ("word", "n", "latin", "length", "search")])
    assert found(S.variants(clash)) == brute(EDGES)


def test_chains_reach_their_root(spark):
    words = {"abcdefg": 2000, "abcdefh": 150, "abcdeih": 12, "abcdeiha": 2}  # each near its neighbour only
    docs = spark.createDataFrame([(1, f"{w} " * n) for w, n in words.items()], "doc_id long, text string")
    want = brute([tuple(r) for r in docs.collect()])
    assert found(S.variants(docs)) == want
    roots = S.roots(spark.createDataFrame([(f"w{k}", f"w{k + 1}") for k in range(11)], "word string, form string"))
    assert {tuple(r) for r in roots.collect()} == {(f"w{k}", "w11") for k in range(11)}


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert S.variants(empty).count() == 0
    assert S.variants(spark.createDataFrame([(1, "only once here: seldomly")], "doc_id long, text string")).count() == 0
