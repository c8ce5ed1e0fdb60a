"""Each stage of the pipeline against brute force on its own input."""

import re

import numpy as np

import corpus_pipeline
from ledgerlake.llm import latent, quality
from test_packing import check
from test_quality import brute as brute_counts
from test_simhash import brute_components, brute_fp
from test_substrings import brute as brute_cut  # noqa: F401  (the digests; the texts are cut below)

D = "/root/testdata/sf0.001"
SPACES = " \t\n\x0b\x0c\r"


def brute_clean(text):
    text = text or ""
    n, chars, *_, failed = brute_counts(text)
    lines = [x for x in text.split("\n") if x.strip(SPACES)]

    def bad(x):
        words = [w for w in re.split("[ \t-\r]+", x) if w]
        return (sum(c in "#*$%&|<>{}" for c in x) > 0.25 * len(words) or 2 * x.count("!!") > 0.5 * len(words)
                or sum(c in "|>«»•·" for c in x) > 0.25 * len(words) or len(words) <= 20 and any(s in x.lower() for s in quality.NOTICES)
                or len(x) <= 240 and len(words) > 1 and all(w.lower() in quality.MENU for w in words))
    good = list(dict.fromkeys(x for x in lines if not bad(x)))
    left = sum(len(re.sub("[ \t-\r]", "", x)) for x in good)
    kept = not failed and left >= 0.5 * chars
    return (text if len(good) == len(lines) else "\n".join(good)) if kept else None


def cut_text(texts, length=200):
    seen = {}
    for t in texts.values():
        b = t.encode()
        for i in range(len(b) - length + 1):
            seen[b[i:i + length]] = seen.get(b[i:i + length], 0) + 1
    out = {}
    for d, t in texts.items():
        b = t.encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        out[d] = bytes(x for x, g in zip(b, gone) if not g).decode("utf-8", "ignore") if gone.any() else t
    return out


def test_stages(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    columns = docs.columns
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    items = {r["item_id"]: latent.words_of(r["text"]) for r in spark.read.parquet(f"{D}/benchmark.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, D)
        if name == "packing":
            check(out.collect(), texts, 4096)
            break
        rows = out.collect()
        assert out.columns == columns and all(r["n_chars"] == len(r["text"]) for r in rows)
        got = {r["doc_id"]: r["text"] for r in rows}
        assert len(got) == len(rows)
        if name == "quality_rules":
            want = {d: c for d, t in texts.items() if (c := brute_clean(t)) is not None}
        elif name == "near_duplicates":
            groups = brute_components({d: brute_fp(t) for d, t in texts.items()})
            want = {d: t for d, t in texts.items() if groups[d] == d}
        elif name == "repeated_strings":
            want = cut_text(texts)
        else:
            held = {d: f" {' '.join(latent.words_of(t))} " for d, t in texts.items()}
            want = {d: t for d, t in texts.items() if not any(f" {' '.join(w)} " in held[d] for w in items.values())}
        assert got == want, (name, sorted(set(got) ^ set(want)))
        texts, docs = want, spark.createDataFrame([tuple(r) for r in rows], docs.schema)


def test_run_and_extra_columns(spark):
    assert corpus_pipeline.run(spark, D).count() > 0
    clashing = spark.read.parquet(f"{D}/documents.parquet").selectExpr("*", *[
        f"{k} AS {c}" for k, c in enumerate(("verdict", "spans", "doc", "fp", "first_id", "codes", "key", "kept", "ids", "count"))])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, clashing.limit(0), D).collect() == []
        out = stage(spark, clashing, D)
        if name == "packing":
            assert out.count() > 0
        else:
            rows = out.collect()
            assert out.columns == clashing.columns and rows
            assert all(tuple(r)[5:] == tuple(range(10)) for r in rows)
