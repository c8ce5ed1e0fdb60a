import math
import re
from collections import Counter

from ledgerlake.llm import lmscore

SCHEMA = "doc_id long, text string, score string"


def brute(docs, order, backoff=0.4, least=2):
    texts = [(d, [w for w in re.split("[ \t-\r]+", (t or "").lower()) if w]) for d, t in docs]
    counts = Counter(tuple(w[i:i + n]) for _, w in texts for n in range(1, order + 1) for i in range(len(w) - n + 1))
    total = sum(len(w) for _, w in texts)

    def value(gram):
        if len(gram) == 1:
            return math.log(counts[gram] / total)
        if counts[gram] >= least:
            return math.log(counts[gram] / counts[gram[:-1]])
        return math.log(backoff) + value(gram[1:])
    return sorted((d, len(w), sum(value(tuple(w[max(0, i - order + 1):i + 1])) for i in range(len(w))) / len(w) if w else None) for d, w in texts)


def same(got, want):
    got = sorted(tuple(r) for r in got)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:2] == w[:2] and (g[2] is w[2] is None or abs(g[2] - w[2]) < 1e-9), (g, w)


DOCS = [(1, "a b c a b d a b c"), (2, "A b\tc x\x0by"), (3, None), (4, " \n"), (5, "z"), (6, "the of " * 500), (6, "the of " * 500), (7, "a b c a b e q")]


def test_small(spark):
    df = spark.createDataFrame([(d, t, "clash") for d, t in DOCS], SCHEMA)
    for order in (1, 2, 3, 5):
        for chars in (1 << 20, 40):
            same(lmscore.scores(df, order=order, block_chars=chars).collect(), brute(DOCS, order))


def test_empty(spark):
    assert lmscore.scores(spark.createDataFrame([], SCHEMA)).collect() == []


def test_whole_table(spark):
    from ledgerlake.llm.queries import QUERIES
    d = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    same(QUERIES["op3_lmscore"](spark, d).collect(), brute(docs, 3))
