import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from ledgerlake.llm import packing

SCHEMA = "doc_id long, text string, length string"


def brute_ids(text):
    t = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    return t.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]


def check(rows, docs, capacity):
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    for doc, text in docs.items():
        want, at = brute_ids(text), 0
        for r in sorted(by_doc[doc], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(want)
            ids = np.array(want[at:at + r["length"]], "<u4")
            assert len(ids) == r["length"] and zlib.crc32(ids.tobytes()) == r["ids_crc32"]
            at += r["length"]
        assert at == len(want)
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == capacity or at & (at - 1) == 0


def test_every_id_once_without_padding(spark):
    docs = {1: None, 2: "", 3: "Hello  world's été | x\n\n12 ab!'s", 4: "word " * 900, 5: "ΑΣ İ 你好 é",
            6: "a" * 5000, 7: "café   \u0085 ok", 8: "it's we'll 'tis"}
    df = spark.createDataFrame([(k, v, "x") for k, v in docs.items()], SCHEMA).coalesce(1)
    rows = packing.digest(packing.pack(df, capacity=128, window=2)).collect()
    check(rows, docs, 128)


def test_whole_table(spark):
    from ledgerlake.llm.queries import QUERIES
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    check(QUERIES["op1_packing"](spark, "/root/testdata/sf0.001").collect(), docs, 4096)


def test_empty_and_repeats(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert packing.pack(empty).collect() == []
    twice = spark.createDataFrame([(1, "a b", ""), (1, "a b", ""), (None, None, None)], SCHEMA).coalesce(1)
    rows = packing.pack(twice).collect()
    assert sum(r["length"] for r in rows) == 3 + 3 + 1


def test_lowest_cost_sequence_first():
    pieces, cost = packing.lay_out([5, 4, 3, 2, 1, 1], [8, 8], 1.0, 0.1)
    assert {(i, s) for i, _, _, s, _ in pieces} == {(0, 0), (1, 1), (2, 1), (3, 0), (4, 1), (5, 0)}
    assert abs(cost[0] - cost[1]) < 1.5
