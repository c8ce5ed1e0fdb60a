"""Operator 12: the file format, files written by Spark, random access."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import public_tokenizers
from ledgerlake.llm import tokenfiles as T
from ledgerlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_format_gives_any_id_span_and_document():
    rng = np.random.default_rng(3)
    ids = np.concatenate([rng.integers(0, 300, 4000), rng.integers(0, 1 << 32, 3000, dtype=np.uint64),
                          rng.integers(0, 70_000, 3001)]).astype(np.uint32)
    rng.shuffle(ids)
    lengths = [1, 2, 7000, len(ids) - 7003]
    data = T.encode([5, None, 6, 6], lengths, ids, 3, 4)
    for file in (T.TokenFile(data, checked=True), T.TokenFile(data + b"\n", checked=True)):
        assert [file[i] for i in range(len(ids))] == ids.tolist()
        for a, b in np.sort(rng.integers(0, len(ids) + 1, (300, 2))).tolist() + [[0, len(ids)], [len(ids)] * 2, [512, 1024]]:
            assert (file.span(a, b) == ids[a:b]).all()
        assert [len(file.document(k)) for k in range(4)] == lengths
        assert (file.part, file.number, file.nulls.tolist()) == (3, 4, [False, True, False, False])
    with pytest.raises(IndexError):
        file[len(ids)]
    with pytest.raises(ValueError):
        T.TokenFile(data[:500] + bytes([data[500] ^ 1]) + data[501:], checked=True)
    with pytest.raises(ValueError):
        T.TokenFile(b"x" * 100)


@pytest.mark.parametrize("ids", [[0], [255], [256], [65535], [65536], [4294967295], list(range(513)), [70_000] * 1025])
def test_format_at_the_bounds_of_chunks_and_blocks(ids):
    file = T.TokenFile(T.encode([1], [len(ids)], np.array(ids, np.uint32)))
    assert [file[i] for i in range(len(ids))] == ids and file.document(0).tolist() == ids


def expected(rows):
    """(doc_id, start, n_tokens, crc) by the library, rows in their order with nulls last."""
    library, out, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        out.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def got(frame):
    return sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in frame.collect()), key=lambda r: r[1])


def test_query_equals_the_library(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    out = QUERIES["op12_tokenfiles"](spark, SF)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert got(out) == expected(rows)


EDGES = [(7, "a b"), (7, "c"), (7, "a b"), (None, "null id"), (None, None), (3, None), (4, ""), (-2, "x <|endoftext|> y"),
         (9, "w " * 60_000), (8, "日本語 ünï Å"), (2**62, "far")]


def test_edge_rows_small_files_and_random_access(spark, scratch):
    docs = spark.createDataFrame(EDGES, "doc_id long, text string").repartition(3).withColumn("value", F.lit("clash"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    T.write(docs.withColumn("row", F.lit(1)).withColumn("part", F.lit(2)), f"{scratch}/files", file_tokens=3)
    assert T.index(spark, f"{scratch}/files").count() > 3
    whole = T.read(spark, f"{scratch}/files")
    ties = lambda x: sorted((r[0] is None, r[0], r[2], r[3]) for r in x)  # noqa: E731  rows of one doc_id may swap
    assert ties(got(whole)) == ties(expected(rows))
    back = sorted(whole.collect(), key=lambda r: r.start)
    assert [r.start for r in back] == np.concatenate([[0], np.cumsum([r.n_tokens for r in back])[:-1]]).tolist()
    assert [r.doc_id for r in back] == sorted([r[0] for r in rows], key=lambda d: (d is None, d or 0))
    ids = np.concatenate([np.frombuffer(r.ids, "<u4") for r in back])
    wanted = spark.createDataFrame([(k,) for k in [0, 0, 5, 17, len(ids) - 1, len(ids), -1, None]], "at long")
    assert sorted(map(tuple, T.tokens_at(wanted, f"{scratch}/files").collect())) == [
        (k, int(ids[k])) for k in sorted({0, 5, 17, len(ids) - 1})]


def test_empty_table(spark, scratch):
    T.write(spark.createDataFrame([], "doc_id long, text string"), f"{scratch}/files")
    assert T.read(spark, f"{scratch}/files").count() == 0


@pytest.mark.parametrize("file", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_of_either_tokenizer_file(spark, scratch, file):
    texts = ["Hello World", " Two  spaces\n", "<|endoftext|> it's", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    T.write(docs, f"{scratch}/files", tokenizer_file=public_tokenizers.path(file))
    library = Tokenizer.from_file(public_tokenizers.path(file))
    for r in T.read(spark, f"{scratch}/files").collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [2]
