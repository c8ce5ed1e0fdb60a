"""Operator 12: token ids in files of directly addressable codes.

A file holds the ids of whole documents.  Every id is cut into chunks of 8, 8 and 16 bits, low bits first; the chunks
of one place form a level, and an id takes part in a level only if bits of it are left.  Beside each level but the
last lies a bitmap that says which ids go on, and a rank directory with the number of set bits before every 512th
bit.  The place of an id in the next level is the rank of its bit, so any id is read with one look-up a level and
nothing else is decoded.

File (little endian)::

    head       magic 8 bytes, part, number in the part, documents, ids, levels: 5 x unsigned 64 bits
    per level  bits of a chunk, chunks, place of chunks, place of bitmap, place of ranks: 5 x unsigned 64 bits
    directory  doc_id 64 bits each, one byte each (1: the doc_id is null), first id of each and the end 64 bits each
    levels     chunks, bitmap (64-bit words), ranks (64 bits each), each padded to 8 bytes
    end        crc32 of all before, unsigned 32 bits, then a line feed that the writer adds

Scale: documents are dealt by ranges of (doc_id, row), so a doc_id that many rows share is split like any other; a
task sorts its range, streams it, and closes a file at ``file_tokens`` ids, which bounds its memory.  Files are
committed by Spark's own file writer, one row a file, so a lost task leaves nothing half written, and read by the
``binaryFile`` source; both work on any store that Spark reaches.  The first id of each file is a running total over
the files' heads: a window per part and one over the parts, whose number is ``spark.sql.shuffle.partitions``.

Defined results: null or empty text holds the end id only; rows that share a doc_id are each a document, in the order
of the table; null doc_ids come last; an empty table gives no files and no rows; extra columns are ignored.  A document
is never cut, so a file exceeds ``file_tokens`` by one document at most.
"""

from __future__ import annotations

import gc
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import select_columns, small_batches
from ledgerlake.llm.packing import END_ID, TOKENIZER, tokenizer

MAGIC = b"DACIDS01"
WIDTHS = (8, 8, 16)
BLOCK = 512
FILE_TOKENS = 1 << 22
HEAD, LEVEL = "<8s5Q", "<5Q"
HEAD_SIZE, LEVEL_SIZE = struct.calcsize(HEAD), struct.calcsize(LEVEL)
KINDS = {8: np.dtype("u1"), 16: np.dtype("<u2")}


def padded(data: bytes) -> bytes:
    return data + bytes(-len(data) % 8)


def encode(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray, part: int = 0, number: int = 0) -> bytes:
    """The bytes of a file with the documents' ids one after another."""
    heads, body, rest, bits = [], [], ids.astype(np.uint32, copy=False), 0
    directory = (np.array([d or 0 for d in doc_ids], "<i8").tobytes()
                 + padded(np.array([d is None for d in doc_ids], "u1").tobytes())
                 + np.concatenate([[0], np.cumsum(lengths)]).astype("<u8").tobytes())
    for level, width in enumerate(WIDTHS):
        bits += width
        chunks = (rest & ((1 << width) - 1)).astype(KINDS[width])
        rest = rest >> width if bits < 32 else np.zeros_like(rest)
        more = rest > 0
        last = not more.any()
        pieces = [padded(chunks.tobytes())]
        if not last:
            words = padded(np.packbits(more, bitorder="little").tobytes())
            blocks = np.frombuffer(words + bytes(-len(words) % (BLOCK // 8)), "<u8").reshape(-1, BLOCK // 64)
            ones = np.bitwise_count(blocks).sum(axis=1, dtype=np.uint64)
            pieces += [words, np.concatenate([[0], np.cumsum(ones)]).astype("<u8").tobytes()]
        heads.append((width, len(chunks), pieces))
        if last:
            break
        rest = rest[more]
    at = HEAD_SIZE + LEVEL_SIZE * len(heads) + len(directory)
    out = [struct.pack(HEAD, MAGIC, part, number, len(doc_ids), len(ids), len(heads))]
    for width, count, pieces in heads:
        places = [at, 0, 0]
        for k, piece in enumerate(pieces):
            places[k] = at
            at += len(piece)
        out.append(struct.pack(LEVEL, width, count, *places))
        body += pieces
    data = b"".join([*out, directory, *body])
    return data + struct.pack("<I", zlib.crc32(data))


class TokenFile:
    """Reads single ids, spans and documents out of a file's bytes; only what is asked for is touched."""

    def __init__(self, data: bytes, checked: bool = False):
        magic, self.part, self.number, self.n_docs, self.n_tokens, levels = struct.unpack_from(HEAD, data)
        if magic != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        self.levels, at = [], HEAD_SIZE
        for k in range(levels):
            width, count, chunks, words, ranks = struct.unpack_from(LEVEL, data, at)
            at += LEVEL_SIZE
            blocks = -(-count // BLOCK)
            self.levels.append((width, np.frombuffer(data, KINDS[width], count, chunks),
                                np.frombuffer(data, "u1", -(-count // 8), words) if words else None,
                                np.frombuffer(data, "<u8", blocks + 1, ranks) if ranks else None))
        self.doc_ids = np.frombuffer(data, "<i8", self.n_docs, at)
        at += 8 * self.n_docs
        self.nulls = np.frombuffer(data, "u1", self.n_docs, at).astype(bool)
        at += -(-self.n_docs // 8) * 8
        self.starts = np.frombuffer(data, "<u8", self.n_docs + 1, at).astype(np.int64)
        if checked:
            end = len(data) - len(data) % 8 + 4  # all before the crc is padded to 8 bytes; a line feed may follow it
            if zlib.crc32(memoryview(data)[:end - 4]) != struct.unpack_from("<I", data, end - 4)[0]:
                raise ValueError("a file of directly addressable codes is damaged")

    @staticmethod
    def rank(words: np.ndarray, ranks: np.ndarray, i: int) -> int:
        """Set bits before bit i: the directory's count, then the bytes of one block."""
        block = i // BLOCK
        before = words[block * BLOCK // 8:i // 8]
        ones = int(ranks[block]) + int(np.bitwise_count(before).sum())
        return ones + (int(words[i // 8]) & ((1 << i % 8) - 1)).bit_count() if i % 8 else ones

    def __getitem__(self, i: int) -> int:
        """Id number i of the file."""
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        value = shift = 0
        for width, chunks, words, ranks in self.levels:
            value |= int(chunks[i]) << shift
            shift += width
            if words is None or not words[i // 8] >> i % 8 & 1:
                break
            i = self.rank(words, ranks, i)
        return value

    def span(self, a: int, b: int) -> np.ndarray:
        """The ids from number a up to b: a slice of each level, found by the ranks of its ends."""
        out = np.zeros(b - a, np.uint32)
        at, shift = np.arange(b - a), 0
        for width, chunks, words, ranks in self.levels:
            out[at] |= chunks[a:b].astype(np.uint32) << np.uint32(shift)
            shift += width
            if words is None or a == b:
                break
            more = np.unpackbits(words[a // 8:-(-b // 8)], bitorder="little")[a % 8:a % 8 + b - a].astype(bool)
            at = at[more]
            a = self.rank(words, ranks, a)
            b = a + len(at)
        return out

    def document(self, k: int) -> np.ndarray:
        return self.span(int(self.starts[k]), int(self.starts[k + 1]))


def write(docs: DataFrame, path: str, tokenizer_file: str | None = None, end_id: int = END_ID,
          file_tokens: int = FILE_TOKENS, doc_col: str = "doc_id", text_col: str = "text") -> None:
    """Tokenise ``docs`` and write files at ``path``, in ascending order of doc_id by (part, number in the part)."""
    if tokenizer_file is None:
        import public_tokenizers
        tokenizer_file = public_tokenizers.path(TOKENIZER)
    spark = docs.sparkSession
    small_batches(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc").asc_nulls_last(), F.col("row")]
    rows = (select_columns(docs, [doc_col, text_col]).toDF("doc", "text")
            .select(F.col("doc").cast("long").alias("doc"), "text", F.monotonically_increasing_id().alias("row"))
            .repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # millions of short strings and no cycles among them
        words = tokenizer(tokenizer_file)
        part, number = TaskContext.get().partitionId(), 0
        doc_ids, lengths, pieces, held = [], [], [], 0
        end = np.array([end_id], np.uint32)

        def file() -> pa.RecordBatch:
            data = encode(doc_ids, lengths, np.concatenate(pieces), part, number)
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["content"])

        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                some = batch.slice(at, 2048)
                for doc, ids in zip(some.column(0).to_pylist(), words.encode(some.column(1))):
                    doc_ids.append(doc)
                    lengths.append(len(ids) + 1)
                    pieces += [ids, end]
                    held += len(ids) + 1
                    if held >= file_tokens:
                        yield file()
                        number += 1
                        doc_ids, lengths, pieces, held = [], [], [], 0
        if held:
            yield file()

    (rows.mapInArrow(run, "content binary").select(F.col("content").cast("string").alias("value"))
     .write.option("maxRecordsPerFile", 1).text(path))


def contents(spark: SparkSession, path: str) -> DataFrame:
    """``path, content`` of every file; what a writer leaves for a part without rows is empty and left out."""
    return spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")


def index(spark: SparkSession, path: str) -> DataFrame:
    """Per file its ``path, part, number, n_docs, n_tokens`` and ``base``, the ids of all files before it."""
    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [struct.unpack(HEAD, x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array([x[k] for x in found], pa.int64()) for k in (1, 2, 3, 4)],
                names=["path", "part", "number", "n_docs", "n_tokens"])

    files = (contents(spark, path).select("path", F.substring("content", 1, HEAD_SIZE).alias("head"))
             .mapInArrow(heads, "path string, part long, number long, n_docs long, n_tokens long"))
    return with_bases(files)


def with_bases(files: DataFrame) -> DataFrame:
    """``files`` (part, number, n_tokens) with ``base``: a running total within each part and one over the parts."""
    before = (Window.unboundedPreceding, -1)
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(*before)
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("in_part"))
    over = Window.orderBy("part").rowsBetween(*before)
    parts = parts.select("part", F.coalesce(F.sum("in_part").over(over), F.lit(0)).alias("before_part"))
    return (files.withColumn("in_part", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(parts, "part")
            .withColumn("base", F.col("before_part") + F.col("in_part")).drop("before_part", "in_part"))


DOCUMENTS = "part long, number long, doc_id long, start long, n_tokens long"


def read(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Every document of the files at ``path``: ``doc_id, start`` (ids of all documents before it), ``n_tokens``,
    ``ids_crc32`` and with ``with_ids`` its ``ids`` as little-endian unsigned 32-bit values."""
    small_batches(spark)
    names = ["part", "number", "doc_id", "start", "n_tokens", "ids_crc32", "ids"][:7 if with_ids else 6]
    kinds = [pa.int64()] * 6 + [pa.binary()]
    some = 512 if with_ids else 65536

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                file = TokenFile(batch.column(0)[k].as_py(), checked=True)
                for first in range(0, file.n_docs, some):
                    last = min(first + some, file.n_docs)
                    a, cuts = int(file.starts[first]), file.starts[first:last + 1]
                    span = memoryview(file.span(a, int(cuts[-1])).astype("<u4").tobytes())
                    ids = [span[4 * (x - a):4 * (y - a)] for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
                    n = last - first
                    columns = [np.full(n, file.part), np.full(n, file.number), None, cuts[:-1], np.diff(cuts),
                               [zlib.crc32(x) for x in ids], [bytes(x) for x in ids] if with_ids else None]
                    arrays = [pa.array(c, t) for c, t in zip(columns[:len(names)], kinds) if c is not None]
                    arrays.insert(2, pa.array(file.doc_ids[first:last], pa.int64(), mask=file.nulls[first:last]))
                    yield pa.RecordBatch.from_arrays(arrays, names=names)

    rows = contents(spark, path).select("content").mapInArrow(
        run, DOCUMENTS + ", ids_crc32 long" + ", ids binary" * with_ids)
    bases = index(spark, path).select("part", "number", "base")
    return (rows.join(bases, ["part", "number"])
            .select("doc_id", (F.col("base") + F.col("start")).alias("start"), *names[4:]))


def tokens_at(wanted: DataFrame, path: str, at_col: str = "at") -> DataFrame:
    """The ids at the token numbers ``wanted`` (counted over all files): distinct ``at, id``, none outside the files.

    Numbers meet their file by an equi-join on stretches of ``FILE_TOKENS`` numbers, are gathered per file and stretch
    (so a list has ``FILE_TOKENS`` entries at most), and each is read from the file's bytes by rank."""
    spark = wanted.sparkSession
    small_batches(spark)
    stretch = lambda c: F.floor(c / FILE_TOKENS).cast("long")
    files = index(spark, path).where("n_tokens > 0").withColumn("stretch", F.explode(F.sequence(
        stretch(F.col("base")), stretch(F.col("base") + F.col("n_tokens") - 1))))
    asked = select_columns(wanted, [at_col]).toDF("at").where("at >= 0").distinct()
    lists = (asked.withColumn("stretch", stretch(F.col("at"))).join(files, "stretch")
             .where("at >= base AND at < base + n_tokens")
             .groupBy("path", "stretch", "base").agg(F.collect_list("at").alias("ats")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                file, base = TokenFile(batch.column(0)[k].as_py()), batch.column(1)[k].as_py()
                ats = batch.column(2)[k].as_py()
                yield pa.RecordBatch.from_arrays([pa.array(ats, pa.int64()),
                                                  pa.array([file[a - base] for a in ats], pa.int64())], names=["at", "id"])

    return lists.join(contents(spark, path), "path").select("content", "base", "ats").mapInArrow(run, "at long, id long")
