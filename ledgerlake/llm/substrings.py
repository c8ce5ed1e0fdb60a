"""Operator 7: removal of repeated byte strings with suffix arrays.

Every byte covered by a string of ``length`` bytes that also starts anywhere else (in any document, the same
included) is removed.  Strings are judged on the input.

1. Runs.  A string's key is the smallest hash among its ``gram``-byte pieces, so equal strings have equal keys, at the
   same place in them.  Neighbouring strings of a document that take their key from the same piece form a run:
   a window of some 280 bytes for about 80 strings.  A task makes the runs of its texts and stores
   ``key, content hash, doc_id, place`` of each, without the text.
2. Candidates.  Keys are counted (pre-aggregated); a key seen once cannot hold a repeated string.  Windows with
   the same content are one variant; all strings of a variant seen twice are repeated.  The variants of a key with more than one of them
   may share some of their strings: one window of each is fetched from its document.
3. Shard arrays.  The fetched windows are dealt out by key.  A task concatenates the windows of whole keys, about
   ``SHARD`` bytes at a time, builds that shard's suffix array by induced sorting and reads the repeated strings off
   its permuted common prefixes.
4. The repeated places go back to all windows of the variant, are merged per document and cut out.

Scale: rows are keyed by content, so exact copies collapse in pre-aggregation and a passage shared by a third of
all documents makes one variant.  A key with more than ``HOT`` variants (many texts that run into the same
passage) is not sorted in one shard: its windows are broken into single strings, whose own hashes spread them and
which are pre-aggregated as in step 2.  In joins, the rows of a key that holds over a ``HEAVY``-th of all rows stay
where they are (``meet``).

Defined results: null and empty texts have no bytes and nothing removed; repeated rows with one doc_id are each
judged (they are copies of each other only if the texts say so); an empty table gives no rows; extra columns
are ignored by ``repeats`` and kept by ``cut``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import numbered, small_batches, store
from ledgerlake.llm.suffixarray import permuted_common_prefixes, suffix_array

LENGTH = 200
GRAM = 40
SHARD = 1 << 20
"""Bytes of windows in a shard, before the last key's."""
HOT = 20_000
"""Windows of one key in a shard: with them a shard has 7 MB at most, and its arrays some 250 MB."""
HEAVY = 2_000
"""A key with more than this part of all rows is found by a broadcast of fewer than this many keys."""
BLOCK = 1 << 22
"""Bytes hashed at a time."""
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of BASE and of its inverse, modulo 2 ** 64."""
    size = 1 << max(16, int(n - 1).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        pair = []
        for base in (int(BASE), inverse(int(BASE))):
            out = np.full(size, np.uint64(base), np.uint64)
            out[0] = 1
            pair.append(np.multiply.accumulate(out))
        _POWERS[size] = (pair[0], pair[1])
    up, down = _POWERS[size]
    return up[:n], down[:n]


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of every ``gram`` consecutive bytes: a polynomial modulo 2 ** 64, mixed."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    h = (sums[gram:] - sums[:-gram]) * down[:len(data) - gram + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def sliding_minimum(h: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` consecutive values, from prefix and suffix minima of blocks."""
    n = len(h)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = h
    blocks = padded.reshape(-1, width)
    prefix = np.minimum.accumulate(blocks, axis=1).ravel()
    suffix = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(suffix[:n - width + 1], prefix[width - 1:n])


def runs_of(text: bytes, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of a text: first place, number of strings, key."""
    width = length - gram + 1
    parts = []
    for at in range(0, len(text) - length + 1, BLOCK):
        data = np.frombuffer(text, np.uint8, min(BLOCK + length - 1, len(text) - at), at)
        h = gram_hashes(data, gram)
        key = sliding_minimum(h, width)
        # a run ends where the key changes, or where the piece that gives it leaves the string
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (h[:len(key) - 1] == key[:-1])])
        first = np.flatnonzero(new)
        parts.append((first + at, np.diff(np.concatenate([first, [len(key)]])), key[first]))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*parts))


def text_bytes(column: pa.Array) -> list[bytes]:
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def runs(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """``doc, place, n, key, content`` of every run of ``docs`` (columns doc and text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
                place, n, key = runs_of(text, length, gram)
                if len(place):
                    content = np.fromiter((digest(text[a:b]) for a, b in zip(
                        place.tolist(), (place + n + length - 1).tolist())), np.uint64, len(place))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(place), doc, np.int64)), pa.array(place.astype(np.int32)),
                         pa.array(n.astype(np.int32)), pa.array(key.view(np.int64)), pa.array(content.view(np.int64))],
                        names=["doc", "place", "n", "key", "content"])

    return docs.select("doc", "text").mapInArrow(together(run), "doc long, place int, n int, key long, content long")


def together(run):
    """Few large batches in place of many small ones."""
    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for b in run(batches):
            held.append(b)
            rows += b.num_rows
            if rows >= 100_000:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, rows = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
    return inner


def repeated_in_shard(windows: list[bytes], strings: list[int], length: int) -> list[np.ndarray]:
    """For each window, which of its first ``strings`` strings also start elsewhere in the shard."""
    sizes = np.array([len(w) + 1 for w in windows])
    first = np.cumsum(sizes) - sizes
    raw = np.frombuffer(b"\x00".join(windows) + b"\x00\x00", np.uint8)
    # letters: 0 ends the shard, 1 ends a window, bytes follow
    t = raw.astype(np.int32) + 2
    t[first[1:] - 1] = 1
    t[-2], t[-1] = 1, 0
    sa = suffix_array(t)
    # two strings that agree in all their bytes are neighbours; a string never runs over the end of its window
    count = np.array(strings)
    edge = np.zeros(len(t) + 1, np.int8)
    np.add.at(edge, first, 1)
    np.add.at(edge, first + count, -1)
    own = np.cumsum(edge[:-1]).astype(bool)
    plcp = permuted_common_prefixes(raw, sa, length, own)
    close = np.flatnonzero(plcp[sa[1:]] >= length)
    again = np.zeros(len(t), bool)
    again[sa[close + 1]] = True
    again[sa[close]] = True
    return [again[f:f + s] for f, s in zip(first, strings)]


def intervals(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def shards(windows: DataFrame, length: int) -> DataFrame:
    """``key, content, parts`` (ranges of repeated strings of a window) from ``key, content, n, bytes``."""
    kind = "key long, content long, parts array<struct<a:int,b:int>>"
    out = pa.schema([("key", pa.int64()), ("content", pa.int64()),
                     ("parts", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))])

    def solve(held: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
        flags = repeated_in_shard([x[3] for x in held], [x[2] for x in held], length)
        rows = [{"key": k, "content": c, "parts": [{"a": a, "b": b} for a, b in intervals(f)]}
                for (k, c, _, _), f in zip(held, flags) if f.any()]
        return pa.RecordBatch.from_pylist(rows, out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if size >= SHARD and row[0] != held[-1][0]:
                    yield solve(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield solve(held)

    dealt = windows.select("key", "content", "n", "bytes").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, kind)


def meet(rows: DataFrame, keyed: DataFrame, on: list[str], weight: str, total: int, more: DataFrame | None = None) -> DataFrame:
    """``rows`` joined with ``keyed``, which holds each ``on`` once and in ``weight`` its number of rows, of ``total`` in all.
    ``more`` has further keys, each of a single row.

    A key with more than one ``HEAVY``-th of all rows is not dealt to a task: there are fewer than ``HEAVY`` such keys in
    any data, so a broadcast finds their rows where they lie.  Of the others, none has more than that part.
    """
    most = total // HEAVY
    heavy, light = keyed.where(F.col(weight) > most), keyed.where(F.col(weight) <= most)
    if more is not None:
        light = light.unionByName(more)
    rest = rows.join(F.broadcast(heavy.select(*on)), on, "left_anti")
    return rows.join(F.broadcast(heavy), on).unionByName(rest.join(light, on))


def fetch(rows: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """``rows`` (key, content, doc, place, n, hot) with their windows' ``bytes``, cut out of the documents' texts."""
    wanted = rows.groupBy("doc").agg(F.collect_list(F.struct("key", "content", "place", "n", "hot")).alias("w"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, ws in zip(text_bytes(batch.column(0)), batch.column(1).to_pylist()):
                got = [(w["key"], w["content"], w["n"], w["hot"], text[w["place"]:w["place"] + w["n"] + length - 1]) for w in ws]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(
                    zip(*got), (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary()))],
                    names=["key", "content", "n", "hot", "bytes"])

    return docs.join(wanted, "doc").select("text", "w").mapInArrow(
        together(run), "key long, content long, n int, hot boolean, bytes binary")


def single_strings(windows: DataFrame, length: int) -> DataFrame:
    """The same result as ``shards``, for windows of hot keys: every string is counted by its own hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = xxhash.xxh3_64_intdigest, xxhash.xxh64_intdigest
        for batch in batches:
            for key, content, n, data in zip(*(c.to_pylist() for c in batch.columns)):
                strings = [data[i:i + length] for i in range(n)]
                a, b = (np.fromiter(map(f, strings), np.uint64, n).view(np.int64) for f in (one, two))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, key)), pa.array(np.full(n, content)), pa.array(np.arange(n, dtype=np.int32)),
                     pa.array(a), pa.array(b)], names=["key", "content", "i", "h1", "h2"])

    strings = windows.select("key", "content", "n", "bytes").mapInArrow(
        together(run), "key long, content long, i int, h1 long, h2 long")
    twice = strings.groupBy("h1", "h2").agg(F.count("*").alias("c")).where("c > 1")
    total = windows.agg(F.sum("n")).first()[0] or 0
    found = meet(strings, twice, ["h1", "h2"], "c", total).groupBy("key", "content").agg(F.collect_list("i").alias("at"))
    return found.select("key", "content", F.transform("at", lambda i: F.struct(i.alias("a"), (i + 1).alias("b"))).alias("parts"))


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT, doc_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """``doc, spans``: for documents with repeated strings, the ranges of bytes to remove (unmerged, unordered).

    ``docs`` must have one row per doc_col.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(f"`{doc_col}`").cast("long").alias("doc"), F.col(f"`{text_col}`").alias("text"))
    made = store(runs(texts, length, gram), "runs")
    keys = made.groupBy("key").agg(F.count("*").alias("k")).where("k > 1")
    found = store(meet(made, keys, ["key"], "k", made.count()).drop("k"), "candidate-runs")
    variants = found.groupBy("key", "content").agg(
        F.count("*").alias("c"), F.min(F.struct("doc", "place", "n")).alias("first"))
    variants = store(variants, "variants")
    mixed = variants.groupBy("key").agg(F.count("*").alias("v")).where("v > 1")
    wanted = meet(variants, mixed, ["key"], "v", variants.count()).select("key", "content", "first.doc", "first.place", "first.n",
                                                (F.col("v") > hot).alias("hot"))
    windows = store(fetch(wanted, texts, length), "windows")
    parts = store(shards(windows.where("not hot"), length).unionByName(single_strings(windows.where("hot"), length)), "parts")
    copied = variants.where("c > 1")
    whole = copied.select("key", "content", "c", F.array(F.struct(
        F.lit(0).alias("a"), F.col("first.n").alias("b"))).alias("parts"))
    single = parts.join(copied.select("key", "content"), ["key", "content"], "left_anti").withColumn("c", F.lit(1).cast("long"))
    spans = meet(found, whole, ["key", "content"], "c", found.count(), single).select("doc", F.explode("parts").alias("p"), "place").select(
        "doc", F.struct((F.col("place") + F.col("p.a")).cast("long").alias("a"),
                        (F.col("place") + F.col("p.b") + F.lit(length - 1)).cast("long").alias("b")).alias("s"))
    return spans.groupBy("doc").agg(F.collect_list("s").alias("spans"))


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Sorted ranges without overlaps; ranges that touch are one."""
    if not spans:
        return []
    ab = np.array([(s["a"], s["b"]) for s in spans], np.int64)
    ab = ab[np.argsort(ab[:, 0], kind="stable")]
    reach = np.maximum.accumulate(ab[:, 1])
    new = np.concatenate([[True], ab[1:, 0] > reach[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(ab) - 1]])
    return list(zip(ab[new, 0].tolist(), reach[last].tolist()))


def remove(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text", as_text: bool = False, **options) -> DataFrame:
    """``docs`` with three more columns: __kept (binary, or with ``as_text`` a string without the rests of characters
    that were cut in two), __removed (array of ranges) and __n_bytes."""
    rows, key = numbered(docs, doc_col)
    spans = store(repeats(rows, doc_col=key, text_col=text_col, **options), "spans")
    spans = spans.select(F.col("doc").alias("__doc"), F.col("spans").alias("__spans"))
    joined = rows.join(spans, rows[key].cast("long") == spans["__doc"], "left").drop("__doc")
    names = [c for c in rows.columns if c != "__row"]
    at = joined.columns.index(text_col), joined.columns.index("__spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, gone, sizes = [], [], []
            for text, spans_ in zip(text_bytes(batch.column(at[0])), batch.column(at[1]).to_pylist()):
                ranges = merged(spans_)
                cuts = [0, *[x for r in ranges for x in r], len(text)]
                left = b"".join(text[a:b] for a, b in zip(cuts[::2], cuts[1::2]))
                kept.append(left.decode("utf-8", "ignore") if as_text else left)
                gone.append([{"a": a, "b": b} for a, b in ranges])
                sizes.append(len(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(n)) for n in names]
                + [pa.array(kept, pa.string() if as_text else pa.binary()), pa.array(gone, kind), pa.array(sizes, pa.int64())],
                names=[*names, "__kept", "__removed", "__n_bytes"])

    kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return joined.mapInArrow(run, f"{schema}, __kept {'string' if as_text else 'binary'}, __removed array<struct<a:bigint,b:bigint>>, __n_bytes bigint")


def digest(docs: DataFrame, **options) -> DataFrame:
    """The contract's columns."""
    rows = docs.select("doc_id", "text")
    return remove(rows, **options).select(
        "doc_id", F.col("__n_bytes").alias("n_bytes"), F.coalesce(F.aggregate("__removed", F.lit(0).cast("long"), lambda s, r: s + r["b"] - r["a"]),
                                        F.lit(0).cast("long")).alias("n_removed"),
        F.size("__removed").cast("long").alias("n_spans"), F.sha2("__kept", 256).alias("kept_sha256"))


def cut(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the repeated strings cut out of the texts; what is left of a character cut in two goes too."""
    out = remove(docs, text_col=text_col, as_text=True, **options)
    text = F.when(F.size("__removed") > 0, F.col("__kept")).otherwise(F.col(f"`{text_col}`"))
    out = out.withColumn(text_col, text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length(F.col(f"`{text_col}`")).cast("long"))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
