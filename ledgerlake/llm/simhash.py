"""Operator 6: SimHash near-duplicates by a binary trie self-join.

A text is lower-cased (A-Z only) and split into words; every shingle of ``shingle`` words (repeats included) is
hashed with XXH64 (seed 42), and a fingerprint bit is 1 where more than half of the hashes have it.  Two
fingerprints are linked when at most ``budget`` bits differ, and documents linked directly or through others
form one component.

Trie join: the 64 bits fall into ``budget + 1`` segments, and two linked fingerprints agree in at least one of
them.  For each segment the distinct fingerprints are rotated so that it leads, dealt out by its value, and each
task walks the binary trie over its sorted fingerprints: pairs of nodes descend together, a pair
of unlike children adds one differing bit, and a pair that has used up the budget is pruned.  Links leave a
task as a star per connected set, never as all pairs, and the stars meet in ``components``.

Scale: equal fingerprints are merged before the join, so copies cost nothing.  Distinct fingerprints that share
a segment are few even in one huge group of near copies: within d bits of one value there are sum(C(64, i), i <= d)
of them at most, and ones further apart spread over other segment values.  The number of partitions follows the
number of distinct fingerprints.

Defined results: null or wordless texts have fingerprint zero and are linked like any other; fewer words
than a shingle are one shingle; every row is returned, repeated rows and doc_ids included; null doc_ids never
become a component's id unless it has no other; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import components, numbered, select_columns, small_batches, store

SHINGLE = 3
BUDGET = 2
SEED = 42
PER_TASK = 500_000
"""Rotated fingerprints for one task of the trie join."""


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of one text."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    spans = zip((ends - lengths)[:n].tolist(), ends[len(words) - n:].tolist())
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in spans), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        part = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp`` (the fingerprint as a signed long) for every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    small_batches(docs.sparkSession)
    rows = select_columns(docs, [doc_col, text_col])
    return rows.withColumn(doc_col, F.col(doc_col).cast("long")).mapInArrow(run, "doc_id long, fp long")


def near_pairs(f: np.ndarray, exact: int, budget: int, leaf: int = 64, at_once: int = 200_000
               ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of sorted distinct ``f`` that agree in the first ``exact`` bits and differ in at most ``budget``.

    Nodes of the trie are index ranges of ``f``.  Pairs of small nodes are compared directly.
    """
    if len(f) < 2:
        return
    cuts = np.flatnonzero(np.diff(f >> np.uint64(64 - exact))) + 1 if exact else np.zeros(0, np.int64)
    lows, highs = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(f)]])
    many = highs - lows > 1
    lows, highs = lows[many], highs[many]
    todo = [(exact, lows[k:k + at_once], highs[k:k + at_once], lows[k:k + at_once], highs[k:k + at_once],
             np.zeros(len(lows[k:k + at_once]), np.int8)) for k in range(0, len(lows), at_once)]
    while todo:
        depth, al, ah, bl, bh, d = todo.pop()
        if len(al) > at_once:
            todo += [(depth, al[k:k + at_once], ah[k:k + at_once], bl[k:k + at_once], bh[k:k + at_once],
                      d[k:k + at_once]) for k in range(0, len(al), at_once)]
            continue
        small = ((ah - al) * (bh - bl) <= leaf) | (depth == 64)
        if small.any():
            la, lb = al[small], bl[small]
            nb = bh[small] - lb
            each = (ah[small] - la) * nb
            which = np.repeat(np.arange(len(each)), each)
            k = np.arange(len(which)) - np.repeat(np.cumsum(each) - each, each)
            i, j = la[which] + k // nb[which], lb[which] + k % nb[which]
            near = (i < j) & (np.bitwise_count(f[i] ^ f[j]) <= budget)
            yield i[near], j[near]
            al, ah, bl, bh, d = (x[~small] for x in (al, ah, bl, bh, d))
        if not len(al):
            continue
        bit, above = np.uint64(1 << (63 - depth)), np.uint64(((1 << 64) - 1) ^ ((1 << (64 - depth)) - 1))
        am = np.clip(np.searchsorted(f, (f[al] & above) | bit), al, ah)
        bm = np.clip(np.searchsorted(f, (f[bl] & above) | bit), bl, bh)
        own = al == bl
        parts = [(al, am, bl, bm, d), (am, ah, bm, bh, d), (al, am, bm, bh, d + 1),
                 tuple(x[~own] for x in (am, ah, bl, bm, d + 1))]
        al, ah, bl, bh, d = (np.concatenate(x) for x in zip(*parts))
        alive = (ah > al) & (bh > bl) & (d <= budget) & ~((al == bl) & (ah - al == 1))
        todo.append((depth + 1, *(x[alive] for x in (al, ah, bl, bh, d))))


def stars(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each of ``n`` items the smallest item that it is connected to through ``pairs``."""
    root = np.arange(n)
    for i, j in pairs:
        while True:
            a, b = root[i], root[j]
            open_ = a != b
            if not open_.any():
                break
            i, j, a, b = i[open_], j[open_], a[open_], b[open_]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(root, up := root[root]):
                root = up
    return root


def rotate(f: np.ndarray, by: int) -> np.ndarray:
    return (f << np.uint64(by)) | (f >> np.uint64(64 - by)) if by else f


def trie_links(distinct: DataFrame, budget: int = BUDGET, partitions: int | None = None) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints ``fp``: enough of them to connect all that differ by
    ``budget`` bits or fewer."""
    starts = [64 * k // (budget + 1) for k in range(budget + 2)]
    segments = F.array(*[F.struct(F.lit(k).alias("segment"), F.lit(s).alias("rotated"), F.expr(
        f"shiftrightunsigned(shiftleft(fp, {s}), {64 - (starts[k + 1] - s)})").alias("value"))
        for k, s in enumerate(starts[:-1])])
    dealt = distinct.select("fp", F.explode(segments).alias("s")).select("fp", "s.segment", "s.value")
    dealt = dealt.repartition(*([partitions] if partitions else []), "segment", "value")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
        if not held:
            return
        fps, segment = (np.concatenate(x) for x in zip(*held))
        for k, by in enumerate(starts[:-1]):
            f = np.sort(rotate(fps[segment == k].view(np.uint64), by))
            root = stars(len(f), near_pairs(f, starts[k + 1] - by, budget))
            tied = np.flatnonzero(root != np.arange(len(f)))
            back = [pa.array(rotate(f[x], (64 - by) % 64).view(np.int64)) for x in (tied, root[tied])]
            yield pa.RecordBatch.from_arrays(back, names=["a", "b"])

    return dealt.select("fp", "segment").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, budget: int = BUDGET, doc_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id, fp, component_id`` for every row of ``docs``; fp is the fingerprint as a signed long."""
    fps = store(fingerprints(docs, doc_col, text_col, shingle), "fingerprints")
    distinct = store(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    partitions = -(-distinct.count() * (budget + 1) // PER_TASK)
    width = max(partitions, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = components(trie_links(distinct, budget, width))
    rooted = distinct.join(found, distinct["fp"] == found["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    first = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    label = rooted.join(first, "root").select("fp", "component_id")
    return fps.join(label, "fp").select("doc_id", "fp", "component_id")


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns: the fingerprint as 16 hexadecimal digits."""
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, doc_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest doc_id.

    Rows, not ids, are judged where ids repeat or are null: each such row is numbered, unlike texts under one id are documents
    of their own, a null id counts after all others, and among rows of the smallest id the first stays."""
    rows, key = numbered(docs, doc_col)
    found = near_duplicates(rows, doc_col=key, **options)
    if key == doc_col:
        first = found.where("doc_id = component_id").select(F.col("doc_id").alias("__first"))
    else:
        ids = rows.select(F.col(key).alias("doc_id"), F.col(f"`{doc_col}`").cast("long").alias("id"))
        order = F.struct(F.isnull("id").alias("none"), "id", "doc_id")
        first = found.join(ids, "doc_id").groupBy("component_id").agg(F.min(order).alias("least")).select(F.col("least.doc_id").alias("__first"))
    kept = rows.join(store(first, "firsts"), rows[key].cast("long") == F.col("__first"), "left_semi")
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
