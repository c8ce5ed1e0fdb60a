"""Operator 9: benchmark decontamination by latent semantic retrieval.

1. Encode.  Every document becomes its sequence of benchmark-vocabulary word numbers (0: any other word), stored once.
2. TF-IDF passages.  Document frequencies are counted over all passages of ``PASSAGE`` words; a word's weight is its idf over
   the root of its frequency, so that frequent words do not fill the leading singular directions.
3. Randomised SVD.  Each task multiplies its passages A with a random matrix and back, the parts of A'(A R) are
   summed by Spark in two salted steps, and their orthonormal basis (vocabulary x ``RANK``) spans the latent space.
4. Search.  Every document's windows of two widths are projected, and pairs with an item at a cosine of ``COSINE`` or more are
   candidates; no pair is dropped for rank.  ``tests/llm/test_latent.py`` measures their recall on copies of a common subsequence
   of 0.6 to 1 (0.9 at least).  Items that the latent space cannot tell, being shorter than ``NARROW`` words or with more than ``DIM``
   of their words without weight, are searched by their rarest words instead: places with, of the rarest words (``RARE`` of the
   positions), all but as many as the checks let a copy lack, within half as many words again as the item has; no copy that the
   checks accept has fewer.
5. Checks.  A candidate's region must hold the item's words in order: its longest common subsequence covers ``SURE`` of the item, or
   ``LIKELY`` of it and ``ANSWER`` of the item's last sentence (its answer) as well, as in a paraphrase.

Scale: the benchmark is the stated query set.  It is taken in blocks of at most ``VOCABULARY`` distinct words
and ``ITEMS`` queries, which bounds everything that is broadcast (basis 15 MB, items); each block is searched against all
documents.  Documents are only scanned, never shuffled; what is shuffled are sums of a fixed size per task.  Very
long texts are processed in pieces of ``AT_ONCE`` words.

Defined results: null and empty texts match nothing, and items without words match nothing; items of under ``SHORT`` words must occur
word for word; an item of more than ``PIECE`` words is cut into pieces, and a document that repeats one of them repeats the item; repeated rows are judged one by one (with several
blocks, ``matches`` gives rows of one doc_id one row); an empty table of documents or of items gives no match; extra columns
are ignored by ``matches`` and kept by ``decontaminate``.
"""

from __future__ import annotations

import re
import string
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import numbered, small_batches, store

PASSAGE = 64
CHUNK = 8
WIDTHS = ((3, 1), (8, 2))  # windows in chunks, and their steps
RANK, MORE = 64, 8
SMOOTH = 4e-4
LIGHT = 0.02
"""Words of less than this share of the largest weight are stop words for the latent space (not for the checks)."""
COSINE = 0.7
NARROW, DIM = 16, 0.4
SURE, LIKELY, ANSWER = 0.8, 0.6, 0.8
SHORT = 8
RARE = 0.55
SLICE = 1 << 13
"""Words of a text that are held against the items' rare words at a time."""
PIECE = 60
VOCABULARY = 60_000
ITEMS = 4096
AT_ONCE = 1 << 18
ROWS = 64
"""Vocabulary rows of a partial sum that travel together."""
EDGES = string.punctuation + "«»“”„…¿¡"


def tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of all texts (null: none), every word in turn as a number among them, and where each text's
    words begin: lower-cased, cut at ASCII blanks, without signs at their ends; what is signs only is no word.  Items and
    documents go through this one function."""
    split = pc.ascii_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))
    flat = split.flatten().dictionary_encode()
    kinds, number = pc.utf8_trim(flat.dictionary, EDGES), flat.indices.to_numpy()
    word = pc.not_equal(kinds, "").to_numpy(zero_copy_only=False)[number] if len(number) else np.zeros(0, bool)
    kept = np.concatenate([[0], np.cumsum(word)])
    return kinds, number[word], kept[split.offsets.to_numpy() - split.offsets[0].as_py()]


def words_of(text: str) -> list[str]:
    kinds, number, _ = tokens(pa.array([text], pa.string()))
    return kinds.take(pa.array(number)).to_pylist()


class Item:
    """A query: at most ``PIECE`` words of a benchmark item as word numbers, and its answer."""

    def __init__(self, item_id: int, codes: Sequence[int], answer: Sequence[int]):
        self.item_id, self.codes, self.answer = item_id, list(codes), list(answer)
        self.distinct = frozenset(codes)
        self.least = len(self.distinct) - lacking(len(self.codes))
        self.masks, self.answer_masks = masks(self.codes), masks(self.answer)


def masks(codes: Sequence[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, c in enumerate(codes):
        out[c] = out.get(c, 0) | 1 << i
    return out


def common_subsequence(pattern: dict[int, int], n: int, text: Sequence[int]) -> int:
    """Length of the longest common subsequence with a pattern of ``n`` words, one word of the text at a time."""
    full = v = (1 << n) - 1
    for c in text:
        u = v & pattern.get(c, 0)
        if u:
            v = (v + u) | (v - u)
    return n - (v & full).bit_count()


def blocks_of(benchmark: DataFrame, id_col: str, text_col: str, vocabulary: int) -> Iterator[tuple[dict[str, int], list[Item]]]:
    """The items in blocks of at most ``vocabulary`` distinct words and ``ITEMS`` queries, or one item that has more."""
    words: dict[str, int] = {}
    items: list[Item] = []
    for item_id, text in benchmark.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`")).toLocalIterator():
        own = words_of(text or "")
        if items and (len(set(own).union(words)) > vocabulary or len(items) + -(-len(own) // PIECE) > ITEMS):
            yield words, items
            words, items = {}, []
        last = [s for s in (words_of(x) for x in re.split(r"[.!?]+(?:\s+|$)", text or "")) if s][-1:]
        answer = last[0] if last and len(last[0]) >= 3 else own[-5:]
        codes = [words.setdefault(w, len(words) + 1) for w in own]
        n = -(-len(codes) // PIECE)
        for k in range(n):
            part = codes[k * len(codes) // n:(k + 1) * len(codes) // n]
            items.append(Item(item_id, part, [words[w] for w in answer] if k == n - 1 else part))
    if items:
        yield words, items


def encode(docs: DataFrame, words: dict[str, int]) -> DataFrame:
    """``doc, codes``: the word numbers of every row of ``docs`` (doc, text) as little-endian 16-bit values."""
    known = docs.sparkSession.sparkContext.broadcast(list(words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pa.array(known.value, pa.string())
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                b = batch.slice(at, 2048)
                kinds, number, cuts = tokens(b.column(1))
                known_as = pc.fill_null(pc.add(pc.index_in(kinds, vocabulary), 1), 0).to_numpy().astype("<u2")
                codes, cuts = known_as[number], cuts.tolist()
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(
                    [codes[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:])], pa.binary())], names=["doc", "codes"])

    return docs.select("doc", "text").mapInArrow(run, "doc long, codes binary")


def pieces(batches: Iterator[pa.RecordBatch], width: int, used: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """The ``used`` words of several documents at a time with the numbers of their passages of ``width`` words,
    and how many passages there are."""
    codes, at, n, size = [], [], 0, 0
    for b in batches:
        for data in b.column(0):
            own = np.frombuffer(data.as_buffer(), "<u2")
            for k in range(0, len(own), AT_ONCE):
                part = own[k:k + AT_ONCE]
                where = np.flatnonzero(used[part])
                codes.append(part[where])
                at.append(n + where // width)
                n += -(-len(part) // width)
                size += len(part)
                if size >= AT_ONCE:
                    yield np.concatenate(codes), np.concatenate(at), n
                    codes, at, n, size = [], [], 0, 0
    if codes:
        yield np.concatenate(codes), np.concatenate(at), n


def summed(rows: DataFrame, columns: int) -> np.ndarray:
    """The sum of partial matrices ``row, salt, part`` (ROWS rows of float64 each), in two steps."""
    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(p, np.float64) for p in frame["part"])
        return pd.DataFrame({"row": [frame["row"].iloc[0]], "part": [total.tobytes()]})

    some = rows.groupBy("row", "salt").applyInPandas(add, "row int, part binary")
    whole = some.groupBy("row").applyInPandas(add, "row int, part binary").collect()
    return np.concatenate([np.frombuffer(r["part"], np.float64).reshape(-1, columns) for r in sorted(whole, key=lambda r: r["row"])])


def partial_sums(total: np.ndarray) -> pa.RecordBatch:
    n = -(-len(total) // ROWS)
    padded = np.zeros((n * ROWS, total.shape[1]))
    padded[:len(total)] = total
    salt = np.full(n, TaskContext.get().partitionId() % 64, np.int32)
    return pa.RecordBatch.from_arrays([pa.array(np.arange(n, dtype=np.int32)), pa.array(salt), pa.array(
        [padded[k * ROWS:(k + 1) * ROWS].tobytes() for k in range(n)], pa.binary())], names=["row", "salt", "part"])


PARTS = "row int, salt int, part binary"


def weights(codes: DataFrame, size: int) -> np.ndarray:
    """Each word number's weight, from its document frequency over all passages."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((size, 1))
        known = np.arange(size) > 0
        for code, at, n in pieces(batches, PASSAGE, known):
            seen = np.unique(at * size + code)
            counts[:, 0] += np.bincount(seen % size, minlength=size)
            counts[0, 0] += n
        yield partial_sums(counts)

    df = summed(codes.select("codes").mapInArrow(run, PARTS), 1)[:size, 0]
    passages = max(1.0, df[0])
    w = np.log((passages + 1) / (df + 1)) / np.sqrt(df / passages + SMOOTH)
    w[0] = 0
    w /= max(w.max(), 1e-9)
    return np.where(w < LIGHT, 0, w)


def add_rows(rows: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """The sums of ``rows`` with equal (ascending) numbers ``at``, for numbers 0 to n - 1."""
    out = np.zeros((n, rows.shape[1]), rows.dtype)
    if len(at):
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        out[at[first]] = np.add.reduceat(rows, first, axis=0)
    return out


def basis(codes: DataFrame, weight: np.ndarray, rank: int, seed: int = 7) -> np.ndarray:
    """An orthonormal basis of the leading right singular directions of the weighted passages."""
    size = len(weight)
    random = (np.random.default_rng(seed).standard_normal((size, rank + MORE)) * weight[:, None]).astype(np.float32)
    sent = codes.sparkSession.sparkContext.broadcast(random)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = sent.value
        total = np.zeros((size, r.shape[1]))
        used = r.any(axis=1)
        for code, at, n in pieces(batches, PASSAGE, used):
            passage = add_rows(r[code], at, n)
            order = np.argsort(code, kind="stable")
            total += add_rows(passage[at[order]], code[order], size)
        yield partial_sums(total)

    y = summed(codes.select("codes").mapInArrow(run, PARTS), rank + MORE)[:size] * weight[:, None]
    q, r = np.linalg.qr(y)
    u, _, _ = np.linalg.svd(r)
    return (q @ u)[:, :rank]


def lacking(n: int) -> int:
    """How many of an item's ``n`` words a copy may lack."""
    return 0 if n < SHORT else n - next(k for k in range(n + 1) if k / n >= LIKELY)


def reach(n: int) -> int:
    return n + n // 2 + CHUNK


def dim(item: Item, weight: np.ndarray) -> bool:
    """Whether the latent space cannot tell the item."""
    return len(item.codes) < NARROW or float(np.mean(weight[item.codes] == 0)) > DIM


class Rare:
    """The rarest words of the items that are searched by them: for each word number the items that it is looked up for."""

    def __init__(self, items: list[Item], weight: np.ndarray):
        pairs, need = [], []
        for k, item in enumerate(items):
            if not dim(item, weight):
                need.append(np.iinfo(np.int64).max // 2)
                continue
            n, less = len(item.codes), lacking(len(item.codes))
            words = Counter(item.codes)
            total = 0
            for c in sorted(words, key=lambda c: (-weight[c], c)):  # whole words: their positions cannot be told apart in a text
                if total >= RARE * n and total > less:
                    break
                total += words[c]
                pairs.append((c, k))
            need.append(total - less)
        pairs.sort()
        word = np.array([c for c, _ in pairs], np.int64)
        self.item = np.array([k for _, k in pairs], np.int64)
        self.first = np.searchsorted(word, np.arange(len(weight) + 1))
        self.need = np.array(need, np.int64)
        self.length = np.array([len(i.codes) for i in items], np.int64)
        self.reach = np.array([reach(len(i.codes)) if dim(i, weight) else 0 for i in items], np.int64)

    def places(self, own: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """``item, start, end`` of the regions with enough of an item's rare words."""
        if not len(self.item):
            return
        over = int(self.reach.max()) + 1
        for at in range(0, len(own), SLICE):  # slices overlap by the longest reach
            part = own[at:at + SLICE + over]
            many = self.first[part + np.int64(1)] - self.first[part]
            where = np.flatnonzero(many)
            each = many[where]
            if not len(where):
                continue
            ends = np.cumsum(each)
            item = self.item[np.repeat(self.first[part[where]] - (ends - each), each) + np.arange(ends[-1])]
            enough = (np.bincount(item, minlength=len(self.need)) >= self.need)[item]
            item, where = item[enough], np.repeat(where, each)[enough]
            order = np.argsort(item, kind="stable")
            item, where = item[order], where[order]
            last = np.arange(len(item)) + self.need[item] - 1
            within = last < len(item)
            j, last = np.flatnonzero(within), last[within]
            good = j[(item[last] == item[j]) & (where[last] - where[j] <= self.reach[item[j]])]
            old = start = end = -1
            for k, w in zip(item[good].tolist(), where[good].tolist()):
                n = int(self.length[k])
                if k == old and w - start <= n // 2:  # near starts share a region
                    end = w
                    continue
                if old >= 0:
                    yield old, max(0, at + start - int(self.length[old])), at + end + int(self.reach[old]) + 1
                old, start, end = k, w, w
            if old >= 0:
                yield old, max(0, at + start - int(self.length[old])), at + end + int(self.reach[old]) + 1


def check(item: Item, region: Sequence[int]) -> tuple[float, bool] | None:
    """The covered share of the item and whether the answer is there, if the region repeats the item."""
    n = len(item.codes)
    if n < SHORT:
        whole = any(list(region[k:k + n]) == item.codes for k in range(len(region) - n + 1))
        return (1.0, True) if whole else None
    if len(item.distinct.intersection(region)) < item.least:
        return None
    share = common_subsequence(item.masks, n, region) / n
    if share < LIKELY:
        return None
    answered = common_subsequence(item.answer_masks, len(item.answer), region) >= ANSWER * len(item.answer)
    return (share, answered) if answered or share >= SURE else None


def search(codes: DataFrame, items: list[Item], weight: np.ndarray, space: np.ndarray, cosine: float) -> DataFrame:
    """``doc, found``: for every row its items (id, cosine, share, answered), each once."""
    vectors = (space * weight[:, None]).astype(np.float32)
    queries = np.stack([vectors[i.codes].sum(axis=0) for i in items])
    queries /= np.maximum(np.linalg.norm(queries, axis=1, keepdims=True), 1e-9)
    sent = codes.sparkSession.sparkContext.broadcast((vectors, queries, [(i.item_id, i.codes, i.answer) for i in items], Rare(items, weight)))
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("cosine", pa.float64()), ("share", pa.float64()), ("answered", pa.bool_())]))

    def found(own: np.ndarray, vectors: np.ndarray, used: np.ndarray, queries: np.ndarray, known: list[Item], rare: Rare, best: dict) -> None:
        for i, a, z in rare.places(own):
            old = best.get(known[i].item_id)
            if old and old[1] == 1.0 and old[2]:
                continue
            good = check(known[i], own[a:z].tolist())
            if good and (old is None or good > old[1:]):
                near = vectors[own[a:z]].sum(axis=0)
                best[known[i].item_id] = (float(near @ queries[i] / max(np.linalg.norm(near), 1e-9)), *good)
        where = np.flatnonzero(used[own])
        if not len(where):
            return
        n = -(-len(own) // CHUNK)
        sums = np.zeros((n + 1, vectors.shape[1]), np.float32)
        np.cumsum(add_rows(vectors[own[where]], where // CHUNK, n), axis=0, out=sums[1:])
        listed = None
        for width, step in WIDTHS:
            start = np.arange(0, max(1, n - width + step), step)
            z = sums[np.minimum(start + width, n)] - sums[start]
            length = np.linalg.norm(z, axis=1, keepdims=True)
            score = (z / np.maximum(length, 1e-9)) @ queries.T
            score[length[:, 0] < 1e-6] = 0
            for w, i in zip(*np.nonzero(score >= cosine)):
                if listed is None:
                    listed = own.tolist()
                item = known[i]
                old = best.get(item.item_id)
                if old and old[1] == 1.0:
                    continue
                a = int(start[w]) * CHUNK
                region = listed[max(0, a - 2 * CHUNK):a + (width + 2) * CHUNK]
                good = check(item, region)
                if good and (old is None or good > old[1:]):
                    best[item.item_id] = (float(score[w, i]), *good)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, queries, plain, rare = sent.value
        used = vectors.any(axis=1)
        known = [Item(*p) for p in plain]
        for b in batches:
            out = []
            for data in b.column(1):
                own, best = np.frombuffer(data.as_buffer(), "<u2"), {}
                for k in range(0, max(1, len(own)), AT_ONCE):  # pieces overlap by the widest window or region and its margins
                    found(own[max(0, k - 32 * CHUNK):k + AT_ONCE], vectors, used, queries, known, rare, best)
                out.append([{"item_id": i, "cosine": v[0], "share": v[1], "answered": v[2]} for i, v in sorted(best.items())])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, kind)], names=["doc", "found"])

    return codes.select("doc", "codes").mapInArrow(
        run, "doc long, found array<struct<item_id:bigint,cosine:double,share:double,answered:boolean>>")


def matches(docs: DataFrame, benchmark: DataFrame, rank: int = RANK, cosine: float = COSINE, doc_col: str = "doc_id",
            text_col: str = "text", item_col: str = "item_id", vocabulary: int = VOCABULARY) -> DataFrame:
    """``doc_id, found`` for every row of ``docs``: the benchmark items that it repeats."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(f"`{doc_col}`").cast("long").alias("doc"), F.col(f"`{text_col}`").alias("text"))
    parts = []
    for words, items in blocks_of(benchmark, item_col, "text", vocabulary):
        codes = store(encode(texts, words), "codes")
        weight = weights(codes, len(words) + 1)
        space = basis(codes, weight, min(rank, len(words)))
        parts.append(search(codes, items, weight, space, cosine))
    if not parts:
        none = F.lit(None).cast("array<struct<item_id:bigint,cosine:double,share:double,answered:boolean>>")
        return texts.select(F.col("doc").alias("doc_id"), F.coalesce(none, F.array()).alias("found"))
    out = parts[0]
    if len(parts) > 1:  # rows of several blocks meet by document
        for p in parts[1:]:
            out = out.unionByName(p)
        out = out.groupBy("doc").agg(F.flatten(F.collect_list("found")).alias("found"))
    return out.select(F.col("doc").alias("doc_id"), "found")


def report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row for every row of ``docs``: whether it repeats a benchmark item, which, and how well."""
    found = matches(docs, benchmark, **options)
    return found.select("doc_id", (F.size("found") > 0).alias("contaminated"), F.transform("found", lambda x: x["item_id"]).alias("item_ids"),
                        F.array_max(F.transform("found", lambda x: x["share"])).alias("best_share"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the rows that repeat a benchmark item."""
    rows, key = numbered(docs, doc_col)
    bad = matches(rows, benchmark, doc_col=key, **options).where(F.size("found") > 0).select(F.col("doc_id").alias("__bad"))
    kept = rows.join(store(bad, "contaminated"), rows[key].cast("long") == F.col("__bad"), "left_anti")
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
