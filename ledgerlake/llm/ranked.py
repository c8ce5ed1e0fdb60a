"""Operator 11: ranked lexical search without random access (NRA).

Terms are the maximal runs of characters that are no ASCII sign, blank or control character, only A-Z lower-cased.
A document's score for an item sums the impacts of the item's terms (:func:`impacts`); each item gets its ``k``
documents of the highest score above 0, equal scores by ascending doc_id.

Within a shard of documents, every term has a list of (document, impact) sorted by falling impact.  An item reads its
lists in step, ever deeper.  What was read of a document is the lower end of its score; the upper end adds, for
each list in which it was not met, the impact at which that list stands.  Reading goes on until no document
outside can reach the k-th lower end, and every document that still can has an interval of one value (:func:`nra`).
So membership, ties and scores are exact.  A task carries the k best of its shards as a floor into the next shard.

Scale: one pass over the texts keeps per document its length and the counts of terms that some item holds (stored;
its lists are short); N, L and df are sums over that table.  Shards are ``SHARD`` documents of a task's own
rows, so a hot source, term or group of copies stays spread.  Each task sends at most k rows an item; a window per
(item, 64 salts) and one per item merge them.  Items go in blocks of bounded bytes and number, hash-dealt, which is
all that the driver holds and sends out; documents are read once a block.

Defined results: null text or text without terms never ranks and does not count into N; rows that repeat a doc_id are
each a document; null doc_ids come after all others at equal score; items are ranked per row, so a repeated item_id
gives its rows twice; items without terms, or with terms that no document holds, give no rows; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import select_columns, small_batches, store
from ledgerlake.llm.wordruns import byte_map, runs

TOP = 50
SHARD = 1 << 16
CELLS = 1 << 24
"""Entries of an item's table of (term, document) marks; longer items take their shard in several pieces."""
BLOCK_BYTES = 4 << 20
BLOCK_ITEMS = 8192
SALTS = 64

TERM_BYTES = byte_map(lambda b: 48 <= b < 58 or 65 <= b < 91 or 97 <= b < 123)


def terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    return runs(texts, lambda data: TERM_BYTES[data])


def impacts(tf: np.ndarray, n: np.ndarray, weight: np.ndarray, docs: int, length: int) -> np.ndarray:
    """w * ((10^9 * tf) div (1000 * tf + 20 * m)) with m = 100 - 50 + ((50 * n * N) div L)."""
    if len(n) and 50 * int(n.max()) * docs >= 1 << 63:  # the product alone may pass 64 bits
        m = np.array([50 + 50 * int(x) * docs // length for x in n], np.int64)
    else:
        m = 50 + 50 * n * docs // max(length, 1)
    return weight * (1_000_000_000 * tf // (1000 * tf + 20 * m))


def nra(lists: list[tuple[np.ndarray, np.ndarray]], n_docs: int, k: int, floor: int = 1,
        step: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Documents (numbers below ``n_docs``) that may be among the ``k`` best with a score of ``floor`` (> 0) or more, and
    their exact scores: all that reach the k-th best score, more than k at ties.

    ``lists`` holds per term the documents and impacts by falling impact.
    """
    lower, seen = np.zeros(n_docs, np.int64), np.zeros((len(lists), n_docs), bool)
    at, front = 0, np.array([imp[0] if len(imp) else 0 for _, imp in lists], np.int64)
    live = None  # once no other document can come in: the marks of those that still can
    while True:
        for t, (docs, imp) in enumerate(lists):
            d, x = docs[at:at + step], imp[at:at + step]
            if live is not None:
                inside = live[d]
                d, x = d[inside], x[inside]
            lower[d] += x
            seen[t, d] = True
            front[t] = imp[at + step] if at + step < len(imp) else 0
        at, step = at + step, 2 * step
        total = int(front.sum())
        found = np.flatnonzero(lower) if live is None else np.flatnonzero(live)
        low = lower[found]
        least = max(floor, int(np.partition(low, len(low) - k)[len(low) - k])) if len(low) >= k else floor
        upper = low + total - front @ seen[:, found]
        able = upper >= least
        if total < least:
            if (upper[able] == low[able]).all():
                return found[able], low[able]
            live = np.zeros(n_docs, bool)
            live[found[able]] = True


def best(scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray, k: int) -> np.ndarray:
    """Places of the k first by falling score, ascending id, nulls last."""
    return np.lexsort((ids, nulls, -scores))[:k]


class Shards:
    """A task's documents shard by shard, and the k best of each item so far."""

    def __init__(self, weights: np.ndarray, items: list[np.ndarray], docs: int, length: int, k: int):
        self.weights, self.items, self.docs, self.length, self.k = weights, items, docs, length, k
        self.tops: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def add(self, ids: np.ndarray, nulls: np.ndarray, n: np.ndarray, doc: np.ndarray, term: np.ndarray,
            tf: np.ndarray) -> None:
        imp = impacts(tf, n[doc], self.weights[term], self.docs, self.length)
        order = np.lexsort((-imp, term))
        doc, term, imp = doc[order], term[order], imp[order]
        first = np.searchsorted(term, np.arange(len(self.weights) + 1))
        for item, own in enumerate(self.items):
            lists = [(doc[first[t]:first[t + 1]], imp[first[t]:first[t + 1]]) for t in own.tolist()
                     if first[t] < first[t + 1]]
            if not lists:
                continue
            piece = max(1024, CELLS // len(lists))
            for a in range(0, len(ids), piece):
                some = lists if piece >= len(ids) else [
                    (d[x] - a, i[x]) for d, i in lists for x in [(d >= a) & (d < a + piece)]]
                scores, old_ids, old_nulls = self.tops.get(item, (np.zeros(0, np.int64),) * 2 + (np.zeros(0, bool),))
                floor = max(1, int(scores[-1])) if len(scores) == self.k else 1
                found, got = nra(some, min(piece, len(ids) - a), self.k, floor)
                scores, new_ids = np.concatenate([scores, got]), np.concatenate([old_ids, ids[a + found]])
                new_nulls = np.concatenate([old_nulls, nulls[a + found]])
                keep = best(scores, new_ids, new_nulls, self.k)
                self.tops[item] = scores[keep], new_ids[keep], new_nulls[keep]


def count_terms(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """Per document with a term: ``doc_id, n`` and the numbers and counts of its terms in ``vocabulary``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, size = pa.array(vocabulary, pa.string()), max(1, len(vocabulary))
        for batch in batches:
            words, index, doc = terms(batch.column(1))
            n = np.bincount(doc, minlength=batch.num_rows)
            number = pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy(zero_copy_only=False)[index]
            hit = number >= 0
            keys, tf = np.unique(doc[hit] * size + number[hit], return_counts=True)
            cuts = pa.array(np.searchsorted(keys, np.arange(batch.num_rows + 1) * size), pa.int32())
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()),
                 pa.ListArray.from_arrays(cuts, pa.array(keys % size, pa.int32())),
                 pa.ListArray.from_arrays(cuts, pa.array(tf, pa.int32()))], names=["doc_id", "n", "terms", "tfs"])
            yield out.filter(pa.array(n > 0))

    return docs.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, doc_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score`` of each item's k best documents (see the module)."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = select_columns(docs, [doc_col, text_col]).toDF("doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    asked = store(select_columns(items, [item_col, item_text_col]).toDF("item_id", "text")
                  .withColumn("item", F.monotonically_increasing_id()), "items")
    count, size = asked.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-size // BLOCK_BYTES), -(-count // BLOCK_ITEMS))
    tops = None
    for block in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).select("item", "text").collect()
        got = search_block(texts, [r.item for r in own], pa.array([r.text for r in own], pa.string()), k)
        tops = got if tops is None else tops.unionByName(got)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    for keys in (["item", "salt"], ["item"]):
        tops = (tops.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
                .where(F.col("rank") <= k))
    return tops.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def search_block(texts: DataFrame, numbers: list[int], item_texts: pa.Array, k: int) -> DataFrame:
    """``item, salt, doc_id, score``: each task's k best documents of every item of a block."""
    words, index, item = terms(item_texts)
    size = max(1, len(words))
    pairs = np.unique(item * size + index)
    items = np.split(pairs % size, np.searchsorted(pairs, np.arange(1, len(numbers)) * size))
    counted = store(count_terms(texts, words.to_pylist()), "terms")
    docs, length = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(words), np.int64)
    for term, n in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[term] = n  # as many rows as the block has terms
    weights = np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = Shards(weights, items, docs, length, k)
        held: list[pa.RecordBatch] = []

        def close() -> None:
            table = pa.Table.from_batches(held).combine_chunks()
            ids, n, numbers_, tfs = [c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in table.columns]
            sizes = pc.list_value_length(numbers_).to_numpy()
            shards.add(pc.fill_null(ids, 0).to_numpy(), pc.is_null(ids).to_numpy(zero_copy_only=False), n.to_numpy(),
                       np.repeat(np.arange(len(ids)), sizes), numbers_.flatten().to_numpy(),
                       tfs.flatten().to_numpy().astype(np.int64))
            held.clear()

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= SHARD:
                close()
        if held:
            close()
        salt = TaskContext.get().partitionId() % SALTS
        for item, (scores, ids, nulls) in shards.tops.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), numbers[item])), pa.array(np.full(len(ids), salt)),
                 pa.array(ids, pa.int64(), mask=nulls), pa.array(scores)], names=["item", "salt", "doc_id", "score"])

    return counted.mapInArrow(run, "item long, salt long, doc_id long, score long")


ORACLE_SQL = """
WITH low AS (SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
words AS (SELECT row_number() OVER () AS doc, doc_id,
                 regexp_extract_all(text, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM low),
lens AS (SELECT doc, doc_id, len(terms) AS n, terms FROM words WHERE len(terms) > 0),
stats AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM lens),
sizes AS (SELECT doc, doc_id, 100 - 50 + ((50 * n * docs) // total) AS m FROM lens, stats),
asked AS (SELECT item_id, row_number() OVER () AS item,
                 unnest(list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'))) AS term FROM benchmark),
tf AS (SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(terms) AS term FROM lens)
       WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weight AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
           FROM tf, stats GROUP BY term, docs),
scored AS (SELECT item, item_id, doc_id, doc,
                  sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
           FROM asked JOIN tf USING (term) JOIN weight USING (term) JOIN sizes USING (doc) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id, doc) AS rank
           FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""
