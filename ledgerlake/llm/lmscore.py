"""Operator 3: stupid-backoff scores from n-gram count tables partitioned by hash.

A text's words (lower case, split on white space) are scored one by one: a word after a context that the corpus holds
``least`` times or more with it scores count(context word) / count(context); otherwise the context is
shortened at a cost of ``backoff``, down to count(word) / all words.  A document's score is the mean logarithm.
Counts are those of the whole corpus.

Relations.  Documents are dealt into blocks by a hash of their id.  A block explodes its texts and sends each distinct
n-gram's hash and count, once, to the n-gram's partition of the count table; there the counts of all blocks are summed and
joined back to what each block had sent, and the block sums its documents' scores.  Longer n-grams are sent only if both
n-grams inside them reached ``least``, since no other can.

Scale: what a block sends is bounded by its own text, and an n-gram that stands in a third of all
documents is one entry a block, so hot words and phrases load no partition more than others.  Blocks and partitions grow with
the corpus.  An entry takes 48 bits beside its partition, so two n-grams of a partition of five million entries
meet by chance in about 4 cases in 100 partitions.

Defined results: null texts have no words, n_words 0 and a null score; repeated rows are scored each (and
counted each); an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import select_columns

ORDER = 3
BACKOFF = 0.4
LEAST = 2
BLOCK_CHARS = 8 << 20
LOW = np.uint64((1 << 48) - 1)
SENT = pa.schema([("block", pa.int32()), ("part", pa.int32()), ("n", pa.int32()), ("low", pa.binary()), ("high", pa.binary()), ("counts", pa.binary())])
SENT_DDL = "block int, part int, n int, low binary, high binary, counts binary"
BACK = pa.schema([("block", pa.int32()), ("part", pa.int32()), ("n", pa.int32()), ("counts", pa.binary())])
BACK_DDL = "block int, part int, n int, counts binary"


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def squeeze(counts: np.ndarray) -> bytes:
    """Counts in a byte each; those of 255 or more follow in eight."""
    small = np.minimum(counts, 255).astype(np.uint8)
    return small.tobytes() + counts[small == 255].astype(np.uint64).tobytes()


def unsqueeze(data: bytes, n: int) -> np.ndarray:
    out = np.frombuffer(data, np.uint8, n).astype(np.int64)
    out[out == 255] = np.frombuffer(data, np.uint64, offset=n)
    return out


class Grams:
    """A block's words and, for each order, its distinct n-grams."""

    def __init__(self, texts: pa.ChunkedArray, parts: int):
        split = pc.ascii_split_whitespace(pc.utf8_lower(pc.fill_null(texts, ""))).combine_chunks()
        lists = split if isinstance(split, pa.Array) else pa.concat_arrays(split.chunks)
        words = lists.flatten().dictionary_encode()
        digest = xxhash.xxh3_64_intdigest
        kinds = words.dictionary.to_pylist()
        hashes = np.fromiter((digest(w) for w in kinds), np.uint64, len(kinds))
        codes = words.indices.to_numpy()
        bounds = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
        real = np.fromiter((w != "" for w in kinds), bool, len(kinds))[codes] if len(codes) else np.zeros(0, bool)
        doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[real]
        self.parts, self.docs = np.uint64(parts), len(bounds) - 1
        self.doc, self.word = doc, hashes[codes][real] if len(codes) else np.zeros(0, np.uint64)
        self.place = np.arange(len(doc)) - np.searchsorted(doc, doc)  # of a word in its document
        self.n_words = np.bincount(doc, minlength=self.docs)
        self.chain = {1: mix(self.word)}
        self.known: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # order -> words that end a kept n-gram, their counts

    def hashed(self, n: int) -> np.ndarray:
        """The hash of the n-gram that ends at each word (only right from place n - 1 on)."""
        if n not in self.chain:
            before = np.concatenate([np.zeros(1, np.uint64), self.hashed(n - 1)[:-1]]) if len(self.word) else self.word
            self.chain[n] = mix(before * np.uint64(0x9E3779B97F4A7C15) + self.word + np.uint64(n))
        return self.chain[n]

    def open(self, n: int, least: int) -> np.ndarray:
        """Words that may end an n-gram of ``least`` occurrences."""
        ok = self.place >= n - 1
        if n > 2:  # both n-grams inside must have reached it
            last = self.count(n - 1) >= least
            ok &= last & np.concatenate([[False], last[:-1]]) if len(last) else ok
        return np.flatnonzero(ok)

    def distinct(self, n: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Open words, and the distinct n-grams' keys in order, each word's n-gram, and the counts."""
        at = self.open(n, least)
        h = self.hashed(n)[at]
        key = ((h >> np.uint64(48)) % self.parts << np.uint64(48)) | (h & LOW)
        return at, *np.unique(key, return_inverse=True, return_counts=True)

    def count(self, n: int) -> np.ndarray:
        """The corpus's count of the n-gram that ends at each word; 0 where it was not sent."""
        out = np.zeros(len(self.word), np.int64)
        at, counts = self.known[n]
        out[at] = counts
        return out

    def learn(self, answers: pa.Table, orders: range, least: int) -> None:
        for n in orders:
            own = answers.filter(pc.equal(answers["n"], n)).sort_by("part")
            at, key, which, _ = self.distinct(n, least)
            sizes = np.unique(key >> np.uint64(48), return_counts=True)[1]
            got = [unsqueeze(x, k) for x, k in zip(own["counts"].to_pylist(), sizes.tolist(), strict=True)]
            self.known[n] = at, np.concatenate(got)[which] if got else np.zeros(len(at), np.int64)


def send(block: int, grams: Grams, n: int, least: int) -> pa.Table:
    """The distinct n-grams of a block by partition: low 32 bits, steps of the 16 bits above, and counts."""
    _, key, _, counts = grams.distinct(n, least)
    part = (key >> np.uint64(48)).astype(np.int64)
    cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]])) if len(key) else np.zeros(1, np.int64)
    rows = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        high = ((key[a:b] >> np.uint64(32)) & np.uint64(0xFFFF)).astype(np.uint16)
        steps = np.diff(high, prepend=np.uint16(0))
        rows.append({"block": block, "part": int(part[a]), "n": n, "low": (key[a:b] & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes(),
                     "high": steps.tobytes() if steps.max() > 255 else steps.astype(np.uint8).tobytes(), "counts": squeeze(counts[a:b])})
    return pa.Table.from_pylist(rows, SENT)


def tally(sent: pa.Table) -> pa.Table:
    """A partition of the count table: the summed counts, joined back to every block's entries."""
    keys, counts, sizes = [], [], []
    for low, high, count in zip(*(sent[c].to_pylist() for c in ("low", "high", "counts"))):
        low = np.frombuffer(low, np.uint32)
        steps = np.frombuffer(high, np.uint8 if len(high) == len(low) else np.uint16)
        keys.append((np.cumsum(steps, dtype=np.uint64) << np.uint64(32)) | low)
        counts.append(unsqueeze(count, len(low)))
        sizes.append(len(low))
    _, which = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(which, weights=np.concatenate(counts)).astype(np.int64)[which]
    cuts = np.cumsum([0, *sizes])
    return pa.table({"block": sent["block"], "part": sent["part"], "n": sent["n"],
                     "counts": pa.array([squeeze(total[a:b]) for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())}, schema=BACK)


def scores(docs: DataFrame, order: int = ORDER, backoff: float = BACKOFF, least: int = LEAST, block_chars: int = BLOCK_CHARS,
           doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, score`` (mean natural logarithm) for every row of ``docs``."""
    rows = select_columns(docs, [doc_col, text_col]).toDF("doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    chars = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-chars // block_chars))
    parts = min(1 << 16, blocks)
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int")).repartition(int(blocks), "block")
    first = range(1, min(order, 2) + 1)

    def explode_first(key: tuple, texts: pa.Table) -> pa.Table:
        grams = Grams(texts["text"], parts)
        words = pa.Table.from_pylist([{"block": key[0].as_py(), "part": 0, "n": 0, "low": bytes(4), "high": bytes(1),
                                       "counts": squeeze(np.array([len(grams.word)]))}], SENT)  # the empty n-gram counts all words
        return pa.concat_tables([words, *(send(key[0].as_py(), grams, n, least) for n in first)])

    def joined(answers: DataFrame, run, kind: str) -> DataFrame:
        return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, kind)

    def counted(sent: DataFrame) -> DataFrame:
        return sent.groupBy("part", "n").applyInArrow(tally, BACK_DDL)

    answers = counted(dealt.groupBy("block").applyInArrow(explode_first, SENT_DDL))
    def explode(n: int):
        def run(key: tuple, texts: pa.Table, known: pa.Table) -> pa.Table:
            grams = Grams(texts["text"], parts)
            grams.learn(known, range(1, n), least)
            return send(key[0].as_py(), grams, n, least)
        return run

    for n in range(3, order + 1):
        answers = answers.unionByName(counted(joined(answers, explode(n), SENT_DDL)))

    def score(key: tuple, texts: pa.Table, known: pa.Table) -> pa.Table:
        grams = Grams(texts["text"], parts)
        grams.learn(known, range(1, order + 1), least)
        below = grams.count(1)
        words = unsqueeze(known.filter(pc.equal(known["n"], 0))["counts"][0].as_py(), 1)[0]
        value = np.log(np.maximum(below, 1) / max(1, int(words)))
        for n in range(2, order + 1):
            here = grams.count(n)
            context = np.concatenate([[0], below[:-1]]) if len(below) else below
            seen = here >= least
            longer = grams.place >= n - 1
            value = np.where(seen, np.log(np.maximum(here, 1) / np.maximum(context, 1)), np.where(longer, value + np.log(backoff), value))
            below = here
        total = np.bincount(grams.doc, weights=value, minlength=grams.docs)
        n = grams.n_words
        return pa.table({"doc_id": texts["doc_id"], "n_words": pa.array(n, pa.int64()),
                         "score": pa.array(total / np.maximum(n, 1), pa.float64(), mask=n == 0)})

    return joined(answers, score, "doc_id long, n_words long, score double")
