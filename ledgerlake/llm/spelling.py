"""Operator 13: spelling variants by k-d trees over letter-count vectors.

Words are the maximal runs of ``[A-Za-zÀ-ÿ]``, A-Z lower-cased, with a seeded noise that deletes a letter of every 31st
(:func:`count_words`).  Two words are near if one inserted, deleted or replaced letter turns one into the other.
Such words' vectors of letter counts differ by at most two in L1: a replaced letter takes one from a count and adds one
to another, an inserted letter adds one to a count.  So near words are found per pair of lengths, (L, L) and (L, L + 1),
by range searches in a k-d tree over the vectors of one length: a search goes down the tree with a budget of one
letter up and one down (one up only for the longer length) and enters a child only if the budget reaches its box
(:meth:`Tree.search`).  Pairs of words whose vectors meet are then compared letter by letter in order.

Scale: words are summed in the map tasks before the shuffle.  An upper tree per length, cut from a hash sample of
``SAMPLE`` words at most, has cells of about ``CELL`` words; every word lies in one cell and is sent to each cell that
its search box meets, at most one more per level for each letter up or down.  A cell with more words than planned
(an unlucky sample, or many words of equal letters, which no cut divides) is dealt over several tasks by the words'
hash, and its searches go to each.  A task holds one such part of a cell, builds the lower tree over it and streams the
searches.  A class of many words with equal letters is met by generating the search word's own edits,
never by comparing all its words.  Links are counted and the best one kept per word, pre-aggregated.  Roots come by
pointer jumping over the words that have a form; a form occurs ten times as often as its word, so chains are short.

Defined results: null text has no words; a null doc_id is spelt ``null`` in the noise's hash; repeated rows count each
time; a table without words gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import discard, select_columns, small_batches, store
from ledgerlake.llm.wordruns import byte_map, runs

LEAST_LETTERS, LEAST_COUNT = 7, 2
NOISE = 31
RATIO = 10
SAMPLE = 200_000
CELL = 1 << 15
LEAF = 4
"""Distinct vectors of a leaf of the lower tree."""
QUERIES = 4096

LETTER_BYTES = byte_map(lambda b: 65 <= b < 91 or 97 <= b < 123)
# the letters of a word in ISO-8859-1: a-z, then U+00C0 to U+00FF
DIMENSIONS = 26 + 64
DIMENSION = np.zeros(256, np.int64)
DIMENSION[97:123] = np.arange(26)
DIMENSION[192:256] = np.arange(26, DIMENSIONS)


def only_letters(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with blanks for all but letters; U+00C0 to U+00FF are C3 and one byte more."""
    lead = data == 0xC3
    kept = (data < 128) | lead
    kept[1:] |= lead[:-1]
    return np.where(kept, LETTER_BYTES[data], np.uint8(32))


class Shifts:
    """CRC-32 of a text put together: crc(a + b) = shift(crc(a), bytes of b) ^ crc(b)."""

    def __init__(self):
        self.tables: dict[int, np.ndarray] = {}

    def table(self, n: int) -> np.ndarray:
        if n not in self.tables:
            zeros = bytes(n)
            empty = zlib.crc32(zeros)
            bits = np.array([zlib.crc32(zeros, 1 << k) ^ empty for k in range(32)], np.uint32)
            table = np.zeros((4, 256), np.uint32)
            for k in range(32):
                table[k // 8, np.arange(256) >> k % 8 & 1 == 1] ^= bits[k]
            self.tables[n] = table
        return self.tables[n]

    def joined(self, first: np.ndarray, second: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """crc of each pair; ``first`` and ``second`` are crcs, ``sizes`` the bytes of the second texts."""
        kinds, at = np.unique(sizes, return_inverse=True)
        tables = np.stack([self.table(int(n)) for n in kinds]) if len(kinds) else np.zeros((1, 4, 256), np.uint32)
        out = second.copy()
        for k in range(4):
            out ^= tables[at, k, first >> np.uint32(8 * k) & np.uint32(255)]
        return out


def count_words(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n``: of all texts, words of at least ``LEAST_LETTERS`` letters after the noise, at least twice.

    h is the crc32 of ``<doc_id>:<run>``; where 31 divides it, letter number h % length is deleted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shifts = Shifts()
        for batch in batches:
            words, index, doc = runs(batch.column(1), only_letters)
            letters = pc.utf8_length(words).to_numpy()
            keep = letters[index] >= LEAST_LETTERS
            index, doc = index[keep], doc[keep]
            used = np.unique(index)
            crcs, sizes = np.zeros(len(words), np.uint32), pc.binary_length(words).to_numpy().astype(np.int64)
            texts = words.take(pa.array(used)).to_pylist()
            crcs[used] = [zlib.crc32(w.encode()) for w in texts]
            heads = np.array([zlib.crc32(("null:" if d is None else f"{d}:").encode())
                              for d in batch.column(0).to_pylist()], np.uint32)
            h = shifts.joined(heads[doc], crcs[index], sizes[index])
            noisy = h % NOISE == 0
            counts = np.bincount(index[~noisy], minlength=len(words))
            some = np.flatnonzero(counts)
            cut = index[noisy].astype(np.int64)
            at = h[noisy] % letters[cut]
            pairs, times = np.unique((cut << 32) + at, return_counts=True)
            spelt = dict(zip(used.tolist(), texts))
            cuts = [(w[:a] + w[a + 1:], t) for w, a, t in zip(
                map(spelt.__getitem__, (pairs >> 32).tolist()), (pairs & (1 << 32) - 1).tolist(), times.tolist())
                if len(w) > LEAST_LETTERS]
            yield pa.RecordBatch.from_arrays([words.take(pa.array(some)).cast(pa.string()), pa.array(counts[some], pa.int64())],
                                             names=["word", "n"])
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in cuts], pa.string()),
                                              pa.array([t for _, t in cuts], pa.int64())], names=["word", "n"])

    small_batches(docs.sparkSession)
    return (select_columns(docs, [doc_col, text_col]).mapInArrow(run, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT))


def letter_counts(words: np.ndarray) -> np.ndarray:
    """Vectors of letter counts of words of one length, given as rows of ISO-8859-1 bytes."""
    kind = np.uint8 if words.shape[1] < 255 else np.int32
    out, row = np.zeros((len(words), DIMENSIONS), kind), np.arange(len(words))
    for column in DIMENSION[words.T]:
        out[row, column] += 1
    return out


class Tree:
    """A k-d tree over vectors of counts; node 0 is the root, a leaf has no children and a number.

    A node is cut where its vectors vary most, at the median: counts up to ``cut`` go left."""

    def __init__(self, vectors: np.ndarray, leaf: int):
        self.dim, self.cut, self.left, self.right, self.leaf = [], [], [], [], []
        self.leaves = 0
        todo = [(np.arange(len(vectors)), self.node())]
        while todo:
            rows, node = todo.pop()
            own = vectors[rows] if len(rows) > leaf else None
            spread = own.astype(np.float32).var(axis=0) if own is not None else np.zeros(1)
            dim = int(spread.argmax())
            if spread[dim] <= 0:
                self.leaf[node] = self.leaves
                self.leaves += 1
                continue
            column = own[:, dim]
            cut = int(np.partition(column, len(column) // 2)[len(column) // 2])
            if cut == int(column.max()):
                cut -= 1
            self.dim[node], self.cut[node] = dim, cut
            self.left[node], self.right[node] = self.node(), self.node()
            todo += [(rows[column <= cut], self.left[node]), (rows[column > cut], self.right[node])]
        for name in ("dim", "cut", "left", "right", "leaf"):
            setattr(self, name, np.array(getattr(self, name), np.int32))

    def node(self) -> int:
        for values in (self.dim, self.cut, self.left, self.right, self.leaf):
            values.append(-1)
        return len(self.dim) - 1

    def search(self, vectors: np.ndarray, up: int, down: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row of ``vectors``, leaf) where the leaf's box holds a vector that has at most ``up`` letters more and
        ``down`` letters less (0 or 1 each); with 0 and 0 the leaf of each vector."""
        row, node = np.arange(len(vectors)), np.zeros(len(vectors), np.int32)
        raised = np.full(len(vectors), -1 if up else -2, np.int32)  # the letter taken up; -1: not yet, -2: none to take
        lowered = np.full(len(vectors), -1 if down else -2, np.int32)
        rows, leaves = [], []
        while len(row):
            done = self.leaf[node] >= 0
            if done.any():
                rows.append(row[done])
                leaves.append(self.leaf[node[done]])
                go = ~done
                row, node, raised, lowered = row[go], node[go], raised[go], lowered[go]
                continue
            dim, cut = self.dim[node], self.cut[node]
            count = vectors[row, dim].astype(np.int32) + (raised == dim) - (lowered == dim)
            left = count <= cut
            over = (count == cut) & (raised == -1) & (lowered != dim)
            under = (count == cut + 1) & (lowered == -1) & (raised != dim)
            o, u = np.flatnonzero(over), np.flatnonzero(under)
            row = np.concatenate([row, row[o], row[u]])
            raised = np.concatenate([raised, dim[o], raised[u]])
            lowered = np.concatenate([lowered, lowered[o], dim[u]])
            node = np.concatenate([np.where(left, self.left[node], self.right[node]), self.right[node[o]], self.left[node[u]]])
        if not rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        return np.concatenate(rows), np.concatenate(leaves)


def spread_out(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every stretch, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of words ``a`` are one edit from the rows of ``b``, of the same length or one longer."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    n = a.shape[1]
    same, shifted = a == b[:, :n], a == b[:, 1:]
    ahead = np.where(same.all(axis=1), n, (~same).argmax(axis=1))
    behind = np.where(shifted.all(axis=1), n, (~shifted[:, ::-1]).argmax(axis=1))
    return ahead + behind >= n


class Cell:
    """Words of one length in a lower tree, and searches among them."""

    def __init__(self, words: np.ndarray):
        vectors = letter_counts(words)
        flat = np.ascontiguousarray(vectors).view([("", vectors.dtype)] * DIMENSIONS).ravel()
        _, first, at = np.unique(flat, return_index=True, return_inverse=True)
        order = np.argsort(at, kind="stable")
        self.words, self.number = words[order], order
        self.vectors = vectors[first]
        self.ends = np.searchsorted(at[order], np.arange(len(first) + 1))
        self.tree = Tree(self.vectors, LEAF)
        home = self.tree.search(self.vectors, 0, 0)
        by_leaf = np.argsort(home[1], kind="stable")
        self.in_leaf = home[0][by_leaf]
        self.leaf_ends = np.searchsorted(home[1][by_leaf], np.arange(self.tree.leaves + 1))
        self.classes: dict[int, dict[bytes, int]] = {}

    def near(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row of ``words``, number of a word of the cell) one edit apart; ``words`` have the cell's length or one
        letter less."""
        less = self.words.shape[1] - words.shape[1]
        vectors = letter_counts(words)
        row, leaf = self.tree.search(vectors, 1, 1 - less)
        sizes = np.diff(self.leaf_ends)[leaf]
        vector = self.in_leaf[spread_out(self.leaf_ends[leaf], sizes)]
        row = np.repeat(row, sizes)
        out = []
        some = max(1, (1 << 24) // max(DIMENSIONS, words.shape[1]))
        meets = np.concatenate([self.distance(vectors[row[a:a + some]], self.vectors[vector[a:a + some]]) == 2 - less
                                for a in range(0, len(row), some)] or [np.zeros(0, bool)])
        row, vector = row[meets], vector[meets]
        sizes = np.diff(self.ends)[vector]
        large = sizes > 4 * words.shape[1] + 16
        for r, v in zip(row[large].tolist(), vector[large].tolist()):
            out.append((r, self.edits(words[r], vectors[r], v)))
        row, vector, sizes = row[~large], vector[~large], sizes[~large]
        place = spread_out(self.ends[vector], sizes)
        row = np.repeat(row, sizes)
        kept = np.concatenate([one_edit(words[row[a:a + some]], self.words[place[a:a + some]])
                               for a in range(0, len(row), some)] or [np.zeros(0, bool)])
        rows = np.concatenate([row[kept], *[np.full(len(x), r) for r, x in out]]).astype(np.int64)
        return rows, np.concatenate([self.number[place[kept]], *[x for _, x in out]]).astype(np.int64)

    @staticmethod
    def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (np.maximum(a, b) - np.minimum(a, b)).sum(axis=1, dtype=np.int64)

    def edits(self, word: np.ndarray, vector: np.ndarray, v: int) -> np.ndarray:
        """Numbers of the words of class ``v`` that one edit of ``word`` gives; the vectors say which letters."""
        if v not in self.classes:
            a, b = self.ends[v], self.ends[v + 1]
            self.classes[v] = {w.tobytes(): int(k) for w, k in zip(self.words[a:b], self.number[a:b])}
        own, change = self.classes[v], self.vectors[v].astype(np.int64) - vector
        letter = np.flatnonzero(change > 0)[0]
        new = bytes([97 + letter if letter < 26 else 192 + letter - 26])
        text = word.tobytes()
        if len(text) < self.words.shape[1]:
            tried = {text[:i] + new + text[i:] for i in range(len(text) + 1)}
        else:
            gone = np.flatnonzero(change < 0)[0]
            tried = {text[:i] + new + text[i + 1:] for i in np.flatnonzero(DIMENSION[word] == gone).tolist()}
        return np.array([own[t] for t in tried if t in own], np.int64)


def matrix(words: pa.Array) -> np.ndarray:
    """Rows of bytes of binary values of one length."""
    size = len(words[0].as_py())
    joined = b"".join(words.to_pylist())
    return np.frombuffer(joined, np.uint8).reshape(-1, size)


def by_length(words: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Each length of the words, and their rows."""
    lengths = pc.binary_length(words).to_numpy()
    for n in np.unique(lengths).tolist():
        yield n, np.flatnonzero(lengths == n)


class Cells:
    """The upper trees, one per length, and the number of parts of each over-full cell."""

    def __init__(self, trees: dict[int, Tree], parts: dict[tuple[int, int], int]):
        self.trees, self.parts = trees, parts

    def find(self, length: int, words: np.ndarray, up: int, down: int) -> tuple[np.ndarray, np.ndarray]:
        tree = self.trees.get(length)
        if tree is None:
            return np.arange(len(words)), np.zeros(len(words), np.int32)
        return tree.search(letter_counts(words), up, down)


ROUTED = "length int, cell int, part int, search boolean, word binary, n long"


def route(words: DataFrame, cells: Cells, searches: bool) -> DataFrame:
    """Every word in its cell, and with ``searches`` also in all cells that its two search boxes meet."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(length: int, row: np.ndarray, cell: np.ndarray, words_: pa.Array, n: pa.Array, search: bool):
            parts = np.array([cells.parts.get((length, c), 1) for c in cell.tolist()], np.int64)
            if search:
                sizes = parts
                row, cell = np.repeat(row, sizes), np.repeat(cell, sizes)
                part = spread_out(np.zeros(len(sizes), np.int64), sizes)
            else:
                part = np.array([zlib.crc32(w) for w in words_.to_pylist()], np.int64)[row] % parts
            at, size = pa.array(row), len(row)
            for a in range(0, size, 1 << 16):
                s = slice(a, a + (1 << 16))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(row[s]), length, np.int32)), pa.array(cell[s].astype(np.int32)),
                     pa.array(part[s].astype(np.int32)), pa.array(np.full(len(row[s]), search)),
                     words_.take(at[s]), n.take(at[s])], names=["length", "cell", "part", "search", "word", "n"])

        for batch in batches:
            for length, rows in by_length(batch.column(0)):
                words_, n = batch.column(0).take(pa.array(rows)), batch.column(1).take(pa.array(rows))
                letters = matrix(words_)
                yield from out(length, *cells.find(length, letters, 0, 0), words_, n, False)
                if searches:
                    yield from out(length, *cells.find(length, letters, 1, 1), words_, n, True)
                    yield from out(length + 1, *cells.find(length + 1, letters, 1, 0), words_, n, True)

    return words.mapInArrow(run, ROUTED)


def plan_cells(words: DataFrame, cell: int = CELL, sample: int = SAMPLE) -> Cells:
    """Cut the upper trees from a hash sample of about ``sample`` words; count all words per cell for over-full ones."""
    total = words.count()
    share = max(1, -(-total // sample))
    picked = words.where(F.pmod(F.xxhash64("latin"), F.lit(share)) == 0).select("latin").toPandas()["latin"]
    picked = pa.array([bytes(x) for x in picked], pa.binary())
    trees = {n: Tree(letter_counts(matrix(picked.take(pa.array(rows)))), max(1, cell // share))
             for n, rows in by_length(picked) if len(rows) * share > cell}
    cells = Cells(trees, {})
    sizes = route(words, cells, False).groupBy("length", "cell").count().where(F.col("count") > 2 * cell)
    return Cells(trees, {(r.length, r.cell): -(-r["count"] // cell) for r in sizes.collect()})


def links(words: DataFrame, cells: Cells) -> DataFrame:
    """``word, near, near_n`` (ISO-8859-1 bytes) of every two near words, both ways."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, points, cell, numbers, asked = None, [], None, None, []

        def ask() -> Iterator[pa.RecordBatch]:
            for length, group in asked_by_length():
                letters, n, words_ = matrix(group.column(0)), group.column(1), group.column(0)
                for a in range(0, len(letters), QUERIES):
                    row, number = cell.near(letters[a:a + QUERIES])
                    if not len(row):
                        continue
                    own, found = pa.array(row + a), pa.array(number)
                    near = numbers[0].take(found), numbers[1].take(found)
                    mine = words_.take(own), n.take(own)
                    names = ["word", "near", "near_n"]
                    yield pa.RecordBatch.from_arrays([mine[0], near[0], near[1]], names=names)
                    if length < cell.words.shape[1]:  # the search of the longer word doesn't come here
                        yield pa.RecordBatch.from_arrays([near[0], mine[0], mine[1]], names=names)
            asked.clear()

        def asked_by_length() -> Iterator[tuple[int, pa.RecordBatch]]:
            table = pa.Table.from_batches(asked).combine_chunks().to_batches()[0]
            for length, rows in by_length(table.column(0)):
                yield length, table.take(pa.array(rows))

        for batch in batches:
            keys = np.stack([batch.column(k).to_numpy() for k in range(3)])
            turns = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for a, b in zip([0, *turns.tolist()], [*turns.tolist(), batch.num_rows]):
                now = tuple(keys[:, a].tolist())
                if now != key:
                    if asked:
                        yield from ask()
                    key, points, cell = now, [], None
                some = batch.slice(a, b - a)
                search = some.column(3).to_numpy(zero_copy_only=False)
                held = some.filter(pa.array(~search))
                if held.num_rows:
                    points.append(held.select(["word", "n"]))
                queries = some.filter(pa.array(search)).select(["word", "n"])
                if queries.num_rows and points:
                    if cell is None:
                        table = pa.Table.from_batches(points).combine_chunks().to_batches()[0]
                        numbers = table.column(0), table.column(1)
                        cell = Cell(matrix(numbers[0]))
                    asked.append(queries)
                    if sum(x.num_rows for x in asked) >= 4 * QUERIES:
                        yield from ask()
        if asked:
            yield from ask()

    keys = ["length", "cell", "part"]
    return (route(words, cells, True).repartition(*keys).sortWithinPartitions(*keys, "search")
            .mapInArrow(run, "word binary, near binary, near_n long"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of every word with a form, by pointer jumping: each round doubles the steps that a root is away."""
    now = store(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = store(now.join(ahead, "root", "left")
                      .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        discard(now)
        now = after
        if now.where("moved").isEmpty():
            return now.select("word", "root")


def variants(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the texts (see the module)."""
    words = store(count_words(docs, doc_col, text_col).select(F.encode("word", "ISO-8859-1").alias("latin"), "n"), "words")
    small_batches(docs.sparkSession)
    found = links(words.select("latin", "n"), plan_cells(words)).groupBy(F.col("word").alias("latin")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near"))).alias("top"))
    linked = store(
        words.join(found, "latin", "left").select(
            "latin", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(-F.col("top.minus") >= RATIO * F.col("n"), F.col("top")).alias("top"))
        .select(F.decode("latin", "ISO-8859-1").alias("word"), "n", "n_near",
                F.decode("top.near", "ISO-8859-1").alias("form"), (-F.col("top.minus")).alias("form_n")), "linked")
    ends = roots(linked.where("form IS NOT NULL").select("word", "form"))
    return linked.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
