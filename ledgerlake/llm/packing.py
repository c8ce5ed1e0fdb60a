"""Operator 1: cost-balanced packing of token sequences.

Every document is tokenised, an end id is appended, and its ids are laid into sequences of at most
``capacity`` tokens.  A sequence's attention cost is estimated as ``linear * n + quadratic * n * n`` for each
document piece of ``n`` tokens in it.  Documents go in descending order of length, each to the sequence of the
lowest cost that still has room for it; a document that fits nowhere is cut and fills the cheapest rests.

Scale: a task packs windows of ``window`` sequences from its own input partition, so no ids are shuffled,
no task holds more than one window, and a hot source or a group of copies costs nothing extra.  A window
takes exactly ``window * capacity`` ids (the last document is cut and continues in the next window), so full
windows have no padding; the rest of a partition ends in sequences whose lengths are powers of two.
A lost task repeats with the same rows and gives the same pieces and sequence ids.

Defined results: null or empty text is one piece holding only the end id; repeated rows and doc_ids are packed
once per row; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import gc
import itertools
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import select_columns, small_batches

CAPACITY = 4096
END_ID = 2
TOKENIZER = "word_bpe_49k.json"
WINDOW = 256
PIECES = ("doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, `offset` long, "
          "sequence_cost double")


def gather(values: np.ndarray, first: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists number ``at`` of ``values`` (list k goes from first[k] to first[k + 1]), and their bounds."""
    start, lengths = first[at], first[at + 1] - first[at]
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.arange(total) + np.repeat(start - ends + lengths, lengths)], np.concatenate([[0], ends])


# kinds of bytes in lower-cased UTF-8 of characters below U+0100; a character of two bytes is told by its second
BLANK, LETTER, DIGIT, OTHER = range(4)
ONE_BYTE = np.full(256, OTHER, np.uint8)
ONE_BYTE[[9, 10, 11, 12, 13, 32]] = BLANK
ONE_BYTE[48:58] = DIGIT
ONE_BYTE[97:123] = LETTER
AFTER_C2 = np.full(256, OTHER, np.uint8)  # U+0080 to U+00BF
AFTER_C2[[0xAA, 0xB5, 0xBA]] = LETTER
AFTER_C2[[0xB2, 0xB3, 0xB9, 0xBC, 0xBD, 0xBE]] = DIGIT
AFTER_C3 = np.full(256, LETTER, np.uint8)  # U+00C0 to U+00FF
AFTER_C3[[0x97, 0xB7]] = OTHER


def split_pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The lower-cased pieces of all texts (characters below U+0100) one after another, and where each text's begin.

    A piece is a run of letters, a single digit, a run of other signs, or one of the endings 's 't 're 've 'm 'll 'd
    where no other sign stands before it.  The bytes are classed, blanks are put in between pieces, and Arrow splits."""
    if texts.offset:
        texts = pa.concat_arrays([texts])
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int32, len(texts) + 1).astype(np.int64)
    raw = np.frombuffer(data, np.uint8, int(at[-1])) if data is not None else np.zeros(0, np.uint8)
    if not len(raw):
        return pa.array([], texts.type), np.zeros(len(texts) + 1, np.int64)
    before = np.concatenate([[np.uint8(0)], raw[:-1]])
    after_c2, after_c3 = before == 0xC2, before == 0xC3
    upper = (raw >= 65) & (raw <= 90) | after_c3 & (raw >= 0x80) & (raw <= 0x9E) & (raw != 0x97)
    low = raw + (upper.astype(np.uint8) << 5)
    kind = np.where(after_c2, AFTER_C2[low], np.where(after_c3, AFTER_C3[low], ONE_BYTE[low]))
    lead = (raw == 0xC2) | (raw == 0xC3)
    kind[:-1] = np.where(lead[:-1], kind[1:], kind[:-1])
    starts = np.zeros(len(raw), bool)  # first bytes of texts
    starts[at[:-1][at[:-1] < len(raw)]] = True
    earlier = np.concatenate([[np.uint8(BLANK)], kind[:-1]])
    earlier[starts] = BLANK
    cut = (kind != earlier) | (kind == DIGIT) & ~(after_c2 | after_c3)
    signs = np.flatnonzero((low == 39) & (earlier != OTHER))
    if len(signs):
        ahead = np.concatenate([low, np.zeros(3, np.uint8)])
        one, two = ahead[signs + 1], ahead[signs + 2]
        size = np.where(np.isin(one, np.frombuffer(b"stmd", np.uint8)), 1, 0)
        for ending in (b"re", b"ve", b"ll"):
            size[(one == ending[0]) & (two == ending[1])] = 2
        ends = at[np.searchsorted(at, signs, "right")]  # of the sign's text
        size[signs + size >= ends] = 0
        signs, size, ends = signs[size > 0], size[size > 0], ends[size > 0]
        cut[signs + 1] = False
        behind = signs + size + 1
        cut[behind[behind < ends]] = True
    cut[starts] = False
    cuts = np.flatnonzero(cut)
    out = np.full(len(raw) + len(cuts), 32, np.uint8)
    moved = np.arange(len(raw)) + np.cumsum(cut)
    out[moved] = low
    added = np.searchsorted(cuts, at)
    spaced = pa.Array.from_buffers(texts.type, len(texts), [None, pa.py_buffer((at + added).astype(np.int32)), pa.py_buffer(out)])
    split = pc.ascii_split_whitespace(spaced)
    pieces, bounds = split.flatten(), split.offsets.to_numpy().astype(np.int64)
    full = pc.not_equal(pieces, "")
    kept = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    return pieces.filter(full), kept[bounds]


class Numbers(dict):
    """Numbers its keys as they are first looked up; ``fresh`` lists those looked up since it was last emptied."""

    def __init__(self):
        self.fresh: list[str] = []

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        self.fresh.append(key)
        return n


class WordTokenizer:
    """Ids of a tokenizer file; of the known word-level BPE file remembered per piece of a word.

    With that file's normaliser and splitter (``KNOWN``), texts whose characters are all below U+0100 are lower-cased
    and split into the file's pieces all at once, as bytes (:func:`split_pieces`), and the pieces' ids are looked up.
    Other texts go through the library unchanged, as do texts that hold an added token's string, and all texts with
    any other file.  The memory of pieces is emptied when it grows past ``most`` pieces.
    """

    # fixed values: how the word-level file normalises and splits
    KNOWN = ({"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
                                                  {"type": "Lowercase"}]},
             {"type": "Sequence", "pretokenizers": [
                 {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
                  "behavior": "Removed", "invert": True},
                 {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]})

    def __init__(self, file: str, most: int = 500_000):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel
        letters = ByteLevel(add_prefix_space=False, use_regex=False)
        self.spelt = {c: letters.pre_tokenize_str(chr(c))[0][0] for c in range(0xA1, 0x100)}
        self.whole = Tokenizer.from_file(file)
        self.most = most
        told = json.loads(self.whole.to_str())
        self.known = (told["normalizer"], told["pre_tokenizer"]) == self.KNOWN
        self.added = [t["content"] for t in told["added_tokens"]]
        self.plain = re.compile("[\t-\r\x20-\x7e¡-ÿ]*").fullmatch
        self.forget()

    def forget(self) -> None:
        self.piece = Numbers()
        self.ids = np.zeros(0, np.uint32)
        self.first = np.zeros(1, np.int64)

    def learn(self) -> None:
        """Add the ids of the pieces that were looked up for the first time: the file's model knows them as strings
        in which a character stands for each byte."""
        fresh, self.piece.fresh = self.piece.fresh, []
        if fresh:
            tokenize, spelt = self.whole.model.tokenize, self.spelt
            got = [[token.id for token in tokenize(piece.translate(spelt))] for piece in fresh]
            lengths = np.fromiter(map(len, got), np.int64, len(got))
            ids = np.fromiter(itertools.chain.from_iterable(got), np.uint32, int(lengths.sum()))
            self.ids = np.concatenate([self.ids, ids])
            self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(lengths)])

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text (null: none), without special tokens."""
        if len(self.piece) > self.most:
            self.forget()
        texts = pc.fill_null(texts, "")
        strings = texts.to_pylist()
        if not self.known:
            return [np.array(self.whole.encode(t, add_special_tokens=False).ids, np.uint32) for t in strings]
        special = pa.array(np.zeros(len(strings), bool))
        for token in self.added:
            special = pc.or_(special, pc.match_substring(texts, token))
        simple = [not s and bool(self.plain(t)) and (t.isascii() or unicodedata.is_normalized("NFC", t))
                  for t, s in zip(strings, special.to_pylist())]
        pieces, offsets = split_pieces(pc.if_else(pa.array(simple), texts, pa.scalar("", texts.type)))
        pieces = pieces.dictionary_encode()
        number = np.fromiter(map(self.piece.__getitem__, pieces.dictionary.to_pylist()), np.int64, len(pieces.dictionary))
        self.learn()
        ids, bounds = gather(self.ids, self.first, number[pieces.indices.to_numpy()])
        cuts = bounds[offsets]
        return [ids[a:b] if plain else np.array(self.whole.encode(t, add_special_tokens=False).ids, np.uint32)
                for a, b, plain, t in zip(cuts[:-1].tolist(), cuts[1:].tolist(), simple, strings)]


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer(file: str) -> WordTokenizer:
    if file not in _TOKENIZERS:
        _TOKENIZERS[file] = WordTokenizer(file)
    return _TOKENIZERS[file]


def lay_out(lengths: list[int], rooms: list[int], linear: float, quadratic: float) -> tuple[list[tuple[int, int, int, int, int]], np.ndarray]:
    """Lay items of ``lengths`` into sequences with ``rooms`` tokens (as many in all).

    Returns pieces ``(item, start in the item, length, sequence, offset)`` and each sequence's cost.
    """
    room, used = np.array(rooms, np.int64), np.zeros(len(rooms), np.int64)
    cost, pieces = np.zeros(len(rooms)), []

    def put(item: int, start: int, n: int, s: int) -> None:
        pieces.append((item, start, n, s, int(used[s])))
        used[s] += n
        room[s] -= n
        cost[s] += linear * n + quadratic * n * n

    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        start, left = 0, lengths[item]
        while left:
            fits = np.flatnonzero(room >= left)
            if len(fits):
                s = int(fits[np.argmin(cost[fits])])
            else:
                most = room.max()
                fits = np.flatnonzero(room == most) if left > most else np.flatnonzero(room > 0)
                s = int(fits[np.argmin(cost[fits])])
            n = min(left, int(room[s]))
            put(item, start, n, s)
            start, left = start + n, left - n
    return pieces, cost


def pack(docs: DataFrame, tokenizer_file: str | None = None, capacity: int = CAPACITY, window: int = WINDOW,
         end_id: int = END_ID, linear: float = 1.0, quadratic: float = 1.0 / 1024,
         doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack ``docs`` (see the module); one row per piece with its ids as little-endian unsigned 32-bit values."""
    if tokenizer_file is None:
        import public_tokenizers
        tokenizer_file = public_tokenizers.path(TOKENIZER)
    small_batches(docs.sparkSession)
    rows = select_columns(docs, [doc_col, text_col])
    full = capacity * window

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # millions of short strings and no cycles among them
        words = tokenizer(tokenizer_file)
        next_sequence = TaskContext.get().partitionId() << 33
        pool: list[tuple[int | None, int, np.ndarray, int]] = []  # doc_id, start, ids, ids of the document
        held = 0

        def lay(items: list, rooms: list[int]) -> pa.RecordBatch:
            nonlocal next_sequence
            pieces, cost = lay_out([len(x[2]) for x in items], rooms, linear, quadratic)
            out = [(items[i][0], items[i][1] + a, n, items[i][2][a:a + n].astype("<u4").tobytes(), items[i][3],
                    next_sequence + s, at, float(cost[s])) for i, a, n, s, at in pieces]
            next_sequence += len(rooms)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
            names = ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "sequence_cost")
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=list(names))

        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                for doc, ids in zip(part.column(0).to_pylist(), words.encode(part.column(1))):
                    ids = np.append(ids, np.uint32(end_id))
                    pool.append((doc, 0, ids, len(ids)))
                    held += len(ids)
                    while held >= full:
                        doc_id, start, ids_, n = pool.pop()
                        over = held - full
                        keep = len(ids_) - over
                        pool.append((doc_id, start, ids_[:keep], n))
                        yield lay(pool, [capacity] * window)
                        pool = [(doc_id, start + keep, ids_[keep:], n)] if over else []
                        held = over
        if held:
            rest = held % capacity
            tail = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
            yield lay(pool, [capacity] * (held // capacity) + tail)

    return rows.mapInArrow(run, PIECES)


def digest(pieces: DataFrame) -> DataFrame:
    """The contract's columns: ids replaced by their unsigned CRC-32."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "sequence_cost")
