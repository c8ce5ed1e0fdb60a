"""Whole batches of texts cut into words at once, as numbers into the batch's distinct words."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def byte_map(keep: Callable[[int], bool]) -> np.ndarray:
    """A table of 256 bytes: A-Z to a-z, ASCII that ``keep`` refuses to a blank, all else to itself."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[[b for b in range(128) if not keep(b)]] = 32
    return table


def runs(texts: pa.Array, clean: Callable[[np.ndarray], np.ndarray]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The runs of non-blank bytes of each text (null: none) after ``clean``, a map of the UTF-8 bytes of all texts
    that keeps their places and leaves valid UTF-8.  Returns the distinct runs, and for every run in turn its number
    among them and the number of its text."""
    texts = pc.fill_null(texts, "")
    if texts.offset:
        texts = pa.concat_arrays([texts])
    _, offsets, data = texts.buffers()
    cleaned = clean(np.frombuffer(data, np.uint8)) if data is not None and data.size else np.zeros(0, np.uint8)
    texts = pa.Array.from_buffers(texts.type, len(texts), [None, offsets, pa.py_buffer(cleaned.tobytes())])
    split = pc.ascii_split_whitespace(texts)
    words = split.flatten().dictionary_encode()
    index = words.indices.to_numpy()
    doc = np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))
    blank = pc.index(words.dictionary, pa.scalar("", words.dictionary.type)).as_py()
    if blank >= 0:
        kept = index != blank
        index, doc = index[kept], doc[kept]
    return words.dictionary, index, doc
