"""Words of whole Arrow columns at once, for operators that count them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are cut into words at a time; a longer text is taken alone.
SLICE = 2 << 20
BLANK, BREAK = 0x20, 0x0A


def slices(texts: pa.Array, most: int = SLICE) -> Iterator[pa.Array]:
    """``texts`` in runs of at most ``most`` bytes, or of one text."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield texts.slice(at, upto - at)
        at = upto


def cut(texts: pa.Array, bytes_to: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words, text of each word, break before it) of texts without nulls, in order.

    A-Z become lower case, then ``bytes_to`` maps every byte; words are what is
    left between blanks and line feeds. A break stands before a word that a line
    feed or the start of its text precedes.
    """
    parts = texts.cast(pa.binary()).to_pylist()
    raw = np.frombuffer(b"\n".join(parts).lower().translate(bytes_to), np.uint8)
    gap = (raw == BLANK) | (raw == BREAK)
    # The bytes that join the texts are gaps whatever the table maps a line feed to.
    edges = np.cumsum([len(p) + 1 for p in parts])
    gap[edges[:-1] - 1] = True
    turn = np.flatnonzero(np.diff(np.concatenate(([True], gap, [True])).astype(np.int8)))
    starts, ends = turn[::2], turn[1::2]
    offsets = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw[~gap])])
    text = np.searchsorted(edges, starts, "right")
    line = np.searchsorted(np.flatnonzero(raw == BREAK), starts)
    first = (np.diff(line, prepend=-1) != 0) | (np.diff(text, prepend=-1) != 0)
    return words, text, first


def numbered(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(distinct words, number of each word among them)."""
    found = words.dictionary_encode()
    return found.dictionary, found.indices.to_numpy(zero_copy_only=False)
