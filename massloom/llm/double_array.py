"""Double-array tries over whole numbers, built and walked by numpy.

A state is a place in two arrays: the child of state ``s`` by symbol ``c`` is at
``base[s] + c`` if ``check`` says ``s`` there. Sequences of one trie all have the
same length, so what is reached after the last level is accepting.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Places that are looked at together for a state's children.
TRIED = 64


@dataclass(frozen=True)
class Trie:
    symbols: np.ndarray  # sorted; a symbol's number is its place
    base: np.ndarray
    check: np.ndarray  # -1: free
    words: np.ndarray  # (sequences, length), as given
    accepts: np.ndarray  # the state that each sequence ends in


def _place(taken: np.ndarray, numbers: np.ndarray, draw: np.random.Generator, width: int) -> tuple[np.ndarray, int]:
    """(``taken``, perhaps grown; a base whose places for ``numbers`` are free)."""
    while True:
        room = len(taken) - width
        bases = draw.integers(1, room, TRIED)
        fits = ~taken[bases[:, None] + numbers].any(axis=1)
        if fits.any():
            return taken, int(bases[np.argmax(fits)])
        taken = np.concatenate((taken, np.zeros(len(taken) // 4 + width, bool)))


def build(words: np.ndarray) -> Trie:
    """The trie of distinct sequences, the rows of ``words``.

    States with many children are placed first, those with one child together
    at the end, each in the next free place.
    """
    count, length = words.shape
    words = words[np.lexsort(words.T[::-1])]
    symbols = np.unique(words)
    width = len(symbols)
    numbers = np.searchsorted(symbols, words)
    draw = np.random.default_rng(count)
    taken = np.zeros(3 * count * length + 2 * width + 64, bool)
    taken[0] = True
    edges: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    bases: list[tuple[np.ndarray, np.ndarray]] = []
    state = np.zeros(count, np.int64)  # that the sequence has reached
    for level in range(length):
        # A new child starts where the sequence differs from the one before in this level or above.
        new = np.ones(count, bool)
        new[1:] = (words[1:, : level + 1] != words[:-1, : level + 1]).any(axis=1)
        child = np.cumsum(new) - 1
        number, parent = numbers[new, level], state[new]
        family = np.ones(len(parent), bool)
        family[1:] = parent[1:] != parent[:-1]
        begin = np.flatnonzero(family)
        sizes = np.diff(np.append(begin, len(parent)))
        base = np.zeros(len(begin), np.int64)
        for k in np.argsort(-sizes, kind="stable")[: int((sizes > 1).sum())]:
            own = number[begin[k] : begin[k] + sizes[k]]
            taken, base[k] = _place(taken, own, draw, width)
            taken[base[k] + own] = True
        single = np.flatnonzero(sizes == 1)
        free = np.flatnonzero(~taken[width + 1 :])[: len(single)] + width + 1
        if len(free) < len(single):
            free = np.concatenate((free, len(taken) + np.arange(len(single) - len(free))))
            taken = np.concatenate((taken, np.zeros(len(single) + width, bool)))
        base[single] = free - number[begin[single]]
        taken[free] = True
        place = np.repeat(base, sizes) + number
        edges.append((place, parent, number))
        bases.append((parent[begin], base))
        state = place[child]
    room = len(taken) + width
    check, out = np.full(room, -1, np.int32), np.zeros(room, np.int32)
    for place, parent, _ in edges:
        check[place] = parent
    for parent, base in bases:
        out[parent] = base
    return Trie(symbols, out, check, words, state)


def walk(trie: Trie, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(places, states): where the sequences that ``columns`` spell are in the trie, and the states they end in.

    All places advance together, one level at a time; those without a child drop out.
    """
    at = np.arange(len(columns[0]))
    state = np.zeros(len(at), np.int64)
    last = len(trie.symbols) - 1
    for column in columns:
        symbol = column[at]
        number = np.minimum(np.searchsorted(trie.symbols, symbol), last)
        after = trie.base[state] + number
        lives = (trie.symbols[number] == symbol) & (trie.check[after] == state)
        at, state = at[lives], after[lives].astype(np.int64)
    return at, state
