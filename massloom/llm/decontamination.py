"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

A passage of m characters that occurs with at most e edits shares at least
m - q + 1 - q e of its q-grams with the text, all on e + 1 neighbouring
diagonals (place in the text less place in the passage). Diagonals are gathered
in overlapping bands; a band with enough shared q-grams is a region that may
hold the passage, and banded alignment decides.

An item is looked for as a whole, and, where it is longer than ``PASSAGE``, also
by passages of that length that overlap, so that a text which quotes a part of it
is found too. What is found of one item in one place is joined to a region. Items
shorter than a q-gram must occur letter by letter, as words of their own.

Texts are compared without regard to case, and a run of white space is a blank.
The benchmark is a stated query set: it goes to all tasks in blocks of bounded
size; the documents are read once, and every block meets every text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from massloom.llm.shared import each_value, whole_text

#: Characters in a q-gram; edits allowed for each character of a passage.
Q, EDIT_SHARE = 10, 0.08
#: Characters of the benchmark in one block, and of texts looked at together.
BLOCK_CHARS, TEXT_CHARS = 500_000, 2_000_000
#: Characters of a passage of a longer item, and from one passage to the next: a quote of both together holds one whole.
PASSAGE, STEP = 120, 60
#: Candidate regions aligned together, and cells of their tables.
ALIGNED, CELLS = 512, 1 << 21
_TABLE_BITS = 22
_MIX = np.uint64(0x9E3779B97F4A7C15)


def code_points(text: str) -> np.ndarray:
    """Code points, with lower case for ASCII and Latin-1 letters and blanks for white space."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").copy()
    upper = ((points >= 65) & (points <= 90)) | ((points >= 0xC0) & (points <= 0xDE) & (points != 0xD7))
    points[upper] += 32
    points[(points >= 9) & (points <= 13)] = 32
    return points


def normal(text: str) -> tuple[np.ndarray, np.ndarray | None]:
    """Code points with one blank for a run of white space, and their places in the text where these differ."""
    points = code_points(text)
    blank = points == 32
    again = np.zeros(len(points), bool)
    again[1:] = blank[1:] & blank[:-1]
    if not again.any():
        return points, None
    places = np.flatnonzero(~again)
    return points[places], places


def _grams(points: np.ndarray) -> np.ndarray:
    """The q-gram at each place as one number; far code points may coincide, alignment tells them apart."""
    count = len(points) - Q + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    folded = (points ^ (points >> np.uint32(8))).astype(np.uint8).tobytes()
    head = np.ndarray((count,), "<u8", folded, strides=(1,))
    tail = np.ndarray((count,), "<u8", folded, offset=Q - 8, strides=(1,))
    return head * _MIX ^ tail


def _slot(grams: np.ndarray) -> np.ndarray:
    return ((grams * _MIX) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)


def edit_budget(length: int) -> int:
    """A share of the length, less for short passages so that one q-gram at least must be shared."""
    return min(int(length * EDIT_SHARE), (length - Q) // Q)


@dataclass
class Block:
    """The q-grams of some passages: distinct ones in order, and where each occurs."""

    ids: np.ndarray
    items: list[np.ndarray]
    #: Which item a passage is of, and where it begins there; without, each is an item.
    own: np.ndarray | None = None
    begin: np.ndarray | None = None
    #: Items too short for q-grams: (item, id, code points).
    short: list[tuple[int, object, np.ndarray]] = field(default_factory=list)
    grams: np.ndarray = field(init=False)
    first: np.ndarray = field(init=False)
    item: np.ndarray = field(init=False)
    place: np.ndarray = field(init=False)
    seen: np.ndarray | None = field(init=False, default=None)

    def __post_init__(self) -> None:
        self.own = np.arange(len(self.items)) if self.own is None else self.own
        self.begin = np.zeros(len(self.items), int) if self.begin is None else self.begin
        grams = [_grams(p) for p in self.items]
        every = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, int)
        order = np.argsort(every, kind="stable")
        self.grams = np.unique(every)
        self.first = np.append(np.searchsorted(every[order], self.grams), len(every))
        self.item, self.place = item[order].astype(np.int32), place[order].astype(np.int32)
        self.length = np.array([len(p) for p in self.items], np.int64)
        self.edits = np.array([edit_budget(len(p)) for p in self.items], np.int64)
        self.least = self.length - Q + 1 - Q * self.edits

    def table(self) -> np.ndarray:
        """Bit per hash value; built in the worker, once per task."""
        if self.seen is None:
            self.seen = np.zeros(1 << _TABLE_BITS, bool)
            self.seen[_slot(self.grams)] = True
        return self.seen


def passages(points: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(begin, code points) of an item as a whole and of its overlapping parts, the last one up to its end."""
    parts = [(0, points)]
    if len(points) > PASSAGE:
        begins = [*range(0, len(points) - PASSAGE, STEP), len(points) - PASSAGE]
        parts += [(at, points[at : at + PASSAGE]) for at in begins]
    return parts


def blocks_of(benchmark: DataFrame) -> Iterator[Block]:
    """Passages of the items in blocks of at most ``BLOCK_CHARS`` characters (or one longer item).

    Items that are null or hold nothing but white space are left out.
    """
    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text is not null")
    held: list[tuple[int, object, int, np.ndarray]] = []
    short: list[tuple[int, object, np.ndarray]] = []
    size = 0

    def block() -> Block:
        own, ids, begin, points = zip(*held) if held else ((), (), (), ())
        return Block(np.array(ids, object), list(points), np.array(own, int), np.array(begin, int), list(short))

    for own, (item_id, text) in enumerate(rows.toLocalIterator()):
        points = normal(text)[0]
        points = points[int(points[:1].tolist() == [32]) : len(points) - int(points[-1:].tolist() == [32])]
        if not len(points):
            continue
        parts = [] if len(points) < Q else passages(points)
        more = sum(len(p) for _, p in parts) or len(points)
        if size and size + more > BLOCK_CHARS:
            yield block()
            held, short, size = [], [], 0
        size += more
        held += [(own, item_id, begin, part) for begin, part in parts]
        if not parts:
            short.append((own, item_id, points))
    if size:
        yield block()


def candidates(points: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """(passage, first diagonal) of every band that holds enough shared q-grams."""
    grams = _grams(points)
    at = np.flatnonzero(block.table()[_slot(grams)])
    found = np.searchsorted(block.grams, grams[at])
    found[found == len(block.grams)] = 0
    real = block.grams[found] == grams[at]
    at, found = at[real], found[real]
    counts = block.first[found + 1] - block.first[found]
    hit = np.repeat(np.arange(len(at)), counts)
    which = np.arange(len(hit)) - np.repeat(np.cumsum(counts) - counts, counts) + block.first[found][hit]
    item = block.item[which].astype(np.int64)
    # Diagonals are moved up by the longest passage, so that none is negative.
    up = int(block.length.max(initial=0))
    diagonal = at[hit] - block.place[which] + up
    width = block.edits[item] + 1
    band = diagonal // width
    span = len(points) + up + 2
    own = item * span + band
    shared = (diagonal - band * width < block.edits[item]) & (band > 0)
    keys, sizes = np.unique(np.concatenate([own, own[shared] - 1]), return_counts=True)
    item, band = keys // span, keys % span
    enough = sizes >= block.least[item]
    item, band = item[enough], band[enough]
    return item, band * (block.edits[item] + 1) - up


def align(points: np.ndarray, block: Block, item: np.ndarray, diagonal: np.ndarray) -> tuple[np.ndarray, ...]:
    """Edits, start and end of the best occurrence of each passage in its band of diagonals."""
    budgets, lengths = block.edits[item], block.length[item]
    cells = int(4 * budgets.max() + 1)
    lowest = diagonal - budgets
    inside = np.arange(cells)[None, :] < (4 * budgets + 1)[:, None]
    rows = int(lengths.max())
    padded = np.zeros((len(item), rows), np.uint32)
    for k, i in enumerate(item):
        padded[k, : lengths[k]] = block.items[i]
    # A cell holds edits in its high part and, so that ties go to the shortest region, the start below.
    one, never = np.int64(1) << 20, np.int64(1) << 40
    steps = np.arange(cells)[None, :] * one
    cost = np.where(inside, cells - np.arange(cells)[None, :], never)
    last = cost.copy()
    for row in range(rows):
        place = lowest[:, None] + np.arange(cells)[None, :] + row
        there = (place >= 0) & (place < len(points))
        text = np.where(there, points[np.clip(place, 0, len(points) - 1)], np.uint32(0xFFFFFFFF))
        kept = cost + np.where(text == padded[:, row : row + 1], 0, one)
        kept[~there] = never
        skipped = np.full_like(cost, never)
        skipped[:, :-1] = cost[:, 1:] + one
        now = np.minimum(kept, skipped)
        now = np.minimum.accumulate(now - steps, axis=1) + steps
        now = np.where(inside, np.minimum(now, never), never)
        cost = now
        done = lengths == row + 1
        last[done] = cost[done]
    best = last.argmin(axis=1)
    value = last[np.arange(len(item)), best]
    start = lowest + cells - (value & (one - 1))
    return value >> 20, np.maximum(start, 0), np.minimum(lowest + best + lengths, len(points))


def occurrences(points: np.ndarray, block: Block) -> Iterator[tuple[int, int, int, int]]:
    """(passage, start, end, edits) of every occurrence within its budget; of overlapping ones the best."""
    item, diagonal = candidates(points, block)
    # Candidates with equal budgets stand together; long passages are aligned few at a time.
    order = np.argsort(block.edits[item], kind="stable")
    item, diagonal = item[order], diagonal[order]
    parts, k = [], 0
    while k < len(item):
        widest = int(4 * block.edits[item[k : k + ALIGNED]].max() + 1)
        n = max(1, min(ALIGNED, CELLS // widest))
        parts.append((item[k : k + n], *align(points, block, item[k : k + n], diagonal[k : k + n])))
        k += n
    good = [
        (int(i), int(s), int(e), int(d))
        for items, edits, starts, ends in parts
        for i, d, s, e in zip(items, edits, starts, ends, strict=True)
        if d <= block.edits[i]
    ]
    held: tuple[int, int, int, int] | None = None
    for one in sorted(good):
        if held and held[0] == one[0] and one[1] < held[2]:
            held = min(held, one, key=lambda x: (x[3], x[1]))
        else:
            if held:
                yield held
            held = one
    if held:
        yield held


def _word(points: np.ndarray) -> np.ndarray:
    """Whether each code point is of a word: ASCII letters and digits, and all beyond ASCII."""
    return (points >= 128) | ((points >= 48) & (points <= 57)) | ((points >= 97) & (points <= 122)) | ((points >= 65) & (points <= 90))


def exactly(points: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places where ``wanted`` stands as words of its own."""
    room = len(points) - len(wanted) + 1
    if room <= 0:
        return np.zeros(0, np.int64)
    same = points[:room] == wanted[0]
    for k in range(1, len(wanted)):
        same &= points[k : room + k] == wanted[k]
    at = np.flatnonzero(same)
    wordy = np.concatenate(([False], _word(points), [False]))
    ends = at + len(wanted)
    return at[~(wordy[at] & wordy[at + 1]) & ~(wordy[ends] & wordy[ends + 1])]


def _pieces(texts: list[np.ndarray], reach: int) -> Iterator[list[tuple[int, int, np.ndarray]]]:
    """Texts to look at together, as (number, offset, piece); long ones in pieces that overlap by ``reach``."""
    held: list[tuple[int, int, np.ndarray]] = []
    size = 0
    step = max(TEXT_CHARS, 2 * reach)
    for number, text in enumerate(texts):
        for at in range(0, max(1, len(text) - reach), step):
            piece = text[at : at + step + reach]
            held.append((number, at, piece))
            size += len(piece)
            if size >= TEXT_CHARS:
                yield held
                held, size = [], 0
    if held:
        yield held


def _regions(hits: list[tuple[int, int, int, int, int, int]]) -> Iterator[tuple[int, int, int, int, int]]:
    """(start, end, edits, item start, item end) of hits of one item in one text that overlap.

    A hit is (start, end, edits, item start, item end, characters of the passage).
    The edits are those of the longest passage found, the fewest if there are several.
    """
    held: tuple[int, int, int, int, int] | None = None
    best = (0, 0)
    for start, end, edits, item_start, item_end, length in sorted(hits):
        if held and start < held[1]:
            best = max(best, (length, -edits))
            held = held[0], max(held[1], end), -best[1], min(held[3], item_start), max(held[4], item_end)
        else:
            if held:
                yield held
            held, best = (start, end, edits, item_start, item_end), (length, -edits)
    if held:
        yield held


def leaks(texts: list[str], block: Block) -> list[tuple[int, object, int, int, int, int, int]]:
    """(text number, item_id, start, end, edits, item start, item end), each region once."""
    longest = max([0, *block.length.tolist(), *(len(p) for _, _, p in block.short)])
    reach = int(2 * longest + 4 * block.edits.max(initial=0) + Q)
    plain = [normal(t) for t in texts]
    found: dict[tuple[int, int], set[tuple[int, int, int, int, int, int]]] = {}
    gap = np.zeros(Q, np.uint32)
    for group in _pieces([points for points, _ in plain], reach):
        starts = np.cumsum([0, *[len(p) + Q for _, _, p in group]])
        points = np.concatenate([x for _, _, p in group for x in (p, gap)])[:-Q]
        hits = [
            (int(block.own[i]), start, end, edits, int(block.begin[i]), int(block.begin[i] + block.length[i]))
            for i, start, end, edits in (occurrences(points, block) if block.items else ())
        ]
        for own, _, wanted in block.short:
            hits += [(own, int(at), int(at) + len(wanted), 0, 0, len(wanted)) for at in exactly(points, wanted)]
        for own, start, end, edits, item_start, item_end in hits:
            k = int(np.searchsorted(starts, start, side="right")) - 1
            number, offset, piece = group[k]
            at = start - int(starts[k])
            # An alignment may end in the gap behind a text, but holds none of it.
            until = min(end - int(starts[k]), len(piece))
            if at < len(piece):
                hit = (offset + at, offset + until, edits, item_start, item_end, item_end - item_start)
                found.setdefault((number, own), set()).add(hit)
    names = {int(own): item_id for own, item_id in zip(block.own, block.ids)} | {own: item_id for own, item_id, _ in block.short}
    out = []
    for (number, own), hits in found.items():
        places = plain[number][1]
        for start, end, edits, item_start, item_end in _regions(list(hits)):
            if places is not None:
                start, end = int(places[start]), int(places[end - 1]) + 1
            out.append(((number, start, end, own), (number, names[own], start, end, edits, item_start, item_end)))
    return [leak for _, leak in sorted(out, key=lambda x: x[0])]


def _sent(docs: DataFrame, benchmark: DataFrame) -> list[Broadcast]:
    return [docs.sparkSession.sparkContext.broadcast(block) for block in blocks_of(benchmark)]


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, start, end, edits, item_start, item_end: a row for each region of a text that quotes an item.

    ``start`` and ``end`` are code points of the text, the end exclusive, and the
    other two say which part of the item was found. A null text counts as empty
    and has no leak; texts without one give no row. Repeated rows of either table
    give repeated rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    types = {"doc_id": pa.int64(), "item_id": pa.int64(), "start": pa.int64(), "end": pa.int64(), "edits": pa.int32(), "item_start": pa.int64(), "item_end": pa.int64()}
    blocks = _sent(docs, benchmark)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, doc_ids = batch.column("text").to_pylist(), batch.column("doc_id").to_pylist()
            for block in each_value(blocks):
                got = leaks(texts, block)
                columns = [[doc_ids[g[0]] for g in got], *[[g[k] for g in got] for k in range(1, 7)]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types.values())], names=list(types))

    return rows.mapInArrow(run, "doc_id long, item_id long, start long, end long, edits int, item_start long, item_end long")


def drop_leaking(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no item is quoted, with all their columns; repeated rows stay or go together."""
    blocks = _sent(docs, benchmark)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = np.ones(batch.num_rows, bool)
            for block in each_value(blocks):
                # What one block has found, the next need not look at.
                left = np.flatnonzero(clean)
                texts = [t or "" for t in batch.column("text").take(pa.array(left)).to_pylist()]
                clean[left[[g[0] for g in leaks(texts, block)]]] = False
            yield batch.filter(pa.array(clean))

    return docs.mapInArrow(run, docs.schema)
