"""Links between bit fingerprints that differ in few bits, by a Gray-order hierarchical index.

Fingerprints that agree in the bits of a mask share an upper node: the masked
pattern is stored once, as the node's key. The masks decide what is found. For
a small number of differing bits, ``block_masks`` makes a set of masks of which
at least one must agree; for a large one, ``random_masks`` finds each link with
a known probability.

Below an upper node the fingerprints are sorted by Gray rank, which brings
those with a common prefix together, and the prefixes of 8, 16, ... bits form
the levels of a tree. Two nodes are compared by the differing bits that their
own patterns add to those of their parents; a pair above the bound goes, with
all that lies below it. So does a pair whose fingerprints are known to be
connected already: a group of near copies costs little more than a spanning
tree, and never gives out all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fingerprints that one task compares with each other at most, unless told otherwise.
NODE_LIMIT = 50_000
#: Rows taken up at once, and pairs held at once.
ROWS_AT_ONCE, PAIRS_AT_ONCE = 50_000, 500_000
LEVEL_BITS = 8


def block_masks(bits: int, differing: int, agreeing: int) -> list[np.ndarray]:
    """Masks of ``agreeing`` out of ``differing + agreeing`` equal blocks.

    ``differing`` bits touch that many blocks at most, so the others agree and
    one of the masks holds just ``agreeing`` of them.
    """
    blocks = np.array_split(np.arange(bits), differing + agreeing)
    return [np.concatenate(chosen) for chosen in combinations(blocks, agreeing)]


def random_masks(bits: int, size: int, count: int, seed: int = 7) -> list[np.ndarray]:
    """``count`` masks of ``size`` bits; a pair differing in a share d of its bits agrees in one with (1 - d) ** size."""
    draw = np.random.default_rng(seed)
    return [np.sort(draw.choice(bits, size, replace=False)) for _ in range(count)]


def _codes(column: pa.Array) -> np.ndarray:
    """Big-endian words, one row per fingerprint."""
    rows = b"".join(column.to_pylist())
    return np.frombuffer(rows, ">u8").astype(np.uint64).reshape(len(column), -1)


def _entries(masks: list[np.ndarray]):
    """Arrow batches of (code, rep) to (node, code, rep), a row for each mask."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            raw = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(len(batch), -1)
            bits = np.unpackbits(raw, axis=1)
            for number, mask in enumerate(masks):
                packed = np.zeros((len(batch), 4), np.uint8)
                key = np.packbits(bits[:, mask], axis=1)
                packed[:, : key.shape[1]] = key
                node = (np.int64(number) << 32) | packed.view("<u4").ravel().astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node), batch.column("code"), batch.column("rep")], names=["node", "code", "rep"]
                )

    return run


def gray_rank(words: np.ndarray) -> np.ndarray:
    """Place of each 64-bit word in the Gray sequence."""
    ranks = words.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        ranks ^= ranks >> np.uint64(shift)
    return ranks


class _Labels:
    """Connected sets of rows: each row's label is a row of its set."""

    def __init__(self, rows: int) -> None:
        self.of = np.arange(rows)

    def unite(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            one, two = self.of[a], self.of[b]
            apart = one != two
            a, b, one, two = a[apart], b[apart], one[apart], two[apart]
            np.minimum.at(self.of, np.maximum(one, two), np.minimum(one, two))
            while not np.array_equal(nearer := self.of[self.of], self.of):
                self.of = nearer


def connect(group: np.ndarray, codes: np.ndarray, bound: int) -> np.ndarray:
    """Label of each row: rows of one group within ``bound`` bits are connected.

    ``group`` must be sorted and the codes in Gray order inside a group.
    """
    rows, words = codes.shape
    labels = _Labels(rows)
    starts: list[np.ndarray] = []
    patterns: list[np.ndarray] = []
    fresh = np.ones(rows, bool)
    fresh[1:] = group[1:] != group[:-1]
    starts.append(np.flatnonzero(fresh))
    patterns.append(np.zeros(len(starts[0]), np.uint8))
    for level in range(words * 64 // LEVEL_BITS):
        if len(starts[-1]) == rows:
            break
        word, shift = level * LEVEL_BITS // 64, 64 - LEVEL_BITS - level * LEVEL_BITS % 64
        part = ((codes[:, word] >> np.uint64(shift)) & np.uint64(255)).astype(np.uint8)
        fresh[1:] |= part[1:] != part[:-1]
        starts.append(np.flatnonzero(fresh))
        patterns.append(part[starts[-1]])
    ends = [np.append(s[1:], rows) for s in starts]
    #: Of each node, the numbers of its first and last child.
    child = [
        (np.searchsorted(starts[k + 1], starts[k]), np.searchsorted(starts[k + 1], ends[k]))
        for k in range(len(starts) - 1)
    ]
    whole = np.flatnonzero(ends[0] - starts[0] > 1)
    stack = [(0, whole, whole, np.zeros(len(whole), np.int64))]
    while stack:
        level, a, b, differ = stack.pop()
        lone = (ends[level][a] - starts[level][a] == 1) & (ends[level][b] - starts[level][b] == 1)
        if lone.any():
            one, two = starts[level][a[lone]], starts[level][b[lone]]
            near = np.bitwise_count(codes[one] ^ codes[two]).sum(axis=1, dtype=np.int64) <= bound
            labels.unite(one[near], two[near])
            a, b, differ = a[~lone], b[~lone], differ[~lone]
        if not len(a):
            continue
        if level == len(child):  # equal codes are one row, so this level has single rows only
            continue
        least = np.minimum.reduceat(labels.of, starts[level])
        most = np.maximum.reduceat(labels.of, starts[level])
        open_ = (least[a] != most[b]) | (least[b] != most[a])
        a, b, differ = a[open_], b[open_], differ[open_]
        first, last = child[level]
        counts = (last[a] - first[a]) * (last[b] - first[b])
        if counts.sum() > PAIRS_AT_ONCE and len(a) > 1:
            half = len(a) // 2
            stack.append((level, a[half:], b[half:], differ[half:]))
            stack.append((level, a[:half], b[:half], differ[:half]))
            continue
        pair = np.repeat(np.arange(len(a)), counts)
        turn = np.arange(len(pair)) - np.repeat(np.cumsum(counts) - counts, counts)
        wide = (last[b] - first[b])[pair]
        below_a, below_b = first[a][pair] + turn // np.maximum(wide, 1), first[b][pair] + turn % np.maximum(wide, 1)
        total = differ[pair] + np.bitwise_count(patterns[level + 1][below_a] ^ patterns[level + 1][below_b])
        near = (total <= bound) & ((a[pair] != b[pair]) | (below_a <= below_b))
        near &= (below_a != below_b) | (ends[level + 1][below_a] - starts[level + 1][below_a] > 1)
        if near.any():
            stack.append((level + 1, below_a[near], below_b[near], total[near]))
    return labels.of


def _linked(bound: int):
    """Sorted Arrow batches of (node, part, code, rep) to the links of a spanning forest of each node."""

    def links(tables: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(tables)
        node, part, rep = (table.column(c).to_numpy() for c in ("node", "part", "rep"))
        codes = np.concatenate([_codes(t.column("code")) for t in tables])
        ranks = [gray_rank(codes[:, w]) for w in reversed(range(codes.shape[1]))]
        order = np.lexsort([*ranks, part, node])
        node, part, rep, codes = node[order], part[order], rep[order], codes[order]
        border = np.concatenate([[0], ((node[1:] != node[:-1]) | (part[1:] != part[:-1])).cumsum()]).astype(np.int64)
        label = connect(border, codes, bound)
        moved = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays([pa.array(rep[moved]), pa.array(rep[label[moved]])], names=["a", "b"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = 0
        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            count += len(batch)
            if count < ROWS_AT_ONCE:
                continue
            # The last group may go on in the next batch: it waits.
            node, part = (np.concatenate([h.column(c).to_numpy() for h in held]) for c in ("node", "part"))
            last = int(np.flatnonzero((node != node[-1]) | (part != part[-1]))[-1:].sum() + 1) if (
                node[0] != node[-1] or part[0] != part[-1]
            ) else 0
            if last == 0:
                continue
            whole = pa.Table.from_batches(held)
            yield links(whole.slice(0, last).to_batches())
            held = whole.slice(last).to_batches()
            count -= last
        if held:
            yield links(held)

    return run


def linked(reps: DataFrame, masks: list[np.ndarray], bound: int, node_limit: int = NODE_LIMIT) -> DataFrame:
    """Links (a, b) that connect fingerprints within ``bound`` bits below any of the masks.

    ``reps`` has distinct ``code`` (binary of 8 bytes or a multiple) and a long
    ``rep`` that names it. A node with more than ``node_limit`` fingerprints is
    dealt into parts by hash; every two parts meet in a task of their own, so
    no task holds more than twice the limit and no pair is lost.
    """
    entries = reps.select("code", "rep").mapInArrow(_entries(masks), "node long, code binary, rep long")
    hot = (
        entries.groupBy("node")
        .count()
        .where(F.col("count") > node_limit)
        .select("node", F.ceil(F.col("count") / node_limit).cast("int").alias("parts"))
    )
    own = F.pmod(F.xxhash64("code"), F.col("parts")).cast("int")
    meets = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.least(own, j) * F.col("parts") + F.greatest(own, j)
    )
    dealt = entries.join(hot, "node", "left").select(
        "node", F.explode(F.when(F.col("parts").isNull(), F.array(F.lit(0))).otherwise(meets)).alias("part"), "code", "rep"
    )
    together = dealt.repartition("node", "part").sortWithinPartitions("node", "part")
    return together.mapInArrow(_linked(bound), "a long, b long").distinct()
