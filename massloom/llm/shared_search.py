"""Ranked search for many items at once, their common parts computed once for each document.

Sets of terms that several items share are mined from the items and become
nodes of a directed graph: a term is a leaf, a node adds two others, an item
adds the nodes it is left with. For a document the accumulator of each node is
computed once, from the leaves up, and every item that uses the node adds it.

Documents: null texts have no term; a repeated row is a document of its own, and
one without id can be found as any other (after those with an id where scores
are equal). Items: rows that are equal count once; a null text has no term and
finds nothing. Other columns are not looked at. Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from massloom.llm.shared import Scratch, whole_text
from massloom.llm.words import cut, numbered, slices
from massloom.operators.ordering import running_total

#: Characters of items that are searched together; a longer item makes a block of its own.
BLOCK_CHARS = 1_000_000
#: Symbols after a symbol, in order of how many items share them, that it is paired with while mining.
REACH = 8
#: Cells of accumulators that are held at a time.
CELLS = 1 << 21
#: Parts that the best documents of an item are ranked in before the last ranking.
PARTS = 64

#: ASCII other than letters and digits ends a term.
TO_TERMS = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))
FOUND = "item int, doc_id long, score long"


@dataclass(frozen=True)
class Plan:
    """A block of items as a graph: leaves are terms, then come the nodes, each the sum of two before it."""

    terms: list[bytes]
    leaf_of: list[int]  # of the first symbols, the term's number; the k-th repeat of a term is a symbol of its own
    nodes: list[tuple[int, int]]
    items: list[int]
    roots: list[list[int]]  # symbols that add up to the item


def item_terms(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().translate(TO_TERMS).split()


def plan(items: list[tuple[int, str | None]], reach: int = REACH) -> Plan:
    """Mines what the items share, round by round, until no two symbols stand together in two items.

    In each round every item lists its symbols by falling number of items, and
    pairs each with the next ``reach``; the pairs that most items share become
    nodes first and replace their symbols wherever both still are. Work and
    memory are linear in the terms of the block.
    """
    numbers: dict[tuple[bytes, int], int] = {}
    held: list[set[int]] = []
    for _, text in items:
        counts = Counter(item_terms(text))
        held.append({numbers.setdefault((term, k), len(numbers)) for term, n in counts.items() for k in range(n)})
    terms = {term: k for k, term in enumerate(dict.fromkeys(term for term, _ in numbers))}
    leaf_of = [terms[term] for term, _ in numbers]
    nodes: list[tuple[int, int]] = []
    while True:
        shares = Counter(s for own in held for s in own)
        having: dict[tuple[int, int], list[int]] = {}
        for at, own in enumerate(held):
            row = sorted((s for s in own if shares[s] > 1), key=lambda s: (-shares[s], s))
            for k, left in enumerate(row):
                for right in row[k + 1 : k + 1 + reach]:
                    having.setdefault((left, right), []).append(at)
        made = False
        for (left, right), places in sorted(having.items(), key=lambda pair: (-len(pair[1]), pair[0])):
            if len(places) < 2:
                break
            places = [at for at in places if left in held[at] and right in held[at]]
            if len(places) < 2:
                continue
            made, node = True, len(leaf_of) + len(nodes)
            nodes.append((left, right))
            for at in places:
                held[at] -= {left, right}
                held[at].add(node)
        if not made:
            return Plan(list(terms), leaf_of, nodes, [number for number, _ in items], [sorted(own) for own in held])


def accumulate(graph: Plan, leaves: list[np.ndarray | None]) -> Iterator[tuple[int, np.ndarray]]:
    """(item's place, its scores) from the partial scores of its terms; None is nothing anywhere."""

    def add(a: np.ndarray | None, b: np.ndarray | None) -> np.ndarray | None:
        return b if a is None else a if b is None else a + b

    value = [leaves[term] for term in graph.leaf_of]
    for left, right in graph.nodes:
        value.append(add(value[left], value[right]))
    for place, root in enumerate(graph.roots):
        parts = [value[s] for s in root if value[s] is not None]
        if parts:
            total = parts[0].copy()
            for part in parts[1:]:
                total += part
            yield place, total


def _postings(docs: DataFrame, plans: list[Broadcast]) -> DataFrame:
    """(block, doc_id, n, terms, tf) of every document with a term: its length and the blocks' terms in it.

    The documents are read and cut once, whatever the number of blocks; the
    vocabularies are looked at one after another.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for texts in slices(batch["text"]):
                ids = batch["doc_id"].slice(done, len(texts))
                done += len(texts)
                words, text, _ = cut(texts, TO_TERMS)
                length = np.bincount(text, minlength=len(texts))
                known, at = numbered(words)
                some = np.flatnonzero(length)
                for block, graph in enumerate(plans):
                    own = graph.value.terms
                    place = pc.index_in(known, value_set=pa.array(own, pa.binary())).fill_null(-1).to_numpy(zero_copy_only=False)
                    term = place[at].astype(np.int64)
                    hit = term >= 0
                    keys, tf = np.unique(text[hit] * len(own) + term[hit], return_counts=True)
                    ends = np.searchsorted(keys, (some + 1) * len(own))
                    offsets = pa.array(np.concatenate(([0], ends)).astype(np.int32))
                    lists = [pa.ListArray.from_arrays(offsets, pa.array(v.astype(np.int32))) for v in (keys % max(len(own), 1), tf)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(some), block, np.int32)), ids.take(pa.array(some)), pa.array(length[some].astype(np.int64)), *lists],
                        ["block", "doc_id", "n", "terms", "tf"],
                    )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return texts.mapInArrow(run, "block int, doc_id long, n long, terms array<int>, tf array<int>")


class _Best:
    """Each item's best documents so far."""

    def __init__(self, items: int, top: int) -> None:
        self.top = top
        self.least = np.zeros(items, np.int64)  # a score must reach this, and be above 0
        self.rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))] * items

    def take(self, item: int, scores: np.ndarray, lost: np.ndarray, ids: np.ndarray) -> None:
        new = np.flatnonzero((scores >= self.least[item]) & (scores > 0))
        if not len(new):
            return
        score, none, doc = (np.concatenate(x) for x in zip(self.rows[item], (scores[new], lost[new], ids[new])))
        first = np.lexsort((doc, none, -score))[: self.top]
        self.rows[item] = score[first], none[first], doc[first]
        if len(first) == self.top:
            self.least[item] = score[first[-1]]


def _search(postings: DataFrame, graph: Broadcast, weights: Broadcast, documents: int, length: int, top: int) -> DataFrame:
    """(item, doc_id, score): the best documents of each partition for each item of the block."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, weight = graph.value, weights.value
        best = _Best(len(own.items), top)
        width = max(16, CELLS // (len(own.leaf_of) + len(own.nodes) + 1))
        for whole in batches:
            for start in range(0, whole.num_rows, width):
                batch = whole.slice(start, width)
                n = batch["n"].to_numpy(zero_copy_only=False)
                ids = batch["doc_id"]
                lost = ids.is_null().to_numpy(zero_copy_only=False)
                ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
                term = pc.list_flatten(batch["terms"]).to_numpy(zero_copy_only=False)
                tf = pc.list_flatten(batch["tf"]).to_numpy(zero_copy_only=False).astype(np.int64)
                doc = np.repeat(np.arange(len(n)), pc.list_value_length(batch["terms"]).to_numpy(zero_copy_only=False))
                m = 100 - 25 + (25 * n * documents) // length
                partial = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc]))
                present, row = np.unique(term, return_inverse=True)
                cells = np.zeros((len(present), len(n)), np.int64)
                cells[row, doc] = partial
                leaves: list[np.ndarray | None] = [None] * len(own.terms)
                for k, t in enumerate(present):
                    leaves[t] = cells[k]
                for place, scores in accumulate(own, leaves):
                    best.take(place, scores, lost, ids)
        for place, (score, none, doc) in enumerate(best.rows):
            if len(score):
                number = pa.array(np.full(len(score), own.items[place], np.int32))
                yield pa.RecordBatch.from_arrays([number, pa.array(doc, mask=none), pa.array(score)], ["item", "doc_id", "score"])

    return postings.select("doc_id", "n", "terms", "tf").mapInArrow(run, FOUND)


def search(docs: DataFrame, items: DataFrame, top: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score): for each item (item_id, text) its ``top`` documents (doc_id, text).

    The score is a whole-number form of BM25 over the item's terms, repeats
    included; only documents above 0 are ranked, equal scores by doc_id.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    asked = items.select("item_id", F.col("text").cast("string").alias("text")).distinct()
    placed = running_total(asked, [], [F.col("item_id"), F.col("text")], F.coalesce(F.length("text"), F.lit(0)), "before")
    order = Window.partitionBy("block").orderBy("item_id", "text")
    asked = scratch.write(
        placed.withColumn("block", F.floor(F.col("before") / BLOCK_CHARS).cast("int"))
        .withColumn("item", F.row_number().over(order))
        .drop("before"),
        "items",
    )
    blocks = [r.block for r in asked.select("block").distinct().orderBy("block").collect()]
    plans = []
    for block in blocks:
        rows = asked.where(F.col("block") == block).orderBy("item").collect()
        plans.append(spark.sparkContext.broadcast(plan([(r["item"], r["text"]) for r in rows])))
    postings = scratch.write(_postings(docs, plans), "postings") if plans else None

    tops = None
    if plans:
        documents, length = postings.where(F.col("block") == 0).agg(F.count("*"), F.sum("n")).first()
        stood = postings.select("block", F.explode("terms").alias("term"))
        counts = scratch.write(stood.groupBy("block", "term").agg(F.count("*").alias("df")), "frequencies")
        for number, graph in enumerate(plans if documents else []):
            df = {r["term"]: r["df"] for r in counts.where(F.col("block") == number).collect()}
            every = [math.floor(1000 * math.log((2 * documents + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(graph.value.terms))]
            weights = spark.sparkContext.broadcast(np.array(every, np.int64))
            found = _search(postings.where(F.col("block") == number), graph, weights, documents, length, top)
            found = scratch.write(found.withColumn("block", F.lit(blocks[number])), "found")
            tops = found if tops is None else tops.unionByName(found)
        scratch.drop(counts)
        scratch.drop(postings)
    if tops is None:
        tops = spark.createDataFrame([], FOUND + ", block int")
    key = ["block", "item"]
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    # Every task brings its best of an item; parts keep them from meeting in one task at once.
    ranked = (
        tops.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)))
        .withColumn("rank", F.row_number().over(Window.partitionBy(*key, "part").orderBy(*order)))
        .where(F.col("rank") <= top)
        .withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
        .where(F.col("rank") <= top)
    )
    return ranked.join(asked, key).select("item_id", "rank", "doc_id", "score")
