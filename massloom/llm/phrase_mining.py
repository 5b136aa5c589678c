"""Phrases whose words stand together more often than apart, mined level by level.

Candidates are safe in the sense of Apriori: a phrase is one only if all its
parts are frequent, and if the bucket that its hash falls in is full enough for
it (a bucket's count bounds each of its phrases). They go to double-array tries
of a bounded size, which are broadcast some at a time. In each task numpy moves
the states of all text positions one word further, level by level, and counts
the accepting states; the counts of all tasks are summed.

Null texts count as empty, a null language as ``und``. Repeated rows count as
often as they stand there; other columns are not looked at. An empty table has
no phrases.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from massloom.llm import double_array
from massloom.llm.shared import Scratch, each_value, whole_text
from massloom.llm.words import cut, numbered, slices
from massloom.operators.ordering import number_rows

#: Occurrences a phrase needs.
LEAST = 10
LONGEST = 3
#: A phrase is dropped where a longer one around it has this share of its occurrences, in hundredths.
COVERED = 50
#: Words of the vocabulary that one broadcast holds.
WORDS_A_BLOCK = 100_000
#: Phrases in one trie on average, and tries broadcast for one pass over the texts: about 100 MB, of which a task holds one at a time.
PHRASES_A_TRIE, TRIES_A_PASS = 50_000, 32
#: Positions whose states move together.
POSITIONS = 1 << 20
#: Occurrences of candidates that are summed in one task on average.
SUMMED = 500_000
#: Phrases whose counts stand in one row, and groups that such rows are summed in first.
BLOCK, SALTS = 512, 32
#: Rows that go back to Spark at a time.
ROWS = 1 << 17
#: Counts of words that a task holds before it sums them and passes them on.
HELD = 1 << 18
#: Parts that a language's phrases are ranked in before the last ranking.
PARTS = 64

#: Ends of pieces become line feeds, a tab a blank.
TO_PIECES = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", b"\n" * 10 + b" ")
KEY = ["w1", "w2", "w3"]
COUNTS = "w1 int, w2 int, w3 int, n long"


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.Array]]:
    for lang in pc.unique(batch["lang"]).to_pylist():
        for texts in slices(batch["text"].filter(pc.equal(batch["lang"], lang))):
            yield lang, texts


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), whole_text().alias("text"))


def _count_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []

    def summed() -> list[pa.RecordBatch]:
        table = pa.Table.from_batches(held).group_by(["lang", "word"]).aggregate([("n", "sum")])
        held.clear()
        return table.select(["lang", "word", "n_sum"]).rename_columns(["lang", "word", "n"]).to_batches()

    for batch in batches:
        for lang, texts in _by_language(batch):
            known, at = numbered(cut(texts, TO_PIECES)[0])
            n = pa.array(np.bincount(at, minlength=len(known)), pa.int64())
            langs = pa.repeat(pa.scalar(lang, pa.string()), len(known))
            held.append(pa.RecordBatch.from_arrays([langs, known.cast(pa.string()), n], ["lang", "word", "n"]))
            if sum(map(len, held)) >= HELD:
                yield from summed()
    if held:
        yield from summed()


def count_words(docs: DataFrame) -> DataFrame:
    """(lang, word, n) of every word."""
    return _texts(docs).mapInArrow(_count_words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _blocks(words: DataFrame) -> list[Broadcast]:
    """The vocabulary (lang, word, id) in broadcasts of at most ``WORDS_A_BLOCK`` words."""
    context, blocks = words.sparkSession.sparkContext, []
    total = words.agg(F.max("id")).first()[0] or 0
    for start in range(0, total, WORDS_A_BLOCK):
        block = words.where((F.col("id") > start) & (F.col("id") <= start + WORDS_A_BLOCK)).select("lang", "word", "id").toArrow()
        by_lang = {}
        for lang in pc.unique(block["lang"]).to_pylist():
            own = block.filter(pc.equal(block["lang"], lang))
            by_lang[lang] = (own["word"].combine_chunks().cast(pa.binary()), own["id"].to_numpy().astype(np.int32))
        blocks.append(context.broadcast(by_lang))
    return blocks


def _encode(texts: pa.Array, lang: str, blocks: list[Broadcast]) -> np.ndarray:
    """Ids of the words; -1 stands for one or more that are not frequent, and for an end of a piece."""
    words, _, first = cut(texts, TO_PIECES)
    known, at = numbered(words)
    ids = np.full(len(known), -1, np.int32)
    for block in each_value(blocks):
        if lang in block:
            vocabulary, numbers = block[lang]
            place = pc.index_in(known, value_set=vocabulary)
            hit = place.is_valid().to_numpy(zero_copy_only=False)
            ids[hit] = numbers[place.drop_null().to_numpy(zero_copy_only=False)]
    row = np.insert(ids[at], np.flatnonzero(first), -1)
    return row[(row >= 0) | (np.concatenate(([0], row[:-1])) >= 0)]


def encode(docs: DataFrame, blocks: list[Broadcast]) -> DataFrame:
    """(ids): the texts of a slice as ids of frequent words, four bytes each; -1 breaks phrases."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, texts in _by_language(batch):
                yield pa.RecordBatch.from_arrays([pa.array([_encode(texts, lang, blocks).tobytes()], pa.binary())], ["ids"])

    return _texts(docs).mapInArrow(run, "ids binary")


def _positions(batches: Iterable[pa.RecordBatch], length: int) -> Iterator[list[np.ndarray]]:
    """Columns of words 1 to ``length`` at every position that starts as many frequent words in a row."""

    def columns(parts: list[np.ndarray]) -> list[np.ndarray]:
        ids = np.concatenate([*parts, np.full(length, -1, np.int32)])
        runs = [ids[k : len(ids) - length + k] for k in range(length)]
        whole = np.logical_and.reduce([run >= 0 for run in runs])
        return [run[whole] for run in runs]

    parts, held = [], 0
    for batch in batches:
        for row in batch["ids"]:
            parts += [np.frombuffer(row.as_py(), np.int32), np.full(1, -1, np.int32)]
            held += len(parts[-2])
            if held >= POSITIONS:
                yield columns(parts)
                parts, held = [], 0
    if parts:
        yield columns(parts)


def _rows(columns: list[np.ndarray], n: np.ndarray) -> Iterator[pa.RecordBatch]:
    columns = [*columns, *[np.full(len(n), -1, np.int32)] * (LONGEST - len(columns))]
    for at in range(0, len(n), ROWS):
        part = [pa.array(c[at : at + ROWS], pa.int32()) for c in columns]
        yield pa.RecordBatch.from_arrays([*part, pa.array(n[at : at + ROWS], pa.int64())], [*KEY, "n"])


FOUND = "part int, keys binary, n binary"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _dealt(keys: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    """Distinct keys with their numbers, dealt by hash: a row holds those of one part.

    Keys stand as differences, byte by byte, which packs well; numbers stop at
    255, far above what a candidate needs.
    """
    keys, n = np.unique(keys, return_counts=True)
    part = ((keys.astype(np.uint64) * _MIX) >> np.uint64(33)).astype(np.int64) % parts
    order = np.argsort(part, kind="stable")
    keys, n, part = keys[order], np.minimum(n[order], 255).astype(np.uint8), part[order]
    begins = np.flatnonzero(np.diff(part, prepend=-1))
    rows = [(slice(a, b), part[a]) for a, b in zip(begins.tolist(), [*begins[1:].tolist(), len(keys)])]
    packed = [np.ascontiguousarray(np.diff(keys[where], prepend=0).view(np.uint8).reshape(-1, 8).T).tobytes() for where, _ in rows]
    yield pa.RecordBatch.from_arrays(
        [pa.array([p for _, p in rows], pa.int32()), pa.array(packed, pa.binary()), pa.array([n[w].tobytes() for w, _ in rows], pa.binary())],
        ["part", "keys", "n"],
    )


def _full(rows: pd.DataFrame, least: int) -> pd.DataFrame:
    """The keys of a part whose bucket holds ``least`` occurrences in all; there are four buckets for each row's key."""
    unpacked = [np.cumsum(np.frombuffer(k, np.uint8).reshape(8, -1).T.copy().view(np.int64).ravel()) for k in rows["keys"]]
    keys, n = np.concatenate(unpacked), np.concatenate([np.frombuffer(x, np.uint8) for x in rows["n"]])
    buckets = 4 * len(keys) + 1
    bucket = ((keys.astype(np.uint64) ^ (keys.astype(np.uint64) >> np.uint64(29))) * _MIX >> np.uint64(20)).astype(np.int64) % buckets
    sums = np.bincount(bucket, n, buckets)
    kept = np.unique(keys[sums[bucket] >= least])
    return pd.DataFrame({"a": kept >> 32, "b": (kept & 0xFFFFFFFF).astype(np.int32)})


def candidates(found: DataFrame, least: int = LEAST) -> DataFrame:
    """(a, b): the keys whose bucket holds ``least`` occurrences in all; no other can be frequent."""
    return found.groupBy("part").applyInPandas(partial(_full, least=least), "a long, b int")


def _pairs(batches: Iterable[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Pairs of frequent words beside each other, as keys of two word numbers."""
    for first, second in _positions(batches, 2):
        yield from _dealt(first.astype(np.int64) << 32 | second, parts)


def _trie_of(first, second, tries: int):
    """The trie that holds the phrases that start with two words; the same for columns and for arrays."""
    return (first * 1_000_003 + second * 7_919) % tries


class Held(NamedTuple):
    """A trie as it is broadcast: its number, the number of tries, and the numbers of its phrases, if they have some."""

    number: int
    tries: int
    trie: double_array.Trie
    names: np.ndarray


def _build_tries(phrases: DataFrame) -> dict[int, Broadcast]:
    """The phrases (w1, w2, w3, name) in tries, built on the executors, each broadcast by itself, by number."""
    tries = max(1, -(-phrases.count() // PHRASES_A_TRIE))
    parts = ("symbols", "base", "check", "words", "accepts")

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        length = 2 if rows["w3"].iloc[0] < 0 else 3
        rows = rows.sort_values(KEY[:length])  # the order that the trie has its sequences in
        trie = double_array.build(rows[KEY[:length]].to_numpy(np.int32))
        arrays = {k: [getattr(trie, k).astype(np.int32).tobytes()] for k in parts}
        names = [rows["name"].to_numpy(np.int64).tobytes()]
        return pd.DataFrame({"trie": [int(rows["trie"].iloc[0])], "length": [length], **arrays, "names": names})

    dealt = phrases.select(*KEY, "name", _trie_of(F.col("w1").cast("long"), F.col("w2").cast("long"), tries).cast("int").alias("trie"))
    schema = "trie int, length int, " + ", ".join(f"{k} binary" for k in (*parts, "names"))
    built, numbers = [], []
    for row in dealt.groupBy("trie").applyInPandas(build, schema).toLocalIterator():
        arrays = {k: np.frombuffer(row[k], np.int32) for k in parts}
        arrays["words"] = arrays["words"].reshape(-1, row["length"])
        held = Held(row["trie"], tries, double_array.Trie(**arrays), np.frombuffer(row["names"], np.int64))
        built.append(phrases.sparkSession.sparkContext.broadcast(held))
        numbers.append(row["trie"])
    return dict(zip(numbers, built))


def _passes(ids: DataFrame, tries: dict[int, Broadcast], task, schema: str) -> DataFrame:
    """What ``task`` makes of the texts, a few tries at a time."""
    out = ids.sparkSession.createDataFrame([], schema)
    for start in range(0, len(tries), TRIES_A_PASS):
        some = list(tries.values())[start : start + TRIES_A_PASS]
        out = out.unionByName(ids.mapInArrow(lambda batches, some=some: task(batches, some), schema))
    return out


def _visits(columns: list[np.ndarray], tries: list[Broadcast]) -> Iterator[tuple[Held, np.ndarray, np.ndarray]]:
    """(trie, positions in it, their accepting states); a position goes to the one trie that may hold its phrase."""
    if not len(columns[0]):
        return
    of = None
    for held in each_value(tries):
        if of is None:
            of = _trie_of(columns[0].astype(np.int64), columns[1].astype(np.int64), held.tries)
        here = np.flatnonzero(of == held.number)
        at, states = double_array.walk(held.trie, [c[here] for c in columns[: held.trie.words.shape[1]]])
        yield held, here[at], states


SUMS = "trie int, block int, salt int, n binary"


def _count(batches: Iterable[pa.RecordBatch], tries: list[Broadcast], length: int) -> Iterator[pa.RecordBatch]:
    """Occurrences of the phrases of the tries in this task's texts: accepting states are counted by ``bincount``.

    Counts go on as blocks of ``BLOCK`` phrases, so that a task gives few rows.
    """
    sums: dict[int, np.ndarray] = {}
    for columns in _positions(batches, length):
        for held, _, states in _visits(columns, tries):
            n = np.bincount(states, minlength=len(held.trie.check))[held.trie.accepts]
            sums[held.number] = sums[held.number] + n if held.number in sums else n
    rows = [
        (number, at // BLOCK, n[at : at + BLOCK].tobytes()) for number, n in sums.items() for at in range(0, len(n), BLOCK) if n[at : at + BLOCK].any()
    ]
    if rows:
        trie, block, n = zip(*rows)
        salt = [TaskContext.get().partitionId() % SALTS] * len(rows)  # the same when a task is run again
        columns = [pa.array(trie, pa.int32()), pa.array(block, pa.int32()), pa.array(salt, pa.int32()), pa.array(n, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["trie", "block", "salt", "n"])


def _sum_blocks(rows: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(n, np.int64) for n in rows["n"])
    return rows.iloc[:1].assign(n=[total.tobytes()])


def _frequent(batches: Iterable[pa.RecordBatch], tries: dict[int, Broadcast]) -> Iterator[pa.RecordBatch]:
    """(w1, w2, w3, n) of summed blocks, which come trie by trie."""
    for batch in batches:
        for number in pc.unique(batch["trie"]).to_pylist():
            own = batch.filter(pc.equal(batch["trie"], number))
            held = next(each_value([tries[number]]))
            for block, raw in zip(own["block"].to_pylist(), own["n"].to_pylist()):
                n = np.frombuffer(raw, np.int64)
                hit = np.flatnonzero(n >= LEAST)
                yield from _rows(list(held.trie.words[block * BLOCK + hit].T), n[hit])


def _longer(batches: Iterable[pa.RecordBatch], tries: list[Broadcast], parts: int) -> Iterator[pa.RecordBatch]:
    """Phrases of three words that start with a pair of the tries, as keys of the pair's and the last word's numbers."""
    for columns in _positions(batches, 3):
        keys = []
        for held, at, states in _visits(columns, tries):
            name = np.zeros(len(held.trie.check), np.int64)
            name[held.trie.accepts] = held.names
            keys.append(name[states] << 32 | columns[2][at])
        if keys:
            yield from _dealt(np.concatenate(keys), parts)


def _counted(ids: DataFrame, phrases: DataFrame, length: int, scratch: Scratch) -> DataFrame:
    """(w1, w2, w3, n) of the phrases that are frequent."""
    tries = _build_tries(phrases)
    found = _passes(ids, tries, partial(_count, length=length), SUMS)
    # Two steps, so that a block of very many tasks' counts does not meet in one task.
    for key in (["trie", "block", "salt"], ["trie", "block"]):
        found = found.groupBy(*key).applyInPandas(_sum_blocks, SUMS)
    words = found.repartition("trie").sortWithinPartitions("trie").mapInArrow(partial(_frequent, tries=tries), COUNTS)
    written = scratch.write(words, "phrases")
    _drop(tries.values())
    return written


def _drop(broadcasts: Iterable[Broadcast]) -> None:
    """Removes broadcasts, from the driver too, once what was made with them is written."""
    for broadcast in broadcasts:
        broadcast.destroy()


def _score(a: str, left: str, right: str) -> Column:
    big = lambda name: F.col(name).cast("decimal(15,0)")
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * big(a) * big(a), big(left) * big(right)).cast("long")


def _scored(words: DataFrame, pairs: DataFrame, triples: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) of all frequent phrases that no longer one covers."""

    def word(k: int) -> DataFrame:
        return words.select(F.col("id").cast("int").alias(f"w{k}"), F.col("word").alias(f"t{k}"), F.col("n").alias(f"n{k}"), F.col("lang").alias(f"lang{k}"))

    inside = F.inline(F.array(F.struct(F.col("w1").alias("w1"), F.col("w2").alias("w2")), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2"))))
    around = triples.select("n", inside).groupBy("w1", "w2").agg(F.max("n").alias("longer"))
    alone = pairs.join(around, ["w1", "w2"], "left").where(F.expr(f"longer IS NULL OR 100 * longer < {COVERED} * n"))
    two = (
        alone.join(word(1), "w1")
        .join(word(2).drop("lang2"), "w2")
        .select(F.col("lang1").alias("lang"), F.concat_ws(" ", "t1", "t2").alias("phrase"), F.col("n").alias("a"), F.col("n1").alias("l"), F.col("n2").alias("r"))
        .withColumn("score", _score("a", "l", "r"))
    )
    head = pairs.select("w1", "w2", F.col("n").alias("n12"))
    tail = pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("n").alias("n23"))
    cuts = (
        triples.join(head, ["w1", "w2"])
        .join(tail, ["w2", "w3"])
        .join(word(1), "w1")
        .join(word(2).select("w2", "t2"), "w2")
        .join(word(3).drop("lang3"), "w3")
        .withColumn("s1", _score("n", "n1", "n23"))
        .withColumn("s2", _score("n", "n12", "n3"))
    )
    first = F.col("s1") <= F.col("s2")
    three = cuts.select(
        F.col("lang1").alias("lang"),
        F.concat_ws(" ", "t1", "t2", "t3").alias("phrase"),
        F.col("n").alias("a"),
        F.when(first, F.col("n1")).otherwise(F.col("n12")).alias("l"),
        F.when(first, F.col("n23")).otherwise(F.col("n3")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )
    return two.unionByName(three)


def collocations(docs: DataFrame, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of two or three words.

    ``a`` counts the phrase, ``l`` and ``r`` the parts of its weakest cut, ``n``
    all words of the language. Ties go by ``a``, then by phrase in byte order.
    """
    scratch = Scratch(docs.sparkSession)
    counted = scratch.write(count_words(docs), "words")
    frequent = counted.where(F.col("n") >= LEAST)
    words = scratch.write(number_rows(frequent, [], [F.col("lang"), F.col("word")], "id"), "vocabulary")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    occurrences, most = (counted.agg(F.sum("n")).first()[0] or 0), (words.agg(F.max("id")).first()[0] or 0)
    if most >= 1 << 31:
        raise ValueError("more frequent words than four bytes can number")
    parts = max(1, -(-occurrences // SUMMED))
    blocks = _blocks(words)
    ids = scratch.write(encode(docs, blocks), "ids")
    _drop(blocks)

    found = candidates(ids.mapInArrow(partial(_pairs, parts=parts), FOUND))
    found = found.select(F.col("a").cast("int").alias("w1"), F.col("b").alias("w2"), F.lit(-1).alias("w3"), F.lit(0).cast("long").alias("name"))
    pairs = _counted(ids, scratch.write(found, "candidates"), 2, scratch)

    named = number_rows(pairs, [], [F.col("w1"), F.col("w2")], "name")
    starts = scratch.write(named.select(*KEY, F.col("name").cast("long").alias("name")), "pairs")
    tries = _build_tries(starts)
    found = candidates(_passes(ids, tries, partial(_longer, parts=parts), FOUND))
    # Their last two words must be frequent as well.
    found = found.join(starts.select(F.col("name").alias("a"), "w1", "w2"), "a").select("w1", "w2", F.col("b").alias("w3"), F.lit(0).cast("long").alias("name"))
    found = found.join(starts.select(F.col("w1").alias("w2"), F.col("w2").alias("w3")), ["w2", "w3"], "left_semi")
    found = scratch.write(found.select(*KEY, "name"), "candidates")
    _drop(tries.values())
    triples = _counted(ids, found, 3, scratch)
    scratch.drop(starts)
    scratch.drop(ids)

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = Window.partitionBy("lang", "part").orderBy(*order)
    ranked = (
        _scored(words, pairs.drop("w3"), triples)
        .withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
        .withColumn("rank", F.row_number().over(part))
        .where(F.col("rank") <= top)
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
        .where(F.col("rank") <= top)
    )
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
