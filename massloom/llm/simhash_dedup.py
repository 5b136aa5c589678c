"""Near-duplicate detection by SimHash over word shingles, linked with the Gray-order index."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from massloom.llm.components import components
from massloom.llm.gray_index import NODE_LIMIT, block_masks, linked, random_masks
from massloom.llm.shared import Scratch, map_batches, whole_text

#: Bytes of a text that are split into words at once.
PIECE = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
#: Bits of each byte value, highest first.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
#: Odd multipliers that make further hashes from the first (golden ratio, and the primes of the hash itself).
_FURTHER = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def shingle_hashes(text: bytes, words: int) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of all runs of ``words`` words, piece by piece, repeats included.

    A-Z count as a-z. A text of fewer words is one shingle, one of none has none.
    """
    carried: list[bytes] = []
    at, given = 0, False
    digest = xxhash.xxh64_intdigest
    while at < len(text):
        border = _SPACE.search(text, at + PIECE)
        end = border.start() if border else len(text)
        tokens = carried + text[at:end].lower().split()
        at = end
        if len(tokens) >= words:
            joined = b" ".join(tokens)
            edges = np.concatenate([[0], np.cumsum([len(t) + 1 for t in tokens])]).tolist()
            spans = zip(edges[: len(edges) - words], edges[words:], strict=True)
            yield np.array([digest(joined[s : e - 1], 42) for s, e in spans], np.uint64)
            given = True
            carried = tokens[len(tokens) - words + 1 :] if words > 1 else []
        else:
            carried = tokens
    if carried and not given:
        yield np.array([digest(b" ".join(carried), 42)], np.uint64)


def fingerprint(text: bytes, words: int, width: int) -> bytes:
    """``width`` 64-bit words; a bit is 1 if it is set in over half of the shingles' hashes, repeats counted."""
    return majority(shingle_hashes(text, words), width)


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """The distinct hashes of ``shingle_hashes``, in order."""
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *shingle_hashes(text, words)]))


def majority(pieces: Iterable[np.ndarray], width: int) -> bytes:
    """``width`` 64-bit words; a bit is 1 if it is set in over half of the hashes."""
    counts = np.zeros((width, 64), np.int64)
    total = 0
    places = np.arange(8) * 256
    for hashes in pieces:
        total += len(hashes)
        for word in range(width):
            mixed = hashes
            if word:
                mixed = hashes * _FURTHER[word - 1]
                mixed = (mixed ^ (mixed >> np.uint64(29))) * _FURTHER[word - 1]
                mixed = mixed ^ (mixed >> np.uint64(32))
            cells = mixed.astype(">u8").view(np.uint8).reshape(-1, 8) + places
            seen = np.bincount(cells.ravel(), minlength=2048).reshape(8, 256)
            counts[word] += (seen @ _BITS).ravel()
    return np.packbits(2 * counts > total, axis=1).tobytes()


def fingerprints(docs: DataFrame, words: int, width: int) -> DataFrame:
    """doc_id and ``code`` of every whole text; a null or empty text has all bits zero."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        codes = [fingerprint(t, words, width) for t in batch.column("bytes").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(codes, pa.binary())], names=["doc_id", "code"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().cast("binary").alias("bytes"))
    return map_batches(rows, run, "doc_id long, code binary")


def near_groups(
    docs: DataFrame, masks: list[np.ndarray], bound: int, words: int, width: int, node_limit: int = NODE_LIMIT
) -> DataFrame:
    """doc_id, code, component_id (smallest doc_id reachable over links) for every row of ``docs``.

    Equal fingerprints are one point of the index, so copies never meet as
    pairs. Repeated rows give repeated rows. A row without doc_id cannot be
    reached by its id: it takes the component of its fingerprint's other rows,
    or null. Other columns of ``docs`` are not read.
    """
    scratch = Scratch(docs.sparkSession)
    prints = scratch.write(fingerprints(docs, words, width), "fingerprints")
    reps = scratch.write(prints.where("doc_id is not null").groupBy("code").agg(F.min("doc_id").alias("rep")), "codes")
    found = components(linked(reps, masks, bound, node_limit), scratch)
    named = reps.join(found, reps["rep"] == found["id"], "left").select(
        "code", F.coalesce("component", "rep").alias("component_id")
    )
    return prints.join(named, "code", "left").select("doc_id", "code", "component_id")


def simhash_groups(docs: DataFrame, node_limit: int = NODE_LIMIT) -> DataFrame:
    """Groups by 64-bit fingerprints of 3-word shingles that differ in at most 3 bits, all links found."""
    return near_groups(docs, block_masks(64, 3, 2), 3, words=3, width=1, node_limit=node_limit)


#: Of ``similar_groups``: 64-bit words in a fingerprint, bits in a mask, masks.
WIDTH, MASK_BITS, MASKS = 4, 16, 80
#: Standard deviations by which a candidate's differing bits may exceed what is expected at the similarity.
MARGIN = 3
#: Texts and shingles of one candidate group that are compared in one task, at most twice as many.
PART_TEXTS, PART_SHINGLES = 1000, 1_000_000


def _digest(hashes: np.ndarray) -> bytes:
    return hashlib.md5(hashes.astype("<u8").tobytes(), usedforsecurity=False).digest()


def set_prints(docs: DataFrame, words: int, width: int) -> DataFrame:
    """doc_id, ``code`` and ``digest`` of the distinct shingles of every whole text, and ``n``, their number."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        codes, digests, sizes = [], [], []
        for text in batch.column("bytes").to_pylist():
            hashes = shingle_set(text, words)
            codes.append(majority([hashes], width))
            digests.append(_digest(hashes))
            sizes.append(len(hashes))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(codes, pa.binary()), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64())],
            names=["doc_id", "code", "digest", "n"],
        )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().cast("binary").alias("bytes"))
    return map_batches(rows, run, "doc_id long, code binary, digest binary, n long")


def similar_links(sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Links of a spanning forest of the sets that are linked where their Jaccard similarity is ``similarity`` or more.

    A set that is reached is not compared again with those reached before it.
    """
    links: list[tuple[int, int]] = []
    sizes = np.array([len(s) for s in sets], np.int64)
    values, elements = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]), return_inverse=True)
    own = np.split(elements, np.cumsum(sizes)[:-1]) if len(sets) else []
    mark = np.zeros(len(values), np.int32)
    left = np.flatnonzero(sizes)
    flat = edges = None
    reached: list[int] = []
    while len(left):
        if not reached:
            reached, left, flat = [int(left[0])], left[1:], None
            continue
        one = reached.pop()
        if flat is None:
            flat = np.concatenate([own[k] for k in left])
            edges = np.cumsum(sizes[left]) - sizes[left]
        mark[own[one]] = 1
        shared = np.add.reduceat(mark[flat], edges)
        mark[own[one]] = 0
        near = shared / (sizes[one] + sizes[left] - shared) >= similarity
        if near.any():
            links += [(one, k) for k in left[near].tolist()]
            reached += left[near].tolist()
            left, flat = left[~near], None
    return links


def similar_groups(docs: DataFrame, similarity: float = 0.8, words: int = 5) -> DataFrame:
    """doc_id, code, component_id (smallest doc_id reachable over links) for every row of ``docs``.

    Texts are linked if the Jaccard similarity of their sets of 5-word shingles
    is ``similarity`` or more. 256-bit fingerprints of the sets only name
    candidates: sets of one size with similarity s have cosine 2 s / (1 + s)
    and differ in arccos(cosine) / pi of the bits, 39 at 0.8; candidates may
    differ in three standard deviations more. Inside a group of candidates the
    sets themselves decide, all with all but those connected already; a large
    group is dealt into parts, every two of which meet. So every link is exact,
    and one is lost only if no chain of candidates joins its ends.

    Equal sets are one point. Rows that are repeated or without doc_id count as
    in ``near_groups``; texts without a word are equal.
    """
    cosine = 2 * similarity / (1 + similarity)
    bits = 64 * WIDTH
    share = float(np.arccos(cosine)) / np.pi
    bound = round(bits * share + MARGIN * (bits * share * (1 - share)) ** 0.5)
    scratch = Scratch(docs.sparkSession)
    prints = scratch.write(set_prints(docs, words, WIDTH), "fingerprints")
    points = scratch.write(
        prints.where("doc_id is not null").groupBy("code", "digest").agg(F.min("doc_id").alias("point"), F.min("n").alias("n")),
        "sets",
    )
    reps = scratch.write(points.groupBy("code").agg(F.min("point").alias("rep")), "codes")
    found = components(linked(reps, random_masks(bits, MASK_BITS, MASKS), bound), scratch)
    named = reps.join(found, reps["rep"] == found["id"], "left").select("code", F.coalesce("component", "rep").alias("near"))
    grouped = scratch.write(points.join(named, "code").select("near", "digest", "point", "n"), "candidates")
    parts = F.greatest(F.ceil(F.count("*") / PART_TEXTS), F.ceil(F.sum("n") / PART_SHINGLES), F.lit(1)).cast("int")
    several = grouped.groupBy("near").agg(F.count("*").alias("texts"), parts.alias("parts")).where("texts > 1")
    asked = grouped.join(several, "near").select("near", "digest", F.col("point").alias("doc_id"), "parts")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().cast("binary").alias("bytes"))

    def hashed(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(t, words) for t in batch.column("bytes").to_pylist()]
        # Another text of the same doc_id is another point.
        own = pa.array([_digest(s) == d for s, d in zip(sets, batch.column("digest").to_pylist(), strict=True)], pa.bool_())
        cells = pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())
        names = ["near", "parts", "digest", "doc_id"]
        return pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], cells], names=[*names, "cells"]).filter(own)

    sets = map_batches(texts.join(asked, "doc_id").distinct(), hashed, "near long, parts int, digest binary, doc_id long, cells binary")
    own = F.pmod(F.xxhash64("digest"), F.col("parts")).cast("int")
    meets = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.least(own, j) * F.col("parts") + F.greatest(own, j)
    )

    def verified(table: pa.Table) -> pa.Table:
        ids = table.column("doc_id").to_pylist()
        links = similar_links([np.frombuffer(c, "<u8") for c in table.column("cells").to_pylist()], similarity)
        return pa.table({k: pa.array([ids[one[at]] for one in links], pa.int64()) for at, k in enumerate("ab")})

    dealt = sets.select("near", F.explode(meets).alias("part"), "doc_id", "cells")
    links = dealt.groupBy("near", "part").applyInArrow(verified, "a long, b long")
    joined = components(links, scratch)
    final = points.join(joined, points["point"] == joined["id"], "left").select(
        "code", "digest", F.coalesce("component", "point").alias("component_id")
    )
    return prints.join(final, ["code", "digest"], "left").select("doc_id", "code", "component_id")


def keep_one(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: of each group the document with the smallest doc_id, and rows without doc_id."""
    gone = groups.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone.hint("shuffle_hash"), docs["doc_id"] == gone["doc_id"], "left_anti")
