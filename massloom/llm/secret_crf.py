"""Secret scan: three fixed patterns, and a linear-chain conditional random field that adds to them.

The field tags tokens as begin of a secret, inside or outside. A token's scores
come from tables: its shape, its own word, the words and shapes next to it, and
what the file is like. It learns from the spans the patterns find in a bounded
sample of the documents with any, beside a sample of the others, so it needs no labels, and it finds what is written like a
secret where the patterns are too strict. Tags are decoded by Viterbi. Most
tokens are certainly outside: whatever their neighbours' tags, another tag
would cost more than it could gain. They split the chain, and only the short
runs between them are decoded; the result is that of the whole chain.
"""

from __future__ import annotations

import hashlib
import logging
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from massloom.llm.shared import Scratch, hashed_sample, map_batches, whole_text

_LOG = logging.getLogger(__name__)

# The patterns, and the least length of what they must match.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_LEAST = 12
#: The least length is part of these two: a run is taken whole, so a longer one starts where any of it would.
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "crf")

OUTSIDE, BEGIN, INSIDE = range(3)
#: Documents in the sample (a quarter of them with a secret, where there are so many), windows of one document and
#: tokens in a window.
SAMPLE, WINDOWS, WINDOW = 4000, 4, 24
#: Steps of training, step size, pull to zero.
STEPS, RATE, PULL = 150, 0.5, 1e-3
#: Characters of texts looked at together.
TEXT_CHARS = 1_000_000
WORD_BITS = 12
#: Rows of each table: shape, own word, words before and behind, shape before, file, and the shape in outline, which
#: also speaks where the exact shape was never seen.
SHAPES, FILES, OUTLINES = 8 * 64 * 3, 9, 8 * 3 * 2
SIZES = (SHAPES, 1 << WORD_BITS, 1 << WORD_BITS, 1 << WORD_BITS, 1 << WORD_BITS, SHAPES, FILES, OUTLINES)
STARTS = np.cumsum((0, *SIZES))

SPACE, LOWER, UPPER, DIGIT, JOIN, FAR, OTHER = range(7)
_CLASS = np.full(128, OTHER, np.uint8)
_CLASS[[32, *range(9, 14)]] = SPACE
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = LOWER, UPPER, DIGIT
_CLASS[[ord(c) for c in "+/_-"]] = JOIN
_HEX = np.zeros(128, bool)
_HEX[[ord(c) for c in "0123456789abcdefABCDEF"]] = True
#: Two tokens of their own stand between texts, so that no text sees its neighbour's words.
_GAP = " \x01 \x02 "
_GAPS = re.compile(r"[\x20\x09-\x0D]")
_LENGTHS = np.array([4, 8, 12, 16, 20, 32, 48])


def base_spans(text: str, whole: bool = False) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of the secrets the patterns find, in order.

    Of an assignment the secret is its value, group 2; so a hexadecimal value
    is found as two kinds with one start. With ``whole`` an assignment is given
    as its whole match, from the name on.
    """
    found = []
    part = 0 if whole else 2
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [(m.start(part), 0, m.end(part)) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


@dataclass
class Tokens:
    """Places of the tokens of some joined texts, and the rows of the tables each looks up."""

    start: np.ndarray
    end: np.ndarray
    rows: np.ndarray
    gap: np.ndarray


def tokens_of(joined: str, edges: np.ndarray) -> Tokens:
    """``edges``: where each text begins, and the end of all."""
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    near = np.minimum(points, 127)
    kinds = np.where(points < 128, _CLASS[near], FAR).astype(np.uint8)
    group = np.where(kinds == SPACE, 0, np.where(kinds == OTHER, 2, 1)).astype(np.int8)
    change = np.flatnonzero(np.diff(group, prepend=-1))
    ends = np.append(change[1:], len(points))
    solid = group[change] > 0
    start, end = change[solid], ends[solid]
    if not len(start):
        none = np.zeros(0, np.int64)
        return Tokens(none, none, np.zeros((0, len(SIZES)), np.int64), np.zeros(0, bool))

    def total(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return sums[end] - sums[start]

    length = end - start
    digits, letters = total(kinds == DIGIT), total((kinds == LOWER) | (kinds == UPPER))
    turn = np.zeros(len(points), bool)
    turn[1:] = (kinds[1:] == DIGIT) != (kinds[:-1] == DIGIT)
    turns = total(turn) - turn[start]
    flags = (
        (digits > 0)
        | (total(kinds == LOWER) > 0) << 1
        | (total(kinds == UPPER) > 0) << 2
        | (total(kinds == JOIN) > 0) << 3
        | (total((points < 128) & _HEX[near]) == length) << 4
        | (total((kinds == FAR) | (kinds == OTHER)) > 0) << 5
    ).astype(np.int64)
    size, changes = np.searchsorted(_LENGTHS, length, side="right"), np.searchsorted([1, 3], turns, side="right")
    shape = (size * 64 + flags) * 3 + changes
    outline = (size * 3 + changes) * 2 + (digits > 0)
    # A word is hashed without regard to case; one that holds a digit counts by its shape alone, as row 0.
    lowered = np.where(kinds == UPPER, points + 32, points).astype(np.uint64)
    place = (np.arange(len(points)) - np.repeat(change, ends - change)).astype(np.uint64)
    mixed = (lowered + np.uint64(1)) * (np.uint64(2) * place + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
    word = ((sums[end] - sums[start]) >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    word[digits > 0] = 0
    # The file: share of digits among its characters, and marks of assignments.
    text = np.maximum(np.searchsorted(edges, start, side="right") - 1, 0)
    count = len(edges)
    sizes = np.bincount(text, weights=length, minlength=count)
    digit_share = np.bincount(text, weights=digits, minlength=count) / np.maximum(sizes, 1)
    signs = np.bincount(text, weights=total((points == 61) | (points == 58)), minlength=count) / np.maximum(sizes, 1)
    file = (np.searchsorted([0.005, 0.05], digit_share, side="right") * 3 + np.searchsorted([0.002, 0.02], signs, side="right"))[text]

    def moved(values: np.ndarray, by: int) -> np.ndarray:
        out = np.zeros_like(values)
        if by > 0:
            out[by:] = values[:-by]
        else:
            out[:by] = values[-by:]
        return out

    rows = np.stack([shape, word, moved(word, 1), moved(word, 2), moved(word, -1), moved(shape, 1), file, outline], axis=1)
    gap = (length == 1) & ((points[start] == 1) | (points[start] == 2))
    return Tokens(start, end, rows + STARTS[:-1], gap)


@dataclass
class Field:
    """Scores of all table rows and of tag pairs (from, to)."""

    rows: np.ndarray
    pairs: np.ndarray

    def emission(self, rows: np.ndarray) -> np.ndarray:
        return self.rows[rows].sum(axis=-2)

    def slack(self) -> float:
        """The most that the pairs around a token can gain by tagging it as secret rather than outside.

        Tagging it outside may force a following inside tag to become a begin.
        """
        best = -np.inf
        t = self.pairs
        for p in range(3):
            for y in (BEGIN, INSIDE):
                for n in range(3):
                    for m in range(3):
                        given = t[p, y] + t[y, n] + (t[n, m] if n == INSIDE else 0)
                        instead = t[p, OUTSIDE] + (t[OUTSIDE, BEGIN] + t[BEGIN, m] if n == INSIDE else t[OUTSIDE, n])
                        best = max(best, given - instead)
        return float(best)


def viterbi(scores: np.ndarray, pairs: np.ndarray) -> list[int]:
    """Best tags of a run between tokens that are outside."""
    best = scores[0] + pairs[OUTSIDE]
    came = []
    for row in scores[1:]:
        ways = best[:, None] + pairs
        came.append(ways.argmax(axis=0))
        best = ways.max(axis=0) + row
    tag = int((best + pairs[:, OUTSIDE]).argmax())
    tags = [tag]
    for back in reversed(came):
        tag = int(back[tag])
        tags.append(tag)
    return tags[::-1]


def tag(field: Field, tokens: Tokens) -> np.ndarray:
    """The best tags of all tokens."""
    tags = np.zeros(len(tokens.start), np.int8)
    if not len(tags):
        return tags
    scores = field.emission(tokens.rows)
    follow = np.zeros(len(scores))
    follow[:-1] = np.maximum(0, scores[1:, INSIDE] - scores[1:, BEGIN])
    gain = scores[:, 1:].max(axis=1) - scores[:, OUTSIDE] + field.slack() + follow
    maybe = (gain >= 0) & ~tokens.gap
    edges = np.flatnonzero(np.diff(np.concatenate([[False], maybe, [False]]).astype(np.int8)))
    for first, last in zip(edges[::2], edges[1::2], strict=True):
        tags[first:last] = viterbi(scores[first:last], field.pairs)
    return tags


def _pieces(texts: list[str]) -> Iterator[tuple[int, int, str]]:
    """(number, offset, piece): whole texts, or pieces of very long ones that end at white space where there is any."""
    for number, text in enumerate(texts):
        at = 0
        while len(text) - at > TEXT_CHARS:
            border = _GAPS.search(text, at + TEXT_CHARS, at + 2 * TEXT_CHARS)
            end = border.start() if border else at + 2 * TEXT_CHARS
            yield number, at, text[at:end]
            at = end
        yield number, at, text[at:]


def _groups(texts: list[str]) -> Iterator[tuple[list[tuple[int, int]], str, np.ndarray]]:
    """(number, offset) of pieces, the pieces joined, and where each begins with the end of all."""
    held: list[tuple[int, int, str]] = []
    size = 0

    def joined() -> tuple[list[tuple[int, int]], str, np.ndarray]:
        edges = np.cumsum([len(_GAP), *[len(h[2]) + len(_GAP) for h in held]])
        return [h[:2] for h in held], _GAP + _GAP.join(h[2] for h in held) + _GAP, edges

    for piece in _pieces(texts):
        held.append(piece)
        size += len(piece[2])
        if size >= TEXT_CHARS:
            yield joined()
            held, size = [], 0
    if held:
        yield joined()


def added_spans(field: Field, texts: list[str]) -> list[list[tuple[int, int]]]:
    """Spans of tokens tagged as secret, for every text; neighbours in one secret make one span."""
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    for places, joined, edges in _groups(texts):
        tokens = tokens_of(joined, edges)
        tags = tag(field, tokens)
        for k in np.flatnonzero(tags != OUTSIDE):
            piece = int(np.searchsorted(edges, tokens.start[k], side="right")) - 1
            number, offset = places[piece]
            own, move = spans[number], offset - int(edges[piece])
            start, end = int(tokens.start[k]) + move, int(tokens.end[k]) + move
            if tags[k] == INSIDE and own:
                own[-1] = (own[-1][0], end)
            else:
                own.append((start, end))
    return spans


def training_windows(text: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """(table rows, tags) of windows around what the patterns find; of every fourth other text, one window.

    Of a very long text the piece with the first span is used, or the first
    piece. Behind a short text more gaps fill the window.
    """
    base, at = base_spans(text), 0
    for _, offset, piece in _pieces([text]):
        if base and offset <= base[0][0] < offset + len(piece):
            text, at = piece, offset
    _, joined, edges = next(_groups([text]))
    tokens = tokens_of(joined, edges)
    if len(tokens.start) < WINDOW:
        tokens = tokens_of(joined + _GAP * (WINDOW // 2), edges)
    tags = np.zeros(len(tokens.start), np.int8)
    for start, _, end in base:
        low, high = start - at + edges[0], end - at + edges[0]
        inside = np.flatnonzero((tokens.start >= low) & (tokens.end <= high) & ~tokens.gap)
        tags[inside] = INSIDE
        tags[inside[:1]] = BEGIN
    hits = np.flatnonzero(tags == BEGIN)[:WINDOWS]
    drawn = int(hashlib.sha256(joined.encode("utf-8", "surrogatepass")).hexdigest()[:8], 16)
    if not len(hits) and drawn % 4:
        return []
    middles = hits if len(hits) else [drawn // 4 % max(1, len(tags))]
    out = []
    for middle in middles:
        low = max(0, min(int(middle) - WINDOW // 2, len(tags) - WINDOW))
        out.append((tokens.rows[low : low + WINDOW], tags[low : low + WINDOW]))
    return out


def train(windows: list[tuple[np.ndarray, np.ndarray]]) -> Field | None:
    """Maximum likelihood by AdaGrad over all windows, forward and backward sums for all at once."""
    if not any((t == BEGIN).any() for _, t in windows):
        return None
    rows, tags = np.stack([r for r, _ in windows]), np.stack([t for _, t in windows]).astype(int)
    count = len(windows)
    table, pairs = np.zeros((STARTS[-1], 3)), np.zeros((3, 3))
    pairs[OUTSIDE, INSIDE] = -1e3
    table_power, pair_power = np.full_like(table, 1e-8), np.full_like(pairs, 1e-8)
    truth = np.eye(3)[tags]
    true_pairs = np.zeros((3, 3))
    np.add.at(true_pairs, (tags[:, :-1].ravel(), tags[:, 1:].ravel()), 1)

    def logsum(a: np.ndarray, axis: int) -> np.ndarray:
        most = a.max(axis=axis, keepdims=True)
        return (np.log(np.exp(a - most).sum(axis=axis, keepdims=True)) + most).squeeze(axis)

    for _ in range(STEPS):
        scores = table[rows].sum(axis=2)
        ahead, back = [scores[:, 0]], [np.zeros((count, 3))]
        for k in range(1, WINDOW):
            ahead.append(logsum(ahead[-1][:, :, None] + pairs, 1) + scores[:, k])
        for k in range(WINDOW - 2, -1, -1):
            back.append(logsum(pairs + (back[-1] + scores[:, k + 1])[:, None, :], 2))
        back.reverse()
        whole = logsum(ahead[-1], 1)
        belief = np.exp(np.stack([a + b for a, b in zip(ahead, back, strict=True)], axis=1) - whole[:, None, None])
        slope = np.zeros_like(table)
        for part in range(rows.shape[2]):
            np.add.at(slope, rows[:, :, part], truth - belief)
        pair_slope = true_pairs.copy()
        for k in range(WINDOW - 1):
            joint = ahead[k][:, :, None] + pairs + (scores[:, k + 1] + back[k + 1])[:, None, :]
            pair_slope -= np.exp(joint - whole[:, None, None]).sum(axis=0)
        slope, pair_slope = slope / count - PULL * table, pair_slope / count
        pair_slope[OUTSIDE, INSIDE] = 0
        table_power += slope**2
        pair_power += pair_slope**2
        table += RATE * slope / np.sqrt(table_power)
        pairs += RATE * pair_slope / np.sqrt(pair_power)
    return Field(table, pairs)


def fit(docs: DataFrame, sample: int = SAMPLE) -> Field | None:
    """Learns from at most ``sample`` documents, chosen by a hash of doc_id; None if no document holds a secret.

    All documents are looked through for secrets first, so the sample holds
    documents with one however rare they are. What is learned from is bounded by
    document too: ``WINDOWS`` windows of ``WINDOW`` tokens. Scans are of whole texts.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))

    def look(batch: pa.RecordBatch) -> pa.RecordBatch:
        hit = pa.array([bool(base_spans(t)) for t in batch.column("text").to_pylist()], pa.bool_())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), hit], names=["doc_id", "hit"])

    scratch = Scratch(docs.sparkSession)
    seen = scratch.write(map_batches(rows, look, "doc_id long, hit boolean"), "secrets")
    quarter = max(1, sample // 4)
    drawn = [hashed_sample(seen.where(w), n, "secrets") for w, n in (("hit", quarter), ("not hit", sample - quarter))]
    chosen = drawn[0].unionByName(drawn[1]).distinct()

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, cells, tags = [], [], []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            for r, t in training_windows(text):
                ids.append(doc_id)
                cells.append(r.astype("<i4").tobytes())
                tags.append(t.astype(np.int8).tobytes())
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(cells, pa.binary()), pa.array(tags, pa.binary())],
            names=["doc_id", "cells", "tags"],
        )

    # The sample bounds both the broadcast ids and the windows that come back.
    got = map_batches(rows.join(F.broadcast(chosen), "doc_id"), cut, "doc_id long, cells binary, tags binary").collect()
    field = train(
        [
            (np.frombuffer(c, "<i4").reshape(-1, len(SIZES)).astype(np.int64), np.frombuffer(t, np.int8))
            for _, c, t in sorted((r.doc_id, bytes(r.cells), bytes(r.tags)) for r in got)
        ]
    )
    scratch.drop(seen)
    if field is None:
        _LOG.warning("The patterns find no secret to learn from: no field, and the scan adds no spans to theirs.")
    return field


def scan(docs: DataFrame, field: Field | None, whole: bool = False) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_crf, base_sha256, spans for every row of ``docs``.

    A span is kind:start:end in code points, end exclusive, ordered by start
    and then kind; that of an assignment is its value or, with ``whole``, the
    whole match. A span the field adds may reach beyond one of the patterns;
    inside one it is left out.
    A null text counts as empty and has none. Repeated rows give repeated rows.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        more = added_spans(field, texts) if field else [[] for _ in texts]
        out: list[list] = [[] for _ in range(6)]
        for text, added in zip(texts, more, strict=True):
            base = base_spans(text, whole)
            new = [(s, 3, e) for s, e in added if not any(bs <= s and e <= be for bs, _, be in base)]
            named = [[f"{KINDS[k]}:{s}:{e}" for s, k, e in spans] for spans in (base, sorted(base + new))]
            for k in range(3):
                out[k].append(sum(b[1] == k for b in base))
            out[3].append(len(new))
            out[4].append(hashlib.sha256(",".join(named[0]).encode()).hexdigest())
            out[5].append(",".join(named[1]))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(o, pa.int64()) for o in out[:4]], *[pa.array(o, pa.string()) for o in out[4:]]],
            names=["doc_id", "n_assign", "n_access", "n_hex", "n_crf", "base_sha256", "spans"],
        )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return map_batches(
        rows, run, "doc_id long, n_assign long, n_access long, n_hex long, n_crf long, base_sha256 string, spans string"
    )
