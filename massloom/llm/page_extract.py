"""Main text of HTML pages by a linear-chain conditional random field over their leaf blocks.

A block's features are the elements around it (tags and the words of their
names, nearest ones apart from the others) and its text. The field is learned
from labelled pages, and Viterbi decodes every page as a whole.

Null and empty pages, and pages without a block of main text, give an empty
text. Every row gives a row, repeated ones and ones without id too. Pages are
read whole.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from massloom.llm import page_layouts
from massloom.llm.page_blocks import Block, Element, blocks
from massloom.llm.shared import DRAWS, fresh, map_batches

#: Pages whose texts are set into layouts to learn from, and layouts made of them.
SAMPLE, LAYOUTS = 200, 1200
#: Characters of a sampled page's blocks, and blocks of it, that layouts draw words from.
BLOCK_CHARS, PAGE_BLOCKS = 1000, 60
#: Places that features are hashed to.
WIDTH = 1 << 16
EPOCHS, STEP, SHRINK = 120, 0.05, 1e-4
OTHER, MAIN = 0, 1
#: Paths whose scores a task keeps; beyond, it starts anew.
KEPT = 50_000


@dataclass(frozen=True)
class Field:
    """A learned field: a score per feature and label, per pair of labels, and per first and last label."""

    weights: np.ndarray  # (WIDTH, 2)
    steps: np.ndarray  # (2, 2): from, to
    first: np.ndarray
    last: np.ndarray


def _place(feature: str) -> int:
    return zlib.crc32(feature.encode()) % WIDTH


def _names(element: Element) -> list[str]:
    return [element.tag, *(f".{w}" for w in element.words), *(f"~{w[:4]}" for w in element.words if len(w) > 4)]


def path_features(path: tuple[Element, ...]) -> list[str]:
    """Of the elements around a block: the three nearest by their distance, the nearest with a name, all, and those inside an article."""
    path = tuple(e for e in path if e.tag not in ("html", "body"))
    out = ["bias"]
    for far, element in enumerate(reversed(path[-3:])):
        out += [f"{far}{name}" for name in _names(element)]
    named = [e for e in path if e.words or e.tag in ("article", "main", "nav", "header", "footer", "aside", "form", "section")]
    for far, element in enumerate(reversed(named[-2:])):
        out += [f"n{far}{name}" for name in _names(element)]
    out += dict.fromkeys(f"*{name}" for e in path for name in _names(e))
    if not named:
        out.append("bare")
    # Parts inside the part that is called the main one.
    deepest = max((k for k, e in enumerate(path) if e.tag in ("article", "main")), default=-1)
    if deepest >= 0:
        inner = [name for e in path[deepest + 1 :] for name in _names(e)]
        out += dict.fromkeys(f"in{name}" for name in inner) if inner else ["in"]
    return out


def _step(value: float, *bounds: float) -> int:
    return sum(value >= b for b in bounds)


def text_features(block: Block) -> list[str]:
    """Of a block's text: length, marks, links."""
    text = block.text
    words = text.count(" ") + 1
    marks = sum(map(text.count, ".,;:!?"))
    tag = block.path[-1].tag if block.path else ""
    long, link = _step(words, 2, 4, 8, 15, 30, 80), _step(block.linked, 0.05, 0.5, 0.95)
    out = [f"long{long}", f"link{link}", f"both{long}:{link}", f"marks{_step(marks / words, 0.02, 0.08, 0.2)}", f"{tag}{long}", f"{tag}:{link}"]
    if text[-1] in ".!?…\"”":
        out.append("ended")
    if "©" in text or "|" in text:
        out.append("sign")
    return out


def page_features(page: list[Block]) -> list[str]:
    """Of a page: whether it names a part as the main one; a block outside that part then says so."""
    tags = {e.tag for b in page for e in b.path}
    return [tag for tag in ("article", "main") if tag in tags]


def _outside(path: tuple[Element, ...], holds: list[str]) -> list[str]:
    tags = {e.tag for e in path}
    return [f"out-{tag}" if tag not in tags else f"in-{tag}" for tag in holds]


def learn(pages: list[list[Block]]) -> Field:
    """A field from labelled pages, by Adam over all of them at once; the chains of all pages advance together."""
    pages = [p for p in pages if p]
    longest = max(map(len, pages), default=1)
    number, owner, gold = [], [], np.full((len(pages), longest), -1)
    row = 0
    at = np.zeros((len(pages), longest), np.int64)  # row of a block's scores; 0 is past the end
    for k, page in enumerate(pages):
        holds = page_features(page)
        for j, block in enumerate(page):
            row += 1
            at[k, j], gold[k, j] = row, int(block.main)
            features = {_place(f) for f in [*path_features(block.path), *text_features(block), *_outside(block.path, holds)]}
            number += features
            owner += [row] * len(features)
    number, owner = np.array(number, np.int64), np.array(owner, np.int64)
    used, local = np.unique(number, return_inverse=True)
    live = gold >= 0
    ends = live.sum(axis=1) - 1
    pick = np.arange(len(pages))
    wanted = np.zeros((row + 1, 2))
    wanted[at[live], gold[live]] = 1
    pairs = np.zeros((2, 2))
    np.add.at(pairs, (gold[:, :-1][live[:, 1:]], gold[:, 1:][live[:, 1:]]), 1)
    begins, stops = (np.bincount(g, minlength=2) for g in (gold[:, 0], gold[pick, ends]))

    shapes = [(len(used), 2), (2, 2), (2,), (2,)]
    values = [np.zeros(s) for s in shapes]
    mean, spread = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes]
    total = max(1, row)
    for epoch in range(1, EPOCHS + 1):
        weights, steps, first, last = values
        score = np.stack([np.bincount(owner, weights[local, c], row + 1) for c in (0, 1)], axis=1)[at]
        score[pick, ends] += last
        forward = np.zeros_like(score)
        forward[:, 0] = score[:, 0] + first
        for j in range(1, longest):
            came = np.logaddexp.reduce(forward[:, j - 1, :, None] + steps, axis=1) + score[:, j]
            forward[:, j] = np.where(live[:, j, None], came, forward[:, j - 1])
        whole = np.logaddexp.reduce(forward[:, -1], axis=1)
        backward = np.zeros_like(score)
        move = np.zeros((2, 2))
        for j in range(longest - 1, 0, -1):
            ahead = (score[:, j] + backward[:, j])[:, None, :] + steps
            chance = np.exp(forward[:, j - 1, :, None] + ahead - whole[:, None, None])
            move += chance[live[:, j]].sum(axis=0)
            backward[:, j - 1] = np.where(live[:, j, None], np.logaddexp.reduce(ahead, axis=2), backward[:, j])
        chance = np.exp(forward + backward - whole[:, None, None])
        given = np.zeros((row + 1, 2))
        given[at[live]] = chance[live]
        off = given - wanted
        slopes = [
            np.stack([np.bincount(local, off[owner, c], len(used)) for c in (0, 1)], axis=1),
            move - pairs,
            chance[:, 0].sum(axis=0) - begins,
            chance[pick, ends].sum(axis=0) - stops,
        ]
        for k, slope in enumerate(slopes):
            slope = slope / total + SHRINK * values[k]
            mean[k] = 0.9 * mean[k] + 0.1 * slope
            spread[k] = 0.999 * spread[k] + 0.001 * slope**2
            values[k] = values[k] - STEP * (mean[k] / (1 - 0.9**epoch)) / (np.sqrt(spread[k] / (1 - 0.999**epoch)) + 1e-8)
    weights = np.zeros((WIDTH, 2), np.float64)
    weights[used] = values[0]
    return Field(weights, values[1], values[2], values[3])


def decode(field: Field, scores: list[tuple[float, float]]) -> list[int]:
    """The best labels of a chain with these scores per block (Viterbi)."""
    if not scores:
        return []
    (oo, om), (mo, mm) = field.steps.tolist()
    other, main = scores[0][0] + field.first[OTHER], scores[0][1] + field.first[MAIN]
    back: list[tuple[int, int]] = []
    for to_other, to_main in scores[1:]:
        a, b, c, d = other + oo, main + mo, other + om, main + mm
        back.append((int(b > a), int(d >= c)))
        other, main = max(a, b) + to_other, max(c, d) + to_main
    labels = [int(main + field.last[MAIN] >= other + field.last[OTHER])]
    for step in reversed(back):
        labels.append(step[labels[-1]])
    return labels[::-1]


class Labeller:
    """Labels the blocks of pages; scores of paths and features it has seen are kept."""

    def __init__(self, field: Field) -> None:
        self.field = field
        self._paths: dict[tuple, tuple[float, float]] = {}
        self._texts: dict[str, tuple[float, float]] = {}

    def _sum(self, features: Iterable[str]) -> tuple[float, float]:
        total = self.field.weights[list({_place(f) for f in features})].sum(axis=0)
        return float(total[0]), float(total[1])

    def labels(self, page: list[Block]) -> list[int]:
        scores = []
        holds = page_features(page)
        for block in page:
            key = (block.path, *holds)
            around = self._paths.get(key)
            if around is None:
                if len(self._paths) >= KEPT:
                    self._paths.clear()
                around = self._paths[key] = self._sum([*path_features(block.path), *_outside(block.path, holds)])
            features = text_features(block)
            text = "\t".join(features)
            inside = self._texts.get(text)
            if inside is None:
                inside = self._texts[text] = self._sum(features)
            scores.append((around[0] + inside[0], around[1] + inside[1]))
        return decode(self.field, scores)

    def text(self, page: str | None) -> str:
        found = blocks(page or "")
        return "\n".join(b.text for b, label in zip(found, self.labels(found)) if label == MAIN)


def fit(pages: DataFrame, sample: int = SAMPLE, layouts: int = LAYOUTS) -> Field:
    """A field learned from ``layouts`` labelled pages, whose texts come from ``sample`` of the pages at most.

    The sample is drawn by a hash of the text; of a sampled page the first
    ``PAGE_BLOCKS`` blocks lend up to ``BLOCK_CHARS`` characters each. It lends
    words alone: how pages are built is learned from the labelled layouts.
    """
    texts = pages.select(F.col("html").cast("string").alias("html")).where("length(html) > 0")
    drawn = F.pmod(F.xxhash64("html"), F.lit(DRAWS))
    bound = DRAWS * 2 * sample // max(texts.count(), 1)

    def lend(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [batch["draw"], pa.array([[b.text[:BLOCK_CHARS] for b in blocks(p)[:PAGE_BLOCKS]] for p in batch["html"].to_pylist()], pa.list_(pa.string()))],
            ["draw", "texts"],
        )

    some = texts.withColumn("draw", drawn).where(F.col("draw") <= bound).orderBy("draw", "html").limit(sample)
    rows = sorted((r["draw"], r["texts"]) for r in map_batches(some.select("draw", "html"), lend, "draw long, texts array<string>").collect())
    lent = [t for _, own in rows for t in own] or ["text of a page"]
    draw = random.Random(13)
    return learn([blocks(page_layouts.page(lent, draw)) for _ in range(layouts)])


def extract(pages: DataFrame, field: Field | Broadcast, html: str = "html") -> DataFrame:
    """``pages`` with ``text``, the main text, and ``n_chars``, its code points, in place of columns of these names."""
    shared = field if isinstance(field, Broadcast) else pages.sparkSession.sparkContext.broadcast(field)
    kept = [c for c in pages.columns if c.lower() not in (html.lower(), "text", "n_chars")]
    source = fresh(pages, "html")
    schema = [f"`{c.replace('`', '``')}` {pages.schema[c].dataType.simpleString()}" for c in kept] + ["text string", "n_chars long"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(shared.value)
        for batch in batches:
            texts = [labeller.text(page) for page in batch.column(source).to_pylist()]
            own = [batch.column(k) for k in range(len(kept))]
            yield pa.RecordBatch.from_arrays([*own, pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], [*kept, "text", "n_chars"])

    quoted = [F.col(f"`{c.replace('`', '``')}`") for c in kept]
    return pages.select(*quoted, F.col(html).cast("string").alias(source)).mapInArrow(run, ", ".join(schema))
