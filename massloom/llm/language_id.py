"""Language identification by averaged hashed subword embeddings and a linear softmax.

Every run of 1 to 3 characters hashes to a row of an embedding table; a text is
the mean of its rows, and a linear layer with softmax names the language. Both
are trained together by stochastic gradient descent in numpy on a bounded
sample. Mean and linear layer commute, so each row's part in the result is
worked out once and a text only sums what its characters look up. A temperature
fitted on rows left out of training calibrates the probabilities, and the same
rows give the confidence below which a prediction is marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from massloom.llm.shared import DRAWS, map_batches

#: Longest run of characters, rows of the embedding table (a power of 2) and its width.
LONGEST, ROWS, WIDTH = 3, 1 << 15, 16
#: Labelled documents per language that are learned from at most; one in FIFTH is for calibration.
SAMPLE, FIFTH = 400, 5
#: Steps of descent, documents in a step, step size.
STEPS, STEP_ROWS, RATE = 1200, 16, 20.0
#: Share of accepted predictions that must be right on the rows for calibration.
ACCEPTED_RIGHT = 0.99
#: Characters of texts looked at together; longer texts are taken in pieces.
TEXT_CHARS = 1_000_000
_SPREAD = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)

UNKNOWN = "und"


@dataclass
class Model:
    """``parts``: log-odds that a table row adds, per language; ``languages`` in order."""

    languages: list[str]
    parts: np.ndarray
    shift: np.ndarray
    temperature: float = 1.0
    accept: float = 0.0


def _rows(points: np.ndarray) -> Iterator[np.ndarray]:
    """For each length of run, the table row of the run at every place but the last two."""
    hashed = np.zeros(len(points) - LONGEST + 1, np.uint32)
    for length in range(LONGEST):
        # The run of the characters so far, whose number is hashed in as well.
        hashed = (hashed ^ (points[length : len(points) - LONGEST + 1 + length] + np.uint32(length))) * _SPREAD[length]
        yield ((hashed ^ (hashed >> np.uint32(15))) & np.uint32(ROWS - 1)).astype(np.int64)


def _groups(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Code points of several texts, each between blanks, with the texts' numbers and first places."""
    held: list[str] = []
    numbers: list[int] = []
    size = 0
    for number, text in enumerate(texts):
        for at in range(0, max(1, len(text)), TEXT_CHARS):
            piece = f" {text[at : at + TEXT_CHARS].lower()} "
            held.append(piece)
            numbers.append(number)
            size += len(piece)
            if size >= TEXT_CHARS:
                yield _joined(held, numbers)
                held, numbers, size = [], [], 0
    if held:
        yield _joined(held, numbers)


def _joined(held: list[str], numbers: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    points = np.frombuffer(("".join(held) + "  ").encode("utf-32-le", "surrogatepass"), "<u4").copy()
    points[(points >= 9) & (points <= 13)] = 32
    return points, np.array(numbers), np.cumsum([0, *[len(h) for h in held]])


def log_odds(model: Model, texts: list[str]) -> np.ndarray:
    """A row of log-odds for every text, not yet tempered."""
    sums = np.zeros((len(texts), len(model.languages)))
    counts = np.zeros(len(texts))
    for points, numbers, edges in _groups(texts):
        # Runs that start at a text's closing blank would reach into the next one.
        inside = np.ones(edges[-1], bool)
        inside[edges[1:] - 1] = False
        for rows in _rows(points):
            looked = model.parts[rows]
            looked[~inside] = 0
            np.add.at(sums, numbers, np.add.reduceat(looked, edges[:-1], axis=0))
        np.add.at(counts, numbers, LONGEST * (np.diff(edges) - 1))
    return sums / np.maximum(counts, 1)[:, None] + model.shift


def _softmax(odds: np.ndarray) -> np.ndarray:
    e = np.exp(odds - odds.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def predict(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Number of the likeliest language (the first of equals) and its calibrated probability."""
    p = _softmax(log_odds(model, texts) / model.temperature)
    return p.argmax(axis=1), p.max(axis=1)


def counted(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Table rows and how often each text looks them up."""
    out = []
    for text in texts:
        total = np.zeros(ROWS, np.int64)
        for points, _, edges in _groups([text]):
            inside = np.ones(edges[-1], bool)
            inside[edges[1:] - 1] = False
            for rows in _rows(points):
                total += np.bincount(rows[inside], minlength=ROWS)
        at = np.flatnonzero(total)
        out.append((at, total[at]))
    return out


def train(features: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, languages: list[str]) -> Model:
    """Stochastic gradient descent on the cross-entropy; then temperature and bound on rows left out."""
    draw = np.random.default_rng(11)
    table = draw.normal(0, 0.1, (ROWS, WIDTH)).astype(np.float32)
    layer = draw.normal(0, 0.1, (WIDTH, len(languages))).astype(np.float32)
    shift = np.zeros(len(languages), np.float32)
    shares = [(at, (n / n.sum()).astype(np.float32)) for at, n in features]
    left_out = np.arange(len(shares)) % FIFTH == 0 if len(shares) >= FIFTH * len(languages) else np.zeros(len(shares), bool)
    learn = np.flatnonzero(~left_out)
    passes = -(-STEPS * STEP_ROWS // len(learn))
    for turn in range(passes):
        rate = RATE * (1 - turn / passes)
        draw.shuffle(learn)
        for k in range(0, len(learn), STEP_ROWS):
            chosen = learn[k : k + STEP_ROWS]
            mean = np.stack([shares[i][1] @ table[shares[i][0]] for i in chosen])
            wrong = _softmax(mean @ layer + shift)
            wrong[np.arange(len(chosen)), labels[chosen]] -= 1
            wrong /= len(chosen)
            back = (wrong @ layer.T).astype(np.float32)
            layer -= 0.02 * rate * (mean.T @ wrong).astype(np.float32)
            shift -= 0.02 * rate * wrong.sum(axis=0).astype(np.float32)
            for row, i in enumerate(chosen):
                table[shares[i][0]] -= rate * shares[i][1][:, None] * back[row]
    model = Model(languages, (table @ layer).astype(np.float32), shift.astype(float))
    held = np.flatnonzero(left_out)
    if len(held):
        odds = np.stack([shares[i][1] @ model.parts[shares[i][0]] for i in held]) + model.shift
        truth = labels[held]
        grid = np.geomspace(0.05, 20, 60)
        loss = [-np.log(_softmax(odds / t)[np.arange(len(held)), truth] + 1e-12).mean() for t in grid]
        model.temperature = float(grid[int(np.argmin(loss))])
        p = _softmax(odds / model.temperature)
        order = np.argsort(-p.max(axis=1), kind="stable")
        right = np.cumsum((p.argmax(axis=1) == truth)[order]) / np.arange(1, len(held) + 1)
        enough = np.flatnonzero(right >= ACCEPTED_RIGHT)
        model.accept = float(p.max(axis=1)[order[enough[-1]]]) if len(enough) else 1.0
    return model


def fit(labelled: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Learns from ``labelled`` (doc_id, text, lang): at most ``sample`` rows per language, chosen by a hash of doc_id.

    Rows without language, id or text are not used; None if none is left.
    """
    rows = labelled.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    ).where("doc_id is not null and text is not null and lang is not null")
    # A bound on the hash, set from the rows of each language, leaves about twice the sample for the window.
    named = rows.select("doc_id", "lang").distinct()
    sizes = named.groupBy("lang").agg(F.count("*").alias("of"))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("lang")), F.lit(DRAWS))
    near = named.join(sizes, "lang").where(drawn <= F.lit(DRAWS * 2 * sample) / F.col("of"))
    turn = F.row_number().over(Window.partitionBy("lang").orderBy(drawn, "doc_id"))
    chosen = near.withColumn("turn", turn).where(F.col("turn") <= sample).select("doc_id", "lang")

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = counted(batch.column("text").to_pylist())
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("lang"),
                pa.array([m[0].tolist() for m in made], pa.list_(pa.int32())),
                pa.array([m[1].tolist() for m in made], pa.list_(pa.int64())),
            ],
            names=["doc_id", "lang", "rows", "counts"],
        )

    # Documents of the sample only: its size times the number of languages bounds both sides.
    picked = rows.join(F.broadcast(chosen), ["doc_id", "lang"])
    found = map_batches(picked, count, "doc_id long, lang string, rows array<int>, counts array<long>").collect()
    found = sorted(found, key=lambda r: (r.doc_id, r.lang, r.rows, r.counts))
    if not found:
        return None
    languages = sorted({r.lang for r in found})
    labels = np.array([languages.index(r.lang) for r in found])
    # Languages take turns, so that every fifth row holds all of them.
    order = np.lexsort([labels, [int((labels[:k] == labels[k]).sum()) for k in range(len(labels))]])
    features = [(np.array(found[k].rows), np.array(found[k].counts)) for k in order]
    return train(features, labels[order], languages)


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score and rejected for every row of ``docs``.

    A text that is null or has no letter is ``und`` with score 0, and so is
    every text if nothing was learned. A score below the learned bound marks a
    prediction as rejected; it is given all the same. Repeated rows give
    repeated rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), text.rlike(r"\p{L}").alias("letters")
    )

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        letters = batch.column("letters").to_numpy(zero_copy_only=False)
        names, scores = np.full(len(batch), UNKNOWN, object), np.zeros(len(batch))
        if model and letters.any():
            best, p = predict(model, batch.column("text").filter(pa.array(letters)).to_pylist())
            names[letters], scores[letters] = np.array(model.languages, object)[best], p
        accept = model.accept if model else 0.0
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores), pa.array(~letters | (scores < accept))],
            names=["doc_id", "lang_pred", "score", "rejected"],
        )

    return map_batches(rows, run, "doc_id long, lang_pred string, score double, rejected boolean")
