"""Quality classifier by compression.

Two zstandard dictionaries are built, from good and from bad labelled text. A
text is cut into blocks; each block is compressed with either dictionary, and
the difference of the two sums of sizes over their total is the raw score.
Logistic calibration on labelled rows that went into no dictionary turns it
into a probability. The learned part is two dictionaries and two numbers, which
travel with the tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from massloom.llm.shared import hashed_sample, map_batches, whole_text

#: Bytes in a block, and in a dictionary at most.
BLOCK, DICTIONARY = 1024, 112_640
#: Labelled rows per class that are learned from at most: half for dictionaries, half for calibration.
ROWS = 6_000
#: Blocks of one labelled row that a dictionary learns from at most, spread evenly over its whole text. It bounds what
#: is learned from, as ``ROWS`` does; scores are of whole texts.
BLOCKS_OF_ROW = 4
LEVEL = 3


@dataclass
class Model:
    """``dictionaries``: (content, trained) for bad and for good text; the score is 1 / (1 + exp(-slope x - shift))."""

    dictionaries: list[tuple[bytes, bool]]
    slope: float = 0.0
    shift: float = 0.0


def _blocks(text: str) -> list[bytes]:
    data = text.encode()
    return [data[at : at + BLOCK] for at in range(0, len(data), BLOCK)]


def _dictionary(samples: list[bytes]) -> tuple[bytes, bool]:
    """A trained dictionary, or the samples themselves where the trainer has too few: under 100, or under 40 kB."""
    size = min(DICTIONARY, sum(map(len, samples)) // 10)
    if len(samples) >= 100 and size >= 4096:
        return zstandard.train_dictionary(size, samples).as_bytes(), True
    return b"".join(samples), False


_compressors: dict[int, list[zstandard.ZstdCompressor | None]] = {}


def _compressors_of(model: Model) -> list:
    """The two compressors, made once per worker and model."""
    key = hash(tuple(model.dictionaries))
    if key not in _compressors:
        _compressors.clear()
        made = []
        for content, trained in model.dictionaries:
            kind = zstandard.DICT_TYPE_AUTO if trained else zstandard.DICT_TYPE_RAWCONTENT
            data = zstandard.ZstdCompressionDict(content, dict_type=kind) if content else None
            if data:
                data.precompute_compress(level=LEVEL)
            made.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False, write_dict_id=False))
        _compressors[key] = made
    return _compressors[key]


def size_difference(model: Model, text: str) -> float:
    """(size by bad - size by good) / sum of both; 0 for an empty text."""
    bad, good = _compressors_of(model)
    sizes = [(len(bad.compress(b)), len(good.compress(b))) for b in _blocks(text)]
    with_bad, with_good = sum(s[0] for s in sizes), sum(s[1] for s in sizes)
    return (with_bad - with_good) / max(1, with_bad + with_good)


def scores(model: Model, texts: list[str | None]) -> np.ndarray:
    raw = np.array([size_difference(model, t or "") for t in texts], dtype=float)
    return 1 / (1 + np.exp(-np.clip(model.slope * raw + model.shift, -30, 30)))


def calibrated(raw: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift by Newton steps, with a weak pull of the slope to zero and one row of doubt per class."""
    raw = np.concatenate([raw, [0.0, 0.0]])
    good = np.concatenate([good.astype(float), [0.0, 1.0]])
    x = np.stack([raw, np.ones_like(raw)], axis=1)
    weights = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (p - good) + np.array([1e-4, 0.0]) * weights
        curvature = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1e-4, 1e-9])
        step = np.linalg.solve(curvature, gradient)
        weights -= np.clip(step, -50, 50)
        if np.abs(step).max() < 1e-8:
            break
    return float(weights[0]), float(weights[1])


def fit(docs: DataFrame, labels: DataFrame, rows: int = ROWS, blocks_of_row: int = BLOCKS_OF_ROW) -> Model:
    """Learns from ``labels`` (doc_id, quality) and the texts they name.

    At most ``rows`` labels of each class, chosen by a hash of doc_id, and at most
    ``blocks_of_row`` blocks of each text that goes into a dictionary; labels
    with a null, of other values or without a document are not used. With no
    usable label every score is 0.5; with one class only, the scores lean to it.
    """
    classes = [
        hashed_sample(labels.where(F.col("quality") == q), rows, "quality").withColumn("quality", F.lit(q)) for q in (0, 1)
    ]
    chosen = classes[0].unionByName(classes[1])
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    # At most 2 * rows pairs of numbers, so every task may have them.
    sample = texts.join(F.broadcast(chosen), "doc_id").withColumn(
        "learns", F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(2)) == 0
    )

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[tuple[int, int, int, bytes]] = []
        for doc_id, text, quality in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "text", "quality")], strict=True):
            blocks = _blocks(text)
            step = max(1, -(-len(blocks) // blocks_of_row))
            out += [(quality, doc_id, at, blocks[at]) for at in range(0, len(blocks), step)]
        columns = list(zip(*out, strict=True)) if out else [(), (), (), ()]
        types = (pa.int32(), pa.int64(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["quality", "doc_id", "at", "block"]
        )

    blocks = sorted(
        tuple(r)
        for r in map_batches(
            sample.where("learns"), cut, "quality int, doc_id long, at int, block binary"
        ).collect()
    )
    model = Model([_dictionary([bytes(b[3]) for b in blocks if b[0] == q]) for q in (0, 1)])

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw = [size_difference(model, t) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([pa.array(raw, pa.float64()), batch.column("quality")], names=["raw", "quality"])

    measured = sorted(tuple(r) for r in map_batches(sample.where("not learns"), measure, "raw double, quality int").collect())
    if measured:
        raw, good = np.array(measured).T
        model.slope, model.shift = calibrated(raw, good)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1, higher is better) and predicted (score >= 0.5) of every whole text; null counts as empty.

    An empty text scores what the calibration gives for no difference. Repeated
    rows give repeated rows with one score.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = scores(model, batch.column("text").to_pylist())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(got), pa.array((got >= 0.5).astype(np.int32))],
            names=["doc_id", "score", "predicted"],
        )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return map_batches(rows, run, "doc_id long, score double, predicted int")


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that the model predicts to be good, with all their columns.

    Null and empty texts stay or go by the score of no difference; equal texts,
    repeated rows among them, stay or go together.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(scores(model, batch.column("text").to_pylist()) >= 0.5))

    return docs.mapInArrow(lambda batches: map(run, batches), docs.schema)


def remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the number as text, by ``parts``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts
