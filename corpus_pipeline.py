"""A pipeline over ``documents``: drop poor texts, copies and benchmark leaks, then encode what is left.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read back as the next one's docs. All but the last return the
columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from massloom.llm import decontamination, exact_dedup, quality_zstd, sentencepiece_codec, simhash_dedup
from massloom.llm.queries import quality_model, table, tokenizer_model
from massloom.llm.shared import Scratch
from massloom.session import ship_package


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier predicts to be good stay."""
    return quality_zstd.keep_good(docs, quality_model(docs, table(spark, sf_dir, "labels")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space the longest stays, then the smallest doc_id."""
    return exact_dedup.keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints of 3-word shingles that differ in at most 3 bits the smallest doc_id stays."""
    ship_package(spark)
    return simhash_dedup.keep_one(docs, simhash_dedup.simhash_groups(docs))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark stay."""
    return decontamination.drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id with token ids, begin and end included, and the text they decode to."""
    ship_package(spark)
    return sentencepiece_codec.encode(docs.select("doc_id", "text"), tokenizer_model()).select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids", "decoded_text"
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("SimHash near-dedup", near),
    ("benchmark decontamination", decontaminated),
    ("SentencePiece encoding and decoding", tokens),
]

#: A learned classifier and an estimated similarity are no matter for SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; what a later stage has read is removed."""
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = scratch.write(docs, "stage")
            if before is not None:
                scratch.drop(before)
            before = docs
    return docs
