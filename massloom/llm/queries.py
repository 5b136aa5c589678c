"""Registered queries of the text operators: (spark, table folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from massloom.llm import (
    decontamination,
    exact_dedup,
    label_sharding,
    language_id,
    license_scan,
    line_dedup,
    page_extract,
    phrase_mining,
    quality_zstd,
    secret_crf,
    sentencepiece_codec,
    shared_search,
    simhash_dedup,
)
from massloom.session import ship_package

#: The merge-type vocabulary the queries use.
VOCABULARY = "piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_model() -> bytes:
    return sentencepiece_codec.read_model(public_tokenizers.path(VOCABULARY))


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """64-bit fingerprint and connected component of every document."""
    return simhash_dedup.simhash_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.hex("code")).alias("fingerprint"), "component_id"
    )


def op2_label_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, shards 0 to 23."""
    return label_sharding.assign_shards(table(spark, sf_dir, "documents"), 24).drop("gid")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, assignments as whole matches."""
    docs = table(spark, sf_dir, "documents")
    return secret_crf.scan(docs, secret_crf.fit(docs), whole=True)


def quality_model(docs: DataFrame, labels: DataFrame) -> quality_zstd.Model:
    """Learned from the labels outside the held-out third."""
    return quality_zstd.fit(docs, labels.where(quality_zstd.remainder(F.col("doc_id"), 3) != 1))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    return quality_zstd.score(docs, model).select(
        "doc_id", (quality_zstd.remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted"
    )


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row that stays for every document, equal texts being equal without white space."""
    return exact_dedup.duplicate_groups(table(spark, sf_dir, "documents")).drop("n_chars")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every occurrence of a benchmark passage in a document, within its edit budget."""
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded text of every document."""
    return sentencepiece_codec.digests(table(spark, sf_dir, "documents"), tokenizer_model())


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines removed from every document as boilerplate of many sources, with a digest of the text left."""
    return line_dedup.drop_wide_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.col("text"), 256).alias("text_sha256")
    )


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every license notice in a document, with its differences from the known wording."""
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents")
    held_out = quality_zstd.remainder(F.col("doc_id"), 4) == 2
    model = language_id.fit(docs.where(~held_out))
    return language_id.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents for each benchmark item."""
    return shared_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 20)


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 strongest phrases of each language."""
    return phrase_mining.collocations(table(spark, sf_dir, "documents"), 2000)


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return page_extract.extract(pages, page_extract.fit(pages)).select("page_id", "url", "text", "n_chars")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash_near_dedup,
        op2_label_sharding,
        op3_secret_scan,
        op4_quality_classifier,
        op5_exact_dedup,
        op6_decontamination,
        op7_sentencepiece,
        op8_line_dedup,
        op9_license_scan,
        op10_language_id,
        op11_ranked_search,
        op12_phrase_mining,
        op13_html_extraction,
    )
}
