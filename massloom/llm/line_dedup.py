"""Removes lines that are spread over many sites: boilerplate.

How many distinct sites show a line is estimated by a HyperLogLog sketch per
line, merged by aggregation. Where the estimate is too near the threshold to
decide, the sites of those lines are counted exactly. Blank lines always stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from massloom.llm.shared import Scratch, whole_text

#: A line on at least so many sites is boilerplate.
MIN_SITES = 5
#: log2 of a sketch's buckets, and the relative error beyond which an estimate decides (over 7 standard errors).
SKETCH_BITS, MARGIN = 12, 0.2


def _lines() -> Column:
    return F.split(whole_text(), "\n")


def _key(line: Column) -> Column:
    """The line without white space at its ends."""
    return F.trim(line, F.lit(" \t\r\x0b\f"))


def wide_lines(docs: DataFrame, scratch: Scratch, min_sites: int) -> DataFrame:
    """(one, two): the 128-bit hashes of lines on at least ``min_sites`` distinct sites.

    A line that a single site shows needs no sketch: smallest and largest site
    are equal. The pairs of line and site are made distinct where they are
    read, before any of them is joined, so a line that a third of all documents
    hold arrives as a few rows.
    """
    line = F.explode(F.array_distinct(F.transform(_lines(), _key))).alias("line")
    pairs = (
        docs.where(F.col("source").isNotNull())
        .select(F.col("source").cast("string").alias("site"), line)
        .where("line <> ''")
        .select(F.xxhash64("line").alias("one"), F.xxhash64(F.lit("line"), "line").alias("two"), "site")
    )
    spread = (
        pairs.groupBy("one", "two")
        .agg(F.min(F.xxhash64("site")).alias("low"), F.max(F.xxhash64("site")).alias("high"))
        .where("low < high")
        .select("one", "two")
    )
    shared = scratch.write(pairs.distinct().join(spread, ["one", "two"], "left_semi"), "line-sites")
    estimated = scratch.write(
        shared.groupBy("one", "two").agg(
            F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(SKETCH_BITS))).alias("sites")
        ),
        "line-estimates",
    )
    sure = estimated.where(F.col("sites") > min_sites * (1 + MARGIN)).select("one", "two")
    close = estimated.where(F.col("sites").between(min_sites * (1 - MARGIN), min_sites * (1 + MARGIN)))
    exact = (
        shared.join(close, ["one", "two"], "left_semi")
        .groupBy("one", "two")
        .agg(F.count_distinct("site").alias("sites"))
        .where(F.col("sites") >= min_sites)
        .select("one", "two")
    )
    return scratch.write(sure.unionByName(exact), "wide-lines")


def drop_wide_lines(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """doc_id, text without boilerplate lines, n_lines and n_removed for every row of ``docs``.

    A site is a value of ``source``; a document without one shows its lines to
    no site, but loses them like any other. A null text counts as empty: one
    blank line. Removal takes all occurrences. Repeated rows give repeated
    rows. Other columns of ``docs`` are not read.
    """
    scratch = Scratch(docs.sparkSession)
    wide = wide_lines(docs, scratch, min_sites)
    row = F.monotonically_increasing_id()
    texts = scratch.write(docs.select("doc_id", whole_text().alias("text"), row.alias("_row")), "line-texts")
    at = F.posexplode(F.transform(_lines(), _key)).alias("at", "line")
    removed = (
        texts.select("_row", at)
        .where("line <> ''")
        .select("_row", "at", F.xxhash64("line").alias("one"), F.xxhash64(F.lit("line"), "line").alias("two"))
        .join(wide, ["one", "two"], "left_semi")
        .groupBy("_row")
        .agg(F.collect_list("at").alias("removed"))
    )
    count = F.size(_lines())
    stay = F.array_except(F.sequence(F.lit(0), count - 1), F.coalesce("removed", F.array().cast("array<int>")))
    return (
        texts.join(removed, "_row", "left")
        .select("doc_id", count.alias("n_lines"), stay.alias("stay"), _lines().alias("lines"))
        .select(
            "doc_id",
            F.array_join(F.transform("stay", lambda i: F.element_at(F.col("lines"), i + 1)), "\n").alias("text"),
            F.col("n_lines").cast("long").alias("n_lines"),
            (F.col("n_lines") - F.size("stay")).cast("long").alias("n_removed"),
        )
    )
