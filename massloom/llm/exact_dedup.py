"""Exact deduplication with a heavy-hitter split.

Texts are equal when identical without their white space. Misra-Gries counters
(``DataFrame.freqItems``) name the digests that may hold more than a given
share of the rows. Exact counts verify them; the winners are few by
construction, are broadcast, and take their rows out of the data on the map
side. All other digests go through an ordinary shuffle, where no group can hold
more than that share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from massloom.llm.shared import WHITE, Scratch, fresh, whole_text

#: Share of all rows from which a digest counts as heavy; at most 1 / SHARE are.
SHARE = 0.001


def normal_digest(text):
    """SHA-256 of the text without white space, lower-case hex."""
    return F.sha2(F.regexp_replace(text, f"{WHITE}+", ""), 256)


def heavy_winners(rows: DataFrame, share: float) -> DataFrame:
    """The best row and size of each digest that holds ``share`` of the rows, and two at least."""
    candidates = rows.freqItems(["text_sha256"], share).select(
        F.explode("text_sha256_freqItems").alias("text_sha256")
    )
    least = F.greatest(F.lit(2), F.ceil(F.lit(share) * F.lit(rows.count())))
    return rows.join(F.broadcast(candidates), "text_sha256").groupBy("text_sha256").agg(*_best()).where(
        F.col("group_size") >= least
    )


def _rank():
    # Bitwise negation turns "smallest" into "largest" and cannot overflow.
    return F.struct("n_chars", F.bitwise_not("doc_id").alias("d"), F.bitwise_not("_row").alias("r"))


def _best():
    return F.max(_rank()).alias("_top"), F.count("*").alias("group_size")


def duplicate_groups(docs: DataFrame, share: float = SHARE) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, n_chars.

    Of equal texts the row with the most code points stays, then the one with
    the smallest doc_id; a null doc_id comes last. A null text is an empty one
    and all empty texts are equal. Of rows repeated with one doc_id and text
    exactly one is marked as kept. Other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    text = whole_text()
    rows = scratch.write(
        docs.select(
            F.col("doc_id"),
            normal_digest(text).alias("text_sha256"),
            F.char_length(text).alias("n_chars"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "digests",
    )
    winners = scratch.write(heavy_winners(rows, share), "heavy-digests")
    heavy = rows.join(F.broadcast(winners), "text_sha256")
    same = Window.partitionBy("text_sha256")
    light = rows.join(F.broadcast(winners.select("text_sha256")), "text_sha256", "left_anti").select(
        "*", F.max(_rank()).over(same).alias("_top"), F.count("*").over(same).alias("group_size")
    )
    return heavy.unionByName(light).select(
        "doc_id",
        F.bitwise_not("_top.d").alias("keep_id"),
        "group_size",
        (F.bitwise_not("_top.r") == F.col("_row")).alias("kept"),
        "text_sha256",
        "n_chars",
    )


def keep_first(docs: DataFrame, share: float = SHARE) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Decisions are made on digests alone; the texts are moved once, to meet
    them. The rules are those of ``duplicate_groups``.
    """
    key, turn = fresh(docs, "key"), fresh(docs, "turn")

    def key_of(doc_id, digest):
        return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), digest)

    stay = (
        duplicate_groups(docs, share)
        .where("kept")
        .select(key_of(F.col("doc_id"), F.concat_ws("-", "text_sha256", "n_chars")).alias(key))
    )
    text = whole_text()
    marked = docs.withColumn(
        key, key_of(F.col("doc_id"), F.concat_ws("-", normal_digest(text), F.char_length(text)))
    )
    first = Window.partitionBy(key).orderBy(key)
    return (
        marked.join(stay, key)
        .withColumn(turn, F.row_number().over(first))
        .where(F.col(turn) == 1)
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
