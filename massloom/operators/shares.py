"""Shares of a total with the small groups folded into one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from massloom.session import durable

DEFAULT_THRESHOLD = 0.02


def fold_small(
    grouped: DataFrame,
    cut: Sequence[str],
    label: str = "label",
    value: str = "value",
    threshold: Column | float = DEFAULT_THRESHOLD,
    keep_single: bool = False,
) -> DataFrame:
    """Per cut: labels at or above the threshold, the rest as ``Other (N groups)``.

    ``grouped`` has one row per cut and label. A single small group keeps its
    own label; a cut whose total is not positive stays as it is; a cut with
    only one group is left out unless ``keep_single``. Totals are an aggregate
    joined back, not a window, so a cut with very many labels is not held by
    one task. The grouped rows, far fewer than the data behind them, are
    written once, so that both sides of that join do not group the data again.
    """
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    known = durable(grouped.where(F.col(label).isNotNull()), "groups")
    totals = known.groupBy(*cut).agg(F.sum(value).alias("_total"), F.count("*").alias("_groups"))
    if not keep_single:
        totals = totals.where(F.col("_groups") > 1)
    small = (F.col("_total") > 0) & (F.col(value).cast("double") / F.col("_total").cast("double") < limit)
    folded = (
        known.join(totals, list(cut))
        .withColumn("_small", F.coalesce(small, F.lit(False)))
        .groupBy(*cut, "_small", F.when(~F.col("_small"), F.col(label)).alias("_label"))
        .agg(
            F.sum(value).alias(value),
            F.count("*").alias("_n"),
            F.min(label).alias("_own"),
            F.max("_total").alias("total"),
        )
    )
    is_other = F.col("_small") & (F.col("_n") > 1)
    return folded.select(
        *cut,
        F.when(is_other, F.format_string("Other (%d groups)", "_n")).otherwise(F.col("_own")).alias(label),
        value,
        "total",
        is_other.alias("is_other"),
    )


def with_shares(folded: DataFrame, cut: Sequence[str], label: str = "label", value: str = "value") -> DataFrame:
    """Adds ``pct``, its legend text and ``rank`` (largest first, Other last).

    At most 1/threshold labels are left per cut after folding, so the rank
    window is small; with a threshold of 0 it holds all labels. A cut without a positive total has no shares and is not
    folded; its rows get no rank and are kept out of that window.
    """
    positive = F.coalesce(F.col("total") > 0, F.lit(False))
    pct = F.when(positive, F.lit(100.0) * F.col(value).cast("double") / F.col("total").cast("double"))
    by_size = Window.partitionBy(*cut, F.when(~positive, F.col(label))).orderBy(
        "is_other", F.col(value).desc(), label
    )
    return (
        folded.withColumn("pct", pct)
        .withColumn(
            "legend",
            F.when(positive, F.format_string("%s (%.1f%%)", F.col(label), F.bround("pct", 1))),
        )
        .withColumn("rank", F.when(positive, F.row_number().over(by_size)))
    )
