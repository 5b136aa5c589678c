"""Keep the first row per key without windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the least ``order`` per ``key``; columns keep their place.

    An aggregate, not a row number: copies collapse before the shuffle, so a
    key with very many rows costs no more than any other. ``order`` should
    decide alone; the other columns break the ties that are left.
    """
    rest = [c for c in df.columns if c not in key and c not in order]
    least = F.min(F.struct(*order, *rest)).alias("_least")
    return df.groupBy(*key).agg(least).select(
        *[F.col(c) if c in key else F.col("_least")[c].alias(c) for c in df.columns]
    )


def split_repeated(df: DataFrame, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is unique, and the others.

    For wide rows with a key that is nearly always unique: only the key
    columns are shuffled to find the repeated ones, and as a rule those are few
    enough for the optimizer to broadcast, or none at all.
    """
    repeated = df.groupBy(*key).agg(F.count("*").alias("_n")).where(F.col("_n") > 1).select(*key)
    return df.join(repeated, list(key), "left_anti"), df.join(repeated, list(key), "left_semi")
