"""Row filters given as data."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def apply_filters(df: DataFrame, filters: Mapping[str, Any] | None) -> DataFrame:
    """Keep rows that satisfy every term: a list means IN, a scalar means equal.

    Terms on columns the frame does not have are skipped.
    """
    terms = [
        F.col(f"`{name}`").isin(value) if isinstance(value, list) else F.col(f"`{name}`") == F.lit(value)
        for name, value in (filters or {}).items()
        if name in df.columns
    ]
    return df.where(reduce(lambda a, b: a & b, terms)) if terms else df
