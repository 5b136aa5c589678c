"""Backward as-of lookup: the last marked row at or before each row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 65_536


def last_marked(
    df: DataFrame,
    group: str,
    position: str,
    marked: Column,
    value: str,
    name: str,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Adds ``name``: ``value`` of the latest row with ``marked`` so far.

    A run of any length is cut into blocks of positions. Inside a block an
    ordinary window carries the value forward; across blocks the last value of
    each block is carried over a table ``block_rows`` times smaller.

    Every row stays. One without position stands nowhere: it neither gives a
    value to others nor gets one. Rows without group are a group of their own.
    """
    blocked = df.withColumn("_block", F.floor(F.col(position) / block_rows)).withColumn(
        "_marked", F.when(marked & F.col(position).isNotNull(), F.col(value))
    )
    inside = (
        Window.partitionBy(group, "_block").orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    )
    earlier = Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        blocked.groupBy(group, "_block")
        .agg(
            F.max_by("_marked", F.when(F.col("_marked").isNotNull(), F.col(position))).alias("_last"),
        )
        .withColumn("_carry", F.last("_last", ignorenulls=True).over(earlier))
        .drop("_last")
    )
    carried = carried.select(F.col(group).alias("_of"), F.col("_block").alias("_in"), "_carry")
    same = F.col(group).eqNullSafe(F.col("_of")) & F.col("_block").eqNullSafe(F.col("_in"))
    found = F.when(F.col(position).isNotNull(), F.coalesce("_seen", "_carry"))
    return (
        blocked.withColumn("_seen", F.last("_marked", ignorenulls=True).over(inside))
        .join(carried, same, "left")
        .withColumn(name, found)
        .drop("_block", "_marked", "_seen", "_of", "_in", "_carry")
    )
