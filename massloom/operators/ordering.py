"""Row numbers and running totals for groups of any size.

A window with ``partitionBy(group)`` sends a whole group to one task. Here the
rows are range-partitioned on group and order, so a group that holds a third
of the table is spread over a third of the tasks; each task numbers its own
rows and the small table of pieces supplies the offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from massloom.session import durable


def ordered_pieces(df: DataFrame, group: Sequence[str], order: Sequence[Column], pieces: int | None = None) -> DataFrame:
    """``df`` in order, with ``_piece`` (partition) and ``_pos`` (place in it).

    The result is written to the shared folder: positions must not change
    between the two reads that follow, whatever happens to an executor.
    """
    keys = [*[F.col(c) for c in group], *order]
    ranged = df.repartitionByRange(pieces, *keys) if pieces else df.repartitionByRange(*keys)
    placed = ranged.sortWithinPartitions(*keys).withColumn("_pos", F.monotonically_increasing_id())
    return durable(placed.withColumn("_piece", F.shiftright("_pos", 33).cast("int")), "ordered")


def number_rows(df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """Row numbers from 1 per group; ``order`` must be unique within a group."""
    placed = ordered_pieces(df, group, order)
    earlier = Window.partitionBy(*group).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(*group, "_piece")
        .agg(F.min("_pos").alias("_first"), F.count("*").alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .drop("_rows")
    )
    return (
        placed.join(starts, [*group, "_piece"])
        .withColumn(name, F.col("_pos") - F.col("_first") + F.col("_before") + 1)
        .drop("_pos", "_piece", "_first", "_before")
    )


def running_total(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], value: Column, name: str
) -> DataFrame:
    """Sum of ``value`` over the rows before this one in the group."""
    placed = ordered_pieces(df.withColumn("_value", value), group, order)
    before = Window.partitionBy(*group).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    inside = (
        Window.partitionBy(*group, "_piece").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        placed.groupBy(*group, "_piece")
        .agg(F.sum("_value").alias("_sum"))
        .withColumn("_carry", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
        .drop("_sum")
    )
    return (
        placed.join(carried, [*group, "_piece"])
        .withColumn(name, F.coalesce(F.sum("_value").over(inside), F.lit(0)) + F.col("_carry"))
        .drop("_value", "_pos", "_piece", "_carry")
    )
