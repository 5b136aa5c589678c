"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from massloom.llm.shared import Scratch


def _hooked(links: DataFrame) -> DataFrame:
    """Each ``a`` and all its ``b`` to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    near = links.join(least, "a").select(F.col("b").alias("a"), "m").where("a <> m")
    return near.unionByName(least.select("a", "m")).select("a", F.col("m").alias("b")).distinct()


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, component) for every id that ``links`` (a, b) name; component is the smallest id reachable.

    Alternates two steps until nothing changes: every id sends its larger
    neighbours to its smallest one, then every id sends itself and its smaller
    neighbours there. Each is an aggregation and a join, so an id with many
    links is pre-aggregated and its rows are split as any skewed join's. The
    number of rounds grows with the logarithm of the longest chain. Each round
    is written to the shared folder and the one before it removed.
    """
    bigger, smaller = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    current = scratch.write(links.where("a <> b").select(bigger, smaller).distinct(), "links")
    before = None
    while True:
        state = tuple(
            current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.count_distinct("a")).first()
        )
        # One link per id, to one that has none itself, is what neither step changes.
        if state == before or state[0] == 0:
            break
        before = state
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        following = scratch.write(_hooked(large), "links")
        scratch.drop(current)
        current = following
    roots = current.select(F.col("b").alias("id")).distinct()
    return current.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        roots.select("id", F.col("id").alias("component"))
    )
