"""Helpers that several text operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from massloom.session import scratch_path

#: White space as the operators on words understand it: blank, tab to carriage return.
WHITE = r"[\x20\x09-\x0D]"
#: Values that a hash for drawing a sample can take.
DRAWS = 1 << 40


def whole_text(name: str = "text") -> Column:
    """The text column; a null text counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """A helper column's name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    name = f"_{name}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def hashed_sample(ids: DataFrame, size: int, salt: str) -> DataFrame:
    """At most ``size`` distinct values of doc_id, those with the smallest hashes; null is left out.

    A bound on the hash, set from the number of values, leaves about twice as
    many as are wanted, so the last step sorts a bounded table at any scale.
    """
    one = ids.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.lit(DRAWS))
    bound = DRAWS * 2 * size // max(one.count(), 1)
    return one.where(drawn <= bound).orderBy(drawn, "doc_id").limit(size)


def each_value(broadcasts: Sequence[Broadcast]) -> Iterator[Any]:
    """The values one after another; a task that has several holds one at a time."""
    for broadcast in broadcasts:
        yield broadcast.value
        if len(broadcasts) > 1:
            broadcast.__dict__.pop("_value", None)


class Scratch:
    """Tables written in the shared folder; each can be removed once nothing reads it."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self._paths: dict[int, str] = {}

    def write(self, df: DataFrame, label: str) -> DataFrame:
        """Writes ``df`` and reads it back: the lineage ends here."""
        path = scratch_path(self.spark, label)
        df.write.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(back)] = path
        return back

    def drop(self, table: DataFrame) -> None:
        """Removes a table that ``write`` returned and no later step reads."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self._paths.pop(id(table)))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def map_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table | None], schema: str
) -> DataFrame:
    """``function`` over Arrow batches; a batch may give several or none."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            made = function(batch)
            if isinstance(made, pa.Table):
                yield from made.to_batches()
            elif made is not None:
                yield made

    return df.mapInArrow(run, schema)
