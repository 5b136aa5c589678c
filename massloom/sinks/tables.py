"""Parquet and CSV sinks."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from massloom.functions.numbers import zero_padded
from massloom.session import passing_shuffles, remove


def write_repositories(df: DataFrame, path: str) -> None:
    """One dataset; a file per repository would be a table of tiny files."""
    df.write.mode("overwrite").parquet(path)


def _clustered(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows of a value together and in order.

    One shuffle by hash, whose partitions Spark evens out when it knows their
    sizes: small ones are merged, and one that a large value fills is cut, so
    that many tasks write it, each a file in order.
    """
    return df.hint("rebalance", *[F.col(c) for c in by]).sortWithinPartitions(*by, *order)


def write_partitioned(df: DataFrame, path: str, by: str, order: Sequence[str] = ()) -> None:
    """Replaces just the partitions that ``df`` holds; rows pass one shuffle and are written once."""
    (
        _clustered(df, [by], order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(by)
        .parquet(path)
    )


def remove_partitions(spark: SparkSession, path: str, by: str, values: Sequence[str]) -> None:
    """Removes the rows of these values of ``by`` from a table that ``write_partitioned`` wrote, if it has any."""
    try:
        table = spark.read.schema(f"`{by}` string").option("basePath", path).parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return
    # Partition folders are found by their value, whatever way Spark has spelled it.
    held = table.where(F.col(by).isin(*values)).select(F.col("_metadata.file_path").alias("file")).distinct()
    for row in held.collect():
        remove(spark, unquote(row["file"]))


def write_runs(df: DataFrame, path: str, order: Sequence[str] = ("scan_number",), by: str = "basename") -> None:
    """zstd Parquet with a partition per run, sorted inside; other runs of the table are left alone."""
    write_partitioned(df, path, by, order)


def append_new(df: DataFrame, path: str, by: str, order: Sequence[str] = ()) -> None:
    """Writes the values of ``by`` that the table does not hold yet; those it holds stay as they are.

    Values are partitions, so what is stored is known without reading a row.
    """
    spark = df.sparkSession
    try:
        stored = spark.read.parquet(path).select(by).distinct()
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    else:
        df = not_yet_done(df, stored.select(F.col(by).cast(df.schema[by].dataType).alias(by)), by)
    write_partitioned(df, path, by, order)


def write_csv_by(df: DataFrame, path: str, by: Sequence[str], order: Sequence[str]) -> None:
    """CSV with header, one folder per value of ``by``, rows of a file in ``order``.

    Tasks move their own files to their places, since there may be very many: the
    driver would do so one by one. A task that is repeated writes the same names.
    """
    with passing_shuffles(df.sparkSession):
        (
            _clustered(df, by, order)
            .write.mode("overwrite")
            .option("mapreduce.fileoutputcommitter.algorithm.version", "2")
            .partitionBy(*by)
            .csv(path, header=True)
        )


def split_label(accession: str = "accession", split: str = "split_id"):
    return F.concat_ws("_", F.col(accession), zero_padded(F.col(split), 3))


def write_splits(df: DataFrame, path: str) -> None:
    """One CSV folder per split, named ``accession_000``."""
    labelled = df.withColumn("split", split_label()).drop("accession", "split_id")
    write_csv_by(labelled, path, ["split"], ["id"])


def not_yet_done(new: DataFrame, done: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows whose key has no output yet."""
    keys = [key] if isinstance(key, str) else list(key)
    return new.join(done.select(*keys), keys, "left_anti")
