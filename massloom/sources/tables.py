"""CSV and Parquet sources for the catalogue tables."""

from __future__ import annotations

import csv
import json
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from massloom.functions.names import is_blank
from massloom.functions.types import as_type, common_type
from massloom.sources.files import first_lines


def csv_headers(spark: SparkSession, path: str | list[str]) -> list[tuple[str, tuple[str, ...] | None]]:
    """(file, column names) of every CSV file, in order of the files; None for a file without a line.

    Tasks read the first line of each file and no more. The driver, which lists
    the files of any read anyhow, holds each distinct header once, beside the
    names of its files.
    """
    lines = first_lines(spark, path).groupBy("line").agg(F.sort_array(F.collect_list("path")).alias("files"))
    found: list[tuple[str, tuple[str, ...] | None]] = []
    for row in lines.collect():
        header = None if row["line"] is None else tuple(next(csv.reader([row["line"]])))
        found += [(file, header) for file in row["files"]]
    return sorted(found, key=lambda x: x[0])


def _read_alike(spark: SparkSession, files: list[str]) -> DataFrame:
    return spark.read.option("header", True).option("escape", '"').csv(files, inferSchema=False)


def read_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV files with headers, every column text: an id ``007`` keeps its zeros.

    Each file is read by its own header: files with equal headers in one go,
    and columns are matched by name, null where a file lacks them.
    """
    alike: dict[tuple[str, ...], list[str]] = {}
    for file, header in csv_headers(spark, path):
        if header is not None:
            alike.setdefault(header, []).append(file)
    if not alike:
        return _read_alike(spark, [path] if isinstance(path, str) else path)
    return union_relaxed([_read_alike(spark, files) for files in alike.values()])


def source_name(file: str) -> str:
    """The file's name without folder and suffix."""
    return file.rsplit("/", 1)[-1].removesuffix(".csv")


def read_by_source(
    spark: SparkSession, path: str | list[str], contract: T.StructType, source: str = "accession"
) -> tuple[DataFrame, DataFrame]:
    """Rows of the files that have all contract columns, and one line per file.

    The rows carry ``source``, the file's name; the lines are (source, missing
    column names), all of them for a file without a header. Every file is read
    by its own header.
    """
    alike: dict[tuple[str, ...], list[str]] = {}
    lines = []
    for file, header in csv_headers(spark, path):
        missing = [c for c in contract.names if c not in (header or ())]
        lines.append((source_name(file), missing))
        if not missing:
            alike.setdefault(header, []).append(file)
    named = F.regexp_replace(F.url_decode(F.col("_metadata.file_name")), r"\.csv\z", "").alias(source)
    frames = [_read_alike(spark, files).select(*contract.names, named) for files in alike.values()]
    nothing = spark.createDataFrame([], ", ".join(f"{c} string" for c in [*contract.names, source]))
    heads = spark.createDataFrame(lines, f"{source} string, missing array<string>")
    return union_relaxed(frames or [nothing]), heads


def read_table(spark: SparkSession, path: str, contract: T.StructType, by: str | None = None) -> DataFrame:
    """All Parquet files below ``path``; an empty table where there are none.

    Columns are matched by name, missing ones are null, and files with a
    narrower number type are widened to the contract's. ``by`` is a text column
    that the table is partitioned by.
    """
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in contract.fields])
    if by:
        nullable = nullable.add(by, "string")
    try:
        return spark.read.schema(nullable).option("recursiveFileLookup", by is None).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], nullable)


def union_relaxed(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name, in order of first appearance; missing columns are null.

    A column has the narrowest type that holds its values of all frames: numbers
    are widened, a number beside a text becomes text, structs and arrays are
    brought together field by field (``functions/types.py``).
    """
    spark = frames[0].sparkSession
    fold = str if spark.conf.get("spark.sql.caseSensitive") == "true" else str.lower
    names: dict[str, str] = {}
    kinds: dict[str, T.DataType] = {}
    for frame in frames:
        for field in frame.schema.fields:
            key = fold(field.name)
            names.setdefault(key, field.name)
            kinds[key] = common_type(kinds[key], field.dataType) if key in kinds else field.dataType

    def shaped(frame: DataFrame) -> DataFrame:
        own = {fold(f.name): f for f in frame.schema.fields}
        columns = []
        for key, name in names.items():
            column = as_type(frame[f"`{own[key].name}`"], own[key].dataType, kinds[key]) if key in own else F.lit(None).cast(kinds[key])
            columns.append(column.alias(name))
        return frame.select(*columns)

    return reduce(DataFrame.unionAll, map(shaped, frames))


def sized_samples(files: DataFrame) -> DataFrame:
    """Ids and sizes of the sample files; filter and columns reach the scan."""
    return files.where(F.col("id").isNotNull() & ~is_blank(F.col("id"))).select("id", "size_bytes")


def replicate_ids(replicates: DataFrame) -> DataFrame:
    return replicates.select("id").where(F.col("id").isNotNull())


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """Dump requests, one JSON object per line; id from the file name if absent."""
    schema = "request_id string, request_timestamp timestamp, target_tables string, filters string, output_format string"
    raw = spark.read.schema(schema).json(path)
    from_name = F.regexp_replace(F.col("_metadata.file_name"), r"\.request\z", "")
    return raw.withColumn("request_id", F.coalesce("request_id", from_name))


def parse_filters(text: str | None) -> dict:
    return json.loads(text) if text else {}
