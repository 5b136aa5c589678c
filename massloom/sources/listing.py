"""Directory listings of repositories as a table."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from massloom.contracts import LISTING

_SCHEME = r"^[a-z0-9]+:/{0,2}(?=/)"


def read_listing(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A listing exported as Parquet or as CSV with header."""
    reader = spark.read.schema(LISTING)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)


def list_folder(spark: SparkSession, root: str, repository_id: str) -> DataFrame:
    """Listing of a folder Spark can read: paths and lengths, not contents.

    Folders without files are not seen; object stores have none.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    plain = F.regexp_replace("path", _SCHEME, "")
    return found.select(
        F.lit(repository_id).alias("repository_id"),
        F.lit(re.sub(_SCHEME, "", root).rstrip("/") or "/").alias("root_path"),
        plain.alias("path"),
        F.lit(False).alias("is_dir"),
        F.col("length").alias("size_bytes"),
    )
