"""Checksums that any engine can compute: rows to buckets to tables, and where two tables differ.

A row's digest is the MD5 of a text in which every value has one form, in every
engine: whole numbers in decimal, floating ones as exponent and whole mantissa,
instants as microseconds, texts with their length ahead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Hexadecimal digits that are added up as one number, and those that name a bucket.
PART_DIGITS = 15
BUCKET_DIGITS = 7
BUCKETS = 1024


def float_text(value: Column) -> Column:
    """A double as ``exponent:mantissa``, exact and the same in every engine; both zeros are ``0``.

    The exponent guessed by the logarithm is put right by comparing with powers
    of two, which are exact; scaling by them is exact too.
    """
    size = F.abs(value)
    two = F.lit(2.0)
    # Two halves, since the least doubles need a factor that is no double itself.
    guess = F.floor(F.log2(size)).cast("int")
    half = F.floor(-guess / 2).cast("int")
    scaled = size * F.pow(two, half) * F.pow(two, -guess - half)
    exponent = guess + F.when(scaled >= 2, 1).when(scaled < 1, -1).otherwise(0)
    mantissa = scaled * F.when(scaled >= 2, 0.5).when(scaled < 1, 2.0).otherwise(1.0) * F.lit(float(2**52))
    finite = F.concat(
        F.when(value < 0, F.lit("-")).otherwise(F.lit("")), exponent.cast("string"), F.lit(":"), mantissa.cast("bigint").cast("string")
    )
    return (
        F.when(F.isnan(value), F.lit("nan"))
        .when(size == float("inf"), F.when(value < 0, F.lit("-inf")).otherwise(F.lit("inf")))
        .when(value == 0, F.lit("0"))
        .when(value.isNotNull(), finite)
    )


def value_text(column: Column, kind: T.DataType) -> Column:
    """The one form of a value as text; nested values take the form of JSON, which is Spark's own."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return float_text(column.cast("double"))
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column).cast("string")
    if isinstance(kind, T.BinaryType):
        return F.lower(F.hex(column))
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType, T.VariantType)):
        return F.to_json(F.struct(column.alias("v")))
    return column.cast("string")


def row_digest(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """MD5 (32 hexadecimal digits) over the values of ``columns``, all by default, in this order.

    A value goes in as its number of characters, a colon and its text, null as
    ``n``, so that no two rows share a text unless they are equal.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    parts = []
    for name in df.columns if columns is None else columns:
        text = value_text(F.col(f"`{name}`"), kinds[name])
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("n")))
    return F.md5(F.concat(F.lit(""), *parts))


def _number(digest: Column, start: int, digits: int) -> Column:
    return F.conv(F.substring(digest, start, digits), 16, 10).cast("decimal(20,0)")


def bucket_of(key_digest: Column, buckets: int = BUCKETS) -> Column:
    return (_number(key_digest, 1, BUCKET_DIGITS).cast("bigint") % buckets).cast("int")


def _hashed(df: DataFrame, key: Sequence[str], buckets: int) -> DataFrame:
    return df.withColumn("_row", row_digest(df)).withColumn("_bucket", bucket_of(row_digest(df, key), buckets))


def bucket_digests(df: DataFrame, key: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """One row per bucket that has rows: bucket, n_rows, digest.

    Rows go to buckets by their key, so that a changed row stays in its bucket.
    Row digests are added up in two numbers of 60 bits: the order of rows does
    not matter, repeated rows count, sums are combined within the task, and at
    most ``buckets`` rows a task are shuffled.
    """
    row = F.col("_row")
    sums = _hashed(df, key, buckets).groupBy(F.col("_bucket").alias("bucket")).agg(
        F.count("*").alias("n_rows"),
        F.sum(_number(row, 1, PART_DIGITS).cast("decimal(28,0)")).alias("first"),
        F.sum(_number(row, PART_DIGITS + 1, PART_DIGITS).cast("decimal(28,0)")).alias("second"),
    )
    return sums.select("bucket", "n_rows", F.concat_ws(":", F.col("first").cast("string"), F.col("second").cast("string")).alias("digest"))


def table_digest(buckets: DataFrame, dataset_id: str) -> DataFrame:
    """One row from ``bucket_digests``: dataset_id, n_rows, n_buckets, digest; of an empty table the MD5 of nothing."""
    lines = F.sort_array(F.collect_list(F.struct("bucket", F.concat_ws(" ", "bucket", "n_rows", "digest").alias("line"))))
    text = F.array_join(F.transform(lines, lambda x: x["line"]), "\n")
    return buckets.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_buckets"), F.md5(text).alias("digest")
    ).select(F.lit(dataset_id).alias("dataset_id"), "n_rows", "n_buckets", "digest")


def differing_buckets(before: DataFrame, after: DataFrame) -> DataFrame:
    """Buckets of two ``bucket_digests`` that are not alike: bucket, rows_before, rows_after."""
    old = before.select("bucket", F.col("n_rows").alias("rows_before"), F.col("digest").alias("_old"))
    new = after.select("bucket", F.col("n_rows").alias("rows_after"), F.col("digest").alias("_new"))
    return (
        old.join(new, "bucket", "full")
        .where(~F.col("_old").eqNullSafe(F.col("_new")))
        .select("bucket", F.coalesce("rows_before", F.lit(0)).alias("rows_before"), F.coalesce("rows_after", F.lit(0)).alias("rows_after"))
    )


def differing_keys(
    before: DataFrame, after: DataFrame, key: Sequence[str], buckets: int = BUCKETS, stored: tuple[DataFrame, DataFrame] | None = None
) -> DataFrame:
    """Keys whose rows are not the same in both tables: key columns, change (added, removed, changed).

    Only rows of differing buckets are shuffled; ``stored`` gives the
    ``bucket_digests`` of both tables where they have been kept. A key may have
    several rows and null parts: the rows of a key are compared as a bag.
    Columns named like the helpers (``_row``, ``_bucket``, ``_side``) are not allowed.
    """
    old, new = stored or (bucket_digests(before, key, buckets), bucket_digests(after, key, buckets))
    wanted = differing_buckets(old, new).select(F.col("bucket").alias("_bucket"))

    def side(df: DataFrame, sign: int) -> DataFrame:
        rows = _hashed(df, key, buckets).join(wanted, "_bucket", "left_semi")
        return rows.select(*[f"`{k}`" for k in key], F.lit(sign).alias("_side"), "_row")

    row = F.col("_row")
    first, second = (_number(row, at, PART_DIGITS).cast("decimal(28,0)") for at in (1, PART_DIGITS + 1))
    both = side(before, -1).unionByName(side(after, 1)).groupBy(*[f"`{k}`" for k in key]).agg(
        F.count_if(F.col("_side") < 0).alias("_before"),
        F.count_if(F.col("_side") > 0).alias("_after"),
        F.sum(first * F.col("_side")).alias("_first"),
        F.sum(second * F.col("_side")).alias("_second"),
    )
    change = F.when(F.col("_before") == 0, F.lit("added")).when(F.col("_after") == 0, F.lit("removed")).otherwise(F.lit("changed"))
    unlike = (F.col("_first") != 0) | (F.col("_second") != 0) | (F.col("_before") != F.col("_after"))
    return both.where(unlike).select(*[f"`{k}`" for k in key], change.alias("change"))
