"""Column and dataset profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from massloom.functions.numbers import decimal_text, round3, whole_text
from massloom.sources.tables import union_relaxed

# Parquet physical types by Spark type name; all else is BYTE_ARRAY.
PHYSICAL_TYPES = {
    "boolean": "BOOLEAN",
    "int": "INT32",
    "date": "INT32",
    "bigint": "INT64",
    "timestamp": "INT64",
    "timestamp_ntz": "INT64",
    "float": "FLOAT",
    "double": "DOUBLE",
}


def column_profile(df: DataFrame, dataset_id: str, approximate: bool = False) -> DataFrame:
    """One row per column: position, types, nulls and distinct values.

    Exact counts take one small aggregation per column, which reads that
    column alone and shuffles each of its values once per task; no row is
    multiplied by the number of columns. ``approximate`` makes a sketch per
    column in one pass.
    """

    def line(at: int, distinct: str, nulls: str) -> Column:
        field = df.schema.fields[at]
        logical = field.dataType.simpleString()
        return F.struct(
            F.lit(dataset_id).alias("dataset_id"),
            F.lit(field.name).alias("column_name"),
            F.lit(at + 1).alias("ordinal_position"),
            F.lit(logical).alias("logical_type"),
            F.lit(PHYSICAL_TYPES.get(logical, "BYTE_ARRAY")).alias("physical_type"),
            F.lit(field.nullable).alias("nullable"),
            F.col(distinct).alias("distinct_count"),
            F.coalesce(F.col(nulls), F.lit(0)).alias("null_count"),
        )

    columns = [F.col(f"`{field.name}`") for field in df.schema.fields]
    if approximate:
        aggs = [
            a
            for at, c in enumerate(columns)
            for a in (F.approx_count_distinct(c).alias(f"d{at}"), F.count_if(c.isNull()).alias(f"n{at}"))
        ]
        return df.agg(*aggs).select(F.inline(F.array(*[line(at, f"d{at}", f"n{at}") for at in range(len(columns))])))
    parts = [
        df.select(c.alias("v"))
        .groupBy("v")
        .agg(F.count("*").alias("n"))
        .agg(F.count("v").alias("d"), F.sum(F.when(F.col("v").isNull(), F.col("n"))).alias("nulls"))
        .select(F.inline(F.array(line(at, "d", "nulls"))))
        for at, c in enumerate(columns)
    ]
    return union_relaxed(parts)


def dataset_metrics(df: DataFrame, dataset_id: str, computed_at: Column | None = None) -> DataFrame:
    """Row count, and least, greatest and mean value of each numeric column."""
    aggs: list[Column] = [F.count("*").alias("rows")]

    def line(name: str, text: Column, kind: str) -> Column:
        return F.struct(
            F.lit(dataset_id).alias("dataset_id"),
            F.lit(name).alias("metric_name"),
            text.alias("metric_value"),
            F.lit(kind).alias("metric_type"),
            (computed_at if computed_at is not None else F.current_timestamp()).alias("computed_at"),
        )

    lines = [line("row_count", whole_text(F.col("rows")), "count")]
    for at, field in enumerate(df.schema.fields):
        if not isinstance(field.dataType, NumericType):
            continue
        column = F.col(f"`{field.name}`").cast("double")
        aggs += [F.min(column).alias(f"min{at}"), F.max(column).alias(f"max{at}"), F.avg(column).alias(f"mean{at}")]
        for stat in ("min", "max", "mean"):
            value = decimal_text(round3(F.col(f"{stat}{at}")))
            lines.append(line(f"{field.name}:{stat}", value, stat))
    return df.agg(*aggs).select(F.inline(F.array(*lines)))


def dataset_run(
    df: DataFrame, dataset_id: str, path: str, fmt: str = "parquet", compression: str | None = None
) -> DataFrame:
    """One manifest row: shape, stored size and checksum of a dataset read from files.

    The checksum does not depend on row order: it is the exact sum of the
    64-bit row hashes. One pass: per file first, then over the files.
    """
    files = (
        df.select(F.struct(*[f"`{c}`" for c in df.columns]).alias("_row"), "_metadata.file_path", "_metadata.file_size")
        .groupBy("file_path")
        .agg(
            F.count("*").alias("rows"),
            F.sum(F.xxhash64("_row").cast("decimal(20,0)")).alias("hash"),
            F.max("file_size").alias("bytes"),
        )
    )
    return files.agg(
        F.sum("rows").alias("row_count"), F.sum("bytes").alias("size_bytes"), F.sum("hash").alias("checksum")
    ).select(
        F.lit(dataset_id).alias("dataset_id"),
        F.lit(path).alias("bronze_path"),
        F.lit(fmt).alias("format"),
        F.lit(compression).cast("string").alias("compression"),
        "row_count",
        F.lit(len(df.columns)).alias("column_count"),
        "size_bytes",
        F.col("checksum").cast("string").alias("checksum"),
        F.current_timestamp().alias("created_at"),
        F.to_json(F.struct(F.lit(df.schema.simpleString()).alias("schema"))).alias("metadata_json"),
    )


def stored_files(df: DataFrame) -> DataFrame:
    """One row per stored file of a frame read from files: id, path, size_bytes, created_at, n_rows."""
    return (
        df.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
        .groupBy("file_path")
        .agg(
            F.max("file_size").alias("size_bytes"),
            F.max("file_modification_time").alias("created_at"),
            F.count("*").alias("n_rows"),
        )
        .select(
            F.regexp_extract("file_path", r"([^/]*)\z", 1).alias("id"),
            F.col("file_path").alias("path"),
            "size_bytes",
            "created_at",
            "n_rows",
        )
    )


# Profiles from stored sketches

#: log2 of the number of registers of a distinct-value sketch, and the size of a quantile sketch.
DISTINCT_LG = 14
QUANTILE_K = 400
#: Three standard errors of the distinct estimate: 1.04 / sqrt(2 ** DISTINCT_LG), three times.
DISTINCT_BOUND = 3 * 1.04 / 2 ** (DISTINCT_LG / 2)
#: Rank error of the quantile estimate, by the sketch's own formula for one rank at 99 % confidence.
QUANTILE_BOUND = 2.296 / QUANTILE_K**0.9021


def column_sketches(df: DataFrame, dataset_id: str, by: str | None = None) -> DataFrame:
    """One row per column, and per value of ``by``: counts and sketches, to be stored and merged.

    dataset_id, part (``by`` as text, null without it), ordinal_position,
    column_name, logical_type, n_rows, null_count, distinct (HyperLogLog), and for
    numbers low, high and quantiles (KLL sketch of doubles, NaN left out); all of
    these null where the column has no value. One pass over ``df``, whatever the
    number of columns; what is shuffled is a sketch per column, part and task.
    Values that a sketch cannot take (structs, arrays) go in as their JSON.
    """
    parts = df.withColumn("_part", F.lit(None).cast("string") if by is None else F.col(f"`{by}`").cast("string"))
    aggs: list[Column] = [F.count("*").alias("_rows")]
    lines = []
    for at, field in enumerate(df.schema.fields):
        column, kind = F.col(f"`{field.name}`"), field.dataType.simpleString()
        number = isinstance(field.dataType, NumericType)
        if kind in ("int", "bigint"):
            sketched = column
        elif kind in ("string", "binary"):
            # A sketch takes no notice of empty values.
            sketched = F.concat(F.lit("="), column if kind == "string" else F.hex(column))
        elif kind in ("tinyint", "smallint", "date", "boolean"):
            sketched = column.cast("string")
        elif kind in ("float", "double"):
            # Both zeros are one value, as in a distinct count.
            sketched = F.when(column == 0, F.lit("0.0")).otherwise(column.cast("string"))
        elif kind.startswith(("decimal", "timestamp")):
            sketched = column.cast("string")
        else:
            sketched = F.to_json(F.struct(column.alias("v")))
            sketched = F.when(column.isNotNull(), sketched)
        double = F.when(~F.isnan(column.cast("double")), column.cast("double")) if number else None
        aggs += [F.count_if(column.isNull()).alias(f"n{at}"), F.hll_sketch_agg(sketched, DISTINCT_LG).alias(f"d{at}")]
        if number:
            aggs += [
                F.min(double).alias(f"lo{at}"), F.max(double).alias(f"hi{at}"), F.kll_sketch_agg_double(double, QUANTILE_K).alias(f"q{at}")
            ]
        lines.append(
            F.struct(
                F.lit(dataset_id).alias("dataset_id"),
                F.col("_part").alias("part"),
                F.lit(at + 1).alias("ordinal_position"),
                F.lit(field.name).alias("column_name"),
                F.lit(kind).alias("logical_type"),
                F.col("_rows").alias("n_rows"),
                F.col(f"n{at}").alias("null_count"),
                F.when(F.col(f"n{at}") < F.col("_rows"), F.col(f"d{at}")).alias("distinct"),
                (F.col(f"lo{at}") if number else F.lit(None).cast("double")).alias("low"),
                (F.col(f"hi{at}") if number else F.lit(None).cast("double")).alias("high"),
                (F.when(F.col(f"lo{at}").isNotNull(), F.col(f"q{at}")) if number else F.lit(None).cast("binary")).alias("quantiles"),
            )
        )
    return parts.groupBy("_part").agg(*aggs).select(F.inline(F.array(*lines)))


def merged_profile(sketches: DataFrame, percentages: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Column profile of all parts together from their stored sketches; the rows are not read again.

    dataset_id, column_name, ordinal_position, logical_type, n_rows, null_count,
    distinct_count (estimate, within ``DISTINCT_BOUND`` in 99.7 of 100 cases), low,
    high, quantiles (array for ``percentages``; ranks off by ``QUANTILE_BOUND`` at
    most in 99 of 100 cases; null without numbers).
    """
    wanted = F.array(*[F.lit(float(p)) for p in percentages])
    return (
        sketches.groupBy("dataset_id", "ordinal_position", "column_name", "logical_type")
        .agg(
            F.sum("n_rows").alias("n_rows"),
            F.sum("null_count").alias("null_count"),
            F.hll_union_agg("distinct").alias("_distinct"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            F.kll_merge_agg_double("quantiles", QUANTILE_K).alias("_quantiles"),
        )
        .select(
            "dataset_id", "column_name", "ordinal_position", "logical_type", "n_rows", "null_count",
            F.when(F.col("n_rows") > F.col("null_count"), F.hll_sketch_estimate("_distinct")).otherwise(F.lit(0)).alias("distinct_count"),
            *[F.when(F.col(c) == 0, 0.0).otherwise(F.col(c)).alias(c) for c in ("low", "high")],
            F.when(F.col("low").isNotNull(), F.kll_sketch_get_quantile_double("_quantiles", wanted)).alias("quantiles"),
        )
    )
