"""Data-quality checks, reported as one table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from massloom.functions.names import is_blank

REPORT_DDL = "check string, column string, n_bad bigint, sample string"


class QualityError(ValueError):
    """Input that does not meet its contract."""


def missing_columns(df: DataFrame, contract: StructType) -> list[str]:
    """Contract columns the frame lacks; looks at names only, reads no rows."""
    return sorted(set(contract.names) - set(df.columns))


def _line(check: str, column: str, n_bad: Column, sample: Column | None = None) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(column).alias("column"),
        F.coalesce(n_bad, F.lit(0)).cast("bigint").alias("n_bad"),
        (F.lit(None) if sample is None else sample).cast("string").alias("sample"),
    )


def check_table(
    raw: DataFrame, contract: StructType, key: str = "id", whole_rows: bool = True, per: str | None = None
) -> DataFrame:
    """All checks on ``raw``: rows, nulls, blanks, casts, repeated rows and keys.

    Rows are first counted per distinct content. That one shuffle serves the
    repeated-row check, and all others then run on distinct rows with weights.
    Without ``whole_rows`` they are counted per key, and only keys are shuffled.
    With ``per`` the report has one set of lines for each value of that column,
    such as the input file; keys then need to be unique within it only.
    """
    absent = missing_columns(raw, contract)
    if absent:
        rows = [("missing_column", name, 1, None) for name in absent]
        return raw.sparkSession.createDataFrame(rows, REPORT_DDL)

    by = [per] if per else []
    rows = raw.select(*by, *contract.names)
    if whole_rows:
        rows = rows.groupBy(*by, *contract.names).agg(F.count("*").alias("_n"))
    weight = F.col("_n") if whole_rows else F.lit(1)
    lines = [_line("no_rows", "*", (F.coalesce("rows", F.lit(0)) == 0).cast("int"))]
    sums: dict[str, Column] = {"rows": weight}
    leasts: dict[str, Column] = {}
    for field in contract.fields:
        value = F.col(field.name)
        if not field.nullable:
            sums[f"null_{field.name}"] = F.when(value.isNull(), weight)
            lines.append(_line("null", field.name, F.col(f"null_{field.name}")))
        if not field.nullable and isinstance(field.dataType, StringType):
            sums[f"blank_{field.name}"] = F.when(is_blank(value), weight)
            lines.append(_line("blank", field.name, F.col(f"blank_{field.name}")))
        if not isinstance(field.dataType, StringType):
            failed = value.isNotNull() & value.try_cast(field.dataType).isNull()
            sums[f"cast_{field.name}"] = F.when(failed, weight)
            leasts[f"bad_{field.name}"] = F.when(failed, value.cast("string"))
            lines.append(_line("cast", field.name, F.col(f"cast_{field.name}"), F.col(f"bad_{field.name}")))
    if whole_rows:
        sums["copies"] = weight - 1
        lines.append(_line("duplicate_row", "*", F.col("copies")))
        distinct = rows
    else:
        distinct = rows.groupBy(*by, key).agg(
            F.count("*").alias("_n"), *[F.sum(c).alias(k) for k, c in sums.items()], *[F.min(c).alias(k) for k, c in leasts.items()]
        )
        sums, leasts = ({k: F.col(k) for k in found} for found in (sums, leasts))
    aggs = [F.sum(c).alias(k) for k, c in sums.items()] + [F.min(c).alias(k) for k, c in leasts.items()]
    if not whole_rows:
        # In the same aggregate, so that the rows are read once.
        again = F.when(F.col("_n") > 1, F.col(key))
        lines.append(_line("duplicate_key", key, F.col("n"), F.col("least")))
        found = distinct.groupBy(*by).agg(*aggs, F.count(again).alias("n"), F.min(again).alias("least")).select(*by, F.inline(F.array(*lines)))
        return found.where((F.col("check") != "duplicate_key") | (F.col("n_bad") > 0)) if per else found
    by_row = distinct.groupBy(*by).agg(*aggs).select(*by, F.inline(F.array(*lines)))

    # Null keys are left to count() rather than to a filter, which would be
    # pushed below the first aggregate and keep its shuffle from being shared.
    repeated = distinct.groupBy(*by, key).agg(F.sum("_n").alias("_n")).where(F.col("_n") > 1)
    by_key = (
        repeated.groupBy(*by)
        .agg(F.count(key).alias("n"), F.min(key).alias("least"))
        .where((F.col("n") > 0) if per else F.lit(True))
        .select(*by, F.inline(F.array(_line("duplicate_key", key, F.col("n"), F.col("least")))))
    )
    return by_row.unionByName(by_key)


def duplicate_keys(df: DataFrame, key: str = "id") -> DataFrame:
    """Every key that occurs more than once, with its number of rows."""
    counted = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    return counted.where(F.col("n") > 1)


def passing(rows: DataFrame, report: DataFrame, per: str) -> DataFrame:
    """Rows of the inputs without any fault."""
    return rows.join(report.where(F.col("n_bad") > 0).select(per).distinct(), per, "left_anti")


def lookup_counts(wanted: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Wanted keys that match no row or several rows of ``table``."""
    found = table.groupBy(key).agg(F.count("*").alias("n_rows"))
    return (
        wanted.select(key)
        .distinct()
        .join(found, key, "left")
        .select(key, F.coalesce("n_rows", F.lit(0)).alias("n_rows"))
        .where(F.col("n_rows") != 1)
    )


def file_faults(rows: DataFrame, heads: DataFrame, source: str) -> DataFrame:
    """Report lines of files that lack columns, and of complete ones without a row."""
    absent = heads.select(source, F.explode("missing").alias("column")).select(
        source, F.lit("missing_column").alias("check"), "column", F.lit(1).cast("bigint").alias("n_bad"), F.lit(None).cast("string").alias("sample")
    )
    bare = heads.where(F.size("missing") == 0).join(rows.select(source).distinct(), source, "left_anti")
    return absent.unionByName(
        bare.select(
            source, F.lit("no_rows").alias("check"), F.lit("*").alias("column"), F.lit(1).cast("bigint").alias("n_bad"), F.lit(None).cast("string").alias("sample")
        )
    )


def strict(report: DataFrame) -> None:
    """Raise if any check failed.

    The message has one entry per check and column, with the total and one
    example, however many inputs the report covers.
    """
    example = F.struct(*[F.col(c) for c in report.columns if c not in ("check", "column", "n_bad")])
    failed = (
        report.where(F.col("n_bad") > 0)
        .groupBy("check", "column")
        .agg(F.sum("n_bad").alias("n_bad"), F.min(example).alias("example"))
        .orderBy("check", "column")
        .collect()
    )
    if failed:
        raise QualityError(
            "; ".join(
                f"{r['check']}({r['column']}): {r['n_bad']}"
                + "".join(f", {k} {v}" for k, v in [*reversed(r["example"].asDict().items())] if v is not None and k != "sample")
                + (f", e.g. {r['example']['sample']}" if r["example"]["sample"] else "")
                for r in failed
            )
        )


def cast_to(raw: DataFrame, contract: StructType) -> DataFrame:
    """Contract columns in contract order and type; bad values become null.

    The cast check of ``check_table`` counts what would be lost.
    """
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in contract.fields])
