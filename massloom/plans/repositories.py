"""Repository jobs: manifest ingest, file inventory, summaries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from massloom.contracts import REPOSITORIES
from massloom.functions.numbers import human_size, zero_padded
from massloom.operators import inventory, quality
from massloom.operators.ordering import number_rows
from massloom.sources.tables import read_csv


def ingest(
    raw: DataFrame, per: str | None = None, heads: DataFrame | None = None, store: Callable[[DataFrame], DataFrame] | None = None
) -> tuple[DataFrame, DataFrame]:
    """The ``repositories`` table and the report of all checks on its input.

    With ``per`` (a column with the input file) faults stay with their file:
    the table holds the rows of the files without any, and ``per``. ``heads``
    (per, missing) tells which columns a file lacks and which files there are.
    ``store`` writes the report and reads it back, so that the table does not make
    it again.
    """
    report = quality.check_table(raw, REPOSITORIES, per=per)
    if quality.missing_columns(raw, REPOSITORIES):
        quality.strict(report)
    if heads is not None:
        report = report.unionByName(quality.file_faults(raw, heads, per))
    if store:
        report = store(report)
    good = quality.passing(raw, report, per) if per else raw
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in REPOSITORIES.fields]
    return good.select(*typed, *([per] if per else [])), report


def load_manifest(spark: SparkSession, csv_path: str) -> DataFrame:
    """The table, or ``QualityError`` naming every check that failed."""
    table, report = ingest(read_csv(spark, csv_path))
    quality.strict(report)
    return table


def build_files(listing: DataFrame, scan_timestamp: Column | None = None) -> DataFrame:
    """The ``files`` table of a listing: rolled up, pruned, fused, classified."""
    stamp = F.current_timestamp() if scan_timestamp is None else scan_timestamp
    return inventory.classify(inventory.fuse(inventory.contributions(listing)), stamp)


def samples_summary(files: DataFrame) -> DataFrame:
    """Sample files with empty annotation columns, for all repositories at once.

    ``sample_group`` numbers the samples of a repository by path.
    """
    samples = files.where(F.col("id").isNotNull()).select("repository_id", "id", "remote_path", "size_bytes")
    numbered = number_rows(samples, ["repository_id"], [F.col("remote_path")], "_number")
    empty = F.lit(None).cast("string")
    return numbered.select(
        "repository_id",
        "id",
        empty.alias("organism"),
        empty.alias("source_type"),
        empty.alias("material"),
        empty.alias("condition"),
        F.concat(F.lit("sample-"), zero_padded(F.col("_number"), 4)).alias("sample_group"),
        "size_bytes",
        human_size(F.col("size_bytes")).alias("size"),
        "remote_path",
    )


def other_summary(files: DataFrame) -> DataFrame:
    return files.where(F.col("id").isNull()).select(
        "repository_id", human_size(F.col("size_bytes")).alias("size"), "size_bytes", "remote_path"
    )
