"""Table contracts: the columns every table must have, in order."""

from __future__ import annotations

from pyspark.sql.types import StructType


def _table(*columns: tuple[str, str] | tuple[str, str, bool]) -> StructType:
    schema = StructType()
    for name, dtype, *rest in columns:
        schema = schema.add(name, dtype, not (rest and rest[0]))
    return schema


REQUIRED = True

REPOSITORIES = _table(
    ("id", "string", REQUIRED),
    ("url", "string", REQUIRED),
    ("doi", "string", REQUIRED),
)

FILES = _table(
    ("id", "string"),
    ("repository_id", "string", REQUIRED),
    ("remote_path", "string", REQUIRED),
    ("size_bytes", "long"),
    ("scan_timestamp", "timestamp"),
)

REPLICATES = _table(
    ("id", "string", REQUIRED),
    ("organism", "string", REQUIRED),
    ("source_type", "string", REQUIRED),
    ("material", "string", REQUIRED),
    ("condition", "string", REQUIRED),
    ("sample_group", "string", REQUIRED),
)

LISTING = _table(
    ("repository_id", "string", REQUIRED),
    ("root_path", "string", REQUIRED),
    ("path", "string", REQUIRED),
    ("is_dir", "boolean", REQUIRED),
    ("size_bytes", "long"),
)

DATASET_MANIFEST = _table(
    ("id", "string", REQUIRED),
    ("path", "string"),
    ("size_bytes", "long"),
    ("created_at", "timestamp"),
)

DATASET_RUN = _table(
    ("dataset_id", "string", REQUIRED),
    ("bronze_path", "string", REQUIRED),
    ("format", "string"),
    ("compression", "string"),
    ("row_count", "long"),
    ("column_count", "integer"),
    ("size_bytes", "long"),
    ("checksum", "string"),
    ("created_at", "timestamp"),
    ("metadata_json", "string"),
)

COLUMN_PROFILE = _table(
    ("dataset_id", "string", REQUIRED),
    ("column_name", "string", REQUIRED),
    ("ordinal_position", "integer"),
    ("logical_type", "string"),
    ("physical_type", "string"),
    ("nullable", "boolean"),
    ("distinct_count", "long"),
    ("null_count", "long"),
)

DATASET_METRICS = _table(
    ("dataset_id", "string", REQUIRED),
    ("metric_name", "string", REQUIRED),
    ("metric_value", "string"),
    ("metric_type", "string"),
    ("computed_at", "timestamp"),
)

DUMP_REQUESTS = _table(
    ("request_id", "string", REQUIRED),
    ("request_timestamp", "timestamp"),
    ("target_tables", "string"),
    ("filters", "string"),
    ("output_format", "string"),
)

# The tables an SQL dump holds, in dump order.
DUMP_TABLES = {
    "repositories": REPOSITORIES,
    "files": FILES,
    "replicates": REPLICATES,
}

CV_PARAM = "struct<accession:string,name:string,value:string>"

# One row per spectrum; scan_seq is the position in the run file.
SPECTRA_DDL = (
    "basename string, scan_seq bigint, scan_number bigint, ms_level int, "
    "scan_time_min double, mz array<double>, intensity array<double>, "
    f"cv array<{CV_PARAM}>, precursors array<struct<cv:array<{CV_PARAM}>>>"
)
