"""Tables as an SQL script."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from massloom.contracts import DUMP_TABLES
from massloom.functions.sql_text import create_table_text, insert_line
from massloom.operators.filters import apply_filters
from massloom.sources.tables import parse_filters, read_requests, union_relaxed

#: What a request may ask for.
FORMATS = ("sql", "parquet", "csv")
LINES_DDL = "table_ord int, section int, line string"


def _frame(spark: SparkSession, rows: list[tuple[int, int, str]]) -> DataFrame:
    return spark.createDataFrame(rows, LINES_DDL).coalesce(1)


def insert_lines(name: str, order: int, df: DataFrame, contract: StructType) -> DataFrame:
    shaped = df.select(*contract.names)
    return shaped.select(
        F.lit(order).alias("table_ord"), F.lit(2).alias("section"), insert_line(name, shaped).alias("line")
    )


def dump_lines(
    tables: Mapping[str, DataFrame],
    filters: Mapping[str, Any] | None = None,
    contracts: Mapping[str, StructType] = DUMP_TABLES,
) -> DataFrame:
    """All lines of the script, in the order (table_ord, section).

    Filters apply to every table that has the column. The parts are joined in
    the order of the script, and a union keeps the order of its parts.
    """
    chosen = {name: contracts[name] for name in contracts if name in tables}
    spark = next(iter(tables.values())).sparkSession
    parts = [_frame(spark, [(-1, 0, "-- generated by massloom"), (-1, 1, "BEGIN;"), (-1, 3, "")])]
    for order, (name, contract) in enumerate(chosen.items()):
        parts += [
            _frame(spark, [(order, 0, f"-- table: {name}"), (order, 1, create_table_text(name, contract))]),
            insert_lines(name, order, apply_filters(tables[name], filters), contract),
            _frame(spark, [(order, 3, "")]),
        ]
    return union_relaxed([*parts, _frame(spark, [(len(chosen), 0, "COMMIT;")])])


def write_dump(lines: DataFrame, path: str) -> None:
    """Text files that read in name order give the script.

    ``lines`` as they come from ``dump_lines``: files are numbered in the order
    of the partitions, so nothing is sorted or shuffled. Inside a table the
    order of its INSERT lines is that of the table.
    """
    lines.select("line").write.mode("overwrite").text(path)


def _chosen(tables: Mapping[str, DataFrame], target_tables: str | None) -> dict[str, DataFrame]:
    names = [t.strip() for t in (target_tables or "").split(",") if t.strip()] or list(tables)
    if unknown := [n for n in names if n not in tables]:
        raise ValueError(f"no table {', '.join(unknown)}")
    return {n: tables[n] for n in names}


def answer_request(
    tables: Mapping[str, DataFrame], target_tables: str | None, filters: Mapping[str, Any] | None
) -> DataFrame:
    """Lines for one request: named tables only (comma-separated; none means all)."""
    return dump_lines(_chosen(tables, target_tables), filters)


def answer_requests(tables: Mapping[str, DataFrame], requests_path: str, out: str) -> list[str]:
    """Answers every request below ``requests_path`` in a folder of its own; returns their ids in order.

    ``output_format`` is sql (a script, also where none is given), parquet or
    csv (a folder per table); others are refused before anything is written.
    The requests are control data, one small file each; the tables are read
    and written by Spark only.
    """
    spark = next(iter(tables.values())).sparkSession
    asked = sorted(read_requests(spark, requests_path).collect(), key=lambda r: r.request_id)
    formats = {r.request_id: (r.output_format or "sql").lower() for r in asked}
    if odd := sorted({f for f in formats.values() if f not in FORMATS}):
        raise ValueError(f"output format {', '.join(odd)} is none of {', '.join(FORMATS)}")
    for request in asked:
        chosen, filters = _chosen(tables, request.target_tables), parse_filters(request.filters)
        to = f"{out}/{request.request_id}"
        if formats[request.request_id] == "sql":
            write_dump(dump_lines(chosen, filters), to)
            continue
        for name, table in chosen.items():
            rows = apply_filters(table, filters).select(*DUMP_TABLES[name].names)
            rows.write.mode("overwrite").option("header", True).format(formats[request.request_id]).save(f"{to}/{name}")
    return [r.request_id for r in asked]
