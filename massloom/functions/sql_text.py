"""SQL text built from rows and schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# SQL column types by Spark type name.
SQL_TYPES = {
    "string": "TEXT",
    "boolean": "BOOLEAN",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "float": "REAL",
    "double": "DOUBLE PRECISION",
    "timestamp": "TIMESTAMP",
}


def _quoted(text: Column) -> Column:
    return F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("''")), F.lit("'"))


def sql_literal(column: Column, dtype: T.DataType) -> Column:
    """The SQL literal of a value; NaN and infinities are quoted."""
    if isinstance(dtype, T.BooleanType):
        text = F.when(column, F.lit("TRUE")).when(~column, F.lit("FALSE"))
    elif isinstance(dtype, (T.FloatType, T.DoubleType)):
        odd = F.isnan(column) | F.abs(column).eqNullSafe(F.lit(float("inf")))
        text = F.when(odd, _quoted(column.cast("string"))).otherwise(column.cast("string"))
    elif isinstance(dtype, T.NumericType):
        text = column.cast("string")
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        # Six fraction digits, or none at all on whole seconds.
        stamp = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        text = _quoted(F.regexp_replace(stamp, r"\.000000\z", ""))
    else:
        text = _quoted(column.cast("string"))
    return F.coalesce(text, F.lit("NULL"))


def insert_line(table: str, df: DataFrame) -> Column:
    """One INSERT statement per row of ``df``."""
    names = ", ".join(df.columns)
    values = F.concat_ws(", ", *[sql_literal(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields])
    return F.concat(F.lit(f"INSERT INTO {table} ({names}) VALUES ("), values, F.lit(");"))


def create_table_text(table: str, schema: T.StructType) -> str:
    lines = [
        f"    {f.name} {SQL_TYPES.get(f.dataType.simpleString(), 'TEXT')}{'' if f.nullable else ' NOT NULL'}"
        for f in schema.fields
    ]
    return f"CREATE TABLE IF NOT EXISTS {table} (\n" + ",\n".join(lines) + "\n);\n"
