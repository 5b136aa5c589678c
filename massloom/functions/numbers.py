"""Column expressions that turn numbers into text and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Size units, each 1024 times the one before.
SIZE_UNITS = ["B", "KB", "MB", "GB", "TB", "PB"]


def human_size(size: Column) -> Column:
    """Size with one decimal and a unit; the unit is chosen before rounding.

    Rounds half to even (``format_string`` alone would round 1.25 up).
    """
    text = F.when(size.isNull(), F.lit(""))
    for step, unit in enumerate(SIZE_UNITS):
        scaled = F.format_string("%.1f " + unit, F.bround(size.cast("double") / F.lit(float(1024**step)), 1))
        if unit == SIZE_UNITS[-1]:
            return text.otherwise(scaled)
        text = text.when(size < F.lit(1024 ** (step + 1)), scaled)
    return text


def zero_padded(number: Column, width: int) -> Column:
    """At least ``width`` digits; longer numbers stay whole."""
    text = number.cast("bigint").cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def to_number(text: Column) -> Column:
    return text.try_cast("double")


def round3(value: Column) -> Column:
    return F.round(value, 3)


def decimal_text(value: Column) -> Column:
    """A number rounded to three digits as plain text: 5.0, 0.25, 12000000.0."""
    fixed = value.try_cast("decimal(38,3)").cast("string")
    return F.regexp_replace(fixed, r"0{1,2}\z", "")


def whole_text(value: Column) -> Column:
    return value.cast("bigint").cast("string")
