"""Column expressions on controlled-vocabulary parameter arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from massloom.functions.numbers import to_number

# Vocabulary terms the jobs read.
TERMS = {
    "tic": "MS:1000285",
    "mz_high": "MS:1000500",
    "mz_low": "MS:1000501",
    "isolation_target": "MS:1000827",
    "isolation_lower": "MS:1000828",
    "isolation_upper": "MS:1000829",
    "selected_mz": "MS:1000744",
    "collision_energy": "MS:1000045",
    "ms_level": "MS:1000511",
    "scan_start": "MS:1000016",
    "mz_array": "MS:1000514",
    "intensity_array": "MS:1000515",
    "float32": "MS:1000521",
    "zlib": "MS:1000574",
}

# Terms that describe encoding, never reported per scan.
TECHNICAL_TERMS = [
    "MS:1000521",
    "MS:1000515",
    "MS:1000514",
    "MS:1000574",
    "MS:1000579",
    "MS:1000580",
    "MS:1000795",
]


def last_value(cv: Column, accession: str) -> Column:
    """Value of the last parameter with this accession, or null."""
    return F.try_element_at(F.filter(cv, lambda p: p["accession"] == accession), F.lit(-1))["value"]


def last_number(cv: Column, accession: str) -> Column:
    return to_number(last_value(cv, accession))


def has_term(cv: Column, accession: str) -> Column:
    return F.coalesce(F.exists(cv, lambda p: p["accession"] == accession), F.lit(False))


def reportable(cv: Column) -> Column:
    """Named, non-technical parameters in document order."""
    return F.filter(
        cv,
        lambda p: p["accession"].isNotNull() & (p["accession"] != "") & ~p["accession"].isin(TECHNICAL_TERMS),
    )
