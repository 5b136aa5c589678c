"""Scan metadata: parameters, parent link and peak statistics per scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from massloom.functions import cv as terms
from massloom.functions import peaks
from massloom.functions.numbers import decimal_text, round3, whole_text
from massloom.operators.asof import last_marked
from massloom.operators.firsts import first_per_key, split_repeated
from massloom.session import durable

# Accession and name of the computed rows, in output order.
PARENT = ("parent:ms1", "Parent MS1 scan")
PEAK_ROWS = {
    "peak_count": ("peak_count", "Number of peaks on the scan"),
    "int_min": ("peak_intensity:min", "Min Intensity"),
    "int_max": ("peak_intensity:max", "Max Intensity"),
    "int_avg": ("peak_intensity:avg", "Average Intensity"),
    "int_median": ("peak_intensity:median", "Median Intensity"),
    "sep_min": ("peak_separation:min", "Min Separantion of peaks"),
    "sep_max": ("peak_separation:max", "Max Separantion of peaks"),
    "sep_avg": ("peak_separation:avg", "Avg Separantion of peaks"),
    "sep_median": ("peak_separation:median", "Median Separantion of peaks"),
}
MIN_FOR_MEDIAN = 3  # medians need more values than this
DEFAULT_PARENT = 1
COMPUTED_FROM = 1_000_000  # position of the first computed row of a scan


def peak_stats(spectra: DataFrame, intensity_median_above: int = 0, gap_median_above: int = 0) -> DataFrame:
    """Adds peak_count, int_* and sep_* columns; everything stays in the row.

    Intensities are sorted raw: logarithms keep order, so the least, greatest
    and middle values need one logarithm each, and only the mean needs all.
    """
    ordered = F.sort_array(peaks.usable(F.col("intensity")))
    mz = F.sort_array(F.coalesce(F.col("mz"), F.array().cast("array<double>")))
    n = F.size("_ordered")
    logs = F.aggregate("_ordered", F.lit(0.0), lambda acc, x: acc + peaks.log_of(x))
    gap_count = F.size("_gaps")
    return (
        spectra.withColumn("_ordered", ordered)
        .withColumn("_gaps", F.sort_array(peaks.gaps(mz)))
        .withColumn("peak_count", n)
        .withColumn("int_min", peaks.log_of(F.get("_ordered", F.lit(0))))
        .withColumn("int_max", peaks.log_of(F.get("_ordered", n - 1)))
        .withColumn("int_avg", F.when(n > 0, logs / n))
        .withColumn(
            "int_median",
            F.when(n > intensity_median_above, peaks.sorted_median(F.col("_ordered"), peaks.log_of)),
        )
        .withColumn("sep_min", F.get("_gaps", F.lit(0)))
        .withColumn("sep_max", F.get("_gaps", gap_count - 1))
        .withColumn("sep_avg", peaks.array_mean(F.col("_gaps")))
        .withColumn("sep_median", F.when(gap_count > gap_median_above, peaks.sorted_median(F.col("_gaps"))))
        .drop("_ordered", "_gaps")
    )


def parent_scans(spectra: DataFrame) -> DataFrame:
    """basename, scan_seq, scan_number, ms_level and the latest MS1 scan so far."""
    narrow = spectra.select("basename", "scan_seq", "scan_number", "ms_level").where(
        F.col("ms_level").isNotNull()
    )
    linked = last_marked(narrow, "basename", "scan_seq", F.col("ms_level") == 1, "scan_number", "parent_scan")
    return linked.withColumn("parent_scan", F.coalesce("parent_scan", F.lit(DEFAULT_PARENT).cast("bigint")))


def _row(pos: Column | int, accession, name, value: Column, number: Column | None = None) -> Column:
    return F.struct(
        (F.lit(pos) if isinstance(pos, int) else pos).alias("pos"),
        (F.lit(accession) if isinstance(accession, str) else accession).alias("accession"),
        (F.lit(name) if isinstance(name, str) else name).alias("name"),
        value.alias("value"),
        (F.lit(None) if number is None else number).cast("double").alias("value_num"),
    )


def _first_in_scan(cv: Column) -> Column:
    """Reportable parameters, of each accession the first in document order."""
    given = terms.reportable(cv)
    known = F.transform(given, lambda p: p["accession"])
    return F.filter(given, lambda p, i: F.array_position(known, p["accession"]) == i + 1)


def _scan_rows(spectra: DataFrame) -> DataFrame:
    """Parameters and peak statistics of each scan, as one array ``rows``."""
    computed = []
    for at, (column, (accession, name)) in enumerate(PEAK_ROWS.items()):
        value = F.col(column) if column == "peak_count" else round3(F.col(column))
        text = whole_text(value) if column == "peak_count" else decimal_text(value)
        computed.append(_row(COMPUTED_FROM + at, accession, name, text, value))
    given = F.transform(
        "_given", lambda p, i: _row(i, p["accession"], p["name"], p["value"])
    )
    return (
        peak_stats(spectra, MIN_FOR_MEDIAN, MIN_FOR_MEDIAN)
        .withColumn("_given", _first_in_scan(F.coalesce("cv", F.array())))
        .select("basename", "scan_number", "scan_seq", F.concat(given, F.array(*computed)).alias("rows"))
    )


def _exploded(scans: DataFrame) -> DataFrame:
    rows = scans.select("basename", "scan_number", "scan_seq", F.inline("rows"))
    return rows.where((F.col("pos") < COMPUTED_FROM) | F.col("value_num").isNotNull())


def scan_metadata(spectra: DataFrame, ms_level: int) -> DataFrame:
    """One row per scan and accession for the scans of one MS level.

    Of repeated accessions the first in document order counts, also where a
    run uses a scan number twice. The rows of a scan are made in place and
    written once, as an array, so that the peaks are read once; only scans with
    a repeated number and the parent links are shuffled.
    """
    key = ["basename", "scan_number"]
    made = durable(_scan_rows(spectra.where(F.col("ms_level") == ms_level)), "scan-rows")
    unique, repeated = split_repeated(made, key)
    columns = [*key, "accession", "name", "value", "value_num"]
    rows = _exploded(unique).select(*columns).unionByName(
        first_per_key(_exploded(repeated), [*key, "accession"], ["scan_seq", "pos"]).select(*columns)
    )
    if ms_level != 2:
        return rows
    parents = (
        parent_scans(spectra)
        .where(F.col("ms_level") == 2)
        .groupBy(*key)
        .agg(F.min_by("parent_scan", "scan_seq").alias("parent"))
    )
    accession, name = PARENT
    return rows.unionByName(
        parents.select(
            *key,
            F.lit(accession).alias("accession"),
            F.lit(name).alias("name"),
            whole_text(F.col("parent")).alias("value"),
            F.col("parent").cast("double").alias("value_num"),
        )
    )


def scans_written(rows: DataFrame) -> DataFrame:
    """Rows and distinct scans per run of a scan table."""
    return rows.groupBy("basename").agg(
        F.count("*").alias("n_rows"), F.count_distinct("scan_number").alias("n_scans")
    )
