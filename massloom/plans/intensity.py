"""Intensity distribution of every scan: histogram and quantile profile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from massloom.functions import peaks
from massloom.operators.firsts import first_per_key, split_repeated
from massloom.session import durable

SCAN = ["basename", "scan_number"]
HEAD = ["basename", "scan_number", "ms_level", "peaks", "min_mz", "max_mz", "min_int", "max_int"]


def scan_heads(spectra: DataFrame) -> DataFrame:
    """Peak count, m/z range and log-intensity range, next to the intensities."""
    raw = peaks.usable(F.col("intensity"))
    return spectra.select(
        *SCAN,
        "scan_seq",
        "ms_level",
        F.size(raw).alias("peaks"),
        F.array_min("mz").alias("min_mz"),
        F.array_max("mz").alias("max_mz"),
        F.coalesce(peaks.log_of(F.array_min(raw)), F.lit(0.0)).alias("min_int"),
        F.coalesce(peaks.log_of(F.array_max(raw)), F.lit(0.0)).alias("max_int"),
        "intensity",
    )


def _first_scans(narrow: DataFrame) -> DataFrame:
    """One row per run and scan number, the first in the file, without ``scan_seq``.

    ``narrow`` holds what was made of the peaks, a few hundred numbers per
    scan. It is written once, so that the peaks are read once; looking for
    repeated numbers then reads two columns of it.
    """
    made = durable(narrow, "scan-counts")
    unique, repeated = split_repeated(made, SCAN)
    return unique.unionByName(first_per_key(repeated, SCAN, ["scan_seq"])).drop("scan_seq")


def _levelled(spectra: DataFrame) -> DataFrame:
    return spectra.select(*SCAN, "scan_seq", "ms_level", "mz", "intensity").where(F.col("ms_level").isNotNull())


def histogram(spectra: DataFrame) -> DataFrame:
    """Scan heads with ``under``, ``over`` and the array of 100 bin counts."""
    counted = scan_heads(_levelled(spectra)).select(
        *HEAD, "scan_seq", peaks.histogram_slots(F.col("intensity")).alias("slots")
    )
    return _first_scans(counted).select(
        *HEAD,
        F.get("slots", F.lit(0)).alias("under"),
        F.get("slots", F.lit(peaks.HISTOGRAM_BINS + 1)).alias("over"),
        F.slice("slots", 2, peaks.HISTOGRAM_BINS).alias("bins"),
    )


def histogram_long(counts: DataFrame) -> DataFrame:
    """One row per scan and non-empty bin with its edges."""
    low = F.lit(peaks.HISTOGRAM_LOW) + F.lit(peaks.BIN_WIDTH) * F.col("bin")
    return (
        counts.select("basename", "scan_number", F.posexplode_outer("bins").alias("bin", "n"))
        .where(F.col("n") > 0)
        .select("basename", "scan_number", "bin", low.alias("lo"), (low + F.lit(peaks.BIN_WIDTH)).alias("hi"), "n")
    )


def histogram_wide(counts: DataFrame) -> DataFrame:
    """One column per bin, named by bin index: ibin_00 to ibin_99."""
    bins = [f"get(bins, {b}) AS ibin_{b:02d}" for b in range(peaks.HISTOGRAM_BINS)]
    return counts.selectExpr(*HEAD, "under", "over", *bins)


def quantiles(spectra: DataFrame) -> DataFrame:
    """Scan heads with the array of 101 log-intensity quantiles; null without peaks."""
    profiled = (
        scan_heads(_levelled(spectra))
        .withColumn("_ordered", F.sort_array(peaks.usable(F.col("intensity"))))
        .select(*HEAD, "scan_seq", peaks.quantile_profile(F.col("_ordered")).alias("quantiles"))
    )
    return _first_scans(profiled).select(*HEAD, "quantiles")


def quantiles_long(profiles: DataFrame) -> DataFrame:
    # An outer explode: the plain one adds a filter on the array, which the
    # optimizer would push down together with a second copy of its computation.
    percentages = peaks.percentages()
    exploded = profiles.select("basename", "scan_number", F.posexplode_outer("quantiles").alias("quantile", "value"))
    return exploded.where(F.col("quantile").isNotNull()).select("basename", "scan_number", "quantile", F.get(percentages, F.col("quantile")).alias("percent"), "value")


def quantiles_wide(profiles: DataFrame) -> DataFrame:
    """One column per quantile, named by position: p_000 to p_100."""
    columns = [f"get(quantiles, {i}) AS p_{i:03d}" for i in range(len(peaks.PERCENTAGES))]
    return profiles.selectExpr(*HEAD, *columns)
