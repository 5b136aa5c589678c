"""Run metadata: header parameters and run-level statistics as EAV rows."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from massloom.functions.cv import TERMS, last_number
from massloom.functions.numbers import decimal_text, round3, to_number, whole_text
from massloom.operators.firsts import first_per_key
from massloom.plans.scan_metadata import peak_stats

EAV_COLUMNS = ["basename", "accession", "name", "value", "group"]
SPREAD = ["min", "max", "avg", "std"]

# Fixed values: (group, measure) -> what is reported: statistic, accession, name.
# A measure is a number taken per scan or per precursor.
REPORTED: dict[tuple[str, str], list[tuple[str, str, str]]] = {
    ("summary", "spectra"): [("sum", "summary:spectrum_count", "total_spectrum_count")],
    ("ms1", "spectra"): [("sum", "ms1:spectrum_count", "ms1_spectrum_count")],
    ("ms2", "spectra"): [("sum", "ms2:spectrum_count", "ms2_spectrum_count")],
    ("summary", "scan_time"): [
        ("min", "summary:first_scan_time_minutes", "first_scan_time_minutes"),
        ("max", "summary:last_scan_time_minutes", "last_scan_time_minutes"),
        ("seconds", "summary:total_run_time_seconds", "total_run_time_seconds"),
    ],
    ("ms1", "mz_low"): [("min", "ms1:mz_low_min", "ms1_mz_low_min")],
    ("ms1", "mz_high"): [("max", "ms1:mz_high_max", "ms1_mz_high_max")],
    ("ms1", "mz_window"): [("avg", "ms1:mz_window_avg", "ms1_mz_window_avg")],
    ("ms2", "mz_low"): [("min", "ms2:mz_low_min", "ms2_mz_low_min")],
    ("ms2", "mz_high"): [("max", "ms2:mz_high_max", "ms2_mz_high_max")],
    ("ms2", "mz_window"): [("avg", "ms2:mz_window_avg", "ms2_mz_window_avg")],
    ("ms2", "isolation_lower"): [
        ("min", "ms2:isolation_lower_offset_min", "ms2_isolation_lower_offset_min")
    ],
    ("ms2", "isolation_upper"): [
        ("max", "ms2:isolation_upper_offset_max", "ms2_isolation_upper_offset_max")
    ],
    ("summary", "peak_separation_min"): [("min", "summary:peak_separation_min", "peak_separation_min")],
    ("summary", "peak_separation_max"): [("max", "summary:peak_separation_max", "peak_separation_max")],
    ("summary", "peak_separation_avg"): [("avg", "summary:peak_separation_avg", "peak_separation_avg")],
    ("summary", "peak_separation_median"): [
        ("avg", "summary:peak_separation_median", "peak_separation_median")
    ],
    ("summary", "peak_intensity_min"): [("min", "summary:peak_intensity_min", "peak_intensity_min")],
    ("summary", "peak_intensity_max"): [("max", "summary:peak_intensity_max", "peak_intensity_max")],
    ("summary", "peak_intensity_avg"): [("avg", "summary:peak_intensity_avg", "peak_intensity_avg")],
    ("summary", "peak_intensity_median"): [
        ("avg", "summary:peak_intensity_median", "peak_intensity_median")
    ],
}
# Measures reported with all four spread statistics.
SPREAD_BLOCKS = [
    ("summary", "tic"),
    ("ms1", "tic"),
    ("ms2", "tic"),
    ("summary", "precursor_mz"),
    ("ms2", "collision_energy"),
    ("ms2", "isolation_target_mz"),
    ("ms2", "isolation_window"),
    ("summary", "peak_count"),
    ("ms1", "peak_count"),
    ("ms2", "peak_count"),
]
for _group, _measure in SPREAD_BLOCKS:
    REPORTED[_group, _measure] = [
        (stat, f"{_group}:{_measure}_{stat}", f"{_measure}_{stat}") for stat in SPREAD
    ]
ACQUISITION = ("acquisition:type", "Heuristic adquisition", "acquisition")
DIA_MIN_WINDOWS = 10
DIA_MIN_WIDTH = 4.0


def header_rows(headers: DataFrame, terms_table: DataFrame | None = None) -> DataFrame:
    """Header parameters as EAV rows.

    ``headers``: basename, seq, group, kind, accession, name, value. A missing
    name is looked up in ``terms_table`` (accession, term), else the accession
    stands in. A missing value of a vocabulary parameter is its own name.
    """
    if terms_table is None:
        named = headers.withColumn("term", F.lit(None).cast("string"))
    else:
        named = headers.join(terms_table.select("accession", "term"), "accession", "left")
    is_cv, is_user = F.col("kind") == "cv", F.col("kind") == "user"
    user_name = F.coalesce(F.nullif(F.col("name"), F.lit("")), F.lit("user_param"))
    given = F.nullif(F.col("name"), F.lit(""))
    return named.where(
        ~is_cv | (F.col("accession").isNotNull() & (F.col("accession") != ""))
    ).select(
        "basename",
        F.when(is_cv, F.col("accession"))
        .when(is_user, F.concat_ws(":", F.lit("user"), F.col("group"), user_name))
        .otherwise(F.concat(F.lit("info:"), F.col("name")))
        .alias("accession"),
        F.when(is_cv, F.coalesce(given, F.col("term"), F.col("accession")))
        .when(is_user, user_name)
        .otherwise(F.col("name"))
        .alias("name"),
        F.when(is_cv, F.coalesce("value", "name")).otherwise(F.col("value")).alias("value"),
        "group",
        "seq",
    )


def dedupe_header(rows: DataFrame) -> DataFrame:
    """First row per run and accession by group, then by place in the file."""
    return first_per_key(rows, ["basename", "accession"], ["group", "seq"]).select(*EAV_COLUMNS)


def _measure(group: Column | str, name: str, value: Column) -> Column:
    return F.struct(
        (F.lit(group) if isinstance(group, str) else group).alias("group"),
        F.lit(name).alias("measure"),
        value.cast("double").alias("x"),
    )


def _precursor_measures() -> Column:
    """Numbers of all precursors of an MS2 scan, as (group, measure, x) structs."""
    kinds = {
        TERMS["isolation_target"]: ("ms2", "isolation_target_mz"),
        TERMS["isolation_lower"]: ("ms2", "isolation_lower"),
        TERMS["isolation_upper"]: ("ms2", "isolation_upper"),
        TERMS["selected_mz"]: ("summary", "precursor_mz"),
        TERMS["collision_energy"]: ("ms2", "collision_energy"),
    }

    def single(param: Column) -> Column:
        group, measure = F.lit(None).cast("string"), F.lit(None).cast("string")
        for accession, (g, m) in kinds.items():
            hit = param["accession"] == accession
            group, measure = F.when(hit, F.lit(g)).otherwise(group), F.when(hit, F.lit(m)).otherwise(measure)
        return F.struct(group.alias("group"), measure.alias("measure"), to_number(param["value"]).alias("x"))

    def last_known(cv: Column, accession: str) -> Column:
        return F.try_element_at(
            F.filter(
                F.transform(F.filter(cv, lambda p: p["accession"] == accession), lambda p: to_number(p["value"])),
                lambda x: x.isNotNull(),
            ),
            F.lit(-1),
        )

    def of_precursor(p: Column) -> Column:
        width = last_known(p["cv"], TERMS["isolation_lower"]) + last_known(p["cv"], TERMS["isolation_upper"])
        known = F.filter(p["cv"], lambda q: q["accession"].isin(list(kinds)))
        return F.concat(F.transform(known, single), F.array(_measure("ms2", "isolation_window", width)))

    return F.flatten(F.transform("precursors", of_precursor))


def _scan_measures() -> Column:
    level = F.when(F.col("ms_level") == 1, F.lit("ms1")).when(F.col("ms_level") == 2, F.lit("ms2"))
    tic, low, high = F.col("_tic"), F.col("_low"), F.col("_high")
    scan = [
        _measure("summary", "spectra", F.lit(1)),
        _measure("ms1", "spectra", F.col("ms_level").eqNullSafe(1).cast("int")),
        _measure("ms2", "spectra", F.col("ms_level").eqNullSafe(2).cast("int")),
        _measure("summary", "scan_time", F.col("scan_time_min")),
        _measure("summary", "tic", tic),
        _measure(level, "tic", tic),
        _measure(level, "mz_low", low),
        _measure(level, "mz_high", high),
        _measure(level, "mz_window", high - low),
        _measure("summary", "peak_count", F.col("peak_count")),
        _measure(level, "peak_count", F.col("peak_count")),
        _measure("summary", "peak_intensity_min", F.col("int_min")),
        _measure("summary", "peak_intensity_max", F.col("int_max")),
        _measure("summary", "peak_intensity_avg", F.col("int_avg")),
        _measure("summary", "peak_intensity_median", F.col("int_median")),
        _measure("summary", "peak_separation_min", F.col("sep_min")),
        _measure("summary", "peak_separation_max", F.col("sep_max")),
        _measure("summary", "peak_separation_avg", F.col("sep_avg")),
        _measure("summary", "peak_separation_median", F.col("sep_median")),
    ]
    return F.array(*scan)


def run_measures(spectra: DataFrame) -> DataFrame:
    """Count, sum, least, greatest, mean and deviation per run and measure.

    Each scan turns into a short list of numbers that is aggregated before the
    shuffle, so what is exchanged is a few dozen rows per run and task, however
    long the run and however unequal the runs.
    """
    known = (
        peak_stats(spectra)
        .withColumn("_tic", last_number(F.col("cv"), TERMS["tic"]))
        .withColumn("_low", last_number(F.col("cv"), TERMS["mz_low"]))
        .withColumn("_high", last_number(F.col("cv"), TERMS["mz_high"]))
    )
    empty = F.array().cast("array<struct<group:string,measure:string,x:double>>")
    precursor = F.when(F.col("ms_level") == 2, F.coalesce(_precursor_measures(), empty)).otherwise(empty)
    exploded = known.select("basename", F.inline_outer(F.concat(_scan_measures(), precursor)))
    return (
        exploded.where(F.col("x").isNotNull() & F.col("group").isNotNull())
        .groupBy("basename", "group", "measure")
        .agg(
            F.count("*").alias("n"),
            F.sum("x").alias("sum"),
            F.min("x").alias("min"),
            F.max("x").alias("max"),
            F.avg("x").alias("avg"),
            F.stddev_samp("x").alias("std"),
        )
    )


_WANTED_DDL = "map<string,array<struct<stat:string,accession:string,name:string>>>"


def _named_lines():
    for key, lines in REPORTED.items():
        yield key, [{"stat": stat, "accession": accession, "name": name} for stat, accession, name in lines]


def statistics_rows(measures: DataFrame) -> DataFrame:
    """Measures as EAV rows with ``value`` as text and ``value_num``."""
    # A constant map from group/measure to its lines, as one SQL literal.
    wanted = F.from_json(F.lit(json.dumps({f"{g}/{m}": lines for (g, m), lines in _named_lines()})), _WANTED_DDL)
    number = F.lit(None).cast("double")
    for stat in ("sum", "min", "max", "avg", "std"):
        number = F.when(F.col("stat") == stat, F.col(stat)).otherwise(number)
    number = F.when(F.col("stat") == "seconds", (F.col("max") - F.col("min")) * 60.0).otherwise(number)
    is_count = F.col("stat") == "sum"
    numeric = (
        measures.withColumn("_lines", F.try_element_at(wanted, F.concat_ws("/", "group", "measure")))
        .select("basename", "group", "n", "sum", "min", "max", "avg", "std", F.inline_outer("_lines"))
        .withColumn("value_num", F.when(is_count, number).otherwise(round3(number)))
        .where(F.col("value_num").isNotNull())
        .select(
            "basename",
            "accession",
            "name",
            F.when(is_count, whole_text(F.col("value_num"))).otherwise(decimal_text(F.col("value_num"))).alias("value"),
            "group",
            "value_num",
        )
    )
    dia = (F.col("n") >= DIA_MIN_WINDOWS) & (F.col("avg") >= DIA_MIN_WIDTH)
    accession, name, group = ACQUISITION
    mode = measures.where((F.col("group") == "ms2") & (F.col("measure") == "isolation_window")).select(
        "basename",
        F.lit(accession).alias("accession"),
        F.lit(name).alias("name"),
        F.when(dia, F.lit("DIA")).otherwise(F.lit("DDA")).alias("value"),
        F.lit(group).alias("group"),
        F.lit(None).cast("double").alias("value_num"),
    )
    return numeric.unionByName(mode)


def run_statistics(spectra: DataFrame) -> DataFrame:
    return statistics_rows(run_measures(spectra))


def run_metadata(headers: DataFrame, spectra: DataFrame, terms_table: DataFrame | None = None) -> DataFrame:
    """Header parameters and statistics in one table, one row per run and accession."""
    head = header_rows(headers, terms_table)
    stats = run_statistics(spectra).select(*EAV_COLUMNS, F.lit(1 << 40).alias("seq"))
    return dedupe_header(head.unionByName(stats))
