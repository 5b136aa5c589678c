"""The registered queries: every job over the derived domain tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from massloom import contracts
from massloom.fixtures import mzml_files
from massloom.fixtures import views as v
from massloom.functions import names
from massloom.functions.numbers import human_size, round3
from massloom.operators import inventory, profile, quality
from massloom.operators.filters import apply_filters
from massloom.plans import breakdown, intensity, repositories, replicates, run_metadata, scan_metadata
from massloom.session import durable, forget, many_files, passing_shuffles, scratch_path
from massloom.sinks import sql_dump
from massloom.sinks import tables as sinks
from massloom.sinks.tables import not_yet_done
from massloom.sources import mzml
from massloom.sources.tables import read_by_source, read_csv, read_table, replicate_ids, union_relaxed
from massloom.streaming import ingest as streaming

Query = Callable[[SparkSession, str], DataFrame]


def _data(spark: SparkSession, sf: str) -> DataFrame:
    files = v.stored_files(spark, sf)
    return breakdown.dataset(v.replicates(spark, sf, files), files)


def _rounded(shares: DataFrame) -> DataFrame:
    return shares.withColumn("pct", F.round("pct", 6))


# Listing and files

def dir_rollup(spark, sf):
    return inventory.roll_up(inventory.contributions(v.listing(spark, sf)))


def wiff_fused_sizes(spark, sf):
    return inventory.fuse(inventory.contributions(v.listing(spark, sf)))


def files_inventory(spark, sf):
    return v.files(spark, sf).drop("scan_timestamp")


def samples_summary(spark, sf):
    return repositories.samples_summary(v.files(spark, sf))


def other_summary(spark, sf):
    return repositories.other_summary(v.files(spark, sf))


def human_sizes(spark, sf):
    return inventory.unique_listing(v.listing(spark, sf)).select(
        "path", human_size(F.col("size_bytes") * F.col("size_bytes")).alias("size")
    )


def sample_names(spark, sf):
    path = F.col("path")
    return inventory.unique_listing(v.listing(spark, sf)).select(
        "path",
        names.is_sample_name(path).alias("is_sample"),
        names.sample_id(F.col("repository_id"), path).alias("sample_id"),
        names.output_name(F.lit("x"), path).alias("output_name"),
        names.run_name(names.base_name(path)).alias("run_name"),
    )


def ftp_url_parts(spark, sf):
    parts = names.ftp_parts(F.col("url"))
    return v.repositories(spark, sf).select("id", *[c.alias(k) for k, c in parts.items()])


# Quality

def dq_replicates(spark, sf):
    return replicates.ingest(v.faulty_annotations(spark, sf))[1]


def dq_repositories(spark, sf):
    return repositories.ingest(v.faulty_manifest(spark, sf))[1]


def dq_by_file(spark, sf):
    rows = v.faulty_annotations(spark, sf).withColumn("accession", F.coalesce("organism", F.lit("none")))
    return replicates.ingest(rows, per="accession")[1]


def duplicate_ids(spark, sf):
    return quality.duplicate_keys(v.faulty_annotations(spark, sf))


def replicates_missing_size(spark, sf):
    files = v.stored_files(spark, sf)
    named = v.replicates(spark, sf, files)
    lost = F.endswith(F.col("sample_group"), F.lit("7"))
    gaps = named.withColumn("id", F.when(lost, F.concat("id", F.lit("_absent"))).otherwise(F.col("id")))
    return replicates.size_faults(gaps, files)


def replicate_id_list(spark, sf):
    return replicate_ids(v.faulty_annotations(spark, sf))


# Worklist

def _worklist(spark, sf):
    files = v.stored_files(spark, sf)
    named = durable(v.replicates(spark, sf, files), "annotations")
    return replicates.worklist(named, files, v.repositories(spark, sf), v.listing(spark, sf))


def sample_worklist(spark, sf):
    return _worklist(spark, sf)


def worklist_status(spark, sf):
    work = durable(_worklist(spark, sf), "worklist")
    digit = F.length("remote_path") % 4
    local = work.where(digit != 0).select(
        "output_path",
        F.when(digit == 1, F.col("size_bytes")).when(digit == 2, F.col("size_bytes") - 1).alias("size_bytes"),
        F.when(digit == 3, F.floor(F.col("size_bytes") / 2)).alias("part_bytes"),
    )
    return replicates.fetch_status(work, local).select(
        "sample_id", "remote_path", "output_path", "size_bytes", "status", "offset"
    )


def worklist_faults(spark, sf):
    """Replicates without a file or with two, repositories missing or listed twice."""
    files = v.stored_files(spark, sf)
    named = v.replicates(spark, sf, files)
    lost = F.endswith(F.col("sample_group"), F.lit("7"))
    gaps = named.withColumn("id", F.when(lost, F.concat("id", F.lit("_absent"))).otherwise(F.col("id")))
    double = files.unionAll(files.where(F.endswith(F.col("id"), F.lit("_5"))))
    key = F.substring("id", 3, 9).cast("int")
    sites = v.repositories(spark, sf).where(key % 6 != 1)
    return replicates.worklist_faults(gaps, double, sites.unionAll(sites.where(key % 6 == 2)))


# Filters and unions

FILTERS = {"organism": ["human", "mouse", "yeast"], "source_type": "BUILDING", "no_such_column": 1}


def filtered_replicates(spark, sf):
    return apply_filters(v.replicates(spark, sf), FILTERS)


def union_relaxed_tables(spark, sf):
    part = v.table(spark, sf, "part").select(
        F.col("p_partkey").alias("key"), F.col("p_size").alias("amount"), F.col("p_name").alias("name")
    )
    supplier = v.table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("int").alias("key"), F.col("s_acctbal").alias("amount"), F.col("s_nationkey").alias("nation")
    )
    return union_relaxed([part, supplier])


def incremental_new_files(spark, sf):
    files = v.files(spark, sf).select("repository_id", "remote_path", "size_bytes")
    done = v.repositories(spark, sf).where(F.col("url").contains("2121")).select(F.col("id").alias("repository_id"))
    return not_yet_done(files, done, "repository_id")


# Batches


def _splits(spark, sf, mode="balanced", **how):
    files = v.stored_files(spark, sf)
    packed = replicates.batch_splits(v.replicates(spark, sf, files), files, mode=mode, **how)
    # The sizes have been looked up and stored.
    forget(files)
    return packed


def batch_splits(spark, sf):
    return _splits(spark, sf).select("accession", "id", "size_bytes", "split_id", "split")


def batch_splits_chained(spark, sf):
    """The same in short stretches."""
    return _splits(spark, sf, stretch=2).select("accession", "id", "size_bytes", "split_id", "split")


def split_totals(spark, sf):
    return replicates.split_totals(_splits(spark, sf))


def split_fill(spark, sf):
    return _splits(spark, sf, "fill").select("accession", "id", "size_bytes", "split_id", "split")


# Breakdown

def organism_size_share(spark, sf):
    return _rounded(breakdown.size_share(_data(spark, sf), "organism"))


def organism_count_share(spark, sf):
    return _rounded(breakdown.count_share(_data(spark, sf), "organism"))


def repo_size_share(spark, sf):
    return _rounded(breakdown.size_share(_data(spark, sf), "repository_id"))


def repo_count_share(spark, sf):
    return _rounded(breakdown.count_share(_data(spark, sf), "repository_id"))


def olap_cuts(spark, sf):
    return _rounded(breakdown.olap_cuts(_data(spark, sf)))


# SQL text

def sql_insert_lines(spark, sf):
    """The dump of all three tables, with its frame."""
    files = v.stored_files(spark, sf)
    tables = {
        "repositories": v.repositories(spark, sf),
        "files": files,
        "replicates": v.replicates(spark, sf, files),
    }
    return sql_dump.dump_lines(tables)


def sql_dump_filtered(spark, sf):
    files = v.stored_files(spark, sf)
    tables = {"files": files, "replicates": v.replicates(spark, sf, files), "repositories": v.repositories(spark, sf)}
    return sql_dump.answer_request(tables, "replicates, repositories", {"organism": ["pig", "rat"], "condition": "1-URGENT"})


def dump_requests(spark, sf):
    """Two requests from their file to a script and to Parquet: the INSERT lines and the rows they give."""
    base = scratch_path(spark, "requests")
    asked = [
        '{"request_id": "first", "target_tables": "replicates, repositories", "filters": "{\\"organism\\": [\\"pig\\", \\"rat\\"], \\"condition\\": \\"1-URGENT\\"}"}',
        '{"request_id": "second", "target_tables": "repositories", "output_format": "PARQUET"}',
    ]
    spark.createDataFrame([(a,) for a in asked], "value string").write.text(f"{base}/in")
    files = v.stored_files(spark, sf)
    tables = {"files": files, "replicates": v.replicates(spark, sf, files), "repositories": v.repositories(spark, sf)}
    sql_dump.answer_requests(tables, f"{base}/in", f"{base}/out")
    script = spark.read.text(f"{base}/out/first").where(F.startswith(F.col("value"), F.lit("INSERT")))
    rows = spark.read.parquet(f"{base}/out/second/repositories")
    return script.select(F.lit("first").alias("request"), F.col("value").alias("line")).unionByName(
        rows.select(F.lit("second").alias("request"), F.concat_ws("|", "id", "url", "doi").alias("line"))
    )


def sql_typed_literals(spark, sf):
    """INSERT lines over every column type of the test tables."""
    orders = v.table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_custkey").cast("int").alias("o_custkey"),
        F.when(F.col("o_orderkey") % 3 != 0, F.concat(F.lit("it's '"), F.col("o_orderpriority"))).alias("note"),
        (F.col("o_orderstatus") == "F").alias("done"),
        F.when(F.col("o_orderkey") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("o_orderkey") * 0.5).alias("half"),
        # Without a time zone, so that the session's does not matter.
        F.expr(
            "timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, cast(o_orderkey * 1.5 AS decimal(18, 6)))"
        ).alias("stamp"),
    )
    contract = orders.schema
    return sql_dump.insert_lines("orders", 0, orders, contract)


# Spectra

def run_metadata_stats(spark, sf):
    return run_metadata.run_statistics(v.scans(spark, sf))


def precursor_stats(spark, sf):
    return run_metadata.run_statistics(v.isolations(spark, sf)).where(F.col("accession") != "acquisition:type")


def acquisition_type(spark, sf):
    rows = run_metadata.run_statistics(v.isolations(spark, sf))
    return rows.where(F.col("accession") == "acquisition:type").select("basename", "value")


def run_peak_stats(spark, sf):
    return run_metadata.run_statistics(v.spectra(spark, sf))


def header_eav_dedupe(spark, sf):
    return run_metadata.dedupe_header(run_metadata.header_rows(v.headers(spark, sf), v.terms(spark, sf)))


def scan_eav_ms1(spark, sf):
    return scan_metadata.scan_metadata(v.scans(spark, sf), 1).drop("value_num")


def scan_eav_ms2(spark, sf):
    return scan_metadata.scan_metadata(v.scans(spark, sf), 2).drop("value_num")


def parent_ms1(spark, sf):
    return scan_metadata.parent_scans(v.scans(spark, sf)).where(F.col("ms_level") == 2).select(
        "basename", "scan_number", "parent_scan"
    )


def scan_peak_stats(spark, sf):
    stats = scan_metadata.peak_stats(v.spectra(spark, sf), 3, 3)
    columns = ["int_min", "int_max", "int_avg", "int_median", "sep_min", "sep_max", "sep_avg", "sep_median"]
    return stats.select("basename", "scan_number", "peak_count", *[round3(F.col(c)).alias(c) for c in columns])


def scan_metadata_ms2(spark, sf):
    return scan_metadata.scan_metadata(v.spectra(spark, sf), 2).drop("value_num")


def intensity_histogram(spark, sf):
    long = intensity.histogram_long(intensity.histogram(v.spectra(spark, sf)))
    return long.withColumn("lo", F.round("lo", 4)).withColumn("hi", F.round("hi", 4))


def intensity_histogram_wide(spark, sf):
    wide = intensity.histogram_wide(intensity.histogram(v.spectra(spark, sf)))
    for name in ("min_mz", "max_mz", "min_int", "max_int"):
        wide = wide.withColumn(name, F.round(name, 5))
    return wide


def intensity_quantiles(spark, sf):
    long = intensity.quantiles_long(intensity.quantiles(v.spectra(spark, sf)))
    return long.withColumn("percent", F.round("percent", 6)).withColumn("value", F.round("value", 6))


# Profiles

def column_profile(spark, sf):
    return profile.column_profile(v.table(spark, sf, "lineitem"), "lineitem").drop("nullable")


def dataset_metrics(spark, sf):
    return profile.dataset_metrics(v.table(spark, sf, "orders"), "orders").drop("computed_at")


def table_manifest(spark, sf):
    names_ = ["orders", "lineitem", "events"]
    runs = [profile.dataset_run(v.table(spark, sf, n), n, f"{n}.parquet") for n in names_]
    return union_relaxed(runs).drop("created_at")


def table_shapes(spark, sf):
    """What of the manifest another engine can see as well."""
    return table_manifest(spark, sf).select("dataset_id", "bronze_path", "format", "row_count", "column_count")


def stored_files(spark, sf):
    """Files of a table written in folders by status: rows of each folder, whether all have a size and a time."""
    path = scratch_path(spark, "orders")
    sinks.write_partitioned(v.table(spark, sf, "orders"), path, "o_orderstatus", ["o_orderkey"])
    found = profile.stored_files(spark.read.parquet(path))
    return found.groupBy(F.regexp_extract("path", "o_orderstatus=([^/]*)/", 1).alias("status")).agg(
        F.sum("n_rows").alias("n_rows"),
        F.bool_and(F.contains(F.col("path"), F.col("id")) & (F.col("size_bytes") > 0) & F.col("created_at").isNotNull()).alias("described"),
    )


# Files on disk, written by Spark from the tables

def mzml_scan(spark, sf):
    path = scratch_path(spark, "mzml")
    mzml_files.write_mzml(v.spectra(spark, sf), path, integers=True)
    spectra = mzml.read_spectra(spark, path, basename=F.regexp_extract("_metadata.file_path", "run=([^/]*)/", 1))
    return spectra.select(
        "basename",
        "scan_seq",
        "scan_number",
        "ms_level",
        F.round("scan_time_min", 4).alias("scan_time_min"),
        F.size("mz").alias("peaks"),
        F.round(F.coalesce(F.array_min("mz"), F.lit(0.0)), 5).alias("min_mz"),
        F.round(F.coalesce(F.array_max("mz"), F.lit(0.0)), 5).alias("max_mz"),
        F.round(F.aggregate("mz", F.lit(0.0), lambda a, x: a + x), 3).alias("sum_mz"),
        F.size("intensity").alias("intensities"),
        F.size("cv").alias("n_params"),
        F.size("precursors").alias("n_precursors"),
    )


def mzml_run_metadata(spark, sf):
    """Header and statistics of mzML runs in one table."""
    path = scratch_path(spark, "mzml")
    mzml_files.write_mzml(v.spectra(spark, sf), path)
    run = F.regexp_extract("_metadata.file_path", "run=([^/]*)/", 1)
    heads = mzml.read_headers(spark, path, basename=F.regexp_extract("path", "run=([^/]*)/", 1), glob="*.txt")
    return run_metadata.run_metadata(heads, mzml.read_spectra(spark, path, basename=run), v.terms(spark, sf))


def annotations_mixed_headers(spark, sf):
    """Annotations from files in three orders of columns, one with a column more; all by their own header."""
    return read_by_source(spark, _mixed_headers(spark, sf), contracts.REPLICATES)[0].drop("accession")


def annotations_header_faults(spark, sf):
    """What the same files lack, by check and column, with the number of files."""
    rows, heads = read_by_source(spark, _mixed_headers(spark, sf), contracts.REPLICATES)
    report = replicates.ingest(rows, per="accession", heads=heads)[1]
    return report.where(F.col("n_bad") > 0).groupBy("check", "column").agg(F.sum("n_bad").alias("n_files"))


def _mixed_headers(spark, sf):
    path = scratch_path(spark, "headers")
    names_ = contracts.REPLICATES.names
    rows = durable(v.replicates(spark, sf), "annotations").withColumn("extra", F.length("id"))
    orders = [names_, names_[::-1], ["material", "extra", *[n for n in names_ if n != "material"]], [n for n in names_ if n != "material"]]
    for k, columns in enumerate(orders):
        part = rows.where(F.ascii(F.right("id", F.lit(1))) % 4 == k).select(*columns)
        with passing_shuffles(spark):
            part.repartition(3, "id").write.mode("append").csv(path, header=True)
    return path


def _written_by_accession(spark, rows, path):
    """A CSV file for each accession, named after it, and nothing else in the folder."""
    made = scratch_path(spark, "parts")
    with passing_shuffles(spark):
        rows.repartition("accession").write.partitionBy("accession").csv(made, header=True)
    fs = spark._jvm.org.apache.hadoop.fs
    system = fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(fs.Path(path))

    def move(folder):
        name = folder.getName().split("=", 1)[1]
        for part in system.globStatus(fs.Path(folder, "part-*")):
            system.rename(part.getPath(), fs.Path(path, f"{name}.csv"))

    with ThreadPoolExecutor(16) as movers:
        list(movers.map(move, [f.getPath() for f in system.globStatus(fs.Path(f"{made}/accession=*"))]))


def stream_replace(spark, sf):
    """Annotations of two accessions with the same ids, and corrected files, in two arrivals and at once.

    The result must not depend on which files arrive together.
    """
    base = scratch_path(spark, "stream")
    key = F.substring("accession", 3, 9).cast("int")
    rows = durable(v.replicates(spark, sf), "annotations")
    twice = rows.where(key % 2 == 1).withColumn("accession", F.concat(F.lit("B_"), F.col("accession")))
    fixed = rows.where(key % 3 == 0).withColumn("condition", F.lit("fixed"))

    def take_in(at):
        streaming.ingest_replicates(spark, f"{base}/in/*", at, f"{at}-report", f"{at}-offsets").awaitTermination()
        return read_table(many_files(spark), at, contracts.REPLICATES, by="accession")

    for number, arrived in enumerate((rows.unionByName(twice), fixed)):
        _written_by_accession(spark, arrived, f"{base}/in/{number}")
        one_by_one = take_in(f"{base}/first")
    at_once = take_in(f"{base}/second")
    return one_by_one.withColumn("way", F.lit("one by one")).unionByName(at_once.withColumn("way", F.lit("at once")))


def stream_ingest(spark, sf):
    """Annotation files in two arrivals, three calls of the stream."""
    base = scratch_path(spark, "stream")
    rows = durable(v.replicates(spark, sf), "annotations")
    for half in (0, 1):
        _written_by_accession(spark, rows.where(F.substring("accession", 3, 9).cast("int") % 2 == half), f"{base}/{half}")
    for arrived in ("0", "0", "{0,1}"):
        streaming.ingest_replicates(
            spark, f"{base}/{arrived}", f"{base}/table", f"{base}/report", f"{base}/offsets"
        ).awaitTermination()
    return read_table(many_files(spark), f"{base}/table", contracts.REPLICATES, by="accession")


def stream_runs(spark, sf):
    """mzML runs in two calls of the stream: peaks of every spectrum."""
    base = scratch_path(spark, "runs")
    mzml_files.write_mzml(v.spectra(spark, sf), f"{base}/in")
    name = lambda path: path.getParent().getName().split("=", 1)[1]
    fs = spark._jvm.org.apache.hadoop.fs
    system = fs.Path(base).getFileSystem(spark._jsc.hadoopConfiguration())
    found = system.globStatus(fs.Path(f"{base}/in/run=*/part-*"))
    for half in (0, 1):
        for k, part in enumerate(found):
            if k % 2 == half:
                system.mkdirs(fs.Path(f"{base}/arrived"))
                system.rename(part.getPath(), fs.Path(f"{base}/arrived/{name(part.getPath())}.mzML"))
        streaming.ingest_runs(spark, f"{base}/arrived", f"{base}/table", f"{base}/offsets").awaitTermination()
    return spark.read.parquet(f"{base}/table").select("basename", "scan_number", "ms_level", F.size("mz").alias("peaks"))


# Sinks, written twice and read back

def sink_runs(spark, sf):
    """A run table written run by run: those of the second call replace theirs and leave the others."""
    path = scratch_path(spark, "run-table")
    scans = v.scans(spark, sf).select("basename", "scan_seq", "scan_number", "ms_level")
    sinks.write_runs(scans, path)
    sinks.write_runs(scans.where(F.col("basename").like("%1%")).withColumn("ms_level", F.lit(9)), path)
    return spark.read.parquet(path).select("basename", "scan_seq", "scan_number", "ms_level")


def sink_append_new(spark, sf):
    """Only runs the table does not hold yet are added."""
    path = scratch_path(spark, "run-table")
    scans = v.scans(spark, sf).select("basename", "scan_seq", "ms_level")
    sinks.append_new(scans.where(F.col("basename").like("%1%")), path, "basename", ["scan_seq"])
    sinks.append_new(scans.withColumn("ms_level", F.lit(9)), path, "basename", ["scan_seq"])
    return spark.read.parquet(path).select("basename", "scan_seq", "ms_level")


def sink_partitioned(spark, sf):
    """Replicates by accession; the second write replaces a third of the accessions."""
    path = scratch_path(spark, "replicates")
    rows = durable(v.replicates(spark, sf), "annotations")
    sinks.write_partitioned(rows, path, "accession", ["id"])
    part = rows.where(F.substring("accession", 3, 9).cast("int") % 3 == 0)
    sinks.write_partitioned(part.withColumn("condition", F.lit("fixed")), path, "accession", ["id"])
    return read_table(spark, path, contracts.REPLICATES, by="accession")


def sink_split_files(spark, sf):
    """Batches as CSV, a folder for each, read back with the folder's name."""
    path = scratch_path(spark, "splits")
    sinks.write_splits(_splits(spark, sf).select("accession", "split_id", "id", "organism"), path)
    return many_files(spark).read.option("header", True).schema("id string, organism string, split string").csv(path)


def csv_ingest(spark, sf):
    """A manifest with an extra column, written and read back as CSV."""
    path = scratch_path(spark, "manifest")
    rows = v.repositories(spark, sf).withColumn("extra", F.lit("1"))
    rows.select("doi", "extra", "id", "url").write.csv(path, header=True)
    table, report = repositories.ingest(read_csv(spark, path))
    quality.strict(report)
    return table


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        organism_size_share, organism_count_share, repo_size_share, repo_count_share, olap_cuts,
        dir_rollup, wiff_fused_sizes, files_inventory, samples_summary, other_summary, human_sizes,
        sample_names, ftp_url_parts, dq_replicates, dq_repositories, dq_by_file, duplicate_ids,
        replicates_missing_size, replicate_id_list, sample_worklist, worklist_status,
        filtered_replicates, union_relaxed_tables, incremental_new_files,
        batch_splits, batch_splits_chained, split_totals, split_fill,
        sql_insert_lines, sql_dump_filtered, dump_requests, sql_typed_literals,
        run_metadata_stats, precursor_stats, acquisition_type, run_peak_stats, header_eav_dedupe,
        scan_eav_ms1, scan_eav_ms2, parent_ms1, scan_peak_stats, scan_metadata_ms2,
        intensity_histogram, intensity_histogram_wide, intensity_quantiles,
        column_profile, dataset_metrics, table_manifest, table_shapes, stored_files,
        mzml_scan, mzml_run_metadata, stream_ingest, csv_ingest,
        annotations_mixed_headers, annotations_header_faults, stream_replace, stream_runs, worklist_faults,
        sink_runs, sink_append_new, sink_partitioned, sink_split_files,
    )
}
