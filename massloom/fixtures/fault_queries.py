"""Registered queries on versions, faults and unlike types: what a job does when its input is not as it should be."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from massloom import contracts
from massloom.fixtures import mzml_files
from massloom.fixtures import views as v
from massloom.fixtures.queries import Query, _written_by_accession
from massloom.functions import names
from massloom.operators import quality
from massloom.plans import intensity, replicates, scan_metadata
from massloom.session import durable, scratch_path
from massloom.sinks import tables as sinks
from massloom.sources import mzml
from massloom.sources.tables import read_csv, read_table, union_relaxed
from massloom.streaming import ingest as streaming


def _put(spark: SparkSession, path: str, text: str, modified: int | None = None) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    out = system.create(place)
    out.write(bytearray(text.encode()))
    out.close()
    if modified is not None:
        system.setTimes(place, modified, -1)


# Streams


def stream_withdraw(spark: SparkSession, sf: str) -> DataFrame:
    """Annotations of seven sources, newer versions of six, and an old version that arrives last.

    Two newer versions have faults, one holds a header only, one a blank line;
    the others are corrections. The table is the same whether arrivals are taken
    in one by one, at once, or file by file.
    """
    base = scratch_path(spark, "stream")
    site = F.substring("accession", 3, 9).cast("int") % 7
    rows = durable(v.replicates(spark, sf).withColumn("accession", F.concat(F.lit("S"), site)), "annotations")
    of = lambda *keys: rows.where(F.col("accession").isin(*[f"S{k}" for k in keys]))
    header = ",".join(contracts.REPLICATES.names)

    def arrive(number: int) -> None:
        if number == 0:
            _written_by_accession(spark, rows, f"{base}/in/0")
        elif number == 1:
            doubled = of(0, 3).unionAll(of(0, 3).where(F.endswith(F.col("id"), F.lit("_1"))))
            _written_by_accession(spark, doubled.unionAll(of(2, 5).withColumn("condition", F.lit("fixed"))), f"{base}/in/1")
            _put(spark, f"{base}/in/1/S1.csv", header + "\n")
            _put(spark, f"{base}/in/1/S4.csv", "\n")
        else:
            for k in (5, 6):
                _put(spark, f"{base}/in/2/S{k}.csv", f"{header}\nlate,a,b,c,d,e\n", 1_000)

    def take_in(way: str) -> DataFrame:
        at = f"{base}/{way.replace(' ', '-')}"
        streaming.ingest_replicates(spark, f"{base}/in/*", at, f"{at}-report", f"{at}-offsets").awaitTermination()
        return read_table(spark, at, contracts.REPLICATES, by="accession").withColumn("way", F.lit(way))

    for number in range(3):
        arrive(number)
        one_by_one = take_in("one by one")
    at_once = take_in("at once")
    kept, streaming.FILES_PER_BATCH = streaming.FILES_PER_BATCH, 1
    try:
        file_by_file = take_in("file by file")
    finally:
        streaming.FILES_PER_BATCH = kept
    return one_by_one.unionByName(at_once).unionByName(file_by_file)


# Batches of many files of one size


def batch_splits_even(spark: SparkSession, sf: str) -> DataFrame:
    """Batches where sizes are whole eighths of a gigabyte, many of them zero and some missing."""
    files = v.stored_files(spark, sf)
    size = F.col("size_bytes")
    eighth = F.lit(1 << 27)
    coarse = F.when(F.length("remote_path") % 11 != 3, F.floor(size / eighth) * eighth)
    named = v.replicates(spark, sf, files)
    packed = replicates.batch_splits(named, files.withColumn("size_bytes", coarse))
    return packed.select("accession", "id", "size_bytes", "split_id", "split")


# Unions


def union_relaxed_types(spark: SparkSession, sf: str) -> DataFrame:
    """A number beside a text, an int beside a bigint and a double, structs with other fields, an array beside a value."""
    key = F.col("p_partkey")
    part = v.table(spark, sf, "part").select(
        key.alias("key"),
        F.col("p_size").cast("int").alias("amount"),
        F.struct(F.col("p_brand").alias("brand"), F.struct(key.cast("int").alias("a")).alias("deep")).alias("about"),
        F.when(key % 3 != 0, F.array(key.cast("int"), (key % 7).cast("int"))).alias("tags"),
        (key % 2 == 0).alias("flag"),
    )
    supplier = v.table(spark, sf, "supplier").select(
        F.col("s_name").alias("key"),
        F.col("s_suppkey").alias("amount"),
        F.struct(F.struct(F.col("s_suppkey").alias("a"), F.col("s_name").alias("b")).alias("deep"), F.col("s_nationkey").alias("nation")).alias("about"),
        F.col("s_suppkey").alias("tags"),
        F.col("s_nationkey").cast("long").alias("flag"),
    )
    nation = v.table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("short").alias("key"),
        (F.col("n_nationkey") / 2).alias("amount"),
        F.lit(None).alias("tags"),
    )
    joined = union_relaxed([part, supplier, nation])
    return joined.select(
        "key", "amount", F.col("about.brand").alias("brand"), F.col("about.deep.a").alias("a"), F.col("about.deep.b").alias("b"),
        F.col("about.nation").alias("nation"), F.array_join(F.col("tags").cast("array<string>"), "+").alias("tags"), "flag",
    )


# mzML: packings, groups, faults


def _run_of(column: str = "_metadata.file_path"):
    return F.regexp_extract(column, "run=([^/]*)/", 1)


def _texts(cv):
    return F.array_join(F.transform(cv, lambda p: F.concat_ws("=", F.coalesce(p["accession"], F.lit("-")), F.coalesce(p["value"], F.lit("-")))), ";")


def mzml_arrays(spark: SparkSession, sf: str) -> DataFrame:
    """Sums of both arrays of every scan read back, and the texts of its own parameters; runs are read in short stretches."""
    path = scratch_path(spark, "mzml")
    mzml_files.write_mzml(v.spectra(spark, sf), path)
    spectra = mzml.read_spectra(spark, path, _run_of(), stretch=50_000)
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    return spectra.select(
        "basename", "scan_number",
        F.round(total("mz"), 3).alias("sum_mz"),
        F.round(F.log10(F.lit(2.0) + total("intensity")), 2).alias("log_sum"),
        F.size("intensity").alias("peaks"),
        _texts(F.slice("cv", 1, 7)).alias("params"),
    )


def mzml_param_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Scans whose level and array storage stand in parameter groups, and the head's parameters with those of a group."""
    path = scratch_path(spark, "mzml")
    mzml_files.write_mzml(v.spectra(spark, sf), path, groups=True)
    spectra = mzml.read_spectra(spark, path, _run_of())
    scans = spectra.select(
        "basename", "scan_number", "ms_level", F.size("mz").alias("peaks"), _texts(F.slice("cv", 1, 7)).alias("params")
    )
    heads = mzml.read_headers(spark, path, _run_of("path"), glob="*.txt").where(F.col("group") == "instrument")
    named = heads.groupBy("basename").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seq", "name"))), lambda p: p["name"]), ";").alias("params")
    )
    return scans.unionByName(named, allowMissingColumns=True)


def mzml_numpress(spark: SparkSession, sf: str) -> DataFrame:
    """Scans packed by MS-Numpress: whether m/z and intensities come back within the packing's bound."""
    path = scratch_path(spark, "mzml")
    given = v.spectra(spark, sf)
    mzml_files.write_mzml(given, path, pressed=True)
    read = mzml.read_spectra(spark, path, _run_of()).select("basename", "scan_seq", F.col("mz").alias("a"), F.col("intensity").alias("b"))
    both = given.join(read, ["basename", "scan_seq"], "left")
    far = F.coalesce(F.array_max(F.zip_with("a", "mz", lambda x, y: F.abs(x - y))), F.lit(0.0))
    off = F.coalesce(F.array_max(F.zip_with("b", "intensity", lambda x, y: F.abs(x - y) / (F.abs(y) + 1))), F.lit(0.0))
    kind = F.col("scan_seq") % 8
    top = F.log(F.lit(1.0) + F.coalesce(F.array_max("intensity"), F.lit(0.0)))
    logged = F.exp(F.lit(0.5) / F.floor(F.lit(65535.0) / F.greatest(top, F.lit(1.0)))) - 1
    plain = F.lit(1e-7)
    return both.select(
        "basename", "scan_seq",
        F.size("a").alias("peaks"),
        F.size("b").alias("intensities"),
        (far <= F.when(kind == 5, plain).when(kind % 4 < 2, F.lit(0.500001e-5)).otherwise(F.lit(0.5))).alias("mz_fits"),
        (off <= F.when(kind == 5, plain).otherwise(logged * 1.0001 + 1e-9)).alias("intensity_fits"),
    )


def mzml_faults(spark: SparkSession, sf: str) -> DataFrame:
    """Runs with broken spectra, one cut off and one that announces too many: faults by kind, and the spectra still read."""
    path = scratch_path(spark, "mzml")
    run, at = F.col("run"), F.col("at")

    def damage(line):
        inside = (at >= 0) & (at < 1 << 59)
        return (
            F.when((run == "run_1") & inside & (at % 7 == 3), F.replace(line, F.lit("</scanList>"), F.lit("")))
            .when((run == "run_2") & inside & (at % 11 == 4), F.replace(line, F.lit("</spectrum>"), F.lit("")))
            .when((run == "run_3") & (at >= 1 << 59), F.lit(""))
            .when((run == "run_4") & (at < 0), F.replace(line, F.lit('<spectrumList count="'), F.lit('<spectrumList count="1')))
            .otherwise(line)
        )

    mzml_files.write_mzml(v.spectra(spark, sf), path, damage=damage)
    read = mzml.read_spectra(spark, path, _run_of(), on_fault="skip", stretch=20_000)
    faults = mzml.read_faults(spark, path, _run_of(), stretch=20_000)
    return (
        read.groupBy("basename").agg(F.count("*").alias("n")).withColumn("fault", F.lit("none"))
        .unionByName(faults.groupBy("basename", "fault").agg(F.count("*").alias("n")))
    )


# Scans without a place, and with a number used twice


def _gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Scans of which every thirteenth has no place in its run, and every seventeenth no run."""
    scans = v.scans(spark, sf)
    e = F.col("scan_seq")
    return scans.withColumn("basename", F.when(e % 17 != 4, F.col("basename"))).withColumn("scan_seq", F.when(e % 13 != 5, e))


def parent_ms1_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Every MS1 and MS2 scan and its parent; those without a place keep their row."""
    return scan_metadata.parent_scans(_gaps(spark, sf)).where(F.col("ms_level").isin(1, 2)).select(
        "basename", "scan_seq", "scan_number", "ms_level", "parent_scan"
    )


def _repeated(spark: SparkSession, sf: str) -> DataFrame:
    """Spectra in which two scans in a row bear one number."""
    return v.spectra(spark, sf).withColumn("scan_number", F.floor(F.col("scan_number") / 2))


def histogram_repeated_scans(spark: SparkSession, sf: str) -> DataFrame:
    """The histogram where a run uses scan numbers twice: the first scan in the file counts."""
    long = intensity.histogram_long(intensity.histogram(_repeated(spark, sf)))
    return long.withColumn("lo", F.round("lo", 4)).withColumn("hi", F.round("hi", 4))


def scan_eav_values(spark: SparkSession, sf: str) -> DataFrame:
    """Scan rows with the number beside its text, MS1 and MS2 in one table."""
    one, two = (scan_metadata.scan_metadata(v.scans(spark, sf), level) for level in (1, 2))
    return one.withColumn("ms_level", F.lit(1)).unionByName(two.withColumn("ms_level", F.lit(2)))


# Tables with types


def typed_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Files written as CSV and read back by their contract; every ninth size and time is no number or time."""
    path = scratch_path(spark, "typed")
    files = v.files(spark, sf)
    key = F.length("remote_path")
    broken = files.select(
        "id", "repository_id", "remote_path",
        F.when(key % 9 != 4, F.col("size_bytes").cast("string")).otherwise(F.lit("12 MB")).alias("size_bytes"),
        F.when(key % 9 != 5, F.date_format("scan_timestamp", "yyyy-MM-dd HH:mm:ss")).otherwise(F.lit("soon")).alias("scan_timestamp"),
    )
    broken.write.csv(path, header=True)
    return quality.cast_to(read_csv(spark, path), contracts.FILES).withColumn("scan_timestamp", F.col("scan_timestamp").cast("string"))


def typed_ingest_faults(spark: SparkSession, sf: str) -> DataFrame:
    """What the checks say of the same rows: how many values of each column are not of its type."""
    key = F.length("remote_path")
    rows = v.files(spark, sf).select(
        "id", "repository_id", "remote_path",
        F.when(key % 9 != 4, F.col("size_bytes").cast("string")).otherwise(F.lit("12 MB")).alias("size_bytes"),
        F.when(key % 9 != 5, F.date_format("scan_timestamp", "yyyy-MM-dd HH:mm:ss")).otherwise(F.lit("soon")).alias("scan_timestamp"),
    )
    return quality.check_table(rows, contracts.FILES, key="remote_path", whole_rows=True).where(F.col("check") != "duplicate_key")


def cut_labels(spark: SparkSession, sf: str) -> DataFrame:
    """File names made of part types, sizes and names with slashes, blanks and colons."""
    label = F.concat_ws("/", F.col("p_type"), F.concat(F.col("p_size"), F.lit(":"), F.col("p_brand")), F.replace(F.col("p_name"), F.lit("e"), F.lit("\\")))
    return v.table(spark, sf, "part").select("p_partkey", label.alias("label"), names.safe_file_name(label).alias("file_name"))


# Order of stored rows


def _places(table: DataFrame, by: str, order: list[str]) -> DataFrame:
    """For each stored file: its rows, and those that do not stand behind the row before them."""
    from pyspark.sql import Window

    at = Window.partitionBy("file").orderBy("row")
    stored = table.select(
        F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("row"), by, F.struct(*order).alias("key")
    )
    marked = stored.withColumn("before", F.lag("key").over(at))
    return marked.groupBy(by).agg(
        F.count("*").alias("n_rows"), F.sum(F.when(F.col("before") > F.col("key"), 1).otherwise(0)).alias("n_behind")
    )


def stored_order(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of a table by status and of a run table, read back file by file in the order they are stored."""
    orders, runs = scratch_path(spark, "orders"), scratch_path(spark, "run-table")
    sinks.write_partitioned(v.table(spark, sf, "orders"), orders, "o_orderstatus", ["o_custkey", "o_orderkey"])
    sinks.write_runs(v.scans(spark, sf).select("basename", "scan_number", "ms_level"), runs)
    first = _places(spark.read.parquet(orders), "o_orderstatus", ["o_custkey", "o_orderkey"])
    second = _places(spark.read.parquet(runs), "basename", ["scan_number"])
    return first.withColumnRenamed("o_orderstatus", "part").unionByName(second.withColumnRenamed("basename", "part"))


def manifest_table(spark: SparkSession, sf: str) -> DataFrame:
    """The manifest written as one dataset and read back."""
    path = scratch_path(spark, "repositories")
    sinks.write_repositories(v.repositories(spark, sf), path)
    return read_table(spark, path, contracts.REPOSITORIES)


FAULT_QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        stream_withdraw, batch_splits_even, mzml_arrays, mzml_param_groups, mzml_numpress, mzml_faults, union_relaxed_types, parent_ms1_gaps, histogram_repeated_scans, scan_eav_values,
        typed_ingest, typed_ingest_faults, cut_labels, stored_order, manifest_table,
    )
}
