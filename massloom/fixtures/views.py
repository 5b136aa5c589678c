"""Domain views over the generic test tables.

``oracle.py`` states the same rules as SQL. All numbers that end up in sums are
whole or halves, so that both engines add them without rounding.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from massloom.contracts import CV_PARAM
from massloom.functions.numbers import zero_padded
from massloom.plans.repositories import build_files
from massloom.session import durable

SCAN_TIME = "2024-01-01 00:00:00"
SUFFIXES = [".raw", ".RAW", ".mzML.gz", ".d/analysis.tdf", ".wiff", ".wiff.scan", ".pdf", ".mgf.zip"]
# Upper bounds of l_orderkey % 1000, doubling, so that the shares do too: the
# organism is the number of binary digits of l_orderkey % 1000 + 1.
ORGANISMS = [
    (1, "archaea"), (3, "fly"), (7, "worm"), (15, "rat"), (31, "yeast"), (63, "pig"),
    (127, "plant"), (255, "bacteria"), (511, "mouse"), (1000, "human"),
]
HEADER_GROUPS = ["file_description", "instrument", "data_processing", "run"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _dealt(df: DataFrame, *keys: str) -> DataFrame:
    """A test table, which is a single small file, dealt out ahead of costly row work; a large one is in many parts as it is."""
    parts = df._jdf.queryExecution().toRdd().getNumPartitions()
    return df if parts >= 2 * df.sparkSession.sparkContext.defaultParallelism else df.repartition(*keys)


def _px(key: str) -> Column:
    return F.concat(F.lit("PX"), zero_padded(F.col(key), 6))


def _text(*parts) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def repositories(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    host = F.when(key % 10 == 3, F.lit("massive-ftp.ucsd.edu")).otherwise(_text("FTP", key % 3, ".example.org"))
    url = _text(
        "ftp://",
        F.when(key % 4 == 0, F.lit("user:p@w@")).otherwise(F.lit("")),
        host,
        F.when(key % 5 == 0, F.lit(":2121")).otherwise(F.lit("")),
        F.when(key % 11 == 7, F.lit("")).otherwise(_text("/data/", key)),
        F.when(key % 2 == 0, F.lit("/")).otherwise(F.lit("")),
    )
    return table(spark, sf_dir, "supplier").select(
        _px("s_suppkey").alias("id"), url.alias("url"), _text("10.1000/", F.col("s_name")).alias("doi")
    )


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files and some empty folders; some rows are listed twice."""
    line = _dealt(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_partkey")
    kind = F.col("l_partkey") % 8
    suffix = F.lit(None).cast("string")
    for at, text in enumerate(SUFFIXES):
        suffix = F.when(kind == at, F.lit(text)).otherwise(suffix)
    root = _text("/data/", F.col("l_suppkey"))
    stem = _text(
        root, "/", F.col("l_orderkey"), "/run_",
        F.col("l_orderkey"), "_", F.col("l_partkey"), "_", F.col("l_linenumber"),
    )
    size = F.round(F.col("l_extendedprice") * 100).cast("bigint") * 40
    even = F.col("l_orderkey") % 2 == 0

    def entry(path: Column, size_bytes: Column, where: Column | None = None) -> Column:
        row = F.struct(path.alias("path"), F.lit(False).alias("is_dir"), size_bytes.alias("size_bytes"))
        return row if where is None else F.when(where, row)

    entries = F.array(
        entry(_text(stem, suffix), size),
        entry(_text(stem, ".wiff.scan"), F.floor(size / 10), (kind == 4) & even),
        entry(_text(stem, ".d/AcqData/part.bin"), F.floor(size / 3), (kind == 3) & even),
        entry(_text(stem, ".raw"), size, (kind == 0) & (F.col("l_linenumber") == 1)),
    )
    # An entry that is not there is a row of nulls.
    found = line.select(_px("l_suppkey").alias("repository_id"), root.alias("_root"), F.inline_outer(entries)).where(F.col("is_dir").isNotNull())
    # A second crawl spelled its root with a slash at the end.
    again = F.when(F.col("path").rlike("_[05]\\."), F.array("_root", F.concat("_root", F.lit("/"))))
    listed = found.withColumn("root_path", F.explode_outer(F.coalesce(again, F.array("_root")))).select(
        "repository_id", "root_path", "path", "is_dir", "size_bytes"
    )
    folders = table(spark, sf_dir, "supplier").select(
        _px("s_suppkey").alias("repository_id"),
        _text("/data/", F.col("s_suppkey")).alias("root_path"),
        _text("/data/", F.col("s_suppkey"), "/incoming").alias("path"),
        F.lit(True).alias("is_dir"),
        F.lit(None).cast("bigint").alias("size_bytes"),
    )
    return listed.unionAll(folders)


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_files(listing(spark, sf_dir), F.to_timestamp(F.lit(SCAN_TIME)))


def stored_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``files`` as a written table, the way the jobs after it find it."""
    return durable(files(spark, sf_dir), "files")


def replicates(spark: SparkSession, sf_dir: str, of: DataFrame | None = None) -> DataFrame:
    """Annotation of every sample file, with its repository as accession."""
    base = files(spark, sf_dir) if of is None else of
    pattern = r"run_([0-9]+)_([0-9]+)_([0-9]+)"
    samples = base.where(F.col("id").isNotNull()).select(
        "id",
        F.col("repository_id").alias("accession"),
        *[
            F.regexp_extract("remote_path", pattern, g).try_cast("bigint").alias(n)
            for g, n in enumerate(["_order", "_part", "_line"], 1)
        ],
    )
    if of is None:
        samples = durable(samples, "samples")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    digits = F.length(F.bin(F.col("_order") % 1000 + 1))
    organism = F.get(F.array(*[F.lit(name) for _, name in ORGANISMS]), digits - 1)
    return (
        samples.join(orders, F.col("_order") == F.col("o_orderkey"), "left")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(part, F.col("_part") == F.col("p_partkey"), "left")
        .select(
            "id",
            organism.alias("organism"),
            F.coalesce("c_mktsegment", F.lit("unknown")).alias("source_type"),
            F.coalesce("p_type", F.lit("unknown")).alias("material"),
            F.coalesce("o_orderpriority", F.lit("unknown")).alias("condition"),
            F.format_string("sample-%04d", F.col("_line")).alias("sample_group"),
            "accession",
        )
    )


def faulty_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotations of all orders with planted nulls, blanks, copies and repeated ids."""
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    rows = orders.select(
        _text("s_", F.when(key % 101 == 5, key - 5).otherwise(key)).alias("id"),
        F.when(key % 53 != 1, F.col("o_orderstatus")).alias("organism"),
        F.when(key % 59 == 2, F.lit("\t ")).otherwise(F.lit("tissue")).alias("source_type"),
        F.when(key % 61 == 3, F.lit(" ")).otherwise(F.lit("plasma")).alias("material"),
        F.col("o_orderpriority").alias("condition"),
        F.format_string("sample-%04d", key).alias("sample_group"),
        F.when(key % 103 == 4, F.lit(2)).otherwise(F.lit(1)).alias("_times"),
    )
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).drop("_times", "_copy")


def faulty_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select(
        _text("PX", F.when(key % 17 == 1, key - 1).otherwise(key)).alias("id"),
        F.when(key % 13 != 2, _text("ftp://host/", key)).alias("url"),
        F.when(key % 19 == 3, F.lit(" ")).otherwise(F.col("s_name")).alias("doi"),
        F.when(key % 23 == 4, F.lit(3)).otherwise(F.lit(1)).alias("_times"),
    )
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).drop("_times", "_copy")


def _param(accession: str, name: str | None, value: Column | str | None) -> Column:
    text = F.lit(value) if value is None or isinstance(value, str) else value
    return F.struct(
        F.lit(accession).cast("string").alias("accession"),
        F.lit(name).cast("string").alias("name"),
        text.cast("string").alias("value"),
    )


def _precursor(*params: Column) -> Column:
    return F.struct(F.array(*params).alias("cv"))


def _no_precursors() -> Column:
    return F.array().cast(f"array<struct<cv:array<{CV_PARAM}>>>")


def spectra(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One spectrum per vector, with peaks, parameters and precursors.

    Every fiftieth has no peaks, another fiftieth an intensity of -1.
    """
    v = F.col("vec_id")
    level = F.when(v % 5 == 0, F.lit(1)).otherwise(F.lit(2))
    bare = v % 50 == 7
    none = F.array().cast("array<double>")
    values = F.transform("embedding", lambda x: x.cast("double"))
    mz = F.transform(values, lambda x, i: F.lit(400.0) + i * F.lit(10.0) + x)
    intensity = F.transform(values, lambda x: F.pow(F.lit(10.0), F.abs(x) * 18.0))
    broken = F.transform(intensity, lambda x, i: F.when(i == 3, F.lit(-1.0)).otherwise(x))
    cv = F.array(
        _param("MS:1000511", "ms level", level),
        _param("MS:1000285", "total ion current", v * 3 + 1),
        _param("MS:1000501", "scan window lower limit", F.lit(400) + v % 7),
        _param("MS:1000500", "scan window upper limit", F.lit(1200) + v % 11),
        _param("MS:1000574", "zlib compression", ""),
        _param("MS:1000285", "total ion current", v * 3 + 2),
        _param("MS:1000523", "64-bit float", None),
    )

    def precursor(shift: int) -> Column:
        return _precursor(
            _param("MS:1000827", "isolation window target m/z", F.lit(400 + shift) + v % 300),
            _param("MS:1000828", "isolation window lower offset", F.lit(1) + v % 4),
            _param("MS:1000829", "isolation window upper offset", "2.5"),
            _param("MS:1000744", "selected ion m/z", F.lit(401 + shift) + v % 300),
            _param("MS:1000045", "collision energy", F.lit(20) + v % 15),
        )

    two = F.array(precursor(0), precursor(50))
    return _dealt(table(spark, sf_dir, "embeddings"), "vec_id").select(
        _text("run_", F.col("label")).alias("basename"),
        v.alias("scan_seq"),
        v.alias("scan_number"),
        level.alias("ms_level"),
        (v * F.lit(0.125)).alias("scan_time_min"),
        F.when(bare, none).otherwise(mz).alias("mz"),
        F.when(bare, none).when(v % 50 == 9, broken).otherwise(intensity).alias("intensity"),
        cv.alias("cv"),
        F.when(level == 1, _no_precursors()).when(v % 3 == 0, two).otherwise(F.slice(two, 1, 1)).alias("precursors"),
    )


def scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scan without peaks per event; users are runs."""
    e = F.col("event_id")
    level = F.when(F.col("event_type") == "view", F.lit(1)).when(F.col("event_type") != "signup", F.lit(2))
    cents = F.round(F.col("value") * 100).cast("bigint")
    none = F.array().cast("array<double>")
    cv = F.array(
        _param("MS:1000285", "total ion current", cents),
        _param("MS:1000579", "MS1 spectrum", ""),
        _param("MS:1000927", "ion injection time", F.get_json_object("props", "$.k")),
        _param("MS:1000285", "total ion current", cents + 1),
        _param("MS:1000501", "scan window lower limit", F.when(e % 9 != 0, F.lit(100) + e % 5)),
        _param("MS:1000500", "scan window upper limit", F.when(e % 7 != 0, F.lit(900) + e % 8)),
        _param(None, "no accession", "x"),
    )
    return _dealt(table(spark, sf_dir, "events"), "event_id").select(
        _text("user_", F.col("user_id")).alias("basename"),
        e.alias("scan_seq"),
        (e + 1).alias("scan_number"),
        level.alias("ms_level"),
        (e * F.lit(0.5)).alias("scan_time_min"),
        none.alias("mz"),
        none.alias("intensity"),
        cv.alias("cv"),
        _no_precursors().alias("precursors"),
    )


def isolations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One MS2 scan per order line with one precursor; suppliers are runs."""
    narrow = F.col("l_suppkey") % 3 == 0
    none = F.array().cast("array<double>")
    params = [
        _param("MS:1000827", "isolation window target m/z", F.floor("l_extendedprice")),
        _param("MS:1000828", "isolation window lower offset",
               F.when(narrow, F.lit(1)).otherwise(F.floor("l_quantity"))),
        _param("MS:1000829", "isolation window upper offset",
               F.when(F.col("l_linenumber") % 5 != 0, F.col("l_linenumber"))),
        _param("MS:1000744", "selected ion m/z", F.floor("l_extendedprice") + 1),
        _param("MS:1000045", "collision energy", F.round(F.col("l_tax") * 100).cast("bigint")),
    ]
    return _dealt(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_partkey").select(
        _text("run_", F.col("l_suppkey")).alias("basename"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("scan_seq"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("scan_number"),
        F.lit(2).alias("ms_level"),
        F.lit(None).cast("double").alias("scan_time_min"),
        none.alias("mz"),
        none.alias("intensity"),
        F.array().cast(f"array<{CV_PARAM}>").alias("cv"),
        F.array(_precursor(*params)).alias("precursors"),
    )


def headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header parameters with many repeated accessions; brands are runs."""
    p = F.col("p_partkey")
    group = F.get(F.array(*[F.lit(g) for g in HEADER_GROUPS]), (p % 4).cast("int"))
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("basename"),
        p.alias("seq"),
        group.alias("group"),
        F.when(p % 5 == 0, F.lit("user")).otherwise(F.lit("cv")).alias("kind"),
        F.when(p % 29 != 1, F.format_string("MS:%07d", F.col("p_size"))).alias("accession"),
        F.when(p % 3 != 0, F.col("p_type")).alias("name"),
        F.when(p % 7 != 0, F.col("p_name")).alias("value"),
    )


def terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vocabulary: accession and term for the sizes up to 25."""
    return (
        table(spark, sf_dir, "part")
        .where(F.col("p_size") <= 25)
        .select(
            F.format_string("MS:%07d", F.col("p_size")).alias("accession"),
            _text("term ", F.col("p_size")).alias("term"),
        )
        .distinct()
    )
