"""Replicate jobs: annotation ingest, size-balanced batches, fetch worklist."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from massloom.contracts import REPLICATES
from massloom.functions import names
from massloom.operators import packing, quality
from massloom.operators.inventory import unique_listing
from massloom.session import durable, forget, passing_shuffles
from massloom.sinks.tables import split_label
from massloom.sources.tables import read_by_source, sized_samples


def ingest(
    raw: DataFrame, per: str | None = None, heads: DataFrame | None = None, store: Callable[[DataFrame], DataFrame] | None = None
) -> tuple[DataFrame, DataFrame]:
    """The ``replicates`` table (with ``accession`` if given) and its check report.

    With ``per`` (a column with the input file) faults stay with their file:
    the table holds the rows of the files without any. ``heads`` (per, missing)
    tells which columns a file lacks and which files there are. ``store`` writes
    the report and reads it back, so that the table does not make it again.
    """
    report = quality.check_table(raw, REPLICATES, whole_rows=False, per=per)
    if quality.missing_columns(raw, REPLICATES):
        quality.strict(report)
    if heads is not None:
        report = report.unionByName(quality.file_faults(raw, heads, per))
    if store:
        report = store(report)
    good = quality.passing(raw, report, per) if per else raw
    extra = [F.col("accession")] if "accession" in raw.columns else []
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in REPLICATES.fields]
    return good.select(*typed, *extra), report


def load_annotations(spark: SparkSession, csv_path: str | list[str]) -> DataFrame:
    """The rows of all files, or ``QualityError`` naming every check that failed."""
    rows, heads = read_by_source(spark, csv_path, REPLICATES)
    table, report = ingest(rows, per="accession", heads=heads)
    quality.strict(report)
    return table


def size_faults(replicates: DataFrame, files: DataFrame) -> DataFrame:
    """Replicates that do not match exactly one sized file: id, n_files."""
    return quality.lookup_counts(replicates, sized_samples(files), "id").withColumnRenamed("n_rows", "n_files")


def with_sizes(replicates: DataFrame, files: DataFrame, on_missing: str = "fail") -> DataFrame:
    """Replicates with ``size_bytes``; strict unless ``on_missing`` is "skip".

    The strict way looks the sizes up once: the result is written and checked;
    ``forget`` removes it.
    """
    if on_missing != "fail":
        return replicates.join(sized_samples(files), "id")
    found = sized_samples(files).groupBy("id").agg(F.count("*").alias("_files"), F.any_value("size_bytes").alias("size_bytes"))
    sized = durable(replicates.join(found, "id", "left"), "sizes")
    faults = sized.where(F.coalesce("_files", F.lit(0)) != 1).agg(F.count_distinct(F.coalesce("id", F.lit(""))).alias("n"), F.min("id").alias("example"))
    told = faults.first()
    if told["n"]:
        raise quality.QualityError(f"{told['n']} replicates without one sized file, e.g. {told['example']}")
    kept = sized.drop("_files")
    kept._scratch_path = sized._scratch_path
    return kept


def batch_splits(
    replicates: DataFrame,
    files: DataFrame,
    accession: str = "accession",
    target_bytes: int = packing.TARGET_BYTES,
    mode: str = "balanced",
    on_missing: str = "fail",
    stretch: int = packing.STRETCH,
) -> DataFrame:
    """Replicates with size, split number and split label.

    ``balanced`` places the runs of equal sizes of an accession one after the
    other, ``stretch`` rows at a time; ``fill`` is parallel throughout, with less
    even loads.
    """
    sized = with_sizes(replicates, files, on_missing)
    if mode == "balanced":
        packed = packing.assign_splits(sized, accession, target_bytes, stretch)
    else:
        packed = packing.fill_splits(sized, accession, target_bytes)
    if on_missing == "fail":
        # Both ways have stored the rows in their own order by now.
        forget(sized)
    return packed.withColumn("split", split_label(accession))


def split_totals(splits: DataFrame, accession: str = "accession") -> DataFrame:
    return splits.groupBy(accession, "split_id").agg(
        F.count("*").alias("n_rows"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("total_bytes")
    )


def worklist_faults(replicates: DataFrame, files: DataFrame, repositories: DataFrame) -> DataFrame:
    """What keeps replicates from being fetched: lookup ("file" or "repository"), key, n_rows.

    A replicate must match exactly one file by id, and the file's repository
    exactly one repository.
    """
    found = files.where(F.col("id").isNotNull())
    wanted = replicates.where(F.col("id").isNotNull()).select("id")
    sites = found.join(wanted, "id", "left_semi").select(F.col("repository_id").alias("id"))
    lost = [
        quality.lookup_counts(keys, table.where(F.col("id").isNotNull()), "id").select(
            F.lit(lookup).alias("lookup"), F.col("id").alias("key"), "n_rows"
        )
        for lookup, keys, table in (("file", wanted, found), ("repository", sites, repositories))
    ]
    return lost[0].unionByName(lost[1])


def worklist(
    replicates: DataFrame, files: DataFrame, repositories: DataFrame, listing: DataFrame, on_missing: str = "fail"
) -> DataFrame:
    """What to fetch, one row per remote file, for all replicates at once.

    A ``.d`` folder yields every file below it, a ``.wiff`` its ``.wiff.scan``
    as well. Each listed file belongs to at most one sample path, so one join
    finds them all. Every replicate must match one file and one repository;
    with ``on_missing`` "skip" those that do not keep a row with what is known.
    No broadcast is forced: the optimizer broadcasts a side whose size it has
    checked, and adaptive skew joins split a hot repository.
    """
    if on_missing == "fail":
        faults = worklist_faults(replicates, files, repositories)
        with passing_shuffles(replicates.sparkSession):
            first = faults.agg(F.count("*").alias("n"), F.min(F.struct("lookup", "key", "n_rows")).alias("of")).first()
        if first["n"]:
            of = first["of"]
            raise quality.QualityError(
                f"{first['n']} keys not found exactly once, e.g. {of['lookup']} {of['key']}: {of['n_rows']}"
            )
    address = names.ftp_parts(F.col("url"))
    sites = repositories.select(
        F.col("id").alias("repository_id"),
        *[address[k].alias(k) for k in ("host", "port", "user", "password", "tls")],
    )
    samples = (
        replicates.select("id")
        .where(F.col("id").isNotNull())
        .join(files.select("id", "repository_id", F.col("remote_path").alias("sample_path")), "id", "left")
    )
    # The outermost .d folder below the root, or the .wiff a scan belongs to.
    relative = F.substring(F.col("path"), F.length("root_path") + 1, F.length("path"))
    folder = F.concat("root_path", F.nullif(F.regexp_extract(relative, r"(?i)^(.*?\.d)/", 1), F.lit("")))
    without_scan = F.expr("left(path, length(path) - 5)")
    scan = F.endswith(F.col("path"), F.lit(".scan")) & F.endswith(F.lower(without_scan), F.lit(".wiff"))
    # A path begins with its sample's, so only the rest of it goes along; whole where a root lists what is not below it.
    begins = F.startswith(F.col("path"), F.col("sample_path"))
    rest = F.substring(F.col("path"), F.length("sample_path") + 1, F.length("path"))
    parts = (
        unique_listing(listing)
        .where(~F.col("is_dir"))
        .withColumn("sample_path", F.coalesce(folder, F.when(scan, without_scan), F.col("path")))
        .select(
            "repository_id",
            "sample_path",
            F.when(begins, rest).alias("_rest"),
            F.when(~begins, F.col("path")).alias("_whole"),
            "size_bytes",
            F.when(folder.isNotNull(), "in_folder").when(scan, "scan").otherwise("whole").alias("kind"),
        )
    )
    name = names.output_name(F.col("id"), F.col("sample_path"))
    found = F.coalesce("_whole", F.concat("sample_path", "_rest"))
    inside = F.substring(F.col("remote_path"), F.length("sample_path") + 1, F.length("remote_path"))
    output = (
        F.when(F.col("kind") == "in_folder", F.concat(F.col("id"), F.lit(".d"), inside))
        .when(F.col("kind") == "scan", F.concat(name, F.lit(".scan")))
        .otherwise(name)
    )
    return (
        samples.join(parts, ["repository_id", "sample_path"], "left")
        .withColumn("remote_path", found)
        .join(sites, "repository_id", "left")
        .select(
            F.col("id").alias("sample_id"),
            "repository_id",
            "sample_path",
            F.coalesce("remote_path", "sample_path").alias("remote_path"),
            "size_bytes",
            F.concat(F.lit("raw/"), output).alias("output_path"),
            "host",
            "port",
            "user",
            "password",
            "tls",
        )
    )


def fetch_status(work: DataFrame, local: DataFrame) -> DataFrame:
    """State of each worklist row and the byte to go on from.

    ``local`` has output_path, size_bytes (finished file) and part_bytes
    (partial file), either null where there is none.
    """
    have = local.select("output_path", F.col("size_bytes").alias("have_bytes"), "part_bytes")
    done = F.col("have_bytes") == F.col("size_bytes")
    status = (
        F.when(done, "done")
        .when(F.col("part_bytes") > 0, "resume")
        .when(F.col("have_bytes").isNotNull(), "restart")
        .otherwise("new")
    )
    return (
        work.join(have, "output_path", "left")
        .withColumn("status", status)
        .withColumn("offset", F.when(F.col("status") == "resume", F.col("part_bytes")).otherwise(F.lit(0)))
        .drop("have_bytes", "part_bytes")
    )
