"""File inventory: directory sizes, companion files, sample classification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from massloom.functions import names

# Fixed values.
SAMPLE_MIN_BYTES = 157286400  # samples are strictly larger than 150 MiB
COMPANION_SUFFIX = ".wiff.scan"
COMPANION_TAIL = ".scan"


def _root(root_path: Column) -> Column:
    return F.rtrim(root_path, F.lit("/"))


def unique_listing(listing: DataFrame) -> DataFrame:
    """One row per repository and path, so that a repeated crawl does not count twice.

    ``root_path`` comes without a slash at its end; of several roots that list
    one path the shortest is kept. ``in_bundle``: the path lies below a ``.d``
    directory. Only names below the scan root count.
    """
    root = _root(F.col("root_path"))
    return _one_per_path(
        listing, F.min(F.struct(F.length(root).alias("n"), root.alias("root_path"))).getField("root_path")
    )


def _one_per_path(listing: DataFrame, root: Column) -> DataFrame:
    relative = F.substring(F.col("path"), F.length("root_path") + 2, F.length("path"))
    return (
        listing.groupBy("repository_id", "path")
        .agg(root.alias("root_path"), F.bool_or("is_dir").alias("is_dir"), F.max("size_bytes").alias("size_bytes"))
        .withColumn("in_bundle", F.contains(F.lower(relative), F.lit(".d/")))
    )


def _below_root(listing: DataFrame) -> DataFrame:
    """The unique listing of what lies below its root: the root is then the beginning of the path, and its length says which.

    So the aggregate holds numbers only; one that holds texts would sort all rows.
    """
    root = _root(F.col("root_path"))
    below = listing.where(F.startswith(F.col("path"), F.concat(root, F.lit("/"))))
    return _one_per_path(below, F.left(F.col("path"), F.min(F.length(root))))


def contributions(listing: DataFrame) -> DataFrame:
    """Rows (path, bytes) whose sum per path is the rolled-up, pruned listing.

    A file contributes its size to itself. Files are first summed per parent
    folder; that sum goes to the parent and to all folders above it, up to but
    not including the root. So rows are multiplied by the depth only after
    they have shrunk to folders. Listed folders contribute 0, which keeps the
    empty ones. What lies below a ``.d`` directory is left out; the directory
    itself stays, with its full size.

    Both branches read the same columns of the unique listing and filter only
    on its aggregates, so that its shuffle is made once and used twice.
    """
    below = _below_root(listing)
    listed = below.where(~F.col("in_bundle")).select(
        "repository_id",
        F.col("path").alias("remote_path"),
        F.when(F.col("is_dir"), F.lit(0)).otherwise(F.col("size_bytes")).alias("size_bytes"),
        "is_dir",
    )
    total = F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("size_bytes")
    return listed.unionByName(_up_the_folders(_parents(below, total), "size_bytes"))


def _parents(below: DataFrame, *totals: Column) -> DataFrame:
    """Files of a unique listing summed per parent folder."""
    return (
        below.where(~F.col("is_dir"))
        .groupBy(
            "repository_id",
            # Of the root, which the folder begins with, the length.
            F.length("root_path").alias("_root"),
            names.folder_name(F.col("path")).alias("_parent"),
            # The same for all files of a folder.
            "in_bundle",
        )
        .agg(*totals)
    )


def _up_the_folders(parents: DataFrame, *totals: str) -> DataFrame:
    """The totals of a parent folder for itself and every folder above it, below the root."""
    root = F.left(F.col("_parent"), F.col("_root"))
    relative = F.substring(F.col("_parent"), F.col("_root") + 2, F.length("_parent"))
    # Up to the outermost .d directory, where there is one.
    kept = F.when(F.col("in_bundle"), F.regexp_extract(relative, r"(?i)^(.*?\.d)(?:/|\z)", 1)).otherwise(relative)
    return (
        parents.withColumn("_names", F.split(kept, "/"))
        .withColumn(
            "_folders",
            F.transform(
                F.sequence(F.lit(1), F.size("_names")),
                lambda k: F.concat_ws("/", root, F.array_join(F.slice("_names", F.lit(1), k), "/")),
            ),
        )
        .select(
            "repository_id",
            F.explode_outer(F.when(F.col("_parent") != root, F.col("_folders"))).alias("remote_path"),
            *totals,
            F.lit(True).alias("is_dir"),
        )
        .where(F.col("remote_path").isNotNull())
    )


def listing_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """What two crawls do not have in common: rows of their unique listings, ``sign`` -1 (gone) or 1 (new).

    A path whose size, kind or root has changed is gone with its old values and
    new with its new ones; a moved file is gone from one path and new at another.
    One aggregate over both crawls: rows that are alike cancel out.
    """
    columns = ["repository_id", "path", "root_path", "is_dir", "size_bytes", "in_bundle"]
    both = (
        _below_root(before).select(*columns, F.lit(-1).alias("sign")).unionByName(_below_root(after).select(*columns, F.lit(1).alias("sign")))
    )
    return both.groupBy(*columns).agg(F.sum("sign").cast("int").alias("sign")).where(F.col("sign") != 0)


def signed_contributions(changes: DataFrame) -> DataFrame:
    """Rows (path, bytes and counts) whose sum per path is what ``changes`` add to or take from a roll-up.

    The counts, of files and folders that bear on the path and of known sizes,
    tell when a folder has lost its last file and a path is to go.
    """
    sign, known = F.col("sign"), F.col("size_bytes").isNotNull()
    size = F.when(F.col("is_dir"), F.lit(0)).otherwise(F.col("size_bytes"))
    listed = changes.where(~F.col("in_bundle")).select(
        "repository_id",
        F.col("path").alias("remote_path"),
        F.coalesce(size * sign, F.lit(0)).alias("size_bytes"),
        F.when(F.col("is_dir"), 0).otherwise(sign).cast("long").alias("n_files"),
        F.when(F.col("is_dir"), sign).otherwise(0).cast("long").alias("n_folders"),
        F.when(F.col("is_dir") | known, sign).otherwise(0).cast("long").alias("n_known"),
    )
    parents = _parents(
        changes,
        F.coalesce(F.sum(F.col("size_bytes") * sign), F.lit(0)).alias("size_bytes"),
        F.sum(sign.cast("long")).alias("n_folders"),
    )
    folders = _up_the_folders(parents, "size_bytes", "n_folders").drop("is_dir")
    return listed.unionByName(
        folders.withColumn("n_files", F.lit(0).cast("long")).withColumn("n_known", F.col("n_folders"))
    )


ROLLUP_COUNTS = ["size_bytes", "n_files", "n_folders", "n_known"]


def roll_up_state(listing: DataFrame) -> DataFrame:
    """The roll-up in the form that changes can be added to, to be stored: path, size_bytes and counts."""
    first = _below_root(listing).withColumn("sign", F.lit(1))
    return _summed(signed_contributions(first))


def _summed(rows: DataFrame) -> DataFrame:
    return (
        rows.groupBy("repository_id", "remote_path")
        .agg(*[F.sum(c).alias(c) for c in ROLLUP_COUNTS])
        .where((F.col("n_files") > 0) | (F.col("n_folders") > 0))
    )


def roll_up_changed(state: DataFrame, changes: DataFrame) -> DataFrame:
    """The stored state brought up to date by ``listing_changes``; only repositories with changes are shuffled."""
    touched = changes.select("repository_id").distinct()
    added = state.join(touched, "repository_id", "left_semi").unionByName(signed_contributions(changes))
    return state.join(touched, "repository_id", "left_anti").unionByName(_summed(added))


def rolled_up(state: DataFrame) -> DataFrame:
    """The state as ``roll_up`` gives it; a file of unknown size keeps a null."""
    return state.select(
        "repository_id",
        "remote_path",
        F.when(F.col("n_known") > 0, F.col("size_bytes")).alias("size_bytes"),
        (F.col("n_folders") > 0).alias("is_dir"),
    )


def roll_up(rows: DataFrame) -> DataFrame:
    """Files and directories, each directory with the bytes of all files below."""
    return rows.groupBy("repository_id", "remote_path").agg(
        F.sum("size_bytes").alias("size_bytes"), F.bool_or("is_dir").alias("is_dir")
    )


def fuse(rows: DataFrame) -> DataFrame:
    """Rolls up and adds each ``.wiff.scan`` to its ``.wiff`` in one aggregate.

    Scan rows are counted under the path without ``.scan``, so no self join is
    needed. That path must match exactly, while the suffix is recognised in
    any case; scans without partner vanish.
    """
    is_scan = F.endswith(F.lower("remote_path"), F.lit(COMPANION_SUFFIX))
    whole = F.expr(f"left(remote_path, length(remote_path) - {len(COMPANION_TAIL)})")
    tagged = rows.withColumn("_scan", is_scan).withColumn(
        "remote_path", F.when(is_scan, whole).otherwise(F.col("remote_path"))
    )
    return (
        tagged.groupBy("repository_id", "remote_path")
        .agg(
            F.count_if(~F.col("_scan")).alias("_own"),
            F.sum(F.when(~F.col("_scan"), F.col("size_bytes"))).alias("_size"),
            F.sum(F.when(F.col("_scan"), F.col("size_bytes"))).alias("_extra"),
        )
        .where(F.col("_own") > 0)
        .select(
            "repository_id",
            "remote_path",
            (F.col("_size") + F.coalesce("_extra", F.lit(0))).alias("size_bytes"),
        )
    )


def classify(items: DataFrame, scan_timestamp: Column) -> DataFrame:
    """The ``files`` table: samples get an id, all other rows a null id."""
    path = F.col("remote_path")
    sample = (F.col("size_bytes") > SAMPLE_MIN_BYTES) & names.is_sample_name(path)
    return items.select(
        F.when(sample, names.sample_id(F.col("repository_id"), path)).alias("id"),
        "repository_id",
        "remote_path",
        "size_bytes",
        scan_timestamp.alias("scan_timestamp"),
    )
