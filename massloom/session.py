"""Session defaults and durable intermediate tables."""

from __future__ import annotations

import contextlib
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "massloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs expect; a cluster's own settings win."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Spectra rows carry whole peak arrays, so Arrow batches are kept short.
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def many_files(spark: SparkSession) -> SparkSession:
    """A session beside ``spark``, with its settings, for jobs over very many small files.

    They are listed by as many tasks as there is room for, not by one for each
    path, and several are read by one task where they are small.
    """
    own = getattr(spark, "_massloom_many_files", None)
    if own is None:
        own = spark._massloom_many_files = spark.newSession()
    settings = {k: v for k, v in spark.conf.getAll.items() if own.conf.isModifiable(k)}
    settings["spark.sql.sources.parallelPartitionDiscovery.parallelism"] = str(4 * spark.sparkContext.defaultParallelism)
    settings["spark.sql.files.openCostInBytes"] = str(64 << 10)
    for key, value in settings.items():
        own.conf.set(key, value)
    return own


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors, once per session.

    Needed where it is not installed there; the same as ``--py-files``.
    """
    if getattr(spark.sparkContext, "_massloom_shipped", False):
        return
    here = Path(__file__).resolve().parent
    archive = shutil.make_archive(tempfile.mkdtemp(prefix="massloom-") + "/massloom", "zip", here.parent, here.name)
    spark.sparkContext.addPyFile(archive)
    spark.sparkContext._massloom_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only where the session names none (single-machine runs, tests) is a folder
    made here, and then it is recorded so that later calls share it.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    made = tempfile.mkdtemp(prefix="massloom-")
    spark.sparkContext.setCheckpointDir(made)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new place in the shared folder; ``job_scope`` removes it at its end."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextlib.contextmanager
def job_scope(spark: SparkSession) -> Iterator[None]:
    """Removes the intermediate tables made inside it, when its results have been written or collected."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            remove(spark, path)


#: Spark's setting for it.
_PASSING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def passing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that is made and run inside go when it ends, not when the driver collects its garbage.

    For steps whose result is kept elsewhere: a later step would otherwise find
    the disks full of what the ones before have shuffled.
    """
    was = spark.conf.get(_PASSING, "false")
    spark.conf.set(_PASSING, "true")
    try:
        yield
    finally:
        spark.conf.set(_PASSING, was)


def durable(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage, survives lost executors, and keeps column pruning, which
    a row-wise RDD checkpoint would give up. What was shuffled for it is removed.
    ``forget`` or the ``job_scope`` around it removes the table.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with passing_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._scratch_path = path
    return back


def forget(table: DataFrame) -> None:
    """Removes a table that ``durable`` returned and nothing reads any more."""
    remove(table.sparkSession, table._scratch_path)
