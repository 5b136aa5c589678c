"""What keeps jobs within disk and time on large tables: seen in plans, files and counts on small ones."""

import glob
import time

import pytest
from pyspark.sql import functions as F

from massloom.contracts import REPLICATES
from massloom.fixtures import queries, views
from massloom.operators import inventory, quality
from massloom.plans import replicates
from massloom.session import durable, many_files, shared_dir

NAMED = "id string, organism string, source_type string, material string, condition string, sample_group string, accession string"


def _shuffled(spark):
    """Shuffle files there are."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(blocks.apply(k).getName().startswith("shuffle_") for k in range(blocks.size()))


def _none_left(spark, before):
    for _ in range(50):
        if _shuffled(spark) <= before:
            return True
        time.sleep(0.1)
    return False


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_shuffle_files_of_durable_tables_go(spark):
    before = _shuffled(spark)
    table = durable(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counted")
    assert _none_left(spark, before)
    assert table.count() == 7


def test_listing_below_its_root_is_not_sorted(spark):
    rows = [
        ("r", "/a", "/a/x.raw", False, 5), ("r", "/a/", "/a/x.raw", False, 7), ("r", "/a/b", "/a/b/y.raw", False, 1),
        ("r", "/a", "/a/b/y.raw", None, None), ("r", "/c", "/a/z.raw", False, 2), (None, "/a", "/a/x.raw", False, 3), ("r", "/", "/top", True, None),
    ]
    listing = spark.createDataFrame(rows, "repository_id string, root_path string, path string, is_dir boolean, size_bytes long")
    below = inventory._below_root(listing)
    assert "SortAggregate" not in _plan(below)
    found = {(r["repository_id"], r["path"]): (r["root_path"], r["is_dir"], r["size_bytes"]) for r in below.collect()}
    assert found == {
        ("r", "/a/x.raw"): ("/a", False, 7), ("r", "/a/b/y.raw"): ("/a", False, 1), (None, "/a/x.raw"): ("/a", False, 3), ("r", "/top"): ("", True, None),
    }


def test_listing_is_made_in_one_pass(spark, sf):
    """one read of the lines, whether a second crawl lists them again or not."""
    plan = views.listing(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_extendedprice") and plan.count("Relation [l_") == 1


def test_annotations_are_made_once(spark, sf, monkeypatch):
    """F8, F9: all files of unlike headers come from one stored table."""
    labels = []
    monkeypatch.setattr(queries, "durable", lambda df, label: labels.append(label) or durable(df, label))
    queries._mixed_headers(spark, sf)
    assert labels == ["annotations"]


def test_checks_shuffle_keys_only(spark):
    """F8: without the check for whole rows none is shuffled whole."""
    rows = [("a", "o", "s", "m", "c", "g", "f"), ("a", "p", " ", "m", "c", "g", "f"), (None, None, "s", "m", "c", "g", "f"), (None, "o", "s", "m", "c", "g", "f"), ("a", "o", "s", "m", "c", "g", "h")]
    raw = spark.createDataFrame(rows, NAMED)
    report = quality.check_table(raw, REPLICATES, whole_rows=False, per="accession")
    keys = [line for line in _plan(report).splitlines() if "hashpartitioning" in line]
    assert keys and not any("organism#" in line.partition("hashpartitioning")[2] for line in keys)
    bad = {(r["accession"], r["check"], r["column"]): (r["n_bad"], r["sample"]) for r in report.where("n_bad > 0").collect()}
    assert {k: x for k, x in bad.items() if k[1] != "null"} == {("f", "blank", "source_type"): (1, None), ("f", "duplicate_key", "id"): (1, "a")}
    assert bad["f", "null", "id"] == (2, None)


def test_report_is_made_once(spark):
    """the table is taken by the stored report."""
    raw = spark.createDataFrame([("a", "o", "s", "m", "c", "g", "f"), ("a", "o", "s", "m", "c", "g", "f"), ("a", "o", "s", "m", "c", "g", "h")], NAMED)
    heads = spark.createDataFrame([("f", []), ("h", []), ("bare", []), ("cut", ["id"])], "accession string, missing array<string>")
    kept = []
    table, report = replicates.ingest(raw, per="accession", heads=heads, store=lambda made: kept.append(durable(made, "report")) or kept[0])
    assert [r["accession"] for r in table.collect()] == ["h"]
    assert report is kept[0]
    lost = {(r["accession"], r["check"]) for r in report.where("n_bad > 0").collect()}
    assert lost == {("f", "duplicate_key"), ("bare", "no_rows"), ("cut", "missing_column")}


def test_arrived_files_stand_alone(spark, sf, tmp_path):
    """a folder of arrivals holds its files and no folder for each."""
    rows = views.replicates(spark, sf)
    queries._written_by_accession(spark, rows, f"{tmp_path}/in")
    names = {r["accession"] for r in rows.select("accession").distinct().collect()}
    assert {p.name for p in (tmp_path / "in").iterdir() if not p.name.startswith(".")} == {f"{n}.csv" for n in names}


def test_many_small_files_share_tasks(spark, tmp_path):
    """files far smaller than Spark's cost of opening one are read several to a task."""
    for k in range(120):
        (tmp_path / f"{k}.csv").write_text(f"id\n{k}\n")
    read = many_files(spark).read.schema("id string").option("header", True).csv(str(tmp_path))
    assert read.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism
    assert {r["id"] for r in read.collect()} == {str(k) for k in range(120)}
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        assert many_files(spark).conf.get("spark.sql.caseSensitive") == "true"
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def _samples(spark):
    named = spark.createDataFrame([(f"r_{k}", "o", "s", "m", "c", "g", "r") for k in range(4)], NAMED)
    files = spark.createDataFrame([(f"r_{k}", "r", f"/a/{k}.raw", 5 << 30) for k in range(4)], "id string, repository_id string, remote_path string, size_bytes long")
    return named, files


@pytest.mark.parametrize("mode", ["fill", "balanced"])
def test_sizes_do_not_stay(spark, mode):
    """the table of sizes goes once rows are stored in packing order."""
    before = set(glob.glob(f"{shared_dir(spark).removeprefix('file:')}/sizes-*"))
    named, files = _samples(spark)
    packed = replicates.batch_splits(named, files, mode=mode)
    assert set(glob.glob(f"{shared_dir(spark).removeprefix('file:')}/sizes-*")) == before
    assert sorted((r["id"], r["split_id"]) for r in packed.collect()) == [(f"r_{k}", k // 2) for k in range(4)]


def test_worklist_leaves_no_shuffles_of_its_check(spark):
    """and a root that is not above its files still gives their whole paths."""
    named, files = _samples(spark)
    files = files.withColumn("remote_path", F.when(F.col("id") == "r_3", F.lit("/other.d")).otherwise(F.col("remote_path")))
    sites = spark.createDataFrame([("r", "ftp://h/a", "d")], "id string, url string, doi string")
    listing = spark.createDataFrame(
        [("r", "/a", f"/a/{k}.raw", False, k) for k in range(3)] + [("r", "/other", "/zzzzz/.d/x", False, 9), ("r", "/other", "/other.d/y/z", False, 8)],
        "repository_id string, root_path string, path string, is_dir boolean, size_bytes long",
    )
    before = _shuffled(spark)
    work = replicates.worklist(named, files, sites, listing)
    assert _none_left(spark, before)
    rows = {(r["sample_id"], r["remote_path"], r["size_bytes"], r["output_path"]) for r in work.collect()}
    assert {x for x in rows if x[0] != "r_3"} == {(f"r_{k}", f"/a/{k}.raw", k, f"raw/r_{k}.raw") for k in range(3)}
    assert ("r_3", "/other.d/y/z", 8, "raw/r_3.d/y/z") in rows
