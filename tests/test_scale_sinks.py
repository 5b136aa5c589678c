"""Batches as files: one folder for each, of which there may be very many."""

import glob
from pathlib import Path

from pyspark.sql import functions as F

from massloom.sinks import tables as sinks


def test_split_files_are_moved_by_tasks(spark, tmp_path, monkeypatch):
    """the driver does not move the file of each folder."""
    rows = spark.range(300).select(F.lit("a").alias("accession"), (F.col("id") % 150).cast("int").alias("split_id"), F.col("id").cast("string").alias("id"))
    asked = {}
    writer = type(rows.write)
    monkeypatch.setattr(writer, "option", lambda self, key, value, option=writer.option: asked.update({key: value}) or option(self, key, value))
    sinks.write_splits(rows, str(tmp_path / "splits"))
    assert asked["mapreduce.fileoutputcommitter.algorithm.version"] == "2"
    assert len(glob.glob(f"{tmp_path}/splits/split=a_*/part-*.csv")) == 150
    assert not Path(tmp_path, "splits", "_temporary").exists()
    read = spark.read.option("header", True).schema("id string, split string").csv(str(tmp_path / "splits"))
    assert sorted((int(r["id"]), r["split"]) for r in read.collect()) == [(k, f"a_{k % 150:03d}") for k in range(300)]
