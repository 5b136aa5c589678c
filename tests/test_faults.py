"""Versions, faults and unlike types: small inputs with results written out."""

import datetime
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from massloom.contracts import REPLICATES
from massloom.functions.types import common_type
from massloom.operators.asof import last_marked
from massloom.sinks import tables as sinks
from massloom.sources import tables as sources
from massloom.sources.files import first_lines
from massloom.streaming import ingest as streaming

HEADER = ",".join(REPLICATES.names)


def _csv(folder, name, *rows, at=None, header=HEADER):
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / name
    path.write_text("\n".join([header, *rows]) + "\n")
    if at is not None:
        os.utime(path, (at, at))


def _row(key):
    return f"{key},a,b,c,d,e"


def _ids(spark, table):
    found = sources.read_table(spark, str(table), REPLICATES, by="accession").collect()
    return sorted((r.accession, r.id) for r in found)


@pytest.mark.parametrize("per_batch", [1, 1000])
@pytest.mark.parametrize("apart", [False, True])
def test_stream_does_not_depend_on_what_arrives_together(spark, tmp_path, monkeypatch, per_batch, apart):
    monkeypatch.setattr(streaming, "FILES_PER_BATCH", per_batch)
    arrivals = [
        [("ACC.csv", [_row("x1"), _row("x2")], 100), ("B b=%.csv", [_row("y1")], 100), ("C.csv", [_row("z1")], 100), ("D.csv", [_row("d1")], 100)],
        # A repeated id, a header alone, a correction.
        [("ACC.csv", [_row("x1"), _row("x1")], 200), ("B b=%.csv", [], 200), ("C.csv", [_row("z2")], 200)],
        # Older than what is there.
        [("C.csv", [_row("z0")], 50), ("D.csv", [], 50)],
    ]
    places = [str(tmp_path / x) for x in ("table", "report", "offsets")]
    for number, files in enumerate(arrivals):
        for name, rows, at in files:
            _csv(tmp_path / "in" / str(number), name, *rows, at=1_700_000_000 + at)
        if apart:
            streaming.ingest_replicates(spark, str(tmp_path / "in" / "*"), *places).awaitTermination()
    if not apart:
        streaming.ingest_replicates(spark, str(tmp_path / "in" / "*"), *places).awaitTermination()
    assert _ids(spark, tmp_path / "table") == [("C", "z2"), ("D", "d1")]


def test_first_lines_of_odd_files(spark, tmp_path):
    for name, raw in {
        "a.csv": b"\xef\xbb\xbfid,x\r\n1,2\r\n", "b.csv": b"\n\nid\n", "c.csv": b"id,y", "d.csv": b"\n",
        "e 1%.csv": ("w" * 40_000 + ",v\nrest").encode(), "f.csv": b"one\rtwo",
    }.items():
        (tmp_path / name).write_bytes(raw)
    got = {r.path.rsplit("/", 1)[-1]: r.line for r in first_lines(spark, str(tmp_path)).collect()}
    assert got == {"a.csv": "id,x", "b.csv": "id", "c.csv": "id,y", "d.csv": None, "e 1%.csv": "w" * 40_000 + ",v", "f.csv": "one"}
    assert dict((f.rsplit("/", 1)[-1], h) for f, h in sources.csv_headers(spark, str(tmp_path)))["c.csv"] == ("id", "y")


@pytest.mark.parametrize(
    ("a", "b", "both"),
    [
        ("int", "int", "int"), ("tinyint", "bigint", "bigint"), ("bigint", "float", "double"), ("smallint", "float", "float"),
        ("int", "string", "string"), ("boolean", "string", "string"), ("boolean", "int", "int"), ("void", "date", "date"),
        ("date", "timestamp", "timestamp"), ("date", "timestamp_ntz", "timestamp_ntz"), ("date", "string", "string"), ("binary", "string", "binary"),
        ("decimal(10,2)", "int", "decimal(12,2)"), ("decimal(38,10)", "decimal(38,0)", "double"), ("decimal(5,1)", "decimal(7,4)", "decimal(8,4)"),
        ("array<int>", "array<string>", "array<string>"), ("array<int>", "double", "array<double>"),
        ("struct<a:int,b:string>", "struct<B:int,c:date>", "struct<a:int,b:string,c:date>"),
        ("map<string,int>", "map<string,double>", "map<string,double>"),
    ],
)
def test_common_types(a, b, both):
    parse = lambda text: T._parse_datatype_string(text)
    assert common_type(parse(a), parse(b)).simpleString() == parse(both).simpleString()
    flipped = common_type(parse(b), parse(a))
    assert flipped.simpleString().lower().count(":") == parse(both).simpleString().count(":")
    if not isinstance(flipped, T.StructType):
        assert flipped.simpleString() == parse(both).simpleString()


def test_union_keeps_nulls_and_nesting(spark):
    one = spark.createDataFrame([(1, (1, [None, (2,)]), None), (None, None, 5)], "k int, s struct<a:int,t:array<struct<b:int>>>, n int")
    two = spark.createDataFrame([("x", ([("y", 1.5)],), "z")], "K string, s struct<t:array<struct<b:string,c:double>>>, m string")
    rows = sources.union_relaxed([one, two]).collect()
    assert [r.k for r in rows] == ["1", None, "x"] and rows[0].asDict(True)["s"] == {"a": 1, "t": [None, {"b": "2", "c": None}]}
    assert rows[1].s is None and (rows[2].s.a, rows[2].n, rows[2].m) == (None, None, "z")
    with pytest.raises(TypeError, match="no common type"):
        sources.union_relaxed([one, spark.createDataFrame([("x",)], "s string")])
    alone = spark.createDataFrame([(datetime.date(2024, 1, 2),)], "d date")
    assert sources.union_relaxed([alone]).collect() == alone.collect()


def test_rows_without_place_stay(spark):
    rows = [("r", 1, 1, 10), ("r", None, 1, 11), ("r", 2, 2, 12), ("r", None, 2, 13), (None, 1, 1, 14), (None, 2, 2, 15), ("s", None, 1, 16)]
    frame = spark.createDataFrame(rows, "run string, at long, level int, number long")
    got = last_marked(frame, "run", "at", F.col("level") == 1, "number", "last", block_rows=1).collect()
    assert {(r.run, r.number): r["last"] for r in got} == {
        ("r", 10): 10, ("r", 11): None, ("r", 12): 10, ("r", 13): None, (None, 14): 14, (None, 15): 14, ("s", 16): None,
    }


def test_partitioned_table_takes_one_shuffle(spark, tmp_path):
    table = spark.range(1000).select((F.col("id") % 3).cast("string").alias("p"), "id")
    plan = sinks._clustered(table, ["p"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "REBALANCE" in plan
    sinks.write_partitioned(table, str(tmp_path / "t"), "p", ["id"])
    odd = spark.createDataFrame([("a/b c=%", 1), ("1", 2)], "p string, id long")
    sinks.write_partitioned(odd, str(tmp_path / "t"), "p", ["id"])
    read = lambda: sorted((r.p, r.id) for r in spark.read.schema("id long, p string").parquet(str(tmp_path / "t")).where("p in ('a/b c=%', '1')").collect())
    assert read() == [("1", 2), ("a/b c=%", 1)]
    sinks.remove_partitions(spark, str(tmp_path / "t"), "p", ["a/b c=%", "no such"])
    assert read() == [("1", 2)]
    sinks.remove_partitions(spark, str(tmp_path / "nowhere"), "p", ["1"])
