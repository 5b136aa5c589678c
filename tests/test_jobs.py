"""Jobs from input files to written tables."""

import base64
import math
import statistics
import struct
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from massloom import contracts, session
from massloom.operators.quality import QualityError
from massloom.plans import breakdown, intensity, replicates, repositories, run_metadata, scan_metadata
from massloom.sinks import sql_dump
from massloom.sinks import tables as sinks
from massloom.sources import mzml, tables
from massloom.sources.listing import list_folder, read_listing
from massloom.streaming import ingest as streaming


def _rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


MANIFEST = "doi,id,url,extra\n10.1/a,007,ftp://h/a,x\n10.1/b,P2,ftp://h/b,y\n"
ANNOTATION = "id,organism,source_type,material,condition,sample_group\n{0}1,human,cell,plasma,healthy,sample-0001\n"


def test_manifest(spark, tmp_path):
    (tmp_path / "m.csv").write_text(MANIFEST)
    table = repositories.load_manifest(spark, str(tmp_path / "m.csv"))
    assert table.columns == ["id", "url", "doi"]
    assert _rows(table, "id") == [("007",), ("P2",)]
    (tmp_path / "bad.csv").write_text("id,url\n1,2\n")
    with pytest.raises(QualityError, match="missing_column.doi"):
        repositories.load_manifest(spark, str(tmp_path / "bad.csv"))
    (tmp_path / "null.csv").write_text('doi,id,url\n"",1,ftp://h\n')
    with pytest.raises(QualityError, match="null.doi"):
        repositories.load_manifest(spark, str(tmp_path / "null.csv"))


def test_annotations(spark, tmp_path):
    (tmp_path / "A.csv").write_text(ANNOTATION.format("a"))
    (tmp_path / "B.csv").write_text(ANNOTATION.format("a"))  # ids are unique per file only
    table = replicates.load_annotations(spark, str(tmp_path))
    assert _rows(table, "accession", "id") == [("A", "a1"), ("B", "a1")]
    assert _rows(tables.replicate_ids(table), "id") == [("a1",), ("a1",)]


def test_stream_takes_each_file_once(spark, tmp_path):
    folder, table, report, at = (str(tmp_path / n) for n in ("in", "table", "report", "at"))
    (tmp_path / "in").mkdir()

    def call():
        streaming.ingest_replicates(spark, folder, table, report, at).awaitTermination()
        return _rows(tables.read_table(spark, table, contracts.REPLICATES), "id")

    (tmp_path / "in" / "A.csv").write_text(ANNOTATION.format("a"))
    (tmp_path / "in" / "bad.csv").write_text(ANNOTATION.format("x").replace("human", " "))
    assert call() == [("a1",)]
    assert call() == [("a1",)]
    (tmp_path / "in" / "B.csv").write_text(ANNOTATION.format("b"))
    assert call() == [("a1",), ("b1",)]
    faults = spark.read.parquet(report).where("n_bad > 0")
    assert _rows(faults, "accession", "check", "column") == [("bad", "blank", "organism")]


def test_stream_of_manifests(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "m.csv").write_text("id,url,doi\nP1,ftp://h/a,10.1/a\n")
    streaming.ingest_repositories(
        spark, str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "r"), str(tmp_path / "c")
    ).awaitTermination()
    assert _rows(spark.read.parquet(str(tmp_path / "t")), "id") == [("P1",)]


def test_listing_sources(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.raw").write_bytes(b"12345")
    seen = list_folder(spark, str(tmp_path), "P")
    assert _rows(seen, "root_path", "path", "size_bytes") == [(str(tmp_path), f"{tmp_path}/sub/a.raw", 5)]
    assert _rows(repositories.build_files(seen), "remote_path", "size_bytes") == [
        (f"{tmp_path}/sub", 5), (f"{tmp_path}/sub/a.raw", 5),
    ]
    seen.write.csv(str(tmp_path / "csv"), header=True)
    assert _rows(read_listing(spark, str(tmp_path / "csv"), "csv"), "path", "size_bytes") == _rows(
        seen, "path", "size_bytes"
    )


FILES = "id string, repository_id string, remote_path string, size_bytes bigint, scan_timestamp timestamp"
GIB = 1024**3


@pytest.fixture
def catalogue(spark):
    files = spark.createDataFrame(
        [
            ("P_a", "P", "/r/a.wiff", 6 * GIB, None),
            ("P_b", "P", "/r/b.d", 7 * GIB, None),
            ("P_c", "P", "/r/c.raw.gz", GIB, None),
            (None, "P", "/r/readme.txt", 10, None),
        ],
        FILES,
    )
    annotated = spark.createDataFrame(
        [(f"P_{k}", "human", "cell", "plasma", c, "sample-0001", "ACC") for k, c in (("a", "x"), ("b", "y"), ("c", "x"))],
        "id string, organism string, source_type string, material string, condition string, sample_group string, accession string",
    )
    sites = spark.createDataFrame([("P", "ftp://me@Host/r/", "10.1/p")], "id string, url string, doi string")
    listing = spark.createDataFrame(
        [
            ("P", "/r", "/r/a.wiff", False, 5), ("P", "/r", "/r/a.wiff.scan", False, 1),
            ("P", "/r", "/r/b.d/x", False, 2), ("P", "/r", "/r/b.d/sub/y", False, 3),
            ("P", "/r", "/r/c.raw.gz", False, 4), ("P", "/r", "/r/c.raw.gz", False, 4),
            ("P", "/r", "/r/readme.txt", False, 10),
        ],
        contracts.LISTING,
    )
    return files, annotated, sites, listing


def test_worklist_and_status(spark, catalogue):
    files, annotated, sites, listing = catalogue
    work = replicates.worklist(annotated, files, sites, listing)
    assert _rows(work, "output_path", "remote_path", "size_bytes", "host", "user") == [
        ("raw/P_a.wiff", "/r/a.wiff", 5, "host", "me"),
        ("raw/P_a.wiff.scan", "/r/a.wiff.scan", 1, "host", "me"),
        ("raw/P_b.d/sub/y", "/r/b.d/sub/y", 3, "host", "me"),
        ("raw/P_b.d/x", "/r/b.d/x", 2, "host", "me"),
        ("raw/P_c.raw.gz", "/r/c.raw.gz", 4, "host", "me"),
    ]
    local = spark.createDataFrame(
        [("raw/P_a.wiff", 5, None), ("raw/P_a.wiff.scan", None, 1), ("raw/P_b.d/x", 9, None)],
        "output_path string, size_bytes bigint, part_bytes bigint",
    )
    assert _rows(replicates.fetch_status(work, local), "output_path", "status", "offset") == [
        ("raw/P_a.wiff", "done", 0), ("raw/P_a.wiff.scan", "resume", 1), ("raw/P_b.d/sub/y", "new", 0),
        ("raw/P_b.d/x", "restart", 0), ("raw/P_c.raw.gz", "new", 0),
    ]


def test_batches(spark, catalogue, tmp_path):
    files, annotated, *_ = catalogue
    splits = replicates.batch_splits(annotated, files)
    assert _rows(splits, "id", "split") == [("P_a", "ACC_000"), ("P_b", "ACC_001"), ("P_c", "ACC_000")]
    assert _rows(replicates.split_totals(splits), "split_id", "n_rows", "total_bytes") == [
        (0, 2, 7 * GIB), (1, 1, 7 * GIB),
    ]
    sinks.write_splits(splits.drop("split"), str(tmp_path / "s"))
    assert sorted(p.name for p in (tmp_path / "s").glob("split=*")) == ["split=ACC_000", "split=ACC_001"]
    twice = files.unionAll(files.where("id = 'P_a'"))
    with pytest.raises(QualityError, match="P_a"):
        replicates.batch_splits(annotated, twice)
    with pytest.raises(QualityError, match="P_c"):
        replicates.batch_splits(annotated, files.where("id <> 'P_c'"))
    assert replicates.batch_splits(annotated, files.where("id <> 'P_c'"), on_missing="skip").count() == 2


def test_breakdown(catalogue):
    files, annotated, *_ = catalogue
    cuts = breakdown.olap_cuts(breakdown.dataset(annotated, files))
    # One repository, one organism: only the cut with two groups is left.
    assert _rows(cuts, "scope", "organism", "cut_column", "measure", "label", "value") == [
        ("organism", "human", "condition", "replicates", "x", 2),
        ("organism", "human", "condition", "replicates", "y", 1),
    ]


def test_summaries_and_csv(spark, catalogue, tmp_path):
    files, *_ = catalogue
    samples = repositories.samples_summary(files)
    assert _rows(samples, "sample_group", "remote_path", "size") == [
        ("sample-0001", "/r/a.wiff", "6.0 GB"), ("sample-0002", "/r/b.d", "7.0 GB"), ("sample-0003", "/r/c.raw.gz", "1.0 GB"),
    ]
    sinks.write_csv_by(samples, str(tmp_path / "samples"), ["repository_id"], ["remote_path"])
    text = "".join(p.read_text() for p in (tmp_path / "samples" / "repository_id=P").glob("*.csv"))
    assert "P_a,,,,,sample-0001" in text.replace('""', "")
    assert _rows(repositories.other_summary(files), "size", "remote_path") == [("10.0 B", "/r/readme.txt")]


def test_dump(spark, catalogue, tmp_path):
    files, annotated, sites, _ = catalogue
    lines = sql_dump.dump_lines({"repositories": sites, "files": files, "replicates": annotated}, {"id": ["P_a", "P"]})
    sql_dump.write_dump(lines, str(tmp_path / "dump"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "dump").glob("part-*")))
    assert text.splitlines()[:3] == ["-- generated by massloom", "BEGIN;", ""]
    assert text.rstrip().endswith("COMMIT;")
    assert text.count("INSERT INTO") == 3
    assert "    remote_path TEXT NOT NULL,\n    size_bytes BIGINT,\n    scan_timestamp TIMESTAMP\n);" in text
    assert text.index("CREATE TABLE IF NOT EXISTS files") < text.index("INSERT INTO files")
    only = sql_dump.answer_request({"files": files, "replicates": annotated}, "replicates", None)
    assert "files" not in {r["line"].split(" ")[2] for r in only.where("section = 2").collect()}


def test_requests(spark, tmp_path):
    (tmp_path / "all.request").write_text("{}\n")
    (tmp_path / "some.request").write_text('{"target_tables": "files", "filters": "{\\"id\\": [\\"a\\"]}"}\n')
    found = tables.read_requests(spark, str(tmp_path))
    assert _rows(found, "request_id") == [("all",), ("some",)]
    assert tables.parse_filters(found.where("request_id = 'some'").first()["filters"]) == {"id": ["a"]}


def test_table_source_and_sinks(spark, tmp_path, catalogue):
    files, annotated, *_ = catalogue
    empty = tables.read_table(spark, str(tmp_path / "nothing"), contracts.FILES)
    assert empty.count() == 0 and empty.columns == contracts.FILES.names
    path = str(tmp_path / "replicates")
    sinks.write_partitioned(annotated, path, "accession")
    sinks.write_partitioned(annotated.withColumn("accession", F.lit("B")).limit(1), path, "accession")
    assert tables.read_table(spark, path, contracts.REPLICATES).count() == 4
    assert sinks.not_yet_done(files.where("id is not null"), annotated.where("condition = 'x'"), "id").count() == 1
    mixed = tmp_path / "mixed"
    spark.sql("select 'P' repository_id, '/a' remote_path, 5 size_bytes").write.parquet(str(mixed / "one"))
    spark.sql("select '/b' remote_path, 'P' repository_id, 6L size_bytes, 'x' id").write.parquet(str(mixed / "two" / "deep"))
    assert _rows(tables.read_table(spark, str(mixed), contracts.FILES), "remote_path", "size_bytes") == [("/a", 5), ("/b", 6)]
    wide = tables.union_relaxed([spark.sql("select 1 a, 'x' b"), spark.sql("select 2.5D a, 3 c")])
    assert _rows(wide, "a", F.coalesce("b", F.lit("")), F.coalesce("c", F.lit(0))) == [(1.0, "x", 0), (2.5, "", 3)]


# Spectra

P = "struct<accession:string,name:string,value:string>"


def _spectra(spark, rows):
    """rows: run, seq, scan, level, minutes, mz, intensity, cv, precursors."""
    return spark.createDataFrame(rows, contracts.SPECTRA_DDL)


def _cv(**terms):
    return [("MS:" + k[1:], k, str(v)) for k, v in terms.items()]


def _precursor(**terms):
    return (_cv(**terms),)


@pytest.fixture
def run(spark):
    tic = lambda v: _cv(_1000285=v, _1000501=100, _1000500=900)
    window = _precursor(_1000827=500, _1000828=1, _1000829=2, _1000744=501, _1000045=30)
    return _spectra(
        spark,
        [
            ("r", 0, 1, 2, 0.5, [], [], tic(10), [window]),
            ("r", 1, 2, 1, 1.0, [3.0, 1.0, 2.5], [9.0, 99.0, 0.0], tic(20), []),
            ("r", 2, 3, 2, 1.5, [1.0, 2.0, 4.0, 8.0, 16.0], [9.0, 9.0, 99.0, 999.0, 9.0], tic(30), [window, _precursor(_1000828=4)]),
            ("r", 3, 4, 2, 2.0, [1.0], [-1.0], [("MS:1000515", "intensity array", ""), ("A", "a", "1"), ("A", "a", "2"), (None, "n", "x")], []),
            ("r", 4, 4, 2, 2.5, [1.0], [9.0], [("A", "late", "9"), ("B", "b", None)], []),
            ("r", 5, 9, None, 3.0, [1.0], [9.0], [], []),
        ],
    )


def test_run_statistics(run):
    got = {r["accession"]: r["value"] for r in run_metadata.run_statistics(run).collect()}
    assert got["summary:spectrum_count"] == "6" and got["ms1:spectrum_count"] == "1" and got["ms2:spectrum_count"] == "4"
    assert got["summary:tic_avg"] == "20.0" and got["summary:tic_std"] == "10.0" and got["ms2:tic_max"] == "30.0"
    assert "ms1:tic_std" not in got  # one value has no deviation
    assert got["summary:first_scan_time_minutes"] == "0.5" and got["summary:total_run_time_seconds"] == "150.0"
    assert got["ms1:mz_window_avg"] == "800.0"
    assert got["ms2:isolation_window_avg"] == "3.0" and got["ms2:isolation_lower_offset_min"] == "1.0"
    assert got["acquisition:type"] == "DDA"
    assert got["summary:peak_count_max"] == "5.0" and got["summary:peak_count_min"] == "0.0"
    assert got["summary:peak_intensity_max"] == "3.0" and got["summary:peak_intensity_min"] == "0.0"
    means = [statistics.fmean(math.log10(1 + x) for x in a) for a in ([9, 99, 0], [9, 9, 99, 999, 9], [9], [9])]
    assert got["summary:peak_intensity_avg"] == str(round(statistics.fmean(means), 3))
    assert got["summary:peak_separation_min"] == "0.5" and got["summary:peak_separation_max"] == "8.0"


@pytest.mark.parametrize("n, width, mode", [(9, 4, "DDA"), (10, 4, "DIA"), (10, 3, "DDA")])
def test_acquisition_type(spark, n, width, mode):
    rows = [("r", i, i, 2, None, [], [], [], [_precursor(_1000828=width / 2, _1000829=width / 2)]) for i in range(n)]
    got = run_metadata.run_statistics(_spectra(spark, rows)).where("accession = 'acquisition:type'").collect()
    assert [r["value"] for r in got] == [mode]


def test_scan_metadata(run):
    got = {}
    for r in scan_metadata.scan_metadata(run, 2).collect():
        key = (r["scan_number"], r["accession"])
        assert key not in got
        got[key] = r["value"]
    assert got[1, "parent:ms1"] == "1" and got[3, "parent:ms1"] == "2" and got[4, "parent:ms1"] == "2"
    assert got[1, "peak_count"] == "0" and (1, "peak_intensity:min") not in got
    assert got[3, "peak_intensity:median"] == "1.0" and got[3, "peak_separation:median"] == "3.0"
    assert got[3, "peak_separation:avg"] == "3.75"
    # A scan number used twice: the first occurrence counts for each accession.
    assert got[4, "A"] == "1" and got[4, "peak_count"] == "0" and (4, "B") in got and got[4, "B"] is None
    assert (4, "MS:1000515") not in got
    written = scan_metadata.scans_written(scan_metadata.scan_metadata(run, 2)).first()
    assert (written["n_rows"], written["n_scans"]) == (len(got), 3)
    ms1 = {r["accession"]: r["value"] for r in scan_metadata.scan_metadata(run, 1).collect()}
    assert "parent:ms1" not in ms1 and "peak_intensity:median" not in ms1
    assert ms1["peak_separation:min"] == "0.5" and ms1["peak_separation:max"] == "1.5"


def test_intensity_distributions(run):
    counts = intensity.histogram(run)
    rows = {r["scan_number"]: r for r in counts.collect()}
    assert sorted(rows) == [1, 2, 3, 4]  # no level, no row; of scan 4 the first
    for r in rows.values():
        assert r["under"] + r["over"] + sum(r["bins"]) == r["peaks"]
    assert rows[4]["peaks"] == 0 and rows[4]["min_int"] == 0.0 and rows[2]["under"] == 1
    wide = intensity.histogram_wide(counts)
    assert len(wide.columns) == 110 and wide.columns[-1] == "ibin_99"
    profiles = intensity.quantiles(run)
    assert {r["scan_number"]: r["quantiles"] is None for r in profiles.collect()} == {1: True, 2: False, 3: False, 4: True}
    assert intensity.quantiles_wide(profiles).columns[-1] == "p_100"
    assert intensity.quantiles_long(profiles).count() == 202


def test_runs_are_written_sorted(run, spark, tmp_path):
    sinks.write_runs(scan_metadata.scan_metadata(run, 2), str(tmp_path / "out"), ("basename", "scan_number", "accession"))
    assert spark.read.parquet(str(tmp_path / "out")).count() > 10
    assert all(".zstd." in p.name for p in (tmp_path / "out").glob("part-*"))


MZML = """<?xml version="1.0"?>
<mzML xmlns="http://psi.hupo.org/ms/mzml" id="run7" version="1.1">
<fileDescription><fileContent><cvParam accession="MS:1000579" name="MS1 spectrum" value=""/><userParam name="who" value="me"/></fileContent></fileDescription>
<softwareList><software><cvParam accession="MS:1" name="skipped" value=""/></software></softwareList>
<instrumentConfigurationList><instrumentConfiguration><cvParam accession="MS:1000031" value="x"/><userParam value="y"/><cvParam name="none"/></instrumentConfiguration></instrumentConfigurationList>
<dataProcessingList><dataProcessing><processingMethod><cvParam accession="MS:1000544" name="conversion"/></processingMethod></dataProcessing></dataProcessingList>
<run id="r" startTimeStamp="t"><cvParam accession="MS:1000031" name="again" value="late"/><spectrumList count="2">
<spectrum index="0" id="scan=5"><cvParam accession="MS:1000511" name="ms level" value="2"/>
<scanList><scan><cvParam accession="MS:1000016" name="scan start time" value="90" unitName="second"/><scanWindowList><scanWindow><cvParam accession="MS:1000501" name="low" value="100"/></scanWindow></scanWindowList></scan></scanList>
<precursorList><precursor><isolationWindow><cvParam accession="MS:1000828" name="lower" value="1.5"/></isolationWindow><selectedIonList><selectedIon><cvParam accession="MS:1000744" name="ion" value="500"/></selectedIon></selectedIonList><activation><cvParam accession="MS:1000045" name="energy" value="30"/></activation></precursor></precursorList>
<binaryDataArrayList>
<binaryDataArray><cvParam accession="MS:1000523" name="64"/><cvParam accession="MS:1000576" name="plain"/><cvParam accession="MS:1000514" name="mz"/><binary>{plain64}</binary></binaryDataArray>
<binaryDataArray><cvParam accession="MS:1000521" name="32"/><cvParam accession="MS:1000574" name="zlib"/><cvParam accession="MS:1000515" name="int"/><binary>{zlib32}</binary></binaryDataArray>
</binaryDataArrayList></spectrum>
<spectrum index="1" id="other"><cvParam accession="MS:1000511" name="ms level" value="1"/></spectrum>
</spectrumList></run></mzML>"""


@pytest.mark.parametrize("zipped", [False, True])
def test_mzml(spark, tmp_path, zipped):
    import base64
    import gzip
    import struct
    import zlib

    text = MZML.format(
        plain64=base64.b64encode(struct.pack("<3d", 1.5, 2.5, 4.0)).decode(),
        zlib32=base64.b64encode(zlib.compress(struct.pack("<3f", 9, 99, 0.5))).decode(),
    )
    folder = tmp_path / "runs"
    folder.mkdir()
    if zipped:
        (folder / "r7.mzML.gz").write_bytes(gzip.compress(text.encode()))
    else:
        (folder / "r7.mzML").write_text(text)
    spectra = mzml.read_spectra(spark, str(folder))
    assert [f.simpleString() for f in spectra.schema.fields] == [
        f.simpleString() for f in spark.createDataFrame([], contracts.SPECTRA_DDL).schema.fields
    ]
    first, second = spectra.orderBy("scan_seq").collect()
    assert (first["basename"], first["scan_number"], first["ms_level"], first["scan_time_min"]) == ("r7", 5, 2, 1.5)
    assert first["mz"] == [1.5, 2.5, 4.0] and first["intensity"] == [9.0, 99.0, 0.5]
    assert [p["accession"][-3:] for p in first["cv"]] == ["511", "016", "501", "828", "744", "045", "523", "576", "514", "521", "574", "515"]
    assert [p["value"] for p in first["precursors"][0]["cv"]] == ["1.5", "500", "30"]
    assert (second["scan_number"], second["ms_level"], second["mz"], second["precursors"]) == (2, 1, None, [])

    terms = spark.createDataFrame([("MS:1000031", "instrument model")], "accession string, term string")
    rows = {
        r["accession"]: (r["name"], r["value"], r["group"])
        for r in run_metadata.run_metadata(mzml.read_headers(spark, str(folder)), spectra, terms).collect()
    }
    assert rows["MS:1000031"] == ("instrument model", "x", "instrument")
    assert rows["user:instrument:user_param"] == ("user_param", "y", "instrument")
    assert rows["user:file_description:who"] == ("who", "me", "file_description")
    assert rows["MS:1000544"] == ("conversion", "conversion", "data_processing")
    assert rows["info:id"] == ("id", "run7", "file_metadata") and rows["info:startTimeStamp"][1] == "t"
    assert "MS:1" not in rows and rows["ms2:spectrum_count"][1] == "1"


def test_each_csv_is_read_by_its_own_header(spark, tmp_path):
    (tmp_path / "A.csv").write_text("id,organism,source_type,material,condition,sample_group\na1,human,lab,liver,none,s1\n")
    (tmp_path / "B.csv").write_text('organism,extra,id,material,source_type,sample_group,condition\nmouse,x,b1,"blood, whole",field,s2,fever\n')
    rows = {r["id"]: r for r in replicates.load_annotations(spark, str(tmp_path)).collect()}
    assert (rows["b1"]["organism"], rows["b1"]["material"], rows["b1"]["condition"], rows["b1"]["accession"]) == ("mouse", "blood, whole", "fever", "B")
    assert (rows["a1"]["organism"], rows["a1"]["accession"]) == ("human", "A")
    (tmp_path / "C.csv").write_text("id,organism,source_type,condition,sample_group\nc1,rat,lab,none,s3\n")
    (tmp_path / "D.csv").write_text("id,organism,source_type,material,condition,sample_group\n")
    with pytest.raises(QualityError, match=r"missing_column\(material\): 1, accession C; no_rows\(\*\): 1, accession D"):
        replicates.load_annotations(spark, str(tmp_path))


def test_same_id_in_two_accessions_and_a_corrected_file(spark, tmp_path):
    head = "id,organism,source_type,material,condition,sample_group\n"
    new = tmp_path / "new"
    new.mkdir()

    def call():
        at = [str(tmp_path / n) for n in ("table", "report", "offsets")]
        streaming.ingest_replicates(spark, str(new), *at).awaitTermination()
        rows = spark.read.parquet(at[0]).collect()
        return sorted((r["accession"], r["id"], r["organism"]) for r in rows)

    (new / "A.csv").write_text(head + "x,human,s,m,c,g\n")
    assert call() == [("A", "x", "human")]
    (new / "B.csv").write_text("organism," + head.replace("organism,", "") + "mouse,x,s,m,c,g\n")
    assert call() == [("A", "x", "human"), ("B", "x", "mouse")]
    (new / "again").mkdir()
    assert call() == [("A", "x", "human"), ("B", "x", "mouse")]


def test_worklist_is_complete_or_fails(spark):
    notes = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    found = spark.createDataFrame([("a", "P1", "/r/a.raw"), ("b", "P9", "/r/b.raw")], "id string, repository_id string, remote_path string")
    sites = spark.createDataFrame([("P1", "ftp://h/r", "d")], "id string, url string, doi string")
    listed = spark.createDataFrame([("P1", "/r", "/r/a.raw", False, 5)], contracts.LISTING)
    faults = {tuple(r) for r in replicates.worklist_faults(notes, found, sites).collect()}
    assert faults == {("file", "c", 0), ("repository", "P9", 0)}
    with pytest.raises(QualityError, match="2 keys not found exactly once, e.g. file c: 0"):
        replicates.worklist(notes, found, sites, listed)
    rows = {r["sample_id"]: r for r in replicates.worklist(notes, found, sites, listed, on_missing="skip").collect()}
    assert set(rows) == {"a", "b", "c"} and rows["a"]["host"] == "h" and rows["b"]["host"] is None


def test_a_path_under_two_spellings_of_its_root_counts_once(spark):
    rows = [("P1", "/data/1", "/data/1/x/a.raw", False, 200_000_000), ("P1", "/data/1/", "/data/1/x/a.raw", False, 200_000_000)]
    listed = spark.createDataFrame(rows, contracts.LISTING)
    sizes = {r["remote_path"]: r["size_bytes"] for r in repositories.build_files(listed).collect()}
    assert sizes == {"/data/1/x": 200_000_000, "/data/1/x/a.raw": 200_000_000}


@pytest.mark.parametrize(
    ("number", "packing", "data", "expected"),
    [
        ("MS:1000519", "MS:1000576", struct.pack("<3i", 1, -2, 3), [1.0, -2.0, 3.0]),
        ("MS:1000522", "MS:1000574", zlib.compress(struct.pack("<3q", 1, 2, 3)), [1.0, 2.0, 3.0]),
        ("MS:1000523", "MS:1003089", struct.pack("<3d", 1, 2, 3), "not supported"),
        ("MS:1000520", "MS:1000576", struct.pack("<3d", 1, 2, 3), "not supported"),
        ("MS:1000523", "MS:1000576", struct.pack("<2d", 1, 2), "2 values where 3 are announced"),
    ],
)
def test_mzml_encodings(spark, tmp_path, number, packing, data, expected):
    text = (
        '<mzML xmlns="http://psi.hupo.org/ms/mzml"><run><spectrumList><spectrum index="0" id="scan=1" defaultArrayLength="3">'
        f'<binaryDataArrayList><binaryDataArray><cvParam accession="{number}"/><cvParam accession="{packing}"/>'
        f'<cvParam accession="MS:1000514"/><binary>{base64.b64encode(data).decode()}</binary></binaryDataArray>'
        "</binaryDataArrayList></spectrum></spectrumList></run></mzML>"
    )
    (tmp_path / "r.mzML").write_text(text)
    spectra = mzml.read_spectra(spark, str(tmp_path / "r.mzML"))
    if isinstance(expected, str):
        with pytest.raises(Exception, match=expected):
            spectra.collect()
    else:
        assert spectra.first()["mz"] == expected


def test_job_scope_removes_what_it_made(spark):
    with session.job_scope(spark):
        kept = session.durable(spark.range(3), "kept")
        place = Path(kept._scratch_path.removeprefix("file:"))
        assert kept.count() == 3 and place.exists()
    assert not place.exists()


def test_requests_are_answered_by_format(spark, catalogue, tmp_path):
    files, annotated, sites, _ = catalogue
    asked = tmp_path / "in"
    asked.mkdir()
    (asked / "a.request").write_text('{"target_tables": "repositories"}\n')
    (asked / "b.request").write_text('{"target_tables": "replicates", "output_format": "csv"}\n')
    known = {"repositories": sites, "files": files, "replicates": annotated}
    assert sql_dump.answer_requests(known, str(asked), str(tmp_path / "out")) == ["a", "b"]
    script = "".join(p.read_text() for p in sorted((tmp_path / "out" / "a").glob("part-*")))
    assert script.startswith("-- generated by massloom\nBEGIN;\n") and script.rstrip().endswith("COMMIT;")
    back = spark.read.option("header", True).csv(str(tmp_path / "out" / "b" / "replicates"))
    assert _rows(back, "id") == _rows(annotated, "id")
    (asked / "c.request").write_text('{"output_format": "xml"}\n')
    with pytest.raises(ValueError, match="xml is none of"):
        sql_dump.answer_requests(known, str(asked), str(tmp_path / "out"))
