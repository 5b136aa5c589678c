"""mzML files that are split, broken, cut off or packed in other ways."""

import base64
import gzip
import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from massloom.fixtures import numpress_files as packed
from massloom.functions import numpress
from massloom.sources import mzml, mzml_fragments
from massloom.sources.mzml_fragments import Stretch, stretch_fragments
from massloom.streaming import ingest as streaming

GROUPS = (
    '<referenceableParamGroupList><referenceableParamGroup id="l2"><cvParam accession="MS:1000511" name="ms level" value="2"/>'
    '</referenceableParamGroup></referenceableParamGroupList>'
)


def _array(kind, raw, *marks):
    params = "".join(f'<cvParam accession="{m}" name="x" value=""/>' for m in (*marks, kind))
    return f"<binaryDataArray>{params}<binary>{base64.b64encode(raw).decode()}</binary></binaryDataArray>"


def _spectrum(k, level='<cvParam accession="MS:1000511" name="ms level" value="1"/>', arrays=""):
    return (
        f'<spectrum index="{k}" id="scan={k + 1}" defaultArrayLength="3">{level}<scanList><scan>'
        f'<cvParam accession="MS:1000016" name="scan start time" value="{k}" unitName="minute"/></scan></scanList>'
        f"<binaryDataArrayList>{arrays}</binaryDataArrayList></spectrum>"
    )


def _run(spectra, count=None, tail="</spectrumList></run></mzML>"):
    count = len(spectra) if count is None else count
    return f'<?xml version="1.0"?><mzML id="x">{GROUPS}<run id="r"><spectrumList count="{count}">\n' + "\n".join(spectra) + tail


@pytest.mark.parametrize("size", [1, 7, 64, 999, 1 << 20])
def test_stretches_give_every_spectrum_once(tmp_path, size, monkeypatch):
    monkeypatch.setattr(mzml_fragments, "BLOCK", 50)
    path = tmp_path / "a.mzML"
    texts = [_spectrum(k) for k in range(9)]
    texts[4] = texts[4].replace("</spectrum>", "")
    path.write_text(_run(texts))
    length = path.stat().st_size
    got = []
    for start in range(0, length, size):
        got += stretch_fragments(Stretch(str(path), start, start + size, start + size >= length))
    assert [r[3].strip() for r in got] == texts
    assert [r[2] for r in got] == [None] * 4 + [mzml_fragments.NO_END] + [None] * 4
    raw = path.read_bytes()
    assert all(raw[r[1] :].startswith(r[3].encode()) for r in got)


def test_faults_cost_no_other_spectrum(spark, tmp_path):
    good = [_spectrum(k) for k in range(4)]
    files = {
        "fine.mzML": _run(good),
        "broken.mzML": _run([good[0], good[1].replace("</scanList>", ""), good[2], good[3]]),
        "open.mzML": _run([good[0], good[1].replace("</spectrum>", ""), good[2]]),
        "cut.mzML": _run(good)[:-400],
        "short.mzML": _run(good, count=6),
        "none.mzML": _run([]),
        "head.mzML": "<mzML <<" + _run(good)[6:],
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    whole = gzip.compress(_run(good).encode())
    (tmp_path / "packed.mzML.gz").write_bytes(whole)
    noise = [_spectrum(k, arrays=_array("MS:1000514", random.Random(k).randbytes(30_000), "MS:1000523")) for k in range(4)]
    (tmp_path / "half.mzML.gz").write_bytes(gzip.compress(_run(noise).encode())[:80_000])
    where = str(tmp_path)
    read = mzml.read_spectra(spark, where, on_fault="skip", stretch=300)
    seen = read.groupBy("basename").agg(F.sort_array(F.collect_list("scan_seq")).alias("seen")).collect()
    assert {r.basename: list(r.seen) for r in seen} == {
        "fine": [0, 1, 2, 3], "packed": [0, 1, 2, 3], "broken": [0, 2, 3], "open": [0, 2], "cut": [0, 1],
        "short": [0, 1, 2, 3], "head": [0, 1, 2, 3], "half": [0, 1],
    }
    faults = {}
    for r in mzml.read_faults(spark, where, stretch=300).collect():
        faults.setdefault(r.basename, set()).add(r.fault)
    assert faults["broken"] == {"spectrum is no XML", "spectra missing"}
    assert faults["open"] == {mzml_fragments.NO_END, "spectra missing"}
    assert faults["cut"] >= {mzml_fragments.CUT, "spectra missing"}
    assert faults["half"] == {mzml_fragments.CUT, mzml_fragments.NO_END, "spectra missing"}
    assert faults["short"] == {"spectra missing"} and faults["head"] == {"head is no XML"}
    assert not {"fine", "packed", "none"} & set(faults)
    assert mzml.read_spectra(spark, f"{where}/fine.mzML").count() == 4
    for name in ("broken", "open", "cut"):
        with pytest.raises(Exception, match="spectrum|file without end"):
            mzml.read_spectra(spark, f"{where}/{name}.mzML").select("scan_seq").collect()


def test_a_run_is_read_by_several_tasks(spark, tmp_path):
    (tmp_path / "a.mzML").write_text(_run([_spectrum(k) for k in range(40)]))
    one = mzml_fragments.read_fragments(spark, str(tmp_path), 1000)
    assert one.rdd.getNumPartitions() > 10
    tasks = one.select(F.spark_partition_id().alias("p"), "start").groupBy("p").count().count()
    assert tasks > 10 and one.count() == 40


def test_parameters_of_groups_stand_in_order(spark, tmp_path):
    level = '<referenceableParamGroupRef ref="l2"/><referenceableParamGroupRef ref="gone"/><cvParam accession="MS:1" name="own" value="v"/>'
    (tmp_path / "a.mzML").write_text(_run([_spectrum(0, level)]))
    row = mzml.read_spectra(spark, str(tmp_path)).first()
    assert row.ms_level == 2 and [p.accession for p in row.cv] == ["MS:1000511", "MS:1", "MS:1000016"] and row.scan_time_min == 0.0


def test_stream_reports_broken_runs(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.mzML").write_text(_run([_spectrum(0), _spectrum(1).replace("</scanList>", "")]))
    (tmp_path / "in" / "b.mzML").write_text(_run([_spectrum(0)]))
    at = [str(tmp_path / x) for x in ("table", "offsets", "report")]
    streaming.ingest_runs(spark, str(tmp_path / "in"), *at).awaitTermination()
    assert sorted((r.basename, r.scan_seq) for r in spark.read.parquet(at[0]).collect()) == [("a", 0), ("b", 0)]
    assert {r.basename for r in spark.read.parquet(at[2]).collect()} == {"a"}
    # A newer version without a spectrum takes back the run.
    (tmp_path / "in" / "b.mzML.gz").write_bytes(gzip.compress(_run([]).encode()))
    streaming.ingest_runs(spark, str(tmp_path / "in"), *at).awaitTermination()
    assert {r.basename for r in spark.read.parquet(at[0]).collect()} == {"a"}


# --- MS-Numpress


def test_half_bytes_as_the_format_says():
    assert packed._halves(0) == [8] and packed._halves(-1) == [15, 15] and packed._halves(23) == [6, 7, 1]
    draw = random.Random(1)
    for n in (0, 1, 2, 5, 400):
        numbers = [draw.choice([0, -1, 23, draw.randint(-(1 << 31), (1 << 31) - 1), draw.randint(-300, 300)]) for _ in range(n)]
        raw = packed._bytes([h for x in numbers for h in packed._halves(x)])
        assert numpress._numbers(raw).tolist() == numbers
    with pytest.raises(ValueError, match="middle"):
        numpress._numbers(b"\x01")


@pytest.mark.parametrize("n", [0, 1, 2, 3, 500])
@pytest.mark.parametrize("deflate", [False, True])
def test_packings_come_back_within_their_bound(n, deflate):
    draw = random.Random(n)
    mz = sorted(draw.uniform(50, 2000) for _ in range(n))
    intensity = [draw.choice([0.0, draw.uniform(0, 10), 10 ** draw.uniform(0, 9)]) for _ in range(n)]
    squeeze = zlib.compress if deflate else bytes
    names = ("MS:1002746", "MS:1002747", "MS:1002748") if deflate else ("MS:1002312", "MS:1002313", "MS:1002314")
    both = ["MS:1000523", names[0]]
    got = mzml.unpack_array(squeeze(packed.encode_linear(mz)), both)
    assert np.abs(got - mz).max(initial=0) <= 0.5 / packed.LINEAR_STEPS * 1.001 and len(got) == n
    got = mzml.unpack_array(squeeze(packed.encode_positive(mz)), [names[1]])
    assert np.abs(got - mz).max(initial=0) <= 0.5 and len(got) == n
    got = mzml.unpack_array(squeeze(packed.encode_logged(intensity)), [names[2]])
    bound = np.expm1(0.5 / packed.logged_steps(intensity)) * (1 + np.array(intensity)) * 1.0001
    assert len(got) == n and (np.abs(got - intensity) <= bound).all()


def test_other_marks_are_refused(spark, tmp_path):
    three = struct.pack("<3d", 1, 2, 3)
    for marks in (["MS:1000523", "MS:1003088"], ["MS:1000520"], ["MS:1000523", "MS:1000521"], [], ["MS:1002312", "MS:1002314"]):
        with pytest.raises(ValueError, match="not supported"):
            mzml.unpack_array(three, marks)
    assert mzml.unpack_array(zlib.compress(three), ["MS:1000523", "MS:1000574"]).tolist() == [1, 2, 3]
    arrays = _array("MS:1000514", packed.encode_linear([1, 2, 3]), "MS:1002312") + _array("MS:1000515", three, "MS:1000523", "MS:1000576")
    (tmp_path / "a.mzML").write_text(_run([_spectrum(0, arrays=arrays)]))
    row = mzml.read_spectra(spark, str(tmp_path)).first()
    assert row.mz == row.intensity == [1, 2, 3]
