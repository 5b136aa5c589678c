"""Column expressions on edge values."""

import math
import statistics

import pyarrow as pa
from pyspark.sql import functions as F

from massloom.functions import cv, names, numbers, peaks, sql_text


def test_sample_id(values):
    paths = ["/r/A.RAW", "/r/a.mzML.gz", "/r/a.d.zip", "/r/a.raw.gz.gz", "/r/.raw", "/r/a.wiff2", "/r/a.raw\n", "/r/a.txt"]
    got = values(paths, "string", lambda x: names.sample_id(F.lit("P"), x))
    assert got == ["P_a", "P_a", "P_a", "P_a.raw.gz", "P_", "P_a", "P_a.raw\n", "P_a.txt"]
    ok = values(paths, "string", names.is_sample_name)
    assert ok == [True, True, True, False, True, True, False, False]


def test_output_name(values):
    got = values(["/r/A.RAW", "/r/a.mzML.gz", "/r/a.txt"], "string", lambda x: names.output_name(F.lit("s"), x))
    assert got == ["s.raw", "s.mzml.gz", "s"]


def test_folder_and_base_name(values):
    paths = ["/a/b/c", "/a", "c"]
    assert values(paths, "string", names.base_name) == ["c", "a", "c"]
    assert values(paths, "string", names.folder_name) == ["/a/b", "", ""]


def test_run_name(values):
    got = values(["r.mzML", "r.mzml.gz", "r.mzML.gz", "r.raw"], "string", names.run_name)
    assert got == ["r", "r", "r", "r.raw"]


def test_human_size(values):
    sizes = [None, 0, 1023, 1024, 1280, 1048575, 2**50, 2**60]
    assert values(sizes, "bigint", numbers.human_size) == [
        "", "0.0 B", "1023.0 B", "1.0 KB", "1.2 KB", "1024.0 KB", "1.0 PB", "1024.0 PB",
    ]


def test_blank(values):
    texts = ["", " ", "\t", " ", "\n", "a", " a", None]
    assert values(texts, "string", names.is_blank) == [True, True, True, True, True, False, False, None]


def test_zero_padded_keeps_long_numbers(values):
    assert values([1, 12345], "int", lambda x: numbers.zero_padded(x, 4)) == ["0001", "12345"]


def test_decimal_text(values):
    numbers_ = [5.0, 0.25, 12000000.0, 1200.1, None]
    assert values(numbers_, "double", numbers.decimal_text) == ["5.0", "0.25", "12000000.0", "1200.1", None]


def test_ftp_parts(values):
    urls = [
        "ftp://u:p@Host.org:2121/a/b/", "ftp://host/a b", "ftp://host", "ftp://host//", "ftp:///x",
        "ftp://u@massive-ftp.ucsd.edu/x?y", "ftp://u:a@b@h/x;type=i",
    ]
    got = values(urls, "string", lambda x: F.struct(*[c.alias(k) for k, c in names.ftp_parts(x).items()]))
    assert [tuple(r) for r in got] == [
        ("host.org", 2121, "u", "p", "/a/b", False),
        ("host", 21, "anonymous", "", "/a b", False),
        ("host", 21, "anonymous", "", "/", False),
        ("host", 21, "anonymous", "", "/", False),
        (None, 21, "anonymous", "", "/x", False),
        ("massive-ftp.ucsd.edu", 21, "u", "", "/x", True),
        ("h", 21, "u", "a@b", "/x", False),
    ]


def test_safe_file_name(values):
    assert values(["a/b\\c d:e"], "string", names.safe_file_name) == ["a_b_c_d_e"]


def test_sql_literals(spark):
    df = spark.sql(
        "select 'it''s' a, true b, cast('NaN' as double) c, 1.5D d, 7 e, cast(null as string) f, "
        "timestamp'2024-01-01 00:00:00' g, timestamp'2024-01-01 00:00:00.5' h, cast('Infinity' as float) i"
    )
    got = df.select(*[sql_text.sql_literal(F.col(f.name), f.dataType) for f in df.schema.fields]).first()
    assert list(got) == [
        "'it''s'", "TRUE", "'NaN'", "1.5", "7", "NULL", "'2024-01-01 00:00:00'", "'2024-01-01 00:00:00.500000'",
        "'Infinity'",
    ]


def _brute_histogram(intensity):
    logs = [] if any(x <= -1 for x in intensity) else [math.log10(1 + x) for x in intensity]
    slots = [0] * 102
    for value in logs:
        if value < 1:
            slots[0] += 1
        elif value >= 9:
            slots[101] += 1
        else:
            slots[1 + min(int((value - 1) / peaks.BIN_WIDTH), 99)] += 1
    return slots


def test_histogram_against_brute_force(values):
    scans = [
        [], [0.0], [-1.0, 5.0], [9.0 - 1e-9, 9.0, 9.0 + 1e-9], [10**1.08 - 1, 10**1.16 - 1],
        [1e9 - 2, 1e9 - 1, 1e9], [float(3**k) for k in range(25)], [7.5] * 40,
    ]
    got = values(scans, "array<double>", peaks.histogram_slots)
    for scan, slots in zip(scans, got, strict=True):
        assert slots == _brute_histogram(scan), scan


def test_slot_counts_of_odd_batches():
    scans = [[math.nan, None, math.inf], [1e12], None, [], [None], [9.0 - 1e-9, 9.0]]
    whole = pa.array(scans, pa.list_(pa.float64()))
    want = [[0] * 101 + [2], [0] * 101 + [1], [0] * 102, [0] * 102, [0] * 102, _brute_histogram([9.0 - 1e-9, 9.0])]
    assert peaks.slot_counts(whole).to_pylist() == want
    assert peaks.slot_counts(whole.slice(1, 4)).to_pylist() == want[1:5]
    assert peaks.slot_counts(whole.slice(0, 0)).to_pylist() == []


def test_quantiles_against_brute_force(values):
    scans = [[], [4.0], [1.0, 3.0], [float((k * 37) % 101) for k in range(64)]]
    got = values(scans, "array<double>", lambda x: peaks.quantile_profile(F.sort_array(x)))
    assert got[0] is None
    for scan, profile in zip(scans[1:], got[1:], strict=True):
        logs = sorted(math.log10(1 + x) for x in scan)
        for percent, value in zip(peaks.PERCENTAGES, profile, strict=True):
            at = (len(logs) - 1) * percent / 100
            low, high = logs[int(at)], logs[min(int(at) + 1, len(logs) - 1)]
            assert math.isclose(value, low + (at - int(at)) * (high - low), abs_tol=1e-12)
        assert profile == sorted(profile)
    assert len(peaks.PERCENTAGES) == 101 and abs(peaks.PERCENTAGES[50] - 50) < 1e-12


def test_median_and_gaps(values):
    arrays = [[], [1.0], [1.0, 4.0], [1.0, 2.0, 9.0], [1.0, 2.0, 4.0, 9.0]]
    assert values(arrays, "array<double>", peaks.sorted_median) == [
        statistics.median(a) if a else None for a in arrays
    ]
    assert values(arrays, "array<double>", peaks.gaps) == [[], [], [3.0], [1.0, 7.0], [1.0, 2.0, 5.0]]


def test_last_value_wins(values):
    param = "array<struct<accession:string,name:string,value:string>>"
    arrays = [[("A", "n", "1"), ("B", "n", "2"), ("A", "n", "3")], [("A", "n", "1"), ("A", "n", None)], []]
    assert values(arrays, param, lambda x: cv.last_number(x, "A")) == [3.0, None, None]
