"""Operators against brute force on small rows."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from massloom import contracts
from massloom.contracts import LISTING, REPLICATES, REPOSITORIES
from massloom.operators import asof, filters, firsts, inventory, ordering, packing, profile, quality, shares
from massloom.plans import repositories


def _rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def listing(spark, root, entries):
    rows = [("P", root, path, size is None, size) for path, size in entries]
    return spark.createDataFrame(rows, LISTING)


BIG = inventory.SAMPLE_MIN_BYTES + 1


def test_inventory_of_nested_folders(spark):
    files = repositories.build_files(
        listing(
            spark,
            "/data/root.d/",
            [
                ("/data/root.d/a/b/one.raw", BIG),
                ("/data/root.d/a/b/one.raw", BIG),  # listed twice
                ("/data/root.d/a/two.txt", 5),
                ("/data/root.d/a/x.d/part/deep.bin", BIG),
                ("/data/root.d/a/x.d/top.bin", 1),
                ("/data/root.d/X.D/inner.d/f", 3),
                ("/data/root.d/y.raw/f", BIG),
                ("/data/root.d/empty", None),
                ("/data/root.d/exact.raw", BIG - 1),
                ("/elsewhere/f", 9),
            ],
        ),
        F.to_timestamp(F.lit("2024-01-01")),
    )
    assert _rows(files, F.coalesce("id", F.lit("")), "remote_path", "size_bytes") == sorted(
        [
            ("P_one", "/data/root.d/a/b/one.raw", BIG),
            ("", "/data/root.d/a/b", BIG),
            ("", "/data/root.d/a/two.txt", 5),
            ("P_x", "/data/root.d/a/x.d", BIG + 1),
            ("", "/data/root.d/a", 2 * BIG + 6),
            ("", "/data/root.d/X.D", 3),
            ("P_y", "/data/root.d/y.raw", BIG),
            ("", "/data/root.d/y.raw/f", BIG),
            ("", "/data/root.d/empty", 0),
            ("", "/data/root.d/exact.raw", BIG - 1),
        ]
    )


def test_scans_are_fused(spark):
    items = listing(
        spark,
        "/r",
        [
            ("/r/a.wiff", 10), ("/r/a.wiff.scan", 5),
            ("/r/b.wiff", 10),
            ("/r/c.WIFF", 10), ("/r/c.wiff.scan", 5),  # case differs: no match
            ("/r/orphan.wiff.scan", 7),
        ],
    )
    fused = inventory.fuse(inventory.contributions(items))
    assert _rows(fused, "remote_path", "size_bytes") == [("/r/a.wiff", 15), ("/r/b.wiff", 10), ("/r/c.WIFF", 10)]


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.lists(st.sampled_from(["a", "b", "x.d"]), max_size=3), st.integers(0, 99)), min_size=1, max_size=30))
def test_root_children_sum_to_total(spark, tree):
    entries = [("/r/" + "/".join([*folders, f"f{i}"]), size) for i, (folders, size) in enumerate(tree)]
    rolled = inventory.roll_up(inventory.contributions(listing(spark, "/r", entries)))
    top = [r for r in rolled.collect() if r["remote_path"].count("/") == 2]
    assert sum(r["size_bytes"] for r in top) == sum(size for _, size in tree)


def test_row_numbers_and_running_totals(spark):
    random.seed(1)
    rows = [("hot" if i % 3 else f"g{i % 7}", f"k{i:04d}", random.randrange(50)) for i in range(600)]
    df = spark.createDataFrame(rows, "g string, k string, n bigint").repartition(5)
    numbered = {(r["g"], r["k"]): r["at"] for r in ordering.number_rows(df, ["g"], [F.col("k")], "at").collect()}
    totals = {
        (r["g"], r["k"]): r["before"]
        for r in ordering.running_total(df, ["g"], [F.col("k")], F.col("n"), "before").collect()
    }
    for group in {r[0] for r in rows}:
        before = 0
        for at, (_, key, n) in enumerate(sorted(r for r in rows if r[0] == group), 1):
            assert numbered[group, key] == at
            assert totals[group, key] == before
            before += n


def test_last_marked_over_blocks(spark):
    random.seed(2)
    rows = [(run, seq, seq + 100, random.random() < 0.1) for run in "ab" for seq in range(200)]
    df = spark.createDataFrame(rows, "run string, seq bigint, scan bigint, ms1 boolean").repartition(4)
    got = {
        (r["run"], r["seq"]): r["parent"]
        for r in asof.last_marked(df, "run", "seq", F.col("ms1"), "scan", "parent", block_rows=16).collect()
    }
    seen = {}
    for run, seq, scan, ms1 in rows:
        if ms1:
            seen[run] = scan
        assert got[run, seq] == seen.get(run)


def test_first_per_key(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, None), ("b", 5, "z")], "k string, at int, v string")
    assert [tuple(r) for r in firsts.first_per_key(df, ["k"], ["at"]).orderBy("k").collect()] == [
        ("a", 1, None), ("b", 5, "z"),
    ]
    unique, repeated = firsts.split_repeated(df, ["k"])
    assert (unique.count(), repeated.count()) == (1, 2)


# Shares

def _folded(spark, groups, threshold=0.02):
    df = spark.createDataFrame([("c", label, value) for label, value in groups], "cut string, label string, value bigint")
    out = shares.with_shares(shares.fold_small(df, ["cut"], threshold=threshold), ["cut"])
    return [(r["label"], r["value"], r["rank"]) for r in out.orderBy("rank", "label").collect()]


def test_fold_small_groups(spark):
    assert _folded(spark, [("a", 60), ("b", 40)]) == [("a", 60, 1), ("b", 40, 2)]
    assert _folded(spark, [("a", 60), ("b", 39), ("c", 1)]) == [("a", 60, 1), ("b", 39, 2), ("c", 1, 3)]
    # Two small groups become one row that stays last; 2 of 100 is not small.
    assert _folded(spark, [("a", 96), ("b", 1), ("c", 1), ("d", 2)]) == [
        ("a", 96, 1), ("d", 2, 2), ("Other (2 groups)", 2, 3),
    ]
    assert _folded(spark, [("a", 5)]) == []
    assert _folded(spark, [("a", 0), ("b", 0)]) == [("a", 0, None), ("b", 0, None)]
    assert _folded(spark, [("a", 5), (None, 5)]) == []


# Packing

def _brute_splits(rows, target):
    """rows: (stratum, size or None, id) of one accession."""
    loads, out = [0], {}
    for stratum in sorted({r[0] for r in rows}):
        mine = [r for r in rows if r[0] == stratum]
        for _, size, key in sorted(mine, key=lambda r: (r[1] is not None, -(r[1] or 0), r[2])):
            size = size or 0
            at = loads.index(min(loads))
            if loads[at] > 0 and loads[at] + size > target:
                loads.append(0)
                at = len(loads) - 1
            loads[at] += size
            out[key] = at
    return out


def _samples(spark, rows):
    full = [(acc, f"{key}", size, organism, "s", "m", "c") for acc, key, size, organism in rows]
    return spark.createDataFrame(
        full,
        "accession string, id string, size_bytes bigint, organism string, source_type string, material string, condition string",
    )


@pytest.mark.parametrize("stretch", [10_000, 3])
def test_packing_equals_brute_force(spark, stretch):
    """Long and short stretches of runs give the same splits as one row after the other."""
    random.seed(3)
    rows = []
    for acc, n in (("hot", 400), ("small", 40), ("one", 1)):
        for i in range(n):
            size = random.choice([0, None, random.randrange(1, 40), random.randrange(60, 130), 7, 7])
            rows.append((acc, f"{acc}{i:03d}", size, random.choice(["x", "y", "z"])))
    got = packing.assign_splits(_samples(spark, rows), target_bytes=100, stretch=stretch).collect()
    assert len(got) == len(rows)
    for acc in ("hot", "small", "one"):
        expected = _brute_splits([(f"{o}|s|m|c", size, key) for a, key, size, o in rows if a == acc], 100)
        assert {r["id"]: r["split_id"] for r in got if r["accession"] == acc} == expected


@pytest.mark.parametrize("seed", range(60))
def test_runs_in_closed_form_equal_rows(seed):
    draw = random.Random(seed)
    target, stretch = draw.choice([10, 100, 1000]), draw.choice([1, 2, 7, 10_000])
    loads, plain = packing.Loads(target, stretch), [0]
    for step in range(draw.randint(1, 25)):
        size, rows = draw.choice([0, 1, 3, draw.randint(1, target), draw.randint(1, 2 * target)]), draw.choice([1, 2, 5, 60])
        expected = []
        for _ in range(rows):
            at = plain.index(min(plain))
            if plain[at] and plain[at] + size > target:
                plain.append(0)
                at = len(plain) - 1
            plain[at] += size
            expected.append(at)
        places = list(loads.place(size, rows))
        assert [start for start, _, _ in places] == [sum(n for _, n, _ in places[:k]) for k in range(len(places))]
        assert [split for _, n, split in places for _ in range(n)] == expected, step
        if draw.random() < 0.3:
            loads.forget(1)


def test_a_long_run_is_few_steps():
    loads = packing.Loads(1000)
    assert sum(n for _, n, _ in loads.place(0, 10**12)) == 10**12
    assert loads.opened == 1
    places = list(loads.place(300, 10**6))
    assert sum(n for _, n, _ in places) == 10**6 and len(places) == loads.opened == -(-(10**6) // 3)


def test_closed_splits_are_dropped_from_the_state():
    loads = packing.Loads(100)
    loads.heap = [(95, 0), (98, 1), (40, 2), (0, 3)]
    loads.forget(10)
    assert sorted(loads.heap) == [(0, 3), (40, 2), (95, 0)]


def test_packing_of_no_rows(spark):
    assert packing.assign_splits(_samples(spark, [("a", "k", 1, "x")]).where("false")).count() == 0


def test_full_splits_hold_one_large_row(spark):
    rows = [("a", f"k{i}", size, "x") for i, size in enumerate([250, 30, 30, 30, 120, 5, 0])]
    got = packing.assign_splits(_samples(spark, rows), target_bytes=100).collect()
    by_split = {}
    for r in got:
        by_split.setdefault(r["split_id"], []).append(r["size_bytes"])
    for sizes in by_split.values():
        assert sum(sizes) <= 100 or sum(s > 0 for s in sizes) == 1
    assert sum(map(sum, by_split.values())) == 465


def test_fill_mode(spark):
    rows = [("a", f"k{i}", 40, "x") for i in range(6)]
    got = packing.fill_splits(_samples(spark, rows), target_bytes=100)
    assert _rows(got, "id", "split_id") == [("k0", 0), ("k1", 0), ("k2", 0), ("k3", 1), ("k4", 1), ("k5", 2)]


# Quality, filters, profiles

def _report(df, contract=REPOSITORIES, **options):
    report = quality.check_table(df, contract, **options).collect()
    return {(r["check"], r["column"]): (r["n_bad"], r["sample"]) for r in report if r["n_bad"]}


def test_quality_report(spark):
    ddl = "id string, url string, doi string, extra int"
    rows = [("1", "u", "d", 0), ("1", "u", "d", 1), ("007", None, "\t", 0), ("2", " ", "d", 0), ("2", "v", "d", 0)]
    found = _report(spark.createDataFrame(rows, ddl))
    assert found == {
        ("null", "url"): (1, None),
        ("blank", "doi"): (1, None),
        ("blank", "url"): (1, None),
        ("duplicate_row", "*"): (1, None),
        ("duplicate_key", "id"): (2, "1"),
    }
    assert _report(spark.createDataFrame([], ddl)) == {("no_rows", "*"): (1, None)}
    assert _report(spark.createDataFrame([("a",)], "url string")) == {
        ("missing_column", "doi"): (1, None), ("missing_column", "id"): (1, None),
    }
    with pytest.raises(quality.QualityError, match="no_rows"):
        quality.strict(quality.check_table(spark.createDataFrame([], ddl), REPOSITORIES))


def test_cast_check(spark):
    raw = spark.createDataFrame([("P", "/r", "/r/a", "maybe", "12x")], ", ".join(f"{n} string" for n in LISTING.names))
    assert _report(raw, LISTING, key="path") == {("cast", "is_dir"): (1, "maybe"), ("cast", "size_bytes"): (1, "12x")}


def test_report_per_file(spark):
    columns = ", ".join(f"{n} string" for n in ["accession", *REPLICATES.names])
    rows = [("A", "1", "o", "s", "m", "c", "g"), ("B", "1", "o", "s", "m", None, "g")]
    df = spark.createDataFrame(rows, columns)
    report = quality.check_table(df, REPLICATES, per="accession")
    assert _rows(report.where("n_bad > 0"), "accession", "check", "column") == [("B", "null", "condition")]
    assert _rows(quality.passing(df, report, "accession"), "accession") == [("A",)]


def test_lookup_counts(spark):
    wanted = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    table = spark.createDataFrame([("a",), ("b",), ("b",)], "id string")
    assert _rows(quality.lookup_counts(wanted, table, "id"), "id", "n_rows") == [("b", 2), ("c", 0)]


def test_filters(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "n int, t string")
    assert _rows(filters.apply_filters(df, {"t": "a"}), "n") == [(1,), (3,)]
    assert _rows(filters.apply_filters(df, {"n": [2, 3], "t": "a", "nope": 1}), "n") == [(3,)]
    assert filters.apply_filters(df, {}).count() == 3
    assert filters.apply_filters(df, None) is df


def test_profiles(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (3, "b")], "n int, t string")
    got = profile.column_profile(df, "d")
    assert _rows(got, "column_name", "distinct_count", "null_count") == [("n", 2, 0), ("t", 2, 1)]
    assert _rows(profile.column_profile(df, "d", approximate=True), "distinct_count") == [(2,), (2,)]
    assert dict(_rows(profile.dataset_metrics(df, "d"), "metric_name", "metric_value")) == {
        "row_count": "3", "n:min": "1.0", "n:max": "3.0", "n:mean": "1.667",
    }


def test_checksum_ignores_order(spark, sf, tmp_path):
    df = spark.read.parquet(f"{sf}/orders.parquet")
    df.repartition(3).write.parquet(str(tmp_path / "copy"))
    copy = spark.read.parquet(str(tmp_path / "copy"))
    a, b = (profile.dataset_run(d, "o", "p").first() for d in (df, copy))
    assert a["checksum"] == b["checksum"] and a["row_count"] == b["row_count"] == df.count()
    files = profile.stored_files(copy)
    assert files.agg(F.sum("size_bytes")).first()[0] == b["size_bytes"]


def test_profiles_meet_their_contracts(spark, sf):
    df = spark.read.parquet(f"{sf}/orders.parquet")

    def shape(table):
        return [(f.name, f.dataType) for f in table.fields]

    assert shape(profile.column_profile(df, "d").schema) == shape(contracts.COLUMN_PROFILE)
    assert shape(profile.column_profile(df, "d", approximate=True).schema) == shape(contracts.COLUMN_PROFILE)
    assert shape(profile.dataset_metrics(df, "d").schema) == shape(contracts.DATASET_METRICS)
    run = profile.dataset_run(df, "o", "p").select(*[F.col(f.name).cast(f.dataType) for f in contracts.DATASET_RUN])
    assert shape(run.schema) == shape(contracts.DATASET_RUN)
    assert set(contracts.DATASET_MANIFEST.names) <= set(profile.stored_files(df).columns)


def test_shares_of_a_cut_without_sizes(spark):
    rows = spark.createDataFrame([("x", "a", None), ("x", "b", None), ("y", "c", 5)], "cut string, label string, value bigint")
    folded = rows.withColumns({"total": F.sum("value").over(Window.partitionBy("cut")), "is_other": F.lit(False)})
    got = {r["label"]: (r["pct"], r["rank"]) for r in shares.with_shares(folded, ["cut"]).collect()}
    assert got == {"a": (None, None), "b": (None, None), "c": (100.0, 1)}
