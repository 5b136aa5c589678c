"""Vocabularies, roll-ups kept up to date, portable checksums and stored sketches."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from massloom.operators import digests, inventory, profile
from massloom.sources import vocabulary

LISTING = "repository_id string, root_path string, path string, is_dir boolean, size_bytes bigint"


# Vocabulary


def _terms(spark, tmp_path, *texts):
    for at, text in enumerate(texts):
        (tmp_path / f"{at}.obo").write_bytes(text.encode())
    return vocabulary.read_terms(spark, str(tmp_path))


def test_terms_of_odd_stanzas(spark, tmp_path):
    terms = _terms(
        spark, tmp_path,
        "﻿[Term]\r\nid: A:1\r\nname: first [one]\r\nis_a: A:2 {x=\"!\"} ! second\r\nis_a: A:3\r\n\r\n[Typedef]\nid: R:1\nname: r\n",
        "format-version: 1.2\n\n[Term]\nid: A:1\nis_a: A:3\nis_obsolete: true\n[Term]\nname: without id\n[Term]\nid: A:4\nname:\nis_obsolete: true",
        "",
    )
    got = {r["accession"]: (r["term"], r["is_a"], r["obsolete"]) for r in terms.collect()}
    assert got == {"A:1": ("first [one]", ["A:2", "A:3"], False), "A:4": (None, [], True)}


def test_closure_of_circles_and_many_ways(spark):
    # Twenty diamonds in a row have a million ways from end to end; 'a' and 'b' run in a circle.
    edges = [("a", ["b"]), ("b", ["a"]), ("alone", [])]
    for k in range(20):
        edges += [(f"t{k}", [f"l{k}", f"r{k}"]), (f"l{k}", [f"t{k + 1}"]), (f"r{k}", [f"t{k + 1}"])]
    closure = vocabulary.ancestors(spark.createDataFrame(edges, "accession string, is_a array<string>"))
    got = {(r[0], r[1]): r[2] for r in closure.collect()}
    parents = {name: above for name, above in edges}
    want = {}
    for name in parents:
        reached, distance = set(parents[name]), 1
        while reached:
            for up in reached:
                want.setdefault((name, up), distance)
            reached = {p for up in reached for p in parents.get(up, []) if (name, p) not in want}
            distance += 1
    assert got == want
    assert got["t0", "t20"] == 40 and got["a", "a"] == 2


def test_closure_of_nothing(spark):
    none = spark.createDataFrame([], "accession string, is_a array<string>")
    assert vocabulary.ancestors(none).count() == 0


def test_rows_under_a_term(spark):
    closure = spark.createDataFrame([("c", "b", 1), ("c", "a", 2), ("b", "a", 1)], "accession string, ancestor string, distance int")
    rows = spark.createDataFrame([(x,) for x in ("a", "b", "c", "c", "d", None)], "accession string")
    assert sorted(r[0] for r in vocabulary.under(rows, closure, "a").collect()) == ["a", "b", "c", "c"]
    assert sorted(r[0] for r in vocabulary.under(rows, closure, "d").collect()) == ["d"]


# Roll-up


def _file(path, size, repo="P"):
    return (repo, "/r", path, False, size)


BEFORE = [
    _file("/r/a/b/x.raw", 5), _file("/r/a/b/y.raw", None), _file("/r/a/z", 7), _file("/r/top", 1),
    _file("/r/a/run.d/in/1", 100), _file("/r/thing", 9), ("P", "/r", "/r/empty", True, None), ("P", "/r", "/r/e2", True, None),
    _file("/r/q", 3, "Q"), _file("/r/k/l", 4, "K"), _file("/r/k/l", 4, "K"),
]
AFTER = [
    # x grows, y becomes known, z moves, the bundle loses its file and gets another, a file becomes a folder.
    _file("/r/a/b/x.raw", 6), _file("/r/a/b/y.raw", 2), _file("/r/c/z", 7), _file("/r/top", 1),
    _file("/r/a/run.d/in/2", 50), _file("/r/thing/part", None), ("P", "/r", "/r/empty", True, None),
    _file("/r/n/new", 8, "N"), ("K", "/r/", "/r/k/l", False, 4),
]


@pytest.mark.parametrize("first, second", [(BEFORE, AFTER), (AFTER, BEFORE), ([], AFTER), (BEFORE, []), (AFTER, AFTER), ([], [])])
def test_rollup_brought_up_to_date(spark, first, second):
    old, new = (spark.createDataFrame(rows, LISTING) for rows in (first, second))
    state = inventory.roll_up_state(old)
    assert sorted(map(tuple, inventory.rolled_up(state).collect()), key=repr) == _rolled(old)
    changed = inventory.roll_up_changed(state, inventory.listing_changes(old, new))
    assert sorted(map(tuple, inventory.rolled_up(changed).collect()), key=repr) == _rolled(new)
    # The state itself is as if made anew, so that the next crawl can be added to it.
    rows = lambda df: sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=repr)
    assert rows(changed) == rows(inventory.roll_up_state(new))


def _rolled(listing):
    rows = inventory.roll_up(inventory.contributions(listing))
    return sorted((tuple(r) for r in rows.select("repository_id", "remote_path", "size_bytes", "is_dir").collect()), key=repr)


def test_untouched_sites_are_not_shuffled_with_the_changes(spark):
    old = spark.createDataFrame(BEFORE, LISTING)
    new = spark.createDataFrame([r for r in BEFORE if r[0] != "Q"], LISTING)
    assert {r[0] for r in inventory.listing_changes(old, new).select("repository_id").collect()} == {"Q"}


# Checksums


def _float_text(x):
    if x is None:
        return None
    if math.isnan(x):
        return "nan"
    if math.isinf(x):
        return "inf" if x > 0 else "-inf"
    if x == 0:
        return "0"
    m, e = math.frexp(abs(x))
    return f"{'-' if x < 0 else ''}{e - 1}:{int(m * 2**53)}"


def test_text_of_doubles(values):
    odd = [0.0, -0.0, 1.0, -1.0, 0.1, 1 / 3, 2.0**52, 2.0**53 - 1, 1e308, -1.7976931348623157e308, 5e-324, 2.2250738585072014e-308, 3e-310,
           math.nan, math.inf, -math.inf, None]
    odd += [f(2.0**k, d) for k in range(-1074, 1024, 7) for f, d in ((math.nextafter, 0.0), (math.nextafter, math.inf))]
    assert values(odd, "double", digests.float_text) == [_float_text(x) for x in odd]


def test_row_digest_is_the_md5_of_a_plain_text(spark):
    rows = spark.sql("SELECT 12L AS a, 'é:' AS b, cast(null AS string) AS c, true AS d, 0.5D AS e, X'0aff' AS f")
    text = "2:122:é:n4:true19:-1:45035996273704964:0aff"
    assert rows.select(digests.row_digest(rows)).first()[0] == hashlib.md5(text.encode()).hexdigest()


def test_rows_that_look_alike_differ(spark):
    rows = spark.createDataFrame([("a", "b"), ("ab", ""), ("", "ab"), (None, "ab"), ("n", "ab"), ("ab", None)], "x string, y string")
    assert rows.select(digests.row_digest(rows)).distinct().count() == 6


def test_bucket_digests_ignore_order_and_count_copies(spark):
    rows = [(k % 50, f"t{k % 7}", k * 0.1) for k in range(500)]
    made = lambda data, parts: sorted(
        map(tuple, digests.bucket_digests(spark.createDataFrame(data, "k int, t string, x double").repartition(parts), ["k"], 16).collect())
    )
    assert made(rows, 1) == made(rows[::-1], 7)
    assert made(rows, 1) != made(rows + rows[:1], 1)
    empty = spark.createDataFrame([], "k int, t string")
    assert digests.bucket_digests(empty, ["k"]).count() == 0
    assert tuple(digests.table_digest(digests.bucket_digests(empty, ["k"]), "none").first()) == ("none", 0, 0, hashlib.md5(b"").hexdigest())


def test_differing_keys_of_bags_and_null_keys(spark):
    schema = "k int, t string, x double"
    before = [(1, "a", 0.0), (2, "b", 1.0), (2, "b", 1.0), (3, None, None), (None, "n", 1.0), (5, "same", math.nan), (6, "gone", 1.0)]
    after = [(1, "a", -0.0), (2, "b", 1.0), (3, "", None), (None, "n", 2.0), (5, "same", math.nan), (7, "new", 1.0), (None, "m", 0.0)]
    old, new = spark.createDataFrame(before, schema), spark.createDataFrame(after, schema)
    want = {(2, "changed"), (3, "changed"), (None, "changed"), (6, "removed"), (7, "added")}
    assert set(map(tuple, digests.differing_keys(old, new, ["k"], 8).collect())) == want
    stored = (digests.bucket_digests(old, ["k"], 8), digests.bucket_digests(new, ["k"], 8))
    assert set(map(tuple, digests.differing_keys(old, new, ["k"], 8, stored).collect())) == want
    assert digests.differing_keys(old, old, ["k"]).count() == 0
    none = spark.createDataFrame([], schema)
    assert digests.differing_keys(none, old, ["k"]).select("change").distinct().collect()[0][0] == "added"


# Sketches


def test_merged_sketches_equal_those_of_all_rows(spark):
    rows = spark.range(20_000).select(
        "id", (F.col("id") % 3000).cast("double").alias("x"), F.lit(None).cast("string").alias("none"),
        F.when(F.col("id") % 2 == 0, F.concat(F.lit("t"), F.col("id") % 10)).alias("t"), F.array("id").alias("list"),
        (F.col("id") % 4).cast("string").alias("part"), (F.col("id") % 5 == 0).alias("flag"), F.current_date().alias("day"),
    )
    split = profile.column_sketches(rows.where("id < 7000"), "d", by="part").unionByName(
        profile.column_sketches(rows.where("id >= 7000"), "d", by="part")
    )
    assert split.count() == 8 * len(rows.columns)
    got = {r["column_name"]: r for r in profile.merged_profile(split).collect()}
    exact = {"id": 20_000, "x": 3000, "none": 0, "t": 5, "list": 20_000, "part": 4, "flag": 2, "day": 1}
    for name, n in exact.items():
        assert got[name]["n_rows"] == 20_000
        assert abs(got[name]["distinct_count"] - n) <= math.ceil(n * profile.DISTINCT_BOUND), name
    assert got["none"]["null_count"] == 20_000 and got["t"]["null_count"] == 10_000
    assert (got["x"]["low"], got["x"]["high"]) == (0.0, 2999.0) and got["t"]["low"] is None
    for share, value in zip((0.25, 0.5, 0.75), got["id"]["quantiles"], strict=True):
        assert abs(value / 20_000 - share) <= profile.QUANTILE_BOUND


def test_sketches_of_no_rows_and_of_no_numbers(spark):
    schema = "x double, t string, n int"
    none = profile.merged_profile(profile.column_sketches(spark.createDataFrame([], schema), "d")).collect()
    assert [(r["n_rows"], r["distinct_count"], r["quantiles"]) for r in none] in ([], [(0, 0, None)] * 3)
    odd = spark.createDataFrame([(math.nan, None, None), (0.0, "", None), (-0.0, "", None), (None, "a", None)], schema)
    got = {r["column_name"]: r for r in profile.merged_profile(profile.column_sketches(odd, "d")).collect()}
    assert (got["x"]["distinct_count"], got["x"]["null_count"], got["x"]["low"], got["x"]["high"]) == (2, 1, 0.0, 0.0)
    assert got["x"]["quantiles"] == [0.0, 0.0, 0.0] and got["t"]["distinct_count"] == 2
    assert (got["n"]["distinct_count"], got["n"]["null_count"], got["n"]["low"], got["n"]["quantiles"]) == (0, 4, None, None)
