"""Inputs above ``chunk_rows`` give what the same inputs give below it."""
from __future__ import annotations

import pytest

from rareseries.operators.catalog import commit_version, list_versions, load_catalog, write_catalog
from rareseries.operators.drift import diff_profiles
from rareseries.operators.increment import first_per_key
from rareseries.params import ScoreParams
from rareseries.operators.scan import series_stats
from rareseries.plans.sequence import number_rows

INF = float("inf")


@pytest.mark.parametrize("chunk_rows", [8, 64, 1 << 20])
def test_numbering_null_keys_strings_and_null_order(spark, chunk_rows):
    rows = [(None if i % 2 else "k", None if i % 3 == 0 else f"é{i % 7}-{i:03d}"[: 3 + i % 4], i) for i in range(150)]
    got = number_rows(spark.createDataFrame(rows, "k string, s string, i long"), ["k"], ["s", "i"], chunk_rows=chunk_rows).collect()
    want = {}
    for key in (None, "k"):
        part = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is None, (r[1] or "").encode(), r[2]))
        want.update({r[2]: n for n, r in enumerate(part)})
    assert {r["i"]: r["pos"] for r in got} == want


@pytest.mark.parametrize("chunk_rows", [8, 1 << 20])
def test_numbering_extreme_and_missing_numbers(spark, chunk_rows):
    rows = [("a", v, i) for i, v in enumerate([1e308, -1e308, INF, -INF, None, 0.0, 1.0] * 12)]
    got = number_rows(spark.createDataFrame(rows, "k string, v double, i long"), ["k"], ["v", "i"], chunk_rows=chunk_rows).collect()
    order = sorted(rows, key=lambda r: (r[1] is None, r[1] or 0.0, r[2]))
    assert {r["i"]: r["pos"] for r in got} == {r[2]: n for n, r in enumerate(order)}


def test_infinite_series_in_the_chunked_statistics(spark):
    rows = [("inf", i, INF if i == 50 else float(i % 9)) for i in range(100)] + [("ok", i, float(i * i % 17)) for i in range(100)]
    panel = spark.createDataFrame(rows, "id string, pos long, value double")
    stats = {}
    for chunk_rows in (32, 1000):
        got, _ = series_stats(panel, ScoreParams(chunk_rows=chunk_rows))
        stats[chunk_rows] = {r["id"]: r for r in got.select("id", "length", "n_infinite", "N", "n_rare").collect()}
    assert stats[32]["ok"] == stats[1000]["ok"]
    assert stats[32]["inf"]["n_infinite"] == stats[1000]["inf"]["n_infinite"] == 1


def test_first_per_key_without_order(spark):
    rows = [("a", None, "y"), ("a", None, "x"), ("b", None, "late"), ("b", 2, "first"), ("b", 3, "no")]
    got = {r["id"]: (r["ord"], r["v"]) for r in first_per_key(spark.createDataFrame(rows, "id string, ord long, v string")).collect()}
    assert got == {"a": (None, "x"), "b": (2, "first")}


def test_versions_are_strings(spark, tmp_path):
    for version, at in (("1.1", "2024-01-02"), ("1.10", "2024-01-01")):
        rows = spark.createDataFrame([(f"row {version}",)], "id string")
        write_catalog(rows, rows, str(tmp_path), version, at)
    assert [r["id"] for r in load_catalog(spark, str(tmp_path), "1.10").collect()] == ["row 1.10"]
    assert [r["id"] for r in load_catalog(spark, str(tmp_path)).collect()] == ["row 1.1"]
    assert sorted(r["version"] for r in list_versions(spark, str(tmp_path)).collect()) == ["1.1", "1.10"]
    with pytest.raises(FileNotFoundError):
        load_catalog(spark, str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        load_catalog(spark, str(tmp_path), "1.2")


def test_versions_are_whole_and_stay(spark, tmp_path):
    """A second write of a version fails; a write that ends between its tables, or before its record, shows nothing."""
    root = str(tmp_path)
    one, two = (spark.createDataFrame([(x,)], "id string") for x in ("one", "two"))
    write_catalog(one, one, root, "1.0", "2024-01-01")
    with pytest.raises(FileExistsError):
        write_catalog(two, two, root, "1.0", "2024-02-01")
    with pytest.raises(FileExistsError):  # another writer was faster
        commit_version(spark, root, {"version": "1.0", "published_at": "2024-03-01", "series": "tables/x", "scanned": "tables/y"})
    broken = two.selectExpr("raise_error('lost') as id")
    with pytest.raises(Exception, match="lost"):
        write_catalog(two, broken, root, "2.0", "2024-04-01")
    assert [r["id"] for t in ("series", "scanned") for r in load_catalog(spark, root, table=t).collect()] == ["one", "one"]
    assert [tuple(r) for r in list_versions(spark, root).collect()] == [("1.0", "2024-01-01")]
    write_catalog(two, one, root, "2/0 é", "2024-05-01")
    assert load_catalog(spark, root).first()["id"] == "two" and load_catalog(spark, root, "1.0").first()["id"] == "one"


def test_drift_compares_numbers(spark):
    schema = "path string, value string"
    old = spark.createDataFrame([("a", "20000000.0"), ("b", "0.0005"), ("c", '"x"'), ("d", "1")], schema)
    new = spark.createDataFrame([("a", "2.0E7"), ("b", "5.0E-4"), ("c", '"y"'), ("d", "2")], schema)
    assert [r["path"] for r in diff_profiles(old, new).collect()] == ["c", "d"]
