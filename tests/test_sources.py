"""Sources, ids and calendar helpers (fixtures F1, F2, F6)."""
from __future__ import annotations

import hashlib
import posixpath
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rareseries.functions.calendar import normalize_granularity, parse_dates, seasonal_period
from rareseries.functions.ids import blob_path, id_part, make_id, unsafe_path
from rareseries.operators.hashing import content_hashes
from rareseries.schemas import ENTRIES
from rareseries.sources.entries import panel_from_entries
from rareseries.sources.wide import infer_granularity, panel_from_wide, select_collections


def test_entry_ids_keep_zero_and_fall_back_to_position(spark):
    e = spark.createDataFrame([(0, "0", [1.0, 2.0]), (1, None, [3.0, 4.0])], ENTRIES)
    h, p = panel_from_entries(e, "test", "D")
    assert sorted(r["id"] for r in h.collect()) == ["gluonts:test:0", "gluonts:test:1"]
    vals = [r["value"] for r in p.filter("id = 'gluonts:test:0'").orderBy("pos").collect()]
    assert vals == [1.0, 2.0]
    assert {r["granularity"] for r in h.collect()} == {"D"}


def test_malformed_entry_is_skipped_without_aborting(spark):
    e = spark.createDataFrame([(0, "0", [1.0]), (1, "1", None), (2, "2", [2.0])], ENTRIES)
    h, _ = panel_from_entries(e, "test", "D")
    assert sorted(r["id"] for r in h.collect()) == ["gluonts:test:0", "gluonts:test:2"]


def test_empty_target_is_a_series_without_points(spark):
    e = spark.createDataFrame([(0, "e", []), (1, "n", [float("nan"), 1.0])], ENTRIES)
    h, p = panel_from_entries(e, "test", None)
    assert h.count() == 2 and p.filter("id = 'gluonts:test:e'").count() == 0
    assert [r["value"] for r in p.filter("id = 'gluonts:test:n'").orderBy("pos").collect()] == [None, 1.0]


def test_wide_table_sorts_by_parsed_date(spark):
    df = spark.createDataFrame([("1990-1-10", 10.0), ("1990-1-2", 2.0)], "date string, value double")
    h, p = panel_from_wide(df, "test")
    hr = h.collect()
    assert [r["id"] for r in hr] == ["tslib:test:value"] and hr[0]["time_column"] == "date"
    rows = p.orderBy("pos").collect()
    assert [r["value"] for r in rows] == [2.0, 10.0]
    assert rows[0]["ts"] == datetime(1990, 1, 2)


def test_wide_table_without_date_keeps_file_order(spark):
    df = spark.createDataFrame([(2.0, 5, "x"), (1.0, 6, "y")], "b double, a int, note string")
    h, p = panel_from_wide(df, "test")
    hr = {r["name"]: r for r in h.collect()}
    assert set(hr) == {"a", "b"} and hr["a"]["dtype"] == "int64" and hr["b"]["dtype"] == "float64"
    assert hr["a"]["time_column"] is None and hr["a"]["granularity"] is None
    assert [r["value"] for r in p.filter("name = 'b'").orderBy("pos").collect()] == [2.0, 1.0]
    assert p.filter(F.col("ts").isNotNull()).count() == 0


def test_unparseable_dates_sort_last_and_become_null(spark):
    df = spark.createDataFrame([("junk", 9.0), ("2001-02-03 04:05:06", 1.0), ("2001-2-2", 0.0)],
                               "date string, v double")
    _, p = panel_from_wide(df, "t")
    rows = p.orderBy("pos").collect()
    assert [r["value"] for r in rows] == [0.0, 1.0, 9.0] and rows[2]["ts"] is None
    assert rows[1]["ts"] == datetime(2001, 2, 3, 4, 5, 6)


def test_parse_dates(spark):
    df = spark.createDataFrame([("1990-1-2",), ("1990-01-02",), ("nope",), (None,), ("2020/3/4 10:00",)], "s string")
    got = [r[0] for r in df.select(parse_dates("s")).collect()]
    assert got == [datetime(1990, 1, 2), datetime(1990, 1, 2), None, None, datetime(2020, 3, 4, 10, 0)]


def _dates(start, step, n):
    return [start + step * i for i in range(n)]


@pytest.mark.parametrize("name,ts,want", [
    ("hourly", _dates(datetime(2020, 1, 1), timedelta(hours=1), 30), "H"),
    ("ten_min", _dates(datetime(2020, 1, 1), timedelta(minutes=10), 30), "10min"),
    ("minute", _dates(datetime(2020, 1, 1), timedelta(minutes=1), 30), "min"),
    ("daily", _dates(datetime(2020, 1, 1), timedelta(days=1), 30), "D"),
    ("weekly_tue", _dates(datetime(2020, 1, 7), timedelta(days=7), 10), "W-TUE"),
    ("business", [d for d in _dates(datetime(2020, 1, 1), timedelta(days=1), 40) if d.weekday() < 5], "B"),
    ("month_end", [datetime(2020 + (m // 12), m % 12 + 1, 1) - timedelta(days=1) for m in range(1, 25)], "M"),
    ("quarter_start", [datetime(2019 + m // 12, m % 12 + 1, 1) for m in range(0, 36, 3)], "Q"),
    ("year_end", [datetime(y, 12, 31) for y in range(2000, 2010)], "Y"),
    ("two_points", _dates(datetime(2020, 1, 1), timedelta(days=1), 2), None),
    ("duplicate", [datetime(2020, 1, 1)] * 2 + [datetime(2020, 1, 2)], None),
    ("irregular", [datetime(2020, 1, 1), datetime(2020, 1, 2), datetime(2020, 1, 5)], None),
    ("with_null", _dates(datetime(2020, 1, 1), timedelta(days=1), 5) + [None], None),
])
def test_infer_granularity(spark, name, ts, want):
    df = spark.createDataFrame([(name, t) for t in ts], "g string, ts timestamp_ntz")
    assert infer_granularity(df, ["g"], "ts").collect()[0]["granularity"] == want


def test_granularity_aliases_and_periods(spark):
    vals = ["1H", "h", "H", "1h", "1B", "0.5h", "D", "W-TUE", "1M", "unknown", None]
    df = spark.createDataFrame([(v,) for v in vals], "g string")
    got = [(r[0], r[1]) for r in df.select(normalize_granularity("g"), seasonal_period(normalize_granularity("g")))
           .collect()]
    assert got == [("H", 24), ("H", 24), ("H", 24), ("H", 24), ("B", 5), ("30min", 48), ("D", 7), ("W-TUE", 52),
                   ("1M", 12), ("unknown", None), (None, None)]


def test_make_and_split_ids(spark):
    df = spark.createDataFrame([("GluonTS", "M4 Hourly", "H 1"), ("tslib", "weather", "wv-(m/s):x")],
                               "s string, c string, k string")
    ids = [r[0] for r in df.select(make_id("s", "c", "k")).collect()]
    assert ids == ["gluonts:m4-hourly:h-1", "tslib:weather:wv-(m/s):x"]
    parts = spark.createDataFrame([(i,) for i in ids + ["only:two"]], "id string").select(
        id_part("id", 0), id_part("id", 1), id_part("id", 2)).collect()
    assert tuple(parts[1]) == ("tslib", "weather", "wv-(m/s):x") and parts[2][2] is None


def test_blob_paths(spark):
    df = spark.createDataFrame([("gluonts:m4_hourly:h1",), ("tslib:weather:wv-(m/s)",)], "id string")
    assert [r[0] for r in df.select(blob_path("id")).collect()] == [
        "gluonts/m4_hourly/ce/h1.parquet", "tslib/weather/68/wv--m-s-.parquet"]


def test_blob_path_shards_spread_a_large_collection(spark):
    ids = spark.range(20_000).select(F.concat(F.lit("gluonts:m4_monthly:t"), F.col("id").cast("string")).alias("id"))
    shards = Counter(r[0].rsplit("/", 2)[1] for r in ids.select(blob_path("id")).collect())
    assert max(shards.values()) < 10_000 and len(shards) == 256
    sample = "gluonts:m4_monthly:t17"
    assert hashlib.md5(sample.encode()).hexdigest()[:2] in shards


@pytest.mark.parametrize("path", ["../../etc/passwd", "/etc/passwd", "a/../../b", "..", "a/b/../c", "./a",
                                  "a//b", "a/./../b", "..a/b", "a/..", ""])
def test_unsafe_path_agrees_with_normpath(spark, path):
    norm = posixpath.normpath(path)
    want = path.startswith("/") or norm == ".." or norm.startswith("../")
    got = spark.createDataFrame([(path,)], "p string").select(unsafe_path("p")).collect()[0][0]
    assert got == want


def test_select_collections_first_file_wins(spark):
    files = spark.createDataFrame([("weather/weather.csv",), ("ETT-small/ETTh1.csv",), ("ETT-small/b/ETTh1.csv",),
                                   ("other/x.csv",), ("traffic/traffic.txt",)], "path string")
    got = sorted((r["collection"], r["path"]) for r in select_collections(files).collect())
    assert got == [("ETTh1", "ETT-small/ETTh1.csv"), ("weather", "weather/weather.csv")]
    assert [r["collection"] for r in select_collections(files, wanted=["weather"]).collect()] == ["weather"]


def test_entries_with_one_id_keep_the_first_and_only_its_points(spark):
    rows = [(0, "Ab", [1.0, 2.0]), (1, "aB", [3.0] * 5), (2, "c", [4.0])]
    entries = spark.createDataFrame(rows, "entry_ord long, item_id string, target array<double>")
    header, panel = panel_from_entries(entries, "col", "D")
    assert {(r["name"], r["ord"]) for r in header.collect()} == {("Ab", 0), ("c", 2)}
    assert sorted((r["name"], r["pos"], r["value"]) for r in panel.collect()) == [("Ab", 0, 1.0), ("Ab", 1, 2.0), ("c", 0, 4.0)]
    assert content_hashes(panel).count() == 2
