"""Folders of wide CSV files and of JSON-lines entries."""
from __future__ import annotations

import gzip
import json
import math
from datetime import datetime

import pytest

from rareseries.operators.batch import scan_batch
from rareseries.operators.increment import limit_new
from rareseries.sources.entries import entry_header
from rareseries.sources.files import entries_from_files, list_files, panel_from_wide_files


def put(root, files: dict[str, str | bytes]) -> str:
    for path, text in files.items():
        p = root / path
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(root)


@pytest.fixture
def small_splits(spark):
    """Files are cut into splits of 4 KB."""
    conf = {"spark.sql.files.maxPartitionBytes": "4k", "spark.sql.files.openCostInBytes": "0"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k in conf:
        spark.conf.unset(k)


def by_series(panel):
    out = {}
    for r in panel.orderBy("id", "pos").collect():
        out.setdefault(r["id"], []).append(r["value"])
    return out


WIDE = {
    "ETT-small/a+b%20 c.csv": '﻿date,x,"y, ""z""",x,,flag,e\n1990-1-10,1,2.5,3,4,t,\n1990-1-2,2,,4,5,u,NA\n\nsoon,9,1e3,5,6,v,nan\n1990-1-3,3,-.5,5, 7 ,w,\n',
    "weather/plain.csv": "p,q,r\n5,,True\n4,1,False\n3,2,True\n",
    "weather/crlf.csv": "p,q\r\n1,2\r\n3,4\r\n",
    "weather/bad.csv": "p,q\n5,6\n4,1,9\n",
    "weather/empty.csv": "",
    "weather/blank.csv": "\n \n",
    "illness/only.csv": "p,q\n",
    "zz/out.csv": "p\n1\n",
    "traffic/plain.csv": "p\n7\n",
    "weather/plain.txt": "p\n1\n",
}


def test_wide_files(spark, tmp_path):
    header, panel, failures = panel_from_wide_files(spark, put(tmp_path, WIDE))
    heads = {r["id"]: r for r in header.collect()}
    got = by_series(panel)
    # of one collection's files the first path counts; text and boolean columns are no series
    assert {k: r["dtype"] for k, r in heads.items()} == {
        "tslib:a+b%20-c:x": "int64", 'tslib:a+b%20-c:y,-"z"': "float64", "tslib:a+b%20-c:x.1": "int64", "tslib:a+b%20-c:unnamed:-4": "int64", "tslib:a+b%20-c:e": "float64",
        "tslib:plain:p": "int64", "tslib:crlf:p": "int64", "tslib:crlf:q": "int64"}
    assert got["tslib:a+b%20-c:x"] == [2.0, 3.0, 1.0, 9.0]  # by date, an unparseable one last
    assert got['tslib:a+b%20-c:y,-"z"'] == [None, -0.5, 2.5, 1000.0] and got["tslib:a+b%20-c:unnamed:-4"] == [5.0, 7.0, 4.0, 6.0]
    assert got["tslib:a+b%20-c:e"] == [None] * 4 and got["tslib:plain:p"] == [7.0] and got["tslib:crlf:q"] == [2.0, 4.0]
    assert {(r["collection"], r["note"]) for r in failures.collect()} == {
        ("bad", "read failed: a line has more fields than the header"), ("empty", "read failed: the file has no header line"), ("blank", "read failed: the file has no header line")}
    assert heads["tslib:a+b%20-c:x"]["time_column"] == "date" and heads["tslib:plain:p"]["time_column"] is None
    first = panel.filter("id = 'tslib:a+b%20-c:x' and pos = 0").first()
    assert first["ts"] == datetime(1990, 1, 2)
    # R4 takes columns in their order, R5 has a row for every unreadable file
    assert [r["name"] for r in limit_new(header, 2).orderBy("ord").collect() if r["collection"] == "a+b%20 c"] == ["x", 'y, "z"']
    rows = {r["id"]: (r["status"], r["length"]) for r in scan_batch(header, panel, failures=failures, with_hash=False).collect()}
    assert rows["tslib:bad:dataset"] == ("error", None) and rows["tslib:a+b%20-c:x"] == ("skipped_short", 4) and len(rows) == 11


def test_wide_files_keep_file_order_across_splits(spark, tmp_path, small_splits):
    """Two files of many splits, the larger first: lines stand in file order where no date orders them."""
    big, small = [(i * 7919) % 20011 for i in range(20000)], [(i * 31) % 2003 for i in range(2000)]
    dated = [f"1990-1-{1 + i % 3},{i}" for i in range(3000)]
    root = put(tmp_path, {"ETT-small/big.csv": "v,w\n" + "".join(f"{v},{i}\n" for i, v in enumerate(big)), "weather/small.csv": "w\n" + "".join(f"{v}\n" for v in small),
                          "weather/ties.csv": "date,i\n" + "\n".join(dated) + "\n"})
    _, panel, _ = panel_from_wide_files(spark, root, chunk_rows=700)
    got = by_series(panel)
    assert got["tslib:big:v"] == big and got["tslib:big:w"] == list(range(20000)) and got["tslib:small:w"] == small
    assert got["tslib:ties:i"] == sorted(range(3000), key=lambda i: (i % 3, i))  # equal dates keep file order


def test_no_files(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    header, panel, failures = panel_from_wide_files(spark, str(tmp_path / "empty"))
    assert header.count() == panel.count() == failures.count() == 0
    assert list_files(spark, str(tmp_path / "empty"), "*.csv").count() == 0


ENTRIES = """{"item_id": 0, "target": [1, 2.5, null, NaN]}

{"target": [1]}
not json
{"item_id": null, "target": []}
{"item_id": "x"}
{"item_id": "y", "target": [1, "a"]}
{"item_id": "z", "target": 7}
{"item_id": "n", "target": ["1.5", -2e3]}
[1]
{"start": "1990", "item_id": "w", "target": [5, 6], "feat": {"a": [1]}}
{"item_id": "cut", "target": [1, 2
"""


def test_entries_from_files(spark, tmp_path):
    root = put(tmp_path / "in", {"c1/train/data.json": ENTRIES, "c1/metadata/metadata.json": '{"freq": "H",\n "target": 1}', "c1/test/data.json": '{"target": [8]}\n',
                                 "c=c2/train/b.json": '{"target": [1]}\n' * 3, "c=c2/train/a.json.gz": gzip.compress(b'{"target": [9]}\n' * 2)})
    entries, quarantine = entries_from_files(spark, root, str(tmp_path / "out"))
    got = {(r["collection"], r["entry_ord"]): r for r in entries.collect()}
    assert {k: r["item_id"] for k, r in got.items()} == {("c1", 0): "0", ("c1", 1): None, ("c1", 3): None, ("c1", 7): "n", ("c1", 9): "w", **{("c2", i): None for i in range(5)}}
    first = got["c1", 0]["target"]
    assert first[:3] == [1.0, 2.5, None] and math.isnan(first[3]) and got["c1", 7]["target"] == [1.5, -2000.0] and got["c1", 3]["target"] == []
    assert [got["c2", i]["target"] for i in range(5)] == [[9.0]] * 2 + [[1.0]] * 3 and {r["freq"] for k, r in got.items()} == {"H", None}
    bad = {(r["entry_ord"], r["reason"]) for r in quarantine.collect()}
    assert bad == {(2, "line is not JSON"), (4, "entry has no target array"), (5, "target is not an array of numbers"), (6, "target is not an array of numbers"),
                   (8, "entry has no target array"), (10, "line is not JSON")}
    assert {r["line"] for r in quarantine.filter("entry_ord = 2").collect()} == {"not json"}
    ids = {r["id"] for r in entry_header(entries.filter("collection = 'c1'"), "c1", "H").collect()}
    assert ids == {"gluonts:c1:0", "gluonts:c1:1", "gluonts:c1:3", "gluonts:c1:n", "gluonts:c1:w"}


def test_entry_positions_across_splits(spark, tmp_path, small_splits):
    lines = [json.dumps({"target": [i]}) if i % 5 else "{broken" for i in range(3000)]
    root = put(tmp_path / "in", {"c/train/b.json": "\n".join(lines[1500:]), "c/train/a.json": "\n\n".join(lines[:1500]) + "\n"})
    entries, quarantine = entries_from_files(spark, root, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).select("file", "block").distinct().count() > 10
    assert all(r["target"] == [r["entry_ord"]] for r in entries.collect())
    assert {r["entry_ord"] for r in quarantine.collect()} == set(range(0, 3000, 5)) and entries.count() == 2400
