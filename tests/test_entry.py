"""Driver contract: entry smoke, registry consistency, a sample of oracle checks at sf0.001."""
from __future__ import annotations

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from helpers import SF_SMALL  # noqa: E402
from oracle_check import TABLES, normalise  # noqa: E402
from rareseries.queries import QUERIES  # noqa: E402


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert rows and "content_hash" in df.columns and "%Rare" not in df.columns
    assert df.schema == entry.entry(spark).schema


def test_every_query_of_the_library_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", ["scan_orders", "scan_entries", "panel_wide", "granularity", "limit_new",
                                  "resume_anti", "control_points", "embedding"])
def test_query_matches_oracle(spark, duck, name):
    got = entry.queries()[name](spark, SF_SMALL).toPandas()
    want = duck.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert normalise(got) == normalise(want)
