"""Registered queries against their SQL on the smallest tables."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest

from rareseries.llm.queries import LLM_ORACLE, LLM_QUERIES

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

from oracle_check import normalise  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got, want = LLM_QUERIES[name](spark, SF).toPandas(), con.execute(LLM_ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(got)
    assert normalise(got) == normalise(want)
