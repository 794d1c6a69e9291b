from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

SF = "/root/testdata/sf0.001"
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def small_docs():
    """Rows of the smallest documents table, plus nulls, empties, ties, repeats, one long text and odd white space."""
    import pyarrow.parquet as pq

    rows = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()]
    base = rows[3][1]
    extra = [
        (9000, None, None, None, None), (9001, "", "en", "src1", 0), (9002, " \t\n ", "en", "src1", 4), (9003, base.upper(), "en", None, 1),
        (9004, base, "en", "src2", 1), (9005, base, "en", "src2", 1), (9006, base.replace(" ", "\t\n ", 5), "en", "src2", 1),
        (9007, "one two", "en", "", 7), (9008, "ONE  two", "en", "", 8), (9009, "é" * 60 + " " + "x" * 200, "fr", "src3", 1),
        (9010, " ".join(f"w{i % 701}x{i}" for i in range(30_000)), "en", "src0", 1), (9011, "a" * 400, "en", "src0", 400),
        (9012, base[: len(base) // 2] + " changed " + base[len(base) // 2 :], "en", "src2", 1),
    ]
    return rows + extra


@pytest.fixture
def docs(spark, small_docs):
    return spark.createDataFrame(small_docs, DOC_SCHEMA).repartition(5)


@pytest.fixture
def empty_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture
def clashing(spark, small_docs):
    """Columns that carry the names the operators use inside, and rows with a null id."""
    from pyspark.sql import functions as F

    rows = [*small_docs[:40], (None, "one two three four five", "en", "src1", 1), (None, None, None, None, None), small_docs[5], small_docs[5]]
    d = spark.createDataFrame(rows, DOC_SCHEMA)
    return d.withColumns({c: F.lit("x") for c in ("id", "h", "norm", "n", "size", "start", "cell", "chunk", "group", "kept", "keep_id", "lost_id", "mix_id", "copies", "y", "lid", "h2", "seg", "block", "score")})
