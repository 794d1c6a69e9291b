"""Operator 13 against plain counting with exact integers."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from rareseries.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(rows, min_docs, top):
    docs, count, groups = Counter(), Counter(), set()
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        groups.add((lang, source))
        found = Counter(TERM.findall(text.translate(LOWER)))
        for t, n in found.items():
            docs[lang, t] += 1
            count[lang, source, t] += n
    kept = defaultdict(list)
    for (lang, t), n in docs.items():
        if n >= min_docs:
            kept[lang].append(t)
    out = set()
    for lang in {g[0] for g in groups}:
        terms, sources = kept[lang], [s for g, s in groups if g == lang]
        v = len(terms)
        n = {s: sum(count[lang, s, t] for t in terms) for s in sources}
        whole = sum(n.values())
        p = {s: {t: 1 + 10**9 * (count[lang, s, t] + 5) // (n[s] + 5 * v) for t in terms} for s in sources}
        q = {t: 1 + 10**9 * (sum(count[lang, s, t] for s in sources) + 5) // (whole + 5 * v) for t in terms}
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in terms), o.encode()) for o in sources if o != s]
            more = [(q[t] - p[s][t], t.encode()) for t in terms if count[lang, s, t] and p[s][t] > q[t]]
            out |= {(lang, s, "pair", o.decode(), -f, r) for r, (f, o) in enumerate(sorted(pairs), 1)}
            out |= {(lang, s, "term", t.decode(), -f, r) for r, (f, t) in enumerate(sorted(more)[:top], 1)}
    return out


def rows_of(small_docs):
    rows = [(r[1], r[2], r[3]) for r in small_docs if r[1] is None or len(r[1]) < 20_000]
    rows += [("Über ÜBER ünder x1y_z\x00q é's", "de", None), (None, None, None), ("alone", "xx", "s"), ("", "xx", "t"), ("", "yy", "only"), ("[brackets] `tick` {curly} @at \x7f del", "en", "src1")]
    return rows + [("hot words hot words", "en", "hot")] * 300 + [("hot words", None, None)] * 40 + rows[:3] * 2


@pytest.mark.parametrize(("block", "shard", "held"), [(64, 100_000, 200_000), (3, 50, 40)])
def test_source_divergence(spark, small_docs, monkeypatch, block, shard, held):
    for name, value in (("BLOCK_SOURCES", block), ("SHARD_ROWS", shard), ("HELD_TERMS", held), ("DENSE_TERMS", 7 if block == 3 else 2048), ("RUN_BYTES", 64 if block == 3 else 1 << 20)):
        monkeypatch.setattr(divergence, name, value)
    rows = rows_of(small_docs)
    docs = spark.createDataFrame(rows, "text string, lang string, source string").withColumns({c: F.lit("x") for c in ("term", "docs", "count", "p", "q", "v", "base", "total", "doc_id")})
    got = divergence.source_divergence(docs.repartition(5), min_docs=8, top=9)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert dict(got.dtypes)["value"] == "bigint" and dict(got.dtypes)["rank"] == "int"
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == by_hand(rows, 8, 9)


def test_large_counts(spark, monkeypatch):
    """Counts beyond 10^10 stay exact."""
    counts = [("en", "a", "x", 40, 30_000_000_001), ("en", "a", "y", 40, 7), ("en", "b", "x", 2, 19_999_999_999), ("en", "b", "z", 30, 3)]
    monkeypatch.setattr(divergence, "term_counts", lambda docs, *_: spark.createDataFrame(counts, divergence._COUNTS))
    docs = spark.createDataFrame([("", "en", "a"), ("", "en", "b")], "text string, lang string, source string")
    n = {"a": 30_000_000_008, "b": 20_000_000_002}
    c = {(s, t): x for _, s, t, _, x in counts}
    p = {(s, t): 1 + 10**9 * (c.get((s, t), 0) + 5) // (n[s] + 15) for s in "ab" for t in "xyz"}
    value = sum(abs(p["a", t] - p["b", t]) for t in "xyz")
    assert {(r["source"], r["value"]) for r in divergence.source_divergence(docs).where("part = 'pair'").collect()} == {("a", value), ("b", value)}


def test_empty(spark, empty_docs):
    assert divergence.source_divergence(empty_docs).count() == 0


def test_terms_are_bytes_of_the_pattern():
    text = "Ab1cD-é'ß\tX\x0b\x0cy\x85z w" * 50
    want = [t.encode() for t in TERM.findall(text.translate(LOWER))]
    assert [t for run in divergence.terms(text.encode()) for t in run] == want
