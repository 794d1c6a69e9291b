"""The corpus pipeline, stage by stage, against brute force on each stage's own input."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import corpus_pipeline
from tests.llm.test_operators import LOWER, shingles

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, rows = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "packing":
            assert docs.columns == columns
        rows[name] = docs.collect()
    first = spark.read.parquet(f"{SF}/documents.parquet").collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = {r["doc_id"] for r in rows["quality_classifier"]}
    for r in first:
        if labels.get(r["doc_id"]) == 1:
            assert r["doc_id"] in good
    assert sum(labels.get(r["doc_id"]) == 0 for r in rows["quality_classifier"]) <= 0.1 * sum(q == 0 for q in labels.values())

    best = {}
    for r in rows["quality_classifier"]:
        t = (r["text"] or "").translate(LOWER)
        best[t] = min(best.get(t, r["doc_id"]), r["doc_id"])
    assert sorted(r["doc_id"] for r in rows["exact_dedup"]) == sorted(best.values())

    sets = {r["doc_id"]: shingles(r["text"], 5) for r in rows["exact_dedup"]}
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    index = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            index[x].append(i)
    for i, s in sets.items():
        for j, n in Counter(j for x in s for j in index[x] if j > i).items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    assert sorted(r["doc_id"] for r in rows["jaccard_join"]) == sorted({find(i) for i in sets})

    copies = Counter(r["doc_id"] for r in rows["mixing"])
    assert set(copies) <= {r["doc_id"] for r in rows["jaccard_join"]} and max(copies.values()) <= 3
    words = lambda rs: sum(len(re.findall(r"[^\x20\x09-\x0d]+", r["text"] or "")) for r in rs)
    assert 0.7 * words(rows["jaccard_join"]) <= words(rows["mixing"]) <= 1.3 * words(rows["jaccard_join"])

    whole = defaultdict(int)
    for r in rows["packing"]:
        whole[r["doc_id"]] += r["length"]
    tokens = {r["doc_id"]: r["doc_tokens"] for r in rows["packing"]}
    assert {i: n * tokens[i] for i, n in copies.items()} == dict(whole)


def test_run_and_registration(spark):
    import __spark_entry__ as entry

    names = entry.queries()
    assert {"pipeline"} | {f"op{n}" for n in range(1, 14)} <= {n.split("_")[0] for n in names}
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
