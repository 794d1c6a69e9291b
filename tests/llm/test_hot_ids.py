"""A third of the rows under one id and a third without one: what operators and stages make of them."""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rareseries.llm import common, jaccard_join, packing, suffix_dedup, vector_dedup
from rareseries.llm.exact_dedup import drop_copies
from rareseries.llm.jaccard_join import jaccard_groups, keep_one_per_group
from rareseries.llm.mixing import mix, mixed_documents
from rareseries.llm.quality import keep_good, rate
from tests.llm.test_operators import LOWER, roots, shingles

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def hot_rows():
    """Groups of copies and near copies, under ids of their own, one repeated id (5), and null."""
    rows = []
    for i in range(240):
        words = [f"w{i % 40}x{j}" for j in range(30)]
        if i % 3 == 1:
            words[0] = f"changed{i}"
        name = 1000 + i if i % 3 == 0 else 5 if i % 3 == 1 else None
        rows.append((name, " ".join(words) if i % 40 != 7 else None, "en", f"s{i % 4}" if i % 5 else None, i % 2))
    return rows + rows[:6] * 3


@pytest.fixture
def hot(spark):
    return spark.createDataFrame(hot_rows(), SCHEMA).repartition(4)


def groups_by_hand(rows, k, percent):
    sets = [shingles(r[1], k) for r in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    out = defaultdict(list)
    for i in range(len(rows)):
        out[find(i)].append(i)
    return sets, list(out.values())


def key(row):
    return (row[0] is None, row[0] or 0)


def test_jaccard_groups_by_row(hot):
    rows = hot_rows()
    sets, groups = groups_by_hand(rows, 4, 85)
    want = Counter()
    for g in groups:
        names = [rows[i][0] for i in g if rows[i][0] is not None]
        for i in g:
            want[rows[i][0], len(sets[i]), min(names) if names else None] += 1
    assert Counter(map(tuple, jaccard_groups(hot, k=4, percent=85).collect())) == want


def test_keep_one_row_of_each_group(hot):
    rows = hot_rows()
    _, groups = groups_by_hand(rows, 5, 80)
    out = keep_one_per_group(hot)
    got = [tuple(r) for r in out.collect()]
    assert out.columns == hot.columns and len(got) == len(groups)
    assert Counter(r[0] for r in got) == Counter(min((rows[i] for i in g), key=key)[0] for g in groups)
    assert set(got) <= set(rows)


def test_jaccard_links_are_contracted_in_stages_without_another_python_step(hot, monkeypatch):
    plans, contract = [], jaccard_join.components
    monkeypatch.setattr(jaccard_join, "components", lambda edges: plans.append(edges._jdf.queryExecution().toString()) or contract(edges))
    keep_one_per_group(hot)
    assert len(plans) == 2 and not any("MapInArrow" in p for p in plans)


def test_jaccard_links_of_more_sets_than_are_weighed_at_a_time():
    rng = np.random.default_rng(3)
    sets = [np.sort(rng.choice(40, 30, replace=False)).astype(np.uint64) for _ in range(2 * jaccard_join.ROWS + 9)]
    rows = np.zeros((len(sets), 40), dtype=int)
    for i, s in enumerate(sets):
        rows[i, s.astype(int)] = 1
    both = rows @ rows.T
    want = np.nonzero(np.triu(100 * both >= 70 * (60 - both), 1))
    got = jaccard_join._links(sets, 70)
    assert len(want[0]) and sorted(zip(*got, strict=True)) == sorted(zip(*want, strict=True))


@pytest.mark.parametrize("rare", [1, 5, 64])
@pytest.mark.parametrize("split", [0, 70])
def test_jaccard_links_of_rare_and_common_members(monkeypatch, rare, split):
    """Members of few and of many sets make the same links, within a chunk and between two."""
    monkeypatch.setattr(jaccard_join, "RARE", rare)
    rng = np.random.default_rng(7)
    sets = []
    for i in range(160):
        own = rng.integers(100, 4000, 3) if i % 3 else rng.integers(100, 130, 3)
        sets.append(np.unique(np.concatenate([rng.choice(24, 20, replace=False), own])).astype(np.uint64))
    want = {(i, j) for i in range(160) for j in range(i + 1, 160) if 100 * len(both := set(sets[i]) & set(sets[j])) >= 60 * len({*sets[i], *sets[j]}) and both}
    want = {(i, j) for i, j in want if not split or i < split <= j}
    got = [*zip(*(x.tolist() for x in jaccard_join._links(sets, 60, split)), strict=True)]
    assert want and len(got) == len(want) and set(got) == want


def test_jaccard_moves_each_text_once(spark, monkeypatch):
    """One large cell of near copies: only its texts move, each once, whatever the number of its chunks."""
    monkeypatch.setattr(jaccard_join, "CHUNK", 5)
    moved = []

    def seen(df, root, *keys, keep=jaccard_join.kept_groups):
        out = keep(df, root, *keys)
        moved.append(sum(common.read_group(*common.files(root), r["file"], r["at"], r["size"]).num_rows for r in out.collect()))
        return out

    monkeypatch.setattr(jaccard_join, "kept_groups", seen)
    words = [f"w{i}" for i in range(90)]
    rows = [(i, " ".join([*words[:i], f"x{i}", *words[i + 1 :]])) for i in range(60)] + [(100 + i, f"a{i} b{i} c{i} d{i}") for i in range(40)] + [(200 + i, " ".join(words)) for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = {r["doc_id"]: r["component_id"] for r in jaccard_groups(df, k=2, percent=80).collect()}
    assert got == {i: 0 if i < 60 or i >= 200 else i for i, _ in rows}
    assert moved == [61]  # equal sets go once
    assert not [x for x in keep_one_per_group(df)._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange" in x]


@pytest.mark.parametrize("missing", [False, True])
def test_join_rows(spark, missing):
    """Rows of a written table, several partitions of them without keys, meet their keys in place."""
    df = spark.range(400).repartition(6, "id").select(F.monotonically_increasing_id().alias("row"), F.col("id").alias("name"), F.array(F.lit(1.5), F.lit(None)).alias("odd"))
    table = common.written(df)
    held = table.where("name % 3 = 0 and row > (2L << 33)").select("row", (F.col("name") * 2).alias("twice"), F.lit("x").alias("y"))
    got = common.join_rows(table, held, "row", missing=missing)
    want = table.join(held, "row", "left_anti" if missing else "inner")
    assert got.dtypes == want.dtypes and Counter(map(str, got.collect())) == Counter(map(str, want.collect())) and want.count()
    assert common.join_rows(table, held.limit(0), "row", missing=missing).count() == (400 if missing else 0)


def test_drop_copies_keeps_one_row_of_each_text(hot):
    rows = hot_rows()
    best = {}
    for r in rows:
        t = (r[1] or "").translate(LOWER)
        best[t] = min(best.get(t, r), r, key=key)
    got = drop_copies(hot.withColumn("extra", F.create_map(F.lit("a"), F.lit(1)))).drop("extra").collect()
    assert Counter(((r[1] or "").translate(LOWER), r[0]) for r in got) == Counter((t, r[0]) for t, r in best.items())
    assert {tuple(r) for r in drop_copies(hot).collect()} <= set(rows) and drop_copies(hot).count() == len(best)


def test_mix_counts_rows(hot):
    rows = hot_rows()
    out = mix(hot).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(r[0] for r in rows)
    words = Counter(len(r[1].split()) if r[1] else 0 for r in rows)
    assert Counter(r["size"] for r in out) == words and all(r["taken"] <= 3 * r["size"] for r in out)
    again = mix(hot.repartition(7)).select("doc_id", "source", "size", "start", "taken").collect()
    assert Counter(again) == Counter(mix(hot).select("doc_id", "source", "size", "start", "taken").collect())
    taken, target = defaultdict(int), {}
    for r in out:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    for s, t in target.items():
        assert abs(taken[s] - t) <= 0.02 * t + 60
    assert set(mixed_documents(hot).columns) == set(hot.columns)


def test_pack_holds_every_row(hot):
    rows = hot_rows()
    got = packing.pack(hot).collect()
    whole = Counter()
    for r in got:
        whole[r["doc_id"], r["doc_tokens"]] += r["length"]
    assert sum(whole.values()) == sum(n * c for (_, n), c in Counter({k: v // k[1] for k, v in whole.items()}).items())
    assert sum(v // n for (_, n), v in whole.items()) == len(rows)


def test_rate_with_a_clashing_text_column(spark, hot):
    """The text column may have any name, also where another column is called ``text``."""
    ratings = spark.createDataFrame([(1000 + 3 * i, i % 2) for i in range(60)], "doc_id long, quality int")
    renamed = hot.withColumnRenamed("text", "body").withColumn("text", F.lit(7))
    a, b = (sorted((str(r["doc_id"]), round(r["tail_probability"], 9)) for r in x.collect()) for x in (rate(hot, ratings), rate(renamed, ratings, text_col="body")))
    assert a == b and keep_good(renamed, ratings, text_col="body").columns == renamed.columns


def test_remove_repeats_by_row(hot, monkeypatch):
    """Rows of one id do not remove one another, nor do rows without an id, which come after all others."""
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", 2000)
    rows = [(r[0], (r[1] or "").encode()) for r in hot_rows()]
    first = {}
    for i, t in rows:
        for p in range(len(t) - 49):
            first[t[p : p + 50]] = min(first.get(t[p : p + 50], 1 << 62), 1 << 62 if i is None else i)
    want = Counter()
    for i, t in rows:
        gone = bytearray(len(t))
        for p in range(len(t) - 49):
            if first[t[p : p + 50]] < ((1 << 62) if i is None else i):
                gone[p : p + 50] = b"x" * 50
        want[i, len(t), sum(map(bool, gone)), bytes(c for c, g in zip(t, gone) if not g)] += 1
    got = suffix_dedup.remove_repeats(hot).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], bytes(r["kept"])) for r in got) == want


def test_vectors_by_row(spark, monkeypatch):
    """Vectors of a repeated id link like others; those without an id link with nothing."""
    monkeypatch.setattr(vector_dedup, "BLOCK", 16)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(12, 6))
    rows = [(100 + i if i % 3 == 0 else 7 if i % 3 == 1 else None, (base[i % 12] + 0.01 * rng.normal(size=6)).tolist()) for i in range(150)]
    unit = [np.array(v) / np.linalg.norm(v) for _, v in rows]
    linked = [[j for j in range(len(rows)) if j != i and rows[i][0] is not None and rows[j][0] is not None and unit[i] @ unit[j] >= 0.9] for i in range(len(rows))]
    root = list(range(len(rows)))
    for _ in range(len(rows)):
        root = [min([root[i], *(root[j] for j in linked[i])]) for i in range(len(rows))]
    least = {}
    for i, r in enumerate(root):
        if rows[i][0] is not None:
            least[r] = min(least.get(r, 1 << 62), rows[i][0])
    want = Counter((rows[i][0], len(linked[i]), None if rows[i][0] is None else least[root[i]]) for i in range(len(rows)))
    got = vector_dedup.vector_groups(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)).collect()
    assert Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == want
    assert all(r["kept"] == (r["vec_id"] is not None and r["vec_id"] == r["component_id"]) for r in got)


def test_vector_blocks_are_written_once(spark, monkeypatch):
    """Many blocks that all meet: their rows lie in files once, no shuffle carries them from pair to pair, and the links are those of all pairs."""
    monkeypatch.setattr(vector_dedup, "BLOCK", 10)
    rng = np.random.default_rng(11)
    x = rng.normal(size=(300, 16)).astype(np.float32)
    x[200:] = x[:100] + 0.05 * rng.normal(size=(100, 16)).astype(np.float32)
    x[100:130] = x[100]
    kept, plans = [], []

    def seen(df, root, *keys, made, keep=vector_dedup.kept_groups):
        out = keep(df, root, *keys, made=made)
        kept.append([common.read_group(*common.files(root), r["file"], r["at"], r["size"]).num_rows for r in out.collect()])
        return out

    def wrote(df, write=vector_dedup.written):
        plans.append(df._jdf.queryExecution().toString())
        return write(df)

    monkeypatch.setattr(vector_dedup, "kept_groups", seen)
    monkeypatch.setattr(vector_dedup, "written", wrote)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(4)
    got = {r["vec_id"]: r for r in vector_dedup.vector_groups(df).collect()}
    assert len(kept) == 1 and sum(kept[0]) == 300 and len(kept[0]) > 20
    assert not any("cogroup" in p.lower() for p in plans)
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    want = roots(range(300), zip(*(e.tolist() for e in np.nonzero(linked)), strict=True))
    assert {i: (r["n_links"], r["component_id"]) for i, r in got.items()} == {i: (int(linked[i].sum()), want[i]) for i in range(300)}
