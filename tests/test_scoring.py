"""Scoring against the brute-force scorer, and chunked plans against bounded plans."""
from __future__ import annotations

import hashlib

import numpy as np
import pytest

from brute import score as brute_score
from helpers import close
from rareseries.operators.hashing import content_hashes
from rareseries.operators.scan import score_panel
from rareseries.params import EMPTY_HASH, ScoreParams
from rareseries.plans.quantiles import exact_quantiles
from rareseries.plans.sequence import compact, number_rows
from rareseries.schemas import HEADER, PANEL

rng = np.random.default_rng(7)
NAN = float("nan")

CASES = {
    "trend": [float(i) for i in range(3, 53)],
    "const": [5.0] * 30,
    "spike_hi": [10.0 + (i % 7) * 0.5 for i in range(40)] + [100.0, 120.0],
    "spike_lo": [10.0 + (i % 7) * 0.5 for i in range(40)] + [-90.0],
    "ties": [1.0] * 20 + [2.0] * 20 + [50.0],
    "all_null": [None] * 15,
    "empty": [],
    "n11": [float(i * i) for i in range(11)],
    "n12": [float(i * i) for i in range(12)],
    "gaps": [None if i % 4 == 1 else float((i * 37) % 23) for i in range(60)],
    "nan_gaps": [NAN if i % 5 == 0 else float((i * 13) % 17) for i in range(45)],
    "extreme": [0.5] * 10 + list(np.linspace(0.0, 1.0, 498)) + [1.4, 100.0],
    "mid_gap": [0.0] * 10 + [-1.0] * 10 + [1.0] * 10 + [-100.0, 100.0],
    "noise": list(rng.normal(50, 10, 80)) + [160.0, -70.0],
}


def make_panel(spark, series: dict):
    rows = [(sid, "test", "c", sid, None, None, "float64", i, None, None if v is None else float(v))
            for sid, vals in series.items() for i, v in enumerate(vals)]
    header = spark.createDataFrame([(sid, "test", "c", sid, None, None, "float64", n)
                                    for n, sid in enumerate(series)], HEADER)
    return header, spark.createDataFrame(rows, PANEL)


@pytest.fixture(scope="module")
def scanned(spark):
    h, p = make_panel(spark, CASES)
    return {r["id"]: r.asDict() for r in score_panel(h, p).collect()}


@pytest.mark.parametrize("sid", list(CASES))
def test_scan_row_matches_brute_force(scanned, sid):
    got, want = scanned[sid], brute_score(CASES[sid])
    assert got["status"] == want["status"]
    assert got["length"] == want["length"]
    assert got["content_hash"] == want["content_hash"]
    assert close(got["missing_pct"], want["missing_pct"])
    if want["status"] != "ok":
        assert got["N"] is None and got["mean"] is None
        assert got["note"].startswith("only ") and got["note"].endswith("need >= 12 to embed")
        return
    for c in ("N", "n_rare", "n_normal", "IR", "pct_rare", "imbalance_level", "mean", "std", "cv"):
        assert close(got[c], want[c]), (c, got[c], want[c])
    for c in ("skewness", "kurtosis", "autocorr_lag1"):
        assert close(got[c], want[c], 1e-7), (c, got[c], want[c])


def test_hand_checked_cases(scanned):
    assert scanned["const"]["imbalance_level"] == "none" and scanned["const"]["IR"] == float("inf")
    assert scanned["const"]["skewness"] == 0.0 and scanned["const"]["kurtosis"] == 0.0
    assert scanned["const"]["autocorr_lag1"] is None
    assert scanned["extreme"]["imbalance_level"] == "extreme" and scanned["extreme"]["n_rare"] == 2
    assert scanned["spike_hi"]["n_rare"] >= 2 and scanned["spike_lo"]["n_rare"] >= 1
    assert scanned["trend"]["n_rare"] == 0
    # Interpolated median inside an empty gap: every value is rare.
    assert scanned["mid_gap"]["pct_rare"] == 100.0 and scanned["mid_gap"]["IR"] == 0.0
    assert scanned["empty"]["content_hash"] == EMPTY_HASH and scanned["empty"]["missing_pct"] is None
    assert scanned["all_null"]["missing_pct"] == 100.0
    assert scanned["n11"]["status"] == "skipped_short" and scanned["n12"]["status"] == "ok"
    assert scanned["n11"]["note"] == "only 11 non-null values, need >= 12 to embed"


def test_infinite_value_is_an_error_row(spark):
    h, p = make_panel(spark, {"inf": [1.0] * 20 + [float("inf")]})
    row = score_panel(h, p).collect()[0]
    assert row["status"] == "error" and row["N"] is None and row["mean"] is None


def test_chunked_plans_equal_bounded_plans(spark):
    h, p = make_panel(spark, CASES)
    a = {r["id"]: r.asDict() for r in score_panel(h, p).collect()}
    b = {r["id"]: r.asDict() for r in score_panel(h, p, ScoreParams(chunk_rows=7)).collect()}
    assert a.keys() == b.keys()
    for sid in a:
        for c, v in a[sid].items():
            assert close(v, b[sid][c], 1e-9), (sid, c, v, b[sid][c])


def test_other_extreme_sides(spark):
    h, p = make_panel(spark, {"s": CASES["spike_hi"] + CASES["spike_lo"]})
    for side in ("high", "low"):
        got = score_panel(h, p, ScoreParams(rel_xtrm_type=side)).collect()[0]
        want = brute_score(CASES["spike_hi"] + CASES["spike_lo"], xtrm=side)
        assert got["n_rare"] == want["n_rare"], side


def test_exact_quantiles_from_sketches_match_numpy(spark, monkeypatch):
    """Brackets of a poor sketch without a margin miss ranks; the counting pass finds that out."""
    from rareseries.plans import quantiles
    vals = {"a": list(rng.normal(0, 1, 300)), "b": [1.0] * 50 + [2.0] * 3 + list(rng.exponential(5, 200)),
            "c": [3.0] * 40, "d": list(np.round(rng.normal(0, 1, 97), 1)), "wide": [float(f"{m}e{e}") for e in range(-300, 301, 4) for m in (-1.5, 1, 7)],
            "burst": [5.0] * 400 + list(rng.normal(5, 1e-9, 60))}
    df = spark.createDataFrame([(k, float(v)) for k, vs in vals.items() for v in vs], "id string, y double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    names = [f"p{i}" for i in range(len(probs))]
    for chunk, sketch, margin in ((10_000, 4096, 0.002), (20, 4096, 0.002), (20, 8, 0.0), (5, 16, 0.01)):
        monkeypatch.setattr(quantiles, "SKETCH_K", sketch)
        monkeypatch.setattr(quantiles, "MARGIN", margin)
        got = {r["id"]: r for r in exact_quantiles(df, probs, names, chunk_rows=chunk).collect()}
        for k, vs in vals.items():
            want = np.percentile(vs, [p * 100 for p in probs])
            for n, w in zip(names, want):
                assert close(got[k][n], float(w), 1e-12), (k, n, chunk, got[k][n], w)


def test_number_rows_chunked_equals_row_number(spark):
    rows = [(k, float(t), i) for k in ("x", "y", "z") for i, t in enumerate(rng.permutation(200) if k != "z"
                                                                            else range(5))]
    df = spark.createDataFrame(rows, "k string, t double, i long")
    want = {(r["k"], r["t"]): r["p"] for r in df.selectExpr(
        "k", "t", "row_number() over (partition by k order by t) - 1 as p").collect()}
    for chunk in (10_000, 16, 3):
        got = {(r["k"], r["t"]): r["pos"] for r in number_rows(df, ["k"], ["t"], "pos", chunk).collect()}
        assert got == want, chunk


def test_sorted_ranges_are_balanced(spark, monkeypatch):
    """One timestamp in half of all rows, most of them of one key: no range is above twice the mean, whatever repeats."""
    from rareseries.plans import sequence
    seen = []
    monkeypatch.setattr(sequence, "written", lambda df: seen.append(df) or df.checkpoint())
    rows = spark.range(40_000).selectExpr("if(id % 10 < 8, 'hot', concat('k', id % 400)) as k", "if(id % 2 = 0, 0L, id % 97) as t", "hash(id) as u", "id")
    got = number_rows(rows, ["k"], ["t", "u", "id"], "pos", 1000)
    want = rows.selectExpr("id", "row_number() over (partition by k order by t, u, id) - 1 as pos")
    assert got.select("id", "pos").exceptAll(want).count() == 0 and got.count() == 40_000
    sizes = [r["count"] for r in seen[0].groupBy((seen[0]["_at"] / 2**33).cast("long")).count().collect()]
    assert len(sizes) >= 60 and max(sizes) <= 2 * sum(sizes) / len(sizes)


def test_halo_chunks_move_k_points_twice(spark):
    from rareseries.operators.relevance import _embedding_halo
    clean = spark.range(1000).selectExpr("'s' as id", "id as cpos", "cast(id as double) as value")
    got = _embedding_halo(clean, 10, "id", 100).orderBy("t").collect()
    assert [(r["t"], r["lag_10"], r["lag_1"], r["target"]) for r in got] == [(t, t - 10.0, t - 1.0, float(t)) for t in range(10, 1000)]


def test_compact_positions_and_previous_value(spark):
    vals = CASES["gaps"]
    _, p = make_panel(spark, {"g": vals})
    for chunk in (1000, 4):
        got = sorted(compact(p.select("id", "pos", "value"), chunk).select("pos", "cpos", "prev").collect())
        clean_prev, c = None, 0
        for r, v in zip(got, vals):
            if v is None:
                assert r["cpos"] is None and r["prev"] is None
            else:
                assert r["cpos"] == c and r["prev"] == clean_prev
                clean_prev, c = v, c + 1


def test_content_hash_matches_hashlib(spark):
    series = {"a": [1.0, 2.0, 3.0], "b": [1.0, None, 3.0], "c": [float(i) / 7 for i in range(25_000)]}
    _, p = make_panel(spark, series)
    got = {r["id"]: r["content_hash"] for r in content_hashes(p).collect()}
    for k, vs in series.items():
        arr = np.asarray([v for v in vs if v is not None], dtype="<f8")
        assert got[k] == hashlib.sha256(arr.tobytes()).hexdigest()[:16]


def test_scan_plan_uses_one_exchange_for_bounded_series(spark):
    from rareseries.operators.scan import stats_bounded
    _, p = make_panel(spark, {"t": CASES["trend"]})
    plan = stats_bounded(p.select("id", "pos", "value"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_embedding_forms_agree(spark):
    from rareseries.operators.relevance import embedding
    _, p = make_panel(spark, {"g": CASES["gaps"], "n": CASES["noise"], "s": CASES["n11"]})
    comp = compact(p.select("id", "pos", "value"))
    a = sorted(map(tuple, embedding(comp, 3).collect()))
    b = sorted(map(tuple, embedding(comp, 3, chunk_rows=5).collect()))
    assert a == b and len(a) == (45 - 3) + (82 - 3) + (11 - 3)
    first = [r for r in a if r[0] == "n" and r[1] == 3][0]
    assert list(first[2:]) == CASES["noise"][:4]


def test_number_rows_with_bursts_ties_and_nulls(spark):
    ts = [0.0] * 60 + [float(i) for i in range(40)] + [None] * 7 + [1e6]
    rows = [("k", t, i) for i, t in enumerate(ts)] + [("small", 1.0, 0)]
    df = spark.createDataFrame(rows, "k string, t double, i long")
    want = {(r["k"], r["i"]): r["p"] for r in df.selectExpr(
        "k", "i", "row_number() over (partition by k order by t asc nulls last, i) - 1 as p").collect()}
    for chunk in (10_000, 9, 2):
        got = {(r["k"], r["i"]): r["pos"] for r in number_rows(df, ["k"], ["t", "i"], "pos", chunk).collect()}
        assert got == want, chunk
