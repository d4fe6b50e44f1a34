"""Exact top-k search against plain integer products."""

import math

import numpy as np
from pyspark.sql import functions as F

from civgraph.llm import topk

SCHEMA = "vec_id long, embedding array<double>, label int, score double, rank int, piece string, dim string, query_id string"


def brute(rows, every=50, k=5):
    usable = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable.setdefault(i, []).append([math.floor(256 * x) for x in v])
    out = set()
    for i, own in usable.items():
        if i % every:
            continue
        # the shortest vector asks; the smallest by the bytes of its doubles
        q = min(own, key=lambda v: (len(v), np.array(v, "<f8").tobytes()))
        best = {}
        for j, vectors in usable.items():
            for v in vectors:
                if j != i and len(v) == len(q):
                    s = max(-topk.TOP, min(topk.TOP, sum(a * b for a, b in zip(q, v))))
                    best[j] = max(best.get(j, s), s)
        ranked = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
        out |= {(i, n, j, s) for n, (j, s) in enumerate(ranked, 1)}
    return out


def got(spark, rows, parts=3, **more):
    frame = spark.createDataFrame([(i, v, 1, 0.5, 2, "p", "d", "q") for i, v in rows], SCHEMA).repartition(parts)
    found = [tuple(r) for r in topk.top(frame, 50, **more).collect()]
    assert len(found) == len(set(found))
    return set(found)


def vectors(n, dims, seed=1):
    r = np.random.default_rng(seed)
    v = r.standard_normal((n, dims))
    return (v / np.linalg.norm(v, axis=1, keepdims=True)).tolist()


def test_equals_brute_force_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 90)
    monkeypatch.setattr(topk, "GROUP", 2)
    rows = list(enumerate(vectors(600, 16)))
    assert got(spark, rows) == brute(rows)
    assert got(spark, rows[::-1], 7, k=8) == brute(rows, k=8)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 40)
    base = vectors(150, 6, 2)
    rows = list(enumerate(base))
    rows += [(None, base[0]), (200, None), (250, [0.1, None] * 3), (300, [float("nan")] * 6), (350, [float("inf")] * 6),
             (400, []), (401, []), (402, []), (450, [0.0] * 6), (500, [0.5, 0.25]), (501, [-0.5, 1.0]), (550, [1.0] * 3)]
    rows += [(i, base[3]) for i in range(1000, 1200)] + [(50, base[50])] * 30 + [(50, base[7]), (60, base[9]), (60, base[9])]
    want = brute(rows)
    assert got(spark, rows) == want
    assert {len([r for r in want if r[0] == q]) for q in (400, 500, 550)} == {2, 1, 0}


def test_equal_vectors_go_by_id(spark):
    rows = [(i, [0.5, -0.25, 0.125]) for i in range(400)] + [(i, [-1.0, 0.0, 2.0]) for i in range(400, 500)]
    assert got(spark, rows) == brute(rows)


def test_large_components(spark):
    rows = [(i, [1e6 * (i % 7) + 0.3, -1e9 * (i % 3), 2.0 ** 40 + i]) for i in range(120)]
    rows += [(i, [1e300 * (-1) ** i, 3.0, 1e18]) for i in range(120, 160)]
    assert got(spark, rows) == brute([(i, [min(max(x, -topk.HUGE), topk.HUGE) for x in v]) for i, v in rows])


def test_few_and_no_rows(spark):
    assert got(spark, []) == set()
    assert got(spark, [(50, [1.0, 2.0])]) == set()
    assert got(spark, [(1, [1.0]), (2, [2.0])]) == set()
    assert got(spark, [(50, [1.0]), (2, [2.0])]) == {(50, 1, 2, 256 * 512)}


def test_bounds_hold_and_close(monkeypatch):
    rows = topk.whole(np.array(vectors(500, 12)))
    block = topk.Block(np.arange(500), rows)
    for w in rows[:20]:
        exact, before = rows @ w, None
        for bound, share in block.bounds(w):
            assert (bound >= exact).all()
            assert before is None or (bound <= before + 1e-6).all()
            before = bound


def test_most_vectors_of_a_cluster_are_never_scored(monkeypatch):
    r = np.random.default_rng(3)
    centres = r.standard_normal((40, 32))
    v = centres[r.integers(0, 40, 4000)] + 0.1 * r.standard_normal((4000, 32))
    block = topk.Block(np.arange(4000), topk.whole(v / np.linalg.norm(v, axis=1, keepdims=True)))
    scored = []
    plain = topk.exact_scores
    monkeypatch.setattr(topk, "exact_scores", lambda rows, w: scored.append(len(rows)) or plain(rows, w))
    for i in range(50):
        best = block.search(i, block.rows[i], 5, [])
        s = (block.rows @ block.rows[i]).astype(int)
        s[i] = -10**9
        assert best == sorted(zip((-s).tolist(), range(4000)))[:5]
    assert sum(scored) < 0.1 * 50 * 4000


def test_schema(spark):
    found = topk.top(spark.createDataFrame([], SCHEMA), 50)
    assert found.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    assert topk.top(spark.range(3).select(F.col("id").alias("vec_id"), F.array(F.lit(1.5)).alias("embedding")), 2).count() == 4
