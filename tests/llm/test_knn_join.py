"""The Voronoi join against all inner products; the query against SQL is in test_queries."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark.llm import knn_join as kj


def brute(rows, k):
    usable = [
        (i, [math.floor(256.0 * x) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, a in {(i, tuple(v)) for i, v in usable if i % 50 == 0}:
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in usable if i != q)
        out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def corpus(seed):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(6, 12)) * 3
    rows = [(i, (centres[r.integers(6)] + r.normal(size=12) * 0.2).astype(np.float32).tolist()) for i in range(900)]
    rows += [(i, rows[7][1]) for i in range(900, 1300)]  # one very common vector
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(spark, small, monkeypatch):
    if small:  # many query blocks, many tasks
        monkeypatch.setattr(kj, "QUERY_BLOCK", 3)
        monkeypatch.setattr(kj, "TASK_ROWS", 200)
    rows = corpus(1)
    rows += [(1350, None), (1400, [1.0, None]), (1450, [float("nan")]), (1451, [float("inf")] * 12), (None, [1.0] * 12)]
    rows += [(1500, []), (1550, [5.0, -2.5]), (1550, [5.0, -2.5]), (1600, [2.0**20] * 12), (1601, [-(2.0**30)] * 12)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, v int").repartition(3)
    got = kj.top_k(docs, F.col("vec_id") % 50 == 0, max_pivots=5).collect()
    assert sorted(map(tuple, got)) == brute(rows, 5)


def test_groups_prune(spark):
    rows = [(i, v) for i, v in corpus(2)[:900]]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, kj.top_k(docs, F.col("vec_id") % 50 == 0, k=3).collect())) == brute(rows, 3)


def test_a_query_in_several_rows(spark):
    rows = [(i, [float(i)]) for i in range(1, 50)] + [(0, [1000.0])] * 3
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, kj.top_k(docs, F.col("vec_id") % 50 == 0).collect()))
    assert got == brute(rows, 5) and len(got) == 5


@pytest.mark.parametrize("block", [4, 1024])
def test_several_cells_with_repeated_ids(spark, block, monkeypatch):
    monkeypatch.setattr(kj, "QUERY_BLOCK", block)
    monkeypatch.setattr(kj, "TASK_ROWS", 500)
    r = np.random.default_rng(3)
    centres = r.normal(size=(8, 12)) * 20
    made = [(i, (centres[i // 50 % 8] + r.normal(size=12) * 0.01).tolist()) for i in range(0, 2000, 5)]
    rows = made + [(i, v) for i, v in made if i % 50 == 0 for _ in range(i // 50 % 4)]  # queries up to four times
    rows += [(i, (np.array(v) * 1.001).tolist()) for i, v in made if i % 100 == 0]  # and with a second vector
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    assert sorted(map(tuple, kj.top_k(docs, F.col("vec_id") % 50 == 0).collect())) == brute(rows, 5)


def test_pivots_grow_without_a_switch():
    assert [kj.pivot_count(n, 64) for n in (0, 1, 2, 10, 40, 511, 512, 10**6)] == [1, 1, 2, 4, 7, 23, 23, 64]


def test_bounds_hold():
    r = np.random.default_rng(4)
    pivots, rows = r.integers(-900, 900, (3, 5)), r.integers(-900, 900, (200, 5))
    at, distance = kj.nearest(rows, pivots)
    radius = np.array([distance[at == c].max() for c in range(3)])
    bounds, score = kj.Bounds(pivots, radius), kj.scores(rows, rows)
    low, high = bounds.of_rows(rows, np.arange(3))
    groups = bounds.of_groups(radius, np.array([np.linalg.norm(rows[at == c], axis=1).max() for c in range(3)]))
    assert (low[:, at].T <= score).all() and (score <= high[:, at].T).all() and (score <= groups[at][:, at]).all()
    assert [a.tolist() for a in kj.best_per_id(np.array([7, 7, 8, 9]), np.array([5.0, 6.0, 1.0, 2.0]), 2)] == [[7, 9], [6.0, 2.0]]


def test_few_and_no_rows(spark):
    docs = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<double>")
    query = F.col("vec_id") % 50 == 0
    assert [tuple(r) for r in kj.top_k(docs, query).collect()] == [(0, 1, 1, 256 * 512)]
    assert kj.top_k(docs.limit(0), query).count() == 0
    assert kj.top_k(docs.filter("vec_id = 1"), query).count() == 0


def test_ties_go_to_smaller_ids():
    score = np.array([[5, 5, 9, 5, 1]])
    row, ids, s = kj.best_of(score, np.array([40, 30, 20, 10, 0]), np.array([10]), 3)
    assert sorted(zip(ids.tolist(), s.tolist())) == [(20, 9), (30, 5), (40, 5)]
