import math
import random

import numpy as np
import pytest

from strandloom.llm import knn


def brute(rows, queries, k=10):
    """Every row but the query's own is a candidate; rows of unlike length never meet."""
    ints = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (i, v) in enumerate(ints):
        if queries(i):
            scored = sorted((-sum(a * b for a, b in zip(v, w)), j) for other, (j, w) in enumerate(ints) if other != at and len(w) == len(v))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize(("n", "pivots", "chunk"), [(300, 64, 4096), (300, 5, 16), (7, 64, 16)])
def test_against_brute_force(spark, monkeypatch, n, pivots, chunk):
    monkeypatch.setattr(knn, "PIVOTS", pivots)
    monkeypatch.setattr(knn, "CHUNK", chunk)
    monkeypatch.setattr(knn, "BLOCK", 4)
    rng = random.Random(n)
    centre = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(4)]
    rows = [(i, [c + rng.gauss(0, 0.2) for c in rng.choice(centre)]) for i in range(n)]
    rows += [(1000 + i, rows[0][1]) for i in range(n // 3)]
    rows += [(2000, None), (2001, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2002, [float("nan")] * 6), (2003, []), (None, [1.0] * 6), (2004, [float("inf")] * 6), (2010, [1.0] * 5), (2020, [2.0] * 5), (2030, []), (10, rows[3][1]), (10, rows[4][1]), (20, rows[5][1]), (20, rows[5][1])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, cell int").repartition(3)
    got = sorted(tuple(r) for r in knn.top_k(df, df.filter("vec_id % 10 = 0")).collect())
    assert got == brute(rows, lambda i: i % 10 == 0)


def test_repeated_ids_are_candidates_of_their_own(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (1, [0.5, 1.0])], "vec_id long, embedding array<double>")
    assert [tuple(r)[1:] for r in knn.top_k(df, df.filter("vec_id = 0")).orderBy("rank").collect()] == [(1, 1, 1024 * 1024), (2, 1, 512 * 1024)]


def test_large_components(spark):
    rows = [(i, [float((i - 3) * 10**9), 1.0]) for i in range(6)] + [(9, [1e300, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in knn.top_k(df, df, k=2, scale=1).collect())
    ints = [(i, [int(x) for x in v]) for i, v in rows[:-1]]
    want = []
    for i, v in ints:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in ints if j != i)[:2]
        want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored)]
    assert got == sorted(want)


def test_bounds_hold_and_prune_clusters():
    rng = np.random.default_rng(3)
    centre = rng.normal(0, 1000, (50, 16))
    v = np.floor(centre[rng.integers(0, 50, 4000)] + rng.normal(0, 30, (4000, 16)))
    pivots = v[:64]
    cell = np.argmin((pivots**2).sum(1) / 2 - v @ pivots.T, 1)
    radius = np.array([np.sqrt(((v[cell == c] - pivots[c]) ** 2).sum(1)).max(initial=0) for c in range(64)])
    most = np.array([np.sqrt((v[cell == c] ** 2).sum(1)).max(initial=0) for c in range(64)])
    q = v[::40]
    upper = knn.upper_bounds(q, pivots, radius, most)
    scores = q @ v.T
    assert all((scores[:, cell == c].max(1, initial=-np.inf) <= upper[:, c]).all() for c in range(64))
    kth = np.sort(scores, 1)[:, -11]
    assert (upper >= kth[:, None]).mean() < 0.2


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert knn.top_k(df, df).collect() == []
