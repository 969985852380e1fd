import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandloom.llm import centroids


def brute(rows, k, rounds, dims, scale, seed=1):
    kept = [(i, tuple(math.floor(scale * float(x)) for x in v)) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) and abs(x) < (1 << 27) / scale for x in v)]
    hashed = lambda i: (1, "") if i is None else (0, hashlib.sha256(f"{seed}:{i}".encode()).hexdigest())
    at = [q for _, q in sorted(kept, key=lambda r: (hashed(r[0]), r[1]))[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def assign():
        return [min((far(q, c), n) for n, c in enumerate(at)) for _, q in kept]

    for _ in range(rounds):
        found = assign()
        for n in range(len(at)):
            mine = [q for (_, q), (_, c) in zip(kept, found) if c == n]
            if mine:
                at[n] = tuple(sum(x) // len(mine) for x in zip(*mine))
    found = assign()
    inertia = [sum(d for d, c in found if c == n) for n in range(len(at))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at]
    return sorted(((i, c, d, inertia[c], sum(inertia), digest[c]) for (i, _), (d, c) in zip(kept, found)), key=str)


def run(df, **how):
    return sorted((tuple(r) for r in centroids.lloyd(df, **how).collect()), key=str)


SCHEMA = "vec_id long, embedding array<float>"


def test_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in np.float32(rng.normal(0, 1, 4) + rng.integers(0, 3) * 4)]) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(200)] + [(2000 + i, rows[i % 20][1]) for i in range(100)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert run(df, k=5, rounds=3, dims=4, scale=64) == brute(rows, 5, 3, 4, 64)
    assert run(df.repartition(3), k=5, rounds=1, dims=4, scale=2) == brute(rows, 5, 1, 4, 2)


def test_empty_clusters_stay_and_ties_go_down(spark):
    rows = [(i, [float(v), 0.0]) for i, v in enumerate([0, 0, 0, 0, 10, 10, 5, 5, -1])]
    got = run(spark.createDataFrame(rows, SCHEMA), k=6, rounds=3, dims=2, scale=1)
    assert got == brute(rows, 6, 3, 2, 1)
    assert len({r[1] for r in got}) < 6


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (1, [3.0, 2.0]), (None, [1.0, 2.0]), (None, [9.0, 9.0]), (2, None), (3, []), (4, [1.0]), (5, [1.0, None]), (6, [nan, 1.0]), (7, [inf, 0.0]), (8, [-inf, 0.0]), (9, [1.0, 2.0, 3.0]), (10, [3e30, 0.0]), (11, [2.0e6, -2.0e6])]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("q", "n", "h", "cluster", "distance", "inertia", "total"):
        df = df.withColumn(c, F.lit("z"))
    for k in (1, 3, 50):
        assert run(df, k=k, rounds=2, dims=2, scale=64) == brute(rows, k, 2, 2, 64)
    assert run(df.limit(0), k=3, dims=2) == []
    assert run(df.filter("vec_id = 2"), k=3, dims=2) == []


def test_parameters(spark):
    with pytest.raises(ValueError):
        centroids.lloyd(spark.createDataFrame([], SCHEMA), dims=65)


def test_sums_are_exact_beyond_a_long(spark):
    points = spark.createDataFrame([([134217727, -134217727], (1 << 40) + 3), ([134217726, -134217726], 1 << 40)], "q array<int>, n long")
    n = (1 << 41) + 3
    want = [(134217727 * ((1 << 40) + 3) + 134217726 * (1 << 40)) // n, -(134217727 * ((1 << 40) + 3) + 134217726 * (1 << 40)) // n]
    assert centroids.moved(points, [[0, 0]], 2) == [want]
