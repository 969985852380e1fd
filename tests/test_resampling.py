import numpy as np
import pytest
from pyspark.sql import functions as F

from strandloom.operators import evaluation, resampling, stats


def number(seed, d, s):
    p = 2147483647
    x = (seed + d * 1000003 + s * 7919) % p
    x = (x * x + 1013904223) % p
    x = ((x + d + 1) * (x + s + 1)) % p
    return (x * x + 12345) % p // 16


def test_draws_are_the_same_everywhere_and_multinomial(spark):
    rows = spark.range(2000).select(F.col("id").alias("d"), (F.col("id") % 97).alias("s"))
    got = rows.select("d", "s", resampling.drawn_column(20260817, F.col("d"), F.col("s")).alias("x")).collect()
    assert all(r.x == number(20260817, r.d, r.s) for r in got)
    assert resampling.drawn(5, np.arange(9), np.int64(3)).tolist() == [number(5, d, 3) for d in range(9)]
    for c in (3, 10, 200):
        index = resampling.drawn(1, np.arange(4000)[:, None], np.arange(c)[None]) % c
        counts = np.array([np.bincount(r, minlength=c) for r in index])
        assert abs(counts.var() / (1 - 1 / c) - 1) < 0.06 and np.abs(counts.mean(0) - 1).max() < 0.15


def plain_blocks(locus, backbone, resamples, block, seed, alpha=0.05):
    def medians(values, seed_):
        n = -(-len(values) // block)
        for d in range(resamples):
            drawn = [v for s in range(n) for i in [number(seed_, d, s) % n] for v in values[i * block : (i + 1) * block]]
            yield float(np.median(drawn))

    if not locus or not backbone:
        return 0.0, 0.0
    found = sorted(a / b for a, b in zip(medians(locus, seed), medians(backbone, seed + 1)) if b > 0)
    n = len(found)
    return (found[max(0, int(n * alpha / 2) - 1)], found[min(n - 1, int(n * (1 - alpha / 2)))]) if found else (0.0, 0.0)


def test_block_interval_equals_plain_draws(spark):
    rng = np.random.default_rng(3)
    rows = [("a", [float(x) for x in rng.poisson(60, 130)], [float(x) for x in rng.poisson(30, 410)]), ("b", [1.0, 5.0, 2.0], [0.0] * 20), ("c", [], [1.0]), ("d", None, None), (None, [4.0] * 7, [2.0] * 9)]
    df = spark.createDataFrame(rows, "k string, x array<double>, y array<double>")
    got = {r.k: (r.ci_low, r.ci_high) for r in resampling.block_interval(df, ["k"], "x", "y", resamples=450, block=20).collect()}
    for k, x, y in rows:
        assert got[k] == pytest.approx(plain_blocks(x, y, 450, 20, 20260817))
    old = stats.bootstrap_ratio(df.filter("k = 'a'"), ["k"], "x", "y", resamples=450, block=20).first()
    assert abs(got["a"][0] - old.ci_low) < 0.08 and abs(got["a"][1] - old.ci_high) < 0.08  # another stream, the same spread
    assert resampling.block_interval(df.limit(0), ["k"], "x", "y").collect() == []


def test_cluster_interval_equals_plain_draws(spark):
    rng = np.random.default_rng(4)
    rows = [("g", f"c{i % 7}", int(a), 1) for i, a in enumerate(rng.integers(0, 2, 90))] + [("g", None, 1, 1), ("z", "c", 1, 0), (None, "c", 1, 2), ("one", "c", 3, None)]
    df = spark.createDataFrame(rows, "g string, c string, a int, b int")
    got = {r.g: r for r in resampling.cluster_interval(df, ["g"], "c", "a", "b", resamples=900, seed=7).collect()}
    for g in ("g", "z", None, "one"):
        sums = {}
        for _, c, a, b in (r for r in rows if r[0] == g):
            x, y = sums.get(c, (0, 0))
            sums[c] = x + a, y + (b or 0)
        sums = [sums[c] for c in sorted(sums, key=lambda c: (c is not None, c or ""))]
        n, found = len(sums), []
        for d in range(900):
            picks = [sums[number(7, d, s) % n] for s in range(n)]
            if sum(b for _, b in picks):
                found.append(sum(a for a, _ in picks) / sum(b for _, b in picks))
        found.sort()
        want = (found[int(0.025 * len(found))], found[min(len(found) - 1, int(0.975 * len(found)))]) if found else (None, None)
        assert got[g].clusters == n and (got[g].low, got[g].high) == want
    old = evaluation.cluster_interval(df.filter("g = 'g'"), ["g"], "c", "a", "b", resamples=900).first()
    assert abs(old.low - got["g"].low) < 0.08 and abs(old.high - got["g"].high) < 0.08 and old.value == got["g"].value
    assert resampling.cluster_interval(df.limit(0), ["g"], "c", "a", "b").collect() == []
