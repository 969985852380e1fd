"""Lloyd clustering of quantised vectors, where equal vectors are one weighted point.

Vectors are quantised to integers and grouped: every distinct vector is kept
once with its multiplicity, so rounds read distinct vectors only and a group of
copies costs as much as one row.  The start is the k vectors whose ids have the
smallest seeded hashes.  Each round is one pass over the distinct vectors:
tasks assign their points to the nearest of the k centroids and add up
weighted integer sums a (cluster, component); Spark adds those up exactly, and
k x dims sums, whatever the size of the table, make the next centroids.  All
arithmetic is on integers, so a result does not depend on how rows are dealt.

The last assignment is joined back to the rows by the vector itself.  Vectors
with over a thousandth of all rows, no more than a thousand of them, are
broadcast; any other vector's rows are few enough to meet in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.llm.common import Scratch

#: Components stay below this in magnitude, so that squared distances of up to 64 components fit a long.
LARGEST = 1 << 27
#: A vector with over 1/HEAVY of all rows is broadcast; there are fewer than HEAVY of those.
HEAVY = 1000


def quantised(vectors: DataFrame, dims: int, scale: int, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id and q, floor(scale * component) of each component; only vectors of ``dims`` finite components."""
    x = F.transform(F.col(embedding), lambda v: F.floor(v.cast("double") * F.lit(float(scale))).cast("int"))
    bound = F.lit(float(LARGEST) / scale)
    # NaN compares greater than every number, so it fails the bound as infinities do.
    fit = (F.size(embedding) == dims) & F.forall(F.col(embedding), lambda v: v.isNotNull() & (F.abs(v.cast("double")) < bound))
    return vectors.filter(F.coalesce(fit, F.lit(False))).select(F.col(vec_id).alias("vec_id"), x.alias("q"))


def _matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, dims)


def nearest(points: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of each point's nearest centroid, the smaller number of equally near ones."""
    best = np.zeros(len(points), np.int32)
    least = np.full(len(points), np.iinfo(np.int64).max)
    for i, c in enumerate(centroids):
        d = ((points - c) ** 2).sum(1)
        closer = d < least
        best[closer], least[closer] = i, d[closer]
    return best, least


def _sums(centroids: list[list[int]], dims: int):
    """Weighted sums of a task's points: (cluster, component, total), and the weight as component -1."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = np.array(centroids, np.int64)
        total, weight = [[0] * dims for _ in centroids], [0] * len(centroids)
        for b in batches:
            points, n = _matrix(b.column(0), dims), b.column(1).to_numpy(zero_copy_only=False)
            best, _ = nearest(points, at)
            # Python integers hold sums that pass a long; a batch's own sums of components below 2**27 do not.
            for c in np.unique(best).tolist():
                mine = best == c
                weight[c] += int(n[mine].sum())
                high, low = np.divmod(n[mine], 1 << 20)
                upper, lower = (points[mine] * high[:, None]).sum(0).tolist(), (points[mine] * low[:, None]).sum(0).tolist()
                total[c] = [t + (h << 20) + r for t, h, r in zip(total[c], upper, lower, strict=True)]
        rows = [(c, i, v) for c in range(len(centroids)) if weight[c] for i, v in enumerate([*total[c], weight[c]])]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([str(r[2]) for r in rows], pa.string())], names=["cluster", "i", "total"])

    return add


def moved(points: DataFrame, centroids: list[list[int]], dims: int) -> list[list[int]]:
    """The centroids after one round over weighted points (q, n): the floors of the weighted means; empty ones stay."""
    parts = points.select("q", "n").mapInArrow(_sums(centroids, dims), "cluster int, i int, total string")
    rows = parts.groupBy("cluster", "i").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    sums = {(r.cluster, r.i): int(r.total) for r in rows}
    return [[sums[c, i] // sums[c, dims] for i in range(dims)] if (c, dims) in sums else old for c, old in enumerate(centroids)]


def _assigned(centroids: list[list[int]], dims: int):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = np.array(centroids, np.int64)
        for b in batches:
            best, least = nearest(_matrix(b.column(0), dims), at)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(best), pa.array(least)], names=["q", "n", "cluster", "distance"])

    return assign


def _order(seed: int) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)


def lloyd(vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """The cluster of every vector: vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256.

    Only vectors of exactly ``dims`` components, none null or not finite, take
    part.  Vectors with a component of 2**27 / scale or more in magnitude, whose
    squared distances could pass a long, take none either.  Every other row has
    its row in the result, repeated ids and equal vectors included.  A null id is
    hashed last, so it starts a centroid only where ids are too few; equal ids
    are ordered by their vectors.  Fewer than k vectors start as many
    centroids.  Vectors equally near to two centroids go to the smaller number.
    An empty table gives an empty result; other columns are not read.
    """
    if dims > 64 or scale < 1:
        raise ValueError("at most 64 components, and a scale of 1 or more")
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    rows = quantised(vectors, dims, scale, vec_id, embedding)
    points = scratch.keep("points", rows.groupBy("q").agg(F.count(F.lit(1)).alias("n")))
    start = rows.select("q", _order(seed).alias("h")).orderBy(F.col("h").asc_nulls_last(), "q").limit(k).collect()
    if not start:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    centroids = [list(r.q) for r in start]
    for _ in range(rounds):
        centroids = moved(points, centroids, dims)
    placed = scratch.keep("placed", points.mapInArrow(_assigned(centroids, dims), "q array<int>, n long, cluster int, distance long"))
    scratch.only("placed")
    sums = placed.groupBy("cluster").agg(F.sum("n").alias("n"), F.sum(F.col("distance").cast("decimal(38,0)") * F.col("n")).alias("inertia")).collect()
    total, every = sum(int(r.inertia) for r in sums), sum(r.n for r in sums)
    facts = [(r.cluster, int(r.inertia), total, hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest()) for r in sums]
    # One row a centroid.
    about = F.broadcast(spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"))
    heavy = placed.filter(F.col("n") * HEAVY > every).select("q", "cluster", "distance")
    light = placed.filter(F.col("n") * HEAVY <= every).select("q", "cluster", "distance")
    back = rows.join(F.broadcast(heavy), "q").unionByName(rows.join(F.broadcast(heavy.select("q")), "q", "left_anti").join(light, "q"))
    return back.join(about, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
