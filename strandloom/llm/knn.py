"""Exact top-k search by inner product: a Voronoi join with bounds from cell summaries.

Vectors become integers, floor(scale * x).  Pivots are a hash-chosen sample of
the data that grows with the square root of its rows; every vector belongs to
its nearest pivot's cell.  A cell's summary holds its number of vectors, its
radius (greatest distance to the pivot) and its greatest norm.

Queries lie in cells too.  First each query meets its own cell, whole; the
k-th best score found there bounds its k-th best of all from below, as do its
scores with the pivots, which are rows of the data.  For another cell with
pivot p, radius r and greatest norm m, ``q.p + |q| r`` and
``(|q|^2 + m^2 - max(0, |q - p| - r)^2) / 2`` bound the scores of its vectors
from above.  Queries are replicated, in blocks, only to the cells whose bound
reaches that of some query of the block.  All bounds are widened by a margin
for rounding.

Cells are cut into chunks of bounded size, so a cell that holds a third of all
vectors spreads over many tasks.  Each chunk is solved locally by an exact
integer product, and the partial lists merge by query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandloom.llm.common import Scratch

#: Least pivots; components of all pivots at most (8 bytes each); vectors of a chunk and queries of a block, about.
PIVOTS, PIVOT_CELLS, CHUNK, BLOCK = 64, 4_000_000, 4096, 512


def _clean(vectors: DataFrame, vec_id: str, embedding: str, scale: int) -> DataFrame:
    e = F.transform(F.col(embedding), lambda x: x.cast("double"))
    ok = F.col(embedding).isNotNull() & F.col(vec_id).isNotNull() & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < 2.0**62 / scale))
    rows = vectors.filter(ok).select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(e, lambda x: F.floor(x * scale).cast("long")).alias("v"), F.size(embedding).alias("dim"))
    return rows.withColumn("row", F.monotonically_increasing_id())


def _matrix(batch: pa.RecordBatch, name: str, dim: int) -> np.ndarray:
    col = batch.column(batch.schema.get_field_index(name))
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(col), dim)


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def _assign(pivots, dim):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pivots.value
        half = (p**2).sum(1) / 2
        for b in batches:
            for at in range(0, b.num_rows, 2048):
                part = b.slice(at, 2048)
                v = _matrix(part, "v", dim)
                cell = np.argmin(half - v @ p.T, 1)
                distance, norm = np.sqrt(((v - p[cell]) ** 2).sum(1)), np.sqrt((v**2).sum(1))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell.astype(np.int32)), pa.array(distance), pa.array(norm)], names=[*part.schema.names, "cell", "distance", "norm"])

    return assign


def _pack(dim, kind, size):
    """Vectors of a task, which share their (cell, part), to rows of bytes of about ``size`` vectors a part."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}
        count: dict[tuple[int, int], int] = {}

        def row(at):
            ids, rows, bound, data = (np.concatenate(x) for x in zip(*held.pop(at), strict=True))
            del count[at]
            blobs = [ids.astype(np.int64), rows.astype(np.int64), bound.astype(np.float64), data.astype(kind)]
            return pa.RecordBatch.from_arrays([pa.array([at[0]], pa.int32()), pa.array([at[1]], pa.int64()), *(pa.array([x.tobytes()], pa.binary()) for x in blobs)], names=["cell", "part", "ids", "rows", "bound", "data"])

        for b in batches:
            cell, part = _column(b, "cell"), _column(b, "part")
            ids, rows, bound, v = _column(b, "vec_id"), _column(b, "row"), _column(b, "bound"), _matrix(b, "v", dim)
            for at in {*zip(cell.tolist(), part.tolist(), strict=True)}:
                mine = (cell == at[0]) & (part == at[1])
                held.setdefault(at, []).append((ids[mine], rows[mine], bound[mine], v[mine]))
                count[at] = count.get(at, 0) + int(mine.sum())
                if count[at] >= 2 * size:
                    yield row(at)
        for at in list(held):
            yield row(at)

    return pack


def upper_bounds(q: np.ndarray, pivots: np.ndarray, radius: np.ndarray, most: np.ndarray) -> np.ndarray:
    """For each query and cell, a number that no score of the cell's vectors exceeds."""
    norm = np.sqrt((q**2).sum(1))[:, None]
    middle = q @ pivots.T
    by_angle = middle + norm * radius
    apart = np.sqrt(np.maximum(norm**2 + (pivots**2).sum(1) - 2 * middle, 0))
    by_distance = (norm**2 + most**2 - np.maximum(apart * (1 - 1e-9) - radius - 1e-3, 0) ** 2) / 2
    return np.minimum(by_angle, by_distance) + 1e-6 * (np.abs(middle) + norm * radius + norm**2) + 1


def _wanted(pivots, summary, dim, k, kind):
    """Packed query blocks to (block, cell) for the other cells that some query of the block needs."""

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pivots.value
        count, radius, most = summary.value
        for b in batches:
            for i in range(b.num_rows):
                block = b.slice(i, 1)
                get = lambda name, t: np.frombuffer(block.column(block.schema.get_field_index(name))[0].as_buffer(), t)  # noqa: B023, E731
                bound = get("bound", np.float64).copy()
                q = get("data", kind).reshape(len(bound), dim).astype(np.float64)
                if len(p) > k:
                    # The pivots are rows of the data; one of them may be the query itself.
                    at_pivots = np.partition(q @ p.T, len(p) - k - 1, 1)[:, len(p) - k - 1]
                    bound = np.maximum(bound, at_pivots - 1e-6 * np.abs(at_pivots) - 1)
                need = (upper_bounds(q, p, radius, most) >= bound[:, None]).any(0) & (count > 0)
                need[_column(block, "cell")[0]] = False
                cells = np.flatnonzero(need).astype(np.int32)
                if len(cells):
                    take = pa.array(np.zeros(len(cells), np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array(cells), *(block.column(block.schema.get_field_index(c)).take(take) for c in ("ids", "rows", "data"))], names=["cell", "q_ids", "q_rows", "q_data"])

    return wanted


def _solve(dim, k, kind):
    """A block of queries and a chunk of vectors to each query's k + 1 best, its own row being marked."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                get = lambda name, t=np.int64: np.frombuffer(b.column(b.schema.get_field_index(name))[i].as_buffer(), t)  # noqa: B023, E731
                q_ids, q_rows, ids = get("q_ids"), get("q_rows"), get("ids")
                q, v = get("q_data", kind).reshape(len(q_ids), dim).astype(np.int64), get("data", kind).reshape(len(ids), dim).astype(np.int64)
                by_id = np.argsort(ids, kind="stable")
                ids, v = ids[by_id], v[by_id]
                # Doubles are exact below 2**53; larger products take the integer path.
                small = float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * dim < 2**52
                s = (q.astype(np.float64) @ v.T.astype(np.float64)).astype(np.int64) if small else q @ v.T
                lo, hi = np.searchsorted(ids, q_ids, "left"), np.searchsorted(ids, q_ids, "right")
                out: list[list[np.ndarray]] = [[], [], [], []]
                for r in range(len(q_ids)):
                    ok = np.arange(len(ids))
                    if len(ok) > k + 1:
                        ok = np.flatnonzero(s[r] >= np.partition(s[r], len(ids) - k - 1)[len(ids) - k - 1])
                    best = ok[np.lexsort((ids[ok], -s[r, ok]))]
                    # Rows with the query's id and vector come first among ties of score and id.
                    own = np.zeros(len(best), bool)
                    if hi[r] > lo[r]:
                        own = (best >= lo[r]) & (best < hi[r])
                        own[own] = (v[best[own]] == q[r]).all(1)
                        order = np.lexsort((~own, ids[best], -s[r, best]))
                        best, own = best[order], own[order]
                    best, own = best[: k + 1], own[: k + 1]
                    for x, y in zip(out, (np.full(len(best), q_rows[r]), ids[best], s[r, best], own), strict=True):
                        x.append(y)
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], names=["q", "vec_id", "score", "own"])

    return solve


_BEST = "q long, vec_id long, score long, own boolean"


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = 1024) -> DataFrame:
    """The k highest integer inner products of every query among the vectors: query_id, rank, vec_id, score.

    Ties go to the smaller vec_id; fewer than k candidates are all returned.
    Every row of the vectors is a candidate of its own but the query's own row:
    one row that has the query's id and vector, if there is one.  Rows that
    repeat an id are candidates, and queries, of their own.

    Vectors that are null, without an id, or that hold a component that is null
    or not finite (or so large that scale times it passes 2**62) take no part.
    Vectors of unlike length have no product, so they are no candidates of one
    another; each length is solved by itself.  Scores are 64-bit integers.  An
    empty table gives an empty result; other columns are not read.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    # Rows are told apart by numbers that are written with them.
    data, asked = scratch.keep("data", _clean(vectors, vec_id, embedding, scale)), scratch.keep("asked", _clean(queries, vec_id, embedding, scale))
    lengths = [r[0] for r in asked.select("dim").distinct().join(data.select("dim").distinct(), "dim").orderBy("dim").collect()]
    results = [_solved(scratch, f"d{dim}", data.filter(F.col("dim") == dim).drop("dim"), asked.filter(F.col("dim") == dim).drop("dim"), dim, k) for dim in lengths]
    if not results:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    every = reduce(DataFrame.unionByName, results)
    # The query's own row is taken out of its k + 1 best.
    mine = Window.partitionBy("q")
    ranked = every.withColumn("place", F.row_number().over(mine.orderBy(F.desc("score"), "vec_id", F.desc("own")))).filter(F.col("place") <= k + 1)
    gone = F.min(F.when(F.col("own"), F.col("place"))).over(mine)
    ranked = ranked.withColumn("gone", F.coalesce(gone, F.lit(k + 2))).filter("place <> gone")
    ranked = ranked.withColumn("rank", F.col("place") - (F.col("place") > F.col("gone")).cast("int")).filter(F.col("rank") <= k)
    ids = asked.select(F.col("row").alias("q"), F.col("vec_id").alias("query_id"))
    return ranked.join(ids, "q").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _solved(scratch: Scratch, name: str, data: DataFrame, asked: DataFrame, dim: int, k: int) -> DataFrame:
    """(q, vec_id, score, own): the best of each query's own cell and of every part of the cells that it may need."""
    spark = data.sparkSession
    largest = F.coalesce(F.max(F.array_max(F.transform("v", F.abs))), F.lit(0))
    n, most = data.agg(F.count(F.lit(1)), largest).first()
    most = max(most, asked.agg(largest).first()[0])
    kind = np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64
    wish = max(1, min(max(PIVOTS, math.isqrt(n)), PIVOT_CELLS // max(dim, 1)))
    chosen = data.orderBy(F.xxhash64("vec_id", "row", F.lit(3)), "vec_id").limit(wish).select("v").collect()
    pivots = spark.sparkContext.broadcast(np.unique(np.array([r[0] for r in chosen], np.float64).reshape(len(chosen), dim), axis=0))
    placed = "vec_id long, v array<long>, row long, cell int, distance double, norm double"
    located = scratch.keep(f"{name}-located", data.select("vec_id", "v", "row").mapInArrow(_assign(pivots, dim), placed))
    cells = len(pivots.value)
    count, radius, norm = np.zeros(cells, np.int64), np.zeros(cells), np.zeros(cells)
    for r in located.groupBy("cell").agg(F.count(F.lit(1)), F.max("distance"), F.max("norm")).collect():
        count[r[0]], radius[r[0]], norm[r[0]] = r[1], r[2] * (1 + 1e-9), r[3] * (1 + 1e-9)
    summary = spark.sparkContext.broadcast((count, radius, norm))
    sizes = spark.createDataFrame([(i, int(max(1, -(-x // CHUNK)))) for i, x in enumerate(count.tolist())], "cell int, parts long")

    def packed(df: DataFrame, size: int) -> DataFrame:
        return df.repartition("cell", "part").mapInArrow(_pack(dim, kind, size), "cell int, part long, ids binary, rows binary, bound binary, data binary")

    # One row a pivot, so the sizes can be broadcast as the pivots are.
    split = located.join(F.broadcast(sizes), "cell").withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts"))).withColumn("bound", F.lit(0.0))
    chunks = scratch.keep(f"{name}-chunks", packed(split.select("cell", "part", "vec_id", "row", "bound", "v"), CHUNK).select("cell", "part", "ids", "data"))
    # Queries of a cell in parts: about as many rows as their share of the data.
    own = scratch.keep(f"{name}-queries", asked.mapInArrow(_assign(pivots, dim), placed).drop("distance", "norm"))
    share = max(1, -(-own.count() // BLOCK))
    at = own.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(share)))
    everywhere = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))

    def best(blocks: DataFrame) -> DataFrame:
        # A needed cell meets all its chunks, each in its own task.
        dealt = blocks.select("cell", "q_ids", "q_rows", "q_data").join(F.broadcast(sizes), "cell").withColumn("part", everywhere).drop("parts")
        return dealt.join(chunks, ["cell", "part"]).select("q_ids", "q_rows", "q_data", "ids", "data").mapInArrow(_solve(dim, k, kind), _BEST)

    own_blocks = packed(at.withColumn("bound", F.lit(0.0)).select("cell", "part", "vec_id", "row", "bound", "v"), BLOCK)
    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id", F.desc("own"))
    near = best(own_blocks.select("cell", F.col("ids").alias("q_ids"), F.col("rows").alias("q_rows"), F.col("data").alias("q_data")))
    near = scratch.keep(f"{name}-near", near.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + 1))
    # The k + 1st best may count the query itself, so it is a bound for the k-th of the others.
    known = near.filter(F.col("place") == k + 1).select(F.col("q").alias("row"), F.col("score").cast("double").alias("bound"))
    bound = at.join(known, "row", "left").withColumn("bound", F.coalesce("bound", F.lit(float("-inf"))))
    blocks = packed(bound.select("cell", "part", "vec_id", "row", "bound", "v"), BLOCK)
    far = best(blocks.mapInArrow(_wanted(pivots, summary, dim, k, kind), "cell int, q_ids binary, q_rows binary, q_data binary"))
    return near.drop("place").unionByName(far)
