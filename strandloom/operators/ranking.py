"""Best hits: ranks with explicit tie order, margins, near-duplicate collapse, greedy suppression."""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.operators import scans
from strandloom.operators.intervals import with_island


def ranked(df: DataFrame, by: list[str], *order: Column, name: str = "rank") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def best_with_margin(df: DataFrame, by: list[str], score: str, *ties: Column, none: float = 999_999.0, least: float = 10.0) -> DataFrame:
    """The best row of each key, how far the second lies below it, and whether that is too near."""
    order = Window.partitionBy(*by).orderBy(F.col(score).desc(), *ties)
    margin = F.coalesce(F.col(score) - F.lead(score).over(order), F.lit(none))
    out = df.withColumn("margin", margin).withColumn("__rank", F.row_number().over(order)).filter("__rank = 1").drop("__rank")
    return out.withColumn("ambiguous", F.col("margin") < least)


def collapse(df: DataFrame, by: list[str], start: str, end: str, rank: list[str], gap: int = 20) -> DataFrame:
    """One row for hits within ``gap`` of each other: the best by the rank columns, with the number it stands for."""
    marked = with_island(df, by, start, end, gap)
    order = Window.partitionBy(*by, "island").orderBy(*[F.col(c).desc() for c in rank], F.col(start), F.col(end))
    support = F.count(F.lit(1)).over(Window.partitionBy(*by, "island"))
    return marked.withColumn("support", support).withColumn("__rank", F.row_number().over(order)).filter("__rank = 1").drop("__rank", "island")


def suppress_overlaps(df: DataFrame, by: list[str], start: str, end: str, order: list[str], share: float = 0.0) -> DataFrame:
    """Keep rows in ``order`` (descending, then by start and end) that overlap no kept row by more than ``share`` of the shorter.

    The choice depends on what was kept before, but only among rows that a
    chain of overlaps connects.  Each task walks its keys in order of start and
    holds one such island at a time, whatever the size of a key.
    """
    names = df.columns
    sorted_ = df.repartition(*by).sortWithinPartitions(*by, start, end)

    def islands(pdf: pd.DataFrame) -> np.ndarray:
        keys = pdf[by]
        fresh = (keys.ne(keys.shift()) & ~(keys.isna() & keys.shift().isna())).any(axis=1).to_numpy(copy=True)
        reach = None
        for i, (a, b) in enumerate(zip(pdf[start].tolist(), pdf[end].tolist(), strict=True)):
            if fresh[i] or reach is None or a > reach:
                fresh[i], reach = True, b
            elif b > reach:
                reach = b
        return fresh

    def chosen(pdf: pd.DataFrame, fresh: np.ndarray) -> pd.DataFrame:
        ranked = pdf.assign(__island=np.cumsum(fresh)).sort_values(["__island", *order, start, end], ascending=[True] + [False] * len(order) + [True, True], kind="stable")
        take, here, now, kept = [], ranked["__island"].tolist(), None, _Kept(share)
        for i, (a, b) in enumerate(zip(ranked[start].tolist(), ranked[end].tolist(), strict=True)):
            if here[i] != now:
                now, kept = here[i], _Kept(share)
            if kept.add(a, b):
                take.append(i)
        return ranked.iloc[take][names]

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: pd.DataFrame | None = None
        for pdf in batches:
            held = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            fresh = islands(held)
            last = int(np.flatnonzero(fresh)[-1]) if len(fresh) else 0
            # The last island may go on in the next batch.
            rest = held.iloc[last:].reset_index(drop=True)
            if last:
                yield chosen(held.iloc[:last], fresh[:last])
        if rest is not None and len(rest):
            yield chosen(rest, islands(rest))

    return sorted_.mapInPandas(walk, df.schema)


class _Kept:
    """Intervals kept so far; ``add`` takes one that overlaps none of them too much."""

    def __init__(self, share: float) -> None:
        self.share, self.starts, self.ends = share, [], []

    def add(self, a, b) -> bool:
        if self.share == 0:
            # Kept intervals are disjoint, so only the neighbours can overlap.
            at = bisect.bisect_right(self.starts, b)
            if at and self.ends[at - 1] >= a:
                return False
            self.starts.insert(at, a)
            self.ends.insert(at, b)
            return True
        if self.starts:
            s, e = np.asarray(self.starts), np.asarray(self.ends)
            shared = np.maximum(np.minimum(b, e) - np.maximum(a, s) + 1, 0)
            if (shared > self.share * np.minimum(b - a + 1, e - s + 1)).any():
                return False
        self.starts.append(a)
        self.ends.append(b)
        return True


def n50(df: DataFrame, by: list[str], length: str, keep: scans.Keep | None = None) -> DataFrame:
    """Count, total, longest and N50 of the lengths of each key.

    Equal lengths are counted first.  A key's distinct lengths meet in one task;
    with ``keep``, which stores rows, they are dealt by ranges instead.
    """
    counted = df.groupBy(*by, length).agg(F.count(F.lit(1)).alias("__k")).withColumns({"__down": -F.col(length), "__sum": F.col(length) * F.col("__k")})
    if keep:
        ran = scans.running_sum(scans.dealt(counted, by, ["__down"], keep, "n50-ranges"), by, ["__down"], F.col("__sum"), "__run")
        every = counted.groupBy(*by).agg(F.sum("__sum").alias("__all"))
        same = reduce(lambda x, y: x & y, (F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in by), F.lit(True))
        ran = ran.join(every.select(*[F.col(c).alias(f"__k_{c}") for c in by], "__all"), same) if by else ran.crossJoin(F.broadcast(every))
    else:
        order = Window.partitionBy(*by).orderBy("__down")
        ran = counted.withColumn("__run", F.sum("__sum").over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("__all", F.sum("__sum").over(Window.partitionBy(*by)))
    return ran.groupBy(*by).agg(F.sum("__k").alias("sequences"), F.sum("__sum").alias("total"), F.max(length).alias("longest"), F.max(F.when(F.col("__run") * 2 >= F.col("__all"), F.col(length))).alias("n50"))


def spread_positions(count: int, most: int) -> Iterator[int]:
    """``most`` indices evenly over 0..count-1, rounded half to even; a single one is the middle."""
    if count <= most:
        yield from range(count)
    else:
        for i in range(most):
            yield round(i * (count - 1) / (most - 1)) if most > 1 else count // 2
