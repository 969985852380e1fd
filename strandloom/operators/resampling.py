"""Bootstraps whose draws are counted, not streamed, so that they are dealt to tasks and can be stated elsewhere.

What a slot of a resample draws is a function of seed, resample and slot alone.
Resamples of one key therefore go to as many tasks as there are slices of them,
in any order, and a task that is lost draws the same again.  The function mixes
by modular squares below 2**31, which any engine with 64-bit integers can
follow; ``stats.bootstrap_ratio`` and ``evaluation.cluster_interval`` draw from
one stream a key instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.operators.stats import Blocks

# Fixed values of the draws: a prime below 2**31 and the numbers that are mixed in.
PRIME, BY_DRAW, BY_SLOT, FIRST, LAST, SHIFT = 2147483647, 1000003, 7919, 1013904223, 12345, 16
#: Resamples a task row.
SLICE = 200


def drawn(seed: Column | np.ndarray | int, draw: Column | np.ndarray, slot: Column | np.ndarray, floor=np.floor_divide):
    """A number below 2**27 of each (seed, draw, slot); columns and arrays alike."""
    x = (seed + draw * BY_DRAW + slot * BY_SLOT) % PRIME
    x = (x * x + FIRST) % PRIME
    x = ((x + draw + 1) * (x + slot + 1)) % PRIME
    return floor((x * x + LAST) % PRIME, SHIFT)


def drawn_column(seed: int, draw: Column, slot: Column) -> Column:
    return drawn(F.lit(seed).cast("long"), draw.cast("long"), slot.cast("long"), lambda x, n: F.shiftright(x, 4))


def drawn_sql(seed: str, draw: str, slot: str) -> str:
    """The same in SQL with ``%`` on integers."""
    x = f"(({seed} + CAST({draw} AS BIGINT) * {BY_DRAW} + CAST({slot} AS BIGINT) * {BY_SLOT}) % {PRIME})"
    x = f"(({x} * {x} + {FIRST}) % {PRIME})"
    x = f"((({x} + {draw} + 1) * ({x} + {slot} + 1)) % {PRIME})"
    return f"((({x} * {x} + {LAST}) % {PRIME}) >> 4)"


def _bounds(draws: DataFrame, by: list[str], low: Column, high: Column) -> DataFrame:
    """by, n and the two order statistics (0-based columns of n) of ``value``, null ones left out."""
    lists = draws.groupBy(*by).agg(F.sort_array(F.collect_list("value")).alias("v")).withColumn("n", F.size("v"))
    at = lambda i: F.when(F.col("n") > 0, F.element_at("v", (F.greatest(i, F.lit(0)) + 1).cast("int")))
    return lists.select(*by, "n", at(low).alias("low"), at(F.least(high, F.col("n") - 1)).alias("high"))


def cluster_interval(df: DataFrame, by: list[str], cluster: str, numerator: str, denominator: str, resamples: int = 10_000, seed: int = 20261118) -> DataFrame:
    """95 % percentile interval of sum(numerator) / sum(denominator), clusters drawn with replacement.

    Result: by, clusters, value, low, high.  Rows shrink to two sums a cluster,
    in order of the cluster (null first); a key's row is as long as its number
    of clusters.  The bounds are the order statistics int(0.025 n) and
    int(0.975 n) of the resamples that have a denominator, null without any.
    """
    sums = df.groupBy(*by, cluster).agg(F.sum(numerator).cast("double").alias("a"), F.sum(denominator).cast("double").alias("b"))
    lists = sums.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(F.col(cluster).alias("c"), F.coalesce("a", F.lit(0.0)).alias("a"), F.coalesce("b", F.lit(0.0)).alias("b")))).alias("l")).withColumn("clusters", F.size("l").cast("long"))
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("b"))
    ratio = lambda s: F.when(s["b"] != 0, s["a"] / s["b"])
    add = lambda s, x: F.struct((s["a"] + x["a"]).alias("a"), (s["b"] + x["b"]).alias("b"))
    # Slices first, so that a key's resamples are spread before they are listed.
    slices = lists.select(*by, "l", "clusters", F.explode(F.sequence(F.lit(0), F.lit((resamples - 1) // SLICE))).alias("slice")).repartition(*by, "slice")
    each = slices.select(*by, "l", "clusters", F.explode(F.sequence(F.col("slice") * SLICE, F.least(F.col("slice") * SLICE + SLICE, F.lit(resamples)) - 1)).alias("d"))
    index = lambda s: (drawn_column(seed, F.col("d"), s) % F.col("clusters")).cast("int")
    total = F.aggregate(F.sequence(F.lit(0).cast("long"), F.col("clusters") - 1), zero, lambda s, slot: add(s, F.get("l", index(slot))))
    draws = each.select(*by, ratio(total).alias("value"))
    n = F.col("n")
    bounds = _bounds(draws, by, F.floor(n * 0.025), F.floor(n * 0.975))
    whole = lists.select(*by, "clusters", ratio(F.aggregate("l", zero, add)).alias("value"))
    return _same(whole, bounds.drop("n"), by)


def _same(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    from strandloom.operators.stats import _same_key

    return _same_key(left, right, by, "left")


def block_interval(df: DataFrame, by: list[str], locus: str, backbone: str, resamples: int = 1000, block: int = 500, seed: int = 20260817, cap: int = 512, alpha: float = 0.05) -> DataFrame:
    """Interval of median(locus) / median(backbone) by resampling blocks: by, ci_low, ci_high.

    ``locus`` and ``backbone`` are arrays of depths in order, one row a key;
    thin the backbone with ``stats.thin_blocks`` before it is collected, as only
    ``cap`` evenly spaced blocks of it are drawn from.  A resample draws as many
    blocks as there are, of the locus by ``seed`` and of the backbone by
    ``seed`` + 1; those whose backbone is 0 do not count.  Bounds are the order
    statistics int(n alpha / 2) - 1 and int(n (1 - alpha / 2)); without a draw
    both are 0.
    """
    last = (resamples - 1) // SLICE

    def medians(values, limit: int | None, start: int, draws: np.ndarray) -> np.ndarray | None:
        blocks = Blocks(values if values is not None else [], block, limit)
        if not blocks.count:
            return None
        index = drawn(start, draws[:, None], np.arange(blocks.count, dtype=np.int64)[None]) % blocks.count
        out = np.empty(len(draws))
        for i, row in enumerate(index):
            upto = np.cumsum(np.bincount(row, minlength=blocks.count)[blocks.owner])
            out[i] = blocks.values[np.searchsorted(upto, [(upto[-1] - 1) // 2, upto[-1] // 2], side="right")].mean()
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for i, (x, y, number) in enumerate(zip(pdf[locus], pdf[backbone], pdf["slice"], strict=True)):
                draws = np.arange(number * SLICE, min(number * SLICE + SLICE, resamples), dtype=np.int64)
                top, base = medians(x, None, seed, draws), medians(y, cap, seed + 1, draws)
                if top is None or base is None or not (base > 0).any():
                    continue
                found = top[base > 0] / base[base > 0]
                yield pdf[by].iloc[[i] * len(found)].reset_index(drop=True).assign(value=found)

    sliced = df.select(*by, locus, backbone, F.explode(F.sequence(F.lit(0), F.lit(last))).alias("slice")).repartition(*by, "slice")
    fields = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in by)
    n = F.col("n")
    bounds = _bounds(sliced.mapInPandas(run, f"{fields}value double"), by, F.floor(n * alpha / 2) - 1, F.floor(n * (1 - alpha / 2))).drop("n")
    out = _same(df.select(*by), bounds, by)
    return out.select(*by, F.coalesce("low", F.lit(0.0)).alias("ci_low"), F.coalesce("high", F.lit(0.0)).alias("ci_high"))
