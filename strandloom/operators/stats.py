"""Robust statistics, block bootstrap, grouped proportions and fits."""

from __future__ import annotations

import random
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.functions.statistics import clopper_pearson
from strandloom.operators import scans
from strandloom.operators.decisions import call_threshold, depth_call
from strandloom.operators.ranking import spread_positions


def _same_key(left: DataFrame, right: DataFrame, by: list[str], how: str = "inner") -> DataFrame:
    """Join on keys where null equals null; without keys the right side is one row."""
    if not by:
        return left.crossJoin(F.broadcast(right))
    named = right.select(*[F.col(c).alias(f"__k_{c}") for c in by], *[c for c in right.columns if c not in by])
    same = reduce(lambda x, y: x & y, (F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in by))
    return left.join(named, same, how).drop(*[f"__k_{c}" for c in by])


def robust(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """n, median, quartiles, their difference and MAD per key, exact and without a key's values in one place; null values take no part."""
    centre = quantiles(df, by, value, {"median": 0.5, "q1": 0.25, "q3": 0.75})
    away = _same_key(df.select(*by, value), centre.select(*by, "median"), by).withColumn("__away", F.abs(F.col(value) - F.col("median")))
    mad = quantiles(away, by, "__away", {"mad": 0.5}).drop("n")
    return _same_key(centre, mad, by, "left").withColumn("iqr", F.col("q3") - F.col("q1"))


def profile(df: DataFrame, by: list[str], length: str) -> DataFrame:
    """Length profile: population deviation, quartiles and the commonest length, the least of ties."""
    common = df.groupBy(*by, length).agg(F.count(F.lit(1)).alias("k")).groupBy(*by).agg(F.min_by(length, F.struct(-F.col("k"), F.col(length))).alias("mode_length"))
    rest = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.min(length).alias("min_length"), F.max(length).alias("max_length"), F.avg(length).alias("mean_length"), F.stddev_pop(length).alias("stdev_length"),
        F.percentile(length, F.lit(0.25)).alias("q1_length"), F.percentile(length, F.lit(0.75)).alias("q3_length"),
    )
    return rest.join(common, by)


def block_medians(df: DataFrame, by: list[str], position: str, value: str, block: int, keep_partial: bool = True) -> DataFrame:
    """Median per block of positions (1-based); a partial last block can be left out."""
    out = df.withColumn("block", F.floor((F.col(position) - 1) / block)).groupBy(*by, "block").agg(F.median(value).alias("block_median"), F.count(F.lit(1)).alias("block_size"))
    return out if keep_partial else out.filter(F.col("block_size") == block)


def proportions(df: DataFrame, group: str, success: str) -> DataFrame:
    """Successes, totals and 95 % bounds per group and over all, where group is null."""
    counts = df.rollup(group).agg(F.count_if(F.col(success)).alias("k"), F.count(F.lit(1)).alias("n"))
    return counts.withColumn("ci", clopper_pearson("k", "n")).select(group, "k", "n", (F.col("k") / F.col("n")).alias("share"), F.col("ci.low").alias("low"), F.col("ci.high").alias("high"))


def fit_line(df: DataFrame, by: list[str], y: str, x: str) -> DataFrame:
    return df.groupBy(*by).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"), F.regr_count(y, x).alias("n"))


class Blocks:
    """Values cut into blocks, sorted once; a draw weighs each value by how often its block was drawn."""

    def __init__(self, values: Sequence[float], block: int, cap: int | None = None) -> None:
        v = np.asarray(values, dtype=float)
        owner = np.arange(len(v)) // block
        self.count = int(owner[-1]) + 1 if len(v) else 0
        if cap is not None and self.count > cap:
            chosen = np.fromiter(spread_positions(self.count, cap), dtype=np.int64)
            keep = np.isin(owner, chosen)
            v, owner = v[keep], np.searchsorted(chosen, owner[keep])
            self.count = len(chosen)
        order = np.argsort(v, kind="stable")
        self.values, self.owner = v[order], owner[order]

    def draw(self, rng: random.Random) -> float:
        """Median of as many blocks as there are, drawn with replacement."""
        times = np.bincount([rng.randrange(self.count) for _ in range(self.count)], minlength=self.count)
        upto = np.cumsum(times[self.owner])
        middle = np.searchsorted(upto, [(upto[-1] - 1) // 2, upto[-1] // 2], side="right")
        return float(self.values[middle].mean())


def percentile_bounds(draws: list[float], alpha: float) -> tuple[float, float]:
    """The order statistics int(n a/2) - 1 and int(n (1 - a/2)), within the draws; zeros without any."""
    if not draws:
        return 0.0, 0.0
    found, n = sorted(draws), len(draws)
    return found[max(0, int(n * alpha / 2) - 1)], found[min(n - 1, int(n * (1 - alpha / 2)))]


def ratio_draws(locus: Blocks, backbone: Blocks, resamples: int, seed: int) -> list[float]:
    """Ratios of drawn medians, the locus drawn before the backbone; a backbone of 0 gives none."""
    if not locus.count or not backbone.count:
        return []
    rng = random.Random(seed)
    pairs = [(locus.draw(rng), backbone.draw(rng)) for _ in range(resamples)]
    return [top / base for top, base in pairs if base > 0]


def dosage_draws(regions: list[Blocks], backbone: Blocks, segments: list[tuple[int, list[int]]], resamples: int, seed: int) -> list[float]:
    """Mean multiplicities per covered base, the backbone drawn before the regions and those only on a backbone above 0.

    A region without depth rows draws as one block of a single zero.
    """
    covered = sum(n for n, members in segments if members)
    if not backbone.count or not covered or not any(r.count for r in regions):
        return []
    parts = [r if r.count else Blocks([0.0], 1) for r in regions]
    weight = np.array([sum(n for n, members in segments if i in members) for i in range(len(parts))], dtype=float) / covered
    rng, out = random.Random(seed), []
    for _ in range(resamples):
        base = backbone.draw(rng)
        if base > 0:
            out.append(float(sum(w * p.draw(rng) / base for w, p in zip(weight, parts, strict=True))))
    return out


def bootstrap_ratio(df: DataFrame, by: list[str], locus: str, backbone: str, resamples: int = 1000, block: int = 500, seed: int = 20260817, cap: int = 512, alpha: float = 0.05) -> DataFrame:
    """Interval of median(locus) / median(backbone) by resampling blocks.

    ``locus`` and ``backbone`` are arrays of depths, one row per key; thin the
    backbone with ``thin_blocks`` before it is collected.  One generator per
    row, seeded alike, draws the locus first.  Without values both bounds are 0.
    """

    def run(batches):
        for pdf in batches:
            found = [percentile_bounds(ratio_draws(Blocks(a if a is not None else [], block), Blocks(b if b is not None else [], block, cap), resamples, seed), alpha) for a, b in zip(pdf[locus], pdf[backbone], strict=True)]
            yield pdf[by].assign(ci_low=pd.Series([x for x, _ in found], index=pdf.index, dtype=float), ci_high=pd.Series([x for _, x in found], index=pdf.index, dtype=float))

    keys = df.select(*by, locus, backbone)
    fields = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in by)
    return keys.mapInPandas(run, f"{fields}, ci_low double, ci_high double")


def thin_blocks(df: DataFrame, by: list[str], order: list[str], block: int = 500, cap: int = 512, keep: scans.Keep | None = None) -> DataFrame:
    """The rows of at most ``cap`` blocks per key, evenly spaced in ``order``; what a bootstrap of blocks reads.

    Rows are cut into blocks of ``block`` in their order; the first and the
    last block are always kept (of one block, the middle one).  A key's rows
    meet in one task; with ``keep``, which stores rows, they are dealt by ranges
    instead.
    """
    if keep:
        placed = scans.numbered(scans.dealt(df, by, order, keep, "blocks-ranges"), by, order, "__at").drop(scans.RANGE).withColumn("__at", F.col("__at") - 1)
        placed = _same_key(placed, df.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / block).alias("__n")), by)
    else:
        w = Window.partitionBy(*by)
        placed = df.withColumn("__at", F.row_number().over(w.orderBy(*order)) - 1).withColumn("__n", F.ceil(F.count(F.lit(1)).over(w) / block))
    return placed.filter(is_spread(F.floor(F.col("__at") / block), F.col("__n"), cap)).drop("__at", "__n")


def is_spread(index: Column, count: Column, most: int) -> Column:
    """Whether an index is among ``most`` evenly spaced ones of 0..count-1, as ``spread_positions`` rounds."""
    if most == 1:
        return F.when(count > 1, index == F.floor(count / 2)).otherwise(True)
    step = (count - 1) / F.lit(most - 1)
    # The nearest slots to an index are those about index / step.
    near = F.floor(index / step)
    hit = lambda i: F.bround(i * (count - 1) / F.lit(most - 1)) == index
    return (count <= most) | hit(near) | hit(near + 1) | hit(F.greatest(near - 1, F.lit(0)))


def quantiles(df: DataFrame, by: list[str], value: str, probabilities: dict[str, float], accuracy: int = 10_000) -> DataFrame:
    """Exact quantiles (linear interpolation) per key without holding a key's values in one place.

    A sketch per key of at least 2 ``accuracy`` rows brackets each quantile
    within a share of 4 / ``accuracy`` of them; a second pass counts the rows
    below the bracket, and only the distinct values inside it, with their
    counts, are sorted.  Null values take
    no part; a key without any value has nulls.
    """
    rows = df.select(*by, F.col(value).cast("double").alias("__v"))
    given = rows.filter("__v is not null")
    margin = 2.0 / accuracy
    names, points = list(probabilities), list(probabilities.values())
    edges = sorted({min(1.0, max(0.0, p + s)) for p in points for s in (-margin, margin)})
    key = [F.col(c) for c in by]
    sketch = given.groupBy(*by).agg(F.count("__v").alias("__n"), F.min("__v").alias("__min"), F.max("__v").alias("__max"), F.percentile_approx("__v", edges, accuracy).alias("__e"))
    # Two rows on either side must fit into the margin beside the sketch's error; smaller keys are sorted whole.
    edge = lambda p, s, end: F.when(F.lit(0 < p + s < 1) & (F.col("__n") >= 2 * accuracy), F.col("__e")[edges.index(min(1.0, max(0.0, p + s)))]).otherwise(F.col(end))
    brackets = sketch.select(*by, "__n", F.explode(F.array(*[F.struct(F.lit(n).alias("q"), F.lit(float(p)).alias("p"), edge(p, -margin, "__min").alias("lo"), edge(p, margin, "__max").alias("hi")) for n, p in zip(names, points, strict=True)])).alias("b")).select(*by, "__n", "b.*")
    joined = _same_key(given, brackets, by)
    outside = F.when(F.col("__v") < F.col("lo"), F.lit(None).cast("double")).otherwise(F.col("__v"))
    counted = joined.filter("__v <= hi").groupBy(*by, "q", "p", "__n", outside.alias("__v")).agg(F.count(F.lit(1)).alias("__c"))
    # Values below the bracket are the one null row, which sorts first.
    upto = F.sum("__c").over(Window.partitionBy(*by, "q").orderBy(F.col("__v").asc_nulls_first()))
    at = (F.col("__n") - 1) * F.col("p")
    ranked = counted.withColumn("__u", upto).withColumn("__lo", F.floor(at)).withColumn("__hi", F.ceil(at)).filter("__v is not null")
    holds = lambda rank: F.min(F.when(F.col("__u") > F.col(rank), F.col("__v")))
    found = ranked.groupBy(*by, "q").agg(holds("__lo").alias("a"), holds("__hi").alias("b"), F.first("__n").alias("__n"), F.first("p").alias("p"))
    share = (F.col("__n") - 1) * F.col("p") - F.floor((F.col("__n") - 1) * F.col("p"))
    wide = found.groupBy(*by).agg(*[F.max(F.when(F.col("q") == n, F.col("a") + (F.col("b") - F.col("a")) * share)).alias(n) for n in names])
    keys = rows.groupBy(*by).agg(F.count("__v").alias("n"))
    return _same_key(keys, wide, by, "left").select(*key, "n", *names)


def weighted_median(df: DataFrame, by: list[str], value: str, weight: str, name: str = "median") -> DataFrame:
    """Median of values that stand for ``weight`` rows each: the middle two of the counted order, averaged."""
    w = Window.partitionBy(*by)
    ran = df.filter(F.col(weight) > 0).withColumn("__u", F.sum(weight).over(w.orderBy(value).rangeBetween(Window.unboundedPreceding, 0))).withColumn("__n", F.sum(weight).over(w))
    holds = lambda rank: F.min(F.when(F.col("__u") > rank, F.col(value)))
    return ran.groupBy(*by).agg(((holds(F.floor((F.col("__n") - 1) / 2)) + holds(F.floor(F.col("__n") / 2))) / 2).alias(name), F.sum(weight).alias("n"))


def locus_ratio(depth: DataFrame, by: list[str], kind: str, value: str, threshold: float = 1.5, calibration: Column | None = None) -> DataFrame:
    """Median depth of each locus over the backbone's median, with MAD and call.

    ``kind`` is null for backbone rows.  The backbone's statistics join every
    locus of their key, which is one row per key.  The call is that of the
    ratio itself; where an interval is at hand, ``copy_number.depth_ratio``
    calls by its low bound.
    """
    base = robust(depth.filter(F.col(kind).isNull()), by, value).select(*by, F.col("median").alias("backbone_median"), F.col("mad").alias("backbone_mad"), F.col("n").alias("backbone_n"))
    locus = depth.filter(F.col(kind).isNotNull()).groupBy(*by, kind).agg(F.median(value).alias("locus_median"), F.count(F.lit(1)).alias("locus_n"))
    joined = locus.join(base, by, "left") if by else locus.crossJoin(F.broadcast(base))
    ratio = F.when(F.col("backbone_median") > 0, F.col("locus_median") / F.col("backbone_median"))
    return joined.withColumn("ratio", ratio).withColumn("depth_call", depth_call(ratio, F.col("backbone_median"), call_threshold(threshold, calibration)["value"]))
