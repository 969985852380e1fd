"""Interval algebra on DataFrames.

``by`` names the key columns.  Intervals are closed on both ends unless a
function says otherwise.  Merging is gaps-and-islands: one shuffle on the key
and a sort, no self-join.  Range joins deal both sides to bins of a fixed
width, so that a key with many positions spreads over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.operators import scans


def with_island(df: DataFrame, by: list[str], start: str, end: str, gap: int = 1, name: str = "island", keep: scans.Keep | None = None) -> DataFrame:
    """Number the islands of each key: a row joins while its start is at most ``gap`` beyond all ends before it.

    A key's rows meet in one task; with ``keep``, which stores rows, they are
    dealt by ranges instead, and a key may be of any size.
    """
    if keep:
        return scans.islands(scans.dealt(df, by, [start, end], keep, f"{name}-ranges"), by, start, end, gap, name).drop(scans.RANGE)
    order = Window.partitionBy(*by).orderBy(start, end)
    before = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(before.isNull() | (F.col(start) > before + gap), 1).otherwise(0)
    return df.withColumn("__fresh", fresh).withColumn(name, F.sum("__fresh").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("__fresh")


def merge(df: DataFrame, by: list[str], start: str, end: str, gap: int = 1, keep: scans.Keep | None = None) -> DataFrame:
    """Islands with their bounds and number of members; ``keep`` as in ``with_island``."""
    return with_island(df, by, start, end, gap, keep=keep).groupBy(*by, "island").agg(F.min(start).alias(start), F.max(end).alias(end), F.count(F.lit(1)).alias("members")).drop("island")


def pad(df: DataFrame, start: str, end: str, by: int, length: str | Column | None = None) -> DataFrame:
    """Widen by ``by`` on both sides, within 1 and the length."""
    limit = F.col(length) if isinstance(length, str) else length
    wide = F.col(end) + by
    return df.withColumn(start, F.greatest(F.col(start) - by, F.lit(1))).withColumn(end, F.least(wide, limit) if limit is not None else wide)


def coverage(df: DataFrame, by: list[str], start: str, end: str) -> DataFrame:
    """Total, union and overlapping length per key."""
    total = df.groupBy(*by).agg(F.sum(F.col(end) - F.col(start) + 1).alias("total_length"))
    union = merge(df, by, start, end).groupBy(*by).agg(F.sum(F.col(end) - F.col(start) + 1).alias("union_length"))
    return total.join(union, by).withColumn("overlap_length", F.col("total_length") - F.col("union_length"))


def segments(df: DataFrame, by: list[str], start: str, end: str) -> DataFrame:
    """Maximal segments of constant multiplicity: boundary events and a running sum."""
    events = df.select(*by, F.explode(F.array(F.struct(F.col(start).alias("at"), F.lit(1).alias("step")), F.struct((F.col(end) + 1).alias("at"), F.lit(-1).alias("step")))).alias("e")).select(*by, "e.at", "e.step")
    steps = events.groupBy(*by, "at").agg(F.sum("step").alias("step"))
    order = Window.partitionBy(*by).orderBy("at")
    ran = steps.withColumn("multiplicity", F.sum("step").over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("after", F.lead("at").over(order))
    return ran.filter("after is not null and multiplicity > 0").select(*by, F.col("at").alias("start"), (F.col("after") - 1).alias("end"), "multiplicity")


def dosage(df: DataFrame, by: list[str], start: str, end: str) -> DataFrame:
    """Mean and greatest multiplicity over covered positions, from segments alone."""
    size = F.col("end") - F.col("start") + 1
    return segments(df, by, start, end).groupBy(*by).agg((F.sum(size * F.col("multiplicity")) / F.sum(size)).alias("dosage"), F.max("multiplicity").alias("max_multiplicity"), F.sum(size).alias("covered"))


def rich_windows(df: DataFrame, by: list[str], start: str, end: str, width: int, least: int = 2) -> DataFrame:
    """Per window of fixed width: covered positions, those with multiplicity of at least ``least``, and their share.

    Segments are cut at window bounds, so no position is listed.
    """
    tile = F.explode(F.sequence(F.floor(F.col("start") / width), F.floor(F.col("end") / width)))
    cut = segments(df, by, start, end).withColumn("tile", tile)
    size = F.least(F.col("end"), (F.col("tile") + 1) * width - 1) - F.greatest(F.col("start"), F.col("tile") * width) + 1
    out = cut.groupBy(*by, "tile").agg(F.sum(size).alias("covered"), F.sum(F.when(F.col("multiplicity") >= least, size).otherwise(0)).alias("rich"))
    return out.withColumn("share", F.col("rich") / F.col("covered"))


def range_join(points: DataFrame, spans: DataFrame, by: list[str], at: str, start: str, end: str, width: int, how: str = "inner") -> DataFrame:
    """Points with the spans that hold them; ``how`` may be inner, left_semi or left_anti.  ``spans`` repeat per bin of ``width``."""
    left = points.withColumn("__bin", F.floor(F.col(at) / width))
    right = spans.select(*[F.col(c).alias(f"__{c}") for c in by], *[c for c in spans.columns if c not in by], F.explode(F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width))).alias("__at_bin"))
    cond = (F.col("__bin") == F.col("__at_bin")) & F.col(at).between(F.col(start), F.col(end))
    for c in by:
        cond &= F.col(c) == F.col(f"__{c}")
    out = left.join(right, cond, how)
    return out.drop("__bin", "__at_bin", *[f"__{c}" for c in by])


def continuation(lost: DataFrame, hits: DataFrame, by: list[str]) -> DataFrame:
    """The hit on another subject that covers most of each lost query interval.

    ``lost`` has subject, start and end; ``hits`` has subject, qstart and qend.
    """
    other = hits.select(*by, F.col("subject").alias("other"), "qstart", "qend")
    size = F.greatest(F.least("end", "qend") - F.greatest("start", "qstart") + 1, F.lit(0))
    near = lost.join(other, by).filter("other <> subject and qstart <= end and qend >= start").withColumn("overlap", size)
    per = near.groupBy(*by, "subject", "start", "end", "other").agg(F.sum("overlap").alias("recovered"))
    return per.groupBy(*by, "subject", "start", "end").agg(F.max_by(F.struct("other", "recovered"), F.struct("recovered", F.reverse("other"))).alias("c")).select(*by, "subject", "start", "end", "c.other", "c.recovered")
