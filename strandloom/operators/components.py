"""Connected components of an edge table, without collecting it anywhere."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least of the node and its neighbours."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def connected_components(edges: DataFrame, src: str, dst: str, keep: Callable[[str, DataFrame], DataFrame], max_rounds: int = 64) -> DataFrame:
    """(node, component) of every node on an edge; the component is its least node.

    Alternates the large-star and small-star steps, whose per-node work is a
    minimum that combines before the shuffle, until the edges are stars.
    ``keep(name, df)`` stores a round's edges durably and returns them; it cuts
    the lineage.  The number of rounds grows with the logarithm of the
    diameter.  Self-loops and repeated edges are allowed; null ends are ignored.
    """
    pairs = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).filter("u is not null and v is not null")
    now = keep("edges0", pairs)
    loops = now.filter("u = v").select("u")
    now = now.filter("u <> v")
    mark = None
    for n in range(1, max_rounds + 1):
        now = keep(f"edges{n}", _small_star(_large_star(now)))
        seen = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if seen == mark:
            break
        mark = seen
    else:
        raise RuntimeError("components did not settle")
    labelled = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = labelled.select(F.col("component").alias("node"), "component").unionByName(loops.select(F.col("u").alias("node"), F.col("u").alias("component")))
    return labelled.unionByName(roots).groupBy("node").agg(F.min("component").alias("component"))
