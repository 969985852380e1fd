"""Seeded data for tests of a workflow: run manifests, read pairs, mixtures, subsamples and substitutions.

Every draw is a hash of the seed and of the row's own names, so it does not
depend on partitions and a lost task gives the same rows again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.functions.sequence import reverse_complement, seed_for
from strandloom.operators.intervals import merge

_WHOLE = 1 << 32


def draw(*parts: str | Column) -> Column:
    """A number in [0, 1) fixed by its parts, null parts as empty texts."""
    text = F.concat_ws(":", *[F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / _WHOLE


def manifest(spark: SparkSession, factors: Mapping[str, Sequence], replicates: int = 1) -> DataFrame:
    """All combinations of given factor levels and replicates, each with a run id and a seed.

    The levels are parameters, so the table is as long as their product.
    """
    out = spark.range(1).select(F.lit("").alias("__run"))
    for name, levels in factors.items():
        out = out.select("*", F.explode(F.array(*[F.lit(v) for v in levels])).alias(name))
    out = out.select("*", F.explode(F.sequence(F.lit(1), F.lit(replicates))).alias("replicate")).drop("__run")
    run = F.concat_ws("_", *[F.col(c).cast("string") for c in [*factors, "replicate"]])
    return out.withColumn("run_id", run).withColumn("seed", seed_for(run))


def substitute(seq: str | Column, rate: float, *names: str | Column) -> Column:
    """The sequence with each of A, C, G and T replaced by another base at a rate."""
    s = F.col(seq) if isinstance(seq, str) else seq
    # A hash that is cheap for each base; ``draw`` is for rows.
    roll = lambda *parts: F.pmod(F.xxhash64(*names, *parts), F.lit(_WHOLE)) / _WHOLE

    def base(c: Column, i: Column) -> Column:
        others = F.replace(F.lit("ACGT"), c, F.lit(""))
        at = F.floor(roll(i, F.lit("which")) * 3).cast("int") + 1
        return F.when((roll(i) < rate) & c.isin("A", "C", "G", "T"), F.substring(others, at, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.split(s, ""), base), "")


def read_pairs(genomes: DataFrame, seq_id: str, seq: str, coverage: Column, seed: int, read: int = 100, insert: int = 300, jitter: int = 8, error: float = 0.0) -> DataFrame:
    """Pairs spread evenly over each sequence, every second one from the other strand.

    A sequence shorter than ``insert`` or null gives none.  The sequence is cut
    where its row lies; only the pairs leave.
    """
    span = F.length(seq) - insert
    pairs = F.greatest(F.lit(1), F.ceil(coverage * F.length(seq) / (2 * read))).cast("int")
    rows = genomes.filter(F.length(seq) >= insert).filter(coverage > 0).withColumn("__n", pairs).withColumn("__max", span).withColumn("pair", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
    even = F.when(F.col("__n") > 1, F.col("pair") * F.col("__max") / (F.col("__n") - 1)).otherwise(F.col("__max") / 2)
    moved = F.when(F.col("__n") > 1, F.floor(draw(F.lit(seed), seq_id, "pair") * (2 * jitter + 1)) - jitter).otherwise(0)
    rows = rows.withColumn("start", F.greatest(F.lit(0), F.least(F.col("__max"), F.round(even + moved).cast("int"))))
    left = F.substring(F.col(seq), F.col("start") + 1, F.lit(read))
    right = reverse_complement(F.substring(F.col(seq), F.col("start") + insert - read + 1, F.lit(read)))
    odd = F.col("pair") % 2 == 1
    first, second = F.when(odd, right).otherwise(left), F.when(odd, left).otherwise(right)
    name = F.format_string("%s_%06d_%d", F.col(seq_id), F.col("pair"), F.col("start"))
    out = rows.select(seq_id, name.alias("name"), F.col("start"), first.alias("read_1"), second.alias("read_2"))
    if not error:
        return out
    return out.withColumn("read_1", substitute("read_1", error, F.lit(seed), "name", F.lit(1))).withColumn("read_2", substitute("read_2", error, F.lit(seed), "name", F.lit(2)))


def subsample(reads: DataFrame, name: str, fraction: float, seed: int) -> DataFrame:
    """A share of the pairs by their name without a shuffle; mates have one name, so both stay or both go."""
    return reads.filter(draw(F.lit(seed), name) < fraction)


def mixture(first: DataFrame, second: DataFrame, name: str, share_of_second: float, seed: int) -> DataFrame:
    """Rows of two read sets, the second's at a share of all it has and the first's at the rest, marked by origin."""
    a = subsample(first.withColumn("origin", F.lit("A")), name, 1 - share_of_second, seed)
    return a.unionByName(subsample(second.withColumn("origin", F.lit("B")), name, share_of_second, seed + 1))


def cut_out(sequences: DataFrame, removals: DataFrame, by: list[str], seq_id: str = "seq_id", seq: str = "seq") -> DataFrame:
    """What is left of sequences when intervals (by, seq_id, start, end; 1-based, inclusive) are taken out: one row a piece, numbered.

    Intervals may overlap, touch or reach beyond the ends; a sequence without
    any is one piece, one that is covered whole has none.
    """
    key = [*by, seq_id]
    merged = merge(removals.select(*key, "start", "end"), key, "start", "end").groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("__cuts"))
    j = sequences.join(merged, key, "left").withColumn("__cuts", F.coalesce("__cuts", F.array().cast(merged.schema["__cuts"].dataType)))
    size = F.length(seq).cast("long")
    firsts = F.concat(F.array(F.lit(1).cast("long")), F.transform("__cuts", lambda c: c["end"].cast("long") + 1))
    lasts = F.concat(F.transform("__cuts", lambda c: c["start"].cast("long") - 1), F.array(size))
    parts = F.filter(F.transform(F.arrays_zip(firsts.alias("a"), lasts.alias("b")), lambda p: F.struct(F.greatest(p["a"], F.lit(1)).alias("a"), F.least(p["b"], size).alias("b"))), lambda p: p["b"] >= p["a"])
    out = j.select(*key, seq, F.posexplode(parts).alias("piece", "__p"))
    return out.select(*key, (F.col("piece") + 1).alias("piece"), F.col("__p.a").alias("start"), F.col("__p.b").alias("end"), F.substr(F.col(seq), F.col("__p.a").cast("int"), (F.col("__p.b") - F.col("__p.a") + 1).cast("int")).alias(seq))
