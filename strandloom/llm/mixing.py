"""Mixing sources to target weights, by DataFrame functions alone.

Every source's documents lie end to end in a stream of words, which is cut
into blocks of ``block`` words.

First the number of blocks of every source in every output shard is drawn,
multinomially *given the sources' totals*: each block that a source owes draws
its shard, and the draws are counted.  Free multinomial draws would let a
source exceed two passes or miss its target; conditioned ones meet it exactly,
the last block being cut.  Then a shard's counts become slots: a shard holds
the numbers of a source that follow those of the shards before it, and slot j
of a source takes the block that a pseudorandom permutation of the source's
block numbers names, so that a pass takes every block once and a second pass
repeats it.  Blocks and documents meet in an equi-join on (source, block).

Positions in the streams come from two small sums, never from one window over
a source: documents are first put into buckets by a hash, buckets get their
offset from a table of (source, bucket) sums, and documents theirs from a
window inside the bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.llm.common import Scratch, parallelism

#: Weights of the sources in their order, repeating; share of all words to draw; passes that a source may make.
WEIGHTS, SHARE, PASSES = (5.0, 2.0, 1.0), 1.5, 2.0


#: Hash buckets that order a source's documents: a fixed number, so that the mix is the same on any cluster.
BUCKETS = 4096
#: Numbers that one row is expanded to at once; sources whose plan may be broadcast (about 100 bytes each).
PIECE, MAX_SOURCES = 65_536, 10_000


def word_count(text: Column) -> Column:
    """Runs without ASCII white space; a null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, passes: float = PASSES) -> DataFrame:
    """(source, source_size) to targets: the draw is shared by weight, no target exceeds ``passes`` times its source.

    What is above is reshared by weight among the others until none is above.
    That fixed point is a water level: sources whose limit per weight is below
    the level stop at their limit, the others get level times weight.  Works on
    one row a source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    table = sizes.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(passes)).withColumn("rate", F.col("most") / F.col("weight"))
    below = Window.orderBy("rate", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    table = table.withColumn("total", F.sum("source_size").over(every)).withColumn("all_weight", F.sum("weight").over(every))
    table = table.withColumn("used", F.coalesce(F.sum("most").over(below), F.lit(0.0))).withColumn("gone", F.coalesce(F.sum("weight").over(below), F.lit(0.0)))
    level = (F.col("total") * F.lit(share) - F.col("used")) / (F.col("all_weight") - F.col("gone"))
    table = table.withColumn("candidate", F.when(level <= F.col("rate"), level))
    table = table.withColumn("level", F.max("candidate").over(every))
    return table.select("source", "source_size", "weight", F.when(F.col("level").isNull(), F.col("most")).otherwise(F.least(F.col("most"), F.col("level") * F.col("weight"))).alias("target"))


def _scramble(index: Column, size: Column, step: Column) -> Column:
    """A permutation of 0..size-1 for a step prime to size; the last index stays the last."""
    return F.pmod((index + 1) * step - 1, size)


def _unit(size: Column, seed: Column) -> Column:
    """A number that is prime to ``size``: the first of some hashed candidates, and 1 if there is none.

    Candidates are below 2**31 and so small that their product with ``size`` stays a long.
    """
    most = F.least(size, F.lit(1 << 31), F.floor(F.lit(1 << 61) / F.greatest(size, F.lit(1))).cast("long"))
    wish = F.transform(F.sequence(F.lit(1), F.lit(24)), lambda k: F.pmod(F.xxhash64(seed, k), F.greatest(most, F.lit(1))))

    def coprime(x: Column) -> Column:
        # Euclid's algorithm in a fold; 48 steps are enough where the lesser number is below 2**31.
        start = F.struct(size.cast("long").alias("a"), x.cast("long").alias("b"))
        end = F.aggregate(F.sequence(F.lit(1), F.lit(48)), start, lambda s, _: F.struct(F.when(s.b == 0, s.a).otherwise(s.b).alias("a"), F.when(s.b == 0, F.lit(0).cast("long")).otherwise(F.pmod(s.a, F.when(s.b == 0, F.lit(1)).otherwise(s.b))).alias("b")))
        return end.a == 1

    return F.coalesce(F.element_at(F.filter(wish, coprime), 1), F.lit(1)).cast("long")


def stream(docs: DataFrame, text: str, doc_id: str, source: str, buckets: int) -> DataFrame:
    """One row a document: doc_id, source, size and the offset of its first word in its source's stream."""
    sized = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), word_count(F.col(text).cast("string")).alias("size"), F.xxhash64(F.col(text).cast("string")).alias("mark"))
    return sized.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "mark"), F.lit(buckets)).cast("int"))


def _few(plan: DataFrame, side: DataFrame) -> DataFrame:
    """The side of one row a source, broadcast where sources are few."""
    return F.broadcast(side) if plan.limit(MAX_SOURCES + 1).count() <= MAX_SOURCES else side


def mix(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", block: int = 64, shards: int = 64, seed: int = 17, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, passes: float = PASSES) -> tuple[DataFrame, DataFrame]:
    """(documents, pieces) of the mix.

    documents: one row per input row with doc_id, source, size (words), offset
    in the source's stream, source_size and target.  pieces: one row for each
    document and slot that takes words of it, with shard, source, slot, block,
    doc_id, row (the document's row key), first (first word taken) and words.

    Null text: no words; a document without words is in no piece.  A null
    source is a source of its own, ordered last.  Rows that repeat an id are
    documents of their own.  An empty table gives two empty results.  Other
    columns are not read, whatever their names.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    rows = scratch.keep("rows", stream(docs, text, doc_id, source, BUCKETS))
    bucket = scratch.keep("buckets", rows.groupBy("source", "bucket").agg(F.sum("size").alias("n")))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = bucket.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    plan = targets(bucket.groupBy("source").agg(F.sum("n").alias("source_size")), weights, share, passes)
    blocks = F.ceil(F.col("source_size") / F.lit(block)).cast("long")
    plan = plan.withColumn("blocks", blocks).withColumn("goal", F.least(F.round("target").cast("long"), (F.col("source_size") * F.lit(passes)).cast("long")))
    # Blocks owed: whole passes, and those that the rest of the goal begins; the short last block comes last in a pass.
    whole = F.floor(F.col("goal") / F.greatest("source_size", F.lit(1))).cast("long")
    plan = plan.withColumn("owed", whole * F.col("blocks") + F.ceil((F.col("goal") - whole * F.col("source_size")) / F.lit(block)).cast("long"))
    plan = scratch.keep("plan", plan.withColumn("step", _unit(F.greatest("blocks", F.lit(1)), F.concat_ws(":", F.lit(seed), F.coalesce("source", F.lit("\0"))))))
    inside = Window.partitionBy("source", "bucket").orderBy("doc_id", "mark").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("ahead", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    # Rows of one bucket with equal id and text lie in any order: they are alike.
    joined = placed.join(offsets.withColumnRenamed("source", "s").withColumnRenamed("bucket", "b"), F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))).drop("s", "b")
    joined = joined.join(_few(plan, plan.withColumnRenamed("source", "s")), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    documents = scratch.keep("documents", joined.select("doc_id", "source", "size", (F.col("base") + F.col("ahead")).alias("offset"), "source_size", "target"))

    # Draws: every block that a source owes draws its shard, in pieces that spread over tasks; only counts are kept.
    def pieces_of(df: DataFrame, count: str) -> DataFrame:
        piece = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(count) - 1) / PIECE).cast("long")))
        return df.filter(F.col(count) > 0).withColumn("p", piece).repartition(parallelism(spark), "source", "p")

    def numbers(count: str) -> Column:
        return F.explode(F.sequence(F.col("p") * PIECE, F.least((F.col("p") + 1) * PIECE, F.col(count)) - 1))

    drawn = pieces_of(plan.select("source", "owed"), "owed").select("source", numbers("owed").alias("j"))
    counts = drawn.groupBy("source", F.pmod(F.xxhash64(F.lit(seed), "source", "j"), F.lit(shards)).cast("int").alias("shard")).agg(F.count(F.lit(1)).alias("count"))
    earlier = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = scratch.keep("counts", counts.withColumn("from", F.coalesce(F.sum("count").over(earlier), F.lit(0))))
    # Slots: a shard's numbers of a source, and the blocks that the permutation gives them.
    mine = counts.join(_few(plan, plan.select("source", "source_size", "blocks", "goal", "step").withColumnRenamed("source", "s")), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    slots = pieces_of(mine, "count").select("source", "shard", "source_size", "blocks", "goal", "step", "from", numbers("count").alias("j")).withColumn("slot", F.col("from") + F.col("j")).drop("from", "j")
    turn, rank = F.floor(F.col("slot") / F.col("blocks")).cast("long"), F.pmod("slot", "blocks")
    slots = slots.withColumn("block", _scramble(rank, F.col("blocks"), F.col("step")))
    size = F.least(F.lit(block), F.col("source_size") - F.col("block") * F.lit(block))
    left = F.col("goal") - turn * F.col("source_size") - rank * F.lit(block)
    slots = slots.select("source", "shard", "slot", "block", F.least(left, size).alias("take"))

    long_docs = documents.filter("size > 0").withColumn("block", F.explode(F.sequence(F.floor(F.col("offset") / block), F.floor((F.col("offset") + F.col("size") - 1) / block))))
    lo = F.greatest(F.col("offset"), F.col("block") * block)
    hi = F.least(F.col("offset") + F.col("size"), F.col("block") * block + F.col("take"))
    # Both sides are numbers that grew out of few rows, so Spark would take either for small and broadcast it: their sizes grow with the corpus.
    pieces = long_docs.select("doc_id", F.col("source").alias("s"), "offset", "size", F.col("block").alias("k")).hint("merge").join(slots.hint("merge"), F.col("s").eqNullSafe(F.col("source")) & (F.col("k") == F.col("block"))).filter(hi > lo)
    scratch.drop("rows", "buckets")
    return documents, pieces.select("shard", "source", "slot", "block", "doc_id", F.col("offset").alias("row"), (lo - F.col("offset")).alias("first"), (hi - lo).alias("words"))


def taken(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken (its words in the mix, repeats counted), source.

    Null, repeated and empty rows are as in ``mix``: each row has its own
    result, and a document without words takes none.
    """
    documents, pieces = mix(docs, **options)
    sums = pieces.groupBy("source", "row").agg(F.sum("words").alias("taken")).withColumnRenamed("source", "s")
    out = documents.join(sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("offset") == F.col("row")) & (F.col("size") > 0), "left")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "source")
