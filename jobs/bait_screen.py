"""Batch job: which known alleles (baits) of a catalogue lie in the contigs of many samples.

    python -m jobs.bait_screen --contigs PATH --baits PATH --output PATH [--config FILE]

Reads a table of contigs (sample, contig, sequence) and one of baits (id,
sequence).  Baits that cannot be in a catalogue, or are shorter than k, are
written to ``rejected`` and take no part.  A contig holds a bait as far as it
holds the bait's k-mers, all on one strand; contigs with at least
``min_containment`` of them are hits.  Written below ``output``, as Parquet:

``hits``      by sample: contig, bait, strand, k-mers found and in all, and
              whether another bait is within ``margin`` of the contig's best;
``report``    by sample: each bait's best containment, contig and status, and
              how many contigs hold it wholly or partly;
``rejected``  baits that were left out, and why.

A run replaces what it wrote before, so it can be repeated at any time.  Rows
of one sample and contig name are one contig.  Only the k-mers that baits have
leave the scan of the contigs, and they are dealt by contig; samples are added
up in part before they are shuffled, so a sample with most of the contigs
stays in no single task.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobs.common import bases, command, log, name_of
from strandloom.functions import sequence as S
from strandloom.operators import kmers, quality_control

DEFAULTS = Path(__file__).with_suffix(".json")
#: k-mers of baits that may be broadcast, with the baits that have them.
MAX_BROADCAST = 500_000
HITS = "contig string, bait string, strand string, found long, n_kmers long, containment double, ambiguous boolean, sample string"
REPORT = "bait string, status string, best_containment double, best_contig string, n_whole long, n_partial long, sample string"
REJECTED = "bait string, problem string"


def baits_of(table: DataFrame, bait: str, seq: str, letters: bool, k: int) -> tuple[DataFrame, DataFrame]:
    """(bait, seq) of the baits that can be screened, and (bait, problem) of the others."""
    rows = table.select(F.col(bait).cast("string").alias("bait"), bases(seq, letters).alias("seq"))
    wrong = quality_control.catalogue_problems(rows, "bait", "seq").select(F.col("seq_id").alias("bait"), "problem")
    nameless = rows.filter("bait is null").select("bait", F.lit("no id").alias("problem"))
    short = rows.join(wrong, "bait", "left_anti").filter(F.col("bait").isNotNull() & (F.length("seq") < k)).select("bait", F.lit("shorter than a k-mer").alias("problem"))
    bad = wrong.filter("bait is not null").unionByName(nameless).unionByName(short).distinct()
    return rows.filter("bait is not null").join(bad, "bait", "left_anti"), bad


def strand_kmers(baits: DataFrame, k: int) -> DataFrame:
    """(g, on): every k-mer of a bait as contigs may hold it, with the (bait, strand) pairs that have it."""
    both = baits.select("bait", F.explode(F.array(F.struct(F.lit("+").alias("strand"), F.col("seq").alias("seq")), F.struct(F.lit("-").alias("strand"), S.reverse_complement("seq").alias("seq")))).alias("x"))
    each = both.select("bait", "x.strand", F.explode(S.kmers("x.seq", k)).alias("g"))
    return each.groupBy("g").agg(F.sort_array(F.collect_list(F.struct("bait", "strand"))).alias("on"))


def hits_of(contigs: DataFrame, baits: DataFrame, k: int, min_containment: float, margin: float) -> DataFrame:
    """Contigs (sample, contig, seq) with enough of a bait's k-mers on its better strand (plus, if both are equal)."""
    index = strand_kmers(baits, k)
    size = baits.select("bait", F.size(S.kmers("seq", k)).cast("long").alias("n_kmers"))
    few = index.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST
    named = contigs.select(F.to_json(F.struct("sample", "contig"), {"ignoreNullFields": "false"}).alias("key"), "seq")
    seen = kmers.known_kmers(named, "key", "seq", index.select("g"), k).distinct()
    met = seen.join(F.broadcast(index) if few else index, "g").select("key", F.explode("on").alias("on"))
    counted = met.groupBy("key", "on.bait", "on.strand").agg(F.count(F.lit(1)).alias("found"))
    better = counted.groupBy("key", "bait").agg(F.max(F.struct("found", F.when(F.col("strand") == "+", 1).otherwise(0).alias("plus"))).alias("x"))
    rows = better.join(size, "bait").select("key", "bait", F.when(F.col("x.plus") == 1, "+").otherwise("-").alias("strand"), "x.found", "n_kmers", (F.col("x.found") / F.col("n_kmers")).alias("containment"))
    rows = rows.filter(F.col("containment") >= min_containment)
    # The baits of one contig: no more than the catalogue has.
    mine = Window.partitionBy("key")
    close = F.count_if(F.col("containment") >= F.col("top") - margin).over(mine) > 1
    rows = rows.withColumn("top", F.max("containment").over(mine)).withColumn("ambiguous", close & (F.col("containment") >= F.col("top") - margin))
    name = F.from_json("key", "sample string, contig string")
    return rows.select(name["contig"].alias("contig"), "bait", "strand", "found", "n_kmers", "containment", "ambiguous", name["sample"].alias("sample"))


def report_of(hits: DataFrame) -> DataFrame:
    """A row for every sample and bait with a hit; the best contig is the least name among equally good ones."""
    whole = F.col("found") == F.col("n_kmers")
    best = F.min_by(F.struct("containment", "contig"), F.struct(-F.col("containment"), F.col("contig")))
    out = hits.groupBy("sample", "bait").agg(best.alias("b"), F.count_if(whole).alias("n_whole"), F.count_if(~whole).alias("n_partial"))
    status = F.when(F.col("n_whole") > 1, "PRESENT_MULTIPLE").when(F.col("n_whole") == 1, "PRESENT").otherwise("PARTIAL")
    return out.select("bait", status.alias("status"), F.col("b.containment").alias("best_containment"), F.col("b.contig").alias("best_contig"), "n_whole", "n_partial", "sample")


def run(spark: SparkSession, config: dict) -> dict:
    """Screen, write, and return the numbers of rows that were read and written."""
    k, out = int(config["k"]), config["output"].rstrip("/")
    contigs = spark.read.parquet(config["contigs"]).select(name_of(config["sample"]).alias("sample"), F.col(config["contig"]).cast("string").alias("contig"), bases(config["contig_seq"], config["letters"]).alias("seq"))
    table = spark.read.parquet(config["baits"])
    baits, bad = baits_of(table, config["bait"], config["bait_seq"], config["letters"], k)
    bad.write.mode("overwrite").parquet(f"{out}/rejected")
    hits = hits_of(contigs, baits, k, float(config["min_containment"]), float(config["margin"]))
    # A folder a sample: rows are brought together by it, and a sample with very many is split again.
    hits.hint("rebalance", F.col("sample")).write.mode("overwrite").partitionBy("sample").parquet(f"{out}/hits")
    written = read(spark, out, "hits")
    report_of(written).write.mode("overwrite").partitionBy("sample").parquet(f"{out}/report")
    counts = {"contigs": contigs.count(), "baits": table.count(), "rejected": read(spark, out, "rejected").count(), "hits": written.count(), "report": read(spark, out, "report").count()}
    log.info("bait_screen: read %(contigs)s contigs and %(baits)s baits; wrote %(rejected)s rejected baits, %(hits)s hits, %(report)s rows of the report", counts)
    return counts


def read(spark: SparkSession, output: str, table: str) -> DataFrame:
    """A table of a run; an explicit schema keeps sample names text."""
    return spark.read.schema({"hits": HITS, "report": REPORT, "rejected": REJECTED}[table]).parquet(f"{output.rstrip('/')}/{table}")


if __name__ == "__main__":
    command("bait-screen", DEFAULTS, run)
