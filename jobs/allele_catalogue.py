"""Incremental job: a catalogue of the alleles seen in contigs that keep arriving.

    python -m jobs.allele_catalogue --contigs FOLDER --known PATH --output PATH [--config FILE]

Every line of a contig's sequence column is a candidate.  Candidates of
``min_bp`` to ``max_bp`` bases are one allele if they, or their reverse
complements, are equal.  A run takes the files that have come into ``contigs``
since the last one (a file stream, ``availableNow``, with its checkpoint in
``output``/checkpoint), adds up their sightings in ``output``/sightings under
the number of the batch, and then writes the catalogue anew from all sightings.

A batch that is repeated after a failure replaces its own folder, so nothing
counts twice; a run without new files writes the same catalogue again.  What
is kept of each batch is one row an allele, sample and share of the contigs
(``SHARES``, by a hash of their names), so the catalogue is made from distinct
alleles and not from contigs.  Sequences are what there is to move: each is
shuffled once on its way into ``sightings`` and once into the catalogue.

``catalogue`` is partitioned by disposition: ``accepted`` for alleles equal to
a known one, ``review`` for others seen in ``min_samples`` samples or more,
``hold`` for the rest.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs.common import bases, command, log, name_of
from strandloom.functions import sequence as S

DEFAULTS = Path(__file__).with_suffix(".json")
#: Tasks that an allele of very many contigs of one sample is dealt to.
SHARES = 16
SIGHTINGS = "signature string, sample string, sightings long, contigs long, first_contig string, allele string, batch long"
CATALOGUE = "signature string, allele string, length int, gc_percent double, known_id string, sightings long, contigs long, n_samples long, first_contig string, disposition string"


def alleles(rows: DataFrame, names: dict, seq: str, letters: bool, least: int, most: int) -> DataFrame:
    """The candidates of each row: its names and the allele, the lesser of both strands."""
    line = rows.select(*[F.col(c).alias(n) for n, c in names.items()], F.explode(F.split(F.col(seq).cast("string"), "\n")).alias("line"))
    found = line.select(*names, bases("line", letters).alias("seq")).filter(F.length("seq").between(least, most))
    return found.select(*names, F.least("seq", S.reverse_complement("seq")).alias("allele"))


def sightings_of(contigs: DataFrame, config: dict) -> DataFrame:
    """One row an allele, sample and share of its contigs: how often and in how many contigs it is, and the least of those."""
    named = contigs.withColumns({"__sample": name_of(config["sample"]), "__contig": F.col(config["contig"]).cast("string")})
    found = alleles(named, {"sample": "__sample", "contig": "__contig"}, config["seq"], config["letters"], int(config["min_bp"]), int(config["max_bp"]))
    # Shares hold different contigs, so their counts add up; both sums are made where the one shuffle has brought them.
    met = found.withColumn("share", F.pmod(F.xxhash64("contig"), F.lit(SHARES))).repartition("allele", "sample", "share")
    each = met.groupBy("allele", "sample", "share", "contig").agg(F.count(F.lit(1)).alias("sightings"))
    per = each.groupBy("allele", "sample", "share").agg(F.sum("sightings").alias("sightings"), F.count(F.lit(1)).alias("contigs"), F.min("contig").alias("first_contig"))
    return per.select(F.sha2("allele", 256).alias("signature"), "sample", "sightings", "contigs", "first_contig", "allele")


def catalogue_of(sightings: DataFrame, known: DataFrame, min_samples: int) -> DataFrame:
    """All sightings as a catalogue; ``known`` has allele and known_id (one row an allele)."""
    total = lambda c: F.sum(c).alias(c)
    per = sightings.repartition("allele").groupBy("allele", "sample").agg(total("sightings"), total("contigs"), F.min("first_contig").alias("first_contig"))
    every = per.groupBy("allele").agg(total("sightings"), total("contigs"), F.count(F.lit(1)).alias("n_samples"), F.min("first_contig").alias("first_contig"))
    out = every.join(known, "allele", "left")
    role = F.when(F.col("known_id").isNotNull(), "accepted").when(F.col("n_samples") >= min_samples, "review").otherwise("hold")
    return out.select(F.sha2("allele", 256).alias("signature"), "allele", F.length("allele").alias("length"), S.gc_percent("allele").alias("gc_percent"), "known_id", "sightings", "contigs", "n_samples", "first_contig", role.alias("disposition"))


def pattern(path: str) -> str:
    """The path as a pattern that only it matches: file streams take a single file by pattern only, and folders either way."""
    path = path.rstrip("/")
    return path if set(path) & set("*?[{") else f"{path[:-1]}[{path[-1]}]"


def run(spark: SparkSession, config: dict) -> dict:
    """Take in what is new, write the catalogue, and return the numbers of rows that were read and written."""
    out = config["output"].rstrip("/")
    stream = spark.readStream.schema(spark.read.parquet(config["contigs"]).schema).parquet(pattern(config["contigs"]))

    def take(batch: DataFrame, number: int) -> None:
        rows = sightings_of(batch, config).withColumn("batch", F.lit(number).cast("long"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{out}/sightings")

    query = stream.writeStream.foreachBatch(take).option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    new = sum(p.numInputRows for p in query.recentProgress)
    # Nothing, appended, makes the table readable where no batch has come yet.
    spark.createDataFrame([], SIGHTINGS).write.mode("append").partitionBy("batch").parquet(f"{out}/sightings")
    named = spark.read.parquet(config["known"]).withColumn("__id", F.col(config["known_id"]).cast("string"))
    known = alleles(named, {"known_id": "__id"}, config["known_seq"], config["letters"], int(config["min_bp"]), int(config["max_bp"])).groupBy("allele").agg(F.min("known_id").alias("known_id"))
    seen = spark.read.schema(SIGHTINGS).parquet(f"{out}/sightings")
    catalogue_of(seen, known, int(config["min_samples"])).write.mode("overwrite").partitionBy("disposition").parquet(f"{out}/catalogue")
    counts = {"new_contigs": new, "sightings": seen.count(), "alleles": read(spark, out).count()}
    log.info("allele_catalogue: read %(new_contigs)s new contigs; %(sightings)s sightings are held; wrote %(alleles)s alleles", counts)
    return counts


def read(spark: SparkSession, output: str) -> DataFrame:
    """The catalogue of the last run."""
    return spark.read.schema(CATALOGUE).parquet(f"{output.rstrip('/')}/catalogue")


if __name__ == "__main__":
    command("allele-catalogue", DEFAULTS, run)
