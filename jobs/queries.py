"""The jobs as queries: each runs twice into a folder of its own, and what it wrote is read back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs import allele_catalogue, bait_screen
from jobs.common import settings
from strandloom.sources.scratch import new_path


def job1_bait_screen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All hits of the benchmark's texts in the documents with their row of the report, and the baits that were left out."""
    config = settings(bait_screen.DEFAULTS, {"contigs": f"{sf_dir}/documents.parquet", "baits": f"{sf_dir}/benchmark.parquet", "output": new_path(spark, "job1-bait-screen")})
    for _ in range(2):
        bait_screen.run(spark, config)
    hits, report, rejected = (bait_screen.read(spark, config["output"], t) for t in ("hits", "report", "rejected"))
    return hits.join(report, ["sample", "bait"]).unionByName(rejected.withColumnRenamed("problem", "status"), allowMissingColumns=True)


def job2_allele_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue of the documents' lines, the benchmark's being known."""
    config = settings(allele_catalogue.DEFAULTS, {"contigs": f"{sf_dir}/documents.parquet", "known": f"{sf_dir}/benchmark.parquet", "output": new_path(spark, "job2-allele-catalogue")})
    for _ in range(2):
        allele_catalogue.run(spark, config)
    return allele_catalogue.read(spark, config["output"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"job1_bait_screen": job1_bait_screen, "job2_allele_catalogue": job2_allele_catalogue}

_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_AS = ("ACGT" * 7)[:26] * 2


def _bases(text: str) -> str:
    return f"translate(regexp_replace(coalesce({text}, ''), '[^A-Za-z]', '', 'g'), '{_LETTERS}', '{_AS}')"


_RC = lambda c: f"reverse(translate({c}, 'ACGT', 'TGCA'))"
_SAMPLE = "CASE WHEN trim(coalesce(source, '')) = '' THEN 'unnamed' ELSE trim(source) END"

SQL: dict[str, str] = {
    "job1_bait_screen": f"""
        WITH b AS (SELECT CAST(item_id AS VARCHAR) AS bait, {_bases("text")} AS seq FROM benchmark),
        p AS (SELECT bait, CASE WHEN bait IS NULL THEN 'no id' WHEN count(*) OVER (PARTITION BY bait) > 1 THEN 'repeated id' WHEN seq = '' THEN 'empty sequence' WHEN length(bait) > 50 THEN 'identifier too long' WHEN length(seq) < 31 THEN 'shorter than a k-mer' END AS problem, seq FROM b),
        bk AS (SELECT DISTINCT bait, unnest(list_transform(range(1, length(seq) - 29), lambda i: substring(seq, i, 31))) AS g FROM p WHERE problem IS NULL),
        n AS (SELECT bait, count(*) AS n_kmers FROM bk GROUP BY bait),
        i AS (SELECT bait, '+' AS strand, g FROM bk UNION ALL SELECT bait, '-', {_RC("g")} FROM bk),
        c AS (SELECT {_SAMPLE} AS sample, CAST(doc_id AS VARCHAR) AS contig, {_bases("text")} AS seq FROM documents),
        ck AS (SELECT DISTINCT sample, contig, g FROM (SELECT sample, contig, unnest(list_transform(range(1, length(seq) - 29), lambda i: substring(seq, i, 31))) AS g FROM c WHERE length(seq) >= 31)),
        f AS (SELECT sample, contig, bait, strand, count(*) AS found FROM ck JOIN i ON ck.g = i.g GROUP BY 1, 2, 3, 4),
        s AS (SELECT *, row_number() OVER (PARTITION BY sample, contig, bait ORDER BY found DESC, strand) AS place FROM f),
        h AS (SELECT sample, contig, s.bait, strand, found, n_kmers, CAST(found AS DOUBLE) / n_kmers AS containment FROM s JOIN n ON s.bait = n.bait WHERE place = 1 AND CAST(found AS DOUBLE) / n_kmers >= 0.5),
        t AS (SELECT *, max(containment) OVER (PARTITION BY sample, contig) AS top FROM h),
        a AS (SELECT *, count(*) FILTER (containment >= top - CAST(0.05 AS DOUBLE)) OVER (PARTITION BY sample, contig) > 1 AND containment >= top - CAST(0.05 AS DOUBLE) AS ambiguous FROM t),
        o AS (SELECT *, row_number() OVER (PARTITION BY sample, bait ORDER BY containment DESC, contig) AS place FROM h),
        r AS (SELECT sample, bait, CASE WHEN count(*) FILTER (found = n_kmers) > 1 THEN 'PRESENT_MULTIPLE' WHEN count(*) FILTER (found = n_kmers) = 1 THEN 'PRESENT' ELSE 'PARTIAL' END AS status, max(containment) AS best_containment,
              max(contig) FILTER (place = 1) AS best_contig, count(*) FILTER (found = n_kmers) AS n_whole, count(*) FILTER (found < n_kmers) AS n_partial FROM o GROUP BY 1, 2)
        SELECT a.sample, a.bait, a.contig, a.strand, a.found, a.n_kmers, a.containment, a.ambiguous, r.status, r.best_containment, r.best_contig, r.n_whole, r.n_partial FROM a JOIN r ON a.sample = r.sample AND a.bait = r.bait
        UNION ALL SELECT DISTINCT NULL, bait, NULL, NULL, NULL, NULL, NULL, NULL, problem, NULL, NULL, NULL, NULL FROM p WHERE problem IS NOT NULL
    """,
    "job2_allele_catalogue": f"""
        WITH l AS (SELECT {_SAMPLE} AS sample, CAST(doc_id AS VARCHAR) AS contig, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
        q AS (SELECT sample, contig, {_bases("line")} AS seq FROM l),
        a AS (SELECT sample, contig, least(seq, {_RC("seq")}) AS allele FROM q WHERE length(seq) BETWEEN 60 AND 20000),
        kl AS (SELECT CAST(item_id AS VARCHAR) AS known_id, {_bases("line")} AS seq FROM (SELECT item_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM benchmark)),
        k AS (SELECT least(seq, {_RC("seq")}) AS allele, min(known_id) AS known_id FROM kl WHERE length(seq) BETWEEN 60 AND 20000 GROUP BY 1),
        e AS (SELECT allele, count(*) AS sightings, count(DISTINCT sample || chr(10) || contig) AS contigs, count(DISTINCT sample) AS n_samples, min(contig) AS first_contig FROM a GROUP BY allele)
        SELECT sha256(e.allele) AS signature, e.allele, CAST(length(e.allele) AS INTEGER) AS length, CAST(100 AS DOUBLE) * length(regexp_replace(e.allele, '[^GC]', '', 'g')) / length(e.allele) AS gc_percent, k.known_id, e.sightings, e.contigs, e.n_samples, e.first_contig,
               CASE WHEN k.known_id IS NOT NULL THEN 'accepted' WHEN e.n_samples >= 2 THEN 'review' ELSE 'hold' END AS disposition
        FROM e LEFT JOIN k ON e.allele = k.allele
    """,
}
