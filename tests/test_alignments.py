"""The queries of mapping and assembly against their SQL, and a reconstruction from reads alone."""

import os

import duckdb
import numpy as np
import pytest

from strandloom.plans import alignments, reconstruction
from strandloom.sources.scratch import keeper

COMPLEMENT = str.maketrans("ACGT", "TGCA")


def rc(s):
    return s.translate(COMPLEMENT)[::-1]


@pytest.mark.parametrize("name", sorted(alignments.QUERIES))
def test_query_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("part", "nation"):
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"create view {t} as select * from read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    df = alignments.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    result = con.execute(alignments.SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr) == sorted((tuple(r[names.index(c)] for c in columns) for r in result.fetchall()), key=repr)


def test_samples_stop_where_reads_and_drafts_end(spark):
    rng = np.random.default_rng(21)
    bases = lambda n: "".join("ACGT"[i] for i in rng.integers(0, 4, n))
    gene, flank, other = bases(360), bases(500), bases(900)
    near = gene[:200] + {"A": "C", "C": "G", "G": "T", "T": "A"}[gene[200]] + gene[201:]
    drafts = {"whole": flank + gene + rc(flank), "turned": rc(flank + gene + rc(flank)), "mixed": flank + gene + rc(flank), "none": other, "dry": flank + gene + rc(flank), "bad": ""}

    def pairs(sample, text, step):
        for s in range(0, len(text) - 250, step):
            yield sample, f"{step}-{s}-{hash(text) & 1}", 1, text[s : s + 100], "I" * 100
            yield sample, f"{step}-{s}-{hash(text) & 1}", 2, rc(text[s + 150 : s + 250]), "I" * 100

    reads = [r for s in ("whole", "turned", "none") for r in pairs(s, drafts[s], 10)]
    reads += list(pairs("mixed", flank + gene + rc(flank), 7)) + list(pairs("mixed", flank + near + rc(flank), 11))
    samples = spark.createDataFrame([(s, "empty path" if s == "bad" else None) for s in drafts], "sample_id string, problem string")
    table = spark.createDataFrame([(s, "c1", t) for s, t in drafts.items()] + [("whole", "c2", other)], "sample_id string, contig string, seq string")
    baits = spark.createDataFrame([("a1", gene), ("a2", bases(60) + gene[60:])], "seq_id string, seq string")
    rows = reconstruction.from_reads(samples, table, spark.createDataFrame(reads, "sample_id string, name string, mate int, seq string, qual string").repartition(4), baits, keeper(spark), reconstruction.Settings(coding=False)).collect()
    got = {r.sample_id: r for r in rows}
    assert set(got) == set(drafts)
    for s in ("whole", "turned"):
        assert (got[s].workflow_status, got[s].seq, got[s].nearest_allele, got[s].exact_known_allele, got[s].remap_breadth_pct) == ("SUCCESS", gene, "a1", True, 100.0)
    assert got["mixed"].workflow_status == "SUCCESS" and got["mixed"].seq in (gene, near) and got["mixed"].candidate_mixed_sites == 1
    assert (got["none"].workflow_status, got["none"].message) == ("SKIP", "No contigs matched bait.")
    assert (got["dry"].workflow_status, got["dry"].message) == ("SKIP", "No reads mapped to target regions.")
    assert (got["bad"].workflow_status, got["bad"].message) == ("FAIL", "empty path")


def test_drafts_of_a_locus_are_dealt_to_all_cores(spark, sf_dir, monkeypatch):
    from strandloom.plans import alignments

    class Enough(Exception):
        pass

    seen = {}

    def keep(name, df):
        seen[name] = df.rdd.getNumPartitions()
        if name == "drafts":
            raise Enough
        return df

    monkeypatch.setattr(alignments, "keeper", lambda s: keep)
    try:
        alignments.loci_from_reads(spark, sf_dir)
    except Enough:
        pass
    assert seen["drafts"] >= spark.sparkContext.defaultParallelism
