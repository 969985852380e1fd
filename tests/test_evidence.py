import pytest

from strandloom.functions.statistics import alleles
from strandloom.operators import evidence
from strandloom.sources import readers
from strandloom.streaming.depth import depth_blocks


def test_pileup_strings():
    # Start marks with their quality, end marks, indels on the strand before them, placeholders, skips, a bare sign.
    assert alleles("^F.,Aa$+2tt,-1c", "C") == ([("C", 1, 2, 0), ("A", 1, 1, 1), ("+TT", 0, 1, 2), ("-C", 0, 1, 3)], 5)
    assert alleles(".<+1A>", "c") == ([("C", 1, 0, 0), ("+A", 1, 0, 1)], 3)
    assert alleles(".+,*#Rn", "G") == ([("G", 1, 1, 0), ("*", 1, 1, 1), ("N", 0, 1, 2)], 5)
    assert alleles("", "G") == ([], 0) and alleles("^", "G") == ([], 0)


def test_per_base_and_summary(spark):
    rows = [("c", 1, "A", 4, "..,,", "IIII", "IIII"), ("c", 2, "A", 8, "..,,TTtt", "IIIIIIII", "IIIIIIII"), ("c", 3, "A", 0, "*", "!", "!"), ("c", 4, "A", 3, "TTt", "III", "III"), ("c", 5, "A", 4, "..TT", "*", "III5"), ("c", 6, "A", 2, None, None, None)]
    support = evidence.per_base(spark.createDataFrame(rows, readers.PILEUP))
    got = {r.position: r for r in support.collect()}
    assert got[2].alt_base == "T" and got[2].alt_fraction == pytest.approx(0.5) and got[2].credible_mixed_site
    assert got[1].reasons == [] and got[1].strand_balance_pct == 100.0 and "CREDIBLE_MIXED_SITE" in got[2].reasons
    # A position without reads holds a placeholder, which is no deletion.
    assert (got[3].depth, got[3].alt_base, got[3].alt_fraction, got[3].reasons, got[3].strand_bias_pvalue) == (0, "", 0.0, ["ZERO_DEPTH"], 1.0)
    assert got[4].reference_discordant_site and not got[4].candidate_mixed_site and got[4].strand_balance_pct == pytest.approx(200 / 3)
    assert got[5].strand_biased_site and not got[5].credible_mixed_site and got[5].mean_base_quality == 0.0 and "LOW_BASE_QUALITY" in got[5].reasons
    assert got[6].depth == 0 and got[6].reasons == ["ZERO_DEPTH"]
    total = evidence.summary(support, spark.createDataFrame([("c", 10), ("d", 5)], "contig string, length int"), margin=1)
    s = {r.contig: r for r in total.collect()}
    assert s["d"].mean_depth == 0 and s["d"].tier_uncertain_base_fraction == 1.0 and s["d"].uncertainty_reasons == {"ZERO_DEPTH": 5}
    c = s["c"]
    assert (c.mixed_site_count, c.candidate_mixed_sites, c.strand_biased_sites, c.reference_discordant_sites, c.mixture_detected) == (1, 2, 1, 1, False)
    assert (c.mean_depth, c.min_depth, c.max_depth, c.breadth_pct, c.bases_lt5, c.uncertainty_reasons["ZERO_DEPTH"]) == (1.9, 0, 8, 40.0, 9, 6)
    assert (c.interior_length, c.internal_zero_depth_positions, c.interior_metric_used, c.median_mixed_fraction) == (5, 2, False, 0.5)


def test_depth_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.tsv").write_text("c\t1\t5\nc\t2\t7\nc\t600\t1\n")
    q = depth_blocks(spark, f"file://{folder}").writeStream.outputMode("complete").format("memory").queryName("blocks").option("checkpointLocation", f"file://{tmp_path}/cp").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(tuple(r) for r in spark.table("blocks").collect()) == [("c", 0, 12, 2), ("c", 1, 1, 1)]
