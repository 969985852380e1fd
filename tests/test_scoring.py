"""Scores against truth, and a reconstruction of several samples, on cases with known answers."""

import random

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from strandloom.operators import evidence, quality_control, scoring, simulate
from strandloom.plans import reconstruction
from strandloom.sources import readers, writers
from tests.test_discovery import bases, rc


def test_truth_copies_and_strata(spark):
    rows = [("u", "c1", 99.0, 1, 100, 201, 300, 200.0, 100), ("u", "c1", 95.0, 3, 98, 230, 325, 150.0, 100), ("u", "c1", 95.0, 5, 100, 900, 805, 150.0, 100), ("u", "c1", 70.0, 1, 100, 501, 600, 90.0, 100), ("u", "c2", 99.0, 11, 100, 1, 90, 180.0, 100), ("u", "c2", 99.0, 1, 50, 301, 350, 80.0, 100)]
    hits = spark.createDataFrame(rows, "u string, replicon string, identity double, qstart int, qend int, sstart int, send int, bitscore double, bait int")
    lengths = spark.createDataFrame([("u", "c1", 902), ("u", "c2", 400)], "u string, replicon string, replicon_length int")
    copies = scoring.truth_copies(hits, lengths, ["u"], "bait")
    assert [(r.copy, r.replicon, r.start, r.end, r.strand, r.clipped_bp) for r in copies.orderBy("copy").collect()] == [(1, "c1", 201, 300, "+", 0), (2, "c1", 805, 902, "-", 2), (3, "c2", 1, 90, "+", 10)]
    units = spark.createDataFrame([("u",), ("one",), ("same",), ("none",)], "u string")
    seqs = spark.createDataFrame([("u", "A"), ("u", "C"), ("one", "A"), ("same", "A"), ("same", "A")], "u string, seq string")
    assert {r.u: scoring.STRATA.index(r.stratum) for r in scoring.stratum(seqs, units, ["u"]).collect()} == {"u": 2, "one": 0, "same": 1, "none": 3}


def test_rounding_rules(spark):
    df = spark.createDataFrame([(2.5, 3), (2.5, 2), (1.5, 2), (2.4, 2)], "v double, t int")
    got = {rule: [r.x for r in df.select(scoring.rounds_to(F.col("v"), F.col("t"), rule).alias("x")).collect()] for rule in scoring.ROUNDING}
    assert got == {"half up": [True, False, True, True], "half even": [False, True, True, True], "nearest": [False, False, False, True]}


def test_sites_against_truths(spark):
    truth = bases(60, 1)
    other = truth[:30] + ("A" if truth[30] != "A" else "C") + truth[31:]
    sites = spark.createDataFrame([("u", truth, 31, other[30]), ("u", truth, 10, "N"), ("v", truth[5:50], 26, other[30])], "u string, candidate string, position int, alt_base string")
    truths = spark.createDataFrame([("u", "t1", truth), ("u", "t2", rc(other)), ("v", "t1", truth), ("v", "t2", other)], "u string, name string, seq string")
    got = {(r.u, r.position): r for r in scoring.mixed_sites(sites, truths, ["u"]).collect()}
    s = got["u", 31]
    assert s.truth_bases_at_site == f"t1:{truth[30]};t2:{other[30]}" and s.truth_copies_differ_at_site and s.alt_base_is_in_a_truth_copy
    assert not got["u", 10].truth_copies_differ_at_site and not got["u", 10].alt_base_is_in_a_truth_copy
    assert got["v", 26].truth_bases_at_site == f"t1:{truth[30]};t2:?"


def test_tables_of_stages(spark):
    names = ("clipped_start_bp", "clipped_end_bp", "lost_prefix_bp", "lost_suffix_bp", "continuation_contig", "recovered_bp", "overlap_bp")
    row = {**{f"truth_{n}": "x" for n in names}, **{f"measured_{n}": "x" for n in names}, "extracted_bp": 5, "expected_bp": 5}
    cases = spark.createDataFrame([row, {**row, "measured_recovered_bp": "y"}, {**row, "truth_overlap_bp": None}, {**row, "truth_overlap_bp": None, "measured_overlap_bp": None}], ", ".join(f"{k} {'int' if k.startswith('ex') else 'string'}" for k in row))
    assert [r.exact for r in scoring.completeness(cases).collect()] == [True, False, False, True]
    a = scoring.stage_rows(spark.createDataFrame([("c1", "good")], "case string, category string"), "first", {"good": "supported"}, "category").withColumn("case_design", F.lit("d"))
    b = spark.createDataFrame([("c2", "e", "x", "control")], "case string, evidence string, case_class string, stage string")
    both = {r["case"]: (r.evidence, r.counts, r.case_class) for r in scoring.combined_stages([a, b], "control").collect()}
    assert both == {"c1": ("d", True, "supported"), "c2": ("e", False, "x")}
    with pytest.raises((PySparkException, Py4JJavaError)):
        scoring.stage_rows(spark.createDataFrame([("c1", "odd")], "case string, category string"), "first", {"good": "supported"}, "category").collect()
    report = "AlignedBases  4600000(99.12%)  4600100(99.10%)\nAvgIdentity   99.98   99.98\n"
    assert tuple(spark.range(1).select(scoring.concordance(report).alias("c")).first().c) == (99.12, 99.98, True)
    assert tuple(spark.range(1).select(scoring.concordance("nothing").alias("c")).first().c) == (None, None, False)
    features = spark.createDataFrame([("g", "r1", True, False, "16S", 1500), ("g", "r1", True, False, "16S", 400), ("h", "r1", True, False, "16S", 1500), ("h", "r2", True, False, "16S", 1500)], "g string, replicon string, circular boolean, plasmid boolean, kind string, length int")
    wanted = spark.createDataFrame([("g", "16S", 1400, 1), ("h", "16S", 1400, 2), ("i", "16S", 1400, 1)], "g string, kind string, least_length int, copies int")
    assert {r.g: (r.found, r.chromosomes, r.sound) for r in scoring.genome_audit(features, ["g"], wanted).collect()} == {"g": (1, 1, True), "h": (2, 2, False), "i": (0, 0, False)}
    text = spark.createDataFrame([("a", "x {{ONE}} {{TWO}}"), ("b", "{{ONE}}"), ("c", None)], "path string, value string")
    assert {r.token: (r.uses, r.files) for r in scoring.slots(text).collect()} == {"ONE": (2, ["a", "b"]), "TWO": (1, ["a"])}
    told = scoring.explained(text, "value", [("TWO", "second"), ("ONE", "first")])
    assert [r.explanation for r in told.orderBy("path").collect()] == ["second", "first", "unexplained"]
    assert scoring.with_blocks(text, [100, 500]).count() == 6


def test_sequences_returned(spark):
    t = bases(80, 5)
    found = spark.createDataFrame([("u", rc(t)), ("u", t[:-1]), ("v", "AC-GT")], "u string, seq string")
    truths = spark.createDataFrame([("u", t), ("u", t), ("u", bases(80, 6)), ("v", "ACGT"), ("w", "A")], "u string, seq string")
    assert {r.u: (r.recovered, r.truths) for r in scoring.truths_recovered(found, truths, ["u"]).collect()} == {"u": (1, 2), "v": (1, 1), "w": (0, 1)}
    n = found.select("u", *[c.alias(k) for k, c in scoring.base_counts("seq").items()]).filter("u = 'v'").first()
    assert (n.returned_bp, n.uncalled_bases, n.lowercase_bases) == (4, 0, 0)
    rows = [("u", "differs", 80, "a"), ("u", "identical", 70, "b"), ("u", "identical", 75, "c")]
    best = scoring.best_per_configuration(spark.createDataFrame(rows, "u string, relation string, aligned int, label string"), ["u"], "relation", "aligned", "label").first()
    assert (best.label, best.detail, best.candidates) == ("c", "c; b; a", 3)
    rel = spark.createDataFrame([("e", t, rc(t), 100.0, 80), ("o", t[:-5], t, 100.0, 75), ("d", t, bases(80, 9), 88.125, 40), ("n", t, bases(80, 9), None, None)], "u string, seq string, truth string, i double, n int")
    got = {r.u: r.relation for r in scoring.annotated_relation(rel, ["u"], "seq", "truth", "i", "n").collect()}
    assert got["e"] == "identical to the annotated allele" and got["o"] == "identical over the 75 bp overlap; candidate -5 bp against the annotated boundary" and got["d"].startswith("88.1") and got["n"] == "no alignment to the annotated allele"
    pool = spark.createDataFrame([("k", t, 5.0), ("k", bases(80, 10), 1.0), ("k", bases(80, 11), 2.0)], "k string, seq string, score double")
    assert [r.score for r in scoring.fewest_shared(pool, spark.createDataFrame([("k", t)], "k string, seq string"), ["k"], "seq", "score", most=2).orderBy("score").collect()] == [1.0, 2.0]
    counts = scoring.relation_counts(spark.createDataFrame([("u", "identical"), ("u", "differs"), ("u", "identical")], "u string, relation string"), ["u"], "relation").first()
    assert counts.total == 3 and counts.identical == 2 and counts.differs == 1


def test_reconstruction_of_samples(spark):
    gene = "ATG" + "GCTGAAACC" * 20 + "TAA"
    n = len(gene)
    local = bases(40, 1) + rc(gene) + bases(50, 2)
    samples = spark.createDataFrame([("good", None), ("thin", None), ("far", None), ("empty", None), ("broken", "empty path")], "sample_id string, problem string")
    names = ["good", "thin", "far"]
    hits11 = spark.createDataFrame([(s, "bait", "c", 1, n, 101, 100 + n, n, 99.0, 100.0, 300.0, 0.0) for s in names] + [("empty", "bait", "c", 1, 20, 1, 20, 20, 99.0, 10.0, 30.0, 0.0)], "sample_id string, " + readers.HITS_11)
    lengths = spark.createDataFrame([(s, "c", 2000) for s in names], "sample_id string, contig string, length long")
    reads = spark.createDataFrame([(s, f"r{i}", "c", 100 + i, 150 + i) for s in names for i in range(3)], "sample_id string, qname string, contig string, start long, end long")
    hits13 = spark.createDataFrame([(s, "bait", "l", 1, n, 40 + n, 41, n, 99.0, 100.0, 300.0, 0.0, n, len(local)) for s in names], "sample_id string, " + readers.HITS_13)
    seqs = spark.createDataFrame([(s, "l", local) for s in names], "sample_id string, seq_id string, seq string")
    valid = spark.createDataFrame([(s, s, "allele1", n, 99.0 if s != "far" else 80.0, 100.0, 300.0, n, n, 0.0) for s in names], "sample_id string, " + readers.HITS_9)
    deep, thin = ("." * 12 + "," * 12, "I" * 24), (".,", "II")
    pile = [(s, i, "A", len(b[1]), *b, "]" * len(b[1])) for s, b in (("good", deep), ("far", deep), ("thin", thin)) for i in range(1, n + 1)]
    profile = quality_control.catalogue_profile(spark.createDataFrame([(f"a{i}", gene) for i in range(6)], "seq_id string, seq string"), [])
    out = reconstruction.reconstruct(samples, hits11, lengths, reads, hits13, seqs, valid, spark.createDataFrame(pile, readers.PILEUP), profile, spark.createDataFrame([(s, 50) for s in names], "sample_id string, read_length int")).cache()
    r = {x.sample_id: x for x in out.collect()}
    g = r["good"]
    assert (g.workflow_status, g.result_disposition, g.qc_confidence, g.qc_flags, g.seq, g.extracted_read_names, g.target_regions) == ("SUCCESS", "PASS", "HIGH", "", gene, 3, 1)
    assert r["thin"].workflow_status == "SKIP" and "remap support" in r["thin"].message and r["far"].message.startswith("Allele failed validation")
    assert (r["empty"].workflow_status, r["empty"].message) == ("SKIP", "No contigs matched bait.") and (r["broken"].workflow_status, r["broken"].message) == ("FAIL", "empty path")
    cells = {x.sample_id: x for x in writers.batch_report(out).collect()}
    assert cells["good"].remap_mean_depth == "24.0" and cells["good"].exact_known_allele == "false" and cells["thin"].remap_mean_depth == "" and cells["broken"].result_disposition == "HOLD"
    with pytest.raises(ValueError):
        reconstruction.Settings(min_identity=120)


def test_read_length(spark):
    rng = random.Random(3)
    rows = [("a", i, "A" * rng.randint(90, 110)) for i in range(50)] + [("a", 99, "*"), ("b", 1, "*")]
    df = spark.createDataFrame(rows, "k string, i int, seq string")
    want = round(sum(len(r[2]) for r in rows[:20]) / 20)
    assert [tuple(r) for r in evidence.read_length(df, ["k"], "i", most=20).collect()] == [("a", want)]


def test_cuts_exactness_and_frames(spark):
    seqs = spark.createDataFrame([("a", "ABCDEFGHIJ"), ("b", "XYZ"), ("c", "QQ")], "seq_id string, seq string")
    gone = spark.createDataFrame([("a", 3, 4), ("a", 4, 6), ("a", 10, 20), ("c", 1, 9)], "seq_id string, start long, end long")
    got = simulate.cut_out(seqs, gone, []).collect()
    assert sorted((r.seq_id, r.piece, r.seq) for r in got) == [("a", 1, "AB"), ("a", 2, "GHI"), ("b", 1, "XYZ")]
    gene = "ATG" + "GCTGAAACC" * 5 + "TAA"
    c = spark.createDataFrame([("k", gene), ("k", gene[1:])], "k string, seq string")
    assert {r.seq == gene: r.exact for r in scoring.exactness(c, spark.createDataFrame([("k", rc(gene))], "k string, seq string"), ["k"]).collect()} == {True: True, False: False}
    grid = {r.orientation: (r.stops, r.frame) for r in scoring.frame_grid(c.limit(1)).collect()}
    assert grid["given"][0] == grid["turned"][0] == 0
    df = spark.createDataFrame([(2.0, "MULTICOPY_DEPTH", "ESTIMATED"), (None, "DEPTH_INDETERMINATE", None)], "dosage_estimate double, depth_call string, dosage_status string")
    assert [r.t for r in df.select(scoring.interpretation().alias("t")).collect()] == ["more than one copy is supported; dosage 2.000 (ESTIMATED)", "no statement on copies; no dosage (NOT_ESTIMATED)"]


def test_repeated_candidates_share_as_single_ones_do(spark):
    target = "ACGTTGCAAGCT"
    pool = spark.createDataFrame([("k", target[:9], 1.0), ("k", target[:9], 1.0), ("k", target[:10], 2.0)], "k string, seq string, score double")
    found = scoring.fewest_shared(pool, spark.createDataFrame([("k", target)], "k string, seq string"), ["k"], "seq", "score", k=4).collect()
    assert sorted(r.shared for r in found) == [6, 6, 7]


def test_the_strand_of_a_truth_is_decided_once_and_at_sight_where_it_holds_the_candidate(spark):
    sites = spark.createDataFrame([(1, "ACGGT", 2, "C"), (2, "ACGGT", 2, "G")], "u int, candidate string, position int, alt_base string")
    truths = spark.createDataFrame([(1, "t", "TTACGGTA"), (2, "t", "TACCGTAA")], "u int, name string, seq string")
    out = scoring.mixed_sites(sites, truths, ["u"])
    assert {r.u: (r.truth_bases_at_site, r.alt_base_is_in_a_truth_copy) for r in out.collect()} == {1: ("t:C", True), 2: ("t:C", False)}
    assert out._jdf.queryExecution().optimizedPlan().toString().count("levenshtein") == 2
