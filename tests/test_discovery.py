"""Alignment, hits, graphs and what is inferred from them, on cases with known answers."""

import random

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from strandloom.operators import alignment, discovery, graph, quality_control
from strandloom.sources import readers

BAD = (PySparkException, Py4JJavaError)


def bases(n, seed):
    rng = random.Random(seed)
    return "".join(rng.choice("ACGT") for _ in range(n))


def rc(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def keeper(spark):
    return lambda _, df: spark.createDataFrame(df.collect(), df.schema)


def test_local_hits(spark):
    q = bases(400, 1)
    other = "A" if q[200] != "A" else "C"
    changed = q[:200] + other + q[201:300] + q[303:]
    subjects = [("plus", bases(90, 2) + q + bases(70, 3)), ("minus", bases(50, 4) + rc(changed) + bases(60, 5)), ("none", bases(900, 6)), ("part", q[100:260] + bases(300, 7)), ("odd", None), ("n", "N" * 50)]
    got = {r.sseqid: r for r in alignment.local_hits(spark.createDataFrame([("q", q)], "seq_id string, seq string"), spark.createDataFrame(subjects, "seq_id string, seq string"), []).collect()}
    assert set(got) == {"plus", "minus", "part"}
    p, m, t = got["plus"], got["minus"], got["part"]
    assert (p.qstart, p.qend, p.sstart, p.send, p.length, p.pident, p.qcovhsp) == (1, 400, 91, 490, 400, 100.0, 100.0)
    assert (m.qstart, m.qend, m.sstart, m.send) == (1, 400, 447, 51) and m.length == 400 and m.pident == pytest.approx(99.0)
    assert (t.qstart, t.qend, t.sstart, t.send) == (101, 260, 1, 160) and t.bitscore < m.bitscore < p.bitscore


GRAPHS = {
    # name: (links between named segments, target hit on T as (qstart, qend, sstart, send), what is expected)
    "matched": ("L1+T+ L2+T+ T+R1+ T+R2+", (1, 300, 1, 300), ("MATCHED_CONTEXT_COUNT", 2, 2, 2, 2)),
    "reversed": ("L1+T+ L2+T+ T+R1+ T+R2+", (1, 300, 300, 1), ("MATCHED_CONTEXT_COUNT", 2, 2, 2, 2)),
    "asymmetric": ("L1+T+ L2+T+ T+R1+", (1, 300, 1, 300), ("ASYMMETRIC_CONTEXTS", None, 1, 2, 1)),
    "onesided": ("L1+T+ L2+T+", (1, 300, 1, 300), ("ONE_SIDED_LOWER_BOUND", None, 2, 2, 0)),
    "cycle": ("L1+T+ T+S+ S+T+", (1, 300, 1, 300), ("TRAVERSAL_LIMIT_REACHED", None, 1, 1, 0)),
    "alone": ("L1+R1+", (1, 300, 1, 300), ("GRAPH_INDETERMINATE", None, None, 0, 0)),
    "uncovered": ("L1+T+ T+R1+", (1, 150, 1, 150), ("INSUFFICIENT_TARGET_COVERAGE", None, None, 0, 0)),
}


def test_contexts_of_targets(spark):
    sizes = {"T": 300, "L1": 300, "L2": 300, "R1": 300, "R2": 300, "S": 40}
    seg, edge, hits = [], [], []
    flip = {"+": "-", "-": "+"}
    for g, (links, (a, b, c, e), _) in GRAPHS.items():
        seg += [(f"{g}.{n}", bases(size, f"{g}{n}")) for n, size in sizes.items()]
        for x in links.split():
            i = x.index("+") + 1
            s, so, t, to = x[: i - 1], x[i - 1], x[i:-1], x[-1]
            edge += [(f"{g}.{s}", so, f"{g}.{t}", to, 0), (f"{g}.{t}", flip[to], f"{g}.{s}", flip[so], 0)]
        hits.append((g, f"{g}.T", a, b, c, e, 99.0, 500.0, 300))
    segments = spark.createDataFrame(seg, "seg_id string, seq string")
    edges = spark.createDataFrame(edge, "src string, src_o string, dst string, dst_o string, overlap int")
    table = spark.createDataFrame(hits, "target string, sseqid string, qstart int, qend int, sstart int, send int, pident double, bitscore double, bait_length int")
    got = {r.target: r for r in discovery.infer_contexts(table, segments, edges, "bait_length", keeper(spark)).collect()}
    for g, (_, _, want) in GRAPHS.items():
        r = got[g]
        # A reversed hit swaps the sides, which are equal there.
        assert (r.status, r.exact, r.lower_bound, r.left_context_count, r.right_context_count) == want, g
    assert got["cycle"].flags == ["CYCLE_ENCOUNTERED"] and got["uncovered"].flags == ["BAIT_QUERY_UNION_BELOW_THRESHOLD"] and got["matched"].min_bp == 100
    long = spark.createDataFrame([("x", bases(12_000, 9))], "seg_id string, seq string")
    inside = spark.createDataFrame([("t", "x", 1, 300, 5600, 5899, 99.0, 1.0, 300)], table.schema)
    r = discovery.infer_contexts(inside, long, edges.limit(0), "bait_length", keeper(spark)).first()
    assert (r.status, r.exact, r.flags) == ("MATCHED_CONTEXT_COUNT", 1, ["CONTEXT_RESOLVED_WITHIN_TARGET_SEGMENT"])
    beyond = spark.createDataFrame([("t", "x", 1, 300, 11_900, 12_199, 99.0, 1.0, 300)], table.schema)
    with pytest.raises(BAD):
        discovery.infer_contexts(beyond, long, edges.limit(0), "bait_length", keeper(spark)).collect()


def test_spelling_and_distinct_paths(spark):
    rows = [("a", 0, "AAAC", 0, 2.0), ("a", 1, "ACGG", 2, 5.0), ("b", 0, "CCGT", 0, 1.0), ("b", 1, "GTTT", 2, 1.0)]
    df = spark.createDataFrame(rows, "p string, i int, seq string, overlap int, depth double")
    got = {r.p: r for r in graph.spell(df, ["p"], "i", "seq", "overlap", "depth").collect()}
    assert (got["a"].seq, got["a"].nodes, got["b"].seq) == ("AAACGG", 2, "CCGTTT") and got["a"].depth == pytest.approx((2 * 4 + 5 * 2) / 6)
    for bad in [("c", 1, "TTTT", 2, 1.0), ("c", 1, "AC", 3, 1.0)]:
        with pytest.raises(BAD):
            graph.spell(spark.createDataFrame([("c", 0, "AAAC", 0, 1.0), bad], df.schema), ["p"], "i", "seq", "overlap", "depth").collect()
    paths = spark.createDataFrame([("AAACGG", ["1+", "2+"]), ("CCGTTT", ["2-", "1-"]), ("AAACGGA", ["3+"])], "seq string, path array<string>")
    assert [(r.place, r.path) for r in graph.distinct_paths(paths, []).orderBy("place").collect()] == [(1, ["3+"]), (2, ["1+", "2+"])]


def test_junctions(spark):
    left, right = bases(40, 21), bases(40, 22)
    paths = {"joined": left + right, "turned": rc(left + right), "apart": left + "GATTACA" + right, "shared": left + right[1:] if left[-1] == right[0] else left[:-1] + right}
    gaps = lambda: spark.createDataFrame([("g", left, right), ("x", bases(40, 30), right), ("e", "", right)], "gap_id string, left string, right string")
    verdict = lambda *names: {r.gap_id: (r.verdict, r.gaps_bp) for r in graph.junctions(spark.createDataFrame([(paths[n],) for n in names], "seq string"), gaps(), []).collect()}
    assert verdict("joined", "turned") == {"g": ("GRAPH_SUPPORTED", [0]), "x": ("NOT_SUPPORTED", []), "e": ("NOT_SUPPORTED", [])}
    assert verdict("apart")["g"] == ("AMBIGUOUS", [7]) and verdict("joined", "apart")["g"] == ("AMBIGUOUS", [0, 7])
    c = spark.createDataFrame([(1, left + "N" * 20 + right), (2, left + right), (3, left + "N" * 5 + right), (4, "N" * 30 + left)], "id int, seq string")
    found = {r.id: (r.placeholder_runs, r.placeholder_bp, r.verdict, r.flag) for r in graph.placeholder_verdict(c, ["id"], spark.createDataFrame([(paths["joined"],)], "seq string"), []).collect()}
    assert found == {1: (1, 20, "GRAPH_SUPPORTED", "PLACEHOLDER_JUNCTION_GRAPH_SUPPORTED"), **{i: (0, 0, "NO_PLACEHOLDER", None) for i in (2, 3, 4)}}
    assert {r.id: r.verdict for r in graph.placeholder_verdict(c, ["id"], None).collect()}[1] == "NOT_ASSESSED"


def test_junctions_stay_within_their_sample(spark, monkeypatch):
    left, right = bases(40, 21), bases(40, 22)
    c = spark.createDataFrame([(s, left + "N" * 20 + right) for s in ("s1", "s2", "s3")], "sample string, seq string")
    paths = spark.createDataFrame([("s2", left + right), ("s3", bases(90, 23)), ("s3", None)], "sample string, seq string")
    want = {"s1": "NOT_ASSESSED", "s2": "GRAPH_SUPPORTED", "s3": "NOT_SUPPORTED"}
    for slice_ in (1000, 1):
        monkeypatch.setattr(graph, "SLICE", slice_)
        found = graph.placeholder_verdict(c, ["sample"], paths).collect()
        assert {r["sample"]: r.verdict for r in found} == want and {r.flag for r in found} == {f"PLACEHOLDER_JUNCTION_{v}" for v in want.values()}
    short = spark.createDataFrame([("s2", "a", left[-3:], right[:2]), ("s2", "b", left[-11:], right), ("s2", None, left, right[:1])], "sample string, gap_id string, left string, right string")
    text = left + right
    at = text.find(left[-3:]) + 3
    got = {r.gap_id: (r.holding, r.gaps_bp) for r in graph.junctions(paths, short, ["sample"]).collect()}
    back = rc(text)
    expect = sorted({x for t in (text, back) if (i := t.find(left[-3:])) >= 0 and (x := t.find(right[:2], i + 2) - i - 3) >= -1 and t.find(right[:2], i + 2) >= 0})
    assert at and got["a"][1] == expect and got["b"] == (1, [0]) and got[None][0] >= 1


def test_hits_and_baits(spark):
    baits = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x")], "g string, seq_id string")
    assert discovery.selected_bait(baits, ["g"], "x").count() == 2
    for wanted in (None, "y"):
        with pytest.raises(BAD):
            discovery.selected_bait(baits, ["g"], wanted).collect()
    rows = [("q", "s1", 10, 60, 110, 160, 51, 90.0, 50.0, 80.0, 0.0, 100, 400), ("q", "s1", 1, 70, 101, 170, 70, 91.0, 70.0, 99.0, 0.0, 100, 400), ("q", "s2", 30, 95, 390, 325, 66, 85.0, 60.0, 95.0, 0.0, 100, 400), ("q", "s3", 1, 20, 5, 24, 20, 99.0, 20.0, 30.0, 0.0, 100, 400)]
    hits = spark.createDataFrame(rows, readers.HITS_13).withColumn("k", F.lit(1))
    assert discovery.strong_hits(hits).count() == 3
    c = discovery.candidate_regions(hits, ["k"])
    assert [(r.place, r.sseqid, r.region_start, r.region_end, r.support) for r in c.orderBy("place").collect()] == [(1, "s1", 101, 170, 2), (2, "s2", 325, 390, 1), (3, "s3", 5, 24, 1)]
    a = discovery.hit_ambiguity(c, ["k"]).first()
    assert (a.bitscore_margin, a.ambiguous, a.second_best_identity) == (4.0, True, 85.0)
    e = discovery.outermost_hits(hits, ["k"]).first()
    assert (e.left.sseqid, e.right.sseqid) == ("s1", "s2")
    spans = {r.sseqid: (r.span.start, r.span.end, r.clipped_bp) for r in discovery.projected_span(c).collect()}
    assert spans == {"s1": (101, 200, 0), "s2": (320, 400, 19), "s3": (5, 104, 0)}
    seqs = spark.createDataFrame([("s1", bases(400, 1)), ("s2", bases(400, 2)), ("s3", bases(400, 3))], "seq_id string, seq string").withColumn("k", F.lit(1))
    cut = {r.sseqid: r.seq for r in discovery.candidate_sequence(discovery.projected_span(c), seqs, ["k"]).collect()}
    assert cut["s1"] == bases(400, 1)[100:200] and cut["s2"] == rc(bases(400, 2)[319:400])
    reads = spark.createDataFrame([(1, "r1", "c", 90, 110), (1, "r1", "d", 0, 20), (1, "r2", "c", 50, 100), (1, "r3", "c", 149, 160)], "k int, qname string, contig string, start long, end long")
    names = discovery.seed_reads(reads, spark.createDataFrame([(1, "c", 100, 150)], "k int, contig string, start long, end long"), ["k"], 64)
    assert sorted(r.qname for r in names.collect()) == ["r1", "r3"] and discovery.rescued(reads, names, ["k"]).count() == 3


def test_catalogues_and_candidates(spark):
    gene = "ATG" + "GCTGAAACC" * 10 + "TAA"
    records = spark.createDataFrame([(f"a{i}", gene) for i in range(6)], "seq_id string, seq string")
    assert quality_control.catalogue_problems(records).isEmpty()
    p = quality_control.catalogue_profile(records, [])
    r = p.first()
    assert (r.n_alleles, r.len_mode, r.len_mod3_mode, r.len_iqr, r.length_profile_underpowered) == (6, len(gene), 0, 0.0, False) and "+1" in r.expected_frame_labels
    cut = gene[:30] + "N" * 10 + gene[30:]
    c = spark.createDataFrame([("same", gene, 0), ("short", gene[:-6], 0), ("clipped", gene[:-12], 12), ("gap", cut, 0), ("empty", "", 0)], "id string, seq string, clipped_bp int")
    m = quality_control.candidate_metrics(c, p, [])
    got = {x.id: x for x in m.collect()}
    assert got["same"].length_ratio == 0 and got["same"].has_start_codon and got["same"].has_stop_codon and got["same"].internal_stops == 0
    assert got["short"].length_ratio == 2 and got["clipped"].length_ratio == 0 and got["clipped"].span_restored_bp == 12
    assert got["gap"].frame_disrupted and got["gap"].n_count == 10 and got["empty"].gc_pct == 0
    full = m.withColumns({"validation_identity": F.lit(99.0), "validation_qcov": F.lit(100.0), "mean_depth": F.lit(40.0), "breadth_pct": F.lit(100.0), "pct_bases_lt5": F.lit(0.0)})
    told = {x.id: (x.sequence_confidence, x.qc_flags, x.catalogue_status) for x in quality_control.assessed(full).collect()}
    assert told["same"] == ("HIGH", "", "NONEXACT_MATCH") and told["short"][0] == "MEDIUM" and "POSSIBLE_NOVEL_ALLELE" in told["short"][1]
    assert told["clipped"][1].startswith("ALLELE_SPAN_CLIPPED_AT_CONTIG_END") and told["gap"][0] == "SUSPECT"
    # Without a depth summary nothing supports the bases.
    assert "LOW_REMAP_DEPTH" in quality_control.assessed(m.withColumns({"validation_identity": F.lit(99.0), "validation_qcov": F.lit(100.0)})).filter("id = 'same'").first().qc_flags
    card = quality_control.scorecard(m, "id", ["allele_length", "gc_pct"]).filter("id = 'same'").first().report
    assert card.split("\n")[0] == "QC report: same" and card.split("\n")[1] == f"allele_length : {len(gene)}"
    mixed = spark.createDataFrame([("long", gene * 3), ("frag", gene[5:60]), ("alien", bases(60, 77)), ("tiny", "ACGT")], "seq_id string, seq string")
    assert [x.seq_id for x in quality_control.unrelated_records(mixed, []).collect()] == ["alien"]
