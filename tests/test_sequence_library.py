import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from strandloom.functions import sequence as S
from strandloom.functions.statistics import _fisher, alleles, pileup_alleles
from strandloom.operators import decisions, graph, intervals, ranking
from strandloom.operators.components import connected_components
from strandloom.sources import readers, writers


def one(spark, column, **values):
    names = list(values)
    return spark.createDataFrame([tuple(values.values())], names).select(column.alias("x")).first()[0]


def test_scalars(spark):
    assert one(spark, S.reverse_complement("s"), s="ACGTNRYsw") == "wsRYNACGT"
    assert one(spark, S.internal_stops("s"), s="ATGTAAATGTAG") == 1 and one(spark, S.internal_stops("s"), s="AT") == 0
    assert sorted(one(spark, S.kmers("s", 2), s="AAAC")) == ["AA", "AC"]
    assert one(spark, S.kmers("s", 9), s="AAAC") == []
    assert [tuple(r) for r in one(spark, S.interior_runs("s"), s="NNACNNNGTNAN")] == [(5, 7), (10, 10)]
    assert tuple(one(spark, S.parse_region("s"), s="c_1:5-9")) == ("c_1", 5, 9) and tuple(one(spark, S.parse_region("s"), s="chr|x 2")) == ("chr|x 2", None, None)
    for wrong in ("c:1:5-9", "c:1,000-2,000", "c:5", ":5-9", "c:-9", ""):
        with pytest.raises((PySparkException, Py4JJavaError)):
            one(spark, S.parse_region("s"), s=wrong)
    assert one(spark, S.mean_phred("s"), s="!+5") == pytest.approx(10.0)
    assert one(spark, S.flag_names("s"), s="LOW_COVERAGE (x; y); GC_SHIFT (3)") == ["LOW_COVERAGE", "GC_SHIFT"]
    assert tuple(one(spark, S.measured_interval("s"), s="10 (+/-2)")) == (10.0, 8.0, 12.0)
    six = one(spark, S.six_frame_stops("s"), s="ATGAAATTTGGG")
    assert six.stops == 0 and six.frame == "+1"


def test_query_span_on_both_strands(spark):
    df = spark.createDataFrame([(11, 90, 1, 80, 100, 200), (11, 90, 190, 111, 100, 195)], "qs int, qe int, ss int, se int, ql int, sl int")
    a, b = (r[0] for r in df.select(S.query_span("qs", "qe", "ss", "se", "ql", "sl")).collect())
    assert (a.strand, a.start, a.end, a.clipped_start) == ("+", 1, 90, 10) and [tuple(x) for x in a.lost] == [(1, 10)]
    assert (b.strand, b.start, b.end, b.clipped_end) == ("-", 101, 195, 5) and [tuple(x) for x in b.lost] == [(1, 5)]


def test_pileup_and_fisher(spark):
    assert _fisher(1, 9, 11, 3) == pytest.approx(0.00275946, abs=1e-8)
    found = {a: (f, r) for a, f, r, _ in alleles("^F.,Aa$+2tt,-1c", "C")[0]}
    assert found == {"C": (1, 2), "A": (1, 1), "+TT": (0, 1), "-C": (0, 1)}
    df = spark.createDataFrame([("..,T", "g")], ["b", "r"]).select(pileup_alleles("b", "r").alias("x"))
    assert [tuple(x) for x in df.first().x.alleles] == [("G", 2, 1, 0), ("T", 1, 0, 1)] and df.first().x.observations == 4


def test_intervals_and_ranking(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 6, 8), ("a", 20, 30), ("b", 3, 4), ("a", 7, 25)], "k string, s long, e long")
    assert sorted(tuple(r) for r in intervals.merge(df, ["k"], "s", "e").collect()) == [("a", 1, 30, 4), ("b", 3, 4, 1)]
    assert {(r.start, r.end, r.multiplicity) for r in intervals.segments(df.filter("k = 'a'"), ["k"], "s", "e").collect()} == {(1, 5, 1), (6, 6, 1), (7, 8, 2), (9, 19, 1), (20, 25, 2), (26, 30, 1)}
    kept = ranking.suppress_overlaps(df.withColumn("w", F.col("e") - F.col("s")), ["k"], "s", "e", ["w"]).collect()
    assert sorted((r.k, r.s) for r in kept) == [("a", 1), ("a", 7), ("b", 3)]
    lost = spark.createDataFrame([("q", "c1", 1, 50)], "q string, subject string, start long, end long")
    hits = spark.createDataFrame([("q", "c2", 1, 30), ("q", "c3", 20, 60), ("q", "c1", 51, 99)], "q string, subject string, qstart long, qend long")
    assert tuple(intervals.continuation(lost, hits, ["q"]).first())[-2:] == ("c3", 31)


def test_graph(spark, tmp_path):
    path = tmp_path / "g.gfa"
    path.write_text("S\t1\tAAAC\tDP:f:2.5\nS\t2\tCGG\nS\t3\tCTT\nS\t4\tTA\nL\t1\t+\t2\t+\t1M\nL\t1\t+\t3\t+\t1M\nL\t2\t+\t4\t+\t0M\nL\t3\t+\t4\t+\t0M\n")
    segments, edges = readers.gfa(spark, f"file://{path}")
    assert segments.count() == 4 and edges.count() == 8
    forward = edges.filter("src_o = '+' and dst_o = '+'")
    paths = graph.terminal_paths(forward, spark.createDataFrame([("1",)], ["node"]), "src", "dst", "node", lambda _, df: spark.createDataFrame(df.collect(), df.schema))
    assert sorted(r.path for r in paths.collect()) == [["1", "2", "4"], ["1", "3", "4"]]
    edges2 = spark.createDataFrame([(1, 2), (2, 3), (5, 4), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in connected_components(edges2, "a", "b", lambda _, df: spark.createDataFrame(df.collect(), df.schema)).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 7: 7}


def test_decisions(spark):
    df = spark.createDataFrame([(50.0, 99.5, 1.0), (4.0, 99.5, 1.0), (15.0, 99.5, 1.0), (15.0, 98.0, 2.5)], "mean_depth double, breadth double, ratio double")
    tiers = [r[0] for r in df.select(decisions.tier(decisions.graded_flags(["mean_depth", "breadth"]), F.col("ratio"))).collect()]
    assert tiers == ["HIGH", "SUSPECT", "MEDIUM", "LOW"]


def test_readers_and_writers(spark, tmp_path):
    path = tmp_path / "x.fasta"
    path.write_text(">a first one\nacg\nTT\n>b\nGG\n")
    rows = readers.fasta(spark, f"file://{path}").collect()
    assert [(r.seq_id, r.description, r.seq) for r in rows] == [("a", "first one", "ACGTT"), ("b", "", "GG")]
    sheet = tmp_path / "s.tsv"
    sheet.write_text("# note\nsample_id\tassembly\tr1\tr2\nok\ta\tb\tc\n../x\ta\tb\tc\ndup\ta\tb\tc\ndup\ta\tb\tc\n")
    assert sorted((r.sample_id, r.problem or "") for r in readers.sample_sheet(spark, f"file://{sheet}").collect()) == [("../x", "unsafe id"), ("dup", "repeated id"), ("dup", "repeated id"), ("ok", "")]
    df = spark.createDataFrame([("a", True, ["x", "y"], None)], "s string, b boolean, l array<string>, n double")
    assert tuple(writers.flat(df).first()) == ("a", "true", "x;y", "")


def test_kernels_on_long_sequences(spark):
    import time

    from strandloom.operators import evaluation

    rng = __import__("numpy").random.default_rng(8)
    long = "".join("ACGT"[i] for i in rng.integers(0, 4, 1_000_000))
    holed = long[:300_000] + "N" * 12 + long[300_000:700_000] + "n" + long[700_000:]
    began = time.time()
    df = spark.createDataFrame([(long, holed, long[400_000:] + "T" * 50)], "s string, h string, o string")
    row = df.select(S.interior_runs("h").alias("runs"), S.six_frame_stops("s").alias("six"), evaluation.relation("o", "s").alias("rel")).first()
    assert [tuple(r) for r in row.runs] == [(300_001, 300_012), (700_013, 700_013)]
    assert row.rel == "identical over the overlap, different boundaries" and time.time() - began < 60
    back = long.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    for label, text, f in (("+1", long, 0), ("+3", long, 2), ("-1", back, 0), ("-2", back, 1)):
        codons = [text[i : i + 3] for i in range(f, len(text) - 2, 3)]
        assert row.six.counts[label] == sum(c in S.STOPS for c in codons[:-1])


def test_six_frames_equal_the_plain_count(spark):
    texts = ["", "A", "TAA", "TAATAA", "taataaTAGA", "NNTAANTGATAA", "TTACTATCATTA", None, "TAATAATA", "RYTAAKM"]
    rows = spark.createDataFrame([(t,) for t in texts], "s string").select("s", S.six_frame_stops("s").alias("six"), *[S.internal_stops("s", f).alias(f"p{f}") for f in range(3)], *[S.internal_stops(S.reverse_complement("s"), f).alias(f"m{f}") for f in range(3)]).collect()
    for r in rows:
        if r.s is None:
            assert r.six.stops is None and r.six.counts is None
            continue
        plain = {f"+{f + 1}": r[f"p{f}"] for f in range(3)} | {f"-{f + 1}": r[f"m{f}"] for f in range(3)}
        assert r.six.counts == plain and (r.six.stops, r.six.frame) == min((n, x) for x, n in plain.items())


def test_stops_of_many_sequences_at_once():
    seqs = ["TAATAATAA", "", "T", "TTA", "AATAA", "TAATAATAA", "TTATTATTA"]
    assert S.frame_stops(seqs).tolist() == [S.frame_stops([s])[0].tolist() for s in seqs]
    assert S.frame_stops(["TAATAATAA", "TTATTATTA"]).tolist() == [[2, 0, 0, 0, 0, 0], [0, 0, 0, 2, 0, 0]]


def test_rows_of_a_small_file_are_dealt_to_all_cores(spark, sf_dir):
    from strandloom.plans import genomic, truth

    for query in (genomic.reading_frames, truth.frames_of_both_strands):
        assert query(spark, sf_dir).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
