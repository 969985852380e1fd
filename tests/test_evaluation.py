import pytest
from pyspark.sql import functions as F

from strandloom.functions.sequence import reverse_complement
from strandloom.functions.statistics import _bound, _t_quantile
from strandloom.operators import evaluation as V
from strandloom.operators import graph, simulate


def stored(spark):
    return lambda _, df: spark.createDataFrame(df.collect(), df.schema)


def test_quantiles_and_bounds():
    assert [round(_t_quantile(0.975, n), 4) for n in (1, 2, 5, 30, 120, 2001)] == [12.7062, 4.3027, 2.5706, 2.0423, 1.9799, 1.9612]
    assert _t_quantile(0.025, 7) == -_t_quantile(0.975, 7)
    assert _bound(5, 10, 0.05, False) == pytest.approx(0.18709, abs=1e-5)
    assert _bound(300_000, 1_000_000, 0.05, True) == pytest.approx(0.3008993, abs=1e-6)


def test_confusion_counts_undecided_and_unknown(spark):
    df = spark.createDataFrame([("a", True, 5), ("a", True, 1), ("a", False, 9), ("a", None, 9), ("a", True, None), ("b", False, 0)], "k string, t boolean, v int")
    got = {(r.k, r.rule): r for r in V.confusion(df, ["k"], F.col("t"), {"high": F.col("v") > 3, "any": F.col("v") >= 0}).collect()}
    r = got["a", "high"]
    assert (r.true_positive, r.false_positive, r.false_negative, r.true_negative, r.undecided, r.unknown) == (1, 1, 1, 0, 1, 1)
    assert r.precision == 0.5 and got["b", "high"].precision is None and len(got) == 4
    sets = V.with_sets(df, {"all": F.lit(True), "some": F.col("v") > 3}).groupBy("unit_set").count().collect()
    assert {tuple(x) for x in sets} == {("all", 6), ("some", 3)}


def test_bins_limits_transitions_and_text(spark):
    df = spark.createDataFrame([(1.0, 0.1, "x"), (4.0, -0.3, "x"), (5.0, 0.5, "y"), (99.0, 0.5, "y"), (2.0, None, "y")], "f double, e double, c string")
    got = {r.bin: tuple(r)[1:] for r in V.error_bins(df, [], "f", [(0, 5, "low"), (5, 10, "high")], "e", "c").collect()}
    assert got == {"low": (2, 1, pytest.approx(-0.1), pytest.approx(0.2), 0.3), "high": (1, 1, 0.5, 0.5, 0.5)}
    rows = [("a", lev, lev >= 10 and not (lev == 20 and i == 0)) for lev in (5, 10, 20, 30, 40) for i in range(2)] + [("b", 5, False), ("c", 5, True)]
    limits = V.detection_limit(spark.createDataFrame(rows, "k string, lev int, h boolean"), ["k"], "lev", F.col("h")).collect()
    assert {tuple(r) for r in limits} == {("a", 10, 30), ("b", None, None), ("c", 5, 5)}
    assert {tuple(r) for r in V.transitions(df, [], "c", "c").collect()} == {("x", "x", 2), ("y", "y", 3)}
    assert V.histogram_text(spark.createDataFrame([(2,), (None,), (2,), (1,)], "v int"), [], "v").first()[0] == "1=1; 2=2; none=1"
    assert df.agg(V.median_range("f").alias("x")).first()[0] == "4.000 (1.000-99.000)"
    assert V.markdown_rows(spark.createDataFrame([("a|b", None)], "x string, y int"), ["x", "y"]).first().line == "| a\\|b |  |"


def test_intervals_over_clusters_and_null_fit(spark):
    df = spark.createDataFrame([("g", c, int(i < c), 1) for c in range(1, 6) for i in range(5)] + [("z", 1, 0, 0)], "g string, c int, a int, b int")
    got = {r.g: r for r in V.cluster_interval(df, ["g"], "c", "a", "b", resamples=300).collect()}
    assert got["g"].clusters == 5 and got["g"].value == pytest.approx(0.6) and got["g"].low < 0.6 < got["g"].high
    assert got["z"].value is None and got["z"].low is None
    pts = spark.createDataFrame([(0.0, 1.0), (1.0, 2.1), (2.0, 2.9), (3.0, 4.2)], "x double, y double")
    r = V.prediction_interval(V.fit_null(pts, [], "x", "y", 1.5, 5.0)).first()
    assert r.slope == pytest.approx(1.04) and r.prediction == pytest.approx(2.55) and r.high - r.prediction == pytest.approx(4.302653 * r.prediction_se, rel=1e-6)
    assert V.prediction_interval(V.fit_null(pts.limit(2), [], "x", "y", 1.5, 5.0)).first().high is None
    s = V.spread(spark.createDataFrame([(float(i),) for i in range(1, 101)], "v double"), [], "v", 3.0).first()
    assert s.n == 100 and s.median == 50.5 and s.p_value == pytest.approx(0.06)


def test_relations(spark):
    t = "ACGTTGCAAACCCGGGTTTACGATCGATTAGC"
    found = [t, t[:5] + "N" + t[6:], t[3:20], t + "AAAA", "TTTTTTTT" + t[:25], "GGGGGGGG", None, ""]
    df = spark.createDataFrame([(i, f, t) for i, f in enumerate(found)], "i int, f string, t string")
    want = [*V.RELATIONS, None, "differs"]
    assert [r[0] for r in df.select(V.relation("f", "t"), "i").orderBy("i").collect()] == want
    turned = df.withColumn("f", reverse_complement("f"))
    assert [r[0] for r in turned.select(V.relation("f", "t"), "i").orderBy("i").collect()] == want
    best = V.best_relation(df.withColumn("r", V.relation("f", "t")).filter("i > 1 and r is not null").withColumn("n", F.length("f")), ["t"], "r", "n").first()
    assert best.i == 2 and best.candidates == 5


def test_single_copy_and_canonical_difference(spark):
    df = spark.createDataFrame([("u", "g1", 90.0), ("u", "g2", 80.0), ("v", "g1", 99.0), ("w", "g1", 1.0), ("w", "g2", 1.0), ("w", "g2", 2.0)], "u string, g string, i double")
    assert [tuple(r) for r in V.single_copy(df, "u", "g", "i").collect()] == [("u", 2, 85.0, 80.0, 90.0)]
    a, b = spark.createDataFrame([("AAC",), ("GG",), (None,)], "s string"), spark.createDataFrame([("GTT",), ("GG",), ("CC",)], "s string")
    assert [(r.old, r.new) for r in V.canonical_difference(a, b, "s").collect()] == [(1, 2)]
    assert V.canonical_difference(a, a, "s").isEmpty()


def test_simulation(spark):
    runs = simulate.manifest(spark, {"depth": [5, 20], "gc": [0.3]}, replicates=3)
    assert runs.count() == 6 and runs.select("seed").distinct().count() == 6
    genome = "ACGTTGCATT" * 100
    g = spark.createDataFrame([("c1", genome), ("short", "ACGT"), ("none", None)], "id string, seq string")
    rows = simulate.read_pairs(g, "id", "seq", F.lit(10.0), 7).collect()
    assert len(rows) == 50 and all(len(r.read_1) == len(r.read_2) == 100 for r in rows)
    rc = str.maketrans("ACGT", "TGCA")
    for i, r in enumerate(sorted(rows, key=lambda r: r.name)):
        fragment = genome[r.start : r.start + 300]
        ends = [fragment[:100], fragment[-100:].translate(rc)[::-1]]
        assert [r.read_1, r.read_2] == (ends[::-1] if i % 2 else ends)
    noisy = simulate.read_pairs(g.repartition(3), "id", "seq", F.lit(10.0), 7, error=0.05)
    again = {r.name: r for r in noisy.collect()}
    assert again == {r.name: r for r in noisy.collect()}
    wrong = sum(a != b for r in rows for a, b in zip(r.read_1 + r.read_2, again[r.name].read_1 + again[r.name].read_2, strict=True))
    assert 300 < wrong < 700
    mates = simulate.subsample(noisy.select("name", F.explode(F.array("read_1", "read_2"))), "name", 0.5, 3).groupBy("name").count().collect()
    assert 10 < len(mates) < 40 and {r["count"] for r in mates} == {2}
    assert simulate.mixture(noisy, noisy, "name", 0.0, 1).groupBy("origin").count().collect() == [("A", 50)]


def test_contexts_and_rank(spark):
    edges = [("t+", "a+", "a", "ACGTACGTAC", 2), ("t+", "b+", "b", "TTTT", 0), ("b+", "c+", "c", "GGGGGGGG", 1), ("x+", "x+", "x", "AC", 0), ("y+", "z+", "z", "A", 5)]
    e = spark.createDataFrame(edges, "src string, dst string, segment string, seq string, overlap int")
    anchors = spark.createDataFrame([(1, "t+", "CC", ["t"], 6), (2, "x+", "", ["x"], 6), (3, "q+", "", ["q"], 6), (4, "y+", "", ["y"], 6), (5, "q+", "ACGTACG", ["q"], 6)], "anchor int, node string, flank string, targets array<string>, min_bp int")
    got = {r.anchor: (len(r.signatures), r.flags) for r in graph.contexts(anchors, e, stored(spark)).collect()}
    assert got == {1: (2, []), 2: (0, ["CYCLE_ENCOUNTERED"]), 3: (0, ["NO_CONTEXT_EDGE"]), 4: (0, ["INVALID_GRAPH_OVERLAP"]), 5: (1, [])}
    few = {r.anchor: r.flags for r in graph.contexts(anchors, e, stored(spark), max_paths=1).collect()}
    assert few[1] == ["MAX_CONTEXT_PATHS_REACHED"]
    assert graph.contexts(anchors.filter("anchor = 1"), e, stored(spark), max_nodes=1).first().flags == ["MAX_CONTEXT_NODES_REACHED"]
    links = spark.createDataFrame([(1, 2, 5), (2, 3, 9), (7, 8, 30)], "a long, b long, o int")
    assert graph.component_overlap(links, spark.createDataFrame([(1,)], "segment long"), "a", "b", "o", stored(spark)).first()[0] == 9
    scores = spark.createDataFrame([("p", 50.0, 2.0, 10), ("q", 50.0, 3.0, 10), ("r", 0.0, 0.0, 99)], "ref string, breadth double, mean_depth double, length int")
    ranks = graph.ranked_paths(scores, []).orderBy("rank").collect()
    assert [(r.ref, r.candidate, r.informative) for r in ranks] == [("q", "path_1", True), ("p", "path_2", True), ("r", "path_3", True)]


def test_comparisons_choose_among_copies(spark):
    rng = __import__("numpy").random.default_rng(12)
    base = lambda n: "".join("ACGT"[i] for i in rng.integers(0, 4, n))
    a, b = base(200), base(180)
    near = a[:90] + {"A": "C", "C": "G", "G": "T", "T": "A"}[a[90]] + a[91:]
    gapped = b[:80] + b[83:]
    returned = [("k", "same", b), ("k", "part", a[10:150].lower()), ("k", "near", near), ("k", "gapped", gapped), ("k", "dashes", a[:50] + "--" + a[50:]), ("k", "null", None), ("k", "empty", ""), ("gone", "any", a), ("k", "far", base(90))]
    truths = [("k", "t2", a), ("k", "t1", b), ("k", "t3", a), ("k", "t4", None), ("other", "t", a)]
    r, t = spark.createDataFrame(returned, "g string, seq_id string, seq string"), spark.createDataFrame(truths, "g string, truth_name string, truth string")
    got = {x.seq_id: x for x in V.comparisons(r, t, ["g"]).collect()}
    assert len(got) == 8 and "null" not in got
    tell = lambda n: (got[n].truth_name, got[n].comparison, got[n].aligned_bp, got[n].mismatches, got[n].gap_columns, got[n].edit_distance)
    assert tell("same") == ("t1", "identical", 180, 0, 0, 0) and tell("dashes") == ("t2", "identical", 200, 0, 0, 0)
    assert tell("part") == ("t2", "incomplete, identical over its own length", 140, 0, 0, 60)
    assert tell("near") == ("t2", "differs", 200, 1, 0, 1) and got["near"].identity_pct == 99.5
    assert tell("gapped") == ("t1", "differs", 180, 0, 3, 3)
    assert got["any"].comparison == V.ABSENT and got["any"].truth_name is None
    assert got["far"].comparison == V.NO_ALIGNMENT and got["empty"].comparison == V.NO_ALIGNMENT
    assert V.comparisons(r.limit(0), t, ["g"]).collect() == []
    assert {x.seq_id: x.comparison for x in V.comparisons(r.drop("g").filter("seq_id = 'same'"), t.drop("g"), []).collect()} == {"same": "identical"}
