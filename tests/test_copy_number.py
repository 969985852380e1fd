"""Depth ratio and dosage against a plain version, and the cases that a call must get right."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from strandloom.operators import copy_number, decisions
from strandloom.plans import genomic

SETTINGS = {"min_contig": 500, "trim": 10, "block": 40, "resamples": 60, "cap": 12}
DEPTH, CONTIGS = "sample string, contig string, pos long, depth int, depth_raw int", "sample string, contig string, length long, ord int"
REGIONS = "sample string, target string, region int, contig string, start long, end long, gene_start long, gene_end long"


def jitter(level, n, seed, spread=3):
    rng = random.Random(seed)
    return [max(0, level + rng.randint(-spread, spread)) for _ in range(n)]


def plain(depths, lengths, regions, gene_length, excluded=(), raw=None, **kw):
    """One target, position by position."""
    o = {**SETTINGS, "seed": 20260817, **kw}
    parts = [depths[c][s - 1 : e] for c, s, e, *_ in regions]
    locus = [v for p in parts for v in p]
    out = [(c, s, e) for c, s, e, *_ in regions] + list(excluded)
    back = [v for c, n in lengths if n >= o["min_contig"] for i, v in enumerate(depths[c], 1) if o["trim"] < i <= n - o["trim"] and not any(c == x and a <= i <= b for x, a, b in out)]
    base = statistics.median(back)
    cut = lambda xs: [xs[i : i + o["block"]] for i in range(0, len(xs), o["block"])]
    kept = cut(back)
    if len(kept) > o["cap"]:
        kept = [kept[round(i * (len(kept) - 1) / (o["cap"] - 1))] for i in range(o["cap"])]
    draw = lambda rng, b: statistics.median([v for _ in [[rng.randrange(len(b)) for _ in b]] for j in _ for v in b[j]])
    rng, ratios = random.Random(o["seed"]), []
    for _ in range(o["resamples"]):
        top, low = draw(rng, cut(locus)), draw(rng, kept)
        ratios += [top / low] if low > 0 else []
    ratios.sort()
    n = len(ratios)
    cover = [[i for i, (*_, a, b) in enumerate(regions) if min(a, b) <= j <= max(a, b)] for j in range(1, gene_length + 1)]
    each = [statistics.median(p) / base for p in parts]
    sums = [sum(each[i] for i in m) for m in cover]
    held = [x for x, m in zip(sums, cover, strict=True) if m]
    return {
        "ratio": statistics.median(locus) / base, "backbone_mad": statistics.median([abs(v - base) for v in back]), "ratio_ci_low": ratios[max(0, int(n * 0.025) - 1)], "ratio_ci_high": ratios[min(n - 1, int(n * 0.975))],
        "dosage_estimate": sum(held) / len(held), "dosage_lower": sum(held) / gene_length, "dosage_upper": (sum(held) + (gene_length - len(held)) * max(held)) / gene_length,
        "gene_overlap_bp": sum(len(m) - 1 for m in cover if m), "query_multiplicity_max": max(held),
    }


def run(spark, samples, excluded=(), calibration=None, **kw):
    """samples: {sample: (depths by contig, regions by target, gene length by target, raw by contig or None)}"""
    rows, contigs, regions, targets = [], [], [], []
    for name, (depths, by_target, genes, raw) in samples.items():
        for k, (c, v) in enumerate(depths.items()):
            rows += [(name, c, i, d, (raw or depths)[c][i - 1]) for i, d in enumerate(v, 1)]
            contigs.append((name, c, len(v), k))
        for t, parts in by_target.items():
            regions += [(name, t, i, *p) for i, p in enumerate(parts)]
            targets.append((name, t, genes[t], calibration))
    ex = spark.createDataFrame([("a", *x) for x in excluded], "sample string, contig string, start long, end long") if excluded else None
    out = copy_number.depth_ratio(
        spark.createDataFrame(rows, DEPTH), spark.createDataFrame(contigs, CONTIGS), spark.createDataFrame(regions, REGIONS), spark.createDataFrame(targets, "sample string, target string, gene_length long, calibration double"),
        ["sample"], ex, calibration="calibration" if calibration else None, **{**SETTINGS, **kw},
    )
    return {(r["sample"], r["target"]): r for r in out.collect()}


def test_against_a_plain_version(spark):
    depths = {"z": jitter(50, 900, 1), "b": jitter(52, 1300, 2), "tiny": jitter(9, 100, 3)}
    depths["b"][399:480] = jitter(150, 81, 4)
    depths["z"][99:160] = jitter(101, 61, 5)
    targets = {"split": [("b", 400, 480, 1, 81), ("z", 100, 160, 120, 61)], "part": [("z", 100, 160, 10, 70)]}
    genes = {"split": 130, "part": 100}
    got = run(spark, {"a": (depths, targets, genes, None)}, excluded=[("b", 700, 820)])
    for name, parts in targets.items():
        want, r = plain(depths, [("z", 900), ("b", 1300), ("tiny", 100)], parts, genes[name], [("b", 700, 820)]), got["a", name]
        for k, v in want.items():
            assert r[k] == pytest.approx(v, abs=6e-3 if k == "backbone_mad" else 6e-4), (name, k)
    s = got["a", "split"]
    assert s.dosage_status == "REVIEW_OVERLAPPING_SPANS" and "OVERLAPPING_QUERY_SPANS" in s.dosage_flags and s.geometry_expected_dosage == pytest.approx(141 / 120, abs=1e-3)
    assert got["a", "part"].dosage_status == "ESTIMATED_PARTIAL_COVERAGE" and got["a", "part"].single_copy_rejected and got["a", "part"].depth_call == "MULTICOPY_DEPTH"


def test_a_long_backbone_leaves_its_scan_as_counts(spark, tmp_path):
    depths = {"z": jitter(50, 41_000, 1), "b": jitter(52, 23_000, 2)}
    depths["b"][399:480] = jitter(150, 81, 4)
    regions, stored = {"t": [("b", 400, 480, 1, 81)]}, []

    def keep(name, df):
        path = f"{tmp_path}/{len(stored)}-{name}"
        df.write.parquet(path)
        out = spark.read.schema(df.schema).parquet(path)
        stored.append(out.count())
        return out

    few = {"cap": 2, "resamples": 20}
    got = run(spark, {"a": (depths, regions, {"t": 81}, None)}, excluded=[("z", 9_990, 10_010)], keep=keep, **few)["a", "t"]
    for k, v in plain(depths, [("z", 41_000), ("b", 23_000)], regions["t"], 81, [("z", 9_990, 10_010)], **few).items():
        assert got[k] == pytest.approx(v, abs=6e-3 if k == "backbone_mad" else 6e-4), k
    assert max(stored) < 1_000


def test_lines_of_a_flag_are_not_numbered_in_one_task(spark, sf_dir, monkeypatch):
    given = []
    monkeypatch.setattr(genomic.copy_number, "depth_ratio", lambda depth, *_, **__: given.append(depth) or _stop())
    with pytest.raises(StopIteration):
        genomic.locus_dosage(spark, sf_dir)
    depth = given[0]
    assert "Window" not in depth._jdf.queryExecution().toString()
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    ends = {r.contig: (r.a, r.b, r.n) for r in depth.groupBy("contig").agg(F.min("pos").alias("a"), F.max("pos").alias("b"), F.count_distinct("pos").alias("n")).collect()}
    assert ends == {r.l_returnflag: (1, r["count"], r["count"]) for r in lines}


def _stop():
    raise StopIteration


def one(level, raw=None, back=50, spread=3, n=300):
    depths = {"bb": jitter(back, 2000, 7, spread), "locus": jitter(level, n, 8, spread)}
    return depths, {"t": [("locus", None, None, None, None)]}, {"t": None}, {**depths, "locus": jitter(raw, n, 8, spread)} if raw else None


def test_calls(spark):
    none = {"bb": [0] * 2000, "locus": jitter(50, 300, 8)}
    got = run(spark, {"single": one(50), "four": one(200), "vague": one(100, raw=300), "gone": one(20), "zero": (none, {"t": [("locus", 1, 300, None, None)]}, {"t": None}, None), "half": one(125, spread=0)})
    r = {s: v for (s, _), v in got.items()}
    assert r["single"].depth_call == "SINGLE_COPY_COMPATIBLE" and r["four"].depth_call == "MULTICOPY_DEPTH" and 3.5 < r["four"].ratio < 4.5
    # One region of a whole gene: the dosage is the ratio.
    assert r["four"].dosage_estimate == pytest.approx(r["four"].ratio, abs=1e-3) and r["four"].dosage_status == "ESTIMATED"
    # Ambiguous mapping lowers depth, so a call above the threshold stands, as a floor.
    assert r["vague"].single_copy_rejected and not r["vague"].reliable and r["vague"].dosage_status == "LOWER_BOUND" and "RATIO_IS_LOWER_BOUND" in r["vague"].notes
    assert "RATIO_WELL_BELOW_ONE" in r["gone"].notes
    assert (r["zero"].ratio, r["zero"].depth_call, r["zero"].dosage_status, r["zero"].reliable) == (0.0, "DEPTH_INDETERMINATE", "NOT_ESTIMATED", False)
    assert r["half"].ratio == 2.5 and "INTERVAL_WITHOUT_INTEGER" in r["half"].notes and "INTERVAL_EXCLUDES_ONE" in r["half"].notes


def test_geometry_that_is_missing_or_does_not_fit(spark):
    depths = {"bb": jitter(50, 2000, 7), "x": jitter(50, 300, 8), "y": [0] * 200}
    got = run(spark, {"a": (depths, {"none": [("x", 1, 300, None, None), ("y", 1, 200, None, None)], "some": [("x", 1, 300, 1, 300), ("y", 1, 200, None, None)], "zero": [("x", 1, 300, 1, 300), ("y", 1, 200, 301, 500)]}, {"none": 500, "some": 500, "zero": 500}, None)})
    assert got["a", "none"].dosage_flags == ["MISSING_QUERY_GEOMETRY"] and got["a", "none"].dosage_estimate is None
    assert "GENE_SPAN_COUNT_MISMATCH" in got["a", "some"].dosage_flags
    assert got["a", "zero"].dosage_flags == ["ZERO_RATIO_REGIONS"] and got["a", "zero"].region_ratios[1] == 0


@pytest.mark.parametrize(("calibration", "call", "source", "used"), [(1.2, "MULTICOPY_DEPTH", "CALIBRATED_FLOOR_HELD", 1.5), (2.6, "SINGLE_COPY_COMPATIBLE", "CALIBRATED_RAISED", 2.6)])
def test_calibration_raises_only(spark, calibration, call, source, used):
    r = run(spark, {"a": one(100)}, calibration=calibration)["a", "t"]
    assert (r.depth_call, r.call_threshold_source, r.call_threshold_used) == (call, source, used)


def test_weighted_copies_equal_the_profile_of_disjoint_spans(spark):
    rows = [("g", 0, 1, 60, 100, 2.0), ("g", 1, 100, 61, 100, 0.5), ("out", 0, 200, 300, 100, 1.0)]
    spans = spark.createDataFrame(rows, "g string, region int, gene_start long, gene_end long, gene_length long, ratio double")
    w = {r.g: r.copies for r in copy_number.weighted_copies(spans, ["g"]).collect()}
    p = {r.g: r for r in copy_number.copy_profile(spans, ["g"]).collect()}
    assert w["g"] == pytest.approx(1.4) == p["g"].dosage == p["g"].dosage_lower == p["g"].dosage_upper
    assert w["out"] == 0 and p["out"].dosage is None and p["out"].covered_bp == 0


CONSENSUS = [
    # exact, status, call, reliable, low, high, dosage, dosage status -> value, kind, method, status, low bound, high bound
    ((3, "MATCHED_CONTEXT_COUNT", 3, "MULTICOPY_DEPTH", True, 2.8, 3.3, 3.1, "ESTIMATED"), (3, "INTEGER_CONTEXT_COUNT", "GRAPH_DEPTH_CONSENSUS", "SUPPORTED", 3, 3, [])),
    ((3, "MATCHED_CONTEXT_COUNT", 3, "MULTICOPY_DEPTH", True, 4.8, 5.3, 5.1, "ESTIMATED"), (3, "INTEGER_CONTEXT_COUNT", "GRAPH_COUNT_OVER_DISCORDANT_DEPTH", "REVIEW", 3, None, ["DEPTH_GRAPH_NUMERIC_DISCORDANCE"])),
    ((1, "MATCHED_CONTEXT_COUNT", 1, "SINGLE_COPY_COMPATIBLE", True, 0.9, 1.1, 1.0, "ESTIMATED"), (1, "INTEGER_CONTEXT_COUNT", "GRAPH_DEPTH_CONSENSUS", "SUPPORTED", 1, 1, [])),
    ((1, "MATCHED_CONTEXT_COUNT", 1, "MULTICOPY_DEPTH", True, 1.8, 2.2, 2.0, "REVIEW_OVERLAPPING_SPANS"), (2.0, "MEAN_DEPTH_DOSAGE", "DEPTH_TANDEM_COMPATIBLE", "REVIEW", None, None, ["DEPTH_GRAPH_NUMERIC_DISCORDANCE", "GRAPH_SINGLE_CONTEXT_TANDEM_DEPTH", "DOSAGE_REVIEW_OVERLAPPING_SPANS"])),
    ((2, "MATCHED_CONTEXT_COUNT", 2, "SINGLE_COPY_COMPATIBLE", True, 0.9, 2.1, 1.0, "ESTIMATED"), (None, "NOT_ESTIMATED", "NONE", "EVIDENCE_CONFLICT", None, None, ["GRAPH_MULTICOPY_DEPTH_SINGLE_COPY_COMPATIBLE"])),
    ((None, "ASYMMETRIC_CONTEXTS", 2, "MULTICOPY_DEPTH", True, 2.8, 3.2, 3.0, "ESTIMATED"), (None, "LOWER_BOUND", "GRAPH_LOWER_BOUND", "LOWER_BOUND", 2, None, [])),
    # Depth that is not reliable supports no count: the larger floor is all there is.
    ((3, "MATCHED_CONTEXT_COUNT", 3, "MULTICOPY_DEPTH", False, 1.8, 2.2, 2.0, "LOWER_BOUND"), (None, "LOWER_BOUND", "GRAPH_LOWER_BOUND", "LOWER_BOUND", 3, None, ["DEPTH_LOWER_BOUND"])),
    ((1, "MATCHED_CONTEXT_COUNT", 1, "MULTICOPY_DEPTH", False, 1.8, 2.2, 2.4, "LOWER_BOUND"), (None, "LOWER_BOUND", "DEPTH_ONLY", "LOWER_BOUND", 2.4, None, ["DEPTH_LOWER_BOUND"])),
    ((None, "GRAPH_INDETERMINATE", None, "MULTICOPY_DEPTH", False, 1.8, 2.2, 2.4, "LOWER_BOUND"), (None, "LOWER_BOUND", "DEPTH_ONLY", "LOWER_BOUND", 2.4, None, ["DEPTH_LOWER_BOUND", "GRAPH_EVIDENCE_UNRESOLVED"])),
    ((None, None, None, "SINGLE_COPY_COMPATIBLE", True, 0.9, 1.2, 1.04, "ESTIMATED"), (1.04, "MEAN_DEPTH_DOSAGE", "DEPTH_ONLY", "SUPPORTED", None, None, [])),
    ((None, "GRAPH_INDETERMINATE", None, "MULTICOPY_DEPTH", True, 1.9, 2.2, 2.04, "ESTIMATED_PARTIAL_COVERAGE"), (2.04, "MEAN_DEPTH_DOSAGE", "DEPTH_ONLY", "REVIEW", None, None, ["GRAPH_EVIDENCE_UNRESOLVED", "DOSAGE_ESTIMATED_PARTIAL_COVERAGE"])),
    ((None, "GRAPH_INDETERMINATE", None, "DEPTH_INDETERMINATE", False, 0.0, 0.0, None, "NOT_ESTIMATED"), (None, "NOT_ESTIMATED", "NONE", "INDETERMINATE", None, None, ["GRAPH_EVIDENCE_UNRESOLVED", "DEPTH_EVIDENCE_UNRELIABLE"])),
]


def test_consensus(spark):
    rows = [(i, *given) for i, (given, _) in enumerate(CONSENSUS)]
    df = spark.createDataFrame(rows, "i int, exact int, graph_status string, lower int, depth_call string, reliable boolean, ci_low double, ci_high double, dosage double, dosage_status string")
    c = F.col
    depth = F.struct(c("depth_call"), c("reliable"), c("ci_low"), c("ci_high"), c("dosage"), c("dosage_status"))
    graph = F.when(c("graph_status").isNotNull(), F.struct(c("graph_status").alias("status"), c("exact"), c("lower").alias("lower_bound")))
    got = {r.i: tuple(r.c) for r in df.select("i", decisions.consensus(depth, graph).alias("c")).collect()}
    for i, (given, want) in enumerate(CONSENSUS):
        assert got[i] == want, given
