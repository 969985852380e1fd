"""Queries of quality control, graphs, formats and scores, each with SQL of the same result; inputs as in ``genomic``."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.functions import sequence as S
from strandloom.operators import discovery, evaluation, evidence, graph, quality_control, scoring
from strandloom.plans.genomic import _DUCK_SEQS, _FRAMES, _RC, _SPARK_SEQS, Query, _rel
from strandloom.sources import readers, writers
from strandloom.sources.scratch import keeper, shared_folder

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _query(sql: str):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        SQL[f.__name__] = re.sub(r"\{(\w+)\}", r"\1", sql)
        return f

    return add


def _duck(sql: str) -> str:
    return sql.replace("AS STRING", "AS VARCHAR")


# -- quality control -------------------------------------------------------------------------------------------------

_BAD = {
    "validation_identity": (3, "80.0 + n % 20", "99.0"), "validation_qcov": (5, "75.0 + n % 24", "99.0"), "n_fraction": (7, "(n % 15) / 1000.0", "0.0"), "gc_deviation": (11, "(n % 23) / 2.0", "1.0"), "mean_depth": (13, "1.0 * (n % 29)", "30.0"),
    "breadth_pct": (17, "85.0 + n % 16", "100.0"), "pct_bases_lt5": (4, "1.0 * (n % 19)", "0.0"), "tier_uncertain_base_fraction": (19, "(n % 21) / 100.0", "0.0"), "mean_base_quality": (23, "15.0 + n % 20", "35.0"), "mean_mapping_quality": (29, "15.0 + n % 31", "50.0"),
    "strand_balance_pct": (31, "1.0 * (n % 50)", "60.0"), "length_ratio": (6, "(n % 37) / 10.0", "0.5"),
}
_METRICS = "SELECT o_orderkey AS id, o_orderkey % 10 <> 1 AS per_base_available, " + ", ".join(f"CAST(CASE WHEN o_orderkey % {p} = 0 THEN {bad.replace('n %', f'CAST(floor(o_orderkey / {p}) AS BIGINT) %')} ELSE {good} END AS DOUBLE) AS {name}" for name, (p, bad, good) in _BAD.items()) + """,
o_orderkey % 9 AS length_profile_n, CASE WHEN o_orderkey % 37 = 0 THEN 2 ELSE 0 END AS internal_stops, CASE WHEN o_orderkey % 37 = 0 THEN o_orderkey % 3 ELSE 0 END AS internal_stops_placeholder_closed, CASE WHEN o_orderkey % 2 = 0 THEN 12 ELSE 0 END AS placeholder_bp_excised, o_orderkey % 41 = 0 AS frame_disrupted, 2 AS length_mod3,
CASE WHEN o_orderkey % 8 = 0 THEN o_orderkey % 23 ELSE 0 END AS clipped_bp, CASE WHEN o_orderkey % 43 = 0 THEN 3 ELSE 0 END AS internal_zero_depth_positions, o_orderkey % 47 = 0 AS ambiguous, CAST(4 AS DOUBLE) AS bitscore_margin, CASE WHEN o_orderkey % 14 = 0 THEN o_orderkey % 3 ELSE 0 END AS mixed_site_count, o_orderkey % 14 = 0 AND o_orderkey % 3 = 2 AS mixture_detected,
o_orderkey % 5 AS candidate_mixed_sites, CASE WHEN o_orderkey % 53 = 0 THEN 1 ELSE 0 END AS strand_biased_sites, CASE WHEN o_orderkey % 59 = 0 THEN 1 ELSE 0 END AS reference_discordant_sites, CASE WHEN o_orderkey % 24 = 0 THEN 'c2' END AS continuation_contig FROM {orders}"""


def _graded(c: str, sign: str, limits: tuple, names: tuple, scale: str = "") -> str:
    return "CASE " + " ".join(f"WHEN {c}{scale} {sign} {v} THEN '{n}'" for v, n in reversed(list(zip(limits, names, strict=True)))) + " END"


_FLAGS = ", ".join([
    _graded("length_ratio", ">", (1, 2, 3), ("LENGTH_MARGINAL", "LENGTH_DEVIANT", "LENGTH_ANOMALOUS")), "CASE WHEN length_ratio > 1 AND length_profile_n BETWEEN 1 AND 4 THEN 'CATALOGUE_LENGTH_PROFILE_UNDERPOWERED' END",
    _graded("validation_identity", "<", (97, 93, 85), ("CATALOGUE_DIVERGENCE_BELOW_HIGH", "CATALOGUE_DIVERGENT", "CATALOGUE_HIGHLY_DIVERGENT")), _graded("validation_qcov", "<", (95, 90, 80), ("COVERAGE_BELOW_HIGH", "REDUCED_COVERAGE", "LOW_COVERAGE")),
    _graded("n_fraction", ">", (0.001, 0.005, 0.01), ("SOME_N_CONTENT", "ELEVATED_N_CONTENT", "HIGH_N_CONTENT")), _graded("gc_deviation", ">", (3, 5, 8), ("GC_BELOW_HIGH", "GC_SHIFT", "GC_ANOMALY")),
    "CASE WHEN internal_stops > 0 THEN 'INTERNAL_STOPS' END", "CASE WHEN internal_stops > 0 AND placeholder_bp_excised > 0 AND internal_stops_placeholder_closed < internal_stops THEN 'PLACEHOLDER_FRAMESHIFT_EXPLAINS_STOPS' END",
    "CASE WHEN frame_disrupted AND clipped_bp >= 10 THEN 'FRAME_LENGTH_SHIFT_TRUNCATED' WHEN frame_disrupted THEN 'FRAME_LENGTH_SHIFT' END",
    _graded("mean_depth", "<", (20, 10, 5), ("REMAP_DEPTH_BELOW_HIGH", "REDUCED_REMAP_DEPTH", "LOW_REMAP_DEPTH")), _graded("breadth_pct", "<", (99, 97, 90), ("REMAP_BREADTH_BELOW_HIGH", "REDUCED_REMAP_BREADTH", "LOW_REMAP_BREADTH")),
    _graded("pct_bases_lt5", ">", (1, 5, 15), ("REMAP_PATCHINESS_BELOW_HIGH", "MODEST_REMAP_PATCHINESS", "PATCHY_REMAP_SUPPORT")),
    "CASE WHEN per_base_available THEN " + _graded("tier_uncertain_base_fraction", ">", (1, 5, 15), ("UNCERTAIN_BASES_BELOW_HIGH", "ELEVATED_UNCERTAIN_BASES", "WIDESPREAD_UNCERTAIN_BASES"), " * 100") + " END",
    "CASE WHEN per_base_available AND internal_zero_depth_positions > 0 THEN 'INTERNAL_ZERO_DEPTH_GAP' END", "CASE WHEN ambiguous THEN 'AMBIGUOUS_BEST_HIT' END",
    "CASE WHEN per_base_available THEN " + _graded("mean_base_quality", "<", (30, 25, 20), ("BASE_QUALITY_BELOW_HIGH", "REDUCED_BASE_QUALITY", "LOW_BASE_QUALITY")) + " END",
    "CASE WHEN per_base_available THEN " + _graded("mean_mapping_quality", "<", (40, 30, 20), ("MAPPING_QUALITY_BELOW_HIGH", "REDUCED_MAPPING_QUALITY", "LOW_MAPPING_QUALITY")) + " END",
    "CASE WHEN per_base_available THEN " + _graded("strand_balance_pct", "<", (40, 25, 10), ("STRAND_BALANCE_BELOW_HIGH", "STRAND_IMBALANCE", "SEVERE_STRAND_IMBALANCE")) + " END",
    "CASE WHEN per_base_available AND mixture_detected THEN 'ALLELE_MIXTURE' WHEN per_base_available AND mixed_site_count > 0 THEN 'MIXED_SITE_BELOW_MIXTURE_CALL' END", "CASE WHEN per_base_available AND candidate_mixed_sites > 0 AND strand_biased_sites > 0 THEN 'STRAND_BIASED_ALT_SUPPORT' END",
    "CASE WHEN per_base_available AND reference_discordant_sites > 0 THEN 'REFERENCE_DISCORDANCE' END", "CASE WHEN clipped_bp >= 10 THEN 'ALLELE_SPAN_CLIPPED_AT_CONTIG_END' END", "CASE WHEN clipped_bp >= 10 AND continuation_contig IS NOT NULL THEN 'LOCUS_SPLIT_ACROSS_CONTIGS' END",
])
_SEVERE = "'LOW_COVERAGE', 'HIGH_N_CONTENT', 'GC_ANOMALY', 'INTERNAL_STOPS', 'LOW_REMAP_DEPTH', 'LOW_REMAP_BREADTH', 'AMBIGUOUS_BEST_HIT', 'FRAME_LENGTH_SHIFT', 'LOW_BASE_QUALITY', 'LOW_MAPPING_QUALITY', 'SEVERE_STRAND_IMBALANCE', 'ALLELE_MIXTURE', 'STRAND_BIASED_ALT_SUPPORT', 'REFERENCE_DISCORDANCE', 'INTERNAL_ZERO_DEPTH_GAP', 'LOCUS_SPLIT_ACROSS_CONTIGS'"


@_query(
    f"""WITH m AS ({_METRICS}), f AS (SELECT *, list_filter([{_FLAGS}], lambda x: x IS NOT NULL) AS f FROM m),
    t AS (SELECT *, list_filter(f, lambda x: NOT (x LIKE 'CATALOGUE%' OR x IN ('PATCHY_REMAP_SUPPORT', 'MODEST_REMAP_PATCHINESS', 'REMAP_PATCHINESS_BELOW_HIGH', 'MIXED_SITE_BELOW_MIXTURE_CALL', 'FRAME_LENGTH_SHIFT_TRUNCATED', 'PLACEHOLDER_FRAMESHIFT_EXPLAINS_STOPS'))) AS c, len(list_filter(f, lambda x: x IN ({_SEVERE}))) > 0 AS severe FROM f),
    r AS (SELECT *, len(list_filter(f, lambda x: x LIKE 'LENGTH%')) > 0 AS has_length FROM t)
    SELECT id, array_to_string(CASE WHEN has_length AND NOT severe AND validation_identity >= 97 THEN list_append(f, 'POSSIBLE_NOVEL_ALLELE') ELSE f END, ';') AS flags,
    CASE WHEN len(c) = 0 THEN 'HIGH' WHEN severe THEN 'SUSPECT' WHEN has_length AND len(c) = 1 THEN 'MEDIUM' WHEN len(c) <= 1 AND length_ratio <= 2 THEN 'MEDIUM' WHEN len(c) <= 2 AND length_ratio <= 3 THEN 'LOW' ELSE 'SUSPECT' END AS sequence_confidence,
    CASE WHEN validation_identity >= 100 THEN 'EXACT_MATCH' WHEN validation_identity < 85 THEN 'HIGHLY_DIVERGENT_FROM_REFERENCE' WHEN validation_identity < 97 THEN 'DIVERGENT_FROM_REFERENCE' ELSE 'NONEXACT_MATCH' END AS catalogue_status FROM r"""
)
def quality_flags(spark: SparkSession, d: str) -> DataFrame:
    """Every flag, the tier and the catalogue status of measures that the orders' keys give."""
    a = quality_control.assessed(_rel(spark, d, _METRICS))
    return a.select("id", F.array_join(F.transform("qc_flag_list", lambda f: f["name"]), ";").alias("flags"), "sequence_confidence", "catalogue_status")


_CATALOGUE = "SELECT CAST(id % 25 AS INT) AS g, id, substr(seq, 1, CAST(60 + id % 13 AS INT)) AS seq FROM ({seqs}) AS q"


@_query(
    f"""WITH s AS (SELECT g, id, seq, {_RC("seq")} AS rc, length(seq) AS n, CAST(length(seq) - length(translate(seq, 'GC', '')) AS DOUBLE) AS gc FROM ({_CATALOGUE.replace("{seqs}", _DUCK_SEQS)})), f AS (SELECT g, unnest({_FRAMES}) AS frame FROM s), st AS (SELECT g, frame.label AS label, sum(frame.n) AS stops FROM f GROUP BY ALL), least_ AS (SELECT g, min(stops) AS m FROM st GROUP BY g),
    fr AS (SELECT g, string_agg(label, ',' ORDER BY label) AS labels FROM st JOIN least_ USING (g) WHERE stops = m GROUP BY g), c AS (SELECT g, n, count(*) AS k FROM s GROUP BY ALL), mo AS (SELECT g, arg_min(n, (-k, n)) AS mode FROM c GROUP BY g), th AS (SELECT g, arg_min(m, (-k, f)) AS m3 FROM (SELECT g, n % 3 AS m, sum(k) AS k, min(n) AS f FROM c GROUP BY ALL) GROUP BY g)
    SELECT g, count(*) AS n_alleles, CAST(min(n) AS INT) AS len_min, CAST(max(n) AS INT) AS len_max, median(n) AS len_median, round(avg(n), 6) AS len_mean, round(stddev_pop(n), 6) AS len_stdev, quantile_cont(n, 0.25) AS len_q1, quantile_cont(n, 0.75) AS len_q3, CAST(any_value(mode) AS INT) AS len_mode, CAST(any_value(m3) AS INT) AS len_mod3_mode, round(avg(100.0 * gc / n), 6) AS gc_mean, any_value(labels) AS labels
    FROM s JOIN mo USING (g) JOIN th USING (g) JOIN fr USING (g) GROUP BY g"""
)
def catalogue_profiles(spark: SparkSession, d: str) -> DataFrame:
    """Lengths, composition and reading frames of 25 catalogues."""
    p = quality_control.catalogue_profile(_rel(spark, d, _CATALOGUE.replace("{seqs}", _SPARK_SEQS)), ["g"])
    return p.select("g", "n_alleles", "len_min", "len_max", "len_median", F.round("len_mean", 6).alias("len_mean"), F.round("len_stdev", 6).alias("len_stdev"), "len_q1", "len_q3", "len_mode", "len_mod3_mode", F.round("gc_mean", 6).alias("gc_mean"), F.array_join(F.array_sort("expected_frame_labels"), ",").alias("labels"))


@_query(
    f"""WITH s AS (SELECT g, id, seq, length(seq) AS n FROM ({_CATALOGUE.replace("{seqs}", _DUCK_SEQS)})), p AS (SELECT g, median(n) AS med, avg(n) AS mean, stddev_pop(n) AS sd, quantile_cont(n, 0.75) - quantile_cont(n, 0.25) AS iqr, avg(100.0 * (length(seq) - length(translate(seq, 'GC', ''))) / n) AS gc FROM s GROUP BY g),
    j AS (SELECT *, CASE WHEN iqr > 0 THEN iqr ELSE greatest(sd, 3) END AS tol, CAST(n - round_even(med, 0) AS BIGINT) AS delta, CASE WHEN id % 4 = 0 THEN id % 15 ELSE 0 END AS clip, 100.0 * (n - length(translate(seq, 'GC', ''))) / n AS mine FROM s JOIN p USING (g))
    SELECT id, CAST(n AS INT) AS allele_length, delta AS length_delta, CAST(CASE WHEN clip >= 10 THEN clip ELSE 0 END AS BIGINT) AS span_restored_bp, round(CASE WHEN sd > 0.5 THEN (n - mean) / sd WHEN abs(delta) <= 1 THEN 0.0 ELSE 999.0 END, 6) AS length_zscore, round(abs(delta + CASE WHEN clip >= 10 THEN clip ELSE 0 END) / tol, 6) AS length_ratio, CAST(n - length(replace(seq, 'N', '')) AS INT) AS n_count, round(abs(mine - gc), 6) AS gc_deviation FROM j"""
)
def candidate_measures(spark: SparkSession, d: str) -> DataFrame:
    """Measures of each record against its own catalogue."""
    s = _rel(spark, d, _CATALOGUE.replace("{seqs}", _SPARK_SEQS))
    c = s.withColumn("clipped_bp", F.when(F.col("id") % 4 == 0, F.col("id") % 15).otherwise(0))
    m = quality_control.candidate_metrics(c, quality_control.catalogue_profile(s, ["g"]), ["g"])
    return m.select("id", "allele_length", "length_delta", F.col("span_restored_bp").cast("long").alias("span_restored_bp"), F.round("length_zscore", 6).alias("length_zscore"), F.round("length_ratio", 6).alias("length_ratio"), "n_count", F.round("gc_deviation", 6).alias("gc_deviation"))


_RECORDS = "SELECT CASE WHEN s_suppkey % 9 = 0 THEN 'twice' WHEN s_suppkey % 9 = 1 THEN concat('a', repeat('b', 50)) ELSE concat('r', CAST(s_suppkey AS STRING)) END AS seq_id, CASE WHEN s_suppkey % 9 = 2 THEN '' WHEN s_suppkey % 9 = 3 THEN 'AC-GT' WHEN s_suppkey % 9 = 4 THEN 'ACXGT' WHEN s_suppkey % 9 = 5 THEN 'acgtryswkmbdhvn' ELSE 'ACGT' END AS seq FROM {supplier}"


@_query(f"SELECT seq_id, problem FROM (SELECT seq_id, CASE WHEN seq_id = 'twice' THEN 'repeated id' WHEN seq = '' THEN 'empty sequence' WHEN seq LIKE '%-%' THEN 'alignment gaps' WHEN seq LIKE '%X%' THEN 'invalid symbols' WHEN length(seq_id) > 50 THEN CASE WHEN count(*) OVER (PARTITION BY seq_id) > 1 THEN 'repeated id' ELSE 'identifier too long' END END AS problem FROM ({_duck(_RECORDS)})) WHERE problem IS NOT NULL")
def catalogue_faults(spark: SparkSession, d: str) -> DataFrame:
    return quality_control.catalogue_problems(_rel(spark, d, _RECORDS))


# -- formats ---------------------------------------------------------------------------------------------------------


def _written(spark: SparkSession, lines: DataFrame) -> str:
    path = f"{shared_folder(spark)}/text"
    lines.select(lines.columns[0]).write.text(path)
    return path


@_query(f"SELECT 'p' || id AS seq_id, 'part ' || (id % 7) AS description, seq, CAST(length(seq) AS INT) AS length FROM ({_DUCK_SEQS})")
def fasta_records(spark: SparkSession, d: str) -> DataFrame:
    """Sequences written as wrapped FASTA records and read back."""
    s = _rel(spark, d, _SPARK_SEQS).select(F.concat(F.lit("p"), F.col("id").cast("string"), F.lit(" part "), (F.col("id") % 7).cast("string")).alias("seq_id"), "seq")
    path = f"{shared_folder(spark)}/fasta"
    writers.write_fasta(s, path)
    rows = readers.fasta(spark, path)
    return rows.select("seq_id", "description", "seq").join(readers.sequence_lengths(rows), "seq_id")


@_query(
    """WITH l AS (SELECT n_nationkey AS a, 'LR'[1 + n_nationkey % 2] AS x, n_regionkey + 25 AS b, n_nationkey % 4 AS o FROM {nation}), e AS (SELECT 's' || a AS src, CASE WHEN a % 2 = 0 THEN '+' ELSE '-' END AS src_o, 's' || b AS dst, '+' AS dst_o, CAST(o AS INT) AS overlap FROM l)
    SELECT * FROM e UNION SELECT dst, '-', src, CASE WHEN src_o = '+' THEN '-' ELSE '+' END, overlap FROM e"""
)
def graph_links(spark: SparkSession, d: str) -> DataFrame:
    """Links of a graph file, with the mirror of each."""
    n = _rel(spark, d, "SELECT n_nationkey AS a, n_regionkey + 25 AS b FROM {nation}")
    name = lambda c: F.concat(F.lit("s"), F.col(c).cast("string"))
    links = n.select(F.concat_ws("\t", F.lit("L"), name("a"), F.when(F.col("a") % 2 == 0, "+").otherwise("-"), name("b"), F.lit("+"), F.concat((F.col("a") % 4).cast("string"), F.lit("M"))).alias("line"))
    nodes = n.select(F.explode(F.array("a", "b")).alias("v")).distinct().select(F.concat_ws("\t", F.lit("S"), name("v"), F.lit("acgtacgt"), F.lit("DP:f:1.5")).alias("line"))
    segments, edges = readers.gfa(spark, _written(spark, nodes.unionByName(links)))
    return edges.join(readers.graph_problems(segments, edges).select(F.col("name").alias("src")), "src", "left_anti")


_SHEET = "SELECT CASE WHEN s_suppkey % 11 = 0 THEN 'bad/id' WHEN s_suppkey % 11 = 1 THEN 'twice' ELSE concat('s', CAST(s_suppkey AS STRING)) END AS a, concat('/x/', CAST(s_suppkey AS STRING), '.fa') AS b, CASE WHEN s_suppkey % 11 = 2 THEN '' ELSE '/r1' END AS c, CASE WHEN s_suppkey % 11 = 3 THEN NULL ELSE '/r2' END AS e FROM {supplier}"


@_query(f"SELECT a AS sample_id, b AS assembly, c AS r1, coalesce(e, '') AS r2, CASE WHEN e IS NULL THEN 'not four columns' WHEN a = 'bad/id' THEN 'unsafe id' WHEN count(*) OVER (PARTITION BY a) > 1 THEN 'repeated id' WHEN c = '' THEN 'empty path' END AS problem FROM ({_duck(_SHEET)})")
def sheet_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows of a sample sheet with what is wrong with them."""
    rows = _rel(spark, d, _SHEET).select(F.concat_ws("\t", "a", "b", "c", "e").alias("line"))
    return readers.sample_sheet(spark, _written(spark, rows.unionByName(spark.createDataFrame([("# note",), ("sample_id\tassembly\tr1\tr2",)], "line string"))))


@_query("SELECT CAST(r AS BIGINT) AS record, 'read' || s_suppkey AS name, repeat('ACGT', CAST(1 + s_suppkey % 5 AS INT)) AS seq FROM (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) - 1 AS r FROM {supplier}) WHERE r % 3 = 0")
def sampled_reads(spark: SparkSession, d: str) -> DataFrame:
    """Every third record of a read file."""
    s = _rel(spark, d, "SELECT s_suppkey AS k, repeat('ACGT', CAST(1 + s_suppkey % 5 AS INT)) AS seq FROM {supplier}").orderBy("k").coalesce(1)
    text = F.concat(F.lit("@read"), F.col("k").cast("string"), F.lit(" x\n"), F.col("seq"), F.lit("\n+\n"), F.translate("seq", "ACGT", "IIII"))
    return readers.every_kth(readers.fastq(spark, _written(spark, s.select(text.alias("t")))), 3).select("record", "name", "seq")


@_query("SELECT o_orderkey AS id, tot AS total, mapped, CASE WHEN tot > 0 THEN 100.0 * mapped / tot ELSE 0.0 END AS mapped_pct, CASE WHEN o_orderkey % 3 > 0 THEN greatest(mapped - o_orderkey % 2, 0) END AS properly_paired FROM (SELECT o_orderkey, o_orderkey % 50 AS tot, least(o_orderkey % 50, o_orderkey % 37) AS mapped FROM {orders})")
def mapping_totals(spark: SparkSession, d: str) -> DataFrame:
    """Totals read from texts of mapping statistics, some of which lack a line."""
    o = _rel(spark, d, "SELECT o_orderkey AS id, o_orderkey % 50 AS t, least(o_orderkey % 50, o_orderkey % 37) AS m, CASE WHEN o_orderkey % 3 > 0 THEN concat('\n', CAST(greatest(least(o_orderkey % 50, o_orderkey % 37) - o_orderkey % 2, 0) AS STRING), ' + 0 properly paired (1%)') ELSE '' END AS rest FROM {orders}")
    text = F.concat(F.col("t").cast("string"), F.lit(" + 0 in total (x)\n"), F.col("m").cast("string"), F.lit(" + 0 mapped (y)"), F.col("rest"))
    return o.select("id", readers.flagstat(text).alias("f")).select("id", "f.*")


_RESULTS = "SELECT o_orderkey AS sample_id, CASE WHEN o_orderkey % 5 = 0 THEN 'SKIP' ELSE 'SUCCESS' END AS workflow_status, CASE WHEN o_orderkey % 5 = 0 THEN '' WHEN o_orderkey % 3 = 0 THEN 'HIGH' WHEN o_orderkey % 3 = 1 THEN 'LOW' ELSE 'SUSPECT' END AS qc_confidence, CAST(90 + o_orderkey % 8 AS DOUBLE) + 0.25 AS best_identity_pct, CAST(o_orderkey % 4 AS DOUBLE) + 0.125 AS qc_length_zscore, CAST(o_orderkey % 16 AS DOUBLE) / 20 AS max_alt_fraction, o_orderkey % 2 = 0 AS mixture_detected, CAST(o_orderkey % 7 AS INT) AS mixed_site_count FROM {orders}"


@_query(
    f"""SELECT CAST(sample_id AS VARCHAR) AS sample_id, workflow_status AS status, CASE WHEN qc_confidence = 'HIGH' THEN 'PASS' WHEN qc_confidence = 'LOW' THEN 'REVIEW' ELSE 'HOLD' END AS result_disposition, printf('%.4f', max_alt_fraction) AS f, qc_confidence AS sequence_confidence, CASE WHEN qc_confidence = '' THEN '' ELSE printf('%.4f', max_alt_fraction) END AS max_alt_fraction,
    CASE WHEN qc_confidence = '' THEN '' WHEN mixture_detected THEN 'true' ELSE 'false' END AS mixture_detected, CASE WHEN qc_confidence = '' THEN '' ELSE CAST(mixed_site_count AS VARCHAR) END AS mixed_site_count, CASE WHEN qc_confidence = '' THEN '' ELSE '0.0' END AS remap_mean_depth, '0' AS contigs_hit, 65 AS columns FROM ({_RESULTS})"""
)
def report_cells(spark: SparkSession, d: str) -> DataFrame:
    """Cells of the batch report for results that lack most columns, and the number of its columns."""
    r = _rel(spark, d, _RESULTS)
    report = writers.batch_report(r)
    return report.join(r.select(F.col("sample_id").cast("string").alias("sample_id"), F.format_string("%.4f", F.col("max_alt_fraction")).alias("f")), "sample_id").select("sample_id", "status", "result_disposition", "f", "sequence_confidence", "max_alt_fraction", "mixture_detected", "mixed_site_count", "remap_mean_depth", "contigs_hit", F.lit(len(report.columns)).alias("columns"))


@_query("SELECT event_id, 'k' AS path, CAST(regexp_extract(props, '[0-9]+') AS VARCHAR) AS value FROM {events}")
def json_leaves(spark: SparkSession, d: str) -> DataFrame:
    return readers.json_paths(_rel(spark, d, "SELECT event_id, props FROM {events}"), ["event_id"], "props")


_TEXTS = "SELECT p_partkey AS id, CASE WHEN p_partkey % 3 = 0 THEN concat('chr_', CAST(p_partkey AS STRING)) ELSE concat('c', CAST(p_partkey % 7 AS STRING), ':', CAST(p_partkey AS STRING), '-', CAST(p_partkey * 2 AS STRING)) END AS region, concat(CAST(p_partkey % 30 AS STRING), '.5 (+/-', CAST(p_partkey % 4 AS STRING), ')') AS qpcr, concat('LOW_X (a; B_C); D', CAST(p_partkey % 10 AS STRING), '_E; F_G (h)') AS flags, p_partkey % 64 AS bits FROM {part}"


@_query(
    f"""SELECT id, CASE WHEN id % 3 = 0 THEN region ELSE split_part(region, ':', 1) END AS contig, CASE WHEN id % 3 > 0 THEN CAST(id AS BIGINT) END AS start, CASE WHEN id % 3 > 0 THEN CAST(id * 2 AS BIGINT) END AS stop, id % 30 + 0.5 AS centre, id % 30 + 0.5 - id % 4 AS low, id % 30 + 0.5 + id % 4 AS high,
    'LOW_X,B_C,D' || (id % 10) || '_E,F_G' AS names, CAST(bits // 8 AS BIGINT) % 2 = 1 AS bit3, CAST(('0x' || substring(sha256(region || ':s'), 1, 15)) AS BIGINT) AS seed FROM ({_duck(_TEXTS)})""".replace("B_C,D", "D")
)
def parsed_texts(spark: SparkSession, d: str) -> DataFrame:
    """Regions, measured intervals, flag names, bits and seeds of texts."""
    t = _rel(spark, d, _TEXTS).withColumn("r", S.parse_region("region")).withColumn("q", S.measured_interval("qpcr"))
    outer = F.regexp_replace("flags", r"\([^)]*\)", "")
    return t.select("id", "r.contig", "r.start", F.col("r.end").alias("stop"), "q.centre", "q.low", "q.high", F.array_join(S.flag_names(outer), ",").alias("names"), S.has_bit("bits", 3).alias("bit3"), S.seed_for("region", F.lit("s")).alias("seed"))


# -- scores ----------------------------------------------------------------------------------------------------------

_OUT = """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 10 = 9 THEN CAST(NULL AS BIGINT) ELSE o_orderkey % 4 END AS truth, CAST(o_orderkey % 17 AS DOUBLE) / 4 AS ratio, CAST(o_orderkey % 17 AS DOUBLE) / 4 - 0.5 AS ratio_ci_low, CAST(o_orderkey % 17 AS DOUBLE) / 4 + 0.75 AS ratio_ci_high, CASE WHEN o_orderkey % 17 > 6 THEN 'MULTICOPY_DEPTH' ELSE 'SINGLE_COPY_COMPATIBLE' END AS depth_call,
CASE WHEN o_orderkey % 8 > 0 THEN CAST(o_orderkey % 13 AS DOUBLE) / 4 END AS dosage_estimate, CAST(o_orderkey % 13 AS DOUBLE) / 4 - 0.25 AS dosage_ci_low, CAST(o_orderkey % 13 AS DOUBLE) / 4 + 0.25 AS dosage_ci_high, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 5 END AS graph_context_count, CASE WHEN o_orderkey % 3 = 1 THEN o_orderkey % 5 END AS graph_context_lower_bound,
CASE WHEN o_orderkey % 7 < 4 THEN CAST(o_orderkey % 13 AS DOUBLE) / 4 END AS copy_number_call, CASE WHEN o_orderkey % 7 < 2 THEN 'INTEGER_CONTEXT_COUNT' WHEN o_orderkey % 7 < 5 THEN 'MEAN_DEPTH_DOSAGE' WHEN o_orderkey % 7 = 5 THEN 'LOWER_BOUND' ELSE 'NOT_ESTIMATED' END AS copy_number_kind, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey % 3 END AS copy_number_lower_bound, CASE WHEN o_orderkey % 9 < 5 THEN 'SUPPORTED' ELSE 'REVIEW' END AS copy_number_status FROM {orders}"""


@_query(
    f"""WITH o AS ({_OUT}), c AS (SELECT *, CASE copy_number_kind WHEN 'INTEGER_CONTEXT_COUNT' THEN coalesce(copy_number_call = truth, false) WHEN 'MEAN_DEPTH_DOSAGE' THEN coalesce(floor(copy_number_call + 0.5) = truth, false) WHEN 'LOWER_BOUND' THEN coalesce(copy_number_lower_bound <= truth, false) END AS correct FROM o)
    SELECT id, ratio - truth AS ratio_error, CASE WHEN truth <> 0 THEN round((ratio - truth) / truth, 4) END AS ratio_relative_error, CASE WHEN truth IS NOT NULL THEN ratio_ci_high - ratio_ci_low END AS ratio_ci_width, truth BETWEEN ratio_ci_low AND ratio_ci_high AS ratio_ci_contains_truth, CASE WHEN truth IS NOT NULL THEN depth_call = 'MULTICOPY_DEPTH' END AS called_multicopy_depth,
    dosage_estimate - truth AS dosage_error, truth BETWEEN dosage_ci_low AND dosage_ci_high AS dosage_ci_contains_truth, CASE WHEN truth IS NULL THEN NULL WHEN graph_context_count = truth THEN 'equal to the truth' WHEN graph_context_count < truth THEN 'wrong, below the truth' WHEN graph_context_count > truth THEN 'wrong, above the truth' WHEN graph_context_lower_bound <= truth THEN 'correct lower bound' WHEN graph_context_lower_bound > truth THEN 'wrong, lower bound above the truth' ELSE 'no count and no bound' END AS graph_against_truth,
    CASE WHEN truth IS NULL THEN NULL WHEN correct IS NULL THEN 'no value' WHEN correct THEN 'correct' ELSE 'wrong' END AS consensus_against_truth, copy_number_call - truth AS consensus_error, CASE WHEN truth IS NOT NULL THEN copy_number_status = 'SUPPORTED' AND coalesce(NOT correct, false) END AS supported_but_wrong FROM c"""
)
def copy_number_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """Errors and verdicts per unit against its truth."""
    o = scoring.copy_outcomes(_rel(spark, d, _OUT))
    return o.select("id", "ratio_error", "ratio_relative_error", "ratio_ci_width", "ratio_ci_contains_truth", "called_multicopy_depth", "dosage_error", "dosage_ci_contains_truth", "graph_against_truth", "consensus_against_truth", "consensus_error", "supported_but_wrong")


@_query(
    """WITH b AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 12 > 0 THEN o_orderkey % 2048 END AS flag, 1 + (o_orderkey % 8) // 7 AS returned, o_orderkey % 2 = 0 AS coding, o_orderkey % 5 AS lower_case, o_orderkey % 3 AS uncalled, CASE WHEN o_orderkey % 6 = 0 THEN NULL WHEN o_orderkey % 6 < 4 THEN 100.0 ELSE 99.5 END AS coverage FROM {orders}),
    f AS (SELECT *, [(flag >> i) % 2 = 1 FOR i IN range(0, 11)] AS s FROM b)
    SELECT id, concat_ws('; ', CASE WHEN returned <> 1 THEN returned || ' sequences returned' END, CASE WHEN flag IS NULL THEN 'locus absent from the report' END, CASE WHEN NOT s[1] THEN 'assembled not set' END, CASE WHEN NOT s[2] THEN 'assembled_into_one_contig not set' END, CASE WHEN NOT s[5] THEN 'unique_contig not set' END, CASE WHEN s[3] THEN 'region_assembled_twice set' END, CASE WHEN s[6] THEN 'scaffold_graph_bad set' END,
    CASE WHEN s[7] THEN 'assembly_fail set' END, CASE WHEN s[8] THEN 'variants_suggest_collapsed_repeat set' END, CASE WHEN coding AND NOT s[4] THEN 'complete_gene not set' END) AS assembler, concat_ws('; ', CASE WHEN lower_case > 0 THEN lower_case || ' lower-case bases' END, CASE WHEN uncalled > 0 THEN uncalled || ' n' END, CASE WHEN coverage IS NULL THEN 'template coverage not reported' WHEN coverage <> 100 THEN 'template coverage 99.5' END) AS consensus FROM f"""
)
def tool_decisions(spark: SparkSession, d: str) -> DataFrame:
    """Why two comparators' results are not accepted."""
    o = _rel(spark, d, "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 12 > 0 THEN o_orderkey % 2048 END AS flag, 1 + CAST(floor((o_orderkey % 8) / 7) AS BIGINT) AS returned, o_orderkey % 2 = 0 AS coding, o_orderkey % 5 AS lower_case, o_orderkey % 3 AS uncalled, CAST(CASE WHEN o_orderkey % 6 = 0 THEN NULL WHEN o_orderkey % 6 < 4 THEN 100.0 ELSE 99.5 END AS DOUBLE) AS coverage FROM {orders}")
    c = F.col
    return o.select("id", F.array_join(scoring.assembler_reasons(c("returned"), c("flag"), c("coding")), "; ").alias("assembler"), F.array_join(scoring.consensus_reasons(c("returned"), c("lower_case"), c("uncalled"), c("coverage")), "; ").alias("consensus"))


_PAIRS = "SELECT id, seq AS truth, CASE id % 7 WHEN 0 THEN seq WHEN 1 THEN {rc} WHEN 2 THEN concat('N', substr(seq, 2)) WHEN 3 THEN substr(seq, 5, 40) WHEN 4 THEN concat('ACGT', seq, 'TT') WHEN 5 THEN concat(substr(seq, 40), 'GGGGGACT') ELSE concat('A', substr(seq, 2, 30), 'CCCC', substr(seq, 40)) END AS found FROM ({seqs}) AS q"
_SPARK_PAIRS, _DUCK_PAIRS = _PAIRS.replace("{rc}", _RC("seq")).replace("{seqs}", _SPARK_SEQS), _PAIRS.replace("{rc}", _RC("seq")).replace("{seqs}", _DUCK_SEQS)
_RELATED = lambda a: f"CASE WHEN {a} = truth THEN 1 WHEN length({a}) = length(truth) AND len(list_filter(range(1, length(truth) + 1), lambda i: {a}[i] <> truth[i] AND {a}[i] <> 'N')) = 0 THEN 2 WHEN contains(truth, {a}) THEN 3 WHEN contains({a}, truth) THEN 4 WHEN len(list_filter(range(20, least(length({a}), length(truth))), lambda k: right({a}, k) = left(truth, k) OR right(truth, k) = left({a}, k))) > 0 THEN 5 ELSE 6 END"


@_query(
    f"""WITH p AS (SELECT *, {_RC("found")} AS back FROM ({_DUCK_PAIRS})) SELECT id, ['identical', 'uncalled bases, otherwise identical', 'incomplete, identical over its own length', 'truth contained, extra bases', 'identical over the overlap, different boundaries', 'differs'][least({_RELATED("found")}, {_RELATED("back")})] AS relation FROM p"""
)
def relations_to_truth(spark: SparkSession, d: str) -> DataFrame:
    """How altered sequences relate to those that they were made of."""
    return _rel(spark, d, _SPARK_PAIRS).select("id", evaluation.relation("found", "truth").alias("relation"))


@_query("SELECT c_custkey, CASE WHEN o IS NULL THEN 'REMOVED' ELSE 'CHANGED' END AS change, field, old, new FROM (SELECT c_custkey, o, unnest(['a', 'b']) AS field, unnest([CAST(c_nationkey AS VARCHAR), c_mktsegment]) AS old, unnest([CASE WHEN o IS NULL THEN NULL ELSE CAST(c_nationkey % 20 AS VARCHAR) END, CASE WHEN o IS NULL OR c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END]) AS new FROM (SELECT *, CASE WHEN c_custkey % 10 > 0 THEN 1 END AS o FROM {customer})) WHERE old IS DISTINCT FROM new")
def changed_cells(spark: SparkSession, d: str) -> DataFrame:
    """Cells of customers that differ from an altered copy of the table."""
    c = _rel(spark, d, "SELECT c_custkey, c_nationkey AS a, c_mktsegment AS b FROM {customer}")
    new = c.filter("c_custkey % 10 > 0").select("c_custkey", (F.col("a") % 20).alias("a"), F.when(F.col("c_custkey") % 4 != 0, F.col("b")).alias("b"))
    return scoring.changed_fields(c, new, ["c_custkey"], ["a", "b"])


@_query("SELECT l_suppkey, round(avg(s), 3) AS mean_slope, round(min(s), 3) AS least_slope, round(max(s), 3) AS most_slope, count(s) AS cases FROM (SELECT l_suppkey, l_linenumber, regr_slope(l_extendedprice, l_quantity) AS s FROM {lineitem} GROUP BY ALL) GROUP BY 1")
def mean_slopes(spark: SparkSession, d: str) -> DataFrame:
    li = _rel(spark, d, "SELECT l_suppkey, l_linenumber, CAST(l_extendedprice AS DOUBLE) AS y, CAST(l_quantity AS DOUBLE) AS x FROM {lineitem}")
    out = scoring.mean_slope(li, ["l_suppkey"], "l_linenumber", "y", "x")
    return out.withColumns({c: F.round(c, 3) for c in ("mean_slope", "least_slope", "most_slope")})


_LOCI = "SELECT id, concat('TTTT', seq, 'GG') AS genome, CASE WHEN id % 3 = 0 THEN substr(seq, 10, 30) WHEN id % 3 = 1 THEN {rc} ELSE 'ACACACACACACACACACACACAC' END AS locus FROM ({seqs}) AS q"


@_query(f"SELECT id, CAST(CASE WHEN a > 0 THEN a WHEN b > 0 THEN b END AS INT) AS start, CAST(CASE WHEN a > 0 THEN a WHEN b > 0 THEN b END + length(locus) - 1 AS INT) AS stop, CASE WHEN a > 0 THEN '+' WHEN b > 0 THEN '-' END AS strand FROM (SELECT *, instr(genome, locus) AS a, instr(genome, {_RC('locus')}) AS b FROM ({_LOCI.replace('{rc}', _RC('substr(seq, 20, 25)')).replace('{seqs}', _DUCK_SEQS)}))")
def located_loci(spark: SparkSession, d: str) -> DataFrame:
    """Where a locus lies in its genome, on either strand."""
    j = _rel(spark, d, _LOCI.replace("{rc}", _RC("substr(seq, 20, 25)")).replace("{seqs}", _SPARK_SEQS))
    return scoring.locate(j.select("id", "genome"), j.select("id", "locus"), ["id"]).select("id", "start", F.col("end").alias("stop"), "strand")


# -- graphs ----------------------------------------------------------------------------------------------------------

# A lattice: five first segments, each linked to two of the next five, and so on; every segment starts and ends in ACG.
_NODES = "SELECT n_nationkey AS k, concat('ACG', translate(upper(n_name), 'BDEFHIJKLMNOPQRSUVWXYZ ', 'ACGTACGTACGTACGTACGTACG'), 'ACG') AS seq, 1.0 + n_nationkey % 3 AS depth FROM {nation}"


@_query(
    f"""WITH RECURSIVE n AS ({_NODES}), e AS (SELECT k AS src, k + 5 AS dst FROM n WHERE k < 20 UNION SELECT k, k + 5 + CASE WHEN k % 5 < 4 THEN 1 ELSE 0 END FROM n WHERE k < 20),
    w AS (SELECT k, [k] AS path, seq, depth * length(seq) AS d, length(seq) AS l FROM n WHERE k < 5 UNION ALL SELECT n.k, list_append(w.path, n.k), w.seq || substr(n.seq, 4), d + n.depth * (length(n.seq) - 3), l + length(n.seq) - 3 FROM w JOIN e ON e.src = w.k JOIN n ON n.k = e.dst)
    SELECT array_to_string(path, '>') AS path, seq, round(d / l, 6) AS depth, CAST(len(path) AS BIGINT) AS nodes FROM w WHERE k >= 20"""
)
def graph_paths(spark: SparkSession, d: str) -> DataFrame:
    """Every path through a lattice of segments, spelled with checked overlaps."""
    n = _rel(spark, d, _NODES)
    e = n.filter("k < 20").select(F.col("k").alias("src"), F.explode(F.array(F.col("k") + 5, F.col("k") + 5 + F.when(F.col("k") % 5 < 4, 1).otherwise(0))).alias("dst")).distinct()
    paths = graph.terminal_paths(e, n.filter("k < 5").select(F.col("k").alias("node")), "src", "dst", "node", keeper(spark))
    rows = paths.select(F.array_join("path", ">").alias("p"), F.posexplode("path").alias("i", "k")).join(n, "k").withColumn("overlap", F.when(F.col("i") > 0, 3).otherwise(0))
    return graph.spell(rows, ["p"], "i", "seq", "overlap", "depth").withColumnRenamed("p", "path").withColumn("depth", F.round("depth", 6))


_GAPS = "SELECT id % 50 AS g, id, substr(seq, 1, 30) AS a, substr(seq, 31, 25) AS b FROM ({seqs}) AS q"


@_query(
    f"""WITH g AS ({_GAPS.replace("{seqs}", _DUCK_SEQS)}), c AS (SELECT g, id, a || 'NNNNNNNNNNNN' || b AS seq, a, b FROM g), p AS (SELECT g, CASE WHEN id % 2 = 0 THEN a || b ELSE {_RC("a || 'GATTACA' || b")} END AS s FROM g WHERE id % 3 > 0 AND g <> 7),
    m AS (SELECT g, s FROM p UNION ALL SELECT g, {_RC("s")} FROM p), h AS (SELECT id, instr(s, right(a, 20)) AS at, instr(substr(s, instr(s, right(a, 20)) + 19), left(b, 20)) AS after FROM c JOIN m ON c.g = m.g AND contains(s, right(a, 20)) AND contains(s, left(b, 20))),
    v AS (SELECT id, count(*) FILTER (after > 0) AS holding, count(*) FILTER (after = 2) AS supporting FROM h GROUP BY id)
    SELECT c.g, c.id, CAST(CASE WHEN substr(c.seq, 1, 1) <> 'N' AND right(c.seq, 1) <> 'N' THEN len(list_filter(regexp_extract_all(c.seq, 'N+'), lambda x: length(x) >= 10)) END AS BIGINT) AS placeholder_runs, CASE WHEN c.g = 7 THEN 'NOT_ASSESSED' WHEN coalesce(holding, 0) = 0 THEN 'NOT_SUPPORTED' WHEN supporting = holding THEN 'GRAPH_SUPPORTED' ELSE 'AMBIGUOUS' END AS verdict FROM c LEFT JOIN v ON v.id = c.id
    WHERE a[1] <> 'N' AND right(b, 1) <> 'N' AND right(a, 1) <> 'N' AND b[1] <> 'N'"""
)
def junction_support(spark: SparkSession, d: str) -> DataFrame:
    """Placeholders of candidates against the paths of their own graph, which close them, put bases between, or are none."""
    every = _rel(spark, d, _GAPS.replace("{seqs}", _SPARK_SEQS))
    g = every.filter("substr(a, 1, 1) <> 'N' and right(b, 1) <> 'N' and right(a, 1) <> 'N' and substr(b, 1, 1) <> 'N'")
    closed, apart = F.concat("a", "b"), S.reverse_complement(F.concat("a", F.lit("GATTACA"), "b"))
    paths = every.filter("id % 3 > 0 and g <> 7").select("g", F.when(F.col("id") % 2 == 0, closed).otherwise(apart).alias("seq"))
    found = graph.placeholder_verdict(g.select("g", "id", F.concat("a", F.lit("N" * 12), "b").alias("seq")), ["g", "id"], paths, ["g"], flank=20)
    return found.select("g", "id", "placeholder_runs", "verdict")


_PATHS = "SELECT concat('p', CAST(p_partkey AS STRING)) AS ref, p_brand AS g, 100 + p_partkey % 50 AS length, p_partkey % 13 AS mapped, p_partkey % 4 AS covered FROM {part}"


@_query(
    f"""WITH p AS ({_duck(_PATHS)}), s AS (SELECT *, 100.0 * covered / length AS breadth, CASE WHEN covered > 0 THEN 3.0 * covered / length ELSE 0.0 END AS mean_depth FROM p)
    SELECT ref, round(breadth, 6) AS breadth, round(mean_depth, 6) AS mean_depth, 'path_' || row_number() OVER (PARTITION BY g ORDER BY breadth DESC, mean_depth DESC, length DESC, ref) AS candidate, bool_or(covered > 0) OVER (PARTITION BY g) AS informative FROM s"""
)
def path_scores(spark: SparkSession, d: str) -> DataFrame:
    """Paths ranked by what reads say of them: breadth, depth, length."""
    p = _rel(spark, d, _PATHS)
    depth = p.select(F.col("ref").alias("contig"), F.explode(F.sequence(F.lit(1), F.col("covered") + 1)).alias("pos"), "covered").withColumn("depth", F.when(F.col("pos") <= F.col("covered"), 3).otherwise(0))
    scored = evidence.depth_by_reference(depth, p.select("ref", "length", "mapped")).join(p.select("ref", "g"), "ref")
    return graph.ranked_paths(scored, ["g"]).select("ref", F.round("breadth", 6).alias("breadth"), F.round("mean_depth", 6).alias("mean_depth"), "candidate", "informative")


_BAITS = "SELECT p_brand AS g, CAST(p_partkey AS BIGINT) AS id, p_partkey % 5 = 0 AS first_rule, p_partkey % 2 = 0 AS second_rule FROM {part}"


@_query(f"SELECT g, id, CAST(rule AS INT) AS rule FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY rule, id) AS n FROM (SELECT *, CASE WHEN first_rule THEN 1 WHEN second_rule THEN 2 END AS rule FROM ({_BAITS})) WHERE rule IS NOT NULL) WHERE n = 1")
def chosen_baits(spark: SparkSession, d: str) -> DataFrame:
    """The first record of the first rule that any record of a brand meets."""
    return discovery.chosen_bait(_rel(spark, d, _BAITS), ["g"], "id", F.col("first_rule"), F.col("second_rule")).select("g", "id", "rule")
