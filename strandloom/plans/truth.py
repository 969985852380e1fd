"""Queries that score results against truth and read comparators' texts, each with SQL of the same result; inputs as in ``genomic``."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.functions import sequence as S
from strandloom.operators import alignment, discovery, evaluation, evidence, graph, intervals, ranking, scoring, simulate
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
    return sql.replace("AS STRING", "AS VARCHAR").replace("{seqs}", _DUCK_SEQS)


def _spark(sql: str) -> str:
    return sql.replace("{seqs}", _SPARK_SEQS)


# -- truth -----------------------------------------------------------------------------------------------------------

_COPIES = "SELECT o_custkey AS u, concat('r', CAST(o_orderkey % 2 AS STRING)) AS replicon, CAST(o_orderkey AS BIGINT) AS hit, 70.0 + o_orderkey % 30 AS identity, 1 + o_orderkey % 9 AS qstart, 100 - o_orderkey % 4 AS qend, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 397 + 110 ELSE o_orderkey % 397 + 10 END AS sstart, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 397 + 10 ELSE o_orderkey % 397 + 110 END AS send, CAST(o_orderkey AS DOUBLE) AS bitscore, 100 AS bait FROM {orders}"


@_query(
    f"""WITH RECURSIVE h AS (SELECT *, CASE WHEN sstart <= send THEN sstart - (qstart - 1) ELSE send - (bait - qend) END AS lo, CASE WHEN sstart <= send THEN send + (bait - qend) ELSE sstart + (qstart - 1) END AS hi FROM ({_duck(_COPIES)}) WHERE identity >= 80 AND qend - qstart + 1 >= 90),
    o AS (SELECT u, replicon, hit, sstart <= send AS fw, greatest(lo, 1) AS s, least(hi, 500) AS e, greatest(1 - lo, 0) + greatest(hi - 500, 0) AS clip, row_number() OVER (PARTITION BY u, replicon ORDER BY bitscore DESC) AS n FROM h),
    w AS (SELECT u, replicon, hit, fw, s, e, clip, n, [{{'s': s, 'e': e}}] AS kept, true AS taken FROM o WHERE n = 1
    UNION ALL SELECT u, replicon, hit, fw, s, e, clip, n, CASE WHEN free THEN list_append(kept, {{'s': s, 'e': e}}) ELSE kept END, free FROM (SELECT o.*, w.kept, len(list_filter(w.kept, lambda x: least(x.e, o.e) - greatest(x.s, o.s) + 1 > 0.5 * least(o.e - o.s + 1, x.e - x.s + 1))) = 0 AS free FROM w JOIN o ON o.u = w.u AND o.replicon = w.replicon AND o.n = w.n + 1))
    SELECT u, hit, CASE WHEN fw THEN '+' ELSE '-' END AS strand, s AS start, e AS stop, clip AS clipped_bp, CAST(row_number() OVER (PARTITION BY u ORDER BY replicon, s) AS INT) AS copy FROM w WHERE taken"""
)
def copies_in_genomes(spark: SparkSession, d: str) -> DataFrame:
    """Copies of a bait of 100 bases on two replicons of 500 per customer."""
    h = _rel(spark, d, _COPIES)
    lengths = h.select("u", "replicon").distinct().withColumn("replicon_length", F.lit(500))
    return scoring.truth_copies(h, lengths, ["u"], "bait").select("u", "hit", "strand", "start", F.col("end").alias("stop"), "clipped_bp", "copy")


_SITES = "SELECT id, CASE WHEN id % 3 = 0 THEN substr(seq, 11, 60) ELSE seq END AS candidate, CAST(1 + id % 50 AS INT) AS position, CASE id % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'c' WHEN 2 THEN 'G' ELSE 'T' END AS alt_base, seq, concat(substr(seq, 1, 30), 'T', substr(seq, 32)) AS other FROM ({seqs}) AS q"


@_query(
    f"""WITH s AS ({_duck(_SITES)}), b AS (SELECT *, CASE WHEN instr(seq, candidate) > 0 THEN substr(seq, CAST(instr(seq, candidate) + position - 1 AS INT), 1) ELSE '?' END AS x, CASE WHEN length(candidate) = length(other) THEN substr(other, position, 1) WHEN instr(other, candidate) > 0 THEN substr(other, CAST(instr(other, candidate) + position - 1 AS INT), 1) ELSE '?' END AS y FROM s)
    SELECT id, 't1:' || x || ';t2:' || y AS bases, x <> y AS differ, upper(alt_base) IN (x, y) AS held FROM b"""
)
def mixed_site_bases(spark: SparkSession, d: str) -> DataFrame:
    """Bases of two truths at a site of a candidate that is one of them or a part of it; the second truth is given turned."""
    s = _rel(spark, d, _spark(_SITES))
    truths = s.select("id", F.lit("t1").alias("name"), "seq").unionByName(s.select("id", F.lit("t2").alias("name"), S.reverse_complement("other").alias("seq")))
    out = scoring.mixed_sites(s.select("id", "candidate", "position", "alt_base"), truths, ["id"])
    return out.select("id", F.col("truth_bases_at_site").alias("bases"), F.col("truth_copies_differ_at_site").alias("differ"), F.col("alt_base_is_in_a_truth_copy").alias("held"))


_LOSSES = "SELECT o_orderkey AS id, " + ", ".join(f"o_orderkey % {a} AS truth_{n}, CASE WHEN o_orderkey % {b} = 0 THEN 1 ELSE 0 END + o_orderkey % {a} AS measured_{n}" for n, a, b in (("clipped_start_bp", 7, 11), ("clipped_end_bp", 5, 13), ("lost_prefix_bp", 3, 17), ("lost_suffix_bp", 4, 19), ("recovered_bp", 6, 23), ("overlap_bp", 8, 29))) + ", CASE WHEN o_orderkey % 2 = 0 THEN 'c' END AS truth_continuation_contig, CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 31 > 0 THEN 'c' END AS measured_continuation_contig, 100 AS expected_bp, 100 - CASE WHEN o_orderkey % 37 = 0 THEN 1 ELSE 0 END AS extracted_bp FROM {orders}"


@_query("SELECT o_orderkey AS id, o_orderkey % 11 > 0 AS start_ok, o_orderkey % 2 = 1 OR o_orderkey % 31 > 0 AS contig_ok, o_orderkey % 11 > 0 AND o_orderkey % 13 > 0 AND o_orderkey % 17 > 0 AND o_orderkey % 19 > 0 AND o_orderkey % 23 > 0 AND o_orderkey % 29 > 0 AND (o_orderkey % 2 = 1 OR o_orderkey % 31 > 0) AND o_orderkey % 37 > 0 AS exact FROM {orders}")
def completeness_checks(spark: SparkSession, d: str) -> DataFrame:
    c = scoring.completeness(_rel(spark, d, _LOSSES))
    return c.select("id", F.col("clipped_start_bp_ok").alias("start_ok"), F.col("continuation_contig_ok").alias("contig_ok"), "exact")


@_query("SELECT stage, case_class, evidence, counts, count(*) AS n FROM (SELECT 'orders' AS stage, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE 'partly' END AS case_class, o_orderpriority AS evidence, true AS counts FROM {orders} UNION ALL SELECT 'control', CASE WHEN c_mktsegment = 'BUILDING' THEN 'finished' ELSE 'open' END, '', false FROM {customer}) GROUP BY ALL")
def stage_tables(spark: SparkSession, d: str) -> DataFrame:
    """Two stage tables as one, the control's rows kept out of the count."""
    a = scoring.stage_rows(_rel(spark, d, "SELECT o_orderstatus AS category, o_orderpriority AS case_design FROM {orders}"), "orders", {"F": "finished", "O": "open", "P": "partly"}, "category")
    b = scoring.stage_rows(_rel(spark, d, "SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN 'b' ELSE 'o' END AS category FROM {customer}"), "control", {"b": "finished", "o": "open"}, "category")
    return scoring.combined_stages([a, b], "control").groupBy("stage", "case_class", "evidence", "counts").agg(F.count(F.lit(1)).alias("n"))


_ANNOTATED = "SELECT CAST(id % 40 AS BIGINT) AS u, id, CASE WHEN id % 3 = 0 THEN seq ELSE substr(seq, 3) END AS seq, CASE WHEN id % 5 = 0 THEN {rc} ELSE concat(seq, 'AC') END AS truth, CASE WHEN id % 7 > 0 THEN CAST(88 + id % 13 AS DOUBLE) END AS i, CASE WHEN id % 7 > 0 THEN CAST(20 + id % 31 AS BIGINT) END AS n FROM ({seqs}) AS q".replace("{rc}", _RC("seq"))


@_query(
    f"""WITH a AS ({_duck(_ANNOTATED)}), b AS (SELECT *, bool_or(seq = truth OR seq = {_RC("truth")}) OVER (PARTITION BY u) AS exact, row_number() OVER (PARTITION BY u ORDER BY coalesce(i * n, 0) DESC, reverse(truth) DESC) AS r FROM a)
    SELECT u, exact, coalesce(n, 0) AS length, CAST(length(seq) - length(truth) AS INT) AS delta, CASE WHEN exact THEN 'identical to the annotated allele' WHEN n > 0 AND i >= 99.995 THEN printf('identical over the %d bp overlap; candidate %+d bp against the annotated boundary', n, length(seq) - length(truth)) WHEN n > 0 THEN printf('%.2f%% identity over %d bp', i, n) ELSE 'no alignment to the annotated allele' END AS relation FROM b WHERE r = 1"""
)
def annotated_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Relation of candidates to their annotated truths."""
    return scoring.annotated_relation(_rel(spark, d, _spark(_ANNOTATED)), ["u"], "seq", "truth", "i", "n").select("u", "exact", "length", "delta", "relation")


_ROWS = "SELECT o_custkey AS u, CASE o_orderkey % 6 WHEN 0 THEN 'identical' WHEN 1 THEN 'uncalled bases, otherwise identical' WHEN 2 THEN 'incomplete, identical over its own length' WHEN 3 THEN 'truth contained, extra bases' WHEN 4 THEN 'identical over the overlap, different boundaries' ELSE 'differs' END AS relation, CAST(o_orderkey AS BIGINT) AS aligned, concat('r', CAST(o_orderkey AS STRING)) AS label, o_orderkey % 6 AS k FROM {orders}"


@_query(f"SELECT u, relation, aligned, candidates, detail FROM (SELECT *, row_number() OVER (PARTITION BY u ORDER BY k, aligned DESC) AS r, count(*) OVER (PARTITION BY u) AS candidates, string_agg(label, '; ') OVER (PARTITION BY u ORDER BY k, aligned DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS detail FROM ({_duck(_ROWS)})) WHERE r = 1")
def configuration_rows(spark: SparkSession, d: str) -> DataFrame:
    """The row that relates best per customer, with the labels of all."""
    return scoring.best_per_configuration(_rel(spark, d, _ROWS).drop("k"), ["u"], "relation", "aligned", "label").select("u", "relation", "aligned", "candidates", "detail")


@_query(f"SELECT u, count(*) AS total, count(*) FILTER (k = 0) AS identical, count(*) FILTER (k = 2) AS incomplete, count(*) FILTER (k = 5) AS differs FROM ({_duck(_ROWS)}) GROUP BY 1")
def relation_table(spark: SparkSession, d: str) -> DataFrame:
    c = scoring.relation_counts(_rel(spark, d, _ROWS), ["u"], "relation")
    return c.select("u", "total", "identical", F.col("incomplete_identical_over_its_own_length").alias("incomplete"), "differs")


@_query("SELECT c_custkey, coalesce(o_orderstatus, 'MISSING') AS status FROM {customer} LEFT JOIN (SELECT o_custkey, min(o_orderstatus) AS o_orderstatus FROM {orders} WHERE o_orderkey % 5 = 0 GROUP BY 1) ON c_custkey = o_custkey")
def truth_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Customers with the status of their orders, or MISSING."""
    r = _rel(spark, d, "SELECT o_custkey AS c_custkey, min(o_orderstatus) AS status FROM {orders} WHERE o_orderkey % 5 = 0 GROUP BY 1")
    return scoring.paired_truth(_rel(spark, d, "SELECT c_custkey FROM {customer}"), r, ["c_custkey"])


_FEATURES = "SELECT l_suppkey AS g, concat('r', CAST(l_linenumber % 2 AS STRING)) AS replicon, l_suppkey % 3 > 0 OR l_linenumber % 2 = 0 AS circular, l_linenumber % 2 = 1 AND l_suppkey % 2 = 0 AS plasmid, l_returnflag AS kind, CAST(l_quantity AS INT) AS length FROM {lineitem}"


@_query(f"WITH f AS ({_duck(_FEATURES)}), m AS (SELECT g, count(DISTINCT replicon) AS c FROM f WHERE circular AND NOT plasmid GROUP BY 1), x AS (SELECT g, count(*) FILTER (kind = 'R' AND length >= 45) AS found FROM f GROUP BY 1) SELECT g, found, coalesce(c, 0) AS chromosomes, coalesce(c, 0) = 1 AND found = 14 AS sound FROM x LEFT JOIN m USING (g)")
def genome_audits(spark: SparkSession, d: str) -> DataFrame:
    f = _rel(spark, d, _FEATURES)
    wanted = f.select("g").distinct().select("g", F.lit("R").alias("kind"), F.lit(45).alias("least_length"), F.lit(14).alias("copies"))
    return scoring.genome_audit(f, ["g"], wanted).select("g", "found", "chromosomes", "sound")


@_query("SELECT r_regionkey, b AS block_bp FROM {region}, (VALUES (100), (500), (1000)) AS t(b)")
def block_cases(spark: SparkSession, d: str) -> DataFrame:
    return scoring.with_blocks(_rel(spark, d, "SELECT r_regionkey FROM {region}"), [100, 500, 1000])


@_query("SELECT token, count(*) AS uses, string_agg(DISTINCT path, ',' ORDER BY path) AS files FROM (SELECT r_name AS path, unnest(regexp_extract_all(concat(repeat(chr(123), 2), n_name, repeat(chr(125), 2), ' ', repeat(chr(123), 2), 'ALL', repeat(chr(125), 2), ' ', n_name), '[{][{]([A-Z0-9_]+)[}][}]', 1)) AS token FROM nation JOIN region ON n_regionkey = r_regionkey) GROUP BY 1")
def slot_tokens(spark: SparkSession, d: str) -> DataFrame:
    """Tokens in double braces, and where they are used."""
    n = _rel(spark, d, "SELECT r_name AS path, n_name FROM {nation} JOIN {region} ON n_regionkey = r_regionkey")
    out = scoring.slots(n.select("path", F.concat(F.lit("{{"), F.col("n_name"), F.lit("}} {{ALL}} "), F.col("n_name")).alias("value")))
    return out.withColumn("files", F.array_join("files", ","))


@_query("SELECT s_suppkey, CASE WHEN s_suppkey % 4 > 0 THEN 95 + (s_suppkey % 50) / 10.0 END AS aligned_pct, 99 + (s_suppkey % 10) / 10.0 AS identity_pct, s_suppkey % 4 > 0 AND 95 + (s_suppkey % 50) / 10.0 >= 98 AND 99 + (s_suppkey % 10) / 10.0 >= 99.9 AS concordant FROM {supplier}")
def concordance_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Verdicts of whole-genome comparison texts, some without their share of aligned bases."""
    s = _rel(spark, d, "SELECT s_suppkey, concat(CASE WHEN s_suppkey % 4 > 0 THEN concat('AlignedBases   100(', CAST(CAST(95 + (s_suppkey % 50) / 10.0 AS DOUBLE) AS STRING), '%)  100(1%)\n') ELSE '' END, 'AvgIdentity    ', CAST(CAST(99 + (s_suppkey % 10) / 10.0 AS DOUBLE) AS STRING), '   1') AS t FROM {supplier}")
    return s.select("s_suppkey", scoring.concordance(F.col("t")).alias("c")).select("s_suppkey", "c.*")


@_query("SELECT p_partkey, CASE WHEN p_name LIKE '%red%' THEN 'red' WHEN p_name LIKE '%a%' THEN 'has an a' ELSE 'unexplained' END AS explanation FROM {part}")
def explained_names(spark: SparkSession, d: str) -> DataFrame:
    return scoring.explained(_rel(spark, d, "SELECT p_partkey, p_name FROM {part}"), "p_name", [("red", "red"), ("a", "has an a")]).drop("p_name")


_RETURNED = "SELECT CAST(id % 50 AS BIGINT) AS u, id, CASE WHEN id % 2 = 0 THEN seq ELSE substr(seq, 2) END AS found, CASE WHEN id % 3 = 0 THEN {rc} ELSE seq END AS truth FROM ({seqs}) AS q".replace("{rc}", _RC("seq"))


@_query(f"WITH a AS ({_duck(_RETURNED)}), f AS (SELECT DISTINCT u, least(found, {_RC('found')}) AS c FROM a), t AS (SELECT DISTINCT u, truth, least(truth, {_RC('truth')}) AS c FROM a) SELECT t.u, count(*) AS truths, count(f.c) AS recovered FROM t LEFT JOIN f ON f.u = t.u AND f.c = t.c GROUP BY 1")
def recovered_truths(spark: SparkSession, d: str) -> DataFrame:
    a = _rel(spark, d, _spark(_RETURNED))
    return scoring.truths_recovered(a.select("u", F.col("found").alias("seq")), a.select("u", F.col("truth").alias("seq")), ["u"])


@_query(f"WITH a AS ({_duck(_RETURNED)}) SELECT id, EXISTS (SELECT 1 FROM a b WHERE b.u = a.u AND (b.truth = a.found OR b.truth = {_RC('a.found')})) AS exact FROM a")
def exact_candidates(spark: SparkSession, d: str) -> DataFrame:
    a = _rel(spark, d, _spark(_RETURNED))
    return scoring.exactness(a.select("u", "id", F.col("found").alias("seq")), a.select("u", F.col("truth").alias("seq")), ["u"]).select("id", "exact")


@_query(f"WITH s AS (SELECT id, seq, {_RC('seq')} AS rc, 'given' AS orientation FROM ({_DUCK_SEQS}) UNION ALL SELECT id, {_RC('seq')}, seq, 'turned' FROM ({_DUCK_SEQS})) SELECT id, orientation, CAST(f.n AS INT) AS stops, f.label AS frame FROM (SELECT id, orientation, list_sort({_FRAMES})[1] AS f FROM s)")
def frames_of_both_strands(spark: SparkSession, d: str) -> DataFrame:
    return scoring.frame_grid(_rel(spark, d, _SPARK_SEQS)).drop("seq")


@_query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'more than one copy is supported' WHEN o_orderkey % 3 = 1 THEN 'compatible with a single copy' ELSE 'no statement on copies' END || '; ' || CASE WHEN o_orderkey % 4 > 0 THEN printf('dosage %.3f', (o_orderkey % 8) / 4.0) ELSE 'no dosage' END || ' (ESTIMATED)' AS text FROM {orders}")
def interpretations(spark: SparkSession, d: str) -> DataFrame:
    o = _rel(spark, d, "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 > 0 THEN CAST(o_orderkey % 8 AS DOUBLE) / 4 END AS dosage_estimate, CASE o_orderkey % 3 WHEN 0 THEN 'MULTICOPY_DEPTH' WHEN 1 THEN 'SINGLE_COPY_COMPATIBLE' ELSE 'DEPTH_INDETERMINATE' END AS depth_call, 'ESTIMATED' AS dosage_status FROM {orders}")
    return o.select("id", scoring.interpretation().alias("text"))


_CUTS = "SELECT id, CAST(5 + id % 7 AS BIGINT) AS a, CAST(9 + id % 11 AS BIGINT) AS b, seq FROM ({seqs}) AS q"


@_query(f"WITH c AS ({_duck(_CUTS)}), p AS (SELECT id, unnest(range(1, length(seq) + 1)) AS i, a, b, seq FROM c), k AS (SELECT id, i, substr(seq, CAST(i AS INT), 1) AS x, i - row_number() OVER (PARTITION BY id ORDER BY i) AS grp FROM p WHERE NOT (i BETWEEN a AND a + 3) AND NOT (i BETWEEN b AND b + 5) AND i < 80) SELECT id, min(i) AS start, string_agg(x, '' ORDER BY i) AS seq FROM k GROUP BY id, grp")
def cut_pieces(spark: SparkSession, d: str) -> DataFrame:
    """What three removals leave of each sequence."""
    c = _rel(spark, d, _spark(_CUTS))
    gone = c.select("id", F.explode(F.array(F.struct(F.col("a").alias("start"), (F.col("a") + 3).alias("end")), F.struct(F.col("b").alias("start"), (F.col("b") + 5).alias("end")), F.struct(F.lit(80).cast("long").alias("start"), F.lit(10_000).cast("long").alias("end")))).alias("x")).select("id", "x.*")
    return simulate.cut_out(c.select("id", "seq"), gone, [], "id").select("id", "start", "seq")


# -- texts of others -------------------------------------------------------------------------------------------------

_HEADERS = "SELECT CAST(p_partkey AS BIGINT) AS ord, concat('lcl|NC_', CAST(p_partkey % 3 AS STRING), CASE WHEN p_partkey % 2 = 0 THEN '_cds_' ELSE '_rrna_' END, CAST(p_partkey AS STRING)) AS seq_id, concat('[gene=g', CAST(p_partkey % 9 AS STRING), '] [location=', CASE WHEN p_partkey % 5 = 0 THEN concat('complement(<', CAST(p_partkey * 7 % 1000 AS STRING), '..', CAST(p_partkey * 7 % 1000 + 50 AS STRING), ')') ELSE concat('join(', CAST(p_partkey * 7 % 1000 AS STRING), '..9,1200..', CAST(1300 + p_partkey AS STRING), ')') END, '] [product=x y]') AS description FROM {part}"


@_query(
    """WITH h AS (SELECT CAST(p_partkey AS BIGINT) AS ord, 'NC_' || (p_partkey % 3) AS replicon, 'g' || (p_partkey % 9) AS gene, CAST(CASE WHEN p_partkey % 5 = 0 THEN p_partkey * 7 % 1000 ELSE least(p_partkey * 7 % 1000, 9) END AS BIGINT) AS start, CAST(CASE WHEN p_partkey % 5 = 0 THEN p_partkey * 7 % 1000 + 50 ELSE 1300 + p_partkey END AS BIGINT) AS stop, CASE WHEN p_partkey % 5 = 0 THEN '-' ELSE '+' END AS strand, p_partkey % 5 = 0 AS partial FROM {part}),
    f AS (SELECT *, min(ord) OVER (PARTITION BY replicon) AS first FROM h) SELECT ord, replicon, gene, 'x y' AS product, start, stop, strand, partial, CAST(row_number() OVER (ORDER BY first, start, ord) AS INT) AS place FROM f"""
)
def annotation_fields(spark: SparkSession, d: str) -> DataFrame:
    a = readers.annotated_entries(_rel(spark, d, _HEADERS))
    return a.select("ord", "replicon", "gene", "product", "start", F.col("end").alias("stop"), "strand", "partial", "place")


@_query("WITH r AS (SELECT 'g' || o_custkey AS ref_name, o_orderkey, o_orderkey % 2048 AS flag, o_orderkey % 4 = 0 AS several FROM {orders}) SELECT ref_name, arg_min(flag, o_orderkey) AS flag, count(*) AS rows, count(*) FILTER (several) AS multi_nt_rows FROM r GROUP BY 1")
def assembler_reports(spark: SparkSession, d: str) -> DataFrame:
    r = _rel(spark, d, "SELECT concat('g', CAST(o_custkey AS STRING)) AS ref_name, CAST(o_orderkey AS BIGINT) AS n, o_orderkey % 2048 AS flag, 1 AS reads, 100 AS ref_len, 90 AS ref_base_assembled, CAST(99 AS DOUBLE) AS pc_ident, 'c' AS ctg, CAST(9 AS DOUBLE) AS ctg_cov, CASE WHEN o_orderkey % 4 = 0 THEN 'A,C' WHEN o_orderkey % 4 = 1 THEN 'A' END AS smtls_nts FROM {orders}")
    return readers.ariba_calls(r, "n").select("ref_name", "flag", "rows", "multi_nt_rows")


@_query("SELECT 'g' || o_custkey AS template, max(o_orderkey) AS score, arg_max(o_orderkey % 50, o_orderkey) AS depth FROM {orders} GROUP BY 1")
def consensus_reports(spark: SparkSession, d: str) -> DataFrame:
    r = _rel(spark, d, "SELECT concat(' g', CAST(o_custkey AS STRING), '  ') AS template, CAST(o_orderkey AS BIGINT) AS score, o_orderkey % 50 AS depth FROM {orders}")
    return readers.kma_calls(r)


_CANDIDATES = "SELECT concat('s', CAST(o_orderkey AS STRING)) AS seq_id, CASE WHEN o_orderkey % 6 > 0 THEN 'ACGT' END AS seq, CASE WHEN o_orderkey % 7 = 0 THEN 'SKIP' ELSE 'SUCCESS' END AS workflow_status, CASE o_orderkey % 4 WHEN 0 THEN 'PASS' WHEN 1 THEN 'REVIEW' ELSE 'HOLD' END AS result_disposition FROM {orders}"


@_query("WITH c AS (SELECT o_orderkey % 4 AS r FROM {orders} WHERE o_orderkey % 6 > 0 AND o_orderkey % 7 > 0) SELECT CASE r WHEN 0 THEN 'accepted' WHEN 1 THEN 'review' ELSE 'hold' END AS role, count(*) AS records FROM c GROUP BY 1 UNION ALL SELECT 'all_candidates', count(*) FROM c")
def catalogue_files(spark: SparkSession, d: str) -> DataFrame:
    """Records of each catalogue file, as counted and as read back."""
    path = f"{shared_folder(spark)}/catalogue"
    counted = writers.write_catalogue(_rel(spark, d, _CANDIDATES), path)
    stored = spark.read.text(path).filter("value like '>%'").groupBy("role").agg(F.count(F.lit(1)).alias("records"))
    return counted.join(stored, "role").filter(F.col("records") == F.col("count")).select("role", "records")


@_query(f"SELECT id, '>graph_path_' || id || ' length=' || length(seq) || ' mean_graph_depth=' || printf('%.2f', (id % 40) / 4.0) || ' nodes=' || id || '+,' || (id + 1) || '-' AS head, CASE WHEN length(seq) > 80 THEN substr(seq, 1, 80) || chr(10) || substr(seq, 81) ELSE seq END AS body FROM ({_DUCK_SEQS})")
def path_texts(spark: SparkSession, d: str) -> DataFrame:
    s = _rel(spark, d, _SPARK_SEQS).select(F.col("id").alias("place"), "seq", ((F.col("id") % 40) / 4.0).alias("depth"), F.array(F.concat(F.col("id").cast("string"), F.lit("+")), F.concat((F.col("id") + 1).cast("string"), F.lit("-"))).alias("path"))
    cut = F.split(F.col("value"), "\n", 2)
    return writers.path_records(s).select(F.col("place").alias("id"), cut[0].alias("head"), cut[1].alias("body"))


@_query("SELECT CAST(n_nationkey AS VARCHAR) AS k, CASE WHEN n_nationkey % 2 = 0 THEN 'true' ELSE 'false' END AS flag, CASE WHEN n_nationkey % 3 > 0 THEN n_name ELSE '' END AS name, n_nationkey || ';' || n_regionkey AS list FROM {nation}")
def flat_cells(spark: SparkSession, d: str) -> DataFrame:
    return writers.flat(_rel(spark, d, "SELECT n_nationkey AS k, n_nationkey % 2 = 0 AS flag, CASE WHEN n_nationkey % 3 > 0 THEN n_name END AS name, array(n_nationkey, n_regionkey) AS list FROM {nation}"))


# -- reads, graphs, intervals ----------------------------------------------------------------------------------------


@_query("SELECT l_suppkey, CAST(round_even(avg(n), 0) AS INT) AS read_length FROM (SELECT l_suppkey, CAST(l_quantity AS INT) AS n, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber) AS r FROM {lineitem}) WHERE r <= 100 GROUP BY 1")
def read_lengths(spark: SparkSession, d: str) -> DataFrame:
    """Mean length of the first hundred reads of each supplier."""
    li = _rel(spark, d, "SELECT l_suppkey, l_orderkey * 10 + l_linenumber AS at, repeat('A', CAST(l_quantity AS INT)) AS seq FROM {lineitem}")
    return evidence.read_length(li, ["l_suppkey"], "at", most=100)


_EDGES = "SELECT CAST(o_custkey AS BIGINT) AS a, 1000000000 + CAST(floor(o_custkey / 7) AS BIGINT) * 3 + o_orderkey % 3 AS b, o_orderkey % 77 AS overlap FROM {orders}"


@_query(
    f"""WITH RECURSIVE e AS ({_EDGES}), linked AS (SELECT a AS x, b AS y FROM e UNION SELECT b, a FROM e), t AS (SELECT DISTINCT a AS x FROM e WHERE a % 50 = 1), r AS (SELECT x FROM t UNION SELECT y FROM r JOIN linked USING (x))
    SELECT coalesce(max(overlap), 0) AS max_overlap FROM e WHERE a IN (SELECT x FROM r)"""
)
def component_overlaps(spark: SparkSession, d: str) -> DataFrame:
    """The largest overlap in the parts of a graph that hold a target."""
    e = _rel(spark, d, _EDGES)
    targets = e.filter("a % 50 = 1").select(F.col("a").alias("segment")).distinct()
    return graph.component_overlap(e, targets, "a", "b", "overlap", keeper(spark))


@_query("SELECT l_orderkey, l_linenumber, q BETWEEN t - 5 AND t + 5 AS holds, q - 2 <= t + 5 AND t - 5 <= q + 2 AS meets, abs(q - t) < 0.5 AS same FROM (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DOUBLE) AS q, CAST(l_tax * 500 AS DOUBLE) AS t FROM {lineitem})")
def interval_predicates(spark: SparkSession, d: str) -> DataFrame:
    li = _rel(spark, d, "SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DOUBLE) AS q, CAST(l_tax * 500 AS DOUBLE) AS t FROM {lineitem}")
    q, t = F.col("q"), F.col("t")
    return li.select("l_orderkey", "l_linenumber", S.interval_contains(t - 5, t + 5, q).alias("holds"), S.interval_overlaps(q - 2, q + 2, t - 5, t + 5).alias("meets"), S.same_value("q", "t", 0.5).alias("same"))


@_query("SELECT l_suppkey, greatest(CAST(l_partkey AS BIGINT) - 10, 1) AS s, least(CAST(l_partkey AS BIGINT) + 15, 190) AS e FROM {lineitem}")
def padded_spans(spark: SparkSession, d: str) -> DataFrame:
    return intervals.pad(_rel(spark, d, "SELECT l_suppkey, CAST(l_partkey AS BIGINT) AS s, CAST(l_partkey AS BIGINT) + 5 AS e FROM {lineitem}"), "s", "e", 10, F.lit(190).cast("long"))


_PLANTED = "SELECT id % 25 AS g, id, seq, replace(substr(seq, 1, CAST(45 + id % 9 AS INT)), 'N', 'A') AS part FROM ({seqs}) AS q"


@_query(f"WITH p AS ({_duck(_PLANTED)}) SELECT id, id AS subject, 1 AS qstart, CAST(length(part) AS INT) AS qend, CASE WHEN id % 2 = 1 THEN 21 ELSE CAST(20 + length(part) AS INT) END AS sstart, CASE WHEN id % 2 = 1 THEN CAST(20 + length(part) AS INT) ELSE 21 END AS send, 100.0::DOUBLE AS pident FROM p")
def local_alignments(spark: SparkSession, d: str) -> DataFrame:
    """Sequences planted on either strand between other bases, searched among all those of their group; best hit of each."""
    p = _rel(spark, d, _spark(_PLANTED))
    placed = F.when(F.col("id") % 2 == 1, F.col("part")).otherwise(S.reverse_complement("part"))
    subjects = p.select("g", F.col("id").alias("seq_id"), F.concat(F.lit("N" * 20), placed, F.lit("N" * 20)).alias("seq"))
    hits = alignment.local_hits(p.select("g", F.col("id").alias("seq_id"), F.col("part").alias("seq")), subjects, ["g"])
    best = ranking.ranked(hits, ["qseqid"], F.col("bitscore").desc(), F.col("sseqid")).filter("rank = 1")
    return best.select(F.col("qseqid").alias("id"), F.col("sseqid").alias("subject"), "qstart", "qend", "sstart", "send", "pident")


@_query("SELECT p_brand AS g, CAST(p_partkey AS BIGINT) AS id FROM (SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS n FROM {part}) WHERE n = 4")
def selected_baits(spark: SparkSession, d: str) -> DataFrame:
    """The record of each brand that has the wanted id."""
    p = _rel(spark, d, "SELECT p_brand AS g, CAST(p_partkey AS BIGINT) AS id, concat('b', CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS STRING)) AS seq_id FROM {part}")
    return discovery.selected_bait(p, ["g"], "b4", "seq_id").select("g", "id")
