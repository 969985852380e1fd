"""Queries of the sequence operators, each with SQL of the same result.

Their inputs are derived from the relational tables by SQL that both engines
understand, so that every row is known; the operators then run on them, and
the query's SQL states the same result in its own way.  ``{name}`` in such SQL
is a table.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.functions import sequence as S
from strandloom.operators import copy_number, decisions, discovery, evidence, graph, intervals, quality_control, ranking, scans, stats
from strandloom.sources import writers
from strandloom.sources.scratch import keeper

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _query(sql: str):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        SQL[f.__name__] = re.sub(r"\{(\w+)\}", r"\1", sql)
        return f

    return add


def _rel(spark: SparkSession, d: str, sql: str) -> DataFrame:
    """A frame of SQL; ``{name}`` is a table, ``{tasks}`` three tasks a core."""
    tasks = str(3 * spark.sparkContext.defaultParallelism)
    return spark.sql(re.sub(r"\{(\w+)\}", lambda m: tasks if m[1] == "tasks" else f"parquet.`{d}/{m[1]}.parquet`", sql))


_RC = lambda c: f"reverse(translate({c}, 'ACGTRYMKBDHVNacgtrymkbdhvn', 'TGCAYRKMVHDBNtgcayrkmvhdbn'))"

# -- pileups ---------------------------------------------------------------------------------------------------------

_PILE = """SELECT contig, position, k, a, b, c, e, a + b + c + e AS n, k % 3 = 0 AS indel, 53 + k % 21 AS bq, 53 + k % 23 AS mq
FROM (SELECT p_brand AS contig, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS BIGINT) AS position, p_partkey AS k, CASE WHEN p_partkey % 11 = 0 THEN 0 ELSE p_partkey % 7 END AS a,
CASE WHEN p_partkey % 11 = 0 THEN 0 ELSE p_partkey % 5 END AS b, CASE WHEN p_partkey % 11 < 4 THEN 0 ELSE (p_partkey * 3) % 10 END AS c, CASE WHEN p_partkey % 11 < 4 THEN 0 ELSE (p_partkey * 7) % 6 END AS e FROM {part})"""
_PILEUP = f"""SELECT contig, position, 'c' AS reference_base, CAST(n AS INT) AS depth, CASE WHEN n = 0 THEN '*' ELSE concat('^F', repeat('.', CAST(a AS INT)), repeat(',', CAST(b AS INT)), '$', repeat('T', CAST(c AS INT)), repeat('t', CAST(e AS INT)), CASE WHEN indel THEN '+2ag' ELSE '+' END) END AS read_bases,
CASE WHEN n = 0 THEN '*' ELSE repeat(chr(CAST(bq AS INT)), CAST(n AS INT)) END AS base_qualities, CASE WHEN n = 0 THEN '*' ELSE repeat(chr(CAST(mq AS INT)), CAST(n AS INT)) END AS mapping_qualities FROM ({_PILE}) AS pile"""
_SITES = f"""pile AS ({_PILE}),
s1 AS (SELECT *, CASE WHEN c + e > 0 THEN 'T' WHEN n > 0 AND indel THEN '+AG' ELSE '' END AS alt_base, CASE WHEN c + e > 0 THEN c WHEN n > 0 AND indel AND b = 0 THEN 1 ELSE 0 END AS af, CASE WHEN c + e > 0 THEN e WHEN n > 0 AND indel AND b > 0 THEN 1 ELSE 0 END AS ar FROM pile),
s2 AS (SELECT *, CASE WHEN n > 0 THEN (af + ar) / n ELSE 0.0 END AS fraction, a + b + af + ar AS total, a + af AS col, a + b AS r FROM s1),
x AS (SELECT contig, position, a, total, col, r, unnest(range(CAST(greatest(0, r + col - total) AS BIGINT), CAST(least(r, col) AS BIGINT) + 1)) AS i FROM s2 WHERE af + ar > 0),
l AS (SELECT *, lgamma(r + 1) + lgamma(total - r + 1) + lgamma(col + 1) + lgamma(total - col + 1) - lgamma(total + 1) - lgamma(i + 1) - lgamma(r - i + 1) - lgamma(col - i + 1) - lgamma(total - r - col + i + 1) AS lp FROM x),
o AS (SELECT contig, position, max(lp) FILTER (i = a) AS obs FROM l GROUP BY 1, 2), f AS (SELECT contig, position, least(1.0, sum(exp(lp)) FILTER (lp <= obs + 1e-9)) AS p FROM l JOIN o USING (contig, position) GROUP BY 1, 2),
s3 AS (SELECT s2.*, coalesce(f.p, 1.0) AS p FROM s2 LEFT JOIN f USING (contig, position)),
s4 AS (SELECT *, n > 0 AND af + ar >= 2 AND fraction BETWEEN 0.05 AND 0.95 AS candidate, n > 0 AND fraction > 0.95 AS discordant FROM s3),
s5 AS (SELECT *, candidate AND (af = 0 OR ar = 0 OR p < 0.01) AS biased FROM s4),
sites AS (SELECT *, candidate AND NOT biased AS credible, CASE WHEN n = 0 THEN 'ZERO_DEPTH' ELSE concat_ws(';', CASE WHEN n < 2 THEN 'INSUFFICIENT_FILTERED_DEPTH' END, CASE WHEN n < 5 AND (a = 0 OR b = 0) THEN 'NO_BIDIRECTIONAL_SUPPORT' END, CASE WHEN fraction >= 0.2 THEN 'EXCESS_ALTERNATIVE_SUPPORT' END, CASE WHEN candidate AND NOT biased THEN 'CREDIBLE_MIXED_SITE' END,
CASE WHEN bq - 33 < 25 THEN 'LOW_BASE_QUALITY' END, CASE WHEN mq - 33 < 25 THEN 'LOW_MAPPING_QUALITY' END) END AS reason FROM s5)"""


def _support(spark: SparkSession, d: str) -> DataFrame:
    return evidence.per_base(_rel(spark, d, _PILEUP), min_base_quality=25, min_mapping_quality=25)


@_query(
    f"""WITH {_SITES} SELECT contig, position, CAST(n AS INT) AS depth, CAST(a + c AS INT) AS forward_depth, CAST(b + e AS INT) AS reverse_depth, CASE WHEN n > 0 THEN 200.0 * least(a + c, b + e) / n ELSE 0.0 END AS strand_balance_pct, CAST(a AS INT) AS ref_forward, CAST(b AS INT) AS ref_reverse, alt_base, CAST(af AS INT) AS alt_forward, CAST(ar AS INT) AS alt_reverse,
    round(fraction, 6) AS alt_fraction, CASE WHEN n > 0 THEN CAST(bq - 33 AS DOUBLE) ELSE 0.0 END AS mean_base_quality, CASE WHEN n > 0 THEN CAST(mq - 33 AS DOUBLE) ELSE 0.0 END AS mean_mapping_quality, round(p, 6) AS strand_bias_pvalue, candidate AS candidate_mixed_site, credible AS credible_mixed_site, biased AS strand_biased_site, discordant AS reference_discordant_site, n < 5 AS is_low_coverage, reason <> '' AS is_uncertain, reason AS uncertainty_reason FROM sites"""
)
def pileup_support(spark: SparkSession, d: str) -> DataFrame:
    """Evidence per position of pileups made of the parts of each brand."""
    s = _support(spark, d).select(*[c for c in evidence.SUPPORT_COLUMNS if c != "reference_base"])
    return s.withColumn("alt_fraction", F.round("alt_fraction", 6)).withColumn("strand_bias_pvalue", F.round("strand_bias_pvalue", 6))


@_query(
    f"""WITH {_SITES}, z AS (SELECT contig, count(*) + 3 AS size FROM sites GROUP BY 1), w AS (SELECT sites.*, size, least(position, size + 1 - position) > 2 AS inner_ FROM sites JOIN z USING (contig)),
    g AS (SELECT contig, any_value(size) AS size, sum(n) AS total, max(n) AS mx, count(*) FILTER (n > 0) AS covered, count(*) FILTER (n < 5) + 3 AS lt5, count(*) FILTER (n < 10) + 3 AS lt10, count(*) FILTER (reason <> '') + 3 AS unsure, count(*) FILTER (inner_) AS il, count(*) FILTER (inner_ AND reason <> '') AS iu, count(*) FILTER (inner_ AND n = 0) AS iz,
    count(*) FILTER (n = 0) + 3 AS zero, sum(n * (bq - 33)) AS bqs, sum(n * (mq - 33)) AS mqs, sum(a + c) AS f, sum(b + e) AS r, count(*) FILTER (candidate) AS cand, count(*) FILTER (credible) AS cred, count(*) FILTER (biased) AS bias, count(*) FILTER (discordant) AS disc, max(fraction) AS mf, coalesce(median(fraction) FILTER (credible), 0.0) AS medf FROM w GROUP BY 1)
    SELECT contig, size AS allele_len, round(total / size, 6) AS mean_depth, CAST(0 AS BIGINT) AS min_depth, CAST(mx AS INT) AS max_depth, round(100.0 * covered / size, 6) AS breadth_pct, lt5 AS bases_lt5, lt10 AS bases_lt10, round(100.0 * lt5 / size, 6) AS pct_bases_lt5, unsure AS uncertain_base_count, round(unsure / size, 6) AS uncertain_base_fraction, il AS interior_length, iu AS interior_uncertain_base_count, il >= greatest(50, floor(0.2 * size)) AS interior_metric_used,
    round(CASE WHEN il >= greatest(50, floor(0.2 * size)) THEN iu / il ELSE unsure / size END, 6) AS tier_uncertain_base_fraction, iz AS internal_zero_depth_positions, zero AS zero_depth, round(CASE WHEN total > 0 THEN bqs / total ELSE 0.0 END, 6) AS mean_base_quality, round(CASE WHEN total > 0 THEN mqs / total ELSE 0.0 END, 6) AS mean_mapping_quality, CAST(f AS BIGINT) AS forward_observations, CAST(r AS BIGINT) AS reverse_observations,
    round(CASE WHEN f + r > 0 THEN 200.0 * least(f, r) / (f + r) ELSE 0.0 END, 6) AS strand_balance_pct, cand AS candidate_mixed_sites, cred AS mixed_site_count, bias AS strand_biased_sites, disc AS reference_discordant_sites, round(mf, 6) AS max_alt_fraction, round(medf, 6) AS median_mixed_fraction, cred >= 2 AS mixture_detected FROM g"""
)
def support_summary(spark: SparkSession, d: str) -> DataFrame:
    """Metrics of each brand's positions, three of which have no row."""
    support = _support(spark, d)
    lengths = support.groupBy("contig").agg((F.count(F.lit(1)) + 3).alias("length"))
    s = evidence.summary(support, lengths, margin=2).withColumn("zero_depth", F.col("uncertainty_reasons")["ZERO_DEPTH"])
    keep = "contig allele_len mean_depth min_depth max_depth breadth_pct bases_lt5 bases_lt10 pct_bases_lt5 uncertain_base_count uncertain_base_fraction interior_length interior_uncertain_base_count interior_metric_used tier_uncertain_base_fraction internal_zero_depth_positions zero_depth mean_base_quality mean_mapping_quality forward_observations reverse_observations strand_balance_pct candidate_mixed_sites mixed_site_count strand_biased_sites reference_discordant_sites max_alt_fraction median_mixed_fraction mixture_detected".split()
    return s.select(*[F.round(c, 6).alias(c) if dict(s.dtypes)[c] == "double" else F.col(c).cast("long").alias(c) if c == "min_depth" else F.col(c) for c in keep])


@_query(f"WITH {_SITES} SELECT contig, position, printf('%d', n) AS depth, printf('%g', fraction) AS alt_fraction, CASE WHEN candidate THEN 'true' ELSE 'false' END AS candidate_mixed_site, reason AS uncertainty_reason FROM sites")
def support_table(spark: SparkSession, d: str) -> DataFrame:
    """Cells of the support table's text form."""
    s = _support(spark, d)
    return writers.support_rows(s).select("contig", F.col("position").cast("long").alias("position"), "depth", "alt_fraction", "candidate_mixed_site", "uncertainty_reason")


# -- sequences, texts and spans --------------------------------------------------------------------------------------

_SEQS = "SELECT p_partkey AS id, upper(concat(translate(substr(sha256_hex, 1, 60), '0123456789abcdef', 'ACGTTAGACGTNTAAC'), CASE WHEN p_partkey % 2 = 0 THEN 'NNNN' ELSE '' END, translate(substr(sha256_hex, 1, 41), '0123456789abcdef', 'TGATAACGTACGTTGA'))) AS seq FROM (SELECT p_partkey, {hash} AS sha256_hex FROM {part}) AS h"
# A table of few bytes is read by one task, however many rows it has: they are dealt to tasks before each is worked on.
_SPARK_SEQS = _SEQS.replace("{hash}", "sha2(p_name || cast(p_partkey as string), 256)").replace("{part}", "(SELECT /*+ REPARTITION({tasks}, p_partkey) */ p_partkey, p_name FROM {part})")
_DUCK_SEQS = _SEQS.replace("{hash}", "sha256(p_name || CAST(p_partkey AS VARCHAR))")


def _stops(s: str, f: int) -> str:
    n = f"CAST(floor((length({s}) - {f}) / 3) AS BIGINT)"
    return f"len(list_filter(range(0, greatest({n} - 1, 0)), lambda i: substring({s}, i * 3 + {f} + 1, 3) IN ('TAA', 'TAG', 'TGA')))"


_FRAMES = "list_value(" + ", ".join(f"{{'n': {_stops(x, f)}, 'label': '{sign}{f + 1}'}}" for sign, x in (("+", "seq"), ("-", "rc")) for f in range(3)) + ")"


@_query(
    f"""WITH s AS (SELECT id, seq, {_RC("seq")} AS rc, replace(seq, 'N', '') AS bare FROM ({_DUCK_SEQS})), e AS (SELECT id, seq, rc, list_sort({_FRAMES})[1] AS best, bare FROM s), b AS (SELECT id, list_sort({_FRAMES})[1].n AS closed FROM (SELECT id, bare AS seq, {_RC("bare")} AS rc FROM s))
    SELECT id, CAST(best.n AS INT) AS stops, best.label AS frame, substring(CASE WHEN best.label[1] = '+' THEN seq ELSE rc END, CAST(best.label[2] AS INT)) AS view, CAST(closed AS INT) AS closed, CAST(len(list_distinct(list_transform(range(1, length(seq) - 5), lambda i: substring(seq, i, 7)))) AS INT) AS kmers,
    regexp_replace(regexp_replace(seq, '^N+', ''), 'N+$', '') LIKE '%N%' AS has_interior_run FROM e JOIN b USING (id)"""
)
def reading_frames(spark: SparkSession, d: str) -> DataFrame:
    """Fewest stops over six frames, the view in that frame, the stops without placeholders, distinct 7-mers."""
    s = _rel(spark, d, _SPARK_SEQS)
    six = S.six_frame_stops("seq")
    return s.withColumn("six", six).select(
        "id", F.col("six.stops").alias("stops"), F.col("six.frame").alias("frame"), S.coding_view("seq", "six.frame").alias("view"), S.six_frame_stops(S.excise_runs("seq"))["stops"].alias("closed"), F.size(S.kmers("seq", 7)).alias("kmers"), (F.size(S.interior_runs("seq")) > 0).alias("has_interior_run"),
    )


@_query(
    f"""WITH s AS (SELECT id, seq, regexp_extract_all(seq, 'N+|[^N]+') AS parts FROM ({_DUCK_SEQS})), t AS (SELECT id, seq, parts, unnest(range(1, len(parts) + 1)) AS i FROM s),
    r AS (SELECT id, seq, parts[i] AS part, length(array_to_string(parts[1:i - 1], '')) AS before FROM t WHERE parts[i][1] = 'N')
    SELECT id, CAST(before + 1 AS INT) AS start, CAST(before + length(part) AS INT) AS "end" FROM r WHERE before > 0 AND before + length(part) < length(seq) AND length(part) >= 2"""
)
def interior_placeholders(spark: SparkSession, d: str) -> DataFrame:
    return _rel(spark, d, _SPARK_SEQS).select("id", F.explode(S.interior_runs("seq", "N", 2)).alias("r")).select("id", "r.start", "r.end")


_HITS = """SELECT o_custkey AS q, concat('s', CAST(o_orderkey % 3 AS STRING)) AS sseqid, CAST(o_orderkey AS BIGINT) AS hit, 1 + o_orderkey % 90 AS qstart, 1 + o_orderkey % 90 + 20 + o_orderkey % 41 AS qend, CASE WHEN o_orderkey % 2 = 0 THEN 1 + o_orderkey % 211 ELSE 1 + o_orderkey % 211 + 20 + o_orderkey % 41 END AS sstart,
CASE WHEN o_orderkey % 2 = 0 THEN 1 + o_orderkey % 211 + 20 + o_orderkey % 41 ELSE 1 + o_orderkey % 211 END AS send, CAST(21 + o_orderkey % 41 AS INT) AS length, 78.0 + o_orderkey % 22 AS pident, 50.0 + o_orderkey % 50 AS qcovhsp, CAST(o_orderkey % 97 AS DOUBLE) AS bitscore, CAST(150 AS BIGINT) AS qlen, CAST(260 AS BIGINT) AS slen FROM {orders}"""
_DUCK_HITS = _HITS.replace("AS STRING", "AS VARCHAR")


@_query(
    f"""WITH h AS ({_DUCK_HITS}), p AS (SELECT *, sstart <= send AS fw, CASE WHEN sstart <= send THEN sstart - (qstart - 1) ELSE send - (qlen - qend) END AS s, CASE WHEN sstart <= send THEN send + (qlen - qend) ELSE sstart + (qstart - 1) END AS e FROM h),
    c AS (SELECT *, greatest(1 - s, 0) AS l, greatest(e - slen, 0) AS r FROM p)
    SELECT hit, CASE WHEN fw THEN '+' ELSE '-' END AS strand, greatest(s, 1) AS start, least(e, slen) AS stop, l AS clipped_start, r AS clipped_end, CAST((CASE WHEN l > 0 THEN 1 ELSE 0 END) + (CASE WHEN r > 0 THEN 1 ELSE 0 END) AS INT) AS lost, l + r AS clipped_bp FROM c"""
)
def projected_spans(spark: SparkSession, d: str) -> DataFrame:
    """Where the whole query would lie for each hit, and what the contig's ends cut off."""
    p = discovery.projected_span(_rel(spark, d, _HITS))
    return p.select("hit", "span.strand", "span.start", F.col("span.end").alias("stop"), "span.clipped_start", "span.clipped_end", F.size("span.lost").alias("lost"), "clipped_bp")


@_query(
    f"""WITH h AS ({_DUCK_HITS}), f AS (SELECT q, sseqid, least(sstart, send) - 1 AS s, greatest(sstart, send) AS e FROM h WHERE pident >= 85 AND length >= 30), w AS (SELECT q, sseqid, greatest(s - 30, 0) AS s, least(250, e + 30) AS e FROM f),
    m AS (SELECT *, max(e) OVER (PARTITION BY q, sseqid ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM w), i AS (SELECT *, sum(CASE WHEN b IS NULL OR s > b + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY q, sseqid ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS i FROM m)
    SELECT q, sseqid AS contig, min(s) AS start, max(e) AS stop FROM i GROUP BY q, sseqid, i"""
)
def padded_regions(spark: SparkSession, d: str) -> DataFrame:
    """Merged target regions about strong hits, padded within contigs of 250 bases."""
    hits = discovery.strong_hits(_rel(spark, d, _HITS), 85, 30)
    lengths = hits.select("q", F.col("sseqid").alias("contig"), F.lit(250).cast("long").alias("length")).distinct()
    return discovery.target_regions(hits, lengths, ["q"], 30).withColumnRenamed("end", "stop")


@_query(
    f"""WITH h AS ({_DUCK_HITS}), l AS (SELECT *, least(sstart, send) AS s, greatest(sstart, send) AS e FROM h), m AS (SELECT *, max(e) OVER (PARTITION BY q, sseqid ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM l),
    i AS (SELECT *, sum(CASE WHEN b IS NULL OR s > b + 20 THEN 1 ELSE 0 END) OVER (PARTITION BY q, sseqid ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS i FROM m),
    r AS (SELECT *, min(s) OVER w AS region_start, max(e) OVER w AS region_end, count(*) OVER w AS support, row_number() OVER (PARTITION BY q, sseqid, i ORDER BY bitscore DESC, qcovhsp DESC, pident DESC, length DESC, s, e) AS n FROM i WINDOW w AS (PARTITION BY q, sseqid, i)),
    t AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY bitscore DESC, qcovhsp DESC, pident DESC, length DESC, sseqid, region_start) AS place FROM r WHERE n = 1)
    SELECT q, max(hit) FILTER (place = 1) AS hit, max(region_start) FILTER (place = 1) AS region_start, max(region_end) FILTER (place = 1) AS region_end, max(support) FILTER (place = 1) AS support, max(place) AS candidates, coalesce(max(bitscore) FILTER (place = 2), 0.0) AS second_best_bitscore,
    coalesce(max(pident) FILTER (place = 2), 0.0) AS second_best_identity, coalesce(max(bitscore) FILTER (place = 1) - max(bitscore) FILTER (place = 2), 999999.0) AS bitscore_margin, coalesce(max(bitscore) FILTER (place = 1) - max(bitscore) FILTER (place = 2), 999999.0) < 10 AS ambiguous FROM t GROUP BY q"""
)
def ranked_candidates(spark: SparkSession, d: str) -> DataFrame:
    """The best of the distinct candidate regions of each query, and its margin over the second."""
    c = discovery.candidate_regions(_rel(spark, d, _HITS), ["q"])
    top = c.filter("place = 1").select("q", "hit", "region_start", "region_end", "support")
    number = c.groupBy("q").agg(F.max("place").cast("long").alias("candidates"))
    return top.join(number, "q").join(discovery.hit_ambiguity(c, ["q"]).drop("best_bitscore"), "q")


@_query(
    f"""WITH h AS ({_DUCK_HITS}), b AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY bitscore DESC, qcovhsp DESC, pident DESC, length DESC, sseqid, hit) AS n, row_number() OVER (PARTITION BY q ORDER BY length DESC, hit) AS m FROM h),
    o AS (SELECT q, arg_min(hit, (qstart, -bitscore, sseqid, sstart, send)) AS left_hit, arg_max(hit, (qend, bitscore, sseqid, sstart, send)) AS right_hit FROM h GROUP BY q)
    SELECT q, max(pident) FILTER (n = 1) AS identity, max(qcovhsp) FILTER (n = 1) AS coverage, max(CASE WHEN pident = 99 AND qcovhsp = 99 THEN 1 ELSE 0 END) FILTER (n = 1) = 1 AS exact, CASE WHEN max(pident) FILTER (n = 1) < 85 OR max(qcovhsp) FILTER (n = 1) < 80 THEN 'SKIP' ELSE 'GO' END AS gate,
    CASE WHEN max(pident) FILTER (n = 1) = 99 AND max(qcovhsp) FILTER (n = 1) = 99 THEN 'EXACT_MATCH' WHEN max(pident) FILTER (n = 1) < 85 THEN 'HIGHLY_DIVERGENT_FROM_REFERENCE' WHEN max(pident) FILTER (n = 1) < 97 THEN 'DIVERGENT_FROM_REFERENCE' ELSE 'NONEXACT_MATCH' END AS catalogue_status,
    max(hit) FILTER (m = 1) AS longest, max(left_hit) AS left_hit, max(right_hit) AS right_hit FROM b JOIN o USING (q) GROUP BY q"""
)
def validated_hits(spark: SparkSession, d: str) -> DataFrame:
    """Best validation hit of each query with its gate and catalogue status, its longest and its outermost hits."""
    hits = _rel(spark, d, _HITS).withColumn("qcovs", F.col("qcovhsp"))
    best = ranking.ranked(hits, ["q"], *[F.col(c).desc() for c in ("bitscore", "qcovs", "pident", "length")], F.col("sseqid"), F.col("hit")).filter("rank = 1")
    exact = quality_control.exact_known((F.col("pident") == 99).cast("int") * 100, (F.col("qcovs") == 99).cast("int") * 100, "length", "length", "length")
    gate = F.when(quality_control.validation_gate(F.col("pident"), F.col("qcovs")).isNull(), "GO").otherwise("SKIP")
    told = best.select("q", F.col("pident").cast("double").alias("identity"), F.col("qcovs").cast("double").alias("coverage"), exact.alias("exact"), gate.alias("gate"), decisions.catalogue_status(F.col("pident"), exact).alias("catalogue_status"))
    ends = discovery.outermost_hits(hits, ["q"]).select("q", F.col("left.hit").alias("left_hit"), F.col("right.hit").alias("right_hit"))
    return told.join(discovery.longest_hit(hits, ["q"], "hit").select("q", F.col("hit").alias("longest")), "q").join(ends, "q")


@_query(
    f"""WITH RECURSIVE h AS ({_DUCK_HITS}), f AS (SELECT q, sseqid, hit, least(sstart, send) AS s, greatest(sstart, send) AS e, row_number() OVER (PARTITION BY q, sseqid ORDER BY bitscore DESC, qend - qstart DESC, pident DESC, sstart, send, hit) AS n FROM h WHERE length >= 30 AND pident >= 80),
    w AS (SELECT q, sseqid, n, hit, [{{'s': s, 'e': e}}] AS kept, true AS taken FROM f WHERE n = 1
    UNION ALL SELECT f.q, f.sseqid, f.n, f.hit, CASE WHEN len(list_filter(w.kept, lambda x: x.s <= f.e AND f.s <= x.e)) = 0 THEN list_append(w.kept, {{'s': f.s, 'e': f.e}}) ELSE w.kept END, len(list_filter(w.kept, lambda x: x.s <= f.e AND f.s <= x.e)) = 0 FROM w JOIN f ON f.q = w.q AND f.sseqid = w.sseqid AND f.n = w.n + 1)
    SELECT q, sseqid, hit FROM w WHERE taken"""
)
def graph_target_hits(spark: SparkSession, d: str) -> DataFrame:
    """Hits that overlap no better hit on their segment."""
    return discovery.graph_hits(_rel(spark, d, _HITS).withColumn("qlen", F.lit(300)), "qlen", ["q"], 80, 0.1, 30).select("q", "sseqid", "hit")


@_query(
    f"""WITH h AS ({_DUCK_HITS}), u AS (SELECT q, greatest(1, least(qstart, 100)) AS s, greatest(1, least(qend, 100)) AS e FROM h), m AS (SELECT *, max(e) OVER (PARTITION BY q ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM u),
    i AS (SELECT *, sum(CASE WHEN b IS NULL OR s > b + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY q ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS i FROM m), r AS (SELECT q, max(e) - min(s) + 1 AS n FROM i GROUP BY q, i) SELECT q, CAST(sum(n) AS BIGINT) AS covered_bp FROM r GROUP BY q"""
)
def clamped_union(spark: SparkSession, d: str) -> DataFrame:
    return discovery.query_union(_rel(spark, d, _HITS).withColumn("qlen", F.lit(100)), ["q"], "qlen")


_LOST = "SELECT q, sseqid AS subject, CAST(1 AS BIGINT) AS start, CAST(qstart - 1 AS BIGINT) AS \"end\" FROM ({hits}) AS h WHERE hit % 4 = 0 AND qstart > 10"


@_query(
    f"""WITH h AS ({_DUCK_HITS}), l AS (SELECT DISTINCT q, sseqid AS subject, CAST(1 AS BIGINT) AS start, CAST(qstart - 1 AS BIGINT) AS stop FROM h WHERE hit % 4 = 0 AND qstart > 10),
    n AS (SELECT l.q, subject, start, stop, sseqid AS other, CAST(sum(greatest(least(stop, qend) - greatest(start, qstart) + 1, 0)) AS BIGINT) AS recovered FROM l JOIN h ON l.q = h.q AND sseqid <> subject AND qstart <= stop AND qend >= start GROUP BY ALL)
    SELECT q, subject, start, stop, other, recovered FROM (SELECT *, row_number() OVER (PARTITION BY q, subject, start, stop ORDER BY recovered DESC, other DESC) AS r FROM n) WHERE r = 1"""
)
def continued_elsewhere(spark: SparkSession, d: str) -> DataFrame:
    """The other subject that covers most of a query interval that a subject lost."""
    h = _rel(spark, d, _HITS)
    lost = h.filter("hit % 4 = 0 and qstart > 10").select("q", F.col("sseqid").alias("subject"), F.lit(1).cast("long").alias("start"), (F.col("qstart") - 1).cast("long").alias("end")).distinct()
    return intervals.continuation(lost, h.select("q", F.col("sseqid").alias("subject"), "qstart", "qend"), ["q"]).withColumnRenamed("end", "stop")


# -- copy number -----------------------------------------------------------------------------------------------------

_DEPTH = "SELECT 'a' AS sample, l_returnflag AS contig, CAST(row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber) AS BIGINT) AS pos, CAST(CASE WHEN l_returnflag = 'R' AND l_linenumber > 2 THEN l_quantity * 2 ELSE l_quantity END AS INT) AS depth, CAST(l_quantity * 2 + l_linenumber AS INT) AS depth_raw FROM {lineitem}"
_REGIONS = [("two", 0, "R", 101, 400, 1, 300), ("two", 1, "A", 201, 500, 200, 499), ("part", 0, "R", 301, 700, 50, 449), ("whole", 0, "A", 51, 250, None, None)]
_GENES = [("two", 499), ("part", 600), ("whole", None)]
_VALUES = lambda rows: ", ".join("(" + ", ".join("NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)


@_query(
    f"""WITH d AS ({_DEPTH}), c AS (SELECT contig, count(*) AS n FROM d GROUP BY 1), r AS (SELECT * FROM (VALUES {_VALUES(_REGIONS)}) AS t(target, region, contig, s, e, gs, ge)), g AS (SELECT * FROM (VALUES {_VALUES(_GENES)}) AS t(target, len)),
    i AS (SELECT target, region, pos, depth, depth_raw FROM r JOIN d ON d.contig = r.contig AND pos BETWEEN s AND e), reg AS (SELECT target, region, median(depth) AS m FROM i GROUP BY 1, 2), loc AS (SELECT target, median(depth) AS m, median(depth_raw) AS raw FROM i GROUP BY 1),
    b AS (SELECT g.target, d.depth FROM g JOIN d ON true JOIN c USING (contig) WHERE n >= 1000 AND pos BETWEEN 101 AND n - 100 AND NOT (d.contig = 'N' AND pos BETWEEN 500 AND 900) AND NOT EXISTS (SELECT 1 FROM r WHERE r.target = g.target AND r.contig = d.contig AND pos BETWEEN s AND e)),
    base AS (SELECT target, median(depth) AS m FROM b GROUP BY 1), mad AS (SELECT target, median(abs(depth - m)) AS mad FROM b JOIN base USING (target) GROUP BY 1),
    sp AS (SELECT r.target, region, coalesce(gs, 1) AS gs, coalesce(ge, e - s + 1) AS ge, coalesce(len, e - s + 1) AS len, reg.m / base.m AS ratio FROM r JOIN g USING (target) JOIN reg USING (target, region) JOIN base USING (target)),
    pos AS (SELECT target, len, unnest(range(1, CAST(len AS BIGINT) + 1)) AS j FROM (SELECT DISTINCT target, len FROM sp)), mult AS (SELECT pos.target, pos.len, j, count(sp.region) AS k, coalesce(sum(ratio), 0.0) AS x FROM pos LEFT JOIN sp ON sp.target = pos.target AND j BETWEEN gs AND ge GROUP BY ALL),
    dose AS (SELECT target, any_value(len) AS len, sum(x) / count(*) FILTER (k > 0) AS dosage, sum(x) / count(*) AS lo, (sum(x) + count(*) FILTER (k = 0) * max(x)) / count(*) AS hi, max(x) AS mx, count(*) FILTER (k > 0) AS covered, sum(k) AS total FROM mult GROUP BY 1)
    SELECT target, round(loc.m, 2) AS locus_median_depth, round(base.m, 2) AS backbone_median_depth, round(mad, 2) AS backbone_mad, round(loc.m / base.m, 3) AS ratio, round(loc.m / raw, 3) AS ambiguity_index, loc.m / raw >= 0.4 AS reliable, round(dosage, 3) AS dosage_estimate, round(lo, 3) AS dosage_lower, round(hi, 3) AS dosage_upper, round(mx, 3) AS query_multiplicity_max,
    round(covered / len, 4) AS query_coverage_fraction, CAST(total - covered AS BIGINT) AS gene_overlap_bp, CASE WHEN loc.m / raw < 0.4 THEN 'LOWER_BOUND' WHEN total > covered THEN 'REVIEW_OVERLAPPING_SPANS' WHEN covered < len THEN 'ESTIMATED_PARTIAL_COVERAGE' ELSE 'ESTIMATED' END AS dosage_status FROM loc JOIN base USING (target) JOIN mad USING (target) JOIN dose USING (target)"""
)
def locus_dosage(spark: SparkSession, d: str) -> DataFrame:
    """Ratio and dosage of three targets over the lines of each return flag as contigs; its interval is drawn, so it is left to tests."""
    keep = keeper(spark)
    lines = _rel(spark, d, "SELECT l_returnflag AS contig, l_orderkey, l_linenumber, l_quantity FROM {lineitem}")
    # A flag has a third or a half of all lines, so they are numbered by ranges; quantities settle what the SQL's order leaves open.
    order = ["l_orderkey", "l_linenumber", "l_quantity"]
    placed = scans.numbered(scans.dealt(lines, ["contig"], order, keep, "lines"), ["contig"], order, "pos")
    depth = keep("depth", placed.selectExpr("'a' AS sample", "contig", "pos", "CAST(CASE WHEN contig = 'R' AND l_linenumber > 2 THEN l_quantity * 2 ELSE l_quantity END AS INT) AS depth", "CAST(l_quantity * 2 + l_linenumber AS INT) AS depth_raw"))
    contigs = depth.groupBy("sample", "contig").agg(F.count(F.lit(1)).alias("length"))
    regions = spark.createDataFrame([("a", *r) for r in _REGIONS], "sample string, target string, region int, contig string, start long, end long, gene_start long, gene_end long")
    targets = spark.createDataFrame([("a", *g) for g in _GENES], "sample string, target string, gene_length long")
    out = copy_number.depth_ratio(depth, contigs, regions, targets, ["sample"], spark.createDataFrame([("a", "N", 500, 900)], "sample string, contig string, start long, end long"), min_contig=1000, ambiguity_warn=0.4, keep=keep)
    return out.select("target", "locus_median_depth", "backbone_median_depth", "backbone_mad", "ratio", "ambiguity_index", "reliable", "dosage_estimate", "dosage_lower", "dosage_upper", "query_multiplicity_max", "query_coverage_fraction", "gene_overlap_bp", "dosage_status")


_CASES = """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 = 0 THEN CAST(NULL AS STRING) WHEN o_orderkey % 5 = 1 THEN 'MATCHED_CONTEXT_COUNT' WHEN o_orderkey % 5 = 2 THEN 'ASYMMETRIC_CONTEXTS' WHEN o_orderkey % 5 = 3 THEN 'TRAVERSAL_LIMIT_REACHED' ELSE 'GRAPH_INDETERMINATE' END AS graph_status, CASE WHEN o_orderkey % 5 = 1 THEN 1 + o_orderkey % 3 END AS exact,
CASE WHEN o_orderkey % 5 IN (1, 2, 3) THEN 1 + o_orderkey % 3 END AS lower, CASE WHEN o_orderkey % 7 < 3 THEN 'MULTICOPY_DEPTH' WHEN o_orderkey % 7 < 6 THEN 'SINGLE_COPY_COMPATIBLE' ELSE 'DEPTH_INDETERMINATE' END AS depth_call, o_orderkey % 4 > 0 AS reliable, CAST(o_orderkey % 9 AS DOUBLE) / 2 AS ci_low, CAST(o_orderkey % 9 AS DOUBLE) / 2 + 1 AS ci_high,
CASE WHEN o_orderkey % 11 = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST(o_orderkey % 9 AS DOUBLE) / 2 + 0.5 END AS dosage, CASE WHEN o_orderkey % 11 = 0 THEN 'NOT_ESTIMATED' WHEN o_orderkey % 4 = 0 THEN 'LOWER_BOUND' WHEN o_orderkey % 13 < 4 THEN 'REVIEW_OVERLAPPING_SPANS' ELSE 'ESTIMATED' END AS dosage_status FROM {orders}"""


@_query(
    f"""WITH c AS ({_CASES.replace("AS STRING", "AS VARCHAR")}), u AS (SELECT *, reliable AND depth_call <> 'DEPTH_INDETERMINATE' AS usable, depth_call = 'MULTICOPY_DEPTH' AS multi, CASE WHEN graph_status IN ('ASYMMETRIC_CONTEXTS', 'TRAVERSAL_LIMIT_REACHED') THEN lower END AS bound, coalesce(exact IS NOT NULL AND reliable AND (exact < ci_low OR exact > ci_high), false) AS apart FROM c),
    v AS (SELECT *, usable AND dosage IS NOT NULL AS dosed FROM u), r AS (SELECT *, CASE WHEN exact >= 2 AND usable AND multi THEN 1 WHEN exact = 1 AND usable AND NOT multi THEN 2 WHEN exact = 1 AND multi AND dosed THEN 3 WHEN exact >= 2 AND usable AND NOT multi THEN 4 WHEN bound IS NOT NULL AND usable AND multi THEN 5 WHEN NOT reliable AND multi AND dosage IS NOT NULL THEN 6 WHEN dosed THEN 7 ELSE 8 END AS rule FROM v)
    SELECT id, CASE WHEN rule IN (1, 2) THEN CAST(exact AS DOUBLE) WHEN rule IN (3, 7) THEN dosage END AS copy_number, CASE rule WHEN 1 THEN 'INTEGER_CONTEXT_COUNT' WHEN 2 THEN 'INTEGER_CONTEXT_COUNT' WHEN 3 THEN 'MEAN_DEPTH_DOSAGE' WHEN 7 THEN 'MEAN_DEPTH_DOSAGE' WHEN 5 THEN 'LOWER_BOUND' WHEN 6 THEN 'LOWER_BOUND' ELSE 'NOT_ESTIMATED' END AS kind,
    CASE WHEN rule IN (1, 2) AND apart THEN 'GRAPH_COUNT_OVER_DISCORDANT_DEPTH' WHEN rule IN (1, 2) THEN 'GRAPH_DEPTH_CONSENSUS' WHEN rule = 3 THEN 'DEPTH_TANDEM_COMPATIBLE' WHEN rule = 5 OR rule = 6 AND coalesce(exact, bound) > dosage THEN 'GRAPH_LOWER_BOUND' WHEN rule IN (6, 7) THEN 'DEPTH_ONLY' ELSE 'NONE' END AS method,
    CASE WHEN rule = 1 AND apart THEN 'REVIEW' WHEN rule IN (1, 2) THEN 'SUPPORTED' WHEN rule IN (3, 7) THEN CASE WHEN dosage_status = 'ESTIMATED' THEN 'SUPPORTED' ELSE 'REVIEW' END WHEN rule = 4 THEN 'EVIDENCE_CONFLICT' WHEN rule IN (5, 6) THEN 'LOWER_BOUND' ELSE 'INDETERMINATE' END AS status,
    CASE WHEN rule IN (1, 2) THEN CAST(exact AS DOUBLE) WHEN rule = 5 THEN CAST(bound AS DOUBLE) WHEN rule = 6 THEN greatest(dosage, coalesce(exact, bound, 0)) END AS lower_bound, CASE WHEN rule = 1 AND NOT apart OR rule = 2 THEN CAST(exact AS DOUBLE) END AS upper_bound,
    concat_ws(';', CASE WHEN apart AND rule <> 5 THEN 'DEPTH_GRAPH_NUMERIC_DISCORDANCE' END, CASE rule WHEN 3 THEN 'GRAPH_SINGLE_CONTEXT_TANDEM_DEPTH' WHEN 4 THEN 'GRAPH_MULTICOPY_DEPTH_SINGLE_COPY_COMPATIBLE' WHEN 6 THEN 'DEPTH_LOWER_BOUND' END,
    CASE WHEN rule = 6 AND graph_status = 'GRAPH_INDETERMINATE' OR rule = 7 AND graph_status IS NOT NULL OR rule = 8 AND graph_status <> 'MATCHED_CONTEXT_COUNT' THEN 'GRAPH_EVIDENCE_UNRESOLVED' END, CASE WHEN rule IN (3, 7) AND dosage_status <> 'ESTIMATED' THEN 'DOSAGE_' || dosage_status WHEN rule = 8 AND (NOT reliable OR depth_call = 'DEPTH_INDETERMINATE') THEN 'DEPTH_EVIDENCE_UNRELIABLE' END) AS flags FROM r"""
)
def copy_consensus(spark: SparkSession, d: str) -> DataFrame:
    """Depth and graph reconciled for every combination that the orders' keys give."""
    c = F.col
    depth = F.struct(c("depth_call"), c("reliable"), c("ci_low"), c("ci_high"), c("dosage"), c("dosage_status"))
    seen = F.when(c("graph_status").isNotNull(), F.struct(c("graph_status").alias("status"), c("exact"), c("lower").alias("lower_bound")))
    out = _rel(spark, d, _CASES).select(c("id"), decisions.consensus(depth, seen).alias("r")).select("id", "r.*")
    return out.withColumn("flags", F.concat_ws(";", "flags"))


@_query(
    """SELECT o_orderkey AS id, CASE WHEN l > 0 AND l = r AND NOT cut THEN 'MATCHED_CONTEXT_COUNT' WHEN cut THEN 'TRAVERSAL_LIMIT_REACHED' WHEN l > 0 AND r > 0 THEN 'ASYMMETRIC_CONTEXTS' WHEN l + r > 0 THEN 'ONE_SIDED_LOWER_BOUND' ELSE 'GRAPH_INDETERMINATE' END AS status, CASE WHEN l > 0 AND l = r AND NOT cut THEN l END AS exact,
    CASE WHEN l > 0 AND r > 0 THEN least(l, r) WHEN l + r > 0 THEN greatest(l, r) END AS lower_bound FROM (SELECT o_orderkey, o_orderkey % 4 AS l, CAST(floor(o_orderkey / 4) AS BIGINT) % 4 AS r, o_custkey % 5 = 0 AS cut FROM {orders})"""
)
def context_statuses(spark: SparkSession, d: str) -> DataFrame:
    o = _rel(spark, d, "SELECT o_orderkey AS id, o_orderkey % 4 AS l, CAST(floor(o_orderkey / 4) AS BIGINT) % 4 AS r, o_custkey % 5 = 0 AS cut FROM {orders}")
    return o.select("id", graph.context_status(F.col("l"), F.col("r"), F.col("cut")).alias("c")).select("id", "c.*")


@_query(
    """SELECT l_returnflag, l_linenumber, count(*) AS n, quantile_cont(l_extendedprice, 0.5) AS middle, quantile_cont(l_extendedprice, 0.05) AS p5, quantile_cont(l_extendedprice, 0.975) AS p97_5 FROM {lineitem} GROUP BY 1, 2"""
)
def bracketed_quantiles(spark: SparkSession, d: str) -> DataFrame:
    """Exact quantiles from brackets, so that no key's values meet in one place."""
    return stats.quantiles(_rel(spark, d, "SELECT l_returnflag, l_linenumber, l_extendedprice FROM {lineitem}"), ["l_returnflag", "l_linenumber"], "l_extendedprice", {"middle": 0.5, "p5": 0.05, "p97_5": 0.975}, 1000)


@_query("WITH r AS (SELECT event_type, event_id, value, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS i, count(*) OVER (PARTITION BY event_type) AS n FROM {events}), b AS (SELECT *, CAST(floor(i / 7) AS BIGINT) AS b, CAST(ceil(n / 7) AS BIGINT) AS m FROM r) SELECT event_type, event_id FROM b WHERE m <= 12 OR b IN (SELECT CAST(round_even(j * (m - 1) / 11, 0) AS BIGINT) FROM range(0, 12) t(j))")
def thinned_blocks(spark: SparkSession, d: str) -> DataFrame:
    """The events of twelve evenly spaced blocks of seven of each type."""
    return stats.thin_blocks(_rel(spark, d, "SELECT event_type, event_id FROM {events}"), ["event_type"], ["event_id"], 7, 12, keeper(spark))
