"""The library's operators on ordinary relational tables, each with SQL of the same result.

Columns stand in for their genomic counterparts: keys for samples or contigs,
dates and hours for positions, names for sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.functions import sequence as S
from strandloom.functions.statistics import fisher_exact
from strandloom.operators import decisions, discovery, evaluation, intervals, kmers, ranking, resampling, simulate, stats
from strandloom.sources.scratch import keeper

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


#: Microseconds of a time without zone, whatever the session's zone.
_EPOCH = "timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)"


def _day(c: str):
    return F.datediff(F.col(c), F.lit("1970-01-01").cast("date")).cast("long")


_SPANS = "spans AS (SELECT o_custkey AS k, datediff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS s, datediff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS e FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_shipdate >= o_orderdate)"
_ISLANDS = "marked AS (SELECT k, s, e, max(e) OVER (PARTITION BY k ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM spans), islands AS (SELECT k, s, e, sum(CASE WHEN b IS NULL OR s > b + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS i FROM marked), merged AS (SELECT k, i, min(s) AS s, max(e) AS e, count(*) AS n FROM islands GROUP BY k, i)"


def spans(spark: SparkSession, d: str) -> DataFrame:
    o, li = _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), _t(spark, d, "lineitem").select("l_orderkey", "l_shipdate")
    joined = o.join(li, F.col("o_orderkey") == F.col("l_orderkey")).filter("l_shipdate >= o_orderdate")
    return joined.select(F.col("o_custkey").alias("k"), _day("o_orderdate").alias("s"), _day("l_shipdate").alias("e"))


@_query(
    """WITH e AS (SELECT event_type, CAST(floor(epoch(ts) / 3600) AS BIGINT) AS hour, value FROM events), per AS (SELECT event_type, hour, sum(value) AS depth FROM e GROUP BY 1, 2),
    b AS (SELECT median(depth) AS m, count(*) AS n FROM per WHERE event_type NOT IN ('purchase', 'click')), mad AS (SELECT median(abs(depth - m)) AS mad FROM per, b WHERE event_type NOT IN ('purchase', 'click')),
    l AS (SELECT event_type, median(depth) AS m, count(*) AS n FROM per WHERE event_type IN ('purchase', 'click') GROUP BY 1)
    SELECT event_type, l.m AS locus_median, l.n AS locus_n, b.m AS backbone_median, mad.mad AS backbone_mad, b.n AS backbone_n, l.m / b.m AS ratio, CASE WHEN l.m / b.m > 1.5 THEN 'MULTICOPY_DEPTH' ELSE 'SINGLE_COPY_COMPATIBLE' END AS depth_call FROM l, b, mad"""
)
def depth_ratio(spark: SparkSession, d: str) -> DataFrame:
    """Hourly value sums of two event types over the median of the others."""
    e = _t(spark, d, "events").select("event_type", F.floor(F.expr(_EPOCH) / 3_600_000_000).alias("hour"), "value")
    per = e.groupBy("event_type", "hour").agg(F.sum("value").alias("depth"))
    kind = per.withColumn("locus", F.when(F.col("event_type").isin("purchase", "click"), F.col("event_type")))
    return stats.locus_ratio(kind, [], "locus", "depth").withColumnRenamed("locus", "event_type")


@_query("SELECT p_partkey, reverse(translate(p_name, 'ACGTRYMKBDHVNacgtrymkbdhvn', 'TGCAYRKMVHDBNtgcayrkmvhdbn')) AS rc, sha256(least(p_name, reverse(translate(p_name, 'ACGTRYMKBDHVNacgtrymkbdhvn', 'TGCAYRKMVHDBNtgcayrkmvhdbn')))) AS signature FROM part")
def canonical_names(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "part").select("p_partkey", S.reverse_complement("p_name").alias("rc"), S.canonical_signature("p_name").alias("signature"))


@_query(
    """SELECT doc_id, CASE WHEN k > 0 THEN g / k ELSE 0.0 END AS gc, CASE WHEN n > 0 THEN 100.0 * g / n ELSE 0.0 END AS gc_percent, CAST(len(list_filter(range(1, CAST(greatest(floor(n / 3) * 3 - 3, 0) AS BIGINT) + 1, 3), lambda i: substring(u, i, 3) IN ('TAA', 'TAG', 'TGA'))) AS INTEGER) AS stops
    FROM (SELECT doc_id, translate(text, 'acgt', 'ACGT') AS u, CAST(length(text) AS DOUBLE) AS n, CAST(length(text) - length(translate(text, 'GCgc', '')) AS DOUBLE) AS g, CAST(length(text) - length(translate(text, 'ACGTacgt', '')) AS DOUBLE) AS k FROM documents)"""
)
def composition(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "documents").select("doc_id", S.gc_fraction("text").alias("gc"), S.gc_percent("text").alias("gc_percent"), S.internal_stops("text").alias("stops"))


@_query(
    """WITH b AS (SELECT DISTINCT unnest(list_transform(range(1, greatest(length(text) - 24, 0) + 1), lambda i: substring(text, i, 25))) AS g FROM benchmark),
    q AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(length(text) - 24, 0) + 1), lambda i: substring(text, i, 25))) AS g FROM documents)
    SELECT doc_id, count(*) AS shared FROM q SEMI JOIN b USING (g) GROUP BY doc_id"""
)
def kmer_relatedness(spark: SparkSession, d: str) -> DataFrame:
    """Documents that share 25-mers with the benchmark."""
    known = _t(spark, d, "benchmark").select(F.explode(S.kmers("text", 25)).alias("g")).distinct()
    return kmers.known_kmers(_t(spark, d, "documents"), "doc_id", "text", known, 25).distinct().groupBy("doc_id").agg(F.count(F.lit(1)).alias("shared"))


@_query(f"WITH {_SPANS}, {_ISLANDS} SELECT k, s, e, n AS members FROM merged")
def merged_intervals(spark: SparkSession, d: str) -> DataFrame:
    return intervals.merge(spans(spark, d), ["k"], "s", "e", keep=keeper(spark))


@_query(f"WITH {_SPANS}, {_ISLANDS}, u AS (SELECT k, sum(e - s + 1) AS u FROM merged GROUP BY k), t AS (SELECT k, sum(e - s + 1) AS t FROM spans GROUP BY k) SELECT k, CAST(t AS BIGINT) AS total_length, CAST(u AS BIGINT) AS union_length, CAST(t - u AS BIGINT) AS overlap_length FROM t JOIN u USING (k)")
def interval_coverage(spark: SparkSession, d: str) -> DataFrame:
    return intervals.coverage(spans(spark, d), ["k"], "s", "e")


@_query(
    f"""WITH {_SPANS}, ev AS (SELECT k, s AS p, 1 AS x FROM spans UNION ALL SELECT k, e + 1, -1 FROM spans), st AS (SELECT k, p, sum(x) AS x FROM ev GROUP BY 1, 2),
    seg AS (SELECT k, p, lead(p) OVER (PARTITION BY k ORDER BY p) AS nx, sum(x) OVER (PARTITION BY k ORDER BY p ROWS UNBOUNDED PRECEDING) AS m FROM st)
    SELECT k, CAST(sum((nx - p) * m) AS DOUBLE) / sum(nx - p) AS dosage, CAST(max(m) AS BIGINT) AS max_multiplicity, CAST(sum(nx - p) AS BIGINT) AS covered FROM seg WHERE nx IS NOT NULL AND m > 0 GROUP BY k"""
)
def span_dosage(spark: SparkSession, d: str) -> DataFrame:
    return intervals.dosage(spans(spark, d), ["k"], "s", "e")


def _excluded(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    e = _t(spark, d, "events").select("event_id", "user_id", F.expr(_EPOCH).alias("at"))
    day = 86_400_000_000
    return e, e.groupBy("user_id").agg((F.min("at") + 2 * day).alias("a"), (F.min("at") + 5 * day).alias("b"))


@_query("WITH x AS (SELECT user_id AS u, min(epoch_us(ts)) + 172800000000 AS a, min(epoch_us(ts)) + 432000000000 AS b FROM events GROUP BY 1) SELECT event_id, user_id, epoch_us(ts) AS at FROM events WHERE NOT EXISTS (SELECT 1 FROM x WHERE u = user_id AND epoch_us(ts) BETWEEN a AND b)")
def positions_outside_spans(spark: SparkSession, d: str) -> DataFrame:
    e, x = _excluded(spark, d)
    return intervals.range_join(e, x, ["user_id"], "at", "a", "b", 86_400_000_000, "left_anti")


@_query("WITH x AS (SELECT user_id AS u, min(epoch_us(ts)) + 172800000000 AS a, min(epoch_us(ts)) + 432000000000 AS b FROM events GROUP BY 1) SELECT event_id, user_id, epoch_us(ts) AS at FROM events WHERE EXISTS (SELECT 1 FROM x WHERE u = user_id AND epoch_us(ts) BETWEEN a AND b)")
def positions_inside_spans(spark: SparkSession, d: str) -> DataFrame:
    e, x = _excluded(spark, d)
    return intervals.range_join(e, x, ["user_id"], "at", "a", "b", 86_400_000_000, "left_semi")


@_query("SELECT l_orderkey AS qname, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_partkey < 40 AND l_partkey + 5 > 20)")
def mate_rescue(spark: SparkSession, d: str) -> DataFrame:
    """Every line of the orders that hold a line whose place touches a region; orders are reads, parts are places."""
    li = _t(spark, d, "lineitem").select(F.lit(1).alias("sample"), F.col("l_returnflag").alias("contig"), F.col("l_orderkey").alias("qname"), "l_linenumber", "l_quantity", F.col("l_partkey").cast("long").alias("start"), (F.col("l_partkey") + 5).cast("long").alias("end"))
    regions = spark.createDataFrame([(1, "R", 20, 40)], "sample int, contig string, start long, end long")
    return discovery.rescued(li, discovery.seed_reads(li, regions, ["sample"], 100), ["sample"]).select("qname", "l_linenumber", "l_quantity")


@_query(
    """SELECT o_custkey, o_orderkey, o_totalprice, margin, margin < 10 AS ambiguous FROM (SELECT o_custkey, o_orderkey, o_totalprice, coalesce(o_totalprice - lead(o_totalprice) OVER w, 999999.0) AS margin, row_number() OVER w AS r FROM orders
    WINDOW w AS (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)) WHERE r = 1"""
)
def best_hit_margin(spark: SparkSession, d: str) -> DataFrame:
    o = _t(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return ranking.best_with_margin(o, ["o_custkey"], "o_totalprice", F.col("o_orderkey"))


@_query(
    """WITH e AS (SELECT user_id, event_id, epoch_us(ts) AS tm, value FROM events), m AS (SELECT *, max(tm) OVER (PARTITION BY user_id ORDER BY tm ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM e),
    i AS (SELECT *, sum(CASE WHEN b IS NULL OR tm > b + 3600000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY tm ROWS UNBOUNDED PRECEDING) AS i FROM m)
    SELECT user_id, event_id, tm, value, support FROM (SELECT *, count(*) OVER (PARTITION BY user_id, i) AS support, row_number() OVER (PARTITION BY user_id, i ORDER BY value DESC, event_id DESC) AS r FROM i) WHERE r = 1"""
)
def collapse_near_hits(spark: SparkSession, d: str) -> DataFrame:
    e = _t(spark, d, "events").select("user_id", "event_id", F.expr(_EPOCH).alias("tm"), "value")
    return ranking.collapse(e, ["user_id"], "tm", "tm", ["value", "event_id"], 3_600_000_000)


@_query(
    """WITH c AS (SELECT l_returnflag, median(l_extendedprice) AS median, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3, count(l_extendedprice) AS n FROM lineitem GROUP BY 1),
    m AS (SELECT l_returnflag, median(abs(l_extendedprice - median)) AS mad FROM lineitem JOIN c USING (l_returnflag) GROUP BY 1) SELECT l_returnflag, median, q1, q3, n, mad, q3 - q1 AS iqr FROM c JOIN m USING (l_returnflag)"""
)
def robust_statistics(spark: SparkSession, d: str) -> DataFrame:
    return stats.robust(_t(spark, d, "lineitem").select("l_returnflag", "l_extendedprice"), ["l_returnflag"], "l_extendedprice")


@_query(
    """WITH p AS (SELECT p_brand, length(p_name) AS n FROM part), c AS (SELECT p_brand, n, count(*) AS k FROM p GROUP BY 1, 2), m AS (SELECT p_brand, n AS mode_length FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY k DESC, n) AS r FROM c) WHERE r = 1)
    SELECT p_brand, count(*) AS n, CAST(min(p.n) AS INTEGER) AS min_length, CAST(max(p.n) AS INTEGER) AS max_length, avg(p.n) AS mean_length, stddev_pop(p.n) AS stdev_length, quantile_cont(p.n, 0.25) AS q1_length, quantile_cont(p.n, 0.75) AS q3_length, CAST(any_value(mode_length) AS INTEGER) AS mode_length FROM p JOIN m USING (p_brand) GROUP BY p_brand"""
)
def length_profile(spark: SparkSession, d: str) -> DataFrame:
    return stats.profile(_t(spark, d, "part").select("p_brand", F.length("p_name").alias("len")), ["p_brand"], "len")


@_query(
    """WITH t AS (SELECT l_suppkey, count(*) FILTER (l_returnflag = 'A' AND l_linestatus = 'F') AS a, count(*) FILTER (l_returnflag = 'A' AND l_linestatus <> 'F') AS b, count(*) FILTER (l_returnflag <> 'A' AND l_linestatus = 'F') AS c, count(*) FILTER (l_returnflag <> 'A' AND l_linestatus <> 'F') AS d FROM lineitem GROUP BY 1),
    f AS (SELECT *, a + b AS r, a + c AS k, a + b + c + d AS n FROM t), x AS (SELECT *, unnest(range(greatest(0, r + k - n), least(r, k) + 1)) AS i FROM f),
    p AS (SELECT l_suppkey, a, b, c, d, i, lgamma(r + 1) + lgamma(n - r + 1) + lgamma(k + 1) + lgamma(n - k + 1) - lgamma(n + 1) - lgamma(i + 1) - lgamma(r - i + 1) - lgamma(k - i + 1) - lgamma(n - r - k + i + 1) AS lp FROM x),
    o AS (SELECT l_suppkey, lp AS obs FROM p WHERE i = a)
    SELECT l_suppkey, a, b, c, d, round(least(1.0, sum(exp(lp))), 6) AS p_value, CASE WHEN a + b > 0 THEN 200.0 * least(a, b) / (a + b) ELSE 0.0 END AS balance FROM p JOIN o USING (l_suppkey) WHERE lp <= obs + 1e-9 GROUP BY l_suppkey, a, b, c, d"""
)
def strand_bias(spark: SparkSession, d: str) -> DataFrame:
    """Fisher's exact test and balance of two flags per supplier."""
    flag, status = F.col("l_returnflag") == "A", F.col("l_linestatus") == "F"
    t = _t(spark, d, "lineitem").groupBy("l_suppkey").agg(F.count_if(flag & status).alias("a"), F.count_if(flag & ~status).alias("b"), F.count_if(~flag & status).alias("c"), F.count_if(~flag & ~status).alias("d"))
    return t.select("*", F.round(fisher_exact("a", "b", "c", "d"), 6).alias("p_value"), S.strand_balance("a", "b").alias("balance"))


@_query(
    """WITH m AS (SELECT l_suppkey, avg(l_quantity) AS mean_depth, 100.0 * count(*) FILTER (l_discount > 0) / count(*) AS breadth, 100.0 * avg(l_tax) AS uncertain_percent, abs(avg(l_discount) * 100 - 5) AS gc_deviation FROM lineitem GROUP BY 1),
    f AS (SELECT *, list_filter([CASE WHEN gc_deviation > 8 THEN 'S' WHEN gc_deviation > 3 THEN 'M' END, CASE WHEN mean_depth < 5 THEN 'S' WHEN mean_depth < 20 THEN 'M' END, CASE WHEN breadth < 90 THEN 'S' WHEN breadth < 99 THEN 'M' END, CASE WHEN uncertain_percent > 1 THEN 'M' END], lambda x: x IS NOT NULL) AS e FROM m),
    t AS (SELECT l_suppkey, CAST(len(e) AS INTEGER) AS flags, CASE WHEN len(e) = 0 THEN 'HIGH' WHEN list_contains(e, 'S') THEN 'SUSPECT' WHEN len(e) <= 1 THEN 'MEDIUM' WHEN len(e) <= 2 THEN 'LOW' ELSE 'SUSPECT' END AS tier FROM f)
    SELECT *, CASE tier WHEN 'HIGH' THEN 'PASS' WHEN 'SUSPECT' THEN 'HOLD' ELSE 'REVIEW' END AS disposition FROM t"""
)
def confidence_tiers(spark: SparkSession, d: str) -> DataFrame:
    li = _t(spark, d, "lineitem")
    m = li.groupBy("l_suppkey").agg(F.avg("l_quantity").alias("mean_depth"), (F.lit(100.0) * F.count_if(F.col("l_discount") > 0) / F.count(F.lit(1))).alias("breadth"), (F.lit(100.0) * F.avg("l_tax")).alias("uncertain_percent"), F.abs(F.avg("l_discount") * 100 - 5).alias("gc_deviation"))
    f = m.withColumn("f", decisions.graded_flags(m.columns)).withColumn("tier", decisions.tier(F.col("f"), F.lit(1.0)))
    return f.select("l_suppkey", F.size("f").alias("flags"), "tier", S.disposition(F.lit("SUCCESS"), F.col("tier")).alias("disposition"))


@_query(
    """SELECT d.source, count(*) AS documents, count(l.quality) AS labelled, count(*) FILTER (l.quality IS NULL) AS missing, count(*) FILTER (l.quality = 1 AND l.toxic = 0) AS clean, coalesce(bool_and(l.quality = 1) FILTER (l.quality IS NOT NULL), false) AS all_good, coalesce(bool_or(l.toxic = 1), false) AS any_toxic
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY d.source"""
)
def truth_evaluation(spark: SparkSession, d: str) -> DataFrame:
    """Rows joined to truth where there is one; cells and criteria per source."""
    j = _t(spark, d, "documents").select("doc_id", "source").join(_t(spark, d, "labels"), "doc_id", "left")
    return j.groupBy("source").agg(
        F.count(F.lit(1)).alias("documents"), F.count("quality").alias("labelled"), F.count_if(F.col("quality").isNull()).alias("missing"), F.count_if((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("clean"),
        F.coalesce(F.bool_and(F.col("quality") == 1), F.lit(False)).alias("all_good"), F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("any_toxic"),
    )


@_query(
    """WITH t AS (SELECT r_name, reverse(translate(r_name, 'ACGTRYMKBDHVNacgtrymkbdhvn', 'TGCAYRKMVHDBNtgcayrkmvhdbn')) AS x FROM region), n AS (SELECT n_name, n_regionkey, reverse(translate(n_name, 'ACGTRYMKBDHVNacgtrymkbdhvn', 'TGCAYRKMVHDBNtgcayrkmvhdbn')) AS rc FROM nation)
    SELECT n_name, max(greatest(100.0 * (1 - levenshtein(n_name, r_name) / greatest(length(n_name), length(r_name), 1)), 100.0 * (1 - levenshtein(rc, r_name) / greatest(length(rc), length(r_name), 1)))) AS identity FROM n, t GROUP BY n_name"""
)
def sequence_concordance(spark: SparkSession, d: str) -> DataFrame:
    """Each name against all truths, in both orientations; the truths are one array of a fixed small table."""
    truths = _t(spark, d, "region").agg(F.collect_list("r_name").alias("truths"))
    return _t(spark, d, "nation").select("n_name").crossJoin(F.broadcast(truths)).select("n_name", S.best_identity("n_name", "truths").alias("identity"))


@_query("SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept, round(regr_r2(l_extendedprice, l_quantity), 6) AS r2, regr_count(l_extendedprice, l_quantity) AS n FROM lineitem GROUP BY 1")
def line_fit(spark: SparkSession, d: str) -> DataFrame:
    fit = stats.fit_line(_t(spark, d, "lineitem").select("l_returnflag", "l_extendedprice", "l_quantity"), ["l_returnflag"], "l_extendedprice", "l_quantity")
    return fit.select("l_returnflag", F.round("slope", 4).alias("slope"), F.round("intercept", 3).alias("intercept"), F.round("r2", 6).alias("r2"), "n")


@_query(
    """WITH b AS (SELECT l_orderkey AS k, CASE WHEN min(l_linestatus) = max(l_linestatus) THEN min(l_linestatus) ELSE 'P' END AS s FROM lineitem GROUP BY 1)
    SELECT coalesce(o_orderkey, k) AS k, CASE WHEN o_orderkey IS NULL THEN 'ADDED' WHEN k IS NULL THEN 'REMOVED' WHEN o_orderstatus <> s THEN 'CHANGED' ELSE 'SAME' END AS relation FROM orders FULL JOIN b ON o_orderkey = k"""
)
def snapshot_comparison(spark: SparkSession, d: str) -> DataFrame:
    """Status of each order as stored against the one its lines give."""
    a = _t(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("old"))
    b = _t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.when(F.min("l_linestatus") == F.max("l_linestatus"), F.min("l_linestatus")).otherwise("P").alias("new"))
    j = a.join(b, "k", "full")
    return j.select("k", S.first_match("SAME", (F.col("old").isNull(), "ADDED"), (F.col("new").isNull(), "REMOVED"), (F.col("old") != F.col("new"), "CHANGED")).alias("relation"))


@_query(
    """WITH s AS (SELECT o_orderpriority, o_totalprice, sum(o_totalprice) OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC ROWS UNBOUNDED PRECEDING) AS run, sum(o_totalprice) OVER (PARTITION BY o_orderpriority) AS total FROM orders)
    SELECT o_orderpriority, count(*) AS sequences, round(any_value(total), 2) AS total, max(o_totalprice) AS longest, max(o_totalprice) FILTER (run * 2 >= total) AS n50 FROM s GROUP BY 1"""
)
def n50(spark: SparkSession, d: str) -> DataFrame:
    out = ranking.n50(_t(spark, d, "orders").select("o_orderpriority", "o_totalprice"), ["o_orderpriority"], "o_totalprice", keeper(spark))
    return out.withColumn("total", F.round("total", 2))


@_query("SELECT event_type, CAST(floor((event_id - 1) / 500) AS BIGINT) AS block, median(value) AS block_median, count(*) AS block_size FROM events GROUP BY 1, 2")
def block_medians(spark: SparkSession, d: str) -> DataFrame:
    return stats.block_medians(_t(spark, d, "events").select("event_type", "event_id", "value"), ["event_type"], "event_id", "value", 500)


@_query("SELECT s_suppkey, i + 1 AS tile, i * (n // 4) + 1 AS start, CASE WHEN i = 3 THEN n ELSE (i + 1) * (n // 4) END AS stop FROM (SELECT s_suppkey, CAST(s_suppkey * 37 + 11 AS BIGINT) AS n, unnest(range(0, 4)) AS i FROM supplier)")
def tiling(spark: SparkSession, d: str) -> DataFrame:
    s = _t(spark, d, "supplier").select("s_suppkey", F.posexplode(S.tiles(F.col("s_suppkey") * 37 + 11, 4)))
    return s.select("s_suppkey", (F.col("pos") + 1).cast("long").alias("tile"), "col.start", F.col("col.end").alias("stop"))


_TAIL = "list_sum(list_transform(range({a}, {b}), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(mid) + (n - i) * ln(1 - mid))))"
#: Bounds of k of n by halving, until the tail beyond k has a probability of 0.025.
_BOUNDS = f"""start AS (SELECT g, k, n, side, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi, 0 AS step FROM counts, (VALUES ('low'), ('high')) AS s(side) WHERE CASE side WHEN 'low' THEN k > 0 ELSE k < n END),
    halved AS (SELECT * FROM start UNION ALL SELECT g, k, n, side, CASE WHEN up THEN mid ELSE lo END, CASE WHEN up THEN hi ELSE mid END, step + 1 FROM (SELECT *, CASE side WHEN 'low' THEN {_TAIL.format(a="k", b="n + 1")} < 0.025 ELSE {_TAIL.format(a="0", b="k + 1")} > 0.025 END AS up FROM (SELECT *, (lo + hi) / 2 AS mid FROM halved WHERE step < 32))),
    bounds AS (SELECT g, max(lo) FILTER (side = 'low') AS low, max(lo) FILTER (side = 'high') AS high FROM halved WHERE step = 32 GROUP BY g)
    SELECT counts.g AS {{name}}, k, n, k / n AS share, round(coalesce(low, 0.0), 6) AS low, round(coalesce(high, 1.0), 6) AS high FROM counts LEFT JOIN bounds ON counts.g IS NOT DISTINCT FROM bounds.g"""


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in ("low", "high")})


@_query("WITH RECURSIVE counts AS (SELECT 'a' || CAST(l_suppkey AS VARCHAR) AS g, count(*) FILTER (l_discount > 0.05) AS k, count(*) AS n FROM lineitem GROUP BY 1 UNION ALL SELECT NULL, count(*) FILTER (l_discount > 0.05), count(*) FROM lineitem), " + _BOUNDS.format(name="class"))
def grouped_acceptance(spark: SparkSession, d: str) -> DataFrame:
    """Shares of lines with a discount per supplier and over all, with exact bounds."""
    li = _t(spark, d, "lineitem").select(F.concat(F.lit("a"), F.col("l_suppkey").cast("string")).alias("class"), (F.col("l_discount") > 0.05).alias("ok"))
    return _rounded(stats.proportions(li, "class", "ok"))


@_query("WITH RECURSIVE j AS (SELECT source, quality = 1 AS ok FROM documents JOIN labels USING (doc_id)), counts AS (SELECT source AS g, count(*) FILTER (ok) AS k, count(*) AS n FROM j GROUP BY 1 UNION ALL SELECT NULL, count(*) FILTER (ok), count(*) FROM j), " + _BOUNDS.format(name="source"))
def acceptance_bounds(spark: SparkSession, d: str) -> DataFrame:
    """Proportions of labelled documents per source with exact bounds."""
    j = _t(spark, d, "documents").select("doc_id", "source").join(_t(spark, d, "labels"), "doc_id")
    return _rounded(stats.proportions(j.select("source", (F.col("quality") == 1).alias("ok")), "source", "ok"))


@_query(
    f"""WITH RECURSIVE {_SPANS}, o AS (SELECT k, s, e, row_number() OVER (PARTITION BY k ORDER BY e DESC, s) AS n FROM spans),
    w AS (SELECT k, s, e, n, [{{'s': s, 'e': e}}] AS kept, true AS taken FROM o WHERE n = 1
    UNION ALL SELECT k, s, e, n, CASE WHEN free THEN list_append(kept, {{'s': s, 'e': e}}) ELSE kept END, free FROM (SELECT o.*, w.kept, len(list_filter(w.kept, lambda x: x.s <= o.e AND o.s <= x.e)) = 0 AS free FROM w JOIN o ON o.k = w.k AND o.n = w.n + 1))
    SELECT k, s, e FROM w WHERE taken"""
)
def greedy_suppression(spark: SparkSession, d: str) -> DataFrame:
    """Spans of each customer, latest end first, that overlap none taken before."""
    return ranking.suppress_overlaps(spans(spark, d), ["k"], "s", "e", ["e"])


@_query(
    f"""WITH e AS (SELECT floor(user_id / 50) AS g, event_type = 'click' AS click, value, CAST(floor((row_number() OVER (PARTITION BY floor(user_id / 50), event_type = 'click' ORDER BY event_id) - 1) / 500) AS BIGINT) AS b FROM events),
    n AS (SELECT g, click, max(b) + 1 AS n FROM e GROUP BY 1, 2), s AS (SELECT g, click, n, unnest(range(0, n)) AS s FROM n), ds AS (SELECT unnest(range(0, 1000)) AS d),
    w AS (SELECT g, click, d, {resampling.drawn_sql("(CASE WHEN click THEN 20260817 ELSE 20260818 END)", "d", "s")} % n AS b, count(*) AS k FROM s, ds GROUP BY 1, 2, 3, 4),
    u AS (SELECT w.g, w.click, w.d, e.value, sum(w.k) OVER (PARTITION BY w.g, w.click, w.d ORDER BY e.value, w.b ROWS UNBOUNDED PRECEDING) AS u, sum(w.k) OVER (PARTITION BY w.g, w.click, w.d) AS t FROM w JOIN e ON w.g = e.g AND w.click = e.click AND w.b = e.b),
    m AS (SELECT g, click, d, (min(value) FILTER (u > floor((t - 1) / 2)) + min(value) FILTER (u > floor(t / 2))) / 2 AS m FROM u GROUP BY 1, 2, 3),
    r AS (SELECT a.g, a.m / z.m AS r FROM m a JOIN m z ON a.g = z.g AND a.d = z.d WHERE a.click AND NOT z.click AND z.m > 0),
    o AS (SELECT g, r, row_number() OVER (PARTITION BY g ORDER BY r) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM r)
    SELECT CAST(g AS BIGINT) AS g, round(max(r) FILTER (i = greatest(CAST(floor(n * 0.05 / 2) AS BIGINT) - 1, 0)), 9) AS ci_low, round(max(r) FILTER (i = least(CAST(floor(n * 0.975) AS BIGINT), n - 1)), 9) AS ci_high FROM o GROUP BY g"""
)
def bootstrap_interval(spark: SparkSession, d: str) -> DataFrame:
    """Clicks' values over the others' per group of users; of the others only the blocks that are drawn are collected."""
    e = _t(spark, d, "events").select(F.floor(F.col("user_id") / 50).alias("g"), "event_id", "value", (F.col("event_type") == "click").alias("click"))
    listed = lambda df, name: df.groupBy("g").agg(F.sort_array(F.collect_list(F.struct("event_id", "value"))).alias(name)).select("g", F.col(f"{name}.value").alias(name))
    backbone = listed(stats.thin_blocks(e.filter("not click"), ["g"], ["event_id"], keep=keeper(spark)), "backbone")
    out = resampling.block_interval(backbone.join(listed(e.filter("click"), "locus"), "g", "left"), ["g"], "locus", "backbone")
    return out.select("g", F.round("ci_low", 9).alias("ci_low"), F.round("ci_high", 9).alias("ci_high"))


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "documents").select("doc_id", "source", "lang", "n_chars").join(_t(spark, d, "labels"), "doc_id", "left")


@_query(
    """WITH j AS (SELECT d.source, l.quality = 1 AS t, d.n_chars > 500 AS a, CASE WHEN d.lang <> 'xx' THEN d.n_chars BETWEEN 200 AND 20000 END AS b FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
    e AS (SELECT source, t, 'long' AS rule, a AS c FROM j UNION ALL SELECT source, t, 'moderate', b FROM j),
    n AS (SELECT source, rule, count(*) FILTER (t AND c) AS true_positive, count(*) FILTER (NOT t AND c) AS false_positive, count(*) FILTER (t AND NOT c) AS false_negative, count(*) FILTER (NOT t AND NOT c) AS true_negative,
    count(*) FILTER (t IS NOT NULL AND c IS NULL) AS undecided, count(*) FILTER (t IS NULL) AS unknown FROM e GROUP BY 1, 2)
    SELECT *, CASE WHEN true_positive + false_positive > 0 THEN true_positive / (true_positive + false_positive) END AS precision, CASE WHEN true_positive + false_negative > 0 THEN true_positive / (true_positive + false_negative) END AS recall FROM n"""
)
def confusion_cells(spark: SparkSession, d: str) -> DataFrame:
    """Two length rules against the quality label per source; rows without a label are unknown."""
    n = F.col("n_chars")
    return evaluation.confusion(_labelled(spark, d), ["source"], F.col("quality") == 1, {"long": n > 500, "moderate": F.when(F.col("lang") != "xx", n.between(200, 20_000))})


@_query(
    """WITH s AS (SELECT unnest(list_filter([CASE WHEN true THEN 'all' END, CASE WHEN l.toxic = 0 THEN 'clean' END, CASE WHEN l.quality = 1 THEN 'good' END], lambda x: x IS NOT NULL)) AS unit_set, d.n_chars FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
    SELECT unit_set, count(*) AS units, CAST(sum(n_chars) AS BIGINT) AS chars FROM s GROUP BY 1"""
)
def overlapping_sets(spark: SparkSession, d: str) -> DataFrame:
    sets = evaluation.with_sets(_labelled(spark, d), {"all": F.lit(True), "clean": F.col("toxic") == 0, "good": F.col("quality") == 1})
    return sets.groupBy("unit_set").agg(F.count(F.lit(1)).alias("units"), F.sum("n_chars").alias("chars"))


@_query(
    """SELECT l_returnflag, CASE WHEN l_quantity < 10 THEN 'below 10' WHEN l_quantity < 30 THEN '10 to 29' ELSE '30 or more' END AS bin, count(*) AS units, count(DISTINCT l_suppkey) AS clusters, median(l_discount - 0.05) AS median_error, median(abs(l_discount - 0.05)) AS median_absolute_error, max(abs(l_discount - 0.05)) AS largest_absolute_error
    FROM lineitem GROUP BY 1, 2"""
)
def error_by_factor(spark: SparkSession, d: str) -> DataFrame:
    li = _t(spark, d, "lineitem").select("l_returnflag", "l_quantity", "l_suppkey", (F.col("l_discount") - 0.05).alias("error"))
    return evaluation.error_bins(li, ["l_returnflag"], "l_quantity", [(0, 10, "below 10"), (10, 30, "10 to 29"), (30, 1e9, "30 or more")], "error", "l_suppkey")


@_query("SELECT o_orderpriority, string_agg(s || '=' || n, '; ' ORDER BY s) AS histogram FROM (SELECT o_orderpriority, coalesce(o_orderstatus, 'none') AS s, count(*) AS n FROM orders GROUP BY 1, 2) GROUP BY 1")
def status_histogram(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.histogram_text(_t(spark, d, "orders").select("o_orderpriority", "o_orderstatus"), ["o_orderpriority"], "o_orderstatus")


@_query("SELECT event_type, printf('%.3f (%.3f-%.3f)', median(value), min(value), max(value)) AS value_range FROM events GROUP BY 1")
def range_text(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "events").groupBy("event_type").agg(evaluation.median_range("value").alias("value_range"))


@_query(
    """WITH c AS (SELECT l_returnflag, l_quantity, bool_and(l_extendedprice > 20000) AS every, bool_or(l_extendedprice > 20000) AS anyone FROM lineitem GROUP BY 1, 2), b AS (SELECT l_returnflag, max(l_quantity) FILTER (NOT every) AS broken FROM c GROUP BY 1)
    SELECT l_returnflag, min(l_quantity) FILTER (anyone) AS lowest_any, min(l_quantity) FILTER (broken IS NULL OR l_quantity > broken) AS lowest_all FROM c JOIN b USING (l_returnflag) GROUP BY 1"""
)
def detection_limit(spark: SparkSession, d: str) -> DataFrame:
    """Smallest quantity with any line over a price, and from which on all are."""
    return evaluation.detection_limit(_t(spark, d, "lineitem").select("l_returnflag", "l_quantity", "l_extendedprice"), ["l_returnflag"], "l_quantity", F.col("l_extendedprice") > 20_000)


@_query("SELECT l_returnflag AS before, l_linestatus AS after, count(*) AS rows FROM lineitem GROUP BY 1, 2")
def label_transitions(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.transitions(_t(spark, d, "lineitem").select("l_returnflag", "l_linestatus"), [], "l_returnflag", "l_linestatus")


@_query(
    """WITH f AS (SELECT l_returnflag, regr_count(l_extendedprice, l_quantity) AS n, regr_slope(l_extendedprice, l_quantity) AS slope, regr_intercept(l_extendedprice, l_quantity) AS intercept, regr_sxx(l_extendedprice, l_quantity) AS sxx, regr_syy(l_extendedprice, l_quantity) AS syy, regr_avgx(l_extendedprice, l_quantity) AS mx FROM lineitem GROUP BY 1),
    p AS (SELECT *, intercept + slope * 60 AS prediction, sqrt((syy - slope * slope * sxx) / (n - 2)) AS sd FROM f)
    SELECT l_returnflag, n, round(slope, 4) AS slope, round(prediction, 3) AS prediction, round((99000 - prediction) / (sd * sqrt(1 + 1 / n + (60 - mx) * (60 - mx) / sxx)), 5) AS z FROM p"""
)
def null_fit(spark: SparkSession, d: str) -> DataFrame:
    """How far a new point lies from the line of each flag's rows."""
    fit = evaluation.fit_null(_t(spark, d, "lineitem").select("l_returnflag", "l_quantity", "l_extendedprice"), ["l_returnflag"], "l_quantity", "l_extendedprice", 60.0, 99_000.0)
    return fit.select("l_returnflag", "n", F.round("slope", 4).alias("slope"), F.round("prediction", 3).alias("prediction"), F.round("z", 5).alias("z"))


@_query(
    """SELECT event_type, count(value) AS n, median(value) AS median, quantile_cont(value, 0.025) AS p2_5, quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.75) AS p75, quantile_cont(value, 0.975) AS p97_5, min(value) AS least, max(value) AS most,
    least(1.0, 2.0 * least(count(*) FILTER (value <= 10), count(*) FILTER (value >= 10)) / count(value)) AS p_value FROM events GROUP BY 1"""
)
def estimate_spread(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.spread(_t(spark, d, "events").select("event_type", "value"), ["event_type"], "value", 10.0)


@_query(
    """WITH c AS (SELECT l_orderkey, l_returnflag, count(*) AS n, max(l_extendedprice) AS i FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY 1, 2)
    SELECT l_orderkey, count(*) AS genomes, avg(i) AS mean_identity, min(i) AS min_identity, max(i) AS max_identity FROM c GROUP BY 1 HAVING bool_and(n = 1) AND count(*) = 2"""
)
def single_copy_units(spark: SparkSession, d: str) -> DataFrame:
    """Orders with exactly one line that was accepted and one that was returned."""
    li = _t(spark, d, "lineitem").filter(F.col("l_returnflag").isin("A", "R")).select("l_orderkey", "l_returnflag", "l_extendedprice")
    return evaluation.single_copy(li, "l_orderkey", "l_returnflag", "l_extendedprice")


@_query(
    """WITH s AS (SELECT o_orderstatus, count(*) AS orders, sum(CASE WHEN o_totalprice > 100000 THEN 1 ELSE 0 END) AS large, sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS urgent FROM orders GROUP BY 1)
    SELECT o_orderstatus, metric, CAST(numerator AS DOUBLE) AS numerator, CAST(orders AS DOUBLE) AS denominator, round(numerator / orders, 4) AS value FROM (SELECT o_orderstatus, orders, 'large' AS metric, large AS numerator FROM s UNION ALL SELECT o_orderstatus, orders, 'urgent', urgent FROM s)"""
)
def long_summary(spark: SparkSession, d: str) -> DataFrame:
    s = _t(spark, d, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"), F.count_if(F.col("o_totalprice") > 100_000).alias("large"), F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent"))
    return evaluation.long_summary(s, ["o_orderstatus"], ["large", "urgent"], "orders")


@_query("SELECT n_nationkey, '| ' || n_nationkey || ' | ' || replace(n_name, '|', '\\|') || ' | ' || n_regionkey || ' |' AS line FROM nation")
def markdown_table(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.markdown_rows(_t(spark, d, "nation"), ["n_nationkey", "n_name", "n_regionkey"]).select("n_nationkey", "line")


@_query(
    """WITH o AS (SELECT sha256(least(text, reverse(translate(text, 'ACGTRYMKBDHVNacgtrymkbdhvn', 'TGCAYRKMVHDBNtgcayrkmvhdbn')))) AS signature, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY 1),
    w AS (SELECT sha256(least(text, reverse(translate(text, 'ACGTRYMKBDHVNacgtrymkbdhvn', 'TGCAYRKMVHDBNtgcayrkmvhdbn')))) AS signature, count(*) AS n FROM benchmark WHERE text IS NOT NULL GROUP BY 1)
    SELECT coalesce(o.signature, w.signature) AS signature, coalesce(o.n, 0) AS old, coalesce(w.n, 0) AS new FROM o FULL JOIN w ON o.signature = w.signature WHERE coalesce(o.n, 0) <> coalesce(w.n, 0)"""
)
def canonical_difference(spark: SparkSession, d: str) -> DataFrame:
    """Texts by their canonical strand, as often as each table has them."""
    return evaluation.canonical_difference(_t(spark, d, "documents").select("text"), _t(spark, d, "benchmark").select("text"), "text")


@_query("SELECT l_orderkey, l_linenumber, n FROM (SELECT l_orderkey, l_linenumber, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem) WHERE least(l_linenumber - 1, n - l_linenumber) > 1")
def interior_rows(spark: SparkSession, d: str) -> DataFrame:
    """Lines more than one place from both ends of their order."""
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    counts = li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    return evaluation.interior(li.join(counts, "l_orderkey"), "l_linenumber", "n", 1)


@_query(
    f"""WITH {_SPANS}, ev AS (SELECT k, s AS p, 1 AS x FROM spans UNION ALL SELECT k, e + 1, -1 FROM spans), st AS (SELECT k, p, sum(x) AS x FROM ev GROUP BY 1, 2),
    seg AS (SELECT k, p, lead(p) OVER (PARTITION BY k ORDER BY p) AS nx, sum(x) OVER (PARTITION BY k ORDER BY p ROWS UNBOUNDED PRECEDING) AS m FROM st), days AS (SELECT k, m, unnest(range(CAST(p AS BIGINT), CAST(nx AS BIGINT))) AS day FROM seg WHERE nx IS NOT NULL AND m > 0)
    SELECT k, CAST(floor(day / 365) AS BIGINT) AS tile, count(*) AS covered, count(*) FILTER (m >= 2) AS rich, count(*) FILTER (m >= 2) / count(*) AS share FROM days GROUP BY 1, 2"""
)
def repeat_rich_windows(spark: SparkSession, d: str) -> DataFrame:
    """Per window of 365 days: covered days and those covered more than once."""
    return intervals.rich_windows(spans(spark, d), ["k"], "s", "e", 365)


@_query("SELECT o_orderkey FROM orders WHERE CAST('0x' || substring(md5('17:' || o_orderkey), 1, 8) AS BIGINT) / 4294967296 < 0.25")
def paired_subsample(spark: SparkSession, d: str) -> DataFrame:
    """A quarter of the orders by the hash of their key, as mates are sampled by their name."""
    return simulate.subsample(_t(spark, d, "orders").select("o_orderkey"), "o_orderkey", 0.25, 17)


@_query("SELECT depth, gc, replicate, depth || '_' || gc || '_' || replicate AS run_id FROM (SELECT unnest([5, 20, 60]) AS depth) CROSS JOIN (SELECT unnest(['low', 'high']) AS gc) CROSS JOIN (SELECT CAST(unnest(range(1, 4)) AS INTEGER) AS replicate)")
def run_manifest(spark: SparkSession, d: str) -> DataFrame:
    return simulate.manifest(spark, {"depth": [5, 20, 60], "gc": ["low", "high"]}, 3).drop("seed")


@_query(
    """WITH b AS (SELECT item_id, unnest(list_transform(range(1, greatest(length(text) - 24, 0) + 1), lambda i: substring(text, i, 25))) AS g FROM benchmark),
    q AS (SELECT DISTINCT unnest(list_transform(range(1, greatest(length(text) - 24, 0) + 1), lambda i: substring(text, i, 25))) AS g FROM documents)
    SELECT item_id FROM benchmark WHERE item_id NOT IN (SELECT item_id FROM b SEMI JOIN q USING (g))"""
)
def unrelated_records(spark: SparkSession, d: str) -> DataFrame:
    """Benchmark items that share no 25-mer with any document."""
    b = _t(spark, d, "benchmark")
    wanted = b.select("item_id", F.explode(S.kmers("text", 25)).alias("g"))
    met = kmers.known_kmers(_t(spark, d, "documents"), "doc_id", "text", wanted.select("g").distinct(), 25).select("g").distinct()
    return b.select("item_id").join(wanted.join(met, "g", "left_semi").select("item_id").distinct(), "item_id", "left_anti")


@_query(
    f"""WITH c AS (SELECT d.source, d.lang, CAST(sum(CASE WHEN l.quality = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS a, CAST(count(*) AS DOUBLE) AS b FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NOT NULL GROUP BY 1, 2),
    k AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY lang NULLS FIRST) - 1 AS i FROM c), n AS (SELECT source, count(*) AS n, sum(a) / sum(b) AS value FROM k GROUP BY 1),
    s AS (SELECT source, n, unnest(range(0, n)) AS s FROM n), ds AS (SELECT unnest(range(0, 10000)) AS d),
    w AS (SELECT source, d, {resampling.drawn_sql("20261118", "d", "s")} % n AS i FROM s, ds),
    r AS (SELECT w.source, w.d, sum(k.a) / sum(k.b) AS r FROM w JOIN k ON w.source IS NOT DISTINCT FROM k.source AND w.i = k.i GROUP BY 1, 2),
    o AS (SELECT source, r, row_number() OVER (PARTITION BY source ORDER BY r) - 1 AS i, count(*) OVER (PARTITION BY source) AS m FROM r)
    SELECT n.source, n.n AS clusters, n.value, max(r) FILTER (i = CAST(floor(m * 0.025) AS BIGINT)) AS low, max(r) FILTER (i = least(CAST(floor(m * 0.975) AS BIGINT), m - 1)) AS high FROM n JOIN o ON n.source IS NOT DISTINCT FROM o.source GROUP BY 1, 2, 3"""
)
def cluster_bootstrap(spark: SparkSession, d: str) -> DataFrame:
    """Share of good documents per source with an interval over languages."""
    labelled = _labelled(spark, d).filter("quality is not null").select("source", "lang", (F.col("quality") == 1).cast("int").alias("good"), F.lit(1).alias("one"))
    return resampling.cluster_interval(labelled, ["source"], "lang", "good", "one")


@_query()
def simulated_reads(spark: SparkSession, d: str) -> DataFrame:
    """Read pairs with errors from every document of 300 characters or more."""
    return simulate.read_pairs(_t(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id"), "text"), "id", "text", F.lit(1.0), 7, error=0.002)
