"""Results against truth: confusion cells, error bins, intervals over clusters, limits, transitions and text tables.

Every function groups by key columns and is a plan of expressions, but for
``cluster_interval``, which resamples one small row a key in Arrow batches.
"""

from __future__ import annotations

import random
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandloom.functions.sequence import IUPAC, IUPAC_COMPLEMENT, reverse_complement
from strandloom.functions.statistics import t_quantile
from strandloom.operators.alignment import local_hits

# Relations of a found sequence to the truth, best first.
RELATIONS = (
    "identical",
    "uncalled bases, otherwise identical",
    "incomplete, identical over its own length",
    "truth contained, extra bases",
    "identical over the overlap, different boundaries",
    "differs",
)
NO_ALIGNMENT, ABSENT = "no alignment to the truth", "sequence returned although the locus is absent"


_COMPLEMENT = str.maketrans(IUPAC, IUPAC_COMPLEMENT)


def with_sets(df: DataFrame, sets: Mapping[str, Column], name: str = "unit_set") -> DataFrame:
    """One row for each set that a row is in; sets may overlap, and a row in none goes."""
    inside = F.array_compact(F.array(*[F.when(cond, F.lit(label)) for label, cond in sets.items()]))
    return df.withColumn(name, F.explode(inside))


def confusion(df: DataFrame, by: list[str], truth: Column, rules: Mapping[str, Column]) -> DataFrame:
    """Cells of each rule against the truth per key, with precision and recall.

    A rule that is null leaves its row undecided; a row without truth counts in
    ``unknown`` alone.  All rules are read in one pass and one shuffle.
    """
    called = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), c.alias("called")) for n, c in rules.items()]))
    each = df.select(*by, truth.alias("__truth"), called.alias("__r")).select(*by, "__truth", "__r.rule", "__r.called")
    t, c = F.col("__truth"), F.col("called")
    cells = each.groupBy(*by, "rule").agg(
        F.count_if(t & c).alias("true_positive"), F.count_if(~t & c).alias("false_positive"), F.count_if(t & ~c).alias("false_negative"), F.count_if(~t & ~c).alias("true_negative"),
        F.count_if(t.isNotNull() & c.isNull()).alias("undecided"), F.count_if(t.isNull()).alias("unknown"),
    )
    share = lambda other: F.when(F.col("true_positive") + F.col(other) > 0, F.col("true_positive") / (F.col("true_positive") + F.col(other)))
    return cells.withColumn("precision", share("false_positive")).withColumn("recall", share("false_negative"))


def error_bins(df: DataFrame, by: list[str], factor: str, bins: Sequence[tuple[float, float, str]], error: str, cluster: str) -> DataFrame:
    """Units, clusters and error medians per half-open bin of a factor; rows without an error or outside all bins go."""
    label = F.lit(None).cast("string")
    for low, high, text in reversed(bins):
        label = F.when((F.col(factor) >= low) & (F.col(factor) < high), F.lit(text)).otherwise(label)
    rows = df.select(*by, label.alias("bin"), F.col(error).alias("__e"), F.col(cluster).alias("__c")).filter("bin is not null and __e is not null")
    size = F.abs("__e")
    return rows.groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("units"), F.countDistinct("__c").alias("clusters"), F.median("__e").alias("median_error"), F.median(size).alias("median_absolute_error"), F.max(size).alias("largest_absolute_error"))


def cluster_interval(df: DataFrame, by: list[str], cluster: str, numerator: str, denominator: str, resamples: int = 10_000, seed: int = 20261118) -> DataFrame:
    """95 % percentile interval of sum(numerator) / sum(denominator), clusters drawn with replacement.

    Rows shrink to two sums a cluster before they are collected, so a key's
    array is as long as its number of clusters.  Clusters are taken in order;
    the bounds are the order statistics int(0.025 n) and int(0.975 n).  They
    are null where no draw has a denominator.
    """
    sums = df.groupBy(*by, cluster).agg(F.sum(numerator).cast("double").alias("__a"), F.sum(denominator).cast("double").alias("__b"))
    lists = sums.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(F.col(cluster).alias("c"), F.col("__a").alias("a"), F.col("__b").alias("b")))).alias("__l"))
    lists = lists.withColumn("__a", F.col("__l.a")).withColumn("__b", F.col("__l.b")).drop("__l")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            low, high = [], []
            for tops, bottoms in zip(pdf["__a"], pdf["__b"], strict=True):
                draw, n, got = random.Random(seed), len(tops), []
                for _ in range(resamples):
                    picks = [draw.randrange(n) for _ in range(n)]
                    under = sum(bottoms[i] for i in picks)
                    if under:
                        got.append(sum(tops[i] for i in picks) / under)
                got.sort()
                low.append(got[int(0.025 * len(got))] if got else None)
                high.append(got[min(len(got) - 1, int(0.975 * len(got)))] if got else None)
            total = [(sum(a), sum(b)) for a, b in zip(pdf["__a"], pdf["__b"], strict=True)]
            values = [a / b if b else None for a, b in total]
            yield pdf[by].assign(clusters=pdf["__a"].map(len).astype("int64"), value=pd.Series(values, index=pdf.index, dtype=float), low=pd.Series(low, index=pdf.index, dtype=float), high=pd.Series(high, index=pdf.index, dtype=float))

    fields = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in by)
    return lists.mapInPandas(run, f"{fields}clusters long, value double, low double, high double")


def histogram_text(df: DataFrame, by: list[str], value: str, name: str = "histogram") -> DataFrame:
    """``value=count; value=count`` in order of the values, null as ``none``: counted first, so that only distinct values are listed."""
    counts = df.groupBy(*by, F.coalesce(F.col(value).cast("string"), F.lit("none")).alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    parts = F.sort_array(F.collect_list(F.struct("__v", "__n")))
    return counts.groupBy(*by).agg(F.array_join(F.transform(parts, lambda x: F.concat(x["__v"], F.lit("="), x["__n"].cast("string"))), "; ").alias(name))


def median_range(value: str) -> Column:
    """Aggregate ``median (min-max)`` with three decimals; empty without values."""
    text = F.format_string("%.3f (%.3f-%.3f)", F.median(value).cast("double"), F.min(value).cast("double"), F.max(value).cast("double"))
    return F.when(F.count(value) > 0, text).otherwise("")


def detection_limit(df: DataFrame, by: list[str], level: str, held: Column) -> DataFrame:
    """Lowest level with any row held, and lowest from which up all rows are held; null where there is none."""
    cells = df.groupBy(*by, level).agg(F.bool_and(held).alias("__all"), F.bool_or(held).alias("__any"))
    cells = cells.withColumn("__broken", F.max(F.when(~F.col("__all"), F.col(level))).over(Window.partitionBy(*by)))
    above = F.col("__broken").isNull() | (F.col(level) > F.col("__broken"))
    return cells.groupBy(*by).agg(F.min(F.when(F.col("__any"), F.col(level))).alias("lowest_any"), F.min(F.when(above, F.col(level))).alias("lowest_all"))


def transitions(df: DataFrame, by: list[str], before: str, after: str) -> DataFrame:
    """How many rows went from one label to another; null is ``none``."""
    return df.groupBy(*by, F.coalesce(before, F.lit("none")).alias("before"), F.coalesce(after, F.lit("none")).alias("after")).agg(F.count(F.lit(1)).alias("rows"))


def fit_null(df: DataFrame, by: list[str], x: str, y: str, at_x: float, at_y: float) -> DataFrame:
    """Line through y on x and what it says of one new point: prediction, its error and z; fewer than three rows give nulls."""
    n, slope, intercept, sxx = F.regr_count(y, x), F.regr_slope(y, x), F.regr_intercept(y, x), F.regr_sxx(y, x)
    sums = df.groupBy(*by).agg(n.alias("n"), slope.alias("slope"), intercept.alias("intercept"), F.regr_r2(y, x).alias("r2"), sxx.alias("__sxx"), F.regr_syy(y, x).alias("__syy"), F.regr_avgx(y, x).alias("__mx"))
    sd = F.when(F.col("n") > 2, F.sqrt(F.greatest(F.col("__syy") - F.col("slope") ** 2 * F.col("__sxx"), F.lit(0.0)) / (F.col("n") - 2)))
    out = sums.withColumn("residual_sd", sd).withColumn("prediction", F.col("intercept") + F.col("slope") * at_x)
    out = out.withColumn("prediction_se", F.col("residual_sd") * F.sqrt(1 + 1 / F.col("n") + (F.lit(at_x) - F.col("__mx")) ** 2 / F.nullif(F.col("__sxx"), F.lit(0.0))))
    return out.withColumn("z", (F.lit(at_y) - F.col("prediction")) / F.nullif(F.col("prediction_se"), F.lit(0.0))).drop("__sxx", "__syy", "__mx")


def prediction_interval(fit: DataFrame, level: float = 0.95) -> DataFrame:
    """``fit_null`` rows with the bounds of the prediction."""
    wide = t_quantile(F.lit(0.5 + level / 2), F.col("n") - 2) * F.col("prediction_se")
    return fit.withColumn("__w", wide).withColumn("low", F.col("prediction") - F.col("__w")).withColumn("high", F.col("prediction") + F.col("__w")).drop("__w")


def spread(df: DataFrame, by: list[str], value: str, observed: float | None = None) -> DataFrame:
    """n, median, outer and inner quantiles and range of estimates; with a two-sided empirical p of an observed value."""
    q = lambda p: F.percentile(value, F.lit(p))
    parts = [F.count(value).alias("n"), F.median(value).alias("median"), q(0.025).alias("p2_5"), q(0.25).alias("p25"), q(0.75).alias("p75"), q(0.975).alias("p97_5"), F.min(value).alias("least"), F.max(value).alias("most")]
    if observed is not None:
        side = F.least(F.count_if(F.col(value) <= observed), F.count_if(F.col(value) >= observed))
        parts.append(F.when(F.count(value) > 0, F.least(F.lit(1.0), F.lit(2.0) * side / F.count(value))).alias("p_value"))
    return df.groupBy(*by).agg(*parts)


def _meets(a: str, t: str, least: int) -> bool:
    """Whether the end of a is the start of t over ``least`` bases or more, but not over all of either."""
    if len(t) < least or len(a) < least:
        return False
    at = a.find(t[:least], max(1, len(a) - len(t) + 1))
    while 0 <= at <= len(a) - least:
        if t.startswith(a[at:]):
            return True
        at = a.find(t[:least], at + 1)
    return False


def _relates(a: str, t: str, least: int) -> int:
    if a == t:
        return 0
    if len(a) == len(t) and all(x == y or x == "N" for x, y in zip(a, t)):
        return 1
    if a and a in t:
        return 2
    if t and t in a:
        return 3
    return 4 if _meets(a, t, least) or _meets(t, a, least) else 5


def relation(found: str, truth: str, least_overlap: int = 20) -> Column:
    """How a found sequence relates to a truth, on the strand that relates best: one of ``RELATIONS``, null if either is null.

    Only relations without a differing base are told apart; the boundary class
    needs an end of one to equal the start of the other over ``least_overlap``.
    """

    @F.pandas_udf("string")
    def related(founds: pd.Series, truths: pd.Series) -> pd.Series:
        out = []
        for a, t in zip(founds, truths, strict=True):
            if a is None or t is None:
                out.append(None)
                continue
            a, t = a.replace("-", "").upper(), t.upper()
            out.append(RELATIONS[min(_relates(a, t, least_overlap), _relates(a.translate(_COMPLEMENT)[::-1], t, least_overlap))])
        return pd.Series(out, dtype=object)

    return related(F.col(found), F.col(truth))


@F.pandas_udf(T.IntegerType())
def _exact(founds: pd.Series, truths: pd.Series) -> pd.Series:
    """The rank of a relation without a differing base and without an overhang on both sides, or null."""
    out = []
    for a, t in zip(founds, truths, strict=True):
        ranks = [_relates(x, t, len(x) + 1) for x in (a, a.translate(_COMPLEMENT)[::-1])]
        out.append(min(ranks) if min(ranks) < 4 else None)
    return pd.Series(out, dtype="Int32")


def comparisons(returned: DataFrame, truths: DataFrame, by: list[str]) -> DataFrame:
    """Each returned sequence (by, seq_id, seq) against the truth copies (by, truth_name, truth) of its key.

    Result: by, seq_id, truth_name, truth_bp, comparison (one of ``RELATIONS``,
    ``NO_ALIGNMENT`` and ``ABSENT``), identity_pct, aligned_bp, mismatches,
    gap_columns, length_difference_bp, edit_distance.  A relation without a
    differing base to any copy goes first, the better one of several and then
    the copy of the least name.  Otherwise the longest local alignment decides,
    by identical bases: the aligned part is identical, or differs.  A key
    without a copy is ABSENT; a null sequence has no row.  The edit distance is
    that of the whole sequences, on the nearer strand, and is null where no copy
    is named.
    """
    key = [*by, "seq_id"]
    called = returned.filter(F.col("seq").isNotNull()).select(*key, F.upper(F.replace(F.col("seq"), F.lit("-"), F.lit(""))).alias("seq"))
    copies = truths.filter(F.col("truth").isNotNull()).select(*by, "truth_name", F.upper("truth").alias("truth"))
    pairs = called.join(copies.hint("merge"), by) if by else called.crossJoin(copies)
    exact = pairs.withColumn("rank", _exact("seq", "truth")).filter("rank is not null").groupBy(*key).agg(F.min(F.struct("rank", "truth_name")).alias("e"))
    hits = local_hits(called, copies.select(*by, F.col("truth_name").alias("seq_id"), F.col("truth").alias("seq")), by, detail=True)
    same = F.col("pident") * F.col("length")
    best = hits.groupBy(*by, F.col("qseqid").alias("seq_id")).agg(F.min(F.struct((-same).alias("less"), F.col("sseqid").alias("truth_name"), "pident", "length", "mismatches", "gap_columns")).alias("a"))
    first = copies.groupBy(*by).agg(F.min("truth_name").alias("__first"))
    j = called.join(exact.hint("merge"), key, "left").join(best.hint("merge"), key, "left")
    j = j.join(first.hint("merge"), by, "left") if by else j.crossJoin(F.broadcast(first))
    j = j.withColumn("truth_name", F.coalesce("e.truth_name", "a.truth_name", "__first"))
    j = j.join(copies.hint("merge"), [*by, "truth_name"], "left").withColumn("n", F.length("truth"))
    names = F.array(*[F.lit(r) for r in RELATIONS])
    is_exact, aligned = F.col("e").isNotNull(), F.col("a").isNotNull()
    clean = (F.col("a.mismatches") == 0) & (F.col("a.gap_columns") == 0)
    comparison = F.when(F.col("__first").isNull(), ABSENT).when(is_exact, F.element_at(names, F.col("e.rank") + 1)).when(~aligned, NO_ALIGNMENT).when(clean, RELATIONS[4]).otherwise(RELATIONS[5])
    pick = lambda whole, part: F.when(is_exact, whole).when(aligned, part)
    return j.select(
        *key, "truth_name", F.col("n").alias("truth_bp"), comparison.alias("comparison"), pick(F.lit(100.0), F.col("a.pident")).alias("identity_pct"), pick(F.least(F.length("seq"), "n"), F.col("a.length")).alias("aligned_bp"),
        pick(F.lit(0), F.col("a.mismatches")).cast("int").alias("mismatches"), pick(F.lit(0), F.col("a.gap_columns")).cast("int").alias("gap_columns"), (F.length("seq") - F.col("n")).alias("length_difference_bp"),
        F.least(F.levenshtein("seq", "truth"), F.levenshtein(reverse_complement("seq"), F.col("truth"))).alias("edit_distance"),
    )


def best_relation(df: DataFrame, by: list[str], related: str, aligned: str) -> DataFrame:
    """The row of each key that relates best, then aligns longest, with the number of rows it was chosen from."""
    index = F.array_position(F.array(*[F.lit(r) for r in RELATIONS]), F.col(related))
    order = Window.partitionBy(*by).orderBy(index, F.col(aligned).desc())
    return df.withColumn("candidates", F.count(F.lit(1)).over(Window.partitionBy(*by))).withColumn("__r", F.row_number().over(order)).filter("__r = 1").drop("__r")


def single_copy(df: DataFrame, unit: str, genome: str, identity: str) -> DataFrame:
    """Units with exactly one row in every genome that there is, with identity statistics; the least alike come first in ``rank``."""
    genomes = df.agg(F.countDistinct(genome).alias("__g"))
    per = df.groupBy(unit, genome).agg(F.count(F.lit(1)).alias("__n"), F.max(identity).alias("__i")).groupBy(unit).agg(F.bool_and(F.col("__n") == 1).alias("__one"), F.count(F.lit(1)).alias("genomes"), F.avg("__i").alias("mean_identity"), F.min("__i").alias("min_identity"), F.max("__i").alias("max_identity"))
    # The right side is one row.
    return per.join(F.broadcast(genomes), F.col("genomes") == F.col("__g")).filter("__one").drop("__one", "__g")


def long_summary(df: DataFrame, by: list[str], metrics: list[str], denominator: str) -> DataFrame:
    """One row per key and metric: numerator, denominator and value to four decimals, null without a denominator."""
    rows = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("numerator")) for m in metrics]))
    out = df.select(*by, F.col(denominator).cast("double").alias("denominator"), rows.alias("__m")).select(*by, "__m.metric", "__m.numerator", "denominator")
    return out.withColumn("value", F.round(F.col("numerator") / F.nullif(F.col("denominator"), F.lit(0.0)), 4))


def markdown_rows(df: DataFrame, columns: list[str], name: str = "line") -> DataFrame:
    """A table line for each row; pipes are escaped and null is empty."""
    cells = [F.coalesce(F.replace(F.col(c).cast("string"), F.lit("|"), F.lit("\\|")), F.lit("")) for c in columns]
    return df.withColumn(name, F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")))


def canonical_difference(old: DataFrame, new: DataFrame, seq: str) -> DataFrame:
    """Sequences of two sets, whatever their names and strands, with how often each has them; equal ones are left out."""

    def counted(df: DataFrame, name: str) -> DataFrame:
        key = F.sha2(F.least(F.col(seq), reverse_complement(seq)), 256).alias("signature")
        return df.filter(F.col(seq).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))

    both = counted(old, "old").join(counted(new, "new"), "signature", "full").na.fill(0, ["old", "new"])
    return both.filter("old <> new")


def interior(df: DataFrame, position: str, length: str | Column, margin: int) -> DataFrame:
    """Rows further than ``margin`` from both ends of 1..length."""
    n = F.col(length) if isinstance(length, str) else length
    return df.filter(F.least(F.col(position) - 1, n - F.col(position)) > margin)
