"""Scores against truth: copies of a locus, outcomes per unit, decisions of tools, mixed sites, completeness, stage tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.functions import sequence as S
from strandloom.operators import ranking
from strandloom.operators.evaluation import RELATIONS, best_relation

# Strata of units by the copies of their truth.
STRATA = ("one copy", "several identical copies", "several different copies", "no copy (negative control)", "no copy under the protocol rule, bait aligned in parts")


def truth_copies(hits: DataFrame, lengths: DataFrame, by: list[str], bait_length: str, min_identity: float = 80.0, min_fraction: float = 0.90) -> DataFrame:
    """Copies of a bait in complete genomes: strong hits stretched to the whole bait, without those that repeat a better one.

    ``hits``: by, replicon, identity, qstart, qend, sstart, send, bitscore and
    ``bait_length``; ``lengths``: by, replicon, replicon_length.  Two hits are
    one copy if they share more than half of the shorter.  Result adds start,
    end, strand, clipped_bp and copy (numbered by replicon and place).
    """
    far = (F.col("identity") >= min_identity) & (F.col("qend") - F.col("qstart") + 1 >= min_fraction * F.col(bait_length))
    forward = F.col("sstart") <= F.col("send")
    before, after = F.col("qstart") - 1, F.col(bait_length) - F.col("qend")
    low, high = F.when(forward, F.col("sstart") - before).otherwise(F.col("send") - after), F.when(forward, F.col("send") + after).otherwise(F.col("sstart") + before)
    at = hits.filter(far).join(lengths.select(*by, "replicon", "replicon_length"), [*by, "replicon"]).withColumns({"__lo": low, "__hi": high, "strand": F.when(forward, "+").otherwise("-")})
    size = F.col("replicon_length")
    wide = at.withColumns({"clipped_bp": F.greatest(1 - F.col("__lo"), F.lit(0)) + F.greatest(F.col("__hi") - size, F.lit(0)), "start": F.greatest("__lo", F.lit(1)), "end": F.least("__hi", size)}).drop("__lo", "__hi")
    kept = ranking.suppress_overlaps(wide, [*by, "replicon"], "start", "end", ["bitscore"], 0.5)
    return ranking.ranked(kept, by, F.col("replicon"), F.col("start"), name="copy") if by else kept


def stratum(copies: DataFrame, units: DataFrame, by: list[str], seq: str = "seq") -> DataFrame:
    """Every unit with truth_copies, distinct sequences and its stratum; units without a copy are absent from the genome."""
    per = copies.groupBy(*by).agg(F.count(F.lit(1)).alias("truth_copies"), F.count_distinct(seq).alias("truth_distinct_sequences"))
    j = units.join(per, by, "left").na.fill(0, ["truth_copies", "truth_distinct_sequences"])
    n = F.col("truth_copies")
    return j.withColumn("stratum", F.when(n == 0, STRATA[3]).when(n == 1, STRATA[0]).when(F.col("truth_distinct_sequences") == 1, STRATA[1]).otherwise(STRATA[2]))


# Ways to round a dosage to a copy number, as three tables of results use them.
ROUNDING = ("half up", "half even", "nearest")


def rounds_to(value: Column, truth: Column, rule: str) -> Column:
    if rule == "half up":
        return F.floor(value + 0.5) == truth
    if rule == "half even":
        return F.bround(value) == truth
    if rule == "nearest":
        return F.abs(value - truth) < 0.5
    raise ValueError(f"no such rule: {rule}")


def copy_outcomes(df: DataFrame, rule: str = "half up") -> DataFrame:
    """Errors and verdicts of copy numbers against ``truth``; a null truth gives null outcomes, a null value no verdict.

    Columns: truth, ratio, ratio_ci_low, ratio_ci_high, depth_call,
    dosage_estimate, dosage_ci_low, dosage_ci_high, graph_context_count,
    graph_context_lower_bound, copy_number_call, copy_number_kind,
    copy_number_lower_bound, copy_number_status.
    """
    c, t = F.col, F.col("truth")
    graph = F.when(c("graph_context_count") == t, "equal to the truth").when(c("graph_context_count") < t, "wrong, below the truth").when(c("graph_context_count") > t, "wrong, above the truth").when(c("graph_context_lower_bound") <= t, "correct lower bound").when(c("graph_context_lower_bound") > t, "wrong, lower bound above the truth").otherwise("no count and no bound")
    kind, call = c("copy_number_kind"), c("copy_number_call")
    correct = F.when(kind == "INTEGER_CONTEXT_COUNT", F.coalesce(call == t, F.lit(False))).when(kind == "MEAN_DEPTH_DOSAGE", F.coalesce(rounds_to(call, t, rule), F.lit(False))).when(kind == "LOWER_BOUND", F.coalesce(c("copy_number_lower_bound") <= t, F.lit(False)))
    known = lambda x: F.when(t.isNotNull(), x)
    error = lambda x: known(F.round(c(x) - t, 4))
    part = lambda x: known(F.when(t != 0, F.round((c(x) - t) / t, 4)))
    return df.withColumns({
        "ratio_error": error("ratio"), "ratio_relative_error": part("ratio"), "ratio_ci_width": known(F.round(c("ratio_ci_high") - c("ratio_ci_low"), 4)), "ratio_ci_contains_truth": known(S.interval_contains("ratio_ci_low", "ratio_ci_high", t)),
        "called_multicopy_depth": known(F.when(c("ratio").isNotNull(), c("depth_call") == "MULTICOPY_DEPTH")), "dosage_error": error("dosage_estimate"), "dosage_relative_error": part("dosage_estimate"), "dosage_ci_contains_truth": known(S.interval_contains("dosage_ci_low", "dosage_ci_high", t)),
        "graph_against_truth": known(graph), "consensus_against_truth": known(F.when(correct.isNull(), "no value").when(correct, "correct").otherwise("wrong")), "consensus_error": error("copy_number_call"),
        "supported_but_wrong": known((c("copy_number_status") == "SUPPORTED") & F.coalesce(~correct, F.lit(False))),
    })


def with_blocks(cases: DataFrame, sizes: list[int]) -> DataFrame:
    """Every case once per block size (``block_bp``)."""
    return cases.withColumn("block_bp", F.explode(F.array(*[F.lit(s) for s in sizes])))


# Bits of an assembly flag in order, and those that a decision wants set or unset.
ASSEMBLY_FLAGS = ("assembled", "assembled_into_one_contig", "region_assembled_twice", "complete_gene", "unique_contig", "scaffold_graph_bad", "assembly_fail", "variants_suggest_collapsed_repeat", "hit_both_strands", "has_variant", "ref_seq_choose_fail")
MUST_SET, MUST_UNSET = ("assembled", "assembled_into_one_contig", "unique_contig"), ("region_assembled_twice", "scaffold_graph_bad", "assembly_fail", "variants_suggest_collapsed_repeat")


def flag_bit(flag: str | Column, name: str) -> Column:
    return S.has_bit(flag, ASSEMBLY_FLAGS.index(name))


def flag_list(flag: str | Column) -> Column:
    """Names of the bits that are set, in order."""
    return S.reasons(*[(flag_bit(flag, name), name) for name in ASSEMBLY_FLAGS])


def assembler_reasons(returned: Column, flag: Column, coding: Column, must_set: tuple = MUST_SET, must_unset: tuple = MUST_UNSET) -> Column:
    """Why an assembled locus is not accepted; an empty array is acceptance."""
    of = [(~flag_bit(flag, n), f"{n} not set") for n in must_set] + [(flag_bit(flag, n), f"{n} set") for n in must_unset] + [(coding & ~flag_bit(flag, "complete_gene"), "complete_gene not set")]
    count = F.when(returned != 1, F.concat(returned.cast("string"), F.lit(" sequences returned")))
    return F.array_compact(F.concat(F.array(count, F.when(flag.isNull(), "locus absent from the report")), S.reasons(*[(F.coalesce(c, F.lit(False)), n) for c, n in of])))


def consensus_reasons(returned: Column, lower_case: Column, uncalled: Column, coverage: Column) -> Column:
    """Why a mapped consensus is not accepted; an unknown coverage is not whole."""
    none = returned == 0
    told = F.when(coverage.isNull(), "template coverage not reported").when(coverage != 100, F.concat(F.lit("template coverage "), coverage.cast("string")))
    return F.array_compact(F.array(F.when(none, "no consensus returned"), F.when(~none & (lower_case > 0), F.concat(lower_case.cast("string"), F.lit(" lower-case bases"))), F.when(~none & (uncalled > 0), F.concat(uncalled.cast("string"), F.lit(" n"))), told))


def base_counts(seq: str) -> dict[str, Column]:
    """Length without gaps, uncalled bases and lower-case bases of returned sequences."""
    plain = F.replace(F.col(seq), F.lit("-"), F.lit(""))
    return {"returned_bp": F.length(plain), "uncalled_bases": S.count_of(F.upper(plain), "N"), "lowercase_bases": F.length(F.regexp_replace(plain, "[^a-z]", ""))}


def base_at(candidate: Column, truth: Column, position: Column) -> Column:
    """The base of a truth at a 1-based position of a candidate: place by place, or where the candidate lies inside it; ``?`` where neither tells."""
    inside = F.instr(truth, candidate)
    return F.when(F.length(candidate) == F.length(truth), F.substr(truth, position, F.lit(1))).when(inside > 0, F.substr(truth, inside + position - 1, F.lit(1))).otherwise("?")


def mixed_sites(sites: DataFrame, truths: DataFrame, by: list[str]) -> DataFrame:
    """Credible mixed sites with the bases of every truth copy there.

    ``sites``: by, candidate, position, alt_base; ``truths``: by, name, seq.
    Each truth is read on the strand of the smaller edit distance.
    """
    c, t = F.upper("candidate"), F.upper("seq")
    j = sites.join(truths, by)
    # No distance is below the difference of the lengths, which is that of a part to its whole.
    near = F.when(F.contains(t, c) | F.contains(c, t), t).when(F.levenshtein(c, t) <= F.levenshtein(c, S.reverse_complement(t)), t).otherwise(S.reverse_complement(t))
    at = j.withColumn("__near", near).withColumn("__base", base_at(c, F.col("__near"), F.col("position").cast("int"))).drop("__near")
    keys = [x for x in sites.columns if x != "candidate"]
    per = at.groupBy(*keys).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("name", "__base"))), lambda x: F.concat(x["name"], F.lit(":"), x["__base"])), ";").alias("truth_bases_at_site"), F.count_distinct("__base").alias("__n"), F.bool_or(F.col("__base") == F.upper("alt_base")).alias("alt_base_is_in_a_truth_copy"))
    return per.withColumn("truth_copies_differ_at_site", F.col("__n") > 1).drop("__n")


def completeness(df: DataFrame) -> DataFrame:
    """Measured against constructed losses of spans: one boolean a check, and ``exact`` where all hold.

    Columns truth_x and measured_x for x in clipped_start_bp, clipped_end_bp,
    lost_prefix_bp, lost_suffix_bp, continuation_contig, recovered_bp,
    overlap_bp; extracted_bp and expected_bp; two nulls agree.
    """
    names = ("clipped_start_bp", "clipped_end_bp", "lost_prefix_bp", "lost_suffix_bp", "continuation_contig", "recovered_bp", "overlap_bp")
    checks = {f"{n}_ok": F.col(f"truth_{n}").eqNullSafe(F.col(f"measured_{n}")) for n in names} | {"length_ok": F.col("extracted_bp").eqNullSafe(F.col("expected_bp"))}
    out = df.withColumns(checks)
    holds = F.lit(True)
    for n in checks:
        holds &= F.col(n)
    return out.withColumn("exact", holds)


def relation_counts(df: DataFrame, by: list[str], related: str) -> DataFrame:
    """One column per relation (underscored) with its number of rows, and the total."""
    cell = lambda r: "".join(x if x.isalnum() else "_" for x in r).replace("__", "_")
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col(related) == r).alias(cell(r)) for r in RELATIONS])


def truths_recovered(found: DataFrame, truths: DataFrame, by: list[str], seq: str = "seq") -> DataFrame:
    """How many distinct truths of each key are returned exactly on either strand: truths, recovered."""
    plain = F.upper(F.replace(F.col(seq), F.lit("-"), F.lit("")))
    called = found.select(*by, F.least(plain, S.reverse_complement(plain)).alias("__c")).distinct().withColumn("__hit", F.lit(1))
    t = F.upper(seq)
    wanted = truths.select(*by, t.alias("__t"), F.least(t, S.reverse_complement(t)).alias("__c")).distinct()
    return wanted.join(called, [*by, "__c"], "left").groupBy(*by).agg(F.count(F.lit(1)).alias("truths"), F.count("__hit").alias("recovered"))


def best_per_configuration(df: DataFrame, by: list[str], related: str, aligned: str, label: str) -> DataFrame:
    """The row that relates best per locus and configuration, with the labels of all rows in ``detail`` (best first)."""
    index = F.array_position(F.array(*[F.lit(r) for r in RELATIONS]), F.col(related))
    labels = df.groupBy(*by).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(index.alias("i"), (-F.col(aligned)).alias("a"), F.col(label).alias("l")))), lambda x: x["l"]), "; ").alias("detail"))
    return best_relation(df, by, related, aligned).join(labels, by)


def annotated_relation(df: DataFrame, by: list[str], seq: str, truth: str, identity: str, length: str) -> DataFrame:
    """Relation of a candidate to its annotated truths by the greatest identity times length: exact, identity, length, delta, relation.

    Ties go to the first truth by its bases; a null length counts as 0.
    """
    s, t = F.upper(seq), F.upper(truth)
    score = F.coalesce(F.col(identity) * F.col(length), F.lit(0.0))
    per = df.groupBy(*by).agg(
        F.bool_or(s.isNotNull() & (s != "") & ((s == t) | (s == S.reverse_complement(t)))).alias("exact"),
        F.max_by(F.struct(F.col(identity).alias("identity"), F.col(length).alias("length"), (F.length(seq) - F.length(truth)).alias("delta")), F.struct(score, F.reverse(t))).alias("b"),
    )
    i, n = F.col("b.identity"), F.coalesce("b.length", F.lit(0))
    told = F.when(F.col("exact"), "identical to the annotated allele").when((n > 0) & (i >= 99.995), F.format_string("identical over the %d bp overlap; candidate %+d bp against the annotated boundary", n.cast("long"), F.col("b.delta").cast("long"))).when(n > 0, F.format_string("%.2f%% identity over %d bp", i.cast("double"), n.cast("long"))).otherwise("no alignment to the annotated allele")
    return per.select(*by, "exact", i.alias("identity"), n.alias("length"), F.col("b.delta").alias("delta"), told.alias("relation"))


def stage_rows(df: DataFrame, stage: str, classes: dict[str, str], category: str) -> DataFrame:
    """Rows of one stage with the class of each category; a category without a class raises."""
    found = F.create_map(*[F.lit(x) for pair in classes.items() for x in pair])[F.col(category)]
    named = F.when(found.isNull(), F.raise_error(F.concat(F.lit("a category without a class: "), F.coalesce(F.col(category), F.lit("null")))).cast("string")).otherwise(found)
    return df.withColumn("stage", F.lit(stage)).withColumn("case_class", named)


def combined_stages(stages: list[DataFrame], control: str) -> DataFrame:
    """All stage tables as one, with ``evidence`` from evidence or case_design, and whether a row counts (the control stage's do not)."""
    out = stages[0]
    for s in stages[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    have = [F.col(c) for c in ("evidence", "case_design") if c in out.columns]
    return out.withColumn("evidence", F.coalesce(*have, F.lit(""))).withColumn("counts", F.col("stage") != control)


def concordance(report: str | Column, least_identity: float = 99.9, least_aligned: float = 98.0) -> Column:
    """Struct of aligned share, identity and verdict read from a dnadiff report's text; what it does not say is null and does not pass."""
    t = F.lit(report) if isinstance(report, str) else report
    part = lambda p: F.regexp_extract(t, p, 1).try_cast("double")
    aligned, identity = part(r"AlignedBases\s+\d+\(([0-9.]+)%\)"), part(r"AvgIdentity\s+([0-9.]+)")
    return F.struct(aligned.alias("aligned_pct"), identity.alias("identity_pct"), F.coalesce((identity >= least_identity) & (aligned >= least_aligned), F.lit(False)).alias("concordant"))


def fewest_shared(candidates: DataFrame, target: DataFrame, by: list[str], seq: str, score: str, k: int = 25, most: int = 5) -> DataFrame:
    """The candidates of the greatest score among those that share the fewest k-mers with the target's sequences: ``most`` of each key.

    Adds ``shared``.  Order: fewest shared, greatest score, then sequence.
    """
    wanted = target.select(*by, F.explode(S.kmers(F.upper(seq), k)).alias("__g")).distinct().withColumn("__hit", F.lit(1))
    keyed = candidates.withColumn("__id", F.xxhash64(*candidates.columns))
    grams = keyed.select(*by, "__id", F.explode(S.kmers(F.upper(seq), k)).alias("__g"))
    # A row's k-mers are distinct, so rows that repeat are told apart from none: each has the one count.
    shared = grams.join(wanted, [*by, "__g"]).groupBy("__id").agg(F.count_distinct("__g").alias("shared"))
    j = keyed.join(shared, "__id", "left").na.fill(0, ["shared"])
    return ranking.ranked(j, by, F.col("shared"), F.col(score).desc(), F.col(seq)).filter(F.col("rank") <= most).drop("rank", "__id")


def explained(df: DataFrame, text: str, rules: list[tuple[str, str]], otherwise: str = "unexplained") -> DataFrame:
    """``explanation``: that of the first rule whose pattern the text matches."""
    return df.withColumn("explanation", S.first_match(otherwise, *[(F.col(text).rlike(p), name) for p, name in rules]))


def slots(lines: DataFrame, pattern: str = r"\{\{([A-Z0-9_]+)\}\}") -> DataFrame:
    """Tokens of a pattern in text lines (path, value): token, uses and the files that hold it."""
    found = lines.select("path", F.explode(F.regexp_extract_all("value", F.lit(pattern), F.lit(1))).alias("token"))
    return found.groupBy("token").agg(F.count(F.lit(1)).alias("uses"), F.sort_array(F.collect_set("path")).alias("files"))


def mean_slope(df: DataFrame, by: list[str], case: str, y: str, x: str) -> DataFrame:
    """Mean, least and greatest slope of the fits of each case; cases with fewer than two points have none."""
    per = df.groupBy(*by, case).agg(F.regr_slope(y, x).alias("__s"))
    return per.groupBy(*by).agg(F.avg("__s").alias("mean_slope"), F.min("__s").alias("least_slope"), F.max("__s").alias("most_slope"), F.count("__s").alias("cases"))


def genome_audit(features: DataFrame, by: list[str], expected: DataFrame) -> DataFrame:
    """Closed genomes against their manifest: chromosomes, full-length features, and whether all is as it should be.

    ``features``: by, replicon, circular, plasmid, kind, length; ``expected``:
    by, kind, least_length, copies.
    """
    main = features.filter(F.col("circular") & ~F.col("plasmid")).groupBy(*by).agg(F.count_distinct("replicon").alias("chromosomes"))
    per = expected.join(features, [*by, "kind"], "left").groupBy(*by, "kind", "copies").agg(F.count_if(F.col("length") >= F.col("least_length")).alias("found"))
    return per.join(main, by, "left").na.fill(0, ["chromosomes"]).withColumn("sound", (F.col("chromosomes") == 1) & (F.col("found") == F.col("copies")))


def in_sheet_order(results: DataFrame, sheet: DataFrame, key: str, order: str) -> DataFrame:
    """Results of the sheet's rows in its order; rows without a result stay, with nulls."""
    return sheet.select(key, F.col(order).alias("__o")).join(results, key, "left").orderBy("__o").drop("__o")


def changed_fields(old: DataFrame, new: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """One row per key and field that differs: key, field, old, new, and whether the row was added, removed or changed.

    Values are compared as text, null as a value of its own.
    """
    side = lambda df, name: df.select(*key, F.struct(*[F.col(c).cast("string").alias(c) for c in columns]).alias(name))
    j = side(old, "__a").join(side(new, "__b"), key, "full")
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"__a.{c}").alias("old"), F.col(f"__b.{c}").alias("new")) for c in columns]))
    kind = F.when(F.col("__a").isNull(), "ADDED").when(F.col("__b").isNull(), "REMOVED").otherwise("CHANGED")
    out = j.select(*key, kind.alias("change"), cells.alias("x")).select(*key, "change", "x.*")
    return out.filter(~F.col("old").eqNullSafe(F.col("new")))


def paired_truth(truth: DataFrame, results: DataFrame, key: list[str], status: str = "status", absent: str = "MISSING") -> DataFrame:
    """Every truth row with its result; ``status`` says so where there is none."""
    return truth.join(results, key, "left").withColumn(status, F.coalesce(status, F.lit(absent)))


def locate(genomes: DataFrame, loci: DataFrame, by: list[str], genome: str = "genome", locus: str = "locus") -> DataFrame:
    """First place of each locus in its genome on either strand: start (1-based), end and strand; null where it is not there."""
    j = genomes.join(loci, by)
    at, back = F.instr(genome, F.col(locus)), F.instr(genome, S.reverse_complement(locus))
    start = F.when(at > 0, at).when(back > 0, back)
    return j.withColumns({"start": start, "end": start + F.length(locus) - 1, "strand": F.when(at > 0, "+").when(back > 0, "-")})


def first_in_window(df: DataFrame, by: list[str], *order: Column, most: int) -> DataFrame:
    """The first ``most`` rows of each key."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("__n") <= most).drop("__n")


def exactness(candidates: DataFrame, truths: DataFrame, by: list[str], seq: str = "seq") -> DataFrame:
    """Every candidate with ``exact``: whether a truth of its key is the same bases on either strand."""
    s = F.upper(seq)
    known = truths.select(*by, F.least(s, S.reverse_complement(s)).alias("__c")).distinct().withColumn("exact", F.lit(True))
    return candidates.withColumn("__c", F.least(s, S.reverse_complement(s))).join(known, [*by, "__c"], "left").drop("__c").na.fill(False, ["exact"])


def frame_grid(records: DataFrame, seq: str = "seq") -> DataFrame:
    """Each sequence as given and turned: orientation, stops, frame; the fewest stops do not depend on the strand it came in."""
    both = F.explode(F.array(F.struct(F.lit("given").alias("orientation"), F.upper(seq).alias("__s")), F.struct(F.lit("turned").alias("orientation"), F.upper(S.reverse_complement(seq)).alias("__s"))))
    out = records.withColumn("__x", both).withColumn("__f", S.six_frame_stops("__x.__s"))
    return out.withColumns({"orientation": F.col("__x.orientation"), "stops": F.col("__f.stops"), "frame": F.col("__f.frame")}).drop("__x", "__f")


def interpretation(result: str = "dosage_estimate", call: str = "depth_call", status: str = "dosage_status") -> Column:
    """One sentence on a depth result."""
    what = F.when(F.col(call) == "MULTICOPY_DEPTH", "more than one copy is supported").when(F.col(call) == "SINGLE_COPY_COMPATIBLE", "compatible with a single copy").otherwise("no statement on copies")
    value = F.when(F.col(result).isNotNull(), F.format_string("dosage %.3f", F.col(result).cast("double"))).otherwise("no dosage")
    return F.concat(what, F.lit("; "), value, F.lit(" ("), F.coalesce(status, F.lit("NOT_ESTIMATED")), F.lit(")"))
