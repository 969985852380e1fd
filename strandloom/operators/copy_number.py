"""Copy number of target loci from depth: ratio to the backbone, interval, dosage with brackets, status and call.

Tables, with ``by`` for the columns that name a sample:

- depth: by, contig, pos, depth, depth_raw; a row for every position, zeros too
- contigs: by, contig, length, and optionally ord, the contigs' order
- regions: by, target, region (0, 1, ...), contig, start, end (null: whole contig), gene_start, gene_end (null: unknown)
- targets: by, target, gene_length (null: unknown)
- excluded: by, contig, start, end
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.operators import intervals
from strandloom.operators.decisions import call_threshold, depth_call, dosage_status
from strandloom.operators.stats import Blocks, dosage_draws, is_spread, percentile_bounds, ratio_draws, weighted_median

BIN = 10_000
Keep = Callable[[str, DataFrame], DataFrame]


def backbone_positions(depth: DataFrame, contigs: DataFrame, excluded: DataFrame | None, by: list[str], min_contig: int = 5000, trim: int = 100, without: list[str] | None = None) -> DataFrame:
    """Depth rows of long contigs, without their ends, excluded intervals and contigs named in ``without``."""
    long = contigs.filter(F.col("length") >= min_contig)
    if without:
        long = long.filter(~F.col("contig").isin(*without))
    inner = depth.join(long.select(*by, "contig", "length"), [*by, "contig"]).filter(F.col("pos").between(trim + 1, F.col("length") - trim) & (F.col("length") - trim > trim + 1)).drop("length")
    return inner if excluded is None else intervals.range_join(inner, excluded.select(*by, "contig", "start", "end"), [*by, "contig"], "pos", "start", "end", BIN, "left_anti")


def _segments(spans: DataFrame, key: list[str]) -> DataFrame:
    """Per key: array of (bases, member regions) over 1..gene_length; uncovered stretches have no members."""
    fits = spans.select(*key, "region", "gene_length", F.greatest(F.lit(1), F.least("gene_start", "gene_end")).alias("lo"), F.least("gene_length", F.greatest("gene_start", "gene_end")).alias("hi")).filter("hi >= lo")
    cut = spans.select(*key, F.explode(F.array(F.lit(1).cast("long"), F.col("gene_length").cast("long") + 1)).alias("at")).unionByName(fits.select(*key, F.explode(F.array(F.col("lo").cast("long"), F.col("hi").cast("long") + 1)).alias("at"))).distinct()
    parts = cut.withColumn("upto", F.lead("at").over(Window.partitionBy(*key).orderBy("at"))).filter("upto is not null")
    held = parts.join(fits.select(*key, "region", "lo", "hi"), key, "left").withColumn("member", F.when((F.col("lo") <= F.col("at")) & (F.col("upto") - 1 <= F.col("hi")), F.col("region")))
    per = held.groupBy(*key, "at", "upto").agg(F.sort_array(F.collect_set("member")).alias("members"))
    return per.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("at", (F.col("upto") - F.col("at")).cast("long").alias("bases"), "members"))).alias("segments"))


def query_segments(spans: DataFrame, key: list[str]) -> DataFrame:
    """Maximal stretches of a query with the same spans on them, one row each: bases and members (empty: uncovered).

    ``spans``: the keys, region, gene_start, gene_end, gene_length.  Ends may
    come in either order; spans outside 1..gene_length cover nothing.
    """
    return _segments(spans, key).select(*key, F.explode("segments").alias("s")).select(*key, F.col("s.at").alias("start"), "s.bases", "s.members")


def span_geometry(spans: DataFrame, key: list[str]) -> DataFrame:
    """Aligned, union, overlapping and covered bases of the spans, and the dosage that single copies would show."""
    size, n = F.col("bases"), F.size("members")
    per = query_segments(spans, key).groupBy(*key).agg(F.sum(size * n).alias("total_bp"), F.sum(F.when(n > 0, size).otherwise(0)).alias("union_bp"))
    return per.withColumn("overlap_bp", F.col("total_bp") - F.col("union_bp")).withColumn("unit_dosage", F.when(F.col("union_bp") > 0, F.col("total_bp") / F.col("union_bp")).otherwise(0.0))


def weighted_copies(spans: DataFrame, key: list[str], ratio: str = "ratio") -> DataFrame:
    """Copies as span length times ratio over the query's length; right for disjoint, complete spans."""
    lo, hi = F.greatest(F.lit(1), F.least("gene_start", "gene_end")), F.least("gene_length", F.greatest("gene_start", "gene_end"))
    return spans.groupBy(*key).agg((F.sum(F.greatest(hi - lo + 1, F.lit(0)) * F.col(ratio)) / F.first("gene_length")).alias("copies"))


def copy_profile(spans: DataFrame, key: list[str], ratio: str = "ratio") -> DataFrame:
    """Mean multiplicity of the covered query bases, where a base carries the sum of its spans' ratios.

    Result: the keys, dosage (null without a covered base), dosage_lower
    (uncovered bases count 0), dosage_upper (they count the greatest
    multiplicity), covered_bp, max_multiplicity.
    """
    parts = query_segments(spans, key).select(*key, "start", "bases", F.explode_outer("members").alias("region"))
    rated = parts.join(spans.select(*key, "region", F.col(ratio).alias("__ratio")), [*key, "region"], "left")
    per = rated.groupBy(*key, "start", "bases").agg(F.coalesce(F.sum("__ratio"), F.lit(0.0)).alias("m"), F.count("region").alias("spans"))
    covered, total, whole = F.sum(F.when(F.col("spans") > 0, F.col("bases")).otherwise(0)), F.sum(F.col("bases") * F.col("m")), F.sum("bases")
    most = F.coalesce(F.max(F.when(F.col("spans") > 0, F.col("m"))), F.lit(0.0))
    return per.groupBy(*key).agg(F.when(covered > 0, total / covered).alias("dosage"), (total / whole).alias("dosage_lower"), ((total + (whole - covered) * most) / whole).alias("dosage_upper"), covered.alias("covered_bp"), most.alias("max_multiplicity"))


def _along_tiles(rows: DataFrame, tiles: DataFrame, wanted: DataFrame, by: list[str]) -> DataFrame:
    """The rows of the ``wanted`` tiles (by, contig, __tile) with ``__at``, their place along the whole backbone from 0 on."""
    mine = rows.join(wanted, [*by, "contig", "__tile"], "left_semi")
    here = F.row_number().over(Window.partitionBy(*by, "contig", "__tile").orderBy("pos")).cast("long") - 1
    return mine.withColumn("__here", here).join(tiles.select(*by, "contig", "__tile", "__from"), [*by, "contig", "__tile"]).withColumn("__at", F.col("__from") + F.col("__here")).drop("__here", "__from")


def _tiles_of(spans: DataFrame, start: str, end: str, name: str) -> DataFrame:
    return spans.withColumn(name, F.explode(F.sequence(F.floor(F.col(start) / BIN), F.floor(F.col(end) / BIN))))


def _subtracted(pool: DataFrame, removed: DataFrame, by: list[str], key: list[str], targets: DataFrame) -> DataFrame:
    """Rows per depth value of each target's backbone: the sample's counts less those inside the target."""
    every = pool.groupBy(*by, "depth").agg(F.count(F.lit(1)).alias("n"))
    mine = removed.groupBy(*key, "depth").agg(F.count(F.lit(1)).alias("gone"))
    return targets.select(*key).join(every, by).join(mine, [*key, "depth"], "left").withColumn("n", F.col("n") - F.coalesce("gone", F.lit(0))).filter("n > 0").drop("gone")


def depth_ratio(
    depth: DataFrame, contigs: DataFrame, regions: DataFrame, targets: DataFrame, by: list[str], excluded: DataFrame | None = None, *,
    min_contig: int = 5000, trim: int = 100, block: int = 500, resamples: int = 1000, seed: int = 20260817, cap: int = 512, threshold: float = 1.5, calibration: str | None = None, ambiguity_warn: float = 0.70, alpha: float = 0.05, keep: Keep | None = None,
) -> DataFrame:
    """One row per target: ratio of median depths with a block-bootstrap interval, dosage with bracket and interval, status, flags and call.

    The backbone of a target is its sample's long contigs less ends, excluded
    intervals and the target's own regions.  No backbone is copied per target:
    medians come from counts per depth value, less those of the target, and the
    bootstrap reads only the ``cap`` evenly spaced blocks that it draws from.
    ``calibration`` names a column of ``targets``.  A target without depth rows
    has depth 0; one without a backbone is DEPTH_INDETERMINATE with ratio 0.
    Notes are codes.  The backbone is counted by tiles of positions, and only
    tiles that a region or a drawn block touches have their rows numbered, so
    most of its rows leave their scan as counts.  ``keep(name, df)`` may store
    what is read more than once (the small tables, whose size Spark knows then,
    tiles, regions' rows); without it they are computed again each time.
    """
    kept = keep or (lambda _, df: df)
    key = [*by, "target"]
    contigs, regions, targets = kept("contigs", contigs), kept("regions-given", regions), kept("targets", targets)
    excluded = excluded if excluded is None else kept("excluded", excluded)
    place = F.col("ord") if "ord" in contigs.columns else F.col("contig")
    sized = regions.join(contigs.select(*by, "contig", "length", place.alias("__ord")), [*by, "contig"], "left")
    open_ended = sized.withColumn("start", F.coalesce("start", F.lit(1)).cast("long")).withColumn("end", F.coalesce("end", "length").cast("long"))
    located = open_ended.select(*key, "region", "contig", "start", "end").filter("end >= start")
    inside = kept("inside", intervals.range_join(depth, located, [*by, "contig"], "pos", "start", "end", BIN).select(*key, "region", "pos", "depth", "depth_raw"))

    # Regions: medians, raw medians, and the depths in order for the bootstrap; a locus is as long as its gene.
    per_region = kept("regions", inside.groupBy(*key, "region").agg(F.median("depth").alias("median"), F.transform(F.sort_array(F.collect_list(F.struct("pos", "depth"))), lambda x: x["depth"].cast("double")).alias("depths")))
    per_target = inside.groupBy(*key).agg(F.median("depth").alias("locus_median"), F.median("depth_raw").alias("locus_raw"), F.count(F.lit(1)).alias("locus_n"))

    pool = backbone_positions(depth, contigs, excluded, by, min_contig, trim).withColumn("__tile", F.floor(F.col("pos") / BIN))
    order = contigs.select(*by, "contig", place.alias("__ord"))
    before = Window.partitionBy(*by).orderBy("__ord", "contig", "__tile").rowsBetween(Window.unboundedPreceding, -1)
    tiles = pool.groupBy(*by, "contig", "__tile").agg(F.count(F.lit(1)).alias("__rows")).join(order, [*by, "contig"])
    tiles = kept("tiles", tiles.withColumn("__from", F.coalesce(F.sum("__rows").over(before), F.lit(0))).drop("__ord"))
    merged = intervals.merge(located, [*key, "contig"], "start", "end").select(*key, "contig", "start", "end")
    removed = intervals.range_join(pool, merged, [*by, "contig"], "pos", "start", "end", BIN)
    counts = kept("counts", _subtracted(pool, removed, by, key, targets))
    middle = weighted_median(counts, key, "depth", "n", "backbone_median")
    away = counts.join(middle.select(*key, "backbone_median"), key).withColumn("away", F.abs(F.col("depth") - F.col("backbone_median"))).groupBy(*key, "away").agg(F.sum("n").alias("n"))
    backbone = kept("middle", middle.withColumnRenamed("n", "backbone_n").join(weighted_median(away, key, "away", "n", "backbone_mad").drop("n"), key))

    # Blocks count a target's own backbone, so the places of its regions are skipped.
    beside = _along_tiles(pool.select(*by, "contig", "pos", "__tile"), tiles, _tiles_of(merged, "start", "end", "__tile").select(*by, "contig", "__tile").distinct(), by)
    gaps = intervals.range_join(beside, merged, [*by, "contig"], "pos", "start", "end", BIN).groupBy(*key, "contig", "start").agg(F.min("__at").alias("a"), F.max("__at").alias("b"))
    gaps = gaps.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("gaps"), F.sum(F.col("b") - F.col("a") + 1).alias("gone"))
    sizes = tiles.groupBy(*by).agg(F.sum("__rows").alias("__all"))
    none = F.array().cast("array<struct<a:bigint,b:bigint>>")
    wanted = targets.select(*key).join(sizes, by).join(gaps, key, "left").withColumn("gaps", F.coalesce("gaps", none)).withColumn("gone", F.coalesce("gone", F.lit(0)))
    wanted = wanted.withColumn("__blocks", F.ceil((F.col("__all") - F.col("gone")) / block))
    chosen = wanted.filter("__blocks > 0").select(*key, "gaps", "gone", "__blocks", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__blocks") - 1)).alias("__b")).filter(is_spread(F.col("__b"), F.col("__blocks"), cap))
    windows = kept("windows", chosen.select(*key, "gaps", "__b", (F.col("__b") * block).alias("__lo"), ((F.col("__b") + 1) * block - 1 + F.col("gone")).alias("__hi")))
    places = _tiles_of(tiles.withColumn("__upto", F.col("__from") + F.col("__rows") - 1), "__from", "__upto", "__bin")
    touched = places.join(_tiles_of(windows, "__lo", "__hi", "__bin").select(*by, "__bin", "__lo", "__hi"), [*by, "__bin"]).filter("__from <= __hi and __upto >= __lo").select(*by, "contig", "__tile").distinct()
    drawn = _along_tiles(pool.select(*by, "contig", "pos", "depth", "__tile"), tiles, kept("touched", touched), by)
    near = intervals.range_join(drawn.select(*by, "__at", "depth"), windows, by, "__at", "__lo", "__hi", max(block, 1))
    skipped = F.aggregate("gaps", F.lit(0).cast("long"), lambda s, g: s + F.greatest(F.least(g["b"], F.col("__at") - 1) - g["a"] + 1, F.lit(0)))
    taken = near.filter(~F.exists("gaps", lambda g: F.col("__at").between(g["a"], g["b"]))).withColumn("__own", F.col("__at") - skipped).filter(F.floor(F.col("__own") / block) == F.col("__b"))
    sampled = taken.groupBy(*key).agg(F.transform(F.sort_array(F.collect_list(F.struct("__own", "depth"))), lambda x: x["depth"].cast("double")).alias("backbone_depths"))

    # Geometry: a single region without spans is the whole gene.
    known = open_ended.join(targets.select(*key, "gene_length"), key)
    number = F.count(F.lit(1)).over(Window.partitionBy(*key))
    spanned = F.count_if(F.col("gene_start").isNotNull() & F.col("gene_end").isNotNull()).over(Window.partitionBy(*key))
    whole = (F.col("__k") == 1) & (F.col("__s") == 0) & F.col("end").isNotNull()
    spans = known.withColumns({"__k": number, "__s": spanned})
    spans = spans.withColumns({"gene_length": F.when(whole, F.coalesce("gene_length", F.col("end") - F.col("start") + 1)).otherwise(F.col("gene_length")), "gene_start": F.when(whole, 1).otherwise(F.col("gene_start")), "gene_end": F.when(whole, F.col("end") - F.col("start") + 1).otherwise(F.col("gene_end"))})
    mismatch = (F.col("__s") > 0) & (F.col("__s") != F.col("__k"))
    facts = spans.groupBy(*key).agg(F.first("__k").alias("regions"), F.first(mismatch).alias("mismatch"), F.max("gene_length").alias("gene_length"))
    spans = spans.filter(~mismatch & (F.col("gene_length") > 0) & F.col("gene_start").isNotNull() & F.col("gene_end").isNotNull())
    rated = spans.select(*key, "region", "gene_start", "gene_end", "gene_length").join(per_region.select(*key, "region", "median"), [*key, "region"], "left").join(backbone.select(*key, "backbone_median"), key, "left")
    rated = rated.withColumn("ratio", F.when(F.col("backbone_median") > 0, F.coalesce("median", F.lit(0.0)) / F.col("backbone_median")))
    profile = copy_profile(rated, key).join(span_geometry(rated, key), key)

    ordered = regions.select(*key, "region").join(per_region, [*key, "region"], "left").groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("region", F.coalesce("median", F.lit(0.0)).alias("median"), F.coalesce("depths", F.array().cast("array<double>")).alias("depths")))).alias("parts"))
    inputs = ordered.join(sampled, key, "left").join(_segments(rated, key), key, "left")
    bounds = _intervals(inputs, key, block, resamples, seed, cap, alpha)

    j = targets.join(facts, key, "left").join(per_target, key, "left").join(backbone, key, "left").join(profile, key, "left").join(bounds, key, "left").join(ordered.select(*key, F.transform("parts", lambda p: p["median"]).alias("medians")), key, "left").drop(targets["gene_length"])
    base, locus, raw = F.coalesce("backbone_median", F.lit(0.0)), F.coalesce("locus_median", F.lit(0.0)), F.coalesce("locus_raw", F.lit(0.0))
    has = base > 0
    ambiguity = F.when(raw > 0, locus / raw).otherwise(0.0)
    reliable = ambiguity >= ambiguity_warn
    ratio = F.when(has, locus / base).otherwise(0.0)
    low, high = F.coalesce("ci_low", F.lit(0.0)), F.coalesce("ci_high", F.lit(0.0))
    used = call_threshold(threshold, F.col(calibration) if calibration else None)
    call = depth_call(low, base, used["value"])
    dosage = F.when(has, F.col("dosage"))
    partial, overlap = F.coalesce(F.col("union_bp") < F.col("gene_length"), F.lit(False)), F.coalesce(F.col("overlap_bp") > 0, F.lit(False))
    zero = F.exists("medians", lambda m: m == 0)
    status = F.when(~has, "NOT_ESTIMATED").otherwise(dosage_status(dosage.isNotNull(), reliable, overlap, partial))
    flags = F.array_compact(F.array(
        F.when(F.col("mismatch"), "GENE_SPAN_COUNT_MISMATCH"), F.when(F.col("union_bp").isNotNull() & partial, "INCOMPLETE_QUERY_COVERAGE"), F.when(overlap, "OVERLAPPING_QUERY_SPANS"),
        F.when(F.col("union_bp").isNotNull() & zero, "ZERO_RATIO_REGIONS"), F.when(F.col("union_bp").isNull() & (F.col("regions") > 1), "MISSING_QUERY_GEOMETRY"), F.when(~reliable, "LOW_MAPPING_UNIQUENESS"),
    ))
    notes = F.array_compact(F.array(
        F.when(~reliable, "LOW_MAPPING_UNIQUENESS"), F.when(~has, "ZERO_BACKBONE"), F.when(has & (F.col("backbone_mad") / base > 0.35), "DISPERSED_BACKBONE"),
        F.when(has & used["source"].isin("CALIBRATED_RAISED", "CALIBRATED_FLOOR_HELD"), used["source"]), F.when(has & (ratio > 0) & ~F.lit(1.0).between(low, high), "INTERVAL_EXCLUDES_ONE"),
        F.when(has & (F.floor(high) < F.ceil(low)), "INTERVAL_WITHOUT_INTEGER"), F.when(has & ~reliable & (call == "MULTICOPY_DEPTH"), "RATIO_IS_LOWER_BOUND"), F.when((ratio > 0) & (ratio < 0.6), "RATIO_WELL_BELOW_ONE"),
    ))
    r = lambda c, n: F.round(c, n)
    blocks = lambda n: F.ceil(F.coalesce(n, F.lit(0)) / block)
    return j.select(
        *key, F.coalesce("regions", F.lit(0)).alias("assembly_region_count"), r(locus, 2).alias("locus_median_depth"), r(raw, 2).alias("locus_median_depth_unfiltered"), r(base, 2).alias("backbone_median_depth"), r(F.when(has, F.col("backbone_mad")).otherwise(0.0), 2).alias("backbone_mad"),
        r(ratio, 3).alias("ratio"), r(F.when(has, low).otherwise(0.0), 3).alias("ratio_ci_low"), r(F.when(has, high).otherwise(0.0), 3).alias("ratio_ci_high"), r(ambiguity, 3).alias("ambiguity_index"), (reliable & has).alias("reliable"),
        (call == "MULTICOPY_DEPTH").alias("single_copy_rejected"), call.alias("depth_call"), r(used["value"], 3).alias("call_threshold_used"), used["source"].alias("call_threshold_source"),
        r(dosage, 3).alias("dosage_estimate"), r(F.when(dosage.isNotNull(), F.col("dosage_lower")), 3).alias("dosage_lower"), r(F.when(dosage.isNotNull(), F.col("dosage_upper")), 3).alias("dosage_upper"),
        r(F.when(dosage.isNotNull(), F.col("dosage_ci_low")), 3).alias("dosage_ci_low"), r(F.when(dosage.isNotNull(), F.col("dosage_ci_high")), 3).alias("dosage_ci_high"), status.alias("dosage_status"), flags.alias("dosage_flags"),
        "gene_length", r(F.coalesce(F.when(has, F.col("covered_bp")) / F.col("gene_length"), F.lit(0.0)), 4).alias("query_coverage_fraction"), r(F.coalesce(F.when(has, F.col("max_multiplicity")), F.lit(0.0)), 3).alias("query_multiplicity_max"),
        F.coalesce("total_bp", F.lit(0)).alias("gene_total_aligned_bp"), F.coalesce("union_bp", F.lit(0)).alias("gene_union_covered_bp"), F.coalesce("overlap_bp", F.lit(0)).alias("gene_overlap_bp"), r(F.when(overlap & has, F.col("unit_dosage")), 3).alias("geometry_expected_dosage"),
        F.transform("medians", lambda m: F.round(F.when(base > 0, m / base).otherwise(0.0), 3)).alias("region_ratios"), blocks(F.col("locus_n")).alias("bootstrap_locus_blocks"), blocks(F.col("backbone_n")).alias("bootstrap_backbone_blocks_total"),
        F.least(blocks(F.col("backbone_n")), F.lit(cap)).alias("bootstrap_backbone_blocks_used"), notes.alias("notes"),
    )


def _intervals(inputs: DataFrame, key: list[str], block: int, resamples: int, seed: int, cap: int, alpha: float) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for parts, values, segments in zip(pdf["parts"], pdf["backbone_depths"], pdf["segments"], strict=True):
                depths = [list(p["depths"]) for p in parts]
                backbone = Blocks(values if values is not None else [], block, cap)
                whole = percentile_bounds(ratio_draws(Blocks([d for part in depths for d in part], block), backbone, resamples, seed), alpha)
                places = {int(p["region"]): i for i, p in enumerate(parts)}
                cut = [(int(s["bases"]), [places[int(m)] for m in s["members"]]) for s in segments] if segments is not None else []
                drawn = dosage_draws([Blocks(d, block) for d in depths], backbone, cut, resamples, seed) if cut else []
                rows.append((*whole, *percentile_bounds(drawn, alpha)))
            yield pdf[key].join(pd.DataFrame(rows, index=pdf.index, columns=["ci_low", "ci_high", "dosage_ci_low", "dosage_ci_high"], dtype=float))

    fields = ", ".join(f"`{c}` {inputs.schema[c].dataType.simpleString()}" for c in key)
    return inputs.select(*key, "parts", "backbone_depths", "segments").mapInPandas(run, f"{fields}, ci_low double, ci_high double, dosage_ci_low double, dosage_ci_high double")


def consensus_input(result: DataFrame) -> Column:
    """The columns of a depth-ratio result as the struct that ``decisions.consensus`` reads."""
    c = F.col
    return F.struct(c("depth_call"), c("reliable"), c("ratio_ci_low").alias("ci_low"), c("ratio_ci_high").alias("ci_high"), c("dosage_estimate").alias("dosage"), c("dosage_status"))
