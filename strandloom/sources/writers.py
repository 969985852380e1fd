"""Sinks: wrapped FASTA, tab-separated reports with empty nulls, partitioned catalogues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.functions.sequence import disposition
from strandloom.operators.evidence import SUPPORT_COLUMNS


def wrapped(seq_id: str, seq: str, width: int = 80) -> Column:
    return F.concat(F.lit(">"), F.col(seq_id), F.lit("\n"), F.regexp_replace(F.col(seq), f"(.{{{width}}})(?=.)", "$1\n"))


def write_fasta(df: DataFrame, path: str, seq_id: str = "seq_id", seq: str = "seq") -> None:
    df.select(wrapped(seq_id, seq).alias("value")).write.text(path)


def flat(df: DataFrame) -> DataFrame:
    """Every column as text: nulls empty, booleans in lower case, lists joined by ``;``, maps and structs as JSON."""
    out = []
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        c = F.col(f"`{f.name}`")
        if kind == "array" and f.dataType.elementType.typeName() not in ("struct", "array", "map"):
            c = F.concat_ws(";", F.transform(c, lambda x: x.cast("string")))
        elif kind in ("array", "map", "struct"):
            c = F.to_json(c)
        out.append(F.coalesce(c.cast("string"), F.lit("")).alias(f.name))
    return df.select(*out)


# The columns of a batch report in order, with decimals of numbers (None: as they are; "flag": true or false).
REPORT = {
    "sample_id": None, "status": None, "workflow_status": None, "result_disposition": None, "locus": None, "tool_version": None, "run_date": None, "allele_length": None, "nearest_allele": None, "exact_known_allele": "flag",
    "best_identity_pct": 1, "validation_coverage_pct": 1, "contigs_hit": None, "target_regions": None, "extracted_read_names": None, "spades_mode": None, "mapped_reads": None, "qc_confidence": None, "sequence_confidence": None,
    "catalogue_status": None, "nearest_allele_identity_pct": 1, "catalogue_review_recommended": "flag", "qc_length_delta": None, "qc_length_zscore": 2, "qc_gc_pct": 1, "qc_gc_deviation": 1, "qc_n_count": None, "qc_internal_stops": None,
    "qc_internal_stops_placeholder_closed": None, "qc_coding_frame_used": None, "qc_length_mod3": None, "qc_length_profile_n": None, "placeholder_runs": None, "placeholder_bp": None, "placeholder_junction_support": None, "qc_flags": None,
    "remap_mean_depth": 1, "remap_breadth_pct": 1, "remap_pct_bases_lt5": 1, "uncertain_base_count": None, "uncertain_base_fraction": 4, "interior_uncertain_base_count": None, "interior_uncertain_base_fraction": 4,
    "internal_zero_depth_positions": None, "terminal_margin_bp": None, "span_clipped_bp": None, "span_clipped_start_bp": None, "span_clipped_end_bp": None, "span_continuation_contig": None, "span_continuation_bp": None,
    "span_continuation_overlap_bp": None, "mean_base_quality": 1, "mean_mapping_quality": 1, "strand_balance_pct": 1, "candidate_mixed_sites": None, "mixed_site_count": None, "strand_biased_sites": None, "reference_discordant_sites": None,
    "max_alt_fraction": 4, "median_mixed_fraction": 4, "mixture_detected": "flag", "bitscore_margin": 1, "elapsed_sec": None, "allele_file": None, "message": None,
}
# Columns that a row without quality control fills too, and those whose empty cell is 0.
ALWAYS = ("sample_id", "status", "workflow_status", "result_disposition", "locus", "tool_version", "run_date", "allele_length", "nearest_allele", "best_identity_pct", "contigs_hit", "target_regions", "extracted_read_names", "spades_mode", "mapped_reads", "qc_confidence", "sequence_confidence", "qc_flags", "span_clipped_bp", "span_clipped_start_bp", "span_clipped_end_bp", "span_continuation_contig", "span_continuation_bp", "span_continuation_overlap_bp", "elapsed_sec", "allele_file", "message")
ZERO = ("allele_length", "contigs_hit", "target_regions", "extracted_read_names", "mapped_reads", "span_clipped_bp", "span_clipped_start_bp", "span_clipped_end_bp", "span_continuation_bp", "span_continuation_overlap_bp", "elapsed_sec")


def batch_report(results: DataFrame) -> DataFrame:
    """The report's 65 columns as text, in order; columns that the results lack are empty.

    Rows without a confidence (skipped or failed) have empty cells of quality
    control.  ``status`` and ``workflow_status`` are one value, FAIL where the
    results have none, and a missing disposition follows from status and tier.
    """
    have = set(results.columns)
    c = lambda n: F.col(n) if n in have else F.lit(None).cast("string")
    judged = F.coalesce(c("qc_confidence"), F.lit("")) != ""
    status = F.coalesce(c("workflow_status"), c("status"), F.lit("FAIL"))
    given = {"status": status, "workflow_status": status, "result_disposition": F.coalesce(F.when(c("result_disposition") != "", c("result_disposition")), disposition(status, F.coalesce(c("qc_confidence"), F.lit("")))), "sequence_confidence": F.coalesce(c("sequence_confidence"), c("qc_confidence"))}
    out = []
    for name, decimals in REPORT.items():
        v = given.get(name, c(name))
        if decimals == "flag":
            v = F.when(F.coalesce(v.cast("boolean"), F.lit(False)), "true").otherwise("false")
        elif isinstance(decimals, int):
            filled = v.cast("double") if name == "best_identity_pct" else F.coalesce(v.cast("double"), F.lit(0.0))
            v = F.when(filled != 0, F.format_string(f"%.{decimals}f", filled)) if name == "best_identity_pct" else F.format_string(f"%.{decimals}f", filled)
        elif name in ZERO:
            v = F.coalesce(v.cast("string"), F.lit("0"))
        out.append(F.coalesce(v.cast("string") if name in ALWAYS else F.when(judged, v.cast("string")), F.lit("")).alias(name))
    return results.select(*out)


def _tsv(df: DataFrame, path: str) -> None:
    df.write.option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").csv(path)


def write_batch_report(results: DataFrame, path: str) -> None:
    _tsv(batch_report(results), path)


def write_report(df: DataFrame, path: str) -> None:
    """Any columns, flattened."""
    _tsv(flat(df), path)


def support_rows(support: DataFrame) -> DataFrame:
    """The columns of a support table as text: numbers to six digits, booleans in lower case."""
    kinds = {f.name: f.dataType.typeName() for f in support.schema.fields}
    return support.select(*[F.coalesce(general(F.col(c), 6) if kinds[c] in ("double", "float") else F.col(c).cast("string"), F.lit("")).alias(c) for c in SUPPORT_COLUMNS])


def general(value: Column, digits: int) -> Column:
    """A number to so many significant digits without trailing zeros; an exponent below 1e-4 and from 10 ** digits on."""
    size = F.floor(F.log10(F.abs(F.format_string(f"%.{digits - 1}e", value.cast("double")).cast("double"))))
    bare = lambda t: F.regexp_replace(F.regexp_replace(t, r"(\.[0-9]*?)0+($|e)", "$1$2"), r"\.($|e)", "$1")
    fixed = F.lit(None).cast("string")
    for e in range(-4, digits):
        fixed = F.when(size == e, F.format_string(f"%.{digits - 1 - e}f", value.cast("double"))).otherwise(fixed)
    return F.when(value == 0, "0").when(size.between(-4, digits - 1), bare(fixed)).otherwise(bare(F.format_string(f"%.{digits - 1}e", value.cast("double"))))


def write_support(support: DataFrame, path: str) -> None:
    _tsv(support_rows(support), path)


def path_records(paths: DataFrame, prefix: str = "graph_path") -> DataFrame:
    """FASTA records of graph paths (place, seq, depth, path: array of oriented nodes) with their facts in the header."""
    head = F.concat(F.lit(f">{prefix}_"), F.col("place").cast("string"), F.lit(" length="), F.length("seq").cast("string"), F.lit(" mean_graph_depth="), F.format_string("%.2f", F.col("depth").cast("double")), F.lit(" nodes="), F.array_join("path", ","))
    return paths.select("place", F.concat(head, F.lit("\n"), F.regexp_replace("seq", "(.{80})(?=.)", "$1\n")).alias("value"))


def write_paths(paths: DataFrame, folder: str, prefix: str = "graph_path") -> None:
    """FASTA of the paths in their order, and a table of name, length, depth and nodes."""
    path_records(paths, prefix).orderBy("place").select("value").write.text(f"{folder}/fasta")
    _tsv(paths.select(F.concat(F.lit(f"{prefix}_"), F.col("place").cast("string")).alias("path"), F.length("seq").alias("length"), F.format_string("%.2f", F.col("depth").cast("double")).alias("mean_graph_depth"), F.array_join("path", ",").alias("nodes")), f"{folder}/table")


ROLES = {"PASS": "accepted", "REVIEW": "review"}


def catalogue_roles(results: DataFrame) -> DataFrame:
    """Results with a sequence that succeeded, once with their role and once among all candidates."""
    done = results.filter((F.col("workflow_status") == "SUCCESS") & F.col("seq").isNotNull())
    mine = F.coalesce(F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])[F.col("result_disposition")], F.lit("hold"))
    return done.withColumn("role", F.explode(F.array(mine, F.lit("all_candidates"))))


def write_catalogue(results: DataFrame, path: str) -> DataFrame:
    """One folder of FASTA records per role, and all candidates; returns (role, path, count) of all four roles.

    ``results``: seq_id, seq, workflow_status, result_disposition.
    """
    rows = catalogue_roles(results)
    rows.select(wrapped("seq_id", "seq").alias("value"), "role").write.partitionBy("role").text(path)
    spark = results.sparkSession
    roles = spark.createDataFrame([(r,) for r in (*ROLES.values(), "hold", "all_candidates")], "role string")
    counts = rows.groupBy("role").agg(F.count(F.lit(1)).alias("count"))
    return roles.join(counts, "role", "left").select("role", F.concat(F.lit(f"{path}/role="), F.col("role")).alias("path"), F.coalesce("count", F.lit(0)).alias("count"))
