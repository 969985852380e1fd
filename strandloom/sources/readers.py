"""Text formats of sequence evidence as typed DataFrames."""

from __future__ import annotations

import json

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

HITS_13 = "qseqid string, sseqid string, qstart int, qend int, sstart int, send int, length int, pident double, qcovhsp double, bitscore double, evalue double, qlen int, slen int"
HITS_11 = HITS_13.rsplit(", qlen", 1)[0]
HITS_8 = "sseqid string, pident double, length int, qstart int, qend int, sstart int, send int, bitscore double"
HITS_9 = "qseqid string, sseqid string, length int, pident double, qcovs double, bitscore double, qlen int, slen int, evalue double"
DEPTH = "contig string, pos long, depth int"
IDXSTATS = "ref string, length long, mapped long, unmapped long"
PILEUP = "contig string, position long, reference_base string, depth int, read_bases string, base_qualities string, mapping_qualities string"


def table(spark: SparkSession, path: str, schema: str, malformed: str = "fail", header: bool = False) -> DataFrame:
    """A tab-separated table without quoting.

    A row whose values do not fit the schema fails the read.  ``malformed`` may
    instead be "skip", which leaves such rows out, as hit tables of a first
    search ask for, or "keep", which adds the column ``malformed`` (the whole
    line, null for a good row).
    """
    modes = {"fail": "FAILFAST", "skip": "DROPMALFORMED", "keep": "PERMISSIVE"}
    read = spark.read.schema(f"{schema}, malformed string" if malformed == "keep" else schema).option("columnNameOfCorruptRecord", "malformed")
    return read.option("sep", "\t").option("quote", "").option("escape", "").option("mode", modes[malformed]).option("header", header).csv(path)


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """seq_id (first word of the header), description, seq (upper case), path and ord.

    ``ord`` orders the records of a file; it comes from where the file was
    split, so it is the same for every reading with the same split size.
    """
    raw = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", r"^>|\s+$", "").alias("record"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    parts = F.split("record", "\n", 2)
    return raw.filter("record <> ''").select(F.split(parts[0], r"\s")[0].alias("seq_id"), F.regexp_replace(parts[0], r"^\S+\s*", "").alias("description"), F.upper(F.regexp_replace(F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("")), r"\s", "")).alias("seq"), "path", F.struct("block", "row").alias("ord"))


def sequence_count(sequences: DataFrame) -> DataFrame:
    """Records per file; a file without one is absent."""
    return sequences.groupBy("path").agg(F.count(F.lit(1)).alias("records"))


def total_length(sequences: DataFrame) -> DataFrame:
    """Bases per file."""
    return sequences.groupBy("path").agg(F.sum(F.length("seq")).alias("total_length"))


def first_sequence(sequences: DataFrame) -> DataFrame:
    """The first record of each file, by one aggregation; a file without one is absent."""
    first = F.min_by(F.struct("seq_id", "description", "seq"), "ord")
    return sequences.groupBy("path").agg(first.alias("r")).select("path", "r.*")


def sequence_lengths(sequences: DataFrame) -> DataFrame:
    """Length per id; of repeated ids the last."""
    return sequences.groupBy("seq_id").agg(F.max_by(F.length("seq"), "ord").alias("length"))


def subsequence(sequences: DataFrame, seq_id: str, start0: int, end0: int) -> DataFrame:
    """The bases start0..end0 (0-based, half open) of one sequence; bounds outside it raise."""
    ok = (F.lit(start0) >= 0) & (F.lit(end0) <= F.length("seq")) & (F.lit(start0) <= F.lit(end0))
    return sequences.filter(F.col("seq_id") == seq_id).select("seq_id", F.when(ok, F.substr("seq", F.lit(start0 + 1), F.lit(end0 - start0))).otherwise(F.raise_error(F.lit("region outside the sequence")).cast("string")).alias("seq"))


def has_records(spark: SparkSession, path: str) -> bool:
    """Whether a plain or gzipped FASTQ file holds a record; a file that is missing or cannot be read holds none."""
    try:
        return not spark.read.text(path).filter("value <> ''").limit(1).isEmpty()
    except (PySparkException, Py4JJavaError):
        return False


def fastq(spark: SparkSession, path: str) -> DataFrame:
    """Records of FASTQ files: path, record (0, 1, ...), name, seq, quality, problem.

    A record is four lines, so lines are numbered per file: one window per
    file, as a gzipped file is one task anyway.  ``problem`` is null, or says
    that a file ends within the record, which then has what there is of it.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("at"), "value")
    numbered = lines.withColumn("n", F.row_number().over(Window.partitionBy("path").orderBy("at")) - 1)
    part = lambda i: F.max(F.when(F.col("n") % 4 == i, F.col("value")))
    out = numbered.groupBy("path", F.floor(F.col("n") / 4).alias("record")).agg(part(0).alias("name"), part(1).alias("seq"), part(3).alias("quality"), F.count(F.lit(1)).alias("lines"))
    return out.select("path", "record", F.regexp_replace(F.split("name", r"\s")[0], "^@", "").alias("name"), "seq", "quality", F.when(F.col("lines") < 4, "incomplete record").alias("problem"))


def fastq_stats(reads: DataFrame) -> DataFrame:
    """Complete reads, their bases and mean length per file."""
    return reads.filter("problem is null").groupBy("path").agg(F.count(F.lit(1)).alias("reads"), F.sum(F.length("seq")).alias("bases"), F.avg(F.length("seq")).alias("mean_length"))


def every_kth(reads: DataFrame, step: int) -> DataFrame:
    """Records 0, step, 2 step, ... of each file; mates in two files stay in step."""
    return reads.filter(F.col("record") % step == 0)


def sample_sheet(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the sheet, paths made absolute from the sheet's folder, with ``problem``: null, or why the row cannot be used.

    Blank lines, lines that start with # and lines of column names before the
    first row of their file are left out; further down such a line is a row.
    Ids that repeat are a problem of every row that has them.
    """
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    every = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), place.alias("at")).filter("trim(value) <> '' and trim(value) not like '#%'")
    every = every.withColumn("named", F.lower(F.trim(F.split("value", "\t")[0])) == "sample_id")
    first = every.filter("not named").groupBy("file").agg(F.min("at").alias("first"))
    body = every.join(F.broadcast(first), "file", "left").filter("not named or at > first")
    raw = body.select(F.split("value", "\t").alias("c"), F.regexp_replace("file", "[^/]*$", "").alias("folder"))
    cell = lambda i: F.trim(F.coalesce(F.try_element_at("c", F.lit(i)), F.lit("")))
    rows = raw.select(cell(1).alias("sample_id"), *[cell(i + 2).alias(n) for i, n in enumerate(("assembly", "r1", "r2"))], F.size("c").alias("cells"), "folder")
    twice = rows.groupBy(F.col("sample_id").alias("id")).agg((F.count(F.lit(1)) > 1).alias("twice"))
    problem = (
        F.when(F.col("cells") != 4, "not four columns")
        .when(~F.col("sample_id").rlike(r"^[A-Za-z0-9][A-Za-z0-9._-]*$"), "unsafe id")
        .when(F.col("twice"), "repeated id")
        .when((F.col("assembly") == "") | (F.col("r1") == "") | (F.col("r2") == ""), "empty path")
    )
    absolute = lambda c: F.when(F.col(c).rlike("^([A-Za-z][A-Za-z0-9+.-]*:|/)") | (F.col(c) == ""), F.col(c)).otherwise(F.concat("folder", c))
    return rows.join(twice, F.col("sample_id") == F.col("id")).select("sample_id", *[absolute(c).alias(c) for c in ("assembly", "r1", "r2")], problem.alias("problem"))


def missing_inputs(spark: SparkSession, sheet: DataFrame, listing: DataFrame) -> DataFrame:
    """The sheet with ``problem`` also for files that are absent or empty; ``listing``: path, length (``binaryFile`` leaves empty files out)."""
    bare = lambda c: F.regexp_replace(c, "^file:/*", "/")
    files = listing.select(bare(F.col("path")).alias("path"), "length").distinct()
    wanted = sheet.select("sample_id", F.explode(F.array("assembly", "r1", "r2")).alias("p")).withColumn("path", bare(F.col("p"))).join(files, "path", "left")
    bad = wanted.groupBy("sample_id").agg(F.min(F.when(F.coalesce("length", F.lit(0)) == 0, F.concat(F.lit("missing or empty file: "), F.col("p")))).alias("file_problem"))
    return sheet.join(bad, "sample_id", "left").withColumn("problem", F.coalesce("problem", "file_problem")).drop("file_problem")


def gfa(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(segments, edges) of an assembly graph; every link comes with its mirror.

    A short record, a segment without bases, an overlap that is not a number
    with M, an orientation other than + and -: each raises when it is read.
    ``graph_problems`` finds what needs both tables.
    """
    lines = spark.read.text(path).filter("trim(value) <> '' and value not like '#%'").select(F.split("value", "\t").alias("c"), "value")
    sound = lambda ok, what, then: F.when(F.coalesce(ok, F.lit(False)), then).otherwise(F.raise_error(F.concat(F.lit(what + ": "), F.substring("value", 1, 200))))
    cell = lambda i: F.try_element_at("c", F.lit(i + 1))
    # Tags from the fourth cell on; the first depth counts.
    tag = F.try_element_at(F.filter("c", lambda x: F.startswith(x, F.lit("DP:f:"))), F.lit(1))
    segments = lines.filter(F.col("c")[0] == "S").select(cell(1).alias("seg_id"), sound(cell(2).isNotNull() & (cell(2) != "*"), "a segment without bases", F.upper(cell(2))).alias("seq"), F.coalesce(F.substr(tag, F.lit(6)).try_cast("double"), F.lit(0.0)).alias("depth"))
    signs = cell(2).isin("+", "-") & cell(4).isin("+", "-")
    overlap = F.regexp_extract(cell(5), r"^([0-9]+)M$", 1).try_cast("int")
    links = lines.filter(F.col("c")[0] == "L").select(cell(1).alias("src"), sound(signs, "a link without orientations", cell(2)).alias("src_o"), cell(3).alias("dst"), cell(4).alias("dst_o"), sound(overlap.isNotNull(), "a link whose overlap is not a number of matches", overlap.cast("string")).cast("int").alias("overlap"))
    flip = lambda c: F.translate(c, "+-", "-+")
    mirror = links.select(F.col("dst").alias("src"), flip("dst_o").alias("src_o"), F.col("src").alias("dst"), flip("src_o").alias("dst_o"), "overlap")
    return segments, links.unionByName(mirror).distinct()


def graph_problems(segments: DataFrame, edges: DataFrame) -> DataFrame:
    """Segments that repeat an id and links to segments that are not there: (name, problem); empty for a sound graph."""
    twice = segments.groupBy("seg_id").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select(F.col("seg_id").alias("name"), F.lit("repeated segment").alias("problem"))
    ends = edges.select(F.explode(F.array("src", "dst")).alias("name")).distinct()
    return twice.unionByName(ends.join(segments.select(F.col("seg_id").alias("name")), "name", "left_anti").select("name", F.lit("undefined segment").alias("problem")))


def flagstat(text: str | Column) -> Column:
    """Struct of totals and the mapped percentage of a flagstat text; counts that it does not hold are null."""
    t = F.lit(text) if isinstance(text, str) else text
    part = lambda p: F.regexp_extract(t, p, 1).try_cast("long")
    total, mapped = part(r"(\d+) \+ \d+ in total"), part(r"(\d+) \+ \d+ mapped")
    return F.struct(total.alias("total"), mapped.alias("mapped"), F.when(total > 0, F.lit(100.0) * mapped / total).otherwise(0.0).alias("mapped_pct"), part(r"(\d+) \+ \d+ properly paired").alias("properly_paired"))


def flagstat_of(alignments: DataFrame, by: list[str], flag: str = "flag") -> DataFrame:
    """The same totals from the flags of alignment rows."""
    bit = lambda b: F.col(flag).bitwiseAND(b) != 0
    primary = ~bit(0x900)
    total, mapped = F.count(F.lit(1)), F.count_if(~bit(0x4))
    return alignments.groupBy(*by).agg(total.alias("total"), mapped.alias("mapped"), (F.lit(100.0) * mapped / total).alias("mapped_pct"), F.count_if(primary & bit(0x1) & bit(0x2) & ~bit(0x4)).alias("properly_paired"))


def annotated_entries(headers: DataFrame, order: str = "ord") -> DataFrame:
    """Records of an annotated genome (seq_id, description, ``order``) with their fields, in the order of replicons and starts (``place``).

    Fields are ``[key=value]`` parts, of a repeated key the last.  The replicon
    is the id without its type and number; replicons are in the order of their
    first record.  A location spans from its least to its greatest position.
    """
    pairs = F.transform(F.regexp_extract_all("description", F.lit(r"\[\w+=[^\]]*\]"), F.lit(0)), lambda p: F.struct(F.regexp_extract(p, r"^\[(\w+)=", 1).alias("key"), F.regexp_extract(p, r"^\[\w+=(.*)\]$", 1).alias("value")))
    field = lambda k: F.coalesce(F.try_element_at(F.filter("__f", lambda p: p["key"] == k), F.lit(-1))["value"], F.lit(""))
    kinds = "cds|rrna|trna|ncrna|tmrna|mrna|misc_rna|precursor_rna|miscrna"  # fixed values
    inner = F.regexp_extract("seq_id", rf"^lcl\|(.+?)_(?:{kinds})_", 1)
    spots = F.transform(F.regexp_extract_all("location", F.lit("[0-9]+"), F.lit(0)), lambda x: x.cast("long"))
    out = headers.withColumn("__f", pairs).withColumns({"replicon": F.when(inner != "", inner).otherwise(F.col("seq_id")), "location": field("location"), "gene": field("gene"), "product": F.when(field("protein") != "", field("protein")).otherwise(field("product")), "locus_tag": field("locus_tag"), "gbkey": field("gbkey"), "pseudo": field("pseudo") == "true"})
    out = out.withColumns({"start": F.coalesce(F.array_min(spots), F.lit(0)), "end": F.coalesce(F.array_max(spots), F.lit(0)), "strand": F.when(F.contains("location", F.lit("complement")), "-").otherwise("+"), "partial": F.col("location").rlike("[<>]")}).drop("__f")
    first = out.groupBy(F.col("replicon").alias("__r")).agg(F.min(order).alias("__first"))
    placed = out.join(first, F.col("replicon") == F.col("__r"))
    return placed.withColumn("place", F.row_number().over(Window.orderBy("__first", "start", order))).drop("__r", "__first")


# Columns of the two comparators' tables that are read.
ARIBA = "ref_name string, flag long, reads long, ref_len long, ref_base_assembled long, pc_ident double, ctg string, ctg_cov double, smtls_nts string"
KMA = "template string, score long, expected long, template_length long, template_identity double, template_coverage double, query_identity double, query_coverage double, depth double, q_value double, p_value double"


def ariba_calls(report: DataFrame, order: str) -> DataFrame:
    """Per reference of an ARIBA report: its first row in ``order``, rows, and rows with more than one nucleotide in the reads."""
    first = F.min_by(F.struct("flag", "reads", "ref_len", "ref_base_assembled", "pc_ident", "ctg_cov"), order)
    several = F.contains(F.coalesce("smtls_nts", F.lit("")), F.lit(","))
    return report.groupBy("ref_name").agg(first.alias("__f"), F.count(F.lit(1)).alias("rows"), F.count_if(several).alias("multi_nt_rows")).select("ref_name", "__f.*", "rows", "multi_nt_rows")


def kma_calls(result: DataFrame) -> DataFrame:
    """Rows of a KMA result with names and numbers free of padding; of a template that repeats, the row of the greatest score."""
    return result.withColumn("template", F.trim("template")).groupBy("template").agg(F.max_by(F.struct(*[c for c in result.columns if c != "template"]), "score").alias("r")).select("template", "r.*")


def json_paths(df: DataFrame, by: list[str], text: str) -> DataFrame:
    """One row per leaf of JSON texts of any depth: path (``a.b[0]``) and value as text; a null leaf has a null value.

    An Arrow function flattens each text by itself; texts that are no JSON give
    one row with an empty path and the text.
    """
    found = df.select(*by, F.explode(_leaves(text)).alias("x"))
    return found.select(*by, "x.path", "x.value")


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("path", T.StringType()), T.StructField("value", T.StringType())])))
def _leaves(texts: pd.Series) -> pd.Series:
    def walk(value, path):
        if isinstance(value, dict) and value:
            for k, v in value.items():
                yield from walk(v, f"{path}.{k}" if path else str(k))
        elif isinstance(value, list) and value:
            for i, v in enumerate(value):
                yield from walk(v, f"{path}[{i}]")
        else:
            yield {"path": path, "value": None if value is None else value if isinstance(value, str) else json.dumps(value)}

    def one(text):
        if text is None:
            return []
        try:
            return list(walk(json.loads(text), ""))
        except ValueError:
            return [{"path": "", "value": text}]

    return texts.map(one)


def digests(spark: SparkSession, path: str) -> DataFrame:
    """Path, size, time and SHA-256 of files; a file's content passes one task, up to 2 GB."""
    return spark.read.format("binaryFile").load(path).select("path", "length", "modificationTime", F.sha2("content", 256).alias("sha256"))
