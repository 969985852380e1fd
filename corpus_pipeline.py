"""A training corpus from ``documents``: quality, near duplicates, decontamination, personal data, mixing.

Each stage takes (spark, docs, sf_dir) and returns rows; its result is written
as Parquet in the shared folder and read again as the next stage's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.llm import decontam, jaccard, mixing, pii, quality
from strandloom.llm.common import Scratch, ids_are_unique, swept

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier of labelled documents accepts; a null text is judged as an empty one, and every row by its own text."""
    model = quality.fit(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, model, name="__score", decision="__predicted").filter("__predicted = 1").select(*COLUMNS)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near duplicates: that with the smallest id, a missing id being the greatest.

    Every row is judged by its own text, whether or not others share its id;
    of rows of a class that share the smallest id, that with the smallest hash
    stays.  Texts without words are in no class, so their rows stay.
    """
    unique = ids_are_unique(docs, "doc_id")
    rows = docs.select(*COLUMNS, F.col("doc_id").alias("__row"))
    if not unique:
        # Ids do not tell rows apart: a row key is written with the rows, so that every reading sees the same.
        rows = Scratch(spark).keep("rows", docs.select(*COLUMNS, F.monotonically_increasing_id().alias("__row")))
    classes = jaccard.jaccard_components(rows, doc_id="__row", size=5, percent=80)
    if unique:
        gone = classes.filter("doc_id <> component_id").select(F.col("doc_id").alias("__gone"))
    else:
        order = rows.select("__row", F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), F.xxhash64("text", "lang", "source", "n_chars").alias("c"), F.col("__row").alias("d")).alias("__order"))
        of = classes.filter("n_shingles > 0").select(F.col("doc_id").alias("__row"), F.col("component_id").alias("__class"))
        first = of.join(order, "__row").groupBy("__class").agg(F.min("__order")["d"].alias("__first"))
        gone = of.join(first, F.col("__row") == F.col("__first"), "left_anti").select(F.col("__row").alias("__gone"))
    return rows.join(gone, F.col("__row") == F.col("__gone"), "left_anti").select(*COLUMNS)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of which less than a twentieth of the words lies in benchmark windows, each judged by its own text.

    A null text has no words, so its row stays; rows without an id and rows
    that repeat one are judged alike; an empty benchmark removes nothing.
    """
    return decontam.uncontaminated(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), size=13, percent=5)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with personal data replaced by its kind in brackets and n_chars counted again; a null text stays null."""
    clean = pii.redact(docs.select(*COLUMNS))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: source, size in words, its source's size and target, and the words that the mix takes of it.

    A null text has no words and takes none; a null source is a source of its
    own; every row that repeats an id has its own result.
    """
    return mixing.taken(docs).select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_near_duplicates),
    ("decontamination", decontaminated),
    ("personal_data", without_personal_data),
    ("mixing", mixed),
]

#: Training a classifier has no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; of the scratch tables only the last stage's stays, as the result reads it."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        with swept():
            docs = scratch.keep(name, stage(spark, docs, sf_dir))
        scratch.only(name)
    return docs
