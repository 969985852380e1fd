"""Session helpers of the text operators: shared scratch tables and document keys."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.llm.kernels import NULL_ID

#: Lets a write's shuffle files go when it ends; without it they stay until the driver's JVM collects its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_open: list[list[Scratch]] = []


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``.

    Where that setting is absent a folder of this machine is chosen, and
    recorded in the session so that later calls agree on it; only a local
    master, whose executors are this process, may do so.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        found = spark.conf.get("spark.strandloom.scratch", None)
    if not found:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="strandloom-")
        spark.conf.set("spark.strandloom.scratch", found)
    return found


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


class Scratch:
    """Parquet tables in the shared folder, which cut lineage and survive lost executors.

    ``keep`` writes a frame and reads it back; ``drop`` deletes a table whose
    rows are no longer needed, and ``only`` all but those that a result still
    reads.  What a result reads stays until ``swept`` ends around the call, or
    else until the application ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.base, self.paths = spark, f"{scratch_dir(spark)}/strandloom-{uuid.uuid4().hex}", {}
        fs, path = _hadoop(spark, self.base)
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        for held in _open:
            held.append(self)

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.base}/{name}"
        schema = df.schema
        with cleaned(self.spark):
            df.write.parquet(path)
        self.paths[name] = path
        return self.spark.read.schema(schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            fs, path = _hadoop(self.spark, self.paths.pop(name))
            fs.delete(path, True)

    def only(self, *names: str) -> None:
        self.drop(*[x for x in self.paths if x not in names])

    def sweep(self) -> None:
        fs, path = _hadoop(self.spark, self.base)
        fs.delete(path, True)
        self.paths.clear()


@contextlib.contextmanager
def cleaned(spark: SparkSession) -> Iterator[None]:
    """Each query that runs inside deletes its shuffle files when it ends; frames made inside run as always after it."""
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


@contextlib.contextmanager
def swept() -> Iterator[None]:
    """Delete, at the end, every scratch table made inside; write the results that are to stay before."""
    held: list[Scratch] = []
    _open.append(held)
    try:
        yield
    finally:
        _open.remove(held)
        for scratch in held:
            scratch.sweep()


def key(name: str) -> Column:
    """A document id as a long; a null id counts as greater than every other."""
    return F.coalesce(F.col(name).cast("long"), F.lit(NULL_ID))


def ids_are_unique(docs: DataFrame, doc_id: str) -> bool:
    """Whether every row has an id of its own."""
    return docs.groupBy(F.col(doc_id).cast("long").alias("id")).agg(F.count(F.lit(1)).alias("k")).filter("id is null or k > 1").isEmpty()


def parallelism(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), 1)
