"""A folder that the driver and all executors share, for tables and texts that a query writes and reads back."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from itertools import count

from pyspark.sql import DataFrame, SparkSession


def shared_base(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; without that setting, and only on a local master, this machine's temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.gettempdir()
    return base


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else has; what is written there stays."""
    return f"{shared_base(spark)}/{name}-{uuid.uuid4().hex}"


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the shared one, deleted when the application ends."""
    path = new_path(spark, "strandloom")
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(at)
    fs.deleteOnExit(at)
    return path


def keeper(spark: SparkSession) -> Callable[[str, DataFrame], DataFrame]:
    """A function that writes a frame below a shared folder and reads it back, for operators that take ``keep``."""
    folder, made = shared_folder(spark), count()

    def keep(name: str, df: DataFrame) -> DataFrame:
        path = f"{folder}/{next(made)}-{name}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return keep
