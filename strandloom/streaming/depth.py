"""File streams: per-base depth in position blocks, and sample sheets row by row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strandloom.sources.readers import DEPTH


def depth_blocks(spark: SparkSession, folder: str, block: int = 500) -> DataFrame:
    """Running sums per contig and block of the depth tables that arrive in a folder; the state is one row a block."""
    rows = spark.readStream.schema(DEPTH).option("sep", "\t").csv(folder)
    return rows.groupBy("contig", F.floor((F.col("pos") - 1) / block).alias("block")).agg(F.sum("depth").alias("total"), F.count(F.lit(1)).alias("positions"))


def on_sample_sheets(spark: SparkSession, folder: str, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Calls ``handle`` with the rows of newly arrived sheets; a batch may be repeated after a failure under the same number."""
    lines = spark.readStream.text(folder).filter("trim(value) <> '' and value not like '#%'")
    return lines.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
