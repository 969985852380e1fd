"""Incremental, reversible line dedup: sharded cuckoo filters over exact reference counts.

A line's key is a 128-bit digest of its stripped, lower-cased bytes.  The index
is a folder of Parquet tables that updates append to, each under its number:

``postings``   which document holds which key;
``totals``     for every key that the update touched, how many documents hold
               it from then on and the smallest of them (the exact counts);
``filters``    the shards' cuckoo filters after the update;
``documents``  the documents that the update put in or took out.

An insertion asks the filters first.  Most lines of a corpus are new, and what
a filter has not seen is certainly new: it gets its count without reading the
totals.  Only hits are looked up, which also tells false hits; then every key
that is really new is put into its filter.  A deletion counts the remaining
holders of the keys it touches, and keys without any leave their filter.  An
update that was cut off is done again under the same number: its filters are
written last, and only updates with filters count.

Lines are dropped by joining postings to the keys of two documents or more.
Keys with over a thousandth of all postings, no more than a thousand keys, are
broadcast; the others are few enough each to meet in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.llm.common import Scratch, ids_are_unique, key, parallelism
from strandloom.llm.cuckoo import STREAM, passing

BLANK = b" \t\n\x0b\x0c\r"
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Keys a shard is made for, and the share of a filter's slots that these fill.
SHARD_KEYS, LOAD = 1 << 18, 0.75
#: Keys with over 1/HEAVY of all postings are broadcast; there are fewer than HEAVY.
HEAVY = 1000
#: Touched keys that a deletion may broadcast (16 bytes each and their overhead).
MAX_BROADCAST = 200_000
#: Bytes of text after which a batch of results is handed on.
PIECE = 4 << 20

_TABLES = {
    "postings": "h1 long, h2 long, doc long",
    "totals": "h1 long, h2 long, n long, least long, fresh boolean",
    "filters": "shard int, gen int, slots binary, buckets int, shards int",
    "documents": "doc long, held boolean",
}


def digests(text: bytes, least: int) -> list[bytes]:
    """The key of every line, empty for a line of under ``least`` code points."""
    out = []
    for line in text.split(b"\n"):
        k = line.strip(BLANK)
        # A code point has four bytes at most.
        long = len(k) >= 4 * least or len(k) >= least and len(k.decode("utf-8", "replace")) >= least
        out.append(hashlib.blake2b(k.translate(LOWER), digest_size=16).digest() if long else b"")
    return out


def _texts(column: pa.Array) -> list[bytes]:
    return pc.fill_null(column.cast(pa.large_binary()), b"").to_pylist()


def _postings(least: int):
    """(h1, h2, doc) of the distinct keys of each row (doc, text)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs = b.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(b), 256):
                found = [sorted(set(digests(t, least)) - {b""}) for t in _texts(b.column(1).slice(at, 256))]
                h = np.frombuffer(b"".join(x for f in found for x in f), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(np.repeat(docs[at : at + 256], [len(f) for f in found]))], names=["h1", "h2", "doc"])

    return read


def _without(least: int):
    """(doc_id, n_lines, n_dropped, kept_sha256, kept) of rows (doc_id, text, keys to drop)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lo, size = 0, 0
            lines, dropped, kept = [], [], []

            def made(hi: int) -> pa.RecordBatch:
                columns = [b.column(0).slice(lo, hi - lo), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())]
                return pa.RecordBatch.from_arrays([*columns, pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()), pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_lines", "n_dropped", "kept_sha256", "kept"])

            for i in range(len(b)):
                text = _texts(b.column(1).slice(i, 1))[0]
                gone = b.column(2)[i]
                if gone.is_valid:
                    pairs = gone.values
                    taken = {x.tobytes() for x in np.stack([pairs.field(0).to_numpy(), pairs.field(1).to_numpy()], 1).astype("<i8")}
                    parts = text.split(b"\n")
                    stay = [x for x, d in zip(parts, digests(text, least), strict=True) if d not in taken]
                    lines.append(len(parts))
                    dropped.append(len(parts) - len(stay))
                    text = b"\n".join(stay)
                else:
                    lines.append(text.count(b"\n") + 1)
                    dropped.append(0)
                kept.append(text)
                size += len(text)
                if size > PIECE:
                    yield made(i + 1)
                    lo, size, lines, dropped, kept = i + 1, 0, [], [], []
            if lo < len(b):
                yield made(len(b))

    return read


class LineIndex:
    """The keys of the lines of a growing and shrinking set of documents, in a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, path: str, least: int = 10):
        self.spark, self.path, self.least = spark, path, least
        self.scratch = Scratch(spark)
        for name, schema in _TABLES.items():  # every table has a folder, so that all can be read
            spark.createDataFrame([], schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}/t=0")
        done = spark.read.schema(f"{_TABLES['filters']}, t int").parquet(f"{path}/filters")
        last = done.orderBy(F.desc("t")).select("t", "buckets", "shards").first()
        self.version, self.buckets, self.shards = tuple(last) if last else (0, 0, 0)

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.schema(f"{_TABLES[name]}, t int").parquet(f"{self.path}/{name}").filter(F.col("t") <= self.version)

    def _write(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.path}/{name}/t={self.version + 1}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(_TABLES[name]).parquet(path)

    def held(self) -> DataFrame:
        """doc: the documents in the index."""
        return self._read("documents").groupBy("doc").agg(F.max_by("held", "t").alias("held")).filter("held").select("doc")

    def totals(self) -> DataFrame:
        """h1, h2, n, least: how many documents hold a key now, and the smallest of them."""
        last = self._read("totals")
        if self.version > 1:
            last = last.groupBy("h1", "h2").agg(F.max_by(F.struct("n", "least"), "t").alias("x")).select("h1", "h2", "x.n", "x.least")
        return last.filter("n > 0").select("h1", "h2", "n", "least")

    def postings(self) -> DataFrame:
        """h1, h2, doc of the documents in the index."""
        out = self._read("postings")
        gone = self._read("documents").filter("not held").groupBy("doc").agg(F.max("t").alias("gone"))
        if not gone.isEmpty():
            out = out.join(gone, "doc", "left").filter("gone is null or t > gone")
        return out.select("h1", "h2", "doc")

    def _filters(self, keys: DataFrame, action: str, schema: str) -> DataFrame:
        """Take keys (h1, h2, n, least) through the filters of their shards; a task works through several shards."""
        if self.version:
            now = self._read("filters").filter(F.col("t") == self.version)
        else:
            now = self.spark.range(self.shards).select(F.col("id").cast("int").alias("shard"), F.lit(0).alias("gen"), F.lit(None).cast("binary").alias("slots"))
        columns = [c.split()[0] for c in STREAM.split(", ")]
        nothing = lambda names: [F.lit(None).cast("long").alias(c) for c in names]
        shard = F.col("h1").bitwiseAND(F.lit(self.shards - 1)).cast("int").alias("shard")
        stream = now.select("shard", "gen", "slots", *nothing(columns[3:])).unionByName(keys.select(shard, F.lit(None).cast("int").alias("gen"), F.lit(None).cast("binary").alias("slots"), "h1", "h2", "n", "least"))
        tasks = min(self.shards, parallelism(self.spark))
        dealt = stream.repartitionById(tasks, F.pmod("shard", F.lit(tasks))).sortWithinPartitions("shard", F.col("gen").asc_nulls_last())
        return dealt.mapInArrow(passing(self.buckets, action), schema)

    def _changed(self, keys: DataFrame, action: str, documents: DataFrame) -> None:
        self._write("documents", documents)
        after = self._filters(keys, action, "shard int, gen int, slots binary")
        self._write("filters", after.withColumn("buckets", F.lit(self.buckets)).withColumn("shards", F.lit(self.shards)))
        self.version += 1
        self.scratch.only()

    def insert(self, docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> None:
        """Add documents.  Rows of one id, or without one, are one document; ids that the index holds are left as they are."""
        new = docs.select(key(doc_id).alias("doc"), F.col(text).cast("string").alias("text"))
        if self.version:
            # Ids alone say whether there is anything to leave out; texts are shuffled only then.
            again = new.select("doc").distinct().join(self.held(), "doc")
            new = new if again.isEmpty() else new.join(again, "doc", "left_anti")
        found = new.mapInArrow(_postings(self.least), "h1 long, h2 long, doc long")
        postings = self._write("postings", found if ids_are_unique(docs, doc_id) else found.distinct())
        batch = postings.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("least"))
        if not self.version:
            count = postings.count()
            self.shards = 1 << max(0, (max(4 * parallelism(self.spark), -(-count // SHARD_KEYS)) - 1).bit_length())
            self.buckets = 1 << max(4, (int(count / self.shards / 4 / LOAD)).bit_length())
            merged = batch.withColumn("fresh", F.lit(True))
        else:
            tested = self.scratch.keep("tested", self._filters(batch, "test", "h1 long, h2 long, n long, least long, hit boolean"))
            hits = tested.filter("hit").drop("hit")
            before = self._read("totals").join(hits.select("h1", "h2"), ["h1", "h2"], "left_semi").groupBy("h1", "h2").agg(F.max_by(F.struct("n", "least"), "t").alias("x")).filter("x.n > 0").select("h1", "h2", F.col("x.n").alias("n0"), F.col("x.least").alias("least0"))
            looked = hits.join(before, ["h1", "h2"], "left").select("h1", "h2", (F.col("n") + F.coalesce("n0", F.lit(0))).alias("n"), F.least("least", "least0").alias("least"), F.col("n0").isNull().alias("fresh"))
            merged = tested.filter("not hit").drop("hit").withColumn("fresh", F.lit(True)).unionByName(looked)
        totals = self._write("totals", merged)
        self._changed(totals.filter("fresh"), "add", new.select("doc").distinct().withColumn("held", F.lit(True)))

    def delete(self, ids: DataFrame, doc_id: str = "doc_id") -> None:
        """Take documents out, as if they had never been in; ids that the index does not hold are passed over."""
        if not self.version:
            return
        gone = self.scratch.keep("gone", ids.select(key(doc_id).alias("doc")).distinct().join(self.held(), "doc", "left_semi"))
        now = self.postings()
        touched = self.scratch.keep("touched", now.join(gone, "doc", "left_semi").select("h1", "h2").distinct())
        stay = now.join(gone, "doc", "left_anti")
        few = touched.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST
        if few:
            stay = stay.join(F.broadcast(touched), ["h1", "h2"], "left_semi")
        # Counted before they meet the touched keys: a key of very many documents arrives as one row a task.
        left = stay.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("least"))
        after = touched.join(left, ["h1", "h2"], "left").select("h1", "h2", F.coalesce("n", F.lit(0)).alias("n"), "least", F.lit(False).alias("fresh"))
        self._write("postings", self.spark.createDataFrame([], _TABLES["postings"]).coalesce(1))
        totals = self._write("totals", after)
        self._changed(totals.filter("n = 0"), "remove", gone.withColumn("held", F.lit(False)))

    def repeated(self) -> DataFrame:
        """doc and the keys it loses: those that a document with a smaller id holds too; documents that lose none have no row."""
        totals = self.totals()
        every = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        shared = self.scratch.keep("shared", totals.filter("n > 1"))
        heavy = F.broadcast(shared.filter(F.col("n") * HEAVY > every).select("h1", "h2", "least"))
        light = shared.filter(F.col("n") * HEAVY <= every).select("h1", "h2", "least")
        now, on = self.postings(), ["h1", "h2"]
        met = now.join(heavy, on).unionByName(now.join(heavy.select(*on), on, "left_anti").join(light, on))
        return met.filter("doc <> least").groupBy("doc").agg(F.collect_list(F.struct("h1", "h2")).alias("gone"))

    def apply(self, docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
        """Rows of documents without the lines they lose: doc_id, n_lines, n_dropped, kept_sha256, kept."""
        return _stripped(docs, self.repeated(), self.least, text, doc_id)


def _stripped(docs: DataFrame, repeated: DataFrame, least: int, text: str, doc_id: str) -> DataFrame:
    base = docs.select(F.col(doc_id).alias("doc_id"), key(doc_id).alias("doc"), F.col(text).cast("string").alias("text"))
    id_type = docs.schema[doc_id].dataType.simpleString()
    return base.join(repeated, "doc", "left").select("doc_id", "text", "gone").mapInArrow(_without(least), f"doc_id {id_type}, n_lines long, n_dropped long, kept_sha256 string, kept string")


def line_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least: int = 10, increments: int = 2) -> DataFrame:
    """Every document without the lines that a document with a smaller id holds too.

    Returns doc_id, n_lines (before), n_dropped, kept_sha256 and kept, one row
    per input row.  The documents go into an index of their own in the given
    number of increments, as a corpus that grows would; the number does not
    change the result.

    Lines whose key has under ``least`` code points always stay, and so do all
    lines of the smallest document that holds a key, repeats included.  Null
    or empty text: one empty line.  Rows that share an id, or that have none,
    are one document, and rows without an id come after all others.  An empty
    table gives an empty result.  Other columns are not read.
    """
    scratch = Scratch(docs.sparkSession)
    path = f"{scratch.base}/index"
    scratch.paths["index"] = path
    index = LineIndex(docs.sparkSession, path, least)
    for i in range(increments):
        index.insert(docs.filter(F.pmod(F.xxhash64(key(doc_id)), F.lit(increments)) == i), text, doc_id)
    repeated = scratch.keep("repeated", index.repeated())
    scratch.only("repeated")
    index.scratch.only()
    return _stripped(docs, repeated, least, text, doc_id)
