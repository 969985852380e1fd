"""Benchmark decontamination by a broadcast set of normalised n-grams.

Executors cut the benchmark into windows of ``size`` words with a 64-bit hash.
A slice of the windows is broadcast as sorted arrays.  A scan of the documents
hashes the word windows of each text in one vectorised pass, looks them up, and
verifies every hit word by word, so a hash collision never marks a word.
Documents are not shuffled.

A broadcast holds about ``MAX_WINDOWS`` windows.  A larger benchmark is cut
into slices of windows by hash, however its windows lie in its items; each
slice is scanned by itself and the hit positions of all slices are united per
document.  ``flagged`` adds the decision to whole rows, and ``without_spans``
removes the words that are hit from the texts.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.llm import kernels as K
from strandloom.llm.common import Scratch

#: Windows of one broadcast: about 130 bytes each, so 65 MB.
MAX_WINDOWS = 500_000
_WINDOW = "length int, hash long, words binary, item string"


def _window_hash(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive words."""
    prefix = np.zeros(len(hashes) + 1, K.U)
    np.cumsum(hashes * K._power("up", len(hashes)), out=prefix[1:])
    return K.mix(K.gram_hash(prefix, size), size)


def _worded(raw: np.ndarray, offsets: np.ndarray):
    """Lower-cased bytes, starts and ends of words, first word of each text, and the words' hashes."""
    low = K.LOWER[raw]
    start, end, first = K.words(low, offsets, K.ALNUM)
    return low, start, end, first, K.mix(K.span_hash(K.prefix_hash(low), start, end))


def _cut(size):
    """Items to the windows of their words."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, offsets = K.column(b, "text")
            items = b.column(b.schema.get_field_index("item")).to_pylist()
            for a, e, r, o in K.pieces(raw, offsets):
                low, start, end, first, hashes = _worded(r, o)
                data = low.tobytes()
                for i in range(e - a):
                    lo, hi = int(first[i]), int(first[i + 1])
                    m = min(size, hi - lo)
                    if not m:
                        continue
                    h = _window_hash(hashes[lo:hi], m).view(np.int64)
                    for at in range(0, len(h), 10_000):
                        part = range(lo + at, lo + min(at + 10_000, len(h)))
                        words = [b" ".join(data[start[k] : end[k]] for k in range(j, j + m)) for j in part]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(words), m, np.int32)), pa.array(h[at : at + len(words)]), pa.array(words, pa.binary()), pa.array([items[a + i]] * len(words), pa.string())],
                            names=["length", "hash", "words", "item"],
                        )

    return cut


class Windows:
    """A slice of the benchmark's windows as arrays sorted by length and hash."""

    def __init__(self, rows: list):
        rows = sorted(rows, key=lambda r: (r[0], r[1] & (1 << 64) - 1))
        self.names = sorted({r[3] for r in rows if r[3] is not None})
        place = {x: i for i, x in enumerate(self.names)}
        self.length = np.array([r[0] for r in rows], np.int32)
        self.hash = np.array([r[1] for r in rows], np.int64).view(K.U)
        self.item = np.array([-1 if r[3] is None else place[r[3]] for r in rows], np.int32)
        self.ends = np.cumsum([0, *(len(r[2]) for r in rows)])
        self.words = b"".join(bytes(r[2]) for r in rows)
        self._tables = None

    def tables(self) -> list:
        """Per length: (length, first entry, sorted hashes, bits by which most windows fall out); made once a worker."""
        if self._tables is None:
            self._tables = []
            for m in np.unique(self.length).tolist():
                lo, hi = np.searchsorted(self.length, [m, m + 1])
                bits = np.zeros(1 << 20, bool)
                bits[(self.hash[lo:hi] & K.U((1 << 20) - 1)).astype(np.int64)] = True
                self._tables.append((m, int(lo), self.hash[lo:hi], bits))
        return self._tables


def _scan(windows):
    """Texts to the words that the windows hit; other columns pass."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = windows.value
        for b in batches:
            raw, offsets = K.column(b, "text")
            n_words, hits, items = [], [], []
            for a, e, r, o in K.pieces(raw, offsets):
                low, start, end, first, hashes = _worded(r, o)
                doc = np.repeat(np.arange(e - a), np.diff(first))
                delta = np.zeros(len(hashes) + 1, np.int64)
                found: dict[int, set] = {}
                data = None
                for m, base, sorted_, bits in known.tables():
                    if len(hashes) < m:
                        continue
                    h = _window_hash(hashes, m)
                    at = np.flatnonzero(bits[(h & K.U((1 << 20) - 1)).astype(np.int64)])
                    at = at[doc[at] == doc[at + m - 1]]
                    lo, hi = np.searchsorted(sorted_, h[at], "left"), np.searchsorted(sorted_, h[at], "right")
                    some = lo < hi
                    for i, x, y in zip(at[some].tolist(), (lo[some] + base).tolist(), (hi[some] + base).tolist(), strict=True):
                        data = data if data is not None else low.tobytes()
                        here = b" ".join(data[start[k] : end[k]] for k in range(i, i + m))
                        same = [j for j in range(x, y) if known.words[known.ends[j] : known.ends[j + 1]] == here]
                        if same:
                            delta[i] += 1
                            delta[i + m] -= 1
                            found.setdefault(int(doc[i]), set()).update(int(known.item[j]) for j in same)
                marked = np.cumsum(delta[:-1]) > 0
                for d in range(e - a):
                    lo, hi = int(first[d]), int(first[d + 1])
                    mine = np.flatnonzero(marked[lo:hi]) if marked[lo:hi].any() else np.empty(0, np.int64)
                    n_words.append(hi - lo)
                    hits.append(mine.tolist())
                    items.append(sorted(known.names[x] for x in found.get(d, ()) if x >= 0))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(n_words, pa.int64()), pa.array(hits, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))], names=[*b.schema.names, "n_words", "hits", "items"])

    return scan


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without their runs of hit words and what lies between the words of a run."""
    for b in batches:
        raw, offsets = K.column(b, "text")
        hits = b.column(b.schema.get_field_index("hits")).to_pylist()
        out: list[str | None] = []
        for a, e, r, o in K.pieces(raw, offsets):
            _, start, end, first, _ = _worded(r, o)
            body = r.tobytes()
            for d in range(e - a):
                at, parts = int(o[d]), []
                hit = np.array(hits[a + d], np.int64)
                for run in np.split(hit, np.flatnonzero(np.diff(hit) > 1) + 1) if len(hit) else ():
                    parts.append(body[at : start[first[d] + run[0]]])
                    at = int(end[first[d] + run[-1]])
                out.append(b"".join([*parts, body[at : o[d + 1]]]).decode())
        where = b.schema.get_field_index("text")
        clean = pa.compute.if_else(b.column(where).is_null(), pa.scalar(None, pa.string()), pa.array(out, pa.string()))
        yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index("row")), clean], names=["row", "text"])


def _slices(benchmark: DataFrame, text: str, item_id: str, size: int, scratch: Scratch) -> Iterator[Windows]:
    """The distinct windows in slices of about MAX_WINDOWS; the driver holds one slice at a time."""
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(text).cast("string").alias("text"))
    windows = scratch.keep("windows", items.mapInArrow(_cut(size), _WINDOW).distinct())
    count = max(1, -(-windows.count() // MAX_WINDOWS))
    for i in range(count):
        rows = windows if count == 1 else windows.filter(F.pmod(F.xxhash64("length", "hash", "item"), F.lit(count)) == i)
        yield Windows([tuple(r) for r in rows.collect()])


def _found(packed: DataFrame, benchmark: DataFrame, item_id: str, item_text: str, size: int) -> DataFrame:
    """(row, text) with n_words, hits and items of every row."""
    spark = packed.sparkSession
    scratch = Scratch(spark)
    added = "n_words long, hits array<long>, items array<string>"
    slices = _slices(benchmark, item_text, item_id, size, scratch)
    first, second = next(slices), next(slices, None)
    kind = packed.schema["row"].dataType.simpleString()
    if second is None:
        scratch.drop("windows")
        return packed.mapInArrow(_scan(spark.sparkContext.broadcast(first)), f"row {kind}, text string, {added}")
    # Row numbers are written with the rows, so that the scans of all slices agree on them; a slice leaves the rows that it hits.
    rows = scratch.keep("rows", packed.withColumn("n", F.monotonically_increasing_id()))
    union = None
    for i, windows in enumerate(itertools.chain((first, second), slices)):
        held = spark.sparkContext.broadcast(windows)
        part = scratch.keep(f"slice{i}", rows.select("n", "text").mapInArrow(_scan(held), f"n long, text string, {added}").drop("text").filter(F.lit(i == 0) | (F.size("hits") > 0)))
        held.unpersist()
        union = part if union is None else union.unionByName(part)
    every = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
    merged = union.groupBy("n").agg(F.max("n_words").alias("n_words"), every("hits"), every("items"))
    scratch.drop("windows")
    return rows.join(merged, "n").select("row", "text", "n_words", "hits", "items")


def _packed(docs: DataFrame, text: str, *rest: Column) -> DataFrame:
    return docs.select(F.struct(*rest).alias("row"), F.col(text).cast("string").alias("text"))


def _contaminated(percent: int) -> Column:
    n_hit = F.size("hits").cast("long")
    return (n_hit > 0) & (n_hit * 100 >= F.col("n_words") * percent)


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id", item_text: str = "text", size: int = 13, percent: int = 5) -> DataFrame:
    """Words of each document that lie inside an occurrence of a benchmark window.

    A window is ``size`` consecutive words of an item; an item of fewer words,
    but not none, is one window.  Returns doc_id, n_words, n_hit, n_items,
    items (ids of items with occurring windows, as sorted strings),
    items_sha256, hits (positions of the hit words) and contaminated
    (n_hit > 0 and 100 * n_hit >= percent * n_words), one row per input row.

    Null texts and items have no words.  An item without an id still hits, but
    is not listed.  Repeated rows each get their own row; a null id is kept.
    An empty benchmark hits nothing; an empty table gives an empty result.
    Other columns are not read, whatever their names.
    """
    found = _found(_packed(docs, text, F.col(doc_id).alias("doc_id")), benchmark, item_id, item_text, size)
    return found.select(
        "row.doc_id",
        "n_words",
        F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        "items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "hits",
        _contaminated(percent).alias("contaminated"),
    )


def uncontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", size: int = 13, percent: int = 5) -> DataFrame:
    """The rows, with all their columns, that are not contaminated; each is judged by its own text.

    Null texts stay, as do rows without ids and those that repeat one.  An
    empty benchmark removes nothing.
    """
    found = _found(_packed(docs, text, *[F.col(f"`{c}`") for c in docs.columns]), benchmark, item_id, item_text, size)
    return found.filter(~_contaminated(percent)).select("row.*")


def without_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", size: int = 13) -> DataFrame:
    """All rows and columns, with the spans that benchmark windows cover removed from the texts.

    A span runs from the first to the last word of a run of hit words, with
    what stands between them; the text around it stays as it is.  Null texts
    stay null; ids are not read.
    """
    rest = [c for c in docs.columns if c != text]
    found = _found(_packed(docs, text, *[F.col(f"`{c}`") for c in rest] or [F.lit(1).alias("none")]), benchmark, item_id, item_text, size)
    clean = found.select("row", "text", "hits").mapInArrow(_clean, f"row {found.schema['row'].dataType.simpleString()}, text string")
    return clean.select(*[F.col("text").alias(text) if c == text else F.col("row")[c].alias(c) for c in docs.columns])
