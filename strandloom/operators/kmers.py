"""k-mers of many texts that a small set knows, found in one scan of the texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandloom.functions import sequence as S

#: k-mers that may be broadcast (about 100 bytes each in a worker).
MAX_BROADCAST = 2_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Code points that a worker hashes at a time, so that its arrays stay in the cache.
CHUNK = 1 << 17


def _window_hashes(points: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of every k code points along the last axis; windows of twice a size come from two of that size."""
    count = points.shape[-1] - k + 1
    if count <= 0:
        return np.empty((*points.shape[:-1], 0), np.uint64)
    acc, size = points, 1
    for bit in bin(k)[3:]:
        acc, size = acc[..., :-size] * np.uint64(pow(int(_BASE), size, 1 << 64)) + acc[..., size:], 2 * size
        if bit == "1":
            acc, size = acc[..., :-1] * _BASE + points[..., size : size + acc.shape[-1] - 1], size + 1
    return acc ^ (acc >> np.uint64(29))


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def _hashes_of(grams: list[str], k: int) -> np.ndarray:
    """The sorted hashes of k-mers."""
    parts = [_window_hashes(_points("".join(grams[i : i + CHUNK])).reshape(-1, k), k)[:, 0] for i in range(0, len(grams), CHUNK)]
    return np.unique(np.concatenate(parts)) if parts else np.empty(0, np.uint64)


def _marks(hashes: np.ndarray) -> tuple[np.ndarray, np.uint64]:
    """A table of the leading bits that hashes have, 16 places a hash, and by how much to shift a hash to its place."""
    bits = min(max(16, len(hashes).bit_length() + 4), 25)
    shift = np.uint64(64 - bits)
    marks = np.zeros(1 << bits, bool)
    marks[hashes >> shift] = True
    return marks, shift


def _chunks(texts: list[str | None]) -> Iterator[list[int]]:
    """The places of texts that are not null, in runs of about ``CHUNK`` code points."""
    run, size = [], 0
    for i, t in enumerate(texts):
        if t is not None:
            run.append(i)
            size += len(t)
        if size >= CHUNK:
            yield run
            run, size = [], 0
    if run:
        yield run


def known_kmers(docs: DataFrame, doc_id: str, text: str, known: DataFrame, k: int, most: int = MAX_BROADCAST) -> DataFrame:
    """Distinct (doc_id, g) of the k-mers of each text that ``known`` (distinct k-mers, column g) holds.

    Up to ``most`` known k-mers go to every worker, which scans many texts at a
    time by a rolling hash and compares the bases where it hits; beyond that
    both sides meet in a join on the k-mer.  Null and short texts have none.
    """
    few = known.select("g").limit(most + 1).toArrow() if most else None
    if few is None or few.num_rows > most:
        mine = docs.select(doc_id, F.explode(S.kmers(text, k)).alias("g"))
        return mine.join(known.select("g"), "g", "left_semi").select(doc_id, "g")
    grams = [g for g in few.column("g").to_pylist() if g is not None and len(g) == k]
    held = docs.sparkSession.sparkContext.broadcast((grams, _hashes_of(grams, k)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, hashes = set(held.value[0]), held.value[1]
        marks, shift = _marks(hashes)
        for b in batches:
            texts = b.column(1).to_pylist() if words else []
            for run in _chunks(texts):
                whole = "".join(texts[i] for i in run)
                ends = np.cumsum([len(texts[i]) for i in run])
                at = _window_hashes(_points(whole), k)
                near = np.flatnonzero(marks[at >> shift])
                found = near[hashes[np.minimum(np.searchsorted(hashes, at[near]), len(hashes) - 1)] == at[near]]
                row = np.searchsorted(ends, found, side="right")
                inside = found + k <= ends[row]  # a window over two texts is of neither
                hits = sorted({(run[r], g) for r, j in zip(row[inside].tolist(), found[inside].tolist(), strict=True) if (g := whole[j : j + k]) in words})
                if hits:
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array([r for r, _ in hits], pa.int64())), pa.array([g for _, g in hits], pa.string())], names=["id", "g"])

    schema = T.StructType([T.StructField("id", docs.schema[doc_id].dataType), T.StructField("g", T.StringType())])
    return docs.select(doc_id, F.col(text).cast("string")).mapInArrow(scan, schema).withColumnRenamed("id", doc_id)
