"""Suffix-array removal of repeated byte strings across documents.

Every string of ``length`` bytes that also starts in a document with a smaller
id is found, and the bytes that such strings cover are removed.

Method.  Suffixes are taken at *anchors*: in every window of ``length`` bytes
the ``lead``-byte gram with the least hash.  A maximal range of consecutive
windows with one least gram is a *run*; equal windows have equal grams, so only
runs of one gram can share windows, and a suffix that starts at the anchor of a
run stands for all its windows.

1. A hash of the gram discards what cannot repeat: runs whose gram occurs in
   one document only.  Nothing is removed on the word of a hash.  Runs whose
   gram several documents of one task hold pass at once and leave one mark for
   the other tasks, so that a gram of very many documents meets in no task.
2. The other suffixes are dealt to buckets by sampled splitters of (leading
   bytes, document), so equal suffixes of very many documents span buckets.  A
   bucket, of bounded size, is sorted by multikey quicksort (eight bytes a
   digit, ties only).  Equal neighbours are settled by their least document;
   where a gram has several suffixes, one of each is expanded to its windows,
   which are sorted and compared alike.
3. Only the first and the last gram of a bucket can go on in another one.  The
   windows of their suffixes are settled in the bucket, too, and those that
   none there precedes meet across the boundaries by their bytes.
4. The removed windows are joined to the texts once.

Compared strings are always of the input, never of what is left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.llm import kernels as K
from strandloom.llm.common import Scratch, ids_are_unique, key, parallelism

#: Runs combined at once in a task; bytes of a bucket's suffixes; windows sorted at once; sampled suffixes a bucket; leading bytes that splitters compare.
COMBINE_ROWS, BUCKET_BYTES, SORT_WINDOWS, SAMPLES, COMPARED = 600_000, 24 << 20, 1_000_000, 20, 32
#: A run's place in one number: start, windows (20 bits), and place of the anchor (8 bits) where it is known.
_N, _ANCHOR = 20, 8
_RUN = "gram long, doc long, row long, at long"
_SUFFIX = "bucket int, doc long, row long, at long, body binary"
_SOLVED = "row long, start long, n long, doc long, body binary"


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` neighbours, by doubling."""
    m, step = h, 1
    while step * 2 <= width:
        m = np.minimum(m[:-step], m[step:])
        step *= 2
    return np.minimum(m[: len(m) - (width - step)], m[width - step :]) if step < width else m


def _runs(raw, offsets, length, lead):
    """(gram, document, start in the buffer, windows) of every run."""
    empty = np.empty(0, np.int64)
    if len(raw) < length:
        return np.empty(0, K.U), empty, empty, empty
    least = _least(K.mix(K.gram_hash(K.prefix_hash(raw), lead)), length - lead + 1)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(least)]
    valid = np.arange(len(least)) + length <= offsets[1:][doc]
    new = valid.copy()
    new[1:] &= (least[1:] != least[:-1]) | ~valid[:-1]
    stop = valid.copy()
    stop[:-1] &= (least[1:] != least[:-1]) | ~valid[1:]
    start, last = np.flatnonzero(new), np.flatnonzero(stop)
    n = last - start + 1
    most = (1 << _N) - 1
    if len(n) and n.max() > most:  # a periodic text: its run in parts
        parts = -(-n // most)
        which = np.repeat(np.arange(len(n)), parts)
        k = np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts)
        start, n = start[which] + k * most, np.minimum(n[which] - k * most, most)
    return least[start], doc[start], start, n


def _intervals(row, start, n):
    """Adjacent window ranges of a row as one."""
    order = np.lexsort((start, row))
    row, start, n = row[order], start[order], n[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (start[1:] != start[:-1] + n[:-1])
    at = np.flatnonzero(new)
    return row[at], start[at], np.add.reduceat(n, at) if len(at) else n[:0]


def _firsts(values: np.ndarray) -> np.ndarray:
    """Where a new value begins in a sorted array."""
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return np.flatnonzero(new)


def _combined(parts):
    """Runs of a task: those whose gram two documents hold pass (at below 0) and leave a mark (at 0)."""
    gram, doc, row, at = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(gram, kind="stable")
    gram, doc, row, at = gram[order].view(np.int64), doc[order], row[order], at[order]
    first = _firsts(gram)
    twice = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)
    known = np.repeat(twice, np.diff(np.append(first, len(gram))))
    yield K.batch(gram=gram[~known], doc=doc[~known], row=row[~known], at=at[~known])
    if twice.any():
        marks = gram[first[twice]]
        zero = np.zeros(len(marks), np.int64)
        spread = K.mix(row[known].view(K.U) ^ at[known].view(K.U), 11).view(np.int64)
        yield K.batch(gram=np.concatenate((marks, spread)), doc=np.concatenate((zero, doc[known])), row=np.concatenate((zero, row[known])), at=np.concatenate((zero, -at[known])))


def _find_runs(length, lead):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for b in batches:
            raw, offsets = K.column(b, "text")
            doc, row = K.ids(b, "doc"), K.ids(b, "row")
            for a, e, r, o in K.pieces(raw, offsets):
                gram, d, start, n = _runs(r, o, length, lead)
                if not len(gram):
                    continue
                parts.append((gram, doc[a:e][d], row[a:e][d], (start - o[d]) << _N | n))
                held += len(gram)
                if held >= COMBINE_ROWS:
                    yield from _combined(parts)
                    parts, held = [], 0
        if parts:
            yield from _combined(parts)

    return find


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs sorted by gram to (row, at) of those whose gram more than one document holds."""
    held = [np.empty(0, np.int64)] * 4

    def settle(gram, doc, row, at):
        if not len(gram):
            return
        first = _firsts(gram)
        own = at > 0
        low = np.minimum.reduceat(np.where(own, doc, np.iinfo(np.int64).max), first)
        high = np.maximum.reduceat(np.where(own, doc, np.iinfo(np.int64).min), first)
        several = (low < high) | np.logical_or.reduceat(at == 0, first)
        keep = own & np.repeat(several, np.diff(np.append(first, len(gram))))
        if keep.any():
            yield K.batch(row=row[keep], at=at[keep])

    for b in batches:
        cols = [K.ids(b, x) for x in ("gram", "doc", "row", "at")]
        passed = cols[3] < 0
        if passed.any():
            yield K.batch(row=cols[2][passed], at=-cols[3][passed])
            cols = [x[~passed] for x in cols]
        cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
        if not len(cols[0]):
            continue
        cut = int(np.flatnonzero(cols[0] != cols[0][-1])[-1]) + 1 if cols[0][0] != cols[0][-1] else 0
        yield from settle(*(x[:cut] for x in cols))
        held = [x[cut:] for x in cols]
    yield from settle(*held)


def _located(b: pa.RecordBatch, length, lead):
    """For each buffer of a batch: bytes, and per run to refine document, row, start, windows, its place and its anchor's in the buffer."""
    width = length - lead + 1
    raw, offsets = K.column(b, "text")
    doc, row = K.ids(b, "doc"), K.ids(b, "row")
    runs = b.column(b.schema.get_field_index("runs"))
    bounds = np.concatenate(([0], np.cumsum(pa.compute.fill_null(pa.compute.list_value_length(runs), 0).to_numpy(zero_copy_only=False)))).astype(np.int64)
    flat = runs.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    for a, e, r, o in K.pieces(raw, offsets):
        lo, hi = bounds[a], bounds[e]
        if lo == hi or len(r) < length:
            continue
        owner = np.repeat(np.arange(e - a), np.diff(bounds[a : e + 1]))
        start, n = flat[lo:hi] >> _N, flat[lo:hi] & (1 << _N) - 1
        base = start + o[owner]
        grams = K.mix(K.gram_hash(K.prefix_hash(r), lead))
        anchor, least = base.copy(), grams[base]
        for k in range(1, width):
            here = grams[base + k]
            better = here < least
            anchor[better], least[better] = base[better] + k, here[better]
        yield r, doc[a:e][owner], row[a:e][owner], start, n, base, anchor


def _splitter_keys(r, doc, n, base, anchor, length) -> np.ndarray:
    """(leading bytes, document) of suffixes as byte strings that compare in their order."""
    out = np.zeros((len(base), COMPARED + 8), np.uint8)
    place = anchor[:, None] + np.arange(COMPARED)
    inside = place < (base + n - 1 + length)[:, None]
    out[:, :COMPARED] = np.where(inside, r[np.minimum(place, len(r) - 1)], 0)
    out[:, COMPARED:] = (doc.view(K.U) ^ K.U(1 << 63)).astype(">u8").view(np.uint8).reshape(-1, 8)
    return out.view(f"S{COMPARED + 8}").ravel()


def _sampled(length, lead):
    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r, doc, _, _, n, base, anchor in _located(b, length, lead):
                keys = _splitter_keys(r, doc, n, base, anchor, length)
                yield K.batch(key=pa.array([x.ljust(COMPARED + 8, b"\0") for x in keys.tolist()], pa.binary()))

    return sampled


def _suffixes(length, lead, splitters):
    """Texts with the runs to refine to suffixes with the bucket that the splitters name."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = splitters.value
        for b in batches:
            for r, doc, row, start, n, base, anchor in _located(b, length, lead):
                size = n + length - 1
                ends = np.cumsum(size)
                at = 0
                while at < len(size):
                    end = max(int(np.searchsorted(ends, ends[at] - size[at] + (4 << 20), "right")), at + 1)
                    s = slice(at, end)
                    bounds = np.concatenate(([0], np.cumsum(size[s])))
                    body = r[np.repeat(base[s] - bounds[:-1], size[s]) + np.arange(bounds[-1])]
                    bucket = np.searchsorted(edges, _splitter_keys(r, doc[s], n[s], base[s], anchor[s], length), "right")
                    packed = (start[s] << _N | n[s]) << _ANCHOR | (anchor[s] - base[s])
                    yield K.batch(bucket=bucket.astype(np.int32), doc=doc[s], row=row[s], at=packed, body=K.binary_array(body, bounds))
                    at = end

    return emit


def multikey_sort(raw: np.ndarray, start: np.ndarray, size: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Number of the string of ``size`` bytes at each start, within groups: equal strings of a group have equal numbers, and numbers ascend.

    A group's number is the place of its first string in sorted order, on input
    as on output; strings of a group are of one size.  Multikey quicksort with
    eight bytes as a digit: strings are partitioned by one digit, and only
    those that are still tied go on to the next.
    """
    padded = np.concatenate((raw, np.zeros(8, np.uint8)))
    digits = np.ndarray(len(padded) - 7, ">u8", padded.tobytes(), strides=(1,))
    group = group.copy()
    tied = np.argsort(group, kind="stable")
    for at in range(0, int(size.max(initial=0)), 8):
        old = group[tied]
        alone = np.ones(len(old), bool)
        alone[1:] = old[1:] != old[:-1]
        last = np.append(alone[1:], True)
        tied = tied[~(alone & last) & (size[tied] > at)]
        if not len(tied):
            break
        left = size[tied] - at
        digit = digits[start[tied] + at].astype(K.U)
        short = left < 8
        if short.any():
            digit[short] &= ~((K.U(1) << (K.U(8) * (K.U(8) - left[short].astype(K.U)))) - K.U(1))
        old = group[tied]
        order = np.lexsort((digit, old))
        tied, digit = tied[order], digit[order]
        fresh = np.ones(len(tied), bool)
        fresh[1:] = old[1:] != old[:-1]
        new = fresh.copy()
        new[1:] |= digit[1:] != digit[:-1]
        place = np.arange(len(tied))
        group[tied] = old + np.maximum.accumulate(np.where(new, place, 0)) - np.maximum.accumulate(np.where(fresh, place, 0))
    return group


def _ranked(*keys: np.ndarray) -> np.ndarray:
    """Group numbers by the values of keys, the first being the most significant."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
    out = np.empty(len(order), np.int64)
    out[order] = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    return out


def _least_of(group: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The least document of each row's group; group numbers are places below the number of rows."""
    least = np.full(len(group), np.iinfo(np.int64).max)
    np.minimum.at(least, group, doc)
    return least[group]


def _solve(length, lead):
    """The suffixes of a bucket to removed windows, and to the least of the windows (with body) whose gram may go on in another bucket."""

    def removed(row, start, n):
        row, start, n = _intervals(row, start, n)
        nothing = pa.nulls(len(row), pa.binary())
        return K.batch(row=row, start=start, n=n, doc=np.zeros(len(row), np.int64), body=nothing)

    def windows(raw, gram, doc, row, start, n, base, more):
        owner = np.repeat(np.arange(len(n)), n)
        k = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        group = multikey_sort(raw, base[owner] + k, np.full(len(owner), length), _ranked(gram[owner]))
        later = doc[owner] > _least_of(group, doc[owner])
        hit = np.flatnonzero(later)
        if len(hit):
            yield removed(row[owner[hit]], start[owner[hit]] + k[hit], np.ones(len(hit), np.int64))
        if more:
            left = np.flatnonzero(~later)
            for at in range(0, len(left), 50_000):
                i = left[at : at + 50_000]
                body = raw[(base[owner[i]] + k[i])[:, None] + np.arange(length)].ravel()
                yield K.batch(row=row[owner[i]], start=start[owner[i]] + k[i], n=np.ones(len(i), np.int64), doc=doc[owner[i]], body=K.binary_array(body, np.arange(len(i) + 1) * length))

    def settle(parts):
        doc, row, at = (np.concatenate([p[i] for p in parts]) for i in range(3))
        raw = np.concatenate([p[3] for p in parts])
        size = np.concatenate([p[4] for p in parts])
        base = np.cumsum(size) - size
        anchor = at & (1 << _ANCHOR) - 1
        n, start = at >> _ANCHOR & (1 << _N) - 1, at >> _ANCHOR + _N
        # The leading bytes first, then the rest of the suffix, then what lies before the anchor.
        gram = multikey_sort(raw, base + anchor, np.full(len(base), lead), np.zeros(len(base), np.int64))
        alike = multikey_sort(raw, base + anchor + lead, size - anchor - lead, _ranked(gram, size, anchor))
        alike = multikey_sort(raw, base, anchor, alike)
        later = doc > _least_of(alike, doc)
        if later.any():
            yield removed(row[later], start[later], n[later])
        rest = np.flatnonzero(~later)
        edge = (gram[rest] == gram.min()) | (gram[rest] == gram.max())
        for at, more in ((rest[edge], True), (rest[~edge], False)):
            at = at[np.argsort(gram[at], kind="stable")]
            first = _firsts(gram[at])
            if not more and len(first):
                # Only grams with several suffixes and more than one document have anything left to settle here.
                several = (np.minimum.reduceat(alike[at], first) != np.maximum.reduceat(alike[at], first)) & (np.minimum.reduceat(doc[at], first) != np.maximum.reduceat(doc[at], first))
                at = at[np.repeat(several, np.diff(np.append(first, len(at))))]
                first = _firsts(gram[at])
            # Pieces of whole grams; those of an edge may be cut anywhere, as their windows meet again.
            ends = np.cumsum(n[at])
            cuts = np.arange(1, len(at) + 1) if more else np.append(first[1:], len(at))
            lo = 0
            while lo < len(at):
                began = ends[lo] - n[at[lo]]
                hi = int(cuts[max(int(np.searchsorted(ends[cuts - 1], began + SORT_WINDOWS, "right")) - 1, int(np.searchsorted(cuts, lo, "right")))])
                part = at[lo:hi]
                yield from windows(raw, gram[part], doc[part], row[part], start[part], n[part], base[part], more)
                lo = hi

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for b in batches:
            bucket = K.ids(b, "bucket")
            first = _firsts(bucket) if len(bucket) else bucket
            for lo, hi in zip(first.tolist(), [*first[1:].tolist(), len(bucket)], strict=False):
                if held and bucket[lo] != now:
                    yield from settle(held)
                    held = []
                now = bucket[lo]
                part = b.slice(lo, hi - lo)
                raw, offsets = K.column(part, "body")
                held.append((K.ids(part, "doc"), K.ids(part, "row"), K.ids(part, "at"), raw.copy(), np.diff(offsets)))
        if held:
            yield from settle(held)

    return solve


def covered(start: np.ndarray, n: np.ndarray, size: int, length: int) -> tuple[np.ndarray, int]:
    """(mask of the bytes under windows that start in the ranges, number of maximal runs)."""
    delta = np.zeros(size + 1, np.int64)
    np.add.at(delta, start, 1)
    np.add.at(delta, np.minimum(start + n - 1 + length, size), -1)
    mask = np.cumsum(delta[:-1]) > 0
    return mask, int(mask[0]) + int(np.count_nonzero(mask[1:] & ~mask[:-1])) if size else 0


def _strip(length):
    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, offsets = K.column(b, "text")
            runs = b.column(b.schema.get_field_index("runs")).to_pylist()
            data = raw.tobytes()
            size, removed, spans, digest, left = [], [], [], [], []
            for i, found in enumerate(runs):
                text, count = data[offsets[i] : offsets[i + 1]], 0
                rest = text
                if found:
                    at = np.array([(x["start"], x["n"]) for x in found], np.int64)
                    mask, count = covered(at[:, 0], at[:, 1], len(text), length)
                    rest = np.frombuffer(text, np.uint8)[~mask].tobytes()
                size.append(len(text))
                removed.append(len(text) - len(rest))
                spans.append(count)
                digest.append(hashlib.sha256(rest).hexdigest())
                left.append(rest)
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index("doc_id")), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digest), pa.array(left, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    return strip


def suffix_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = 50, lead: int = 20) -> DataFrame:
    """Remove every byte under a ``length``-byte string that also starts in a document with a smaller id.

    Returns doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the
    remaining bytes; they need not be whole characters), one row per input row.

    Null text: empty.  Texts shorter than ``length``: never touched.  Null id:
    greater than every other id, and two such rows do not judge each other.
    Rows that repeat an id are one document as to order: a string in both is no
    repetition.  An empty table gives an empty result.  Other columns are not
    read, whatever their names.
    """
    if not 1 <= lead <= length or length - lead >= 1 << _ANCHOR:
        raise ValueError("lead must be between 1 and length, and at most 255 bytes shorter")
    spark = docs.sparkSession
    scratch = Scratch(spark)
    id_type = docs.schema[doc_id].dataType
    base = docs.select(F.col(doc_id).alias("doc_id"), key(doc_id).alias("doc"), F.col(text).cast("string").alias("text"))
    if ids_are_unique(docs, doc_id):
        base = base.withColumn("row", F.col("doc"))
    else:
        # Ids do not tell rows apart: row numbers are written with the rows, so that every reading sees the same.
        base = scratch.keep("rows", base.withColumn("row", F.monotonically_increasing_id()))
    parts = parallelism(spark)
    runs = base.select("doc", "row", "text").mapInArrow(_find_runs(length, lead), _RUN)
    refine = scratch.keep("refine", runs.repartition(parts, "gram").sortWithinPartitions("gram").mapInArrow(_repeated, "row long, at long"))
    windows = F.col("at").bitwiseAND(F.lit((1 << _N) - 1))
    count, size = refine.agg(F.count(F.lit(1)), F.coalesce(F.sum(windows + F.lit(length - 1)), F.lit(0))).first()
    buckets = max(parts, -(-size // BUCKET_BYTES))
    # Splitters from about SAMPLES suffixes a bucket, chosen by hash: their rows can be broadcast.
    every = max(1, count // (buckets * SAMPLES))
    some = refine.filter(F.pmod(F.xxhash64("row", "at"), F.lit(every)) == 0).groupBy("row").agg(F.collect_list("at").alias("runs"))
    keys = sorted(bytes(r[0]) for r in base.join(F.broadcast(some), "row").select("doc", "row", "text", "runs").mapInArrow(_sampled(length, lead), "key binary").collect())
    splitters = np.array([keys[i * len(keys) // buckets] for i in range(1, buckets)] if keys else [], f"S{COMPARED + 8}")
    held = spark.sparkContext.broadcast(splitters)
    listed = refine.groupBy("row").agg(F.collect_list("at").alias("runs"))
    suffixes = base.join(listed, "row").select("doc", "row", "text", "runs").mapInArrow(_suffixes(length, lead, held), _SUFFIX)
    solved = scratch.keep("solved", suffixes.repartitionById(buckets, F.col("bucket")).mapInArrow(_solve(length, lead), _SOLVED))
    scratch.drop("refine")
    across = solved.filter("body is not null").withColumnRenamed("body", "window")
    least = across.groupBy("window").agg(F.min("doc").alias("least"))
    later = across.join(least, "window").filter("doc > least").select("row", "start", F.lit(1).cast("long").alias("n"))
    removed = solved.filter("body is null").select("row", "start", "n").unionByName(later).groupBy("row").agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    joined = base.join(removed, "row", "left").select("doc_id", "text", "runs")
    return joined.mapInArrow(_strip(length), f"doc_id {id_type.simpleString()}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
