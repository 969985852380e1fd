"""N-gram Jaccard join by grouped prefixes.

Documents become sets of word n-grams; two link when
``100 * intersection >= percent * union``.

1. A first pass counts, in a sketch of fixed size, in how many documents the
   n-grams of each sketch cell occur.  Cells order n-grams from rare to common.
2. A second pass makes one row a document: set size, a 128-bit set digest, the
   prefix (under that order, the first n - ceil(t n) + 1 members: two sets that
   link share one of them) and a 512-bit parity signature.  Equal sets collapse
   to their smallest document, and sets with equal prefix and size to a group.
3. Groups meet at prefix members.  At each member its first group is paired
   with the others, and a group's first set with its other sets.  Pairs that
   the sizes or the signatures exclude are dropped (the signatures' distance
   is a lower bound of the symmetric difference, so nothing is lost); the rest
   are verified on whole sets, and their links give components.
4. Members whose sets still lie in several components are expanded, but only
   to pairs across components, and at members of many sets only to pairs of
   neighbouring bands of sizes, so that a group of near copies never yields all
   its pairs.  They are verified as before; then no candidate is left that
   could change a component.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.llm import kernels as K
from strandloom.llm.common import Scratch, cleaned, ids_are_unique
from strandloom.operators.components import connected_components

#: Cells of the frequency sketch, in slices that are summed apart; words of the parity signature.
CELLS, SLICES, PARITY = 1 << 21, 64, 8
#: Words of the wider signature, and the set size from which a set has one.
WIDE, WIDE_FROM = 128, 1500
#: Sets of one component at one member from which they count as many; document ids that may be broadcast (about 50 bytes each).
MANY, MAX_BROADCAST = 32, 500_000
#: Sets at one member from which they are dealt by bands of sizes too.
HOT = 512


def _sets(raw, offsets, size):
    """Distinct n-grams of each document of a buffer: (hash, document)."""
    low = K.LOWER[raw]
    start, end, first = K.words(low, offsets, K.NOT_BLANK)
    hashes = K.mix(K.span_hash(K.prefix_hash(low), start, end))
    return K.distinct(*K.word_grams(hashes, first, size))


def _cells(h: np.ndarray) -> np.ndarray:
    return (K.mix(h, 3) >> K.U(40)).astype(np.int64) & (CELLS - 1)


def _slices(total: np.ndarray) -> Iterator[pa.RecordBatch]:
    width = CELLS // SLICES
    packed = [zlib.compress(np.minimum(total[i * width : (i + 1) * width], 0xFFFFFFFF).astype(np.uint32).tobytes(), 1) for i in range(SLICES)]
    yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array(packed, pa.binary())], names=["slice", "counts"])


def _count(size):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(CELLS, np.uint32), False
        for b in batches:
            raw, offsets = K.column(b, "text")
            for _, _, r, o in K.pieces(raw, offsets):
                cell, n = np.unique(_cells(_sets(r, o, size)[0]), return_counts=True)
                total[cell] += n.astype(np.uint32)
                seen = True
        if seen:
            yield from _slices(total)

    return count


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the slices that a task sees."""
    sums: dict[int, np.ndarray] = {}
    for b in batches:
        for i, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            part = np.frombuffer(zlib.decompress(blob), np.uint32).astype(np.int64)
            sums[i] = sums[i] + part if i in sums else part
    for i, total in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([zlib.compress(np.minimum(total, 0xFFFF).astype(np.uint16).tobytes(), 1)], pa.binary())], names=["slice", "counts"])


def frequencies(docs: DataFrame, size: int) -> np.ndarray:
    """Documents by sketch cell, up to 65,535: CELLS short numbers, whatever the size of the table."""
    out = np.zeros(CELLS, np.uint16)
    width = CELLS // SLICES
    summed = docs.select("text").mapInArrow(_count(size), "slice int, counts binary").repartition(SLICES, "slice").mapInArrow(_add, "slice int, counts binary")
    for row in summed.collect():
        out[row[0] * width : (row[0] + 1) * width] = np.frombuffer(zlib.decompress(bytes(row[1])), np.uint16)
    return out


def _digests(h: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two order-free 64-bit digests of each set."""
    sums = []
    for seed in (21, 22):
        c = np.concatenate((np.zeros(1, K.U), np.cumsum(K.mix(h, seed), dtype=K.U)))
        sums.append(K.mix(c[bounds[1:]] - c[bounds[:-1]], seed))
    return sums[0], sums[1]


def _parity(bit: np.ndarray, owner: np.ndarray, count: int, width: int) -> np.ndarray:
    """A signature of ``width`` words for each set: every member flips one bit."""
    flips = np.zeros(count * width * 64, np.uint8)
    np.add.at(flips, owner * (width * 64) + (bit & K.U(width * 64 - 1)).astype(np.int64), 1)
    return np.packbits(flips & 1).view(np.int64)


def _describe(size, percent, frequency):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = frequency.value
        for b in batches:
            raw, offsets = K.column(b, "text")
            docs = K.ids(b, "doc")
            for a, e, r, o in K.pieces(raw, offsets):
                h, owner = _sets(r, o, size)
                order = np.lexsort((h, rank[_cells(h)], owner))
                h = h[order]
                bounds = np.searchsorted(owner, np.arange(e - a + 1))
                n = np.diff(bounds)
                s1, s2 = _digests(h, bounds)
                take = np.where(n > 0, n - (percent * n + 99) // 100 + 1, 0)
                ends = np.cumsum(take)
                flat = np.repeat(bounds[:-1] - ends + take, take) + np.arange(int(ends[-1]) if len(ends) else 0)
                bit = K.mix(h, 31)
                packed = _parity(bit, owner, e - a, PARITY)
                long_ = np.flatnonzero(n >= WIDE_FROM)
                mine = (n >= WIDE_FROM)[owner]
                wide = _parity(bit[mine], np.searchsorted(long_, owner[mine]), len(long_), WIDE)
                yield K.batch(
                    doc=docs[a:e], n=n.astype(np.int64), s1=s1.view(np.int64), s2=s2.view(np.int64),
                    prefix=K.list_array(h[flat], np.concatenate(([0], ends))),
                    parity=K.list_array(packed, np.arange(e - a + 1) * PARITY),
                    wide=K.list_array(wide, np.concatenate(([0], np.cumsum((n >= WIDE_FROM) * WIDE)))),
                )

    return describe


def _expand(size):
    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole sets of the documents whose digest is the one that is asked for."""
        for b in batches:
            raw, offsets = K.column(b, "text")
            docs, want = K.ids(b, "doc"), K.ids(b, "s1")
            for a, e, r, o in K.pieces(raw, offsets):
                h, owner = _sets(r, o, size)
                bounds = np.searchsorted(owner, np.arange(e - a + 1))
                good = np.flatnonzero(_digests(h, bounds)[0].view(np.int64) == want[a:e])
                for i in good:
                    yield K.batch(doc=docs[a + i : a + i + 1], grams=K.list_array(h[bounds[i] : bounds[i + 1]], np.array([0, bounds[i + 1] - bounds[i]])))

    return expand


def _possible(percent):
    """Neither the sizes nor the signatures of sets a and b exclude a link."""
    distance = reduce(lambda x, y: x + y, (F.bit_count(F.col("pa")[i].bitwiseXOR(F.col("pb")[i])) for i in range(PARITY)))
    return (F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent) & (distance * (100 + percent) <= (F.col("na") + F.col("nb")) * (100 - percent))


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the (a, b) pairs whose whole sets link."""
    left = pairs.select("a", "b").join(sets.select(F.col("doc").alias("b"), F.col("grams").alias("gb")), "b")
    both = left.join(sets.select(F.col("doc").alias("a"), F.col("grams").alias("ga")), "a")
    common = F.size(F.array_intersect("ga", "gb"))
    return both.filter(common * 100 >= (F.size("ga") + F.size("gb") - common) * percent).select("a", "b")


def jaccard_components(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = 5, percent: int = 80) -> DataFrame:
    """Classes of documents that chains of links join.

    Words are maximal runs without ASCII white space, with A-Z lower-cased; a
    text of fewer than ``size`` words, but not none, has its whole sequence as
    its only n-gram.  Returns doc_id, n_shingles (set size) and component_id
    (the smallest doc_id reachable by links, itself included), one row per
    input row.

    Null or blank texts have an empty set and link with nothing.  Every row is
    a node of its own: rows that repeat an id, or have none, are joined by
    their texts alone.  A null id counts as greater than every other, so a
    component of rows without ids has a null component_id.  An empty table
    gives an empty result.  Other columns are not read, whatever their names.
    """
    if not 1 <= percent <= 100 or size < 1:
        raise ValueError("percent must be in 1..100 and size positive")
    with cleaned(docs.sparkSession):
        return _components(docs, text, doc_id, size, percent)


def _components(docs: DataFrame, text: str, doc_id: str, size: int, percent: int) -> DataFrame:
    scratch = Scratch(docs.sparkSession)
    id_type = docs.schema[doc_id].dataType
    base = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))
    if ids_are_unique(docs, doc_id):
        return _classes(base, scratch, size, percent).select(F.col("doc").cast(id_type).alias("doc_id"), "n_shingles", F.col("component").cast(id_type).alias("component_id"))
    # Ids do not tell rows apart: row numbers are written with the rows, so that every reading sees the same.
    rows = scratch.keep("numbered", base.withColumnRenamed("doc", "id").withColumn("doc", F.monotonically_increasing_id()))
    of = scratch.keep("classes", _classes(rows.select("doc", "text"), scratch, size, percent).join(rows.select("doc", "id"), "doc"))
    least = of.groupBy("component").agg(F.min("id").alias("least"))
    out = of.join(least, "component").select(F.col("id").cast(id_type).alias("doc_id"), "n_shingles", F.col("least").cast(id_type).alias("component_id"))
    scratch.only("classes")
    return out


def _classes(base: DataFrame, scratch: Scratch, size: int, percent: int) -> DataFrame:
    """(doc, n_shingles, component) of rows (doc, text) whose doc is unique and not null; the component is its least doc."""
    spark = base.sparkSession
    rank = spark.sparkContext.broadcast(frequencies(base, size))
    rows = scratch.keep("rows", base.select("doc", "text").mapInArrow(_describe(size, percent, rank), "doc long, n long, s1 long, s2 long, prefix array<long>, parity array<long>, wide array<long>"))
    rank.destroy()
    full = rows.filter("n > 0")
    sets = scratch.keep("sets", full.groupBy("s1", "s2", "n").agg(F.min("doc").alias("rep"), F.first("prefix").alias("prefix"), F.first("parity").alias("parity"), F.first("wide").alias("wide")).withColumn("shape", F.xxhash64("prefix", "n")))
    # Of every row only its set's representative is needed from here on.
    of = scratch.keep("of", rows.select("doc", "n", "s1", "s2").join(sets.select("s1", "s2", "n", "rep"), ["s1", "s2", "n"], "left").select("doc", "n", "rep"))
    scratch.drop("rows")
    # Groups: the head stands for all sets with its prefix and size.
    head = sets.groupBy("shape").agg(F.min("rep").alias("head"))
    info = scratch.keep("info", sets.select("rep", "s1", "n", "parity", "wide", "shape").join(head, "shape").drop("shape"))
    # Prefix members that several sets share; nothing else can make a candidate.
    at = sets.select(F.explode("prefix").alias("member"), "rep")
    shared = at.groupBy("member").agg(F.min("rep").alias("x"), F.max("rep").alias("z")).filter("x < z").select("member")
    lists = scratch.keep("lists", at.join(shared, "member"))
    scratch.drop("sets")

    # Heads at members, and first sets of groups: stars, not all pairs.
    heads = lists.join(info.filter("rep = head").select("rep"), "rep", "left_semi")
    stars = heads.join(heads.groupBy("member").agg(F.min("rep").alias("a")), "member").select("a", F.col("rep").alias("b"))
    within = info.select(F.col("head").alias("a"), F.col("rep").alias("b"))
    first = scratch.keep("first", _screened(stars.unionByName(within).filter("a < b").distinct(), info, percent))
    digest = info.select(F.col("rep").alias("doc"), "s1")

    def verified(name: str, pairs: DataFrame) -> DataFrame:
        need = pairs.select(F.col("a").alias("doc")).unionByName(pairs.select(F.col("b").alias("doc"))).distinct().join(digest, "doc")
        need = scratch.keep(f"{name}-need", need)
        # Few documents are picked out where they lie; many are dealt by id.
        side = F.broadcast(need) if need.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST else need
        found = base.select("doc", "text").join(side, "doc").select("doc", "s1", "text").mapInArrow(_expand(size), "doc long, grams array<long>")
        whole = scratch.keep(f"{name}-sets", found)
        links = scratch.keep(name, _linked(pairs, whole, percent))
        scratch.drop(f"{name}-sets")
        return links

    links = verified("links", first)
    parts = scratch.keep("parts1", connected_components(links, "a", "b", lambda name, df: scratch.keep(f"c1-{name}", df)))
    scratch.drop(*[x for x in scratch.paths if x.startswith("c1-")])

    # Pairs across components at members that still see several.
    label = lists.join(parts.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    seen = label.groupBy("member", "component").agg(F.count(F.lit(1)).alias("k"))
    torn = seen.groupBy("member").agg(F.min("component").alias("x"), F.max("component").alias("z"), (F.sum("k") > HOT).alias("hot")).filter("x < z").select("member", "hot")
    held = scratch.keep("torn", label.join(torn, "member").join(seen, ["member", "component"]).join(info.select("rep", "n", "parity"), "rep").withColumn("many", F.col("k") > MANY).drop("k"))
    scratch.drop("lists")
    side = lambda x: held.select("member", "hot", F.col("rep").alias(x), F.col("component").alias(f"c{x}"), F.col("n").alias(f"n{x}"), F.col("parity").alias(f"p{x}"), F.col("many").alias(f"m{x}"))
    # Sets that link lie in one band of sizes or in neighbouring ones, so a member of very many sets is dealt by size too.
    band = lambda n: F.floor(F.log(F.col(n).cast("double")) / F.lit(math.log(100 / percent * 1.0001)))
    one = F.lit(0).cast("long")
    a = side("a").withColumn("band", F.when(F.col("hot"), band("na")).otherwise(one)).drop("hot")
    b = side("b").withColumnRenamed("member", "same").withColumn("near", F.explode(F.when(F.col("hot"), F.array(*[band("nb") + F.lit(k) for k in (-1, 0, 1)])).otherwise(F.array(one)))).drop("hot")
    possible = (F.col("member") == F.col("same")) & (F.col("band") == F.col("near")) & (F.col("ca") != F.col("cb")) & _possible(percent)
    few = a.filter("not ma").join(b, possible & (F.col("mb") | (F.col("a") < F.col("b"))))
    # Two components of many sets each: their pairs are wanted, those within either are not.
    big = held.filter("many").select("member", "component").distinct()
    facing = big.select("member", F.col("component").alias("ca")).join(big.select("member", F.col("component").alias("other")), "member").filter("ca < other")
    many = a.join(facing, ["member", "ca"]).join(b, possible & (F.col("other") == F.col("cb")))
    across = few.select("a", "b").unionByName(many.select("a", "b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    second = scratch.keep("second", _screened(across.join(first.select("a", "b"), ["a", "b"], "left_anti"), info, percent))
    scratch.drop("torn", "first")
    more = verified("more", second)
    if not more.isEmpty():
        parts = scratch.keep("parts2", connected_components(links.unionByName(more), "a", "b", lambda name, df: scratch.keep(f"c2-{name}", df)))
    of = of.join(parts.withColumnRenamed("node", "rep"), "rep", "left")
    found = scratch.keep("found", of.select("doc", F.col("n").alias("n_shingles"), F.coalesce("component", "rep", "doc").alias("component")))
    scratch.only("found", *(x for x in ("numbered",) if x in scratch.paths))
    return found


def _screened(pairs: DataFrame, info: DataFrame, percent: int) -> DataFrame:
    """Pairs that sizes and signatures allow; of two large sets, the wider signatures too."""
    of = lambda x: info.select(F.col("rep").alias(x), F.col("n").alias(f"n{x}"), F.col("parity").alias(f"p{x}"))
    left = pairs.join(of("b"), "b").join(of("a"), "a").filter(_possible(percent)).select("a", "b", "na", "nb")
    large = (F.col("na") >= WIDE_FROM) & (F.col("nb") >= WIDE_FROM)
    wide = info.filter(F.col("n") >= WIDE_FROM)
    both = left.filter(large).join(wide.select(F.col("rep").alias("b"), F.col("wide").alias("wb")), "b").join(wide.select(F.col("rep").alias("a"), F.col("wide").alias("wa")), "a")
    distance = F.aggregate(F.zip_with("wa", "wb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    near = both.filter(distance * (100 + percent) <= (F.col("na") + F.col("nb")) * (100 - percent))
    return left.filter(~large).select("a", "b").unionByName(near.select("a", "b"))
