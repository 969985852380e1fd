import re

import pytest
from pyspark.sql import functions as F

from strandloom.llm import mixing


def level(sizes, weights, total):
    """Targets by resharing what is above until none is above."""
    target = dict.fromkeys(sizes, 0.0)
    open_ = set(sizes)
    rest = total
    while open_:
        w = sum(weights[s] for s in open_)
        target.update({s: rest * weights[s] / w for s in open_})
        above = {s for s in open_ if target[s] > 2 * sizes[s]}
        if not above:
            break
        for s in above:
            target[s] = 2.0 * sizes[s]
            rest -= target[s]
        open_ -= above
    return target


def docs(spark, n=400):
    rows = [(i, " ".join(["w"] * (i * 37 % 90)) if i % 29 else None, ["b", "a", None, "hot", "é"][i % 5 if i % 3 else 3], 1) for i in range(n)]
    rows += [(7, "x y z", "tiny", 0), (7, "x y z", "tiny", 0), (None, "p q", "a", 0), (900, "", "empty", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size int").repartition(3)


@pytest.mark.parametrize("block", [1, 8, 64])
def test_targets_and_words(spark, block):
    df = docs(spark)
    got = mixing.taken(df, block=block, shards=4).collect()
    again = mixing.taken(df.repartition(2), block=block, shards=4).collect()
    assert sorted(map(str, got)) == sorted(map(str, again)) and len(got) == df.count()
    sizes = {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    names = sorted((s for s in sizes if s is not None)) + [None]
    want = level(sizes, dict(zip(names, [5, 2, 1] * 3)), 1.5 * sum(sizes.values()))
    taken = {}
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes), (taken, want)


def test_sizes(spark):
    text = "a\x0bb c d\n\ne"
    df = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string").select("doc_id", mixing.word_count(F.col("text")).alias("n"))
    assert {r.doc_id: r.n for r in df.collect()} == {1: len(re.findall(r"[^\x20\x09-\x0D]+", text)), 2: 0}


def test_pieces_meet_blocks(spark):
    documents, pieces = mixing.mix(docs(spark, 100), block=16, shards=4)
    rows = pieces.collect()
    per_slot = {}
    for r in rows:
        per_slot[r.source, r.slot] = per_slot.get((r.source, r.slot), 0) + r.words
    assert max(per_slot.values()) <= 16 and {r.shard for r in rows} <= set(range(4)) and documents.count() == 104


def test_shards_hold_the_drawn_counts(spark):
    """Slots of a shard follow those of the shards before it, every pass takes every block once, and the last block comes last."""
    df = docs(spark, 300)
    documents, pieces = mixing.mix(df, block=4, shards=5, share=1.9)
    slots = {(r.source, r.slot): (r.shard, r.block) for r in pieces.collect()}
    sizes = {r.source: r.source_size for r in documents.collect()}
    for source, size in sizes.items():
        mine = sorted((slot, *x) for (s, slot), x in slots.items() if s == source)
        assert [m[0] for m in mine] == list(range(len(mine)))
        assert [m[1] for m in mine] == sorted(m[1] for m in mine)
        blocks = max(-(-size // 4), 1)
        for lo in range(0, len(mine), blocks):
            turn = [m[2] for m in mine[lo : lo + blocks]]
            assert len({*turn}) == len(turn) and (len(turn) < blocks or turn[-1] == blocks - 1)
        if len(mine) > 200:
            shares = [sum(m[1] == k for m in mine) / len(mine) for k in range(5)]
            assert all(0.1 < x < 0.3 for x in shares) and len({*shares}) > 1


def test_unit_stays_in_range_for_huge_sources(spark):
    sizes = [1, 2, 3, 64, 997, 1 << 31, (1 << 38) + 7, 1 << 45]
    df = spark.createDataFrame([(n,) for n in sizes], "n long").select("n", mixing._unit(F.col("n"), F.concat_ws(":", F.lit("s"), "n")).alias("u"))
    import math

    for r in df.collect():
        assert math.gcd(r.n, r.u) == 1 and r.n * r.u < 1 << 62


def test_same_mix_under_any_partition_setting(spark):
    df, mixes = docs(spark), []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("3", "37"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            mixes.append(sorted(map(str, mixing.taken(df, block=8, shards=4).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert mixes[0] == mixes[1]


def test_empty_table(spark):
    assert mixing.taken(spark.createDataFrame([], "doc_id long, text string, source string")).collect() == []
