import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandloom.llm import common, line_dedup
from strandloom.llm.cuckoo import Cuckoo
from strandloom.llm.kernels import NULL_ID

WS = " \t\n\x0b\x0c\r"


def lowered(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def brute(rows, least=10, among=None):
    """Rows of the result; ``among``: the rows that are held against each other."""
    holders = {}
    for i, t in rows if among is None else among:
        for line in (t or "").split("\n"):
            holders.setdefault(lowered(line.strip(WS)), set()).add(NULL_ID if i is None else i)
    out = []
    for i, t in rows:
        own, lines = NULL_ID if i is None else i, (t or "").split("\n")
        keep = [x for x in lines if len(lowered(x.strip(WS))) < least or min(holders.get(lowered(x.strip(WS)), {own})) >= own]
        out.append((i, len(lines), len(lines) - len(keep), hashlib.sha256("\n".join(keep).encode()).hexdigest(), "\n".join(keep)))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


SCHEMA = "doc_id long, text string"


def corpus(rng, n, first=0):
    pool = [f"line number {i} of a corpus" + " é" * int(i % 3) for i in range(60)] + ["short", "", "nine char", "exactly10!", "\U0001f600" * 9, "\U0001f600" * 10]
    out = []
    for i in range(first, first + n):
        lines = [pool[j] for j in rng.integers(0, len(pool), rng.integers(0, 9))] + [f"line of document {i} alone"]
        lines = [x.upper() if rng.random() < 0.2 else f" \t{x}\r" if rng.random() < 0.2 else x for x in lines]
        out.append((i, "\n".join(lines)))
    return out


@pytest.mark.parametrize("increments", [1, 3])
def test_equals_brute_force(spark, increments):
    rows = corpus(np.random.default_rng(1), 300) + [(900 + i, "the same line in very many documents\nand one more") for i in range(500)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert rows_of(line_dedup.line_dedup(df, increments=increments)) == brute(rows)


def test_odd_rows(spark):
    long = "\n".join(f"line {i % 5000} of a long text" for i in range(60_000))
    rows = [(1, "A shared line\n\n"), (1, "a shared line\nother text here"), (2, " A SHARED line\t\n"), (2, None), (3, ""), (None, "a shared line"), (None, "unheard of before"), (None, "unheard of before"), (4, long), (5, long + "\ntail"), (6, "\n\n"), (7, "a shared line"), (8, "É shared line\né shared line"), (9, "É shared line")]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("doc", "h1", "n", "least", "gone", "t", "kept", "shard"):
        df = df.withColumn(c, F.lit("z"))
    assert rows_of(line_dedup.line_dedup(df)) == brute(rows)
    assert rows_of(line_dedup.line_dedup(df.limit(0))) == []


def test_insertions_and_deletions_are_reversible(spark):
    rng = np.random.default_rng(4)
    one, two, three = corpus(rng, 120), corpus(rng, 100, 120), corpus(rng, 80, 60)
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
    path = common.Scratch(spark).base
    index = line_dedup.LineIndex(spark, path)
    index.insert(frame(one))
    index.insert(frame(two))
    assert rows_of(index.apply(frame(one + two))) == brute(one + two)
    index.insert(frame(three))  # all of them are held already, so nothing changes
    assert rows_of(index.apply(frame(one + two))) == brute(one + two)
    index.delete(frame(one[:90] + [(5000, "")]).select("doc_id"))
    left = one[90:] + two
    assert rows_of(index.apply(frame(left))) == brute(left)
    index = line_dedup.LineIndex(spark, path)  # opened again
    index.insert(frame(one[:90]))
    assert rows_of(index.apply(frame(one + two))) == brute(one + two)
    index.delete(frame(one + two).select("doc_id"))
    assert index.totals().count() == 0 and index.held().count() == 0 and index.postings().count() == 0
    slots = [r.slots for r in index._read("filters").filter(F.col("t") == index.version).collect()]
    assert slots and not any(any(s) for s in slots)  # every fingerprint has left its filter
    index.insert(frame(three))
    assert rows_of(index.apply(frame(three))) == brute(three)


def test_deletion_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "MAX_BROADCAST", 0)
    rows = corpus(np.random.default_rng(9), 60)
    index = line_dedup.LineIndex(spark, common.Scratch(spark).base)
    index.delete(spark.createDataFrame(rows[:5], SCHEMA))
    index.insert(spark.createDataFrame(rows, SCHEMA))
    index.delete(spark.createDataFrame(rows[:25], SCHEMA))
    assert rows_of(index.apply(spark.createDataFrame(rows, SCHEMA))) == brute(rows, among=rows[25:])


def test_filters_hold_what_was_added():
    rng = np.random.default_rng(2)
    h = rng.integers(-(1 << 63), 1 << 63, (9000, 2), dtype=np.int64)
    h[8000:] = h[7000:8000]  # the same fingerprint and buckets twice
    f = Cuckoo(1024)
    for part in np.array_split(h, 7):
        f.add(part[:, 0], part[:, 1])
    assert len(f.tables) > 1 and sum(int((t != 0).sum()) for t in f.tables) == 9000
    assert f.contains(h[:, 0], h[:, 1]).all()
    other = rng.integers(-(1 << 63), 1 << 63, (20000, 2), dtype=np.int64)
    assert f.contains(other[:, 0], other[:, 1]).mean() < 0.01
    f.remove(h[2000:8000, 0], h[2000:8000, 1])
    stay = np.r_[h[:2000], h[8000:]]
    assert f.contains(stay[:, 0], stay[:, 1]).all()
    assert f.contains(h[2000:7000, 0], h[2000:7000, 1]).mean() < 0.01
    f.remove(stay[:, 0], stay[:, 1])
    assert not any(t.any() for t in f.tables)
    with pytest.raises(ValueError):
        f.remove(h[:1, 0], h[:1, 1])


def test_a_filter_that_is_nearly_full_takes_keys_without_another_generation():
    import numpy as np

    from strandloom.llm.cuckoo import Cuckoo

    rng = np.random.default_rng(4)
    h1, h2 = (rng.integers(-(2**63), 2**63 - 1, 3400) for _ in range(2))
    held = Cuckoo(1024)
    for at in (0, 1700):
        held.add(h1[at : at + 1700], h2[at : at + 1700])
    assert len(held.tables) == 1 and np.count_nonzero(held.tables[0]) == 3400 and held.contains(h1, h2).all()
    held.remove(h1[:1700], h2[:1700])
    assert np.count_nonzero(held.tables[0]) == 1700 and held.contains(h1[1700:], h2[1700:]).all()
