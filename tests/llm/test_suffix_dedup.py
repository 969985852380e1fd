import hashlib
import random

import numpy as np
import pytest

from strandloom.llm import suffix_dedup as S
from strandloom.llm.common import Scratch


def brute(rows, length):
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        k = (1 << 63) - 1 if d is None else d
        for i in range(len(b) - length + 1):
            w = b[i : i + length]
            first[w] = min(first.get(w, k), k)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        k = (1 << 63) - 1 if d is None else d
        mask = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < k:
                mask[i : i + length] = b"\1" * length
        runs = sum(1 for i in range(len(b)) if mask[i] and not (i and mask[i - 1]))
        kept = bytes(c for c, m in zip(b, mask) if not m)
        out.append((d, len(b), sum(mask), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def rows_of(seed, n=60):
    rng = random.Random(seed)
    words = ["the", "and", "émoi", "of", "thth", "x", "ing", "zu", "ß"]
    text = lambda m: " ".join(rng.choice(words) for _ in range(m))
    passages = [text(rng.randint(5, 40)) for _ in range(6)]
    rows = []
    for i in range(n):
        kind = rng.random()
        t = text(rng.randint(0, 80))
        if kind < 0.5:
            t = t + rng.choice(passages) + text(rng.randint(0, 20)) + rng.choice(passages)
        elif kind < 0.6:
            t = "ab " * rng.randint(1, 200)
        elif kind < 0.7:
            t = "a" * rng.randint(0, 300)
        rows.append((i * 3 % n, t))
    return rows + [(None, rows[3][1]), (None, rows[5][1]), (n + 5, None), (n + 6, ""), (2, rows[2][1]), (2, rows[2][1]), (4, passages[0] * 3)]


def got(df):
    return sorted((tuple(r)[:5] for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("bucket", [24 << 20, 3000])
def test_against_brute_force(spark, monkeypatch, seed, bucket):
    monkeypatch.setattr(S, "BUCKET_BYTES", bucket)
    monkeypatch.setattr(S, "SORT_WINDOWS", 100)
    monkeypatch.setattr(S, "COMBINE_ROWS", 50)
    rows = rows_of(seed)
    df = spark.createDataFrame([(d, t, "z") for d, t in rows], "doc_id long, text string, doc string").repartition(3)
    assert got(S.suffix_dedup(df)) == brute(rows, 50)


def test_unique_ids_and_a_passage_in_every_document(spark, monkeypatch):
    monkeypatch.setattr(S, "BUCKET_BYTES", 4000)
    monkeypatch.setattr(S, "COMBINE_ROWS", 30)
    rng = random.Random(8)
    passage = " ".join(f"w{rng.randrange(99)}" for _ in range(40))
    rows = [(1000 - i, f"{rng.random()} {passage} {rng.random()}" + passage[: rng.randrange(200)]) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(S.suffix_dedup(df)) == brute(rows, 50)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.suffix_dedup(df).collect() == []


def test_multikey_sort():
    raw = np.frombuffer(b"abcdefghijabcdefghiXabcdefghij\0\0abc\0\0", np.uint8)
    start = np.arange(len(raw) - 10)
    rank = S.multikey_sort(raw, start, np.full(len(start), 10), np.zeros(len(start), np.int64))
    strings = [bytes(raw[s : s + 10]) for s in start]
    assert rank.tolist() == [sum(x < y for x in strings) for y in strings]


def test_scratch_sweep(spark):
    s = Scratch(spark)
    assert s.keep("a", spark.range(3)).count() == 3
    s.sweep()
