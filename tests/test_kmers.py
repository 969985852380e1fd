import random

import numpy as np
import pytest

from strandloom.operators import kmers


def plain_hash(gram):
    acc = 0
    for c in gram:
        acc = (acc * int(kmers._BASE) + ord(c)) % (1 << 64)
    return acc ^ (acc >> 29)


@pytest.mark.parametrize("k", [1, 2, 3, 8, 25, 31, 32, 40])
def test_hashes_of_windows(k):
    text = "".join(random.Random(k).choices("ACGT\n\u00e9\U0001f600", k=40))
    assert kmers._window_hashes(kmers._points(text), k).tolist() == [plain_hash(text[i : i + k]) for i in range(41 - k)]
    assert len(kmers._window_hashes(kmers._points(text[: k - 1]), k)) == 0


def test_known_kmers_are_hashed_together(monkeypatch):
    rng, calls, whole = random.Random(1), [], kmers._window_hashes
    grams = ["".join(rng.choices("ACGT", k=31)) for _ in range(3000)]
    monkeypatch.setattr(kmers, "_window_hashes", lambda *a: calls.append(1) or whole(*a))
    hashes = kmers._hashes_of(grams, 31)
    assert len(calls) == 1 and hashes.tolist() == sorted({plain_hash(g) for g in grams})
    marks, shift = kmers._marks(hashes)
    assert marks[hashes >> shift].all() and marks.mean() < 0.1 and len(kmers._hashes_of([], 31)) == 0


def test_texts_are_scanned_many_at_a_time(spark):
    texts = ["ACGTACGT", None, "", "ACGT" * 50_000, "A", "CGTACG", "TTT\u00e9TTTT\U0001f600T", "x" * 200_000]
    runs = list(kmers._chunks(texts))
    assert [i for r in runs for i in r] == [0, 2, 3, 4, 5, 6, 7] and len(runs) == 2
    k, known = 7, ["ACGTACG", "CGTACGT", "GTACGTA", "TT\u00e9TTTT", "TTTT\U0001f600T", "TTT\u00e9TTT", "ACGTCGT", "xxxxxxx", "ACG", "ACGTACGT", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1)
    want = sorted({(i, t[j : j + k]) for i, t in enumerate(texts) if t for j in range(len(t) - k + 1)} & {(i, g) for i in range(len(texts)) for g in known})
    for most in (kmers.MAX_BROADCAST, 0):
        got = kmers.known_kmers(docs, "i", "t", spark.createDataFrame([(g,) for g in known], "g string"), k, most)
        assert sorted(tuple(r) for r in got.collect()) == want, most
    none = kmers.known_kmers(docs, "i", "t", spark.createDataFrame([], "g string"), k)
    assert none.collect() == [] and np.array_equal(kmers._marks(np.empty(0, np.uint64))[0], np.zeros(1 << 16, bool))
