import random
import re

import pytest

from strandloom.llm import jaccard
from strandloom.llm.jaccard import jaccard_components


def shingles(text, size):
    t = (text or "").translate({i: i + 32 for i in range(65, 91)})
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    if not w:
        return set()
    return {tuple(w)} if len(w) < size else {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def brute(rows, size, percent):
    """Every row is a node; a component is named by its least id, a missing one being the greatest."""
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted([(d, len(s), least.get(root(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))], key=str)


def rows_of(seed, n=90):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["The", "É"]
    text = lambda m: [rng.choice(words) for _ in range(m)]
    seeds = [text(rng.choice([3, 9, 10, 11, 30, 60, 120])) for _ in range(8)]
    rows = []
    for i in range(n):
        w = list(rng.choice(seeds)) if rng.random() < 0.7 else text(rng.randint(0, 40))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            if w:
                w[rng.randrange(len(w))] = rng.choice(words)
        if rng.random() < 0.3:
            w = w + text(rng.randint(1, 3))
        rows.append((1000 - i * 7, rng.choice([" ", "\n", "  "]).join(w)))
    return rows + [(None, rows[0][1]), (None, rows[2][1]), (None, "own words only here"), (5000, None), (5001, ""), (5002, " \n "), (rows[3][0], rows[3][1]), (rows[3][0], rows[4][1])]


@pytest.mark.parametrize(("seed", "size", "percent"), [(1, 3, 90), (2, 5, 80), (3, 1, 50), (4, 3, 90)])
def test_against_brute_force(spark, seed, size, percent):
    rows = rows_of(seed)
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, n int").repartition(3)
    got = sorted((tuple(r) for r in jaccard_components(df, size=size, percent=percent).collect()), key=str)
    assert got == brute(rows, size, percent)


def test_many_sets_at_a_member_and_wide_signatures(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "MANY", 1)
    monkeypatch.setattr(jaccard, "WIDE_FROM", 20)
    monkeypatch.setattr(jaccard, "MAX_BROADCAST", 5)
    rows = rows_of(9, 70)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert sorted((tuple(r) for r in jaccard_components(df, size=3, percent=80).collect()), key=str) == brute(rows, 3, 80)


def test_unique_ids(spark):
    rows = [(d, t) for d, t in rows_of(6)[:90]]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted((tuple(r) for r in jaccard_components(df, size=3, percent=90).collect()), key=str) == brute(rows, 3, 90)


def test_rows_without_id_do_not_join_classes(spark):
    one, two = (" ".join(f"{x}{i}" for i in range(20)) for x in "ab")
    got = jaccard_components(spark.createDataFrame([(1, one), (2, two), (None, one), (None, two)], "doc_id long, text string"))
    assert sorted(((r.doc_id, r.component_id) for r in got.collect()), key=str) == [(1, 1), (2, 2), (None, 1), (None, 2)]


def test_empty_table(spark):
    assert jaccard_components(spark.createDataFrame([], "doc_id long, text string")).collect() == []
