"""Stages of the pipeline against brute force on small tables."""

import os
import random
import re

import duckdb
from pyspark.sql import functions as F

import corpus_pipeline
from strandloom.llm import common, mixing, pii, queries, quality
from tests.llm.test_jaccard import brute as classes
from tests.llm.test_mixing import level

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA).repartition(3)


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_stages_judge_rows_that_share_an_id(spark, tmp_path):
    rng = random.Random(5)
    text = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    leak, a, b, c, d = (text(60) for _ in range(5))
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, leak), (None, a), (7, leak), (7, b), (8, c), (None, None), (9, "x " + leak)]
    got = corpus_pipeline.decontaminated(spark, table(spark, rows), str(tmp_path))
    assert pairs(got) == sorted([(None, a), (7, b), (8, c), (None, None)], key=str)

    near = a + " more"
    rows = [(None, a), (None, a), (None, near), (7, b), (7, c), (8, b), (7, b), (3, d + " more"), (None, d), (None, None), (None, "")]
    got = pairs(corpus_pipeline.one_of_near_duplicates(spark, table(spark, rows), str(tmp_path)))
    assert [x for x in got if x[1] not in (a, near)] == sorted([(7, b), (7, c), (3, d + " more"), (None, None), (None, "")], key=str)
    assert sum(x[1] in (a, near) for x in got) == 1


def hits(words, windows, size=13):
    hit = set()
    for k in {len(w) for w in windows}:
        for i in range(len(words) - k + 1):
            if tuple(words[i : i + k]) in windows:
                hit |= set(range(i, i + k))
    return hit


def ascii_lower(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


def test_every_stage_against_plain_python(spark, sf_dir):
    """Each stage on all that the one before it kept of the smallest tables, with odd rows and clashing columns added."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    long = " ".join(f"word{i % 977} x" for i in range(20_000))
    odd = [(None, None, None, None, None), (None, long, "en", "s", 1), (None, long + " more", "en", None, 1), (3, docs.filter("doc_id = 3").first().text, "en", None, 0), (3, long, "en", "s", 1), (4, "", "en", "s", 0)]
    now = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    stages = dict(corpus_pipeline.STAGES)
    rows = [tuple(r) for r in now.collect()]
    table = lambda x: spark.createDataFrame(x, docs.schema).select("*", *[F.lit("z").alias(c) for c in ("row", "hits", "score", "doc", "component_id", "kept", "rank", "size")]).repartition(3)
    run = lambda name, x: [tuple(r) for r in stages[name](spark, table(x), sf_dir).collect()]
    key = lambda r: str(r)

    kept = run("quality", rows)
    model = quality.fit(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    good = {r.text for r in quality.score(table(rows), model).filter("predicted = 1").collect()}
    assert sorted(kept, key=key) == sorted((r for r in rows if r[1] in good), key=key)

    unique = run("near_duplicates", kept)
    numbered = list(enumerate(kept))
    of = {d: c for d, n, c in classes([(i, r[1]) for i, r in numbered], 5, 80) if n}
    groups = {}
    for i, r in numbered:
        groups.setdefault(of.get(i, ("alone", i)), []).append(r)
    assert len(unique) == len(groups)
    for group in groups.values():
        ids = [r[0] for r in group if r[0] is not None]
        assert sum(unique.count(r) for r in {*group} if r[0] == (min(ids) if ids else None)) >= 1

    clean = run("decontamination", unique)
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = set()
    for item in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect():
        w = word.findall(ascii_lower(item.text))
        k = min(13, len(w))
        windows |= {tuple(w[i : i + k]) for i in range(len(w) - k + 1 if k else 0)}
    want = []
    for r in unique:
        w = word.findall(ascii_lower(r[1]))
        h = hits(w, windows)
        if not (h and 20 * len(h) >= len(w)):
            want.append(r)
    assert sorted(clean, key=key) == sorted(want, key=key)

    private = run("personal_data", clean)
    assert sorted((r[0], r[2], r[3]) for r in private if None not in r) == sorted((r[0], r[2], r[3]) for r in clean if None not in r)
    assert all(r[4] == (None if r[1] is None else len(r[1])) for r in private)
    assert not any(re.search(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r[1] or "") for r in private)
    untouched = {r.text for r in pii.report(table(clean)).join(table(clean).select(F.col("doc_id").alias("d"), "text"), F.col("doc_id") == F.col("d")).filter("spans = ''").collect()}
    assert {r[1] for r in clean if r[0] is not None and r[1] in untouched} <= {r[1] for r in private}

    mixed = stages["mixing"](spark, table(private), sf_dir).collect()
    size = lambda x: len(re.findall(r"[^\x20\x09-\x0D]+", x or ""))
    assert sorted((str(r.doc_id), r.size) for r in mixed) == sorted((str(r[0]), size(r[1])) for r in private)
    sizes = {}
    for r in private:
        sizes[r[3]] = sizes.get(r[3], 0) + size(r[1])
    names = sorted(s for s in sizes if s is not None) + [s for s in sizes if s is None]
    weights = dict(zip(names, [mixing.WEIGHTS[i % 3] for i in range(len(names))]))
    goal = level(sizes, weights, 1.5 * sum(sizes.values()))
    taken = {}
    for r in mixed:
        assert abs(r.target - goal[r.source]) < 1e-6 * max(goal[r.source], 1) and r.taken <= 2 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - goal[s]) <= 1 for s in sizes)


def test_scratch_is_empty_once_results_are_written(spark, sf_dir, tmp_path, monkeypatch):
    folder = tmp_path / "shared"
    monkeypatch.setattr(common, "scratch_dir", lambda spark: f"file://{folder}")
    for name in ("op2_suffix_dedup", "op3_mixing", "op8_jaccard", "op4_top_k", "op7_token_counts", "pipeline"):
        with common.swept():
            queries.QUERIES[name](spark, sf_dir).write.parquet(f"{tmp_path}/{name}")
        assert os.listdir(folder) == [], name
        assert duckdb.sql(f"select count(*) from '{tmp_path}/{name}/*.parquet'").fetchall()[0][0] > 0


def test_no_machine_local_scratch_on_a_cluster():
    import pytest

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        common.scratch_dir(Session())
