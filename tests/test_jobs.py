import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from jobs import allele_catalogue, bait_screen, queries
from jobs.common import name_of, settings

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COMPLEMENT = str.maketrans("ACGT", "TGCA")


def rc(s):
    return s.translate(COMPLEMENT)[::-1]


def bases(n, seed):
    x, out = seed * 7919 + 1, []
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append("ACGT"[(x >> 16) & 3])
    return "".join(out)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def table(spark, rows, schema, path, mode="overwrite"):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode(mode).parquet(path)
    return path


CONTIGS, BAITS = "source string, doc_id string, text string", "item_id string, text string"


@pytest.fixture
def here(tmp_path):
    return lambda name: f"file://{tmp_path}/{name}"


def screen(spark, here, contigs, baits, **more):
    values = {"contigs": table(spark, contigs, CONTIGS, here("contigs")), "baits": table(spark, baits, BAITS, here("baits")), "output": here("out"), "letters": False}
    config = settings(bait_screen.DEFAULTS, values | more)
    return config, bait_screen.run(spark, config)


def test_screen_finds_baits_on_either_strand(spark, here):
    one, two = bases(200, 1), bases(150, 2)
    changed = one[:100] + {"A": "C", "C": "G", "G": "T", "T": "A"}[one[100]] + one[101:]
    contigs = [("s1", "c1", bases(50, 3) + one + bases(50, 4)), ("s1", "c2", rc(one).lower()), ("s1", "c3", changed), ("s2", "c1", two[:60]), ("s2", "c2", two[:100]), (None, "c1", one + two), (" ", "c9", one), ("s3", None, one), ("s3", "c4", None), ("s3", "c5", ""), ("007", "c1", one)]
    baits = [("one", one), ("two", two), ("same", one), ("short", "ACGT"), ("empty", None), ("empty", "A"), (None, one), ("gap", "AC-GT" * 10)]
    config, counts = screen(spark, here, contigs, baits, k=21)
    hits = {(r.sample, r.contig, r.bait): (r.strand, r.found, r.n_kmers, r.ambiguous) for r in bait_screen.read(spark, config["output"], "hits").collect()}
    n = 200 - 20
    assert hits["s1", "c1", "one"] == ("+", n, n, True) and hits["s1", "c2", "one"] == ("-", n, n, True)
    assert hits["s1", "c3", "one"] == ("+", n - 21, n, True) and hits["s2", "c2", "two"] == ("+", 80, 130, False)
    assert ("s2", "c1", "two") not in hits and hits["unnamed", "c1", "two"] == ("+", 130, 130, True)
    assert ("unnamed", "c9", "one") in hits and ("s3", None, "one") in hits and ("007", "c1", "one") in hits
    report = {(r.sample, r.bait): tuple(r)[1:6] for r in bait_screen.read(spark, config["output"], "report").collect()}
    assert report["s1", "one"] == ("PRESENT_MULTIPLE", 1.0, "c1", 2, 1) and report["s2", "two"] == ("PARTIAL", 80 / 130, "c2", 0, 1)
    rejected = rows_of(bait_screen.read(spark, config["output"], "rejected"))
    assert rejected == sorted([("short", "shorter than a k-mer"), ("empty", "repeated id"), (None, "no id"), ("gap", "alignment gaps")], key=repr)
    assert counts["contigs"] == len(contigs) and counts["baits"] == len(baits) and counts["hits"] == len(hits) and counts["rejected"] == 4


def test_screen_again_gives_the_same(spark, here, monkeypatch):
    one = bases(120, 5)
    config, counts = screen(spark, here, [("s", str(i), one) for i in range(30)], [("one", one)])
    first = [rows_of(bait_screen.read(spark, config["output"], t)) for t in ("hits", "report", "rejected")]
    monkeypatch.setattr(bait_screen, "MAX_BROADCAST", 0)  # the join without a broadcast
    assert bait_screen.run(spark, config) == counts
    assert [rows_of(bait_screen.read(spark, config["output"], t)) for t in ("hits", "report", "rejected")] == first
    config, counts = screen(spark, here, [], [])
    assert set(counts.values()) == {0} and rows_of(bait_screen.read(spark, config["output"], "report")) == []


def brute_catalogue(contigs, known, least, most, min_samples):
    seen = {}
    for sample, contig, text in contigs:
        for line in (text or "").split("\n"):
            s = line.upper()
            if least <= len(s) <= most:
                seen.setdefault(min(s, rc(s)), []).append(((sample or "").strip() or "unnamed", contig))
    names = {}
    for i, text in known:
        for line in (text or "").split("\n"):
            names.setdefault(min(line.upper(), rc(line.upper())), set()).add(i)
    out = []
    for allele, at in seen.items():
        samples = {s for s, _ in at}
        name = min(names[allele]) if allele in names else None
        out.append((allele, len(allele), name, len(at), len(set(at)), len(samples), min(c for _, c in at), "accepted" if name else "review" if len(samples) >= min_samples else "hold"))
    return sorted(out, key=repr)


def catalogue(spark, config):
    return rows_of(allele_catalogue.read(spark, config["output"]).select("allele", "length", "known_id", "sightings", "contigs", "n_samples", "first_contig", "disposition"))


def test_catalogue_grows_with_its_input(spark, here):
    a, b, c, d = (bases(80, i) for i in range(10, 14))
    known = [("k2", a), ("k1", rc(a)), ("k3", "ACGT")]
    first = [("s1", "c1", f"{a}\n{b}\nACGT"), ("s1", "c2", f"{rc(b)}\n{b}"), (None, "c3", c), ("s2", "c4", None)]
    second = [("s2", "c5", f"{b.lower()}\n{d}"), (" ", "c6", d)]
    values = {"contigs": table(spark, first, CONTIGS, here("contigs")), "known": table(spark, known, BAITS, here("known")), "output": here("out"), "letters": False}
    config = settings(allele_catalogue.DEFAULTS, values)
    assert allele_catalogue.run(spark, config)["new_contigs"] == len(first)
    assert catalogue(spark, config) == brute_catalogue(first, known, 60, 20000, 2)
    before = rows_of(allele_catalogue.read(spark, config["output"]))
    assert allele_catalogue.run(spark, config)["new_contigs"] == 0  # nothing is new, nothing changes
    assert rows_of(allele_catalogue.read(spark, config["output"])) == before
    table(spark, second, CONTIGS, values["contigs"], "append")
    assert allele_catalogue.run(spark, config)["new_contigs"] == len(second)
    assert catalogue(spark, config) == brute_catalogue(first + second, known, 60, 20000, 2)
    assert {r.disposition for r in allele_catalogue.read(spark, config["output"]).collect()} == {"accepted", "review", "hold"}


def test_catalogue_repeats_a_batch_that_was_cut_off(spark, here, monkeypatch):
    rows = [("s1", f"c{i}", bases(70, 20 + i % 3)) for i in range(12)]
    values = {"contigs": table(spark, rows, CONTIGS, here("contigs")), "known": table(spark, [], BAITS, here("known")), "output": here("out"), "letters": False}
    config = settings(allele_catalogue.DEFAULTS, values)
    whole = allele_catalogue.sightings_of

    def broken(batch, settings_):
        out = whole(batch, settings_)
        return out.withColumn("allele", F.when(F.col("signature") != "", F.raise_error(F.lit("lost"))).cast("string"))

    monkeypatch.setattr(allele_catalogue, "sightings_of", broken)
    with pytest.raises(Exception):
        allele_catalogue.run(spark, config)
    monkeypatch.setattr(allele_catalogue, "sightings_of", whole)
    allele_catalogue.run(spark, config)
    assert catalogue(spark, config) == brute_catalogue(rows, [], 60, 20000, 2)


def test_sequences_are_shuffled_once_a_step(spark, here):
    a, b = bases(90, 40), bases(90, 41)
    rows = [(f"s{i % 2}", f"c{i}", f"{a}\n{rc(a)}\n{b if i % 3 else ''}") for i in range(60)] + [("s1", None, a), ("s1", None, a), (None, "c1", b)]
    values = {"contigs": table(spark, rows, CONTIGS, here("contigs")), "known": table(spark, [("k", b)], BAITS, here("known")), "output": here("out"), "letters": False}
    config = settings(allele_catalogue.DEFAULTS, values)
    found = allele_catalogue.sightings_of(spark.read.parquet(values["contigs"]), config)
    assert {(r.allele, r["sample"]): (r.sightings, r.contigs) for r in found.groupBy("allele", "sample").agg(F.sum("sightings").alias("sightings"), F.sum("contigs").alias("contigs")).collect()} == {(min(a, rc(a)), "s0"): (60, 30), (min(a, rc(a)), "s1"): (62, 31), (min(b, rc(b)), "s0"): (20, 20), (min(b, rc(b)), "s1"): (20, 20), (min(b, rc(b)), "unnamed"): (1, 1)}
    assert found.count() > 5  # an allele of many contigs is in several shares
    held = spark.read.schema(allele_catalogue.SIGHTINGS).parquet(table(spark, [tuple(r) + (0,) for r in found.collect()], allele_catalogue.SIGHTINGS, here("held")))
    known = spark.createDataFrame([(min(b, rc(b)), "k")], "allele string, known_id string")
    got = allele_catalogue.catalogue_of(held, F.broadcast(known), 2)
    assert {r.allele: (r.sightings, r.contigs, r.n_samples, r.disposition) for r in got.collect()} == {min(a, rc(a)): (122, 61, 2, "review"), min(b, rc(b)): (41, 41, 3, "accepted")}
    for df in (allele_catalogue.sightings_of(spark.read.parquet(values["contigs"]), config), allele_catalogue.catalogue_of(held, F.broadcast(known), 2)):
        assert df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_catalogue_of_nothing(spark, here):
    values = {"contigs": table(spark, [], CONTIGS, here("contigs")), "known": table(spark, [], BAITS, here("known")), "output": here("out")}
    counts = allele_catalogue.run(spark, settings(allele_catalogue.DEFAULTS, values))
    assert set(counts.values()) == {0} and rows_of(allele_catalogue.read(spark, here("out"))) == []


def test_settings(spark, tmp_path):
    assert settings(bait_screen.DEFAULTS, {"k": 11, "letters": None})["k"] == 11
    with pytest.raises(ValueError, match="colour"):
        settings(bait_screen.DEFAULTS, {"colour": 1})
    names = spark.createDataFrame([("a ",), ("",), (None,)], "s string").select(name_of("s"))
    assert [r[0] for r in names.collect()] == ["a", "unnamed", "unnamed"]
    assert allele_catalogue.pattern("x/contigs/") == "x/contig[s]" and allele_catalogue.pattern("x/*.parquet") == "x/*.parquet"


def test_command_line(spark, here, tmp_path):
    one = bases(100, 6)
    contigs, baits = table(spark, [("s", "c", one)], CONTIGS, here("contigs")), table(spark, [("one", one)], BAITS, here("baits"))
    (tmp_path / "own.json").write_text(json.dumps({"contigs": contigs, "baits": baits, "output": here("ignored"), "letters": False}))
    env = os.environ | {"PYTHONPATH": ROOT}
    done = subprocess.run([sys.executable, "-m", "jobs.bait_screen", "--config", str(tmp_path / "own.json"), "--output", here("out"), "--k", "15"], env=env, cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "read 1 contigs and 1 baits" in done.stderr
    assert [(r.found, r.n_kmers) for r in bait_screen.read(spark, here("out"), "hits").collect()] == [(86, 86)]


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_equals_sql(spark, sf_dir, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"create view {t} as select * from read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    df = queries.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    result = con.execute(queries.SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr) == sorted((tuple(r[names.index(c)] for c in columns) for r in result.fetchall()), key=repr)
