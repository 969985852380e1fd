"""Every operator on nulls in any column, empty and very long texts, repeated rows, empty tables and clashing column names."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_jaccard import brute as jaccard_brute
from tests.llm.test_suffix_dedup import brute as suffix_brute
from strandloom.llm import chat, decontam, html_extract, jaccard, knn, mixing, pii, quality, suffix_dedup, token_counts

LONG = " ".join(f"word{i % 977} x" for i in range(120_000))
REPEATED = "the quick brown fox jumps over the lazy dog while seven bright owls watch from an old oak tree"
CLASH = ("size", "kept", "score", "predicted", "spans", "n_tokens", "hash", "id", "key", "value", "n_words", "component_id", "doc", "text_", "shard", "block", "start", "end", "i", "n", "chat", "role_", "rank", "target", "taken", "raw", "digest", "item", "kind", "html_", "words", "label", "quality", "part")
TEXTS = [(1, REPEATED), (1, REPEATED), (2, REPEATED), (3, ""), (4, None), (None, REPEATED), (None, None), (5, LONG), (6, " \t\n "), (7, "\x00é\U0001f600 a"), (8, "one")]


def clashing(df):
    return df.select("*", *[F.lit("z").alias(c) for c in CLASH if c not in df.columns])


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if n % 3 else "a", None if n % 4 else "en", 1) for n, (i, t) in enumerate(TEXTS)]
    return clashing(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")).repartition(3).persist()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (3, 0, 0), (5, 0, None), (8, None, 0), (None, 1, 0), (2, 1, 1), (2, 0, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, REPEATED), (1, REPEATED), (None, "one"), (2, None), (3, "")], "item_id long, text string")


def results(name, docs, labels, items):
    if name == "quality":
        return quality.score(docs, quality.fit(docs, labels), name="own_score", decision="own_decision").select("doc_id", "own_score", "own_decision")
    if name == "suffix":
        return suffix_dedup.suffix_dedup(docs, length=50)
    if name == "mixing":
        return mixing.taken(docs).select("doc_id", "size", "source_size", "target", "taken")
    if name == "decontam":
        return decontam.contamination(docs, items)
    if name == "pii":
        return pii.report(docs)
    if name == "tokens":
        return token_counts.token_counts(docs, "word_bpe_49k.json")
    return jaccard.jaccard_components(docs, size=3, percent=90)


NAMES = ["quality", "suffix", "mixing", "decontam", "pii", "tokens", "jaccard"]


@pytest.mark.parametrize("name", NAMES)
def test_documents(docs, labels, items, name):
    rows = results(name, docs, labels, items).collect()
    assert len(rows) == len(TEXTS)
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, _ in TEXTS)
    assert results(name, docs.limit(0), labels, items).collect() == []


def by_row(rows, *columns):
    return sorted((tuple(r[c] for c in ("doc_id", *columns)) for r in rows), key=str)


def expected(*values):
    """One tuple a row of TEXTS, in its order."""
    return sorted([(i, *v) for (i, _), v in zip(TEXTS, values, strict=True)], key=str)


def test_values_of_odd_rows(docs, labels, items):
    get = lambda name: results(name, docs, labels, items).collect()
    utf8 = [len((t or "").encode()) for _, t in TEXTS]
    blank = [len((t or "").replace("\x00", "a").split()) for _, t in TEXTS]
    whole = len(REPEATED)
    own_repeats = suffix_brute([(d, t) for d, t in TEXTS], 50)
    assert by_row(get("suffix"), "n_bytes", "n_removed", "n_spans", "kept_sha256") == own_repeats
    assert sum(r[2] == whole for r in own_repeats) == 2 and sum(r[2] > 0 for r in own_repeats) == 2
    assert by_row(get("mixing"), "size") == expected(*((n,) for n in blank))
    assert all(0 <= r.taken <= 2 * r.size for r in get("mixing"))
    words = len(REPEATED.split())
    hit = [(words, words, 1, True) if t == REPEATED else (1, 1, 0, True) if t == "one" else (n, 0, 0, False) for (_, t), n in zip(TEXTS, [0, 0, 0, 0, 0, 0, 0, 240_000, 0, 2, 1])]
    assert by_row(get("decontam"), "n_words", "n_hit", "n_items", "contaminated") == expected(*hit)
    assert by_row(get("pii"), "n_email", "n_ip", "n_card", "n_phone", "spans") == expected(*((0, 0, 0, 0, "") for _ in TEXTS))
    count = token_counts.load("word_bpe_49k.json")
    tokens = [count([t or ""])[0] for _, t in TEXTS]
    assert by_row(get("tokens"), "n_bytes", "n_tokens", "over_limit") == expected(*((b, n, n > 2048) for b, n in zip(utf8, tokens)))
    assert by_row(get("jaccard"), "n_shingles", "component_id") == jaccard_brute(TEXTS, 3, 90)
    scores = {}
    for r in results("quality", docs, labels, items).join(docs.select("doc_id", "text").distinct().withColumnRenamed("doc_id", "d"), F.col("doc_id").eqNullSafe(F.col("d"))).collect():
        scores.setdefault(r.doc_id, set()).add(r.own_score)
    assert all(len(v) == 1 for d, v in scores.items() if d is not None) and scores[3] == scores[4] and scores[1] == scores[2]


@pytest.mark.parametrize("name", ["quality", "decontam"])
def test_empty_second_table(docs, labels, items, name):
    assert len(results(name, docs, labels.limit(0), items.limit(0)).collect()) == len(TEXTS)


def test_vectors(spark):
    v = [1.0, -0.5, 0.25]
    rows = [(0, v), (0, v), (100, [0.0, 0.0, 0.0]), (3, None), (4, [float("nan"), 0.0, 0.0]), (5, [None, 1.0, 1.0]), (6, v), (None, v), (7, [float("inf"), 0.0, 0.0]), (9, v)]
    df = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = knn.top_k(df, df.filter("vec_id % 100 = 0"), k=3).orderBy("query_id", "rank").collect()
    whole = np.floor(1024 * np.array(v)).astype(int)
    best = int(whole @ whole)
    # Either of the two rows 0 meets the other one, 6 and 9; all products with the row 100 are 0.
    assert [(r.query_id, r.vec_id, r.score) for r in got if r.query_id == 0] == sorted([(0, i, best) for i in (0, 6, 9)] * 2, key=lambda x: x[1])
    assert [(r.rank, r.vec_id, r.score) for r in got if r.query_id == 100] == [(1, 0, 0), (2, 0, 0), (3, 6, 0)]
    assert knn.top_k(df.limit(0), df.limit(0), k=3).collect() == []


def test_conversations(spark):
    rows = [("c", 1, "user", "hello there"), ("c", 1, "user", "hello there"), ("c", 2, "assistant", "> hello there\n\nhi"), ("c", None, None, None), (None, 1, "user", "x"), (None, None, None, ""), ("d", 1, "user", LONG), ("e", 1, None, None)]
    df = clashing(spark.createDataFrame(rows, "conv_id string, turn int, role string, text string"))
    got = chat.conversations(df).collect()
    found = sorted(((r.conv_id, r.turn, r.role, r.parent_turn, r.depth, r.text) for r in got), key=str)
    plain = [(c, t, r, None, 1, x or "") for c, t, r, x in rows]
    plain[2] = ("c", 2, "assistant", 1, 2, "hi")
    assert found == sorted(plain, key=str)
    assert chat.conversations(df.limit(0)).collect() == []


def test_pages(spark):
    html = "<html><body><nav><a href='/'>Home</a></nav><article><h1>Title</h1>" + "".join(f"<p>{REPEATED} {i}.</p>" for i in range(8)) + "</article></body></html>"
    rows = [(1, "u", html), (1, "u", html), (2, None, None), (None, None, ""), (3, "v", "<<<>&#xfffffff;&bogus;"), (4, "w", "<div>" * 5000 + REPEATED), (5, "x", "<article>" + f"<p>{REPEATED}</p>" * 20_000)]
    df = clashing(spark.createDataFrame(rows, "page_id long, url string, html string"))
    every = html_extract.extract_text(df).collect()
    got = {(r.page_id, r.url): r for r in every}
    assert sorted((str(r.page_id), str(r.url)) for r in every) == sorted((str(r[0]), str(r[1])) for r in rows)
    assert got[1, "u"].text == "\n\n".join(["Title", *(f"{REPEATED} {i}." for i in range(8))])
    assert got[5, "x"].text == "\n\n".join([REPEATED] * 20_000) and all(r.n_chars == len(r.text) for r in every)
    assert got[2, None].text == "" and got[2, None].n_chars == 0 and REPEATED in got[1, "u"].text
    assert html_extract.extract_text(df.limit(0)).collect() == []
