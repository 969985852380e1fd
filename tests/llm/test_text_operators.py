import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from strandloom.llm import decontam, html_extract, quality, token_counts

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))


def test_contamination_against_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice(["Alpha", "beta", "é7", "x", "y_z"]) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 4, 20, 25]))) for i in range(6)] + [(9, None), (None, "only unnamed words here"), (3, text(15))]
    docs = [(i, text(rng.randint(0, 60)) + " " + (rng.choice(items)[1] or "") * (i % 2)) for i in range(40)]
    docs += [(100, None), (None, "only UNNAMED words here"), (1, docs[1][1])]
    windows = {}
    for item, t in items:
        w = words(t)
        k = min(13, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            windows.setdefault(tuple(w[i : i + k]), set()).add(item)
    want = []
    for d, t in docs:
        w = words(t)
        hit, found = set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                who = windows.get(tuple(w[i : i + k]))
                if who:
                    hit |= set(range(i, i + k))
                    found |= {str(x) for x in who if x is not None}
        want.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    a = spark.createDataFrame([(*x, "t") for x in docs], "doc_id long, text string, items string").repartition(2)
    b = spark.createDataFrame(items, "item_id long, text string")
    for most in (1_000_000, 20):
        monkeypatch.setattr(decontam, "MAX_WINDOWS", most)
        got = [tuple(r[c] for c in ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")) for r in decontam.contamination(a, b).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert decontam.contamination(a.limit(0), b).collect() == []
    assert not any(r.n_hit for r in decontam.contamination(a, b.limit(0)).collect())


def test_spans_and_rows_are_removed(spark, monkeypatch):
    item = " ".join(f"w{i}" for i in range(20))
    docs = [(1, f"Before it, ({item.upper()}) and after."), (1, "clean"), (None, item), (None, None), (2, f"{item}! x {item}"), (3, item[:30])]
    a = spark.createDataFrame([(*x, "t", 5) for x in docs], "doc_id long, text string, hits string, row int")
    b = spark.createDataFrame([(1, item)], "item_id long, text string")
    for most in (500_000, 3):
        monkeypatch.setattr(decontam, "MAX_WINDOWS", most)
        got = decontam.without_spans(a, b)
        assert got.columns == a.columns
        assert sorted(((r.doc_id, r.text, r.hits, r.row) for r in got.collect()), key=str) == sorted([(1, "Before it, () and after.", "t", 5), (1, "clean", "t", 5), (None, "", "t", 5), (None, None, "t", 5), (2, "! x ", "t", 5), (3, item[:30], "t", 5)], key=str)
        kept = decontam.uncontaminated(a, b)
        assert kept.columns == a.columns and sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(1, "clean"), (None, None), (3, item[:30])], key=str)


def test_token_counts_equal_the_library(spark, tmp_path):
    from tokenizers import Tokenizer

    texts = ["a<|endoftext|>b <|startoftext|>", "é ́x\nA'S it's 've", "Ω x\x1cy\tz Σ ΑΣ ", " ", "", None, "12 3a4 don't!!??", "word " * 3000, "a" * 5000, "12 3a4 don't!!??"]
    library = Tokenizer.from_file(token_counts.locate("word_bpe_49k.json"))
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, digest int").repartition(2)
    want = {i: (len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in enumerate(texts)}
    cache = f"file://{tmp_path}/cache"
    for _ in range(2):
        got = token_counts.token_counts(df, "word_bpe_49k.json", cache=cache).collect()
        assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in got} == want
        assert all(r.over_limit == (r.n_tokens > 2048) for r in got)
    stored = spark.read.parquet(cache)
    assert stored.count() == stored.select("digest").distinct().count() == len({t or "" for t in texts})
    piece = token_counts.token_counts(df, "piece_bpe_32k.model").collect()
    assert all(r.n_tokens >= 0 for r in piece) and len(piece) == len(texts)


def test_quality_on_held_out_rows(spark, sf_dir):
    docs = spark.read.parquet(sf_dir.replace("sf0.001", "sf0.01") + "/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(sf_dir.replace("sf0.001", "sf0.01") + "/labels.parquet")
    model = quality.fit(docs, labels)
    assert np.array_equal(model.weights, quality.fit(docs.repartition(3), labels).weights)
    rows = quality.score(docs, model).join(labels, "doc_id").filter("crc32(cast(doc_id as string)) % 5 = 0").collect()
    assert sum((r.score >= 0.5) == (r.quality == 1) for r in rows) / len(rows) > 0.9
    odd = spark.createDataFrame([(1, None, 5), (None, "", 6), (2, "x" * 100_000, 7)], "doc_id long, text string, score int")
    got = quality.score(odd, model).collect()
    assert len(got) == 3 and all(0 <= r.score <= 1 for r in got) and got[0].score == got[1].score
    assert quality.score(odd.limit(0), model).collect() == []


def naive_features(text):
    """Buckets of every feature occurrence, token by token in plain Python."""
    from strandloom.llm import kernels as K

    m = (1 << 64) - 1

    def mix(h, seed):
        return int(K.mix(np.array([h & m], K.U), seed)[0])

    def poly(data):
        return sum(int(K._bytes[c]) * pow(K.BASE, i, 1 << 64) for i, c in enumerate(data)) & m

    bucket = lambda h, kind: mix(h, kind) >> 24 & quality.BUCKETS - 1
    raw = (text or "").encode()
    words, before = [], None
    for w in re.findall(rb"[^\x20\x09-\x0D]+", raw):
        words.append(77 if w == before else mix(poly(w), 0))
        before = w
    out = []
    for size in (1, 2, 3):
        for i in range(len(words) - size + 1):
            h = 0
            for x in words[i : i + size]:
                h = (h * 3 + x) & m
            out.append(bucket(h, size))
    for size in (3, 4, 5):
        out += [bucket(poly(raw[i : i + size]), 10 + size) for i in range(len(raw) - size + 1) if not re.search(rb"[\x20\x09-\x0D]", raw[i + 1 : i + size - 1])]
    return out


def test_quality_scores_against_a_plain_scorer(spark):
    texts = ["one", "", None, "the the the end", "É é  x\ty\n\nlast words, here. 123", "ab", " lead", "a a b b a a"]
    rng = np.random.default_rng(4)
    model = quality.Model(rng.normal(0, 1, quality.BUCKETS).astype(np.float32), 0.25)
    got = {r.doc_id: r.score for r in quality.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1), model).collect()}
    for i, t in enumerate(texts):
        f = naive_features(t)
        z = (sum(float(model.weights[x]) for x in f) / len(f) if f else 0.0) + 0.25
        assert abs(got[i] - 1 / (1 + np.exp(-z))) < 1e-9


def test_quality_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(2)
    vectors, layer, bias = rng.normal(0, 1, (9, 4)), rng.normal(0, 1, (4, 2)), rng.normal(0, 1, 2)
    flat, owner, labels = np.array([0, 3, 5, 3, 8, 1]), np.array([0, 0, 1, 1, 2, 2]), np.array([0, 1, 1])
    share = np.array([0.25, 0.75, 0.5, 0.5, 0.1, 0.9])
    loss = lambda: quality.gradients(vectors, layer, bias, flat, share, owner, labels)[0]
    _, g_layer, g_bias, g_vectors, used = quality.gradients(vectors, layer, bias, flat, share, owner, labels)
    full = np.zeros_like(vectors)
    full[used] = g_vectors
    numeric(loss, [(vectors, full), (layer, g_layer), (bias, g_bias)])


def numeric(loss, pairs, step=1e-5, close=1e-4):
    """Each gradient equals the difference quotient of the loss in every place."""
    for values, gradient in pairs:
        for at in np.ndindex(values.shape):
            held = values[at]
            values[at] = held + step
            high = loss()
            values[at] = held - step
            low = loss()
            values[at] = held
            assert abs((high - low) / (2 * step) - gradient[at]) < close


def test_labeller_gradients_are_those_of_the_loss(monkeypatch):
    monkeypatch.setattr(html_extract, "WIDTH", 5)
    monkeypatch.setattr(html_extract, "HIDDEN", 3)
    model, rng = html_extract.Labeller(3), np.random.default_rng(6)
    for name in ("w", "u", "b"):
        setattr(model, name, [x.astype(np.float64) for x in getattr(model, name)])
    model.out, model.bias = model.out.astype(np.float64), np.array([0.3])
    x, mask = rng.normal(0, 1, (4, 2, 5)), np.array([[1, 1], [1, 1], [1, 0], [1, 0]], bool)
    y = np.array([[1, 0], [0, 1], [1, 0], [0, 0]], float)
    _, grads = model.gradients(x, mask, y)
    # The recurrence runs in single precision.
    numeric(lambda: model.gradients(x, mask, y)[0], list(zip(model.parameters(), grads)), step=1e-2, close=5e-3)


def test_quality_learns_from_4000_rows(spark, monkeypatch):
    monkeypatch.setattr(quality, "_trained", lambda batches: iter([pa.RecordBatch.from_arrays([pa.array([np.zeros(quality.BUCKETS, np.float32).tobytes()], pa.binary()), pa.array([float(sum(b.num_rows for b in batches))])], names=["weights", "bias"])]))
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), "id").alias("text"))
    labels = docs.select("doc_id", F.pmod("doc_id", F.lit(2)).cast("int").alias("quality"))
    assert quality.fit(docs, labels).bias == 4000


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header class="site-header"><a href="/">Home</a></header>
<nav><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></nav><div id="cookie-notice">We use cookies.</div>
<article><h1>A  title &amp; more</h1><p>First   para<br>line two.<p>Second <b>bold</b> para &lt;ok&gt; with a number of further words.</p>
<div class="ad">Buy now!</div><p>Third paragraph of the text, long enough to be prose.</p></article>
<section class="comments"><h3>Comments</h3><div class="comment"><p>I do not agree at all.</p></div></section><form><label>Mail</label></form>
<aside class="sidebar"><ul><li><a href="/c">Related story</a></li></ul></aside><footer>&copy; site</footer><script>var x = "<p>no</p>";</script></body></html>"""


def test_html_extraction(spark):
    df = spark.createDataFrame([(1, "u", PAGE, "t"), (2, None, None, "t"), (None, "v", "", "t"), (3, "w", "<p>" * 3000, "t")], "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in html_extract.extract_text(df).collect()}
    assert got[1].text == "A title & more\n\nFirst para line two.\n\nSecond bold para <ok> with a number of further words.\n\nThird paragraph of the text, long enough to be prose."
    assert got[1].n_chars == len(got[1].text) and got[2].text == "" and got[None].n_chars == 0 and got[3].text == ""
    assert html_extract.extract_text(df.limit(0)).collect() == []


def test_labeller_on_unseen_layouts():
    model, wrong, total = html_extract.trained(), 0, 0
    for page, labels in html_extract.training_pages(150, 4321):
        found = html_extract.blocks(page)
        wrong += int((html_extract.labels(model, [found])[0] != np.array(labels)).sum())
        total += len(labels)
    assert wrong / total < 0.02


def test_scanner_keeps_text():
    texts = lambda page: [x for _, x, _ in html_extract.blocks(page)]
    assert texts("<p>" + "İ" * 40 + "</p><script>x</script><p>whole next paragraph</p><p>and more</p>")[1:] == ["whole next paragraph", "and more"]
    assert texts("<p don't>text is here</p><p>it's</p>") == ["text is here", "it's"]
    assert texts('<p class="x>open</p><p>rest</p>') == ["open", "rest"]
    assert texts("<script>a</scripty>b</SCRIPT ><p>c</p>") == ["c"]
    assert texts("<script>var a; <p>kept</p>") == ["kept"] and texts("<title>t <p>x") == ["x"]
    assert texts("<p>sum <math><mi>x</mi></math></p><svg><title>t</title><text>z</text></svg><p>d") == ["sum x", "z", "d"]
    assert texts("<textarea>a<p>b</textarea><select><option>1</select><template><p>t</p></template>c") == ["c"]
    assert texts('<a title="1 > 0" href=x>link</a> on') == ["link on"]


def test_splits_only_known_tokenizers(tmp_path):
    import json

    path = token_counts.locate("word_bpe_49k.json")
    assert token_counts.splits(path)
    spec = json.load(open(path))
    for change in (lambda s: s["pre_tokenizer"]["pretokenizers"][0]["pattern"].update(Regex=r"\w+|\s+"), lambda s: s["normalizer"]["normalizers"].append({"type": "Strip", "strip_left": True, "strip_right": True}), lambda s: s["added_tokens"].append({**s["added_tokens"][0], "content": "a b"})):
        other = json.loads(json.dumps(spec))
        change(other)
        name = f"{tmp_path}/x.json"
        json.dump(other, open(name, "w"))
        assert not token_counts.splits(name)


def test_counts_of_a_content_of_very_many_rows(spark):
    df = spark.createDataFrame([(i, "the hot text" if i % 3 else f"text {i}") for i in range(600)], "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(df, "word_bpe_49k.json").collect()}
    count = token_counts.load("word_bpe_49k.json")
    assert got == {i: count(["the hot text" if i % 3 else f"text {i}"])[0] for i in range(600)}


def test_vectors_read_whole_blocks():
    words = [f"Word{i}" if i % 3 else f"é{i}É" for i in range(500)]
    text = " ".join(words)
    row = html_extract.vectors([(("p",), text, 0.0)])[0]
    counts = [0] * html_extract.WORD_DIM
    for w in words:
        counts[html_extract._hash(w.lower(), html_extract.WORD_DIM)] += 1
    at = html_extract.PATH_DIM
    assert np.allclose(row[at : at + html_extract.WORD_DIM], np.array(counts) / len(words))
    assert np.allclose(row[-4:-2], [sum(c.isupper() for c in text) / len(text), sum(c.isdigit() for c in text) / len(text)])


def test_table_pages_match_their_articles(spark, sf_dir):
    import html

    for r in html_extract.extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet")).join(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html"), "page_id").collect():
        body = r.html.split("<article>")[1].split("</article>")[0]
        parts = (re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*(>|$)", "", x))).strip() for x in re.split(r"<p>|</p>|</?h1>", body))
        assert r.text == "\n\n".join(x for x in parts if x)
