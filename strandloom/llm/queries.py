"""The operators bound to the synthetic tables, and SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.llm import centroids, chat, decontam, html_extract, jaccard, knn, line_dedup, mixing, pii, quality, suffix_dedup, token_counts


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, _table(spark, sf_dir, "labels"))
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0
    return quality.score(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(_table(spark, sf_dir, "documents"), length=50).drop("kept")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return knn.top_k(vectors, vectors.filter("vec_id % 100 = 0"), k=10, scale=1024)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), size=13, percent=5)
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(_table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), "word_bpe_49k.json", limit=2048)


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(_table(spark, sf_dir, "documents"), size=3, percent=90)


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.conversations(_table(spark, sf_dir, "conversations"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_text(_table(spark, sf_dir, "pages"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.lloyd(_table(spark, sf_dir, "embeddings"), k=16, rounds=3, dims=64, scale=64, seed=1)


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(_table(spark, sf_dir, "documents"), least=10, increments=2).drop("kept")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_mixing": op3_mixing,
    "op4_top_k": op4_top_k,
    "op5_decontamination": op5_decontamination,
    "op6_pii": op6_pii,
    "op7_token_counts": op7_token_counts,
    "op8_jaccard": op8_jaccard,
    "op9_chat": op9_chat,
    "op10_html_text": op10_html_text,
    "op11_centroids": op11_centroids,
    "op12_line_dedup": op12_line_dedup,
    "pipeline": pipeline,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op2_suffix_dedup": """
        WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS t FROM documents),
        s AS (SELECT doc_id, unnest(range(1, octet_length(t) - 48)) AS i, t FROM d),
        w AS (SELECT doc_id, i, t[i : i + 49] AS g FROM s),
        m AS (SELECT g, min(doc_id) AS least FROM w GROUP BY g),
        r AS (SELECT DISTINCT w.doc_id, w.i FROM w JOIN m ON w.g = m.g AND w.doc_id > m.least),
        j AS (SELECT doc_id, i, CASE WHEN lag(i) OVER o IS NULL OR lag(i) OVER o + 50 < i THEN 1 ELSE 0 END AS fresh FROM r WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
        k AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS span FROM j),
        p AS (SELECT doc_id, span, min(i) AS a, max(i) + 49 AS z FROM k GROUP BY 1, 2),
        x AS (SELECT doc_id, sum(z - a + 1) AS removed, count(*) AS spans FROM p GROUP BY 1),
        q AS (SELECT doc_id, span AS place, z + 1 AS a, coalesce(lead(a) OVER (PARTITION BY doc_id ORDER BY span) - 1, octet_length(t)) AS z, t FROM p JOIN d USING (doc_id)
              UNION ALL SELECT doc_id, 0, 1, min(a) - 1, any_value(t) FROM p JOIN d USING (doc_id) GROUP BY 1),
        f AS (SELECT doc_id, string_agg(CASE WHEN a <= z THEN hex(t[a : z]) ELSE '' END, '' ORDER BY place) AS h FROM q GROUP BY 1)
        SELECT d.doc_id, CAST(octet_length(d.t) AS BIGINT) AS n_bytes, CAST(coalesce(x.removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(x.spans, 0) AS BIGINT) AS n_spans, sha256(CASE WHEN f.h IS NULL THEN d.t ELSE unhex(f.h) END) AS kept_sha256
        FROM d LEFT JOIN x ON d.doc_id = x.doc_id LEFT JOIN f ON d.doc_id = f.doc_id
    """,
    "op4_top_k": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
                   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(q.e, d.e) AS BIGINT) AS score FROM v q JOIN v d ON q.vec_id % 100 = 0 AND d.vec_id <> q.vec_id),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM s)
        SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, score FROM r WHERE k <= 10
    """,
    "op5_decontamination": """
        WITH w AS (SELECT doc_id, regexp_extract_all(LOWERED, '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS w FROM documents),
        b AS (SELECT item_id, regexp_extract_all(LOWERED, '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS w FROM benchmark),
        m AS (SELECT item_id, w, least(len(w), 13) AS k FROM b WHERE len(w) > 0),
        g AS (SELECT DISTINCT item_id, k, array_to_string(w[i : i + k - 1], ' ') AS g FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM m)),
        ks AS (SELECT DISTINCT k FROM g),
        d AS (SELECT doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') AS g FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, ks WHERE len(w) >= k)),
        h AS (SELECT d.doc_id, d.i, d.k, g.item_id FROM d JOIN g ON d.g = g.g AND d.k = g.k),
        p AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM h) GROUP BY doc_id),
        t AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM h) GROUP BY doc_id)
        SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(p.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(t.n_items, 0) AS BIGINT) AS n_items,
               sha256(coalesce(t.items, '')) AS items_sha256, coalesce(p.n_hit, 0) > 0 AND 20 * coalesce(p.n_hit, 0) >= len(w.w) AS contaminated
        FROM w LEFT JOIN p ON w.doc_id = p.doc_id LEFT JOIN t ON w.doc_id = t.doc_id
    """.replace("LOWERED", _LOWER),
    "op8_jaccard": """
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(LOWERED, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i : i + 2], ' ')) END) AS g FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
        l AS (SELECT a, b FROM c JOIN n x ON c.a = x.doc_id JOIN n y ON c.b = y.doc_id WHERE 100 * k >= 90 * (x.n + y.n - k)),
        r(doc_id, reached) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.reached = l.a)
        SELECT r.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(reached) AS component_id FROM r LEFT JOIN n ON r.doc_id = n.doc_id GROUP BY r.doc_id
    """.replace("LOWERED", _LOWER),
}

_SPANS = """
    SELECT doc_id, t, rank, kind, unnest(m) AS match, unnest(range(1, len(m) + 1)) AS i, m, p FROM
    (SELECT doc_id, t, RANK AS rank, 'KIND' AS kind, regexp_extract_all(t, 'PATTERN') AS m, string_split_regex(t, 'PATTERN') AS p FROM d)
"""
# The plain patterns: the engine that runs this SQL has neither lookbehind nor possessive quantifiers.
_PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
    "card": r"[0-9](?:[ -]?[0-9])+",
}


def _pii_sql() -> str:
    every = " UNION ALL ".join(_SPANS.replace("RANK", str(i)).replace("KIND", k.name).replace("PATTERN", _PLAIN.get(k.name, k.pattern)) for i, k in enumerate(pii.KINDS))
    luhn = "list_sum(list_transform(range(1, len(DIGITS) + 1), lambda i: CASE WHEN (len(DIGITS) - i) % 2 = 0 THEN CAST(DIGITS[i] AS INTEGER) ELSE CAST(DIGITS[i] AS INTEGER) * 2 - CASE WHEN CAST(DIGITS[i] AS INTEGER) > 4 THEN 9 ELSE 0 END END)) % 10 = 0"
    part = "(25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
    score = " ".join(f"WHEN '{k.name}' THEN {k.score} + CASE WHEN regexp_matches(near, '{k.context}') THEN {pii.BONUS} ELSE 0 END" for k in pii.KINDS)
    base = ", ".join(f"'{k}'" for k in pii.BASE)
    return f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        m AS ({every}),
        s AS (SELECT doc_id, t, rank, kind, match, CAST(len(array_to_string(list_transform(range(1, i + 1), lambda j: p[j]), '')) + len(array_to_string(m[1 : i - 1], '')) AS BIGINT) AS start FROM m),
        n AS (SELECT *, start + len(match) AS stop, regexp_replace(match, '[^0-9]', '', 'g') AS digits, replace(match, ' ', '') AS tight,
                     CASE WHEN start > 0 THEN t[start : start] ELSE '' END AS before, t[start + len(match) + 1 : start + len(match) + 1] AS after,
                     translate(t[greatest(start - {pii.NEAR}, 0) + 1 : start] || ' ' || t[start + len(match) + 1 : start + len(match) + {pii.NEAR}], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS near FROM s),
        g AS (SELECT * FROM n WHERE CASE kind
            WHEN 'email' THEN true
            WHEN 'ip' THEN regexp_matches(match, '^0*{part}(\\.0*{part}){{3}}$')
            WHEN 'card' THEN CASE WHEN len(digits) BETWEEN 14 AND 19 THEN {luhn.replace("DIGITS", "digits")} ELSE false END
            WHEN 'phone' THEN len(digits) BETWEEN 10 AND 15
            WHEN 'iban' THEN CASE WHEN NOT regexp_matches(before, '[A-Za-z0-9]') AND NOT regexp_matches(after, '[A-Za-z0-9]') AND len(tight) BETWEEN 15 AND 34
                THEN list_reduce(list_prepend(0, list_transform(range(1, len(tight) + 1), lambda i: CASE WHEN (tight[5:] || tight[:4])[i] BETWEEN '0' AND '9' THEN CAST((tight[5:] || tight[:4])[i] AS INTEGER) ELSE 1000 + ascii((tight[5:] || tight[:4])[i]) - 55 END)), lambda a, c: CASE WHEN c >= 1000 THEN (a * 100 + c - 1000) % 97 ELSE (a * 10 + c) % 97 END) = 1 ELSE false END
            WHEN 'pan' THEN CASE WHEN len(match) BETWEEN 13 AND 19 THEN {luhn.replace("DIGITS", "match")} ELSE false END
            WHEN 'ssn' THEN regexp_matches(match, '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$')
            WHEN 'secret' THEN NOT regexp_matches(before, '[A-Za-z0-9]') AND NOT regexp_matches(after, '[A-Za-z0-9]') END),
        k AS (SELECT * FROM g WHERE kind IN ({base}) OR CASE kind {score} END >= {pii.LEAST}),
        f AS (SELECT * FROM k WHERE kind <> 'pan' OR NOT EXISTS (SELECT 1 FROM k c WHERE c.doc_id = k.doc_id AND c.kind = 'card' AND c.start <= k.start AND k.stop <= c.stop)),
        a AS (SELECT doc_id, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans,
                     coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (kind IN ({base})), '') AS base,
                     {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in pii.BASE)} FROM f GROUP BY doc_id)
        SELECT d.doc_id, {", ".join(f"CAST(coalesce(n_{k}, 0) AS BIGINT) AS n_{k}" for k in pii.BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN a ON d.doc_id = a.doc_id
    """


ORACLES["op6_pii"] = _pii_sql()


def _lloyd_sql(k: int = 16, rounds: int = 3) -> str:
    """Rounds written out one after the other; dot products of integers below 2**53 are exact in doubles."""
    near = """a{r} AS MATERIALIZED (SELECT row, vec_id, q, cluster, distance FROM
                (SELECT v.row, v.vec_id, v.q, c.cluster, v.qq - 2 * list_dot_product(v.q, c.q) + list_dot_product(c.q, c.q) AS distance,
                        row_number() OVER (PARTITION BY v.row ORDER BY v.qq - 2 * list_dot_product(v.q, c.q) + list_dot_product(c.q, c.q), c.cluster) AS place FROM v, c{r} c) WHERE place = 1)"""
    move = """m{r} AS (SELECT cluster, list(x ORDER BY i) AS q FROM (SELECT cluster, i, floor(sum(x) / count(*)) AS x FROM
                (SELECT cluster, unnest(q) AS x, unnest(range(1, 65)) AS i FROM a{r}) GROUP BY cluster, i) GROUP BY cluster),
              c{n} AS MATERIALIZED (SELECT c.cluster, coalesce(m.q, c.q) AS q FROM c{r} c LEFT JOIN m{r} m ON c.cluster = m.cluster)"""
    steps = ", ".join(f"{near.format(r=r)}, {move.format(r=r, n=r + 1)}" for r in range(rounds))
    return f"""
        WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS q FROM embeddings
                   WHERE embedding IS NOT NULL AND len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        v AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, q, list_dot_product(q, q) AS qq FROM e),
        c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, q) - 1 AS cluster, q FROM (SELECT q, sha256('1:' || CAST(vec_id AS VARCHAR)) AS h FROM v ORDER BY h, q LIMIT {k})),
        {steps}, {near.format(r=rounds)},
        s AS (SELECT cluster, CAST(sum(distance) AS BIGINT) AS inertia FROM a{rounds} GROUP BY cluster),
        t AS (SELECT CAST(sum(inertia) AS BIGINT) AS inertia FROM s),
        h AS (SELECT cluster, sha256(array_to_string(list_transform(q, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',')) AS centroid_sha256 FROM c{rounds})
        SELECT a.vec_id, CAST(a.cluster AS INTEGER) AS cluster, CAST(a.distance AS BIGINT) AS distance, s.inertia AS cluster_inertia, t.inertia, h.centroid_sha256
        FROM a{rounds} a JOIN s ON a.cluster = s.cluster JOIN h ON a.cluster = h.cluster, t
    """


ORACLES["op11_centroids"] = _lloyd_sql()
ORACLES["op12_line_dedup"] = """
    WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS i FROM documents),
    k AS (SELECT doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM l),
    m AS (SELECT k, min(doc_id) AS least FROM k WHERE length(k) >= 10 GROUP BY k HAVING min(doc_id) <> max(doc_id)),
    d AS (SELECT k.doc_id, k.i, k.line, m.least IS NOT NULL AND k.doc_id <> m.least AS gone FROM k LEFT JOIN m ON k.k = m.k)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256 FROM d GROUP BY doc_id
"""
