"""Token counts with a digest cache.

The cache is a Parquet table of (content digest, tokenizer digest, n_tokens).
A document's digest is joined to it; only distinct contents that are missing
are encoded.  Contents that occur once are encoded in their scan task, without
a shuffle of texts; of copies, one text is first chosen per digest.  The new counts are
appended to the cache, and documents get their count from the cache by digest.

Content is normalised only in ways that cannot change a count under any
tokenizer: a null becomes the empty text.  The tokenizer's digest covers its
file's bytes and the library's version.

Encoding splits a text at blanks and line feeds and keeps the counts of pieces
seen before, for tokenizers that never join or count across them; ``splits``
says so per tokenizer, and whole texts are encoded otherwise.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.llm.common import Scratch

#: Pieces remembered in a Python worker; distinct duplicates that may be broadcast (16 bytes each and their overhead).
REMEMBERED, MAX_BROADCAST = 800_000, 500_000


def tokenizer_digest(path: str) -> str:
    """Digest of a tokenizer: its file and the version of the library that reads it."""
    if path.endswith(".model"):
        import sentencepiece as library
    else:
        import tokenizers as library
    with open(path, "rb") as f:
        return hashlib.sha256(library.__version__.encode() + b"\0" + f.read()).hexdigest()


def load(name: str) -> Callable[[list[str]], list[int]]:
    """The counting function of a public tokenizer file, by name or path; no special tokens are added."""
    path = locate(name)
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    return lambda texts: [len(x.ids) for x in model.encode_batch_fast(texts, add_special_tokens=False)]


def locate(name: str) -> str:
    if "/" in name:
        return name
    import public_tokenizers

    return str(public_tokenizers.path(name))


# Patterns of pieces that never hold white space, of tokenizer files whose pre-tokenizer keeps only such pieces, and normalisers that leave single blanks between them.
PIECES = (r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",)
NORMALISERS = ({"type": "NFC"}, {"type": "Lowercase"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "})


def splits(name: str) -> bool:
    """Whether the tokenizer is known to drop blanks and line feeds and never to join across them.

    Only specifications that are known in every part count; any other
    pattern, normaliser, step or added token with white space does not.
    """
    path = locate(name)
    if path.endswith(".model"):
        return False
    import json

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)

    def steps(part, inner):
        return [] if not part else part[inner] if part.get("type") == "Sequence" else [part]

    pre = steps(spec.get("pre_tokenizer"), "pretokenizers")
    first = bool(pre) and pre[0].get("type") == "Split" and pre[0].get("behavior") == "Removed" and pre[0].get("invert") is True and pre[0].get("pattern", {}).get("Regex") in PIECES
    rest = all(p.get("type") == "ByteLevel" and p.get("add_prefix_space") is False and p.get("use_regex") is False for p in pre[1:])
    plain = all(n in NORMALISERS for n in steps(spec.get("normalizer"), "normalizers"))
    added = all(not any(c.isspace() for c in t["content"]) and not t.get("lstrip") and not t.get("rstrip") and not t.get("single_word") for t in spec.get("added_tokens", ()))
    return first and rest and plain and added and spec.get("post_processor") is None


def counter(name: str) -> Callable[[list[str]], list[int]]:
    """Counts of whole texts, by remembered pieces where the tokenizer allows it."""
    count = load(name)
    if not splits(name):
        return count
    seen: dict[str, int] = {"": 0}

    def counts(texts: list[str]) -> list[int]:
        cut = [t.replace("\n", " ").split(" ") for t in texts]
        new = list({p for pieces in cut for p in pieces if p not in seen})
        if new:
            if len(seen) > REMEMBERED:
                seen.clear()
                seen[""] = 0
                new = list({p for pieces in cut for p in pieces if p})
            for at in range(0, len(new), 4096):
                part = new[at : at + 4096]
                seen.update(zip(part, count(part), strict=True))
        get = seen.__getitem__
        return [sum(map(get, pieces)) for pieces in cut]

    return counts


def _encode(name):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        counts = None
        for b in batches:
            counts = counts or counter(name)
            texts = b.column(1)
            found: list[int] = []
            for at in range(0, len(texts), 200):
                found += counts([x or "" for x in texts[at : at + 200].to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.int64())], names=["digest", "n_tokens"])

    return encode


def token_counts(docs: DataFrame, tokenizer: str, cache: str | None = None, text: str = "text", doc_id: str = "doc_id", limit: int = 2048) -> DataFrame:
    """Tokens of every whole text: doc_id, n_bytes, n_tokens, over_limit, one row per input row.

    ``cache`` is the path of the cache table; without one, the call starts
    from an empty cache in the shared scratch folder.  Appending is a Parquet
    append: rows of a run that is repeated after a failure may occur twice, so
    readers take one count per digest.

    Null text: empty, no tokens.  Null or repeated ids: each row gets its own
    result.  An empty table gives an empty result.  Other columns are not
    read, whatever their names.
    """
    spark = docs.sparkSession
    version = tokenizer_digest(locate(tokenizer))
    schema = "digest binary, tokenizer string, n_tokens long"
    scratch = Scratch(spark)
    path = cache or f"{scratch.base}/cache"
    spark.createDataFrame([], schema).coalesce(1).write.mode("append").parquet(path)
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    base = docs.select(F.col(doc_id).alias("doc_id"), body.alias("text"), F.unhex(F.sha2(body, 256)).alias("digest"))
    ids = scratch.keep("ids", base.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")))
    known = spark.read.schema(schema).parquet(path).filter(F.col("tokenizer") == version).select("digest").distinct()
    stored_before = not known.isEmpty()
    counted = ids.groupBy("digest").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
    often = counted.select("digest")
    # Contents that are not simply encoded where they are found: further copies and known ones.
    special = scratch.keep("special", (often.unionByName(ids.select("digest").join(known, "digest", "left_semi")).distinct() if stored_before else often))
    n_special = special.limit(MAX_BROADCAST + 1).count()
    texts = base.select("digest", "text")
    side = F.broadcast(special) if n_special <= MAX_BROADCAST else special
    todo = texts.join(side, "digest", "left_anti") if n_special else texts
    if n_special:
        # One text of each content that occurs more than once, and none of a known one.
        several = texts.join(side, "digest", "left_semi")
        several = several.join(known, "digest", "left_anti") if stored_before else several
        todo = todo.unionByName(several.groupBy("digest").agg(F.first("text").alias("text")))
    todo.mapInArrow(_encode(tokenizer), "digest binary, n_tokens long").select("digest", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(path)
    stored = spark.read.schema(schema).parquet(path).filter(F.col("tokenizer") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    # Contents of very many rows: no more than 4,096, so their counts are broadcast, and the other rows are dealt by digest.
    many = max(64, ids.count() // 4096)
    hot = scratch.keep("hot", stored.join(counted.filter(F.col("k") > many).select("digest"), "digest", "left_semi"))
    near = ids.join(F.broadcast(hot.withColumnRenamed("n_tokens", "known")), "digest", "left")
    rare = near.filter("known is null").drop("known").join(stored, "digest", "left")
    out = near.filter("known is not null").select("digest", "doc_id", "n_bytes", F.col("known").alias("n_tokens")).unionByName(rare.select("digest", "doc_id", "n_bytes", "n_tokens"))
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
