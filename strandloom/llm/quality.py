"""Quality classifier of supervised subword embeddings.

A text is the average of learned vectors of its hashed features; a linear layer
and a softmax turn the average into class probabilities; everything is trained
by stochastic gradient descent in numpy.

Features: words, word n-grams, and character n-grams (of UTF-8 bytes) inside
words with their boundaries.  Words are normalised in one way: a word that
equals the one before it is the token ``AGAIN``, so that repetition carries
over to words never seen.

Training rows are a sample of at most ``max_rows`` labelled rows, chosen by a
hash of the id.  Executors turn the sample into feature counts, and one task
trains on these.  Since the output layer is linear, scoring needs one number
per feature and class: the model that reaches the executors is one table of
``BUCKETS`` floats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandloom.llm import kernels as K

BUCKETS, DIM, WORD_ORDERS, ORDERS = 1 << 16, 12, (1, 2, 3), (3, 4, 5)
#: The hash of the token for a repeated word.
AGAIN = K.U(77)


def _features(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, document) of every feature occurrence, one kind at a time."""
    start, end, first = K.words(raw, offsets, K.NOT_BLANK)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    prefix = K.prefix_hash(raw)
    mask = K.U(BUCKETS - 1)
    bucket = lambda h, kind: (K.mix(h, kind) >> K.U(24) & mask).astype(np.int32)
    words = K.mix(K.span_hash(prefix, start, end))
    again = np.zeros(len(words), bool)
    again[1:] = (words[1:] == words[:-1]) & (doc[1:] == doc[:-1])
    words[again] = AGAIN
    for size in WORD_ORDERS:
        count = max(len(words) - size + 1, 0)
        h = np.zeros(count, K.U)
        for k in range(size):
            h = h * K.U(3) + words[k : k + count]
        whole = doc[:count] == doc[size - 1 :][:count]
        yield bucket(h, size)[whole], doc[:count][whole]
    blank = ~K.NOT_BLANK[raw]
    spaces = np.concatenate(([0], np.cumsum(blank)))
    owner = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    for size in ORDERS:
        h = K.gram_hash(prefix, size)
        if not len(h):
            continue
        # A gram may hold a blank at either end, which marks a word's boundary, but not inside.
        ok = (spaces[size - 1 : len(raw)] - spaces[1 : len(raw) - size + 2] == 0) & (owner[: len(h)] == owner[size - 1 :])
        yield bucket(h, 10 + size)[ok], owner[: len(h)][ok]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Feature counts of each text."""
    for b in batches:
        raw, offsets = K.column(b, "text")
        docs, labels = K.ids(b, "doc"), K.ids(b, "label")
        for a, e, r, o in K.pieces(raw, offsets):
            pairs = [bucket.astype(np.int64) | doc.astype(np.int64) << 32 for bucket, doc in _features(r, o)]
            found, count = np.unique(np.concatenate(pairs), return_counts=True)
            bounds = np.searchsorted(found >> 32, np.arange(e - a + 1))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(docs[a:e]),
                    pa.array(labels[a:e].astype(np.int32)),
                    pa.array([(found[x:y] & 0xFFFFFFFF).astype(np.int32).tobytes() for x, y in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary()),
                    pa.array([count[x:y].astype(np.float32).tobytes() for x, y in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary()),
                ],
                names=["doc", "label", "features", "counts"],
            )


def _trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All counted rows to one row: the trained weights and bias."""
    found = []
    for b in batches:
        for doc, label, f, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3), strict=True):
            found.append((doc, label, np.frombuffer(f.as_py(), np.int32), np.frombuffer(c.as_py(), np.float32)))
    found.sort(key=lambda r: r[:2])
    model = train([(f, c, y) for _, y, f, c in found])
    yield pa.RecordBatch.from_arrays([pa.array([model.weights.tobytes()], pa.binary()), pa.array([model.bias])], names=["weights", "bias"])


class Model:
    """One weight a feature and a bias: the log-odds of class 1 are the weights' average plus the bias."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias


def gradients(vectors, layer, bias, flat, share, owner, labels):
    """(summed loss, gradients of the layer, of the bias, and of the vectors of the features in use, and those features).

    Text ``owner`` holds feature ``flat`` with a ``share`` of its feature
    occurrences; its average vector goes through the layer and a softmax.
    """
    n = len(labels)
    mean = np.zeros((n, vectors.shape[1]), vectors.dtype)
    for d in range(vectors.shape[1]):
        mean[:, d] = np.bincount(owner, share * vectors[flat, d], n)
    z = mean @ layer + bias
    p = np.exp(z - z.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    loss = -float(np.log(p[np.arange(n), labels] + 1e-300).sum())
    p[np.arange(n), labels] -= 1
    g_mean = p @ layer.T
    used, inverse = np.unique(flat, return_inverse=True)
    g_vectors = np.zeros((len(used), vectors.shape[1]), vectors.dtype)
    for d in range(vectors.shape[1]):
        g_vectors[:, d] = np.bincount(inverse, share * g_mean[owner, d], len(used))
    return loss, mean.T @ p, p.sum(0), g_vectors, used


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = 8, rate: float = 0.5, batch: int = 32, seed: int = 7) -> Model:
    """Stochastic gradient descent on average embeddings, a linear layer and softmax."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    layer, bias = np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32)
    if not rows:
        return Model(np.zeros(BUCKETS, np.float32), 0.0)
    grad_v = np.ones(BUCKETS, np.float32)
    grad_l, grad_b = np.ones_like(layer), np.ones_like(bias)
    layer[:, 1] = rng.normal(0, 0.5, DIM)
    rows = [(f, c / max(c.sum(), 1), y) for f, c, y in rows]
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), batch):
            part = [rows[i] for i in order[at : at + batch]]
            flat = np.concatenate([x[0] for x in part])
            share = np.concatenate([x[1] for x in part]).astype(np.float32)
            owner = np.repeat(np.arange(len(part)), [len(x[0]) for x in part])
            _, g_layer, g_bias, step, used = gradients(vectors, layer, bias, flat, share, owner, np.array([x[2] for x in part]))
            grad_l += g_layer**2
            grad_b += g_bias**2
            layer -= rate * g_layer / np.sqrt(grad_l)
            bias -= rate * g_bias / np.sqrt(grad_b)
            # Per-feature adaptive steps: a feature's share scales its document's gradient.
            grad_v[used] += (step**2).sum(1) * 1e4
            vectors[used] -= 30 * rate * step / np.sqrt(grad_v[used])[:, None]
    weights = vectors @ (layer[:, 1] - layer[:, 0])
    return Model(weights.astype(np.float32), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality", max_rows: int = 4000, held_out: int = 5) -> Model:
    """Learn from rows whose crc32(id as text) mod ``held_out`` is not 0, at most ``max_rows`` of them by a hash of the id.

    Labels without an id, or other than 0 and 1, teach nothing; of conflicting
    labels of an id the smaller counts; documents that repeat an id each teach
    its label, a null text as an empty one.  Without a usable label the model
    gives every text one half.
    """
    base = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    usable = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label")).filter("id is not null and label in (0, 1)").filter(F.crc32(F.col("id").cast("string")) % held_out != 0)
    chosen = usable.groupBy("id").agg(F.min("label").alias("label")).orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(max_rows)
    # The sample is bounded by max_rows, so it can be broadcast.
    sample = base.join(F.broadcast(chosen), "id").select(F.xxhash64(F.col("id").cast("string"), F.coalesce("text", F.lit(""))).alias("doc"), "label", "text")
    # One task trains on the bounded sample; the driver gets the finished table of weights.
    counted = sample.mapInArrow(_counted, "doc long, label int, features binary, counts binary").repartition(1)
    done = counted.mapInArrow(_trained, "weights binary, bias double").first()
    return Model(np.frombuffer(bytes(done[0]), np.float32), done[1]) if done else train([])


def _scores(model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for b in batches:
            raw, offsets = K.column(b, "text")
            out = np.empty(len(offsets) - 1)
            for a, e, r, o in K.pieces(raw, offsets):
                total, count = np.zeros(e - a), np.zeros(e - a)
                for bucket, doc in _features(r, o):
                    total += np.bincount(doc, m.weights[bucket], e - a)
                    count += np.bincount(doc, minlength=e - a)
                out[a:e] = total / np.maximum(count, 1) + m.bias
            names = [f.name for f in b.schema]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(1 / (1 + np.exp(-np.clip(out, -60, 60))))], names=[*names, "score"])

    return score


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.3, name: str = "score", decision: str = "predicted") -> DataFrame:
    """Add the probability of class 1 and the decision (1 if it reaches ``threshold``) to every row.

    Only the text is an input.  Null and empty texts have no features and get
    the model's prior.  All rows and columns stay; columns that already bear
    the new names are replaced.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(model)
    rest = [c for c in docs.columns if c not in (name, decision)]
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([T.StructField("row", packed.schema["row"].dataType), T.StructField("text", T.StringType()), T.StructField("score", T.DoubleType())])
    scored = packed.mapInArrow(_scores(held), schema)
    return scored.select("row.*", F.col("score").alias(name), (F.col("score") >= threshold).cast("int").alias(decision))
