"""Vectorised byte kernels shared by the text operators.

All kernels work on a concatenated UTF-8 buffer of several documents plus the
documents' offsets, exactly as an Arrow string column stores them, so a batch
of documents is processed by a fixed number of numpy passes and never by a
Python loop over characters or words.  ``pieces`` cuts an Arrow batch into
buffers of a few MB, which bounds the memory of every kernel whatever the
batch size; a single longer document forms a buffer of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
#: Odd multiplier of the polynomial hash, and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: Stands for a null document id: it compares greater than every other id.
NULL_ID = (1 << 63) - 1

_powers: dict[str, np.ndarray] = {"up": np.ones(1, U), "down": np.ones(1, U)}
_bytes = np.random.default_rng(20240817).integers(0, 1 << 64, 256, dtype=np.uint64)


def _power(kind: str, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        size = max(n, 1 << 20)
        out = np.empty(size, U)
        out[0] = 1
        step = np.full(size - 1, BASE if kind == "up" else INVERSE, U)
        np.multiply.accumulate(step, out=out[1:])
        _powers[kind] = out
    return _powers[kind][:n]


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective finaliser on 64-bit words; another seed gives an independent one."""
    h = h + U((seed * 0xD1342543DE82EF95 + 0x9E3779B97F4A7C15) & (1 << 64) - 1)
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def column(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    col = batch.column(batch.schema.get_field_index(name))
    col = pc.fill_null(col.cast(pa.large_binary()), b"")
    if len(col) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def ids(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False).astype(np.int64)


def pieces(raw: np.ndarray, offsets: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first document, end document, bytes, offsets) for runs of documents of about ``limit`` bytes."""
    n, at = len(offsets) - 1, 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end, raw[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def prefix_hash(raw: np.ndarray) -> np.ndarray:
    """Running polynomial hash; ``span_hash`` reads any span's hash from it."""
    out = np.zeros(len(raw) + 1, U)
    np.cumsum(_bytes[raw] * _power("up", len(raw)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return (prefix[end] - prefix[start]) * _power("down", len(prefix))[start]


def gram_hash(prefix: np.ndarray, size: int) -> np.ndarray:
    """Hash of every span of ``size`` bytes, by start."""
    n = len(prefix) - size
    return (prefix[size:] - prefix[:-size]) * _power("down", n) if n > 0 else np.empty(0, U)


def class_table(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[np.frombuffer(members, np.uint8)] = True
    return table


#: Lower-cases A-Z and leaves every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words that end at a blank, and of words of ASCII letters and digits plus all that is not ASCII.
NOT_BLANK = ~class_table(b"\x20\x09\x0a\x0b\x0c\x0d")
ALNUM = class_table(bytes(range(48, 58)) + bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))


def words(raw: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each document plus the total) of maximal runs of member bytes within a document."""
    inside = member[raw]
    if not len(raw):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    edge = offsets[:-1][offsets[:-1] < offsets[1:]]
    begin[edge] = inside[edge]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    end[edge[1:] - 1] = inside[edge[1:] - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_grams(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of every run of ``size`` words in a document; a document of fewer words, but not none, has its whole sequence as one."""
    total = len(hashes)
    lengths = np.diff(first)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    acc = np.zeros(max(total - size + 1, 0), U)
    for k in range(size):
        acc = mix(acc * U(3) + hashes[k : total - size + 1 + k], k + 1)
    whole = np.arange(len(acc)) + size <= first[1:][doc[: len(acc)]] if len(acc) else np.empty(0, bool)
    out, owner = acc[whole], doc[: len(acc)][whole]
    short = np.flatnonzero((lengths > 0) & (lengths < size))
    if len(short):
        extra = np.empty(len(short), U)
        for i, d in enumerate(short):
            h = np.zeros(1, U)
            for k in range(int(lengths[d])):
                h = mix(h * U(3) + hashes[first[d] + k : first[d] + k + 1], k + 1)
            extra[i] = mix(h, 97 + int(lengths[d]))[0]
        out, owner = np.concatenate((out, extra)), np.concatenate((owner, short))
    return out, owner


def distinct(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, hash) pairs, ordered by document and then hash."""
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    keep = np.ones(len(hashes), bool)
    keep[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[keep], owner[keep]


def list_array(values: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    """An Arrow list column of int64 from flat values and bounds."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.view(np.int64) if values.dtype == U else values.astype(np.int64)))


def binary_array(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """An Arrow binary column from flat bytes and bounds."""
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32).tobytes()), pa.py_buffer(values.tobytes())])


def batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], names=list(columns))
