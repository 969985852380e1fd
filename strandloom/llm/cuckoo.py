"""Cuckoo filters of 16-bit fingerprints in numpy, and the pass that tests and changes the filters of many shards.

A key is two longs.  The first says its shard and fingerprint, the second its
bucket; a fingerprint lies in its bucket or in the one that bucket and
fingerprint name together, so it can be moved, and deleted, without its key.
Equal fingerprints take a slot each: deleting one key leaves the others.  What
finds no slot goes to a further generation with the same number of buckets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLOTS, KICKS, FULL = 4, 200, 0.85
U = np.uint64


def _spread(mark: np.ndarray) -> np.ndarray:
    h = mark.astype(U) * U(0x9E3779B97F4A7C15)
    return ((h ^ (h >> U(29))) * U(0xBF58476D1CE4E5B9) >> U(20)).astype(np.int64)


class Cuckoo:
    """Generations of buckets of four fingerprints."""

    def __init__(self, buckets: int, generations: list[np.ndarray] | None = None):
        self.buckets, self.tables = buckets, generations or [np.zeros((buckets, SLOTS), np.uint16)]

    def places(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(fingerprint, first bucket, second bucket)."""
        mark = ((h1.view(U) >> U(40)) & U(0xFFFF)).astype(np.uint16)
        mark[mark == 0] = 1
        one = (h2 & (self.buckets - 1)).astype(np.int64)
        return mark, one, self.other(mark, one)

    def other(self, mark: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        return bucket ^ (_spread(mark) & (self.buckets - 1))

    def contains(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Whether each key may have been added; never false for one that was."""
        mark, one, two = self.places(h1, h2)
        found = np.zeros(len(mark), bool)
        for t in self.tables:
            found |= (t[one] == mark[:, None]).any(1) | (t[two] == mark[:, None]).any(1)
        return found

    def add(self, h1: np.ndarray, h2: np.ndarray) -> None:
        mark, one, two = self.places(h1, h2)
        at = 0
        while at < len(mark):
            # A table is filled up to FULL and then left, for moves become long beyond that.
            room = int(self.buckets * SLOTS * FULL) - int(np.count_nonzero(self.tables[-1]))
            if room <= 0:
                self.tables.append(np.zeros((self.buckets, SLOTS), np.uint16))
                continue
            part = slice(at, at + room)
            m, a, b = mark[part], one[part], two[part]
            left = self._put(self.tables[-1], m, a)
            left = left[self._put(self.tables[-1], m[left], b[left])]
            rest = self._kick(self.tables[-1], m[left], b[left])
            while len(rest[0]):
                self.tables.append(np.zeros((self.buckets, SLOTS), np.uint16))
                rest = self._kick(self.tables[-1], *rest)
            at += room

    def remove(self, h1: np.ndarray, h2: np.ndarray) -> None:
        """Take out one fingerprint of each key; the keys must have been added."""
        for mark, *buckets in zip(*(x.tolist() for x in self.places(h1, h2)), strict=True):
            at = next(((t, b, s) for t in self.tables for b in buckets for s in range(SLOTS) if t[b, s] == mark), None)
            if at is None:
                raise ValueError("a key that was never added")
            at[0][at[1], at[2]] = 0

    @staticmethod
    def _put(table: np.ndarray, mark: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Fill free slots of the buckets; returns which entries found none."""
        order = np.argsort(bucket, kind="stable")
        b = bucket[order]
        first = np.r_[True, b[1:] != b[:-1]] if len(b) else np.empty(0, bool)
        rank = np.arange(len(b)) - np.maximum.accumulate(np.where(first, np.arange(len(b)), 0))
        full = table[b] != 0
        fits = rank < SLOTS - full.sum(1)
        slot = np.argsort(full, axis=1, kind="stable")
        table[b[fits], slot[fits, rank[fits]]] = mark[order][fits]
        return np.sort(order[~fits])

    def _kick(self, table: np.ndarray, mark: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place fingerprints, moving others, all of them a step at a time; returns those left without a slot, and a bucket of each."""
        for turn in range(KICKS):
            for _ in range(2):
                left = self._put(table, mark, bucket)
                mark, bucket = mark[left], self.other(mark[left], bucket[left])
            if not len(mark):
                break
            # One of a bucket takes the slot of a held fingerprint, which goes on to its other bucket; the others wait.
            into, first = np.unique(bucket, return_index=True)
            slot = (_spread(mark[first] + np.uint16(turn)) + into) % SLOTS
            held = table[into, slot]
            table[into, slot] = mark[first]
            wait = np.delete(np.arange(len(mark)), first)
            mark, bucket = np.concatenate([mark[wait], held]), np.concatenate([bucket[wait], self.other(held, into)])
        return mark, bucket


#: Rows of a pass: a shard's filter has one row a generation, its keys have null ``gen``.  Filters come first in a shard.
STREAM = "shard int, gen int, slots binary, h1 long, h2 long, n long, least long"


def passing(buckets: int, action: str):
    """A pass over rows of STREAM ordered by shard, filters first: holds one shard's filter and one batch of keys.

    ``test`` gives (h1, h2, n, least, hit) of every key; ``add`` and ``remove``
    give the rows of all filters (shard, gen, slots) after the change.
    """

    def filters(shard: int | None, held: Cuckoo | None) -> Iterator[pa.RecordBatch]:
        if held is not None and action != "test":
            for i, t in enumerate(held.tables):
                yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([i], pa.int32()), pa.array([t.astype("<u2").tobytes()], pa.binary())], names=["shard", "gen", "slots"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, loaded = None, None, []
        for b in batches:
            at = b.column(0).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(at[1:] != at[:-1]) + 1).tolist(), len(at)] if len(at) else [0]
            for lo, hi in zip(cuts, cuts[1:]):
                if int(at[lo]) != shard:
                    yield from filters(shard, held)
                    shard, held, loaded = int(at[lo]), Cuckoo(buckets), []
                part = b.slice(lo, hi - lo)
                is_key = part.column(1).is_null().to_numpy(zero_copy_only=False)
                if not is_key.all():
                    loaded += [np.frombuffer(x, "<u2").astype(np.uint16).reshape(buckets, SLOTS) for x in part.column(2).to_pylist() if x is not None]
                    held = Cuckoo(buckets, loaded)
                part = part.slice(int((~is_key).sum()))
                if not len(part):
                    continue
                h1, h2 = (part.column(i).to_numpy(zero_copy_only=False) for i in (3, 4))
                if action == "test":
                    yield pa.RecordBatch.from_arrays([*(part.column(i) for i in (3, 4, 5, 6)), pa.array(held.contains(h1, h2))], names=["h1", "h2", "n", "least", "hit"])
                elif action == "add":
                    held.add(h1, h2)
                else:
                    held.remove(h1, h2)
        yield from filters(shard, held)

    return run
