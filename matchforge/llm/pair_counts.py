"""Counts of distinct 64-bit keys in dense vectors under a minimal perfect hash.

Distinct keys are dealt to shards by their hash; a task builds the minimal perfect hash of
one shard (about ``SHARD_KEYS`` keys): level by level keys take a bit of their own or go
on, and the number of bits before it is a key's slot. Partial counts are shuffled to
(shard, salt), each task adds its part up in a dense vector indexed by slot, and the vectors
of a shard's salts are added in a second step. A shard is one row: hash, keys by slot, counts
by slot. A looked-up key is compared with the key in its slot, so a key that was not counted
is found out.

Lookups load shards in rounds of at most ``ROUND_KEYS`` keys, which bounds what is sent to
tasks (16 bytes a key and the hash) however many keys there are.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchforge.llm.common import column, in_tasks, mix, stage

SHARD_KEYS = 1 << 18
ROUND_KEYS = 1 << 21
# Tasks that add up one shard before the second step.
SALTS = 4
# Bits of a level per key that reaches it.
_ROOM = 1.5
_LEVELS = mix(np.arange(1, 129, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
PARTIAL_SCHEMA = "cell int, key long, n long"


def cells(keys: np.ndarray) -> np.ndarray:
    """A fixed number from 0 to 65,535 for each key; ranges of them make shards."""
    return (mix(keys.astype(np.uint64) ^ np.uint64(0xE7037ED1A0B428DB)) >> np.uint64(48)).astype(np.int32)


class MinimalHash:
    """A minimal perfect hash of distinct keys: slots 0 to n - 1."""

    def __init__(self, keys: np.ndarray):
        self.levels, self.n, left = [], len(keys), keys.astype(np.uint64)
        base = 0
        while len(left):
            if len(self.levels) == len(_LEVELS):
                raise ValueError("the keys are not distinct")
            size = 64 * max(1, -(-int(_ROOM * len(left)) // 64))
            at = self._place(left, len(self.levels), size)
            hits = np.bincount(at, minlength=size)
            words = np.packbits(hits == 1, bitorder="little").view(np.uint64)
            upto = np.cumsum(np.bitwise_count(words), dtype=np.int64)
            self.levels.append((size, words, base + upto - np.bitwise_count(words)))
            base += int(upto[-1])
            left = left[hits[at] > 1]

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys ^ _LEVELS[level]) % np.uint64(size)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; a key that was not built in gets any slot, or -1."""
        keys = keys.astype(np.uint64)
        out, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (size, words, before) in enumerate(self.levels):
            at = self._place(keys[open_], level, size)
            word, bit = words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[open_[hit]] = (before[at >> 6] + below)[hit]
            open_ = open_[~hit]
        return out


class Lookup:
    """Counts of the keys of some shards."""

    def __init__(self, shards: int, rows: list[tuple[int, MinimalHash, np.ndarray, np.ndarray]]):
        self.shards, self.rows = shards, rows

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """The count of each key, 0 if its shard is not held here."""
        out, own = np.zeros(len(keys), np.int64), shard_of(cells(keys), self.shards)
        for shard, hashed, known, counted in self.rows:
            mine = np.flatnonzero(own == shard)
            slots = hashed.slots(keys[mine])
            if (slots < 0).any() or (known[slots] != keys[mine]).any():
                raise KeyError("a key that was not counted")
            out[mine] = counted[slots]
        return out


def shard_of(cell, shards: int):
    return cell.astype(np.int64) * shards >> 16


class PairCounts:
    """Exact counts of all keys of a partial-count table (``cell``, ``key``, ``n``)."""

    def __init__(self, partials: DataFrame, shard_keys: int = SHARD_KEYS, round_keys: int = ROUND_KEYS):
        self.spark = partials.sparkSession
        distinct = stage(partials.select("cell", "key").distinct(), "pair_keys")
        self.shards = max(1, -(-distinct.count() // shard_keys))
        shard = F.shiftright(F.col("cell").cast("long") * self.shards, 16).cast("int").alias("shard")
        hashed = stage(in_tasks(
            distinct.select(shard, "key").repartition(self.shards, "shard"), _build,
            "shard int, size long, hash binary, keys binary"), "pair_hashes")
        sizes = sorted((r.shard, r.size) for r in hashed.select("shard", "size").collect())
        self.rounds = _rounds(sizes, round_keys)
        added = None
        for shards in self.rounds:
            some = self._sum(partials.select(shard, "key", "n"), hashed, shards)
            added = some if added is None else added.unionByName(some)
        self.table = None if added is None else stage(hashed.join(added, "shard"), "pair_table")

    def _sum(self, partials: DataFrame, hashed: DataFrame, shards: list[int]) -> DataFrame:
        rows = hashed.where(F.col("shard").isin(shards)).select("shard", "hash").collect()
        held = self.spark.sparkContext.broadcast({r.shard: bytes(r.hash) for r in rows})

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hashes, sums = {}, {}
            for batch in batches:
                own, keys, n = (column(batch, c).to_numpy() for c in ("shard", "key", "n"))
                for s in np.unique(own).tolist():
                    if s not in hashes:
                        hashes[s] = pickle.loads(held.value[s])
                        sums[s] = np.zeros(hashes[s].n, np.int64)
                    np.add.at(sums[s], hashes[s].slots(keys[own == s]), n[own == s])
            yield from _vectors(sums)

        salted = partials.where(F.col("shard").isin(shards)).withColumn("salt", F.spark_partition_id() % SALTS)
        leaves = in_tasks(salted.repartition(len(shards) * SALTS, "shard", "salt").drop("salt"), add, "shard int, counts binary")
        return in_tasks(leaves.repartition(len(shards), "shard"), _merge, "shard int, counts binary")

    def most(self, second_ids: int) -> np.ndarray:
        """For each second id of a key (key % ``second_ids``) the largest count of its keys."""
        best = np.zeros(second_ids, np.int64)
        if self.table is None:
            return best

        def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            largest = np.zeros(second_ids, np.int64)
            for batch in batches:
                for keys, counts in zip(column(batch, "keys"), column(batch, "counts")):
                    np.maximum.at(largest, np.frombuffer(keys.as_py(), np.int64) % second_ids, np.frombuffer(counts.as_py(), np.int64))
            at = np.flatnonzero(largest)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(largest[at])], names=["id", "n"])

        # one number for each id of a vocabulary
        found = in_tasks(self.table.select("keys", "counts"), top, "id long, n long").groupBy("id").agg(F.max("n").alias("n")).toArrow()
        best[found.column("id").to_numpy()] = found.column("n").to_numpy()
        return best

    def lookup(self, shards: list[int]) -> Lookup:
        """The counts of some shards, at most ``round_keys`` keys (or one shard)."""
        rows = self.table.where(F.col("shard").isin(shards)).toLocalIterator()
        return Lookup(self.shards, [
            (r.shard, pickle.loads(r.hash), np.frombuffer(bytes(r["keys"]), np.int64), np.frombuffer(bytes(r.counts), np.int64))
            for r in rows])


def _rounds(sizes: list[tuple[int, int]], most: int) -> list[list[int]]:
    out: list[list[int]] = []
    held = 0
    for shard, n in sizes:
        if not out or held + n > most:
            out.append([])
            held = 0
        out[-1].append(shard)
        held += n
    return out


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        own, keys = column(batch, "shard").to_numpy(), column(batch, "key").to_numpy()
        for s in np.unique(own).tolist():
            found.setdefault(s, []).append(keys[own == s])
    for s, parts in found.items():
        keys = np.concatenate(parts)
        hashed = MinimalHash(keys)
        by_slot = np.empty(len(keys), np.int64)
        by_slot[hashed.slots(keys)] = keys
        yield pa.RecordBatch.from_arrays([
            pa.array([s], pa.int32()), pa.array([len(keys)], pa.int64()),
            pa.array([pickle.dumps(hashed)], pa.binary()), pa.array([by_slot.tobytes()], pa.binary()),
        ], names=["shard", "size", "hash", "keys"])


def _vectors(sums: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for s, counts in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([s], pa.int32()), pa.array([counts.tobytes()], pa.binary())], names=["shard", "counts"])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for s, counts in zip(column(batch, "shard").to_pylist(), column(batch, "counts")):
            counts = np.frombuffer(counts.as_py(), np.int64)
            sums[s] = sums[s] + counts if s in sums else counts
    yield from _vectors(sums)
