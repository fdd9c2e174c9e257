"""Sorted keys with a count each, in the shared folder, looked up by workers through memory maps."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfwise.llm.arrays import open_array, write_array
from shelfwise.sources.scratch import scratch_path


@dataclass(frozen=True)
class SortedKeys:
    """Distinct whole numbers; a key's place is its rank among all of them."""

    root: str
    shards: tuple[int, ...]
    first: np.ndarray
    offset: np.ndarray  # rank of each shard's first key, then the number of keys

    @property
    def size(self) -> int:
        return int(self.offset[-1])

    def _runs(self, starts: np.ndarray, ordered: np.ndarray):
        cuts = np.searchsorted(ordered, starts)
        cuts[:1] = 0
        ends = np.append(cuts[1:], len(ordered))
        for k in np.flatnonzero(ends > cuts):
            yield int(k), slice(int(cuts[k]), int(ends[k]))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (-1 for a key that is not there) and count (0) of each key."""
        asked, at = np.unique(keys, return_inverse=True)
        rank, count = np.full(len(asked), -1, np.int64), np.zeros(len(asked), np.int64)
        for k, run in self._runs(self.first, asked):
            held = open_array(self.root, f"key-{self.shards[k]}")
            place = np.minimum(np.searchsorted(held, asked[run]), len(held) - 1)
            known = held[place] == asked[run]
            rank[run] = np.where(known, place + self.offset[k], -1)
            counts = open_array(self.root, f"count-{self.shards[k]}")
            count[run] = np.where(known, counts[place], 0)
        return rank[at], count[at]

    def keys_at(self, ranks: np.ndarray) -> np.ndarray:
        """The key of each rank."""
        asked, at = np.unique(ranks, return_inverse=True)
        out = np.zeros(len(asked), np.int64)
        for k, run in self._runs(self.offset[:-1], asked):
            out[run] = open_array(self.root, f"key-{self.shards[k]}")[asked[run] - self.offset[k]]
        return out[at]


def store(counted: DataFrame, label: str, shard_rows: int = 1_000_000) -> SortedKeys:
    """Writes distinct ``key`` with ``n``, both long, as sorted shards; one fact a shard returns."""
    root = scratch_path(counted.sparkSession, label)
    n_shards = max(1, -(-counted.count() // shard_rows))

    def write(batches):
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        found = [(b.column("key").to_numpy(), b.column("n").to_numpy()) for b in batches if b.num_rows]
        if found:
            key, n = (np.concatenate(c) for c in zip(*found, strict=True))
            write_array(root, f"key-{shard}", key)
            write_array(root, f"count-{shard}", n)
            fact = {"shard": [shard], "first": [int(key[0])], "size": [len(key)]}
            yield pa.RecordBatch.from_pydict(fact)

    rows = counted.select("key", "n").repartitionByRange(n_shards, "key").sortWithinPartitions("key")
    facts = rows.mapInArrow(write, "shard long, first long, size long").collect()
    facts.sort(key=lambda f: f["first"])
    size = np.array([f["size"] for f in facts], np.int64)
    return SortedKeys(
        root,
        tuple(f["shard"] for f in facts),
        np.array([f["first"] for f in facts], np.int64),
        np.append(0, np.cumsum(size)).astype(np.int64),
    )
