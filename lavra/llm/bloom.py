"""Blocked Bloom filters over 64-bit keys, built on the cluster and small enough to broadcast.

All bits of a key lie in one 64-bit block, so a probe reads one number. Filters
are sharded: a shard has its own range of blocks, and a pass holds as many
shards as a fixed number of bytes takes. What is beyond it goes to further
passes, so the size of a broadcast does not grow with the number of keys.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a filter for each key, and the bits that a key sets.
KEY_BITS = 32
SET_BITS = 4
#: Blocks of 8 bytes in one broadcast.
PASS_BLOCKS = 1 << 21

_U = np.uint64


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a finalizer of multiplications and shifts)."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> _U(27))) * _U(0x94D049BB133111EB)
        return values ^ (values >> _U(31))


def places(keys: np.ndarray, blocks: np.ndarray | np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """The block of each key, out of ``blocks``, and the bits it sets there."""
    block = ((keys >> _U(32)) * blocks) >> _U(32)
    bits = np.zeros(len(keys), np.uint64)
    for turn in range(SET_BITS):
        bits |= _U(1) << ((keys >> _U(6 * turn)) & _U(63))
    return block, bits


@dataclass(frozen=True)
class Shards:
    """The shards of one pass: where the blocks of each part of each class begin.

    The keys of a class are dealt over its parts by their own bits. A part that
    is not in this pass has no blocks.
    """

    first: dict[int, np.ndarray]
    blocks: dict[int, np.ndarray]
    total: int

    def part_of(self, kind: int, keys: np.ndarray) -> np.ndarray:
        return (mix(keys + _U(1)) % _U(len(self.blocks[kind]))).astype(np.int64)

    def places(self, kind: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which keys of a class are in this pass, and the blocks and bits of these."""
        blocks = self.blocks.get(kind)
        if blocks is None or not blocks.any():
            return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
        if len(blocks) == 1:
            here = np.arange(len(keys))
            block, bits = places(keys, blocks[0])
            return here, block + self.first[kind][0], bits
        part = self.part_of(kind, keys)
        here = np.flatnonzero(blocks[part])
        block, bits = places(keys[here], blocks[part[here]])
        return here, block + self.first[kind][part[here]], bits


def plan_passes(counts: dict[int, int], pass_blocks: int = PASS_BLOCKS) -> list[Shards]:
    """Cut classes of so many keys each into passes of at most ``pass_blocks`` blocks."""
    shards = []
    for kind, count in sorted(counts.items()):
        blocks = max(1, -(-count * KEY_BITS // 64))
        parts = -(-blocks // pass_blocks)
        shards += [(kind, part, parts, -(-blocks // parts)) for part in range(parts)]
    passes, room = [], 0
    for shard in shards:
        if shard[3] > room:
            passes.append([])
            room = pass_blocks
        passes[-1].append(shard)
        room -= shard[3]
    plans = []
    for chosen in passes:
        first, blocks, total = {}, {}, 0
        for kind, part, parts, size in chosen:
            if kind not in blocks:
                first[kind], blocks[kind] = np.zeros(parts, np.uint64), np.zeros(parts, np.uint64)
            first[kind][part], blocks[kind][part] = total, size
            total += size
        plans.append(Shards(first, blocks, total))
    return plans


def build(keys: DataFrame, shards: Shards) -> np.ndarray:
    """The blocks of one pass from a table of ``kind`` (class) and ``key``.

    Bits are gathered per block on the cluster; the driver receives one row for
    each block that is not empty, at most ``shards.total`` of them.
    """

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = batch.column("kind").to_numpy(zero_copy_only=False)
            key = batch.column("key").to_numpy(zero_copy_only=False).view(np.uint64)
            for kind in np.unique(kinds):
                _, block, bits = shards.places(int(kind), key[kinds == kind])
                yield pa.RecordBatch.from_arrays([pa.array(block.view(np.int64)), pa.array(bits.view(np.int64))], ["block", "bits"])

    rows = keys.select("kind", "key").mapInArrow(placed, "block long, bits long")
    found = rows.groupBy("block").agg(F.bit_or("bits").alias("bits")).toArrow()
    blocks = np.zeros(shards.total, np.uint64)
    blocks[found.column("block").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return blocks


def may_hold(blocks: np.ndarray, shards: Shards, kind: int, keys: np.ndarray) -> np.ndarray:
    """Positions of the keys of a class that this pass may hold; none is left out that it does hold."""
    here, block, bits = shards.places(kind, keys)
    return here[(blocks[block] & bits) == bits]
