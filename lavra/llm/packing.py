"""Best-fit packing planned on the histogram of piece lengths."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.llm.staging import chunks, rank_within, stage, texts_of
from lavra.llm.tokens import encoder

CAPACITY = 1024


class Slots(NamedTuple):
    """Ranks ``lo`` to ``hi`` of one length: ``each`` of them per bin, from bin ``first`` at ``offset``."""

    length: int
    lo: int
    hi: int
    first: int
    each: int
    offset: int


def plan_best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Slots], int]:
    """Pack lengths by best fit, longest first, over counts instead of items.

    Equal bins are one run (first bin, number of bins) under their free space.
    A length goes to the run with the least free space that still holds it;
    each of its bins takes as many as fit, which is where best fit would put
    the following items too. The plan has a few rows per distinct length,
    whatever the counts are. Returns the slots and the number of bins.
    """
    free: dict[int, list[tuple[int, int]]] = {}
    spaces: list[int] = []
    slots, bins = [], 0

    def keep(space: int, first: int, number: int) -> None:
        if space and number:
            if space not in free:
                insort(spaces, space)
            free.setdefault(space, []).append((first, number))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            place = bisect_left(spaces, length)
            if place < len(spaces):
                space = spaces[place]
                first, number = free[space].pop()
                if not free[space]:
                    del free[space]
                    spaces.pop(place)
            else:
                space, first, number = capacity, bins, -(-left // (capacity // length))
                bins += number
            each = space // length
            full = min(number, left // each)
            if full:
                slots.append(Slots(length, rank, rank + full * each, first, each, capacity - space))
                rank, left = rank + full * each, left - full * each
                keep(space - each * length, first, full)
            if full < number and left and left < each:
                slots.append(Slots(length, rank, rank + left, first + full, left, capacity - space))
                keep(space - left * length, first + full, 1)
                rank, left, full = rank + left, 0, full + 1
            keep(space, first + full, number - full)
    return slots, bins


def _encode(tokenizer: str, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts = encoder(tokenizer).encode
        for chunk in chunks(batches, "text"):
            ids, sizes = encode_texts(texts_of(chunk, "text"))
            ids = np.insert(ids, np.cumsum(sizes), np.uint32(end_id)).astype("<u4")
            sizes = sizes + 1
            crcs, place = [], 0
            for size in sizes.tolist():
                head = (size - 1) % capacity + 1
                edges = [0, *range(head, size + 1, capacity)]
                crcs.append([zlib.crc32(ids[place + a : place + b]) for a, b in zip(edges[:-1], edges[1:])])
                place += size
            yield pa.RecordBatch.from_arrays(
                [
                    chunk.column("doc_id").cast(pa.int64()),
                    pa.array((sizes - 1) % capacity + 1, pa.int64()),
                    pa.array(crcs, pa.list_(pa.int64())),
                ],
                names=["doc_id", "head", "crcs"],
            )

    return run


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """Pack ``docs`` (doc_id, text) into sequences of at most ``capacity`` tokens.

    Each document's ids are followed by ``end_id``. A document above the
    capacity is cut into full pieces behind a first piece that takes the rest;
    full pieces fill sequences of their own, all other pieces are packed by
    :func:`plan_best_fit` and take the planned slots by their rank within their
    length. The driver sees the histogram only: at most ``capacity`` rows. The
    plan is broadcast, a few rows per length.

    A NULL text counts as empty (one piece with the end id). Repeated rows are
    packed each for itself. Other columns are ignored; an empty table gives no
    rows. Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset.
    """
    spark = docs.sparkSession
    coded = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_encode(tokenizer, end_id, capacity), "doc_id long, head long, crcs array<long>")
    # Written first: dealing by ranges samples its input, which would encode all texts twice.
    coded = stage(coded, "coded")
    ranked = rank_within(coded, ["head"], [F.col("doc_id")], "nth", "pieces")
    found = coded_summary(ranked)
    counts = {row["head"]: row["docs"] for row in found}
    most = max((row["pieces"] for row in found), default=1)
    slots, bins = plan_best_fit(counts, capacity)
    earlier, before = 0, {}
    for length in sorted(counts):
        before[length], earlier = earlier, earlier + counts[length]
    rows = [(*slot, before[slot.length]) for slot in slots]
    plan = spark.createDataFrame(rows, "slot_length long, lo long, hi long, first long, each long, base long, before long")
    meets = (F.col("head") == F.col("slot_length")) & (F.col("nth") >= F.col("lo")) & (F.col("nth") < F.col("hi"))
    into = F.col("nth") - F.col("lo")
    placed = ranked.join(F.broadcast(plan), meets).select(
        "doc_id",
        "head",
        "crcs",
        (F.col("before") + F.col("nth")).alias("number"),
        (F.col("first") + F.floor(into / F.col("each"))).alias("bin"),
        (F.col("base") + F.pmod(into, F.col("each")) * F.col("head")).alias("place"),
    )
    first = F.col("piece") == 0
    return placed.select("*", F.posexplode("crcs").alias("piece", "ids_crc32")).select(
        "doc_id",
        "piece",
        F.when(first, F.lit(0).cast("long")).otherwise(F.col("head") + (F.col("piece") - 1) * F.lit(capacity).cast("long")).alias("start"),
        F.when(first, F.col("head")).otherwise(F.lit(capacity).cast("long")).alias("length"),
        "ids_crc32",
        F.when(first, F.col("bin")).otherwise(F.lit(bins).cast("long") + F.col("number") * F.lit(most).cast("long") + F.col("piece")).cast("long").alias("sequence_id"),
        F.when(first, F.col("place")).otherwise(F.lit(0).cast("long")).cast("long").alias("offset"),
    )


def coded_summary(ranked: DataFrame) -> list:
    """Pieces by length of the first piece: at most ``capacity`` rows."""
    return ranked.groupBy("head").agg(F.count("*").alias("docs"), F.max(F.size("crcs")).alias("pieces")).collect()
