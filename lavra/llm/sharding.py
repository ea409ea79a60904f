"""Longest-processing-time sharding of groups that must stay together."""

from __future__ import annotations

import heapq
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.llm.staging import rank_within, stage

#: Groups above this part of a shard's fair share are placed one by one. At most
#: shards * SINGLE_PARTS of them can exist, which bounds what the driver sees.
SINGLE_PARTS = 256
#: Size classes per doubling for all smaller groups; at most 64 * CLASS_STEPS classes exist.
CLASS_STEPS = 16


class Dealt(NamedTuple):
    """Ranks ``lo`` to ``hi`` of a class go to ``shard``, or to each shard in turn when it is -1."""

    size_class: int
    lo: int
    hi: int
    shard: int


def deal_class(loads: list[float], count: int, weight: float) -> list[int]:
    """How many of ``count`` equal items each shard gets from a least-loaded-first heap.

    The heap levels the loads first and then deals evenly; the level is found
    by bisection, the last items by the heap itself, so the work does not grow
    with ``count``.
    """
    low, high = min(loads), max(loads) + weight * (count / len(loads) + 1)
    for _ in range(80):
        level = (low + high) / 2
        if sum(max(0, int((level - load) // weight)) for load in loads) <= count:
            low = level
        else:
            high = level
    given = [max(0, int((low - load) // weight)) for load in loads]
    heap = [(load + n * weight, shard) for shard, (load, n) in enumerate(zip(loads, given))]
    heapq.heapify(heap)
    for _ in range(count - sum(given)):
        load, shard = heap[0]
        given[shard] += 1
        heapq.heapreplace(heap, (load + weight, shard))
    return given


def plan_lpt(single: list[tuple[int, object]], classes: list[tuple[int, int, int]], shards: int):
    """Place single groups (weight, key), then classes (class, count, total), largest first.

    Returns (key, shard) for the single groups and the dealt ranks of each class.
    """
    loads = [0.0] * shards
    heap = [(0.0, shard) for shard in range(shards)]
    placed, dealt = [], []
    for weight, key in sorted(single, key=lambda g: (-g[0], g[1])):
        load, shard = heapq.heappop(heap)
        placed.append((key, shard))
        loads[shard] = load + weight
        heapq.heappush(heap, (loads[shard], shard))
    for size_class, count, total in sorted(classes, reverse=True):
        given = deal_class(loads, count, total / count)
        rounds = min(given)
        if rounds:
            dealt.append(Dealt(size_class, 0, rounds * shards, -1))
        rank = rounds * shards
        for shard, n in enumerate(given):
            loads[shard] += n * total / count
            if n > rounds:
                dealt.append(Dealt(size_class, rank, rank + n - rounds, shard))
                rank += n - rounds
    return placed, dealt


def shard_groups(groups: DataFrame, key: list[str], weight: str, shards: int) -> DataFrame:
    """Give each group a ``shard``: heavy ones by the heap, the rest by class and rank.

    ``groups`` has one row per group. Its heavy rows (bounded by SINGLE_PARTS)
    and the sums of its size classes reach the driver, nothing else.
    """
    spark = groups.sparkSession
    total = groups.agg(F.sum(weight).alias("total")).first()["total"] or 0
    limit = total / (shards * SINGLE_PARTS)
    single = [(row[weight], tuple(row[k] for k in key)) for row in groups.where(F.col(weight) > limit).select(*key, weight).collect()]
    small = groups.where(F.col(weight) <= limit).withColumn("size_class", F.floor(F.log2(F.col(weight).cast("double")) * CLASS_STEPS).cast("int"))
    ranked = rank_within(small, ["size_class"], [F.col(weight).desc(), *[F.col(k) for k in key]], "nth", "groups")
    sums = ranked.groupBy("size_class").agg(F.count("*").alias("n"), F.sum(weight).alias("total")).collect()
    placed, dealt = plan_lpt(single, [(r["size_class"], r["n"], r["total"]) for r in sums], shards)
    plan = spark.createDataFrame(dealt, "of_class int, lo long, hi long, to_shard int")
    meets = (F.col("size_class") == F.col("of_class")) & (F.col("nth") >= F.col("lo")) & (F.col("nth") < F.col("hi"))
    # Turns go forth and back, so no shard gets the largest of every turn.
    turn = F.pmod("nth", F.lit(shards)).cast("int")
    odd = F.pmod(F.floor(F.col("nth") / shards), F.lit(2)) == 1
    in_turn = F.when(odd, F.lit(shards - 1) - turn).otherwise(turn)
    shard = F.when(F.col("to_shard") >= 0, F.col("to_shard")).otherwise(in_turn).cast("int")
    rest = ranked.join(F.broadcast(plan), meets).select(*key, shard.alias("shard"))
    kinds = ", ".join(f"{k} {dict(groups.dtypes)[k]}" for k in key)
    return rest.unionByName(spark.createDataFrame([(*k, s) for k, s in placed], f"{kinds}, shard int"))


def assign_shards(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Put ``docs`` (doc_id, text) into ``shards`` of near equal bytes, equal texts together.

    Groups of equal texts are weighed by all their copies and placed longest
    first on the least-loaded shard. A NULL text has no bytes and is grouped
    with empty texts. Repeated rows are copies. Texts are compared by 128 bits
    of hash and their length, so they are not shuffled. A group above a fair
    share makes its shard larger: it must stay together. Other columns are
    ignored; an empty table gives no rows.

    Returns doc_id, size, text_crc32, law, shard, slot (gapless per shard).
    """
    text = F.coalesce("text", F.lit(""))
    key = ["hash_a", "hash_b", "size"]
    thin = stage(
        docs.select(
            F.col("doc_id").cast("long"),
            (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.xxhash64(text).alias("hash_a"),
            F.xxhash64(F.lit(7), text).alias("hash_b"),
        ),
        "sizes",
    )
    groups = stage(thin.groupBy(*key).agg((F.count("*") * F.col("size")).cast("long").alias("weight")), "groups")
    chosen = shard_groups(groups, key, "weight", shards)
    met = thin.join(chosen, key)
    slots = rank_within(met.drop("hash_a", "hash_b"), ["shard"], [F.col("doc_id"), F.col("text_crc32")], "slot", "slots")
    return slots.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot")
