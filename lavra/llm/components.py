"""Connected components by alternating stars, as joins and minima only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.llm.staging import discard, stage

MAX_ROUNDS = 40


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a long, b long); the label is the least node reachable.

    Each round links every node's larger neighbours, then its smaller ones, to
    the least of its neighbourhood. Minima are combined before the shuffle and
    no neighbourhood is gathered, so a node may have any number of edges. A
    round is written to the shared folder; the end is a round without change.
    """
    ordered = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current, before = stage(ordered.distinct(), "edges"), None
    for _ in range(MAX_ROUNDS):
        both = _both_ways(current)
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # A node that is the least of its neighbourhood has only larger ones: its edges stay as they are.
        large = large.where("a != b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
        linked = small.unionByName(down.select("a", F.col("m").alias("b"))).distinct()
        last, current = current, stage(linked, "edges")
        discard(last)
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"no fixed point after {MAX_ROUNDS} rounds")
    roots = current.select(F.col("b").alias("node")).distinct().withColumn("label", F.col("node"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(roots)
