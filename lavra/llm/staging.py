"""Small helpers shared by the operators: written tables, Arrow chunks, ranks."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lavra.scratch import new_folder

#: Text handled at once inside a task, in bytes. One longer text is a chunk of its own.
CHUNK_BYTES = 1 << 20


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder, compressed, and read it back.

    The written table cuts the lineage and survives lost executors.
    """
    path = new_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    made = df.sparkSession.read.schema(df.schema).parquet(path)
    made.staged_at = path
    return made


def discard(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more: all that was made of them is written itself."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.staged_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches into slices holding about ``limit`` bytes of ``column``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(size, dtype=np.int64) // limit
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [batch.num_rows]])
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            yield batch.slice(int(lo), int(hi - lo))
    # A worker lives on with the next task: give back what this one no longer needs.
    pa.default_memory_pool().release_unused()


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a chunk, NULL as the empty text."""
    return [text or "" for text in batch.column(column).to_pylist()]


def worker_wide(name: str, make: Callable[[], object]) -> object:
    """One object per Python worker, kept between the tasks that it runs.

    Task functions travel by value, so their own globals start anew each time.
    """
    kept = sys.modules.setdefault("_lavra_worker_wide", types.ModuleType("_lavra_worker_wide"))
    if not hasattr(kept, name):
        setattr(kept, name, make())
    return getattr(kept, name)


def rank_within(df: DataFrame, keys: list[str], order: list[Column], name: str, label: str) -> DataFrame:
    """Number the rows of each key from 0, in ``order``.

    Rows are dealt by ranges of key and order together, so a key with any share
    of the rows is spread over many tasks; the count of earlier parts is added
    afterwards. Equal rows are numbered in any order. Column names starting
    with ``_rank`` are reserved.
    """
    wanted = [F.col(k) for k in keys] + order
    rows = stage(
        df.repartitionByRange(*wanted)
        .sortWithinPartitions(*wanted)
        .withColumn("_rank_row", F.monotonically_increasing_id())
        .withColumn("_rank_part", F.shiftright("_rank_row", 33)),
        label,
    )
    before = Window.partitionBy(*keys).orderBy("_rank_part").rowsBetween(Window.unboundedPreceding, -1)
    ends = [F.col(k).alias(f"_rank_key{i}") for i, k in enumerate(keys)]
    runs = (
        rows.groupBy(*keys, "_rank_part")
        .agg(F.min("_rank_row").alias("_rank_first"), F.count("*").alias("_rank_count"))
        .withColumn("_rank_before", F.coalesce(F.sum("_rank_count").over(before), F.lit(0)))
        .select(*ends, F.col("_rank_part").alias("_rank_of"), "_rank_first", "_rank_before")
    )
    met = F.col("_rank_part") == F.col("_rank_of")
    for i, k in enumerate(keys):
        met = met & F.col(k).eqNullSafe(F.col(f"_rank_key{i}"))
    rank = F.col("_rank_before") + F.col("_rank_row") - F.col("_rank_first")
    return rows.join(runs, met).select(*df.columns, rank.cast("long").alias(name))
