"""Landed binary files, read by byte ranges inside tasks.

Spark lists the files; a task opens what it needs through an Arrow file system
(local, HDFS, S3 or GCS paths) and reads no more than the ranges it works on.
So the size of a file is not bounded by what fits into one row.
"""

from __future__ import annotations

import io
from collections.abc import Callable
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What opens a path for reading at any place.
Opener = Callable[[str], BinaryIO]


class _File(io.RawIOBase):
    """An Arrow file as Python's own: a place before its start is an OSError."""

    def __init__(self, native: pa.NativeFile):
        self.native = native

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        return self.native.readinto(buffer)

    def seek(self, place: int, whence: int = io.SEEK_SET) -> int:
        try:
            return self.native.seek(place, whence)
        except ValueError as problem:
            raise OSError(str(problem)) from None

    def tell(self) -> int:
        return self.native.tell()

    def close(self) -> None:
        self.native.close()
        super().close()


def open_file(path: str) -> BinaryIO:
    system, name = fs.FileSystem.from_uri(path)
    return _File(system.open_input_file(name))


def open_stream(path: str) -> BinaryIO:
    """A file from its start, inflated if its name says that it is compressed."""
    system, name = fs.FileSystem.from_uri(path)
    return system.open_input_stream(name, compression="detect")


#: How many tasks' worth of files one task takes that reads no more of a file than its head.
HEADS_PER_TASK = 16
#: Into how many tasks Spark deals the listing of one folder that has many folders in it: one for each, if it may.
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def listed(spark: SparkSession, path: str | list[str], *columns: Column) -> DataFrame:
    """``columns`` of the ``binaryFile`` rows of every file at ``path``; no content is to be among them.

    Each task reports to the driver, so a task for each folder, and one for every few files, would send
    more than the names do. A listing has a task per core, and its rows are in partitions of many files.
    """
    cores, before = spark.sparkContext.defaultParallelism, spark.conf.get(LISTING_TASKS)
    spark.conf.set(LISTING_TASKS, str(min(int(before), cores)))
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(*columns)
    finally:
        spark.conf.set(LISTING_TASKS, before)
    return files.coalesce(max(4 * cores, files.rdd.getNumPartitions() // HEADS_PER_TASK))


def list_files(spark: SparkSession, path: str | list[str] | DataFrame) -> DataFrame:
    """``_arquivo`` and ``_bytes`` of every file at ``path``, from the listing alone.

    Spark lists no files of zero bytes: they count as not landed. A listing made before is taken as it
    is, so what needs the same files several times lists them once.
    """
    if isinstance(path, DataFrame):
        return path
    return listed(spark, path, F.col("_metadata.file_path").alias("_arquivo"), F.col("length").alias("_bytes"))


def _size_of(spark: SparkSession, name: str) -> int:
    bytes_of = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    return bytes_of(spark.conf.get(name))


def spread(work: DataFrame, total_bytes: int, *keys: str) -> DataFrame:
    """Deal rows of work, which stand for so many bytes of files, over tasks.

    Rows are small while what they stand for is not, so their own size says
    nothing. As for Spark's file scans, a task gets ``spark.sql.files.maxPartitionBytes``,
    or less where that would leave cores without work.
    """
    spark = work.sparkSession
    largest = _size_of(spark, "spark.sql.files.maxPartitionBytes")
    least = _size_of(spark, "spark.sql.files.openCostInBytes")
    per_core = -(-total_bytes // spark.sparkContext.defaultParallelism)
    tasks = max(1, -(-total_bytes // min(largest, max(least, per_core))))
    return work.repartition(tasks, *keys)


def total_bytes(files: DataFrame) -> int:
    return files.agg(F.sum("_bytes").alias("total")).first()["total"] or 0
