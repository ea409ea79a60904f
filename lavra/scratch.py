"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folder: tempfile.TemporaryDirectory | None = None


def shared_folder(spark: SparkSession) -> str:
    """Return the folder named by ``spark.checkpoint.dir``.

    Only a local session, where driver and executors are one process, may fall
    back to a temporary folder of this machine.
    """
    global _local_folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    if _local_folder is None:
        _local_folder = tempfile.TemporaryDirectory(prefix="lavra-")
    return _local_folder.name


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh, unused path below the shared folder."""
    run = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/lavra/{run}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Unlike a cache, the written table survives the loss of executors, and it
    cuts the lineage for everything that is built on it.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
