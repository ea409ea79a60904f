"""Parquet tables, their directory layouts, and small local tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Accept both plain directories (2023/01) and named ones (ano=2023/mes=01).
YEAR_IN_PATH = r"/sih/(?:ano=)?(\d{4})/"
MONTH_IN_PATH = r"/(?:mes=)?(\d{1,2})/[^/]+$"


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def read_tree(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """Every Parquet file below ``root``, whatever its directories are called."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.option("recursiveFileLookup", "true").parquet(root)


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table with ``column=value`` directories.

    The schema includes the partition columns, so that their types are declared
    rather than guessed from the directory names.
    """
    return spark.read.schema(schema).parquet(path)


def period_from_path(
    df: DataFrame, path: str, year_pattern: str = YEAR_IN_PATH, month_pattern: str = MONTH_IN_PATH
) -> DataFrame:
    """Add ``_ano`` and ``_mes`` from a file path; NULL where the path has none."""
    return df.withColumns(
        {
            "_ano": F.regexp_extract(F.col(path), year_pattern, 1).try_cast("int"),
            "_mes": F.regexp_extract(F.col(path), month_pattern, 1).try_cast("int"),
        }
    )


def with_source_path(df: DataFrame) -> DataFrame:
    """Add ``_arquivo``, the file each row was read from."""
    return df.withColumn("_arquivo", F.col("_metadata.file_path"))


def local_rows(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType | str) -> DataFrame:
    """A small table of literal rows; the schema is always declared."""
    return spark.createDataFrame(list(rows), schema)
