"""Delimited text files with a preamble of descriptive lines."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra.functions.text import last_value_of
from lavra.sources.ranges import Opener, list_files, open_stream

#: Bytes read at first of a file whose first lines are wanted.
HEAD = 1 << 12

LINE_BREAK = r"\r\n|\n|\r"

CSV_OPTIONS = {"sep": ";", "mode": "PERMISSIVE", "nullValue": ""}


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    encoding: str = "ISO-8859-1",
) -> DataFrame:
    """All delimited files below ``path`` as one scan, with ``_arquivo``.

    The first line of each file is dropped as a header. Short rows are filled
    with NULL and surplus fields are dropped. Compressed files are read like plain ones.
    """
    return (
        spark.read.options(**CSV_OPTIONS)
        .option("header", "true")
        .option("encoding", encoding)
        .option("recursiveFileLookup", "true")
        .schema(schema)
        .csv(path)
        .withColumn("_arquivo", F.col("_metadata.file_path"))
    )


def first_lines(stream: BinaryIO, lines: int, block: int = HEAD) -> list[bytes]:
    """The first lines of a stream, read in growing blocks and no further than they need."""
    content = b""
    while True:
        more = stream.read(block)
        content += more
        found = content.splitlines()
        if not more or len(found) > lines or len(found) == lines and content.endswith(b"\n"):
            return found[:lines]
        block *= 2


def read_first_lines(
    spark: SparkSession,
    path: str | list[str],
    lines: int,
    encoding: str,
    opener: Opener = open_stream,
) -> DataFrame:
    """``_arquivo`` and the first lines of each file of any size, from its head alone.

    The listing deals files over tasks as it would their content, so large files
    have a task each, which reads their first ``HEAD`` bytes, more only where lines are longer.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads = []
            for name in batch.column("_arquivo").to_pylist():
                with opener(name) as stream:
                    heads.append(first_lines(stream, lines))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_arquivo"), pa.array(heads, pa.list_(pa.binary()))],
                names=["_arquivo", "linhas"],
            )

    heads = list_files(spark, path).select("_arquivo").mapInArrow(run, "_arquivo string, linhas array<binary>")
    return heads.select(
        "_arquivo", F.transform("linhas", lambda line: F.decode(line, encoding)).alias("linhas")
    )


def parsed_lines(df: DataFrame, line: str, schema: T.StructType, *keep: str) -> DataFrame:
    """The columns to keep and the fields of each delimited line.

    As a generator the parse runs once per line; as a projection it would be
    repeated in every filter that Catalyst moves below it.
    """
    fields = F.from_csv(line, schema.toDDL(), CSV_OPTIONS)
    return df.select(*keep, F.inline(F.array(fields)))


def preamble_columns(lines: Column, labels: Mapping[str, str]) -> dict[str, Column]:
    """One column per label, from an array of preamble lines."""
    return {name: last_value_of(lines, label) for name, label in labels.items()}


def read_preambles(
    spark: SparkSession,
    path: str,
    labels: Mapping[str, str],
    lines: int = 8,
    encoding: str = "ISO-8859-1",
) -> DataFrame:
    """One row per file: ``_arquivo`` and the value of each label in its first lines."""
    return read_first_lines(spark, path, lines, encoding).select(
        "_arquivo",
        *(value.alias(name) for name, value in preamble_columns(F.col("linhas"), labels).items()),
    )
