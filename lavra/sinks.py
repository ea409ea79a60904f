"""Parquet sinks. A rerun replaces what it writes and nothing else."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter

from lavra.publish import Folders, publish, stage_rows


def _writer(df: DataFrame, codec: str | None, max_records: int | None) -> DataFrameWriter:
    writer = df.write.mode("overwrite")
    if codec:
        writer = writer.option("compression", codec)
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    return writer


def write_table(
    df: DataFrame, path: str, codec: str | None = None, max_records: int | None = None
) -> None:
    """Replace the table at ``path``."""
    _writer(df, codec, max_records).parquet(path)


def write_partitioned(
    df: DataFrame,
    path: str,
    columns: Sequence[str],
    codec: str | None = None,
    max_records: int | None = None,
) -> None:
    """Replace the table at ``path`` with one directory per value.

    The rebalance hint brings equal values together so that files are few, and
    splits a value that holds too many rows over several tasks.
    """
    rebalanced = df.hint("rebalance", *columns)
    _writer(rebalanced, codec, max_records).partitionBy(*columns).parquet(path)


def period_path(root: str, year: int, month: int) -> str:
    """Where one period of a table by periods lies."""
    return f"{root}/ano={year}/mes={month}"


def period_folders(files: Folders, root: str, depth: int) -> list[str]:
    """The partition folders below ``root``, ``depth`` levels down."""
    if not depth:
        return [""]
    return [
        f"{name}/{below}".rstrip("/")
        for name in files.children(root)
        if "=" in name
        for below in period_folders(files, f"{root}/{name}", depth - 1)
    ]


def write_periods(
    df: DataFrame,
    path: str,
    columns: Sequence[str] = ("ano", "mes"),
    codec: str | None = "snappy",
    max_records: int | None = None,
) -> None:
    """Replace only the periods that occur in ``df``; leave the others alone.

    They are written aside and put in place by renames, which
    :func:`lavra.publish.recover` finishes after a crash.
    """
    spark = df.sparkSession
    staged = stage_rows(df, path, columns, codec, max_records)
    folders = period_folders(Folders(spark, path), f"{staged.folder}/rows", len(columns))
    publish(spark, path, staged, dict(zip(folders, folders)))
