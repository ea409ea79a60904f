"""The registered queries: each a Spark function and, where SQL can say it, its SQL."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession


class Entry(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def entries() -> dict[str, Entry]:
    from lavra.catalog import checks, counts, files, jobs, joins, rows, spans

    found: dict[str, Entry] = {}
    for module in (rows, joins, counts, spans, checks, files, jobs):
        found.update(module.ENTRIES)
    return found
