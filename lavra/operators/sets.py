"""Unions and differences."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame


def union_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """``UNION ALL`` of any number of frames, matched by column name."""
    return reduce(DataFrame.unionByName, frames)


def difference(expected: DataFrame, found: DataFrame, *keys: str) -> DataFrame:
    """Distinct key tuples of ``expected`` that ``found`` lacks, NULL included."""
    return expected.select(*keys).subtract(found.select(*keys))
