"""Counts, ranges, duplicates and samples."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.functions.text import is_blank


def distinct_count(*names: str) -> Column:
    """Distinct values or tuples, where NULL counts as a value.

    A struct is never NULL itself, so the plain distinct aggregate keeps the
    NULL that ``count(DISTINCT c)`` would skip.
    """
    return F.count_distinct(F.struct(*names))


def null_count(name: str) -> Column:
    return F.count_if(F.col(name).isNull())


def blank_count(name: str) -> Column:
    return F.count_if(is_blank(F.col(name)))


def null_counts(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """NULLs per column, all in one pass: one row, one column per name."""
    return df.agg(*(null_count(name).alias(name) for name in names))


def blank_counts(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """NULL or blank texts per column, all in one pass."""
    return df.agg(*(blank_count(name).alias(name) for name in names))


def group_counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def duplicate_groups(df: DataFrame, *keys: str) -> DataFrame:
    """How many key tuples occur more than once."""
    return (
        group_counts(df, *keys).filter(F.col("n") > 1).agg(F.count(F.lit(1)).alias("n"))
    )


def duplicate_excess(df: DataFrame, *keys: str) -> DataFrame:
    """Rows beyond the first of each key tuple: total less distinct."""
    return df.agg((F.count(F.lit(1)) - distinct_count(*keys)).alias("n"))


def unexpected_groups(df: DataFrame, keys: Iterable[str], expected: Column | int) -> DataFrame:
    """How many groups do not have the expected number of rows."""
    return (
        group_counts(df, *keys).filter(F.col("n") != expected).agg(F.count(F.lit(1)).alias("n"))
    )


def value_range(df: DataFrame, *names: str) -> DataFrame:
    """Smallest and largest value of each column in one pass."""
    return df.agg(
        *(
            bound(name).alias(f"{name}_{label}")
            for name in names
            for label, bound in (("min", F.min), ("max", F.max))
        )
    )


def distinct_values(df: DataFrame, *names: str) -> DataFrame:
    """The distinct values or tuples, sorted, NULL first."""
    return df.select(*names).distinct().orderBy(*names)


def vertex_mean(df: DataFrame, polygon: str, x: str, y: str) -> DataFrame:
    """Mean of all vertices of each polygon; x is longitude, y is latitude."""
    return df.groupBy(polygon).agg(F.avg(y).alias("latitude"), F.avg(x).alias("longitude"))


def first_sorted(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """The first ``n`` rows in key order, as a distributed top-k."""
    return df.orderBy(*keys).limit(n)


def first_any(df: DataFrame, n: int) -> DataFrame:
    """Any ``n`` rows, for looking at."""
    return df.limit(n)
