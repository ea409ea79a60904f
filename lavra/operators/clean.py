"""Cleaning applied to whole frames, one projection each."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra.functions.moments import date_from_digits
from lavra.functions.text import decimal_comma, null_if_blank


def map_columns_of_type(
    df: DataFrame, data_type: type[T.DataType], change: Callable[[Column], Column]
) -> DataFrame:
    """Apply ``change`` to every column of a type in a single ``select``.

    One projection keeps analysis linear in the number of columns, which counts
    on tables with more than a hundred of them.
    """
    return df.select(
        *(
            change(F.col(f"`{field.name}`")).alias(field.name)
            if isinstance(field.dataType, data_type)
            else F.col(f"`{field.name}`")
            for field in df.schema.fields
        )
    )


def map_columns(
    df: DataFrame, names: Iterable[str], change: Callable[[Column], Column]
) -> DataFrame:
    """Apply ``change`` to the named columns in a single projection."""
    return df.withColumns({name: change(F.col(f"`{name}`")) for name in names})


def blanks_to_null(df: DataFrame) -> DataFrame:
    return map_columns_of_type(df, T.StringType, null_if_blank)


def parse_dates(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return map_columns(df, names, date_from_digits)


def parse_decimals(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return map_columns(df, names, decimal_comma)


def trim_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return map_columns(df, names, F.trim)


def keep_matching(df: DataFrame, name: str, pattern: str) -> DataFrame:
    return df.filter(F.col(name).rlike(pattern))


def keep_present(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col(name).isNotNull())
