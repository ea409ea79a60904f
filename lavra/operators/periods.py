"""Calendars of expected periods and what is missing from them."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.functions.moments import hours_in_year


def check_year(year: int, earliest: int) -> None:
    if not isinstance(year, int) or isinstance(year, bool):
        raise TypeError("the year must be an integer")
    if year < earliest:
        raise ValueError(f"the year must be {earliest} or later")


def check_month(month: int) -> None:
    if not isinstance(month, int) or isinstance(month, bool):
        raise TypeError("the month must be an integer")
    if not 1 <= month <= 12:
        raise ValueError("the month must lie between 1 and 12")


def month_range(
    first_year: int, first_month: int, last_year: int, last_month: int, earliest: int
) -> tuple[date, date]:
    """Validated first days of an inclusive range of months."""
    for year, month in ((first_year, first_month), (last_year, last_month)):
        check_year(year, earliest)
        check_month(month)
    first, last = date(first_year, first_month, 1), date(last_year, last_month, 1)
    if first > last:
        raise ValueError("the range must not start after it ends")
    return first, last


def _with_year_and_month(months: DataFrame) -> DataFrame:
    return months.select(
        F.year("mes_inicial").alias("ano"), F.month("mes_inicial").alias("mes"), "mes_inicial"
    )


def month_spine(spark: SparkSession, first: date, last: date) -> DataFrame:
    """One row per month from ``first`` to ``last``, both included."""
    months = F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 month"))
    return _with_year_and_month(spark.range(1).select(F.explode(months).alias("mes_inicial")))


def month_spine_of(df: DataFrame, day: str) -> DataFrame:
    """One row per month between the earliest and the latest ``day`` of a table."""
    bounds = df.agg(
        F.trunc(F.min(day), "month").alias("first"), F.trunc(F.max(day), "month").alias("last")
    )
    months = F.sequence("first", "last", F.expr("interval 1 month"))
    return _with_year_and_month(bounds.select(F.explode(months).alias("mes_inicial")))


def year_spine(spark: SparkSession, first: int, last: int) -> DataFrame:
    return spark.range(first, last + 1).select(F.col("id").cast("int").alias("ano"))


def hourly_rows_expected(years: DataFrame, stations: int) -> DataFrame:
    """Rows that a complete hourly series of every station has, per year."""
    return years.withColumn("esperado", (hours_in_year(F.col("ano")) * stations).cast("long"))


def missing_keys(expected: DataFrame, found: DataFrame, *keys: str) -> DataFrame:
    """Expected keys that were not found."""
    return expected.join(found.select(*keys).distinct(), list(keys), "left_anti")


def completeness(
    expected: DataFrame, found: DataFrame, keys: Iterable[str], label: str
) -> DataFrame:
    """One row: expected, found, missing, the sorted missing labels, and a flag.

    ``expected`` is a calendar, so the list of missing labels is no longer than
    the calendar.
    """
    keys = list(keys)
    landed = found.select(*keys).distinct().withColumn("__found", F.lit(True))
    missing = F.col("__found").isNull()
    return (
        expected.join(landed, keys, "left")
        .agg(
            F.count(F.lit(1)).alias("total_esperado"),
            F.count("__found").alias("total_encontrado"),
            F.count_if(missing).alias("total_ausente"),
            F.array_sort(F.collect_list(F.when(missing, F.col(label)))).alias("ausentes"),
        )
        .withColumn("completo", F.col("total_ausente") == 0)
    )
