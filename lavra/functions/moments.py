"""Dates, hours and periods. Results do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_from_digits(text: Column, pattern: str = "yyyyMMdd") -> Column:
    """Date from ``20230105``; a bad date becomes NULL."""
    return F.try_to_date(text, pattern)


def hour_code(text: Column) -> Column:
    """``0000 UTC`` becomes ``0000``."""
    return F.substring(F.trim(text), 1, 4)


def hourly_timestamp(day: Column, hour: Column) -> Column:
    """Zone-free timestamp from ``yyyy/MM/dd`` and ``HHmm``.

    NULL when either part is missing, has another shape or names no real
    moment.
    """
    well_formed = day.rlike(r"^\d{4}/\d{2}/\d{2}$") & hour.rlike(r"^\d{4}$")
    iso = F.concat(
        F.translate(day, "/", "-"),
        F.lit(" "),
        F.substring(hour, 1, 2),
        F.lit(":"),
        F.substring(hour, 3, 2),
    )
    return F.when(well_formed, iso.try_cast("timestamp_ntz"))


def hours_in_year(year: Column) -> Column:
    """8,760 or, in a leap year, 8,784."""
    return F.dayofyear(F.make_date(year, F.lit(12), F.lit(31))) * 24


def monthly_file_stem(day: Column, prefix: str) -> Column:
    """Prefix followed by two-digit year and month: ``RDSP2304``."""
    return F.concat(F.lit(prefix), F.date_format(day, "yyMM"))
