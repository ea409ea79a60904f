"""Calendars derived from the period that a table covers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.catalog import Entry
from lavra.catalog.dirty import table
from lavra.functions.moments import hours_in_year, monthly_file_stem
from lavra.operators.periods import missing_keys, month_range, month_spine


def _spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The months from the first order to the last, as a caller would name them."""
    first, last = table(spark, sf_dir, "orders").agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    return month_spine(spark, *month_range(first.year, first.month, last.year, last.month, earliest=1992))


def period_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spine(spark, sf_dir).select("ano", "mes")


def period_file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spine(spark, sf_dir).select(
        monthly_file_stem(F.col("mes_inicial"), "RDSP").alias("arquivo")
    )


def missing_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months in which no order of high value was placed."""
    found = (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_totalprice") > 499_900)
        .select(F.year("o_orderdate").alias("ano"), F.month("o_orderdate").alias("mes"))
    )
    return missing_keys(_spine(spark, sf_dir).select("ano", "mes"), found, "ano", "mes")


def expected_hourly_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per year: the rows of a complete series of all stations seen, and the rows found."""
    seen = (
        table(spark, sf_dir, "events")
        .groupBy(F.year("ts").alias("ano"))
        .agg(
            F.count_distinct("event_type").alias("estacoes"),
            F.count(F.lit(1)).alias("encontrado"),
        )
    )
    return seen.select(
        "ano",
        (hours_in_year(F.col("ano")) * F.col("estacoes")).cast("long").alias("esperado"),
        "encontrado",
    )


_SPINE_SQL = """select unnest(generate_series(date_trunc('month', min(o_orderdate)),
    date_trunc('month', max(o_orderdate)), interval 1 month)) as m from orders"""

ENTRIES = {
    "period_spine": Entry(
        period_spine,
        f"""select cast(year(m) as integer) as ano, cast(month(m) as integer) as mes
            from ({_SPINE_SQL})""",
    ),
    "period_file_names": Entry(
        period_file_names, f"select concat('RDSP', strftime(m, '%y%m')) as arquivo from ({_SPINE_SQL})"
    ),
    "missing_periods": Entry(
        missing_periods,
        f"""select cast(year(m) as integer) as ano, cast(month(m) as integer) as mes
            from ({_SPINE_SQL}) where m not in
              (select date_trunc('month', o_orderdate) from orders where o_totalprice > 499900)""",
    ),
    "expected_hourly_rows": Entry(
        expected_hourly_rows,
        """select cast(year(ts) as integer) as ano,
               cast(dayofyear(make_date(year(ts), 12, 31)) * 24
                    * count(distinct event_type) as bigint) as esperado,
               count(*) as encontrado from events group by year(ts)""",
    ),
}
