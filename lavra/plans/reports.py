"""Re-checks of the stored tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra import contracts as C
from lavra.functions.moments import hours_in_year
from lavra.operators import aggregates as A
from lavra.operators import quality as Q
from lavra.operators.sets import union_by_name
from lavra.scratch import materialize
from lavra.sources.tables import period_from_path, read_partitioned, read_tree, with_source_path


@dataclass(frozen=True)
class AdmissionsReport:
    checks: DataFrame
    periods: DataFrame
    by_year: DataFrame
    by_period: DataFrame
    by_state: DataFrame
    admission_range: DataFrame
    sample: DataFrame


def admission_checks(
    stored: DataFrame,
    columns: int = C.ADMISSION_COLUMN_COUNT,
    periods: int = C.ADMISSION_PERIOD_COUNT,
    municipalities: int = C.MUNICIPALITY_COUNT,
    states: Sequence[str] = (C.MUNICIPALITY_STATE,),
) -> list[Q.Check]:
    return [
        Q.column_count("columns", stored, columns),
        Q.unique_count("periods", ["_ano", "_mes"], periods),
        Q.not_null("without municipality", "NM_MUN"),
        Q.not_null("without state", "SIGLA_UF"),
        Q.max_distinct("distinct municipalities", ["MUNIC_RES"], municipalities),
        Q.reported_nulls("without main diagnosis", "DIAG_PRINC"),
        Q.reported_nulls("without admission date", "DT_INTER"),
        Q.value_set("states", "SIGLA_UF", states),
    ]


def admissions_report(spark: SparkSession, root: str) -> AdmissionsReport:
    """Everything that is looked at in the stored admissions.

    All checks come from one scan; nothing runs until a frame is used.
    """
    stored = read_tree(spark, root)
    dated = period_from_path(with_source_path(stored), "_arquivo")
    return AdmissionsReport(
        checks=Q.evaluate(dated, admission_checks(stored)),
        periods=A.distinct_values(dated, "_ano", "_mes"),
        by_year=A.group_counts(dated, "_ano").orderBy("_ano"),
        by_period=A.group_counts(dated, "_ano", "_mes").orderBy("_ano", "_mes"),
        by_state=A.group_counts(dated, "SIGLA_UF").orderBy(F.desc("n"), "SIGLA_UF"),
        admission_range=A.value_range(stored, "DT_INTER"),
        sample=A.first_any(
            stored.select(
                "MUNIC_RES", "NM_MUN", "SIGLA_UF", "AREA_KM2", *C.ADMISSION_DATE_COLUMNS, "DIAG_PRINC"
            ),
            10,
        ),
    )


def weather_checks(
    stations: int = C.WEATHER_STATION_COUNT, states: Sequence[str] = (C.WEATHER_STATE,)
) -> list[Q.Check]:
    hours = hours_in_year(F.col("ano"))
    return [
        Q.row_count("rows", hours * stations),
        Q.unique_count("stations", ["codigo_estacao"], stations),
        Q.value_set("states", "uf", states),
        Q.not_null("without timestamp", "data_hora_utc"),
        Q.not_null("without station code", "codigo_estacao"),
        Q.not_null("without latitude", "latitude"),
        Q.not_null("without longitude", "longitude"),
        Q.no_duplicates("duplicate station and timestamp", ["codigo_estacao", "data_hora_utc"]),
        Q.group_size("stations with an unexpected row count", ["codigo_estacao"], hours),
    ]


def weather_report(
    spark: SparkSession,
    base: str,
    years: Iterable[int],
    checks: Sequence[Q.Check] | None = None,
) -> DataFrame:
    """The check frame of all years, grouped by ``ano``.

    A year that cannot be read, or holds no rows, is one failed row; the others
    are still checked.
    """
    parts = []
    for year in years:
        try:
            stored = read_partitioned(spark, f"{base}/{year}", C.WEATHER_SILVER_SCHEMA)
            dated = stored.withColumn("ano", F.lit(year))
            # Measured here and now, so that a damaged file is noticed within its year.
            measured = materialize(Q.evaluate(dated, weather_checks() if checks is None else checks, ["ano"]), "report")
        except (PySparkException, Py4JJavaError):
            parts.append(Q.error_row(spark, "cannot be read", ano=year))
        else:
            parts.append(Q.error_row(spark, "holds no rows", ano=year) if measured.isEmpty() else measured)
    return union_by_name(parts)


@dataclass(frozen=True)
class WeatherReport:
    checks: DataFrame
    range: DataFrame
    stations: DataFrame
    sample: DataFrame


def weather_series_report(
    spark: SparkSession, base: str, years: Sequence[int], checks: Sequence[Q.Check] | None = None
) -> WeatherReport:
    """The checks, and of all readable years the time range, the rows per station and a sample."""
    checked = materialize(weather_report(spark, base, years, checks), "report")
    bad = {r["ano"] for r in checked.filter(F.col("position") < 0).select("ano").distinct().collect()}
    paths = [f"{base}/{year}" for year in years if year not in bad]
    stored = union_by_name(
        [read_partitioned(spark, path, C.WEATHER_SILVER_SCHEMA) for path in paths]
        or [spark.createDataFrame([], C.WEATHER_SILVER_SCHEMA)]
    )
    return WeatherReport(
        checks=checked,
        range=A.value_range(stored, "data_hora_utc"),
        stations=A.group_counts(stored, "ano", "codigo_estacao"),
        sample=A.first_any(stored, 10),
    )
