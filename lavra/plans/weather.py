"""The hourly weather series of all stations."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra import contracts as C
from lavra.functions.moments import hour_code, hourly_timestamp
from lavra.functions.text import decimal_comma, null_if_blank
from lavra.operators import quality as Q
from lavra.operators.clean import keep_matching
from lavra.operators.lookup import lookup_left
from lavra.operators.sets import union_by_name
from lavra.publish import Folders, publish, stage_rows
from lavra.scratch import materialize
from lavra.sinks import write_partitioned
from lavra.sources.archive import (
    chunk_lines,
    list_archives,
    list_members,
    member_count_check,
    read_member_chunks,
)
from lavra.sources.delimited import (
    LINE_BREAK,
    parsed_lines,
    preamble_columns,
    read_delimited,
    read_preambles,
)

PREAMBLE = {**C.WEATHER_PREAMBLE_TEXTS, **C.WEATHER_PREAMBLE_NUMBERS}


def from_archives(
    spark: SparkSession, path: str | list[str], pattern: str = C.WEATHER_MEMBER_PATTERN, keep_going: bool = False
) -> DataFrame:
    """Raw observations and preamble texts of all matching archive members.

    With ``keep_going`` a damaged archive or member is a row with ``membro`` and the complaint in ``_erro``.
    """
    chunks = read_member_chunks(
        spark, path, pattern, C.WEATHER_PREAMBLE_LINES, C.WEATHER_ENCODING, keep_going=keep_going
    )
    kept = ["_arquivo", *(["membro", "_erro"] if keep_going else []), *PREAMBLE]
    lines = F.slice(F.split("preambulo", LINE_BREAK), 1, C.WEATHER_PREAMBLE_LINES)
    described = chunks.withColumns(preamble_columns(lines, PREAMBLE))
    return parsed_lines(chunk_lines(described, *kept), "linha", C.WEATHER_RAW_SCHEMA, *kept)


def from_folder(spark: SparkSession, path: str) -> DataFrame:
    """Raw observations and preamble texts of all delimited files below a folder.

    Files of any size, compressed or not, are scanned in splits; their preambles,
    one row per file, are joined by path.
    """
    preambles = read_preambles(spark, path, PREAMBLE, C.WEATHER_PREAMBLE_LINES, C.WEATHER_ENCODING)
    return lookup_left(
        read_delimited(spark, path, C.WEATHER_RAW_SCHEMA, C.WEATHER_ENCODING),
        # Written once: it is both measured and joined.
        materialize(preambles, "preambles"),
        "_arquivo",
        "_arquivo",
        PREAMBLE,
    )


def clean(raw: DataFrame, year: int | Column, *keep: str) -> DataFrame:
    """The 28 columns of the cleaned series, from raw text, behind the columns to keep."""
    observed = keep_matching(raw, "data", C.WEATHER_DATE_PATTERN)
    hour = hour_code(F.col("hora_utc"))
    values = {
        "ano": (year if isinstance(year, Column) else F.lit(year)).cast("int"),
        "data_hora_utc": hourly_timestamp(F.col("data"), hour),
        "hora_utc": hour,
        **{
            name: decimal_comma(null_if_blank(F.col(name))) for name in C.WEATHER_PREAMBLE_NUMBERS
        },
        **{name: decimal_comma(F.col(name)) for name in C.WEATHER_MEASURES},
    }
    return observed.select(
        *keep,
        *(values.get(name, F.col(name)).alias(name) for name in C.WEATHER_SILVER_COLUMNS)
    )


def checks(
    stations: int = C.WEATHER_STATION_COUNT, states: Iterable[str] = (C.WEATHER_STATE,)
) -> list[Q.Check]:
    """In the order in which they stop the job."""
    return [
        Q.unique_count("stations", ["codigo_estacao"], stations),
        Q.not_null("without timestamp", "data_hora_utc"),
        Q.not_blank("without station code", "codigo_estacao"),
        Q.not_null("without latitude", "latitude"),
        Q.not_null("without longitude", "longitude"),
        Q.value_set("states", "uf", list(states)),
        Q.no_duplicates("duplicate station and timestamp", ["codigo_estacao", "data_hora_utc"]),
    ]


def run(raw: DataFrame, year: int | Column, path: str, required: list[Q.Check]) -> DataFrame:
    """Clean, check, and only then write by station. Returns the check frame.

    The cleaned rows are written to the shared folder once, so the checks scan
    only the columns they need and the archives are unpacked a single time.
    """
    cleaned = materialize(clean(raw, year), "weather")
    results = materialize(Q.evaluate(cleaned, required), "weather-checks")
    Q.enforce(results)
    write_partitioned(cleaned, path, ["codigo_estacao"])
    return results


def run_year(
    spark: SparkSession, year: int, landing: str, base: str, stations: int = C.WEATHER_STATION_COUNT
) -> DataFrame:
    """One year from its archive; the archive must hold one member per station."""
    archive = f"{landing}/{year}/{year}.zip"
    members = list_members(spark, archive, C.WEATHER_MEMBER_PATTERN)
    Q.enforce(member_count_check(list_archives(spark, archive), members, ".csv", stations))
    raw = from_archives(spark, archive)
    return run(raw, year, f"{base}/{year}", checks(stations))


def run_years(
    spark: SparkSession,
    years: Iterable[int],
    landing: str,
    base: str,
    stations: int = C.WEATHER_STATION_COUNT,
    required: list[Q.Check] | None = None,
) -> DataFrame:
    """All years as one job; a bad year is not written and stops no other.

    The year is that of the archive, ``landing/yyyy/yyyy.zip``, and goes as a key through reading, checks and
    writing. A year fails if its archive is missing, holds too few or
    too many members, or one that is damaged, if a check fails, or if fewer rows are
    stored than were read. Returns one row per year: ``ano``, ``status`` (``OK``
    or ``ERRO``) and ``motivo``.
    """
    places = {year: f"{landing}/{year}/{year}.zip" for year in sorted(set(years))}
    files = Folders(spark, landing)
    landed = [path for path in places.values() if files.exists(path)]
    wanted = spark.createDataFrame([(year,) for year in places], "ano int")
    if not landed:
        return _year_status(wanted, Q.error_row(spark, "", ano=0).limit(0))
    year = F.regexp_extract("_arquivo", r"(\d{4})\.zip(?:/|$)", 1).try_cast("int")

    raw = materialize(from_archives(spark, landed, keep_going=True), "weather-raw")
    damaged = raw.filter(F.col("_erro").isNotNull()).select(
        year.alias("ano"), F.concat_ws(": ", F.col("membro"), F.col("_erro")).alias("check")
    )
    cleaned = clean(raw.filter(F.col("_erro").isNull()), year)
    members = list_members(spark, landed, C.WEATHER_MEMBER_PATTERN, keep_going=True)
    counted = member_count_check(list_archives(spark, landed), members, ".csv", stations)
    judged = materialize(
        union_by_name(
            [
                damaged.select(
                    "ano", F.lit(-2).alias("position"), "check", *(F.lit(None).cast("long").alias(n) for n in ("observed", "expected")), F.lit(False).alias("passed")
                ),
                counted.withColumn("position", F.lit(-1)).withColumn("ano", year).drop("_arquivo"),
                Q.evaluate(cleaned, checks(stations) if required is None else required, ["ano"]),
            ]
        ),
        "weather-checks",
    )
    status = materialize(_year_status(wanted, judged), "weather-status")
    # A calendar has few years.
    passing = [row["ano"] for row in status.filter(F.col("status") == "OK").collect()]
    accepted = cleaned.filter(F.col("ano").isin(passing)).withColumn("_ano", F.col("ano"))
    staged = stage_rows(accepted, base, ["_ano", "codigo_estacao"], codec=None)
    stored = {row["_ano"]: row["n"] for row in staged.table.groupBy("_ano").agg(F.count(F.lit(1)).alias("n")).collect()}
    if sum(stored.values()) != staged.rows:
        raise Q.QualityError(f"{staged.rows} rows were written, {sum(stored.values())} are stored")
    publish(spark, base, staged, {f"_ano={year}": str(year) for year in stored})
    return status


def _year_status(wanted: DataFrame, judged: DataFrame) -> DataFrame:
    """One row per wanted year: its first failed check, if there is one."""
    message = F.when(F.col("observed").isNull(), F.col("check")).otherwise(
        F.format_string("%s: observed %d, expected %d", "check", "observed", "expected")
    )
    failed = F.min(F.when(~F.col("passed"), F.struct("position", message.alias("message"))))
    found = judged.groupBy("ano").agg(failed["message"].alias("motivo"), F.lit(True).alias("landed"))
    reason = F.when(F.col("landed").isNull(), "no archive landed").otherwise(F.col("motivo"))
    return wanted.join(found, "ano", "left").select(
        "ano", F.when(reason.isNull(), "OK").otherwise("ERRO").alias("status"), reason.alias("motivo")
    )
