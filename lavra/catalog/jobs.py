"""The whole jobs: build, check, write, and read back what was written."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra import contracts as C
from lavra.catalog import Entry, landing
from lavra.catalog.dirty import DIMENSION_SQL, ORDERS_SQL, dimension, orders, table
from lavra.operators import quality as Q
from lavra.operators.periods import month_spine
from lavra.plans import admissions, municipalities, reports, weather
from lavra.scratch import new_folder
from lavra.sinks import write_periods
from lavra.sources import dbf
from lavra.sources.landing import MONTHLY_FILE
from lavra.sources.ranges import list_files
from lavra.sources.tables import read_partitioned, read_table

PERIOD = ["ano", "mes"]
SPEC = admissions.Enrichment()


def silver_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean, enrich, guard, write; then admissions and area per month and state."""
    path = new_folder(spark, "silver-fact")
    raw = orders(spark, sf_dir).drop("VAL_TOT", "ano", "mes")
    admissions.run(raw, dimension(spark, sf_dir), path)
    return (
        read_table(spark, path)
        .groupBy(F.date_format("DT_INTER", "yyyy-MM").alias("mes"), "SIGLA_UF")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("DIAG_PRINC").alias("com_diagnostico"),
            F.round(F.sum("AREA_KM2"), 2).alias("area_km2"),
        )
    )


def silver_batch_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of every month of 1995 to 2001 and the rows written for it.

    February has records without a birth date, so no February is written.
    """
    path = new_folder(spark, "silver-batch")
    unborn = (F.col("mes") == 2) & (F.col("o_orderkey") % 5 == 0)
    raw = (
        orders(spark, sf_dir)
        .drop("VAL_TOT")
        .withColumn("NASC", F.when(unborn, "").otherwise(F.col("NASC")))
    )
    born = Q.not_null("without birth date", "NASC")
    expected = month_spine(spark, date(1995, 1, 1), date(2001, 12, 1))
    status = admissions.run_periods(
        raw, dimension(spark, sf_dir), path, expected, extra_checks=[born]
    )
    return _with_written(status, read_table(spark, path))


def silver_fact_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From landed DBF files to the fact: status of every month and the rows written for it.

    February has been cut short, for May nothing has landed, and July 1996 is not expected. March 1997
    lies in another folder, too, June 1999 has a second file, and one file has a strange name.
    """
    path = new_folder(spark, "silver-landed")
    files = list_files(spark, landing.damaged_admission_files(spark, sf_dir))
    fields = dbf.describe(spark, files)
    rows, unreadable = admissions.stage_months(spark, files, fields, MONTHLY_FILE)
    expected = month_spine(spark, date(1995, 1, 1), date(2001, 12, 1)).filter(
        "not (ano = 1996 and mes = 7)"
    )
    status = admissions.run_periods(
        rows, dimension(spark, sf_dir), path, expected, unreadable=unreadable
    )
    short = status.withColumn("motivo", F.regexp_replace("motivo", "^cut short.*", "cut short"))
    return _with_written(short, read_table(spark, path))


def _with_written(status: DataFrame, written: DataFrame) -> DataFrame:
    rows = written.groupBy(*PERIOD).agg(F.count(F.lit(1)).alias("linhas"))
    return status.join(rows, PERIOD, "left")


def _series_checks() -> list[Q.Check]:
    return [
        Q.max_distinct("stations", ["codigo_estacao"], C.WEATHER_STATION_COUNT),
        *[check for check in weather.checks() if check.name not in ("stations", "states")],
        Q.value_set("states", "uf", ["MG", "SP"]),
    ]


def _hourly_series(spark: SparkSession, sf_dir: str) -> str:
    base = new_folder(spark, "silver-weather")
    raw = weather.from_archives(spark, landing.hourly_archives(spark, sf_dir))
    weather.run(raw, 2024, f"{base}/2024", _series_checks())
    return base


def silver_timeseries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly series: out of the archive, checked, written by station, read back."""
    base = _hourly_series(spark, sf_dir)
    stored = read_partitioned(spark, f"{base}/2024", C.WEATHER_SILVER_SCHEMA)
    return stored.select(
        "ano",
        F.date_format("data_hora_utc", "yyyy-MM-dd HH:mm:ss").alias("data_hora_utc"),
        "data",
        "hora_utc",
        "codigo_estacao",
        "uf",
        "latitude",
        "altitude",
        "precipitacao_mm",
        "pressao_estacao_mb",
        "vento_velocidade_ms",
    )


YEARS = [landing.GOOD_YEAR, landing.MISSING_YEAR, landing.DAMAGED_YEAR, landing.SHORT_YEAR]
STATIONS = 5


def _yearly_series(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    base = new_folder(spark, "silver-years")
    required = weather.checks(STATIONS, ["MG", "SP"])
    status = weather.run_years(spark, YEARS, landing.yearly_series(spark, sf_dir), base, STATIONS, required)
    return status, base


def silver_timeseries_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four years in one job: whole, missing, with a damaged member, one member short; and the rows stored."""
    status, base = _yearly_series(spark, sf_dir)
    rows = read_partitioned(spark, f"{base}/{landing.GOOD_YEAR}", C.WEATHER_SILVER_SCHEMA).groupBy("ano")
    return status.join(rows.agg(F.count(F.lit(1)).alias("linhas")), "ano", "left")


def quality_report_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the stored years that can be read: rows per station, and the range of all."""
    _, base = _yearly_series(spark, sf_dir)
    report = reports.weather_series_report(spark, base, YEARS, reports.weather_checks(STATIONS, ["MG", "SP"]))
    first, last = (F.date_format(F.col(name), "yyyy-MM-dd HH:mm:ss").alias(name) for name in report.range.columns)
    # One row of two moments.
    return report.stations.join(report.range.select(first, last))


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored series re-checked per year; one of the two years cannot be read."""
    base = _hourly_series(spark, sf_dir)
    return reports.weather_report(spark, base, [2023, 2024]).drop("position")


def quality_report_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored admissions re-checked, with the period taken from the path."""
    root = f"{new_folder(spark, 'stored')}/sih"
    cleaned = admissions.clean(orders(spark, sf_dir).drop("VAL_TOT"))
    enriched = admissions.enrich(cleaned, dimension(spark, sf_dir))
    write_periods(enriched, root)
    return reports.admissions_report(spark, root).checks.drop("position")


def silver_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes from archived DBF files, mean vertex from points, written and read back."""
    path = new_folder(spark, "silver-dimension")
    attributes = municipalities.read_attributes(
        spark, landing.municipality_archives(spark, sf_dir)
    )
    vertices = table(spark, sf_dir, "events").select(
        F.concat(F.lit("35"), F.lpad(F.col("user_id").cast("string"), 12, "0"), F.lit(" ")).alias(
            "CD_MUN"
        ),
        (F.col("value") * 2 - 50).alias("x"),
        F.col("value").alias("y"),
    )
    unmet = ("municipalities", "distinct CD_MUN", "distinct CD_MUN_6")
    missing = ("without latitude", "without longitude")
    required = [c for c in municipalities.checks() if c.name not in unmet + missing]
    municipalities.run(attributes, vertices, path, required)
    return read_table(spark, path).select(
        "CD_MUN",
        "CD_MUN_6",
        "NM_MUN",
        "SIGLA_UF",
        "AREA_KM2",
        F.round("latitude", 9).alias("latitude"),
        F.round("longitude", 9).alias("longitude"),
    )


_CLEAN_SQL = f"""
select o_orderkey, ano, mes, nullif(trim(MUNIC_RES), '') as MUNIC_RES,
       try_strptime(DT_INTER, '%Y%m%d') as DT_INTER, try_strptime(DT_SAIDA, '%Y%m%d') as DT_SAIDA,
       case when trim(DIAG_PRINC) <> '' then DIAG_PRINC end as DIAG_PRINC
from ({ORDERS_SQL})
"""
_ENRICHED_SQL = f"""
select * from ({_CLEAN_SQL}) c join ({DIMENSION_SQL}) d on c.MUNIC_RES = d.CD_MUN_6
"""
_HOURLY_SQL = """
select event_type, date_trunc('hour', ts) as hora, count(*) as n,
       sum(cast(floor(value * 100) as bigint)) as cents
from events group by all
"""


def _report_line(group: str, name: str, observed: str, expected: str, passed: str, source: str) -> str:
    return (
        f"""select {group} '{name}' as "check", cast({observed} as bigint) as observed, """
        f"""cast({expected} as bigint) as expected, {passed} as passed from {source}"""
    )


def _weather_report_sql() -> str:
    year = "cast(2024 as integer) as ano,"
    lines = [
        _report_line(year, "rows", "count(*)", "8784 * 40", "count(*) = 8784 * 40", "h"),
        _report_line(
            year,
            "stations",
            "count(distinct event_type)",
            "40",
            "count(distinct event_type) = 40",
            "h",
        ),
        _report_line(
            year,
            "states",
            "count_if(event_type = 'click')",
            "0",
            "count_if(event_type = 'click') = 0",
            "h",
        ),
        *(
            _report_line(year, name, "0", "0", "true", "(select 1)")
            for name in (
                "without timestamp",
                "without station code",
                "without latitude",
                "without longitude",
                "duplicate station and timestamp",
            )
        ),
        _report_line(
            year,
            "stations with an unexpected row count",
            "count(*)",
            "0",
            "count(*) = 0",
            "(select event_type from h group by 1 having count(*) <> 8784)",
        ),
        _report_line(
            "cast(2023 as integer) as ano,", "cannot be read", "null", "null", "false", "(select 1)"
        ),
    ]
    return f"with h as ({_HOURLY_SQL})\n" + "\nunion all\n".join(lines)


def _fact_report_sql() -> str:
    def line(name: str, observed: str, expected: str, test: str) -> str:
        return _report_line("", name, observed, expected, f"{observed} {test}", "e")

    lines = [
        _report_line("", "columns", "9", "116", "false", "(select 1)"),
        line("periods", "count(distinct ano * 100 + mes)", "36", "= 36"),
        line("without municipality", "count_if(NM_MUN is null)", "0", "= 0"),
        line("without state", "count_if(SIGLA_UF is null)", "0", "= 0"),
        line("distinct municipalities", "count(distinct MUNIC_RES)", "645", "<= 645"),
        line("without main diagnosis", "count_if(DIAG_PRINC is null)", "null", ">= 0"),
        line("without admission date", "count_if(DT_INTER is null)", "null", ">= 0"),
        line("states", "count(*) + 1", "0", "= 0"),
    ]
    return f"with e as ({_ENRICHED_SQL})\n" + "\nunion all\n".join(lines)


ENTRIES = {
    "silver_fact": Entry(
        silver_fact,
        f"""select strftime(DT_INTER, '%Y-%m') as mes, SIGLA_UF, count(*) as n,
               count(DIAG_PRINC) as com_diagnostico, round(sum(AREA_KM2), 2) as area_km2
            from ({_ENRICHED_SQL}) group by all""",
    ),
    "silver_batch_status": Entry(
        silver_batch_status,
        f"""with e as (select unnest(generate_series(timestamp '1995-01-01',
                         timestamp '2001-12-01', interval 1 month)) as m),
                 s as (select ano, mes, count_if(mes = 2 and o_orderkey % 5 = 0) as bad
                       from ({_CLEAN_SQL}) group by all),
                 w as (select ano, mes, count(*) as linhas from ({_ENRICHED_SQL}) group by all)
            select cast(year(m) as integer) as ano, cast(month(m) as integer) as mes,
                   case when bad = 0 then 'OK' else 'ERRO' end as status,
                   case when bad is null then 'no rows landed'
                        when bad > 0 then concat('without birth date: ', cast(bad as varchar))
                   end as motivo,
                   case when bad = 0 then linhas end as linhas
            from e left join s on year(m) = s.ano and month(m) = s.mes
                   left join w on year(m) = w.ano and month(m) = w.mes""",
    ),
    "silver_fact_landed": Entry(
        silver_fact_landed,
        f"""with e as (select unnest(generate_series(timestamp '1995-01-01',
                         timestamp '2001-12-01', interval 1 month)) as m),
                 x as (select cast(year(m) as integer) as ano, cast(month(m) as integer) as mes
                       from e where m <> timestamp '1996-07-01'),
                 l as (select distinct ano, mes from ({_CLEAN_SQL}) where mes <> 5),
                 w as (select ano, mes, count(*) as linhas from ({_ENRICHED_SQL})
                       where o_orderkey % 101 <> 0 group by all),
                 s as (select coalesce(x.ano, l.ano) as ano, coalesce(x.mes, l.mes) as mes,
                         case when x.ano is null then 'period not expected'
                              when l.ano is null then 'no rows landed'
                              when l.ano = 1997 and l.mes = 3 then 'wrong folder'
                              when l.ano = 1999 and l.mes = 6 then 'second file of its period'
                              when l.mes = 2 then 'cut short' end as motivo
                       from x full join l on x.ano = l.ano and x.mes = l.mes
                       union all select null, null, 'unknown name' from l where ano = 1998 and mes = 4)
            select s.ano, s.mes, case when motivo is null then 'OK' else 'ERRO' end as status, motivo,
                   case when motivo is null then linhas end as linhas
            from s left join w on s.ano = w.ano and s.mes = w.mes""",
    ),
    "silver_timeseries": Entry(
        silver_timeseries,
        f"""select 2024 as ano, strftime(hora, '%Y-%m-%d %H:%M:%S') as data_hora_utc,
               strftime(hora, '%Y/%m/%d') as data, strftime(hora, '%H%M') as hora_utc,
               concat('A-', event_type) as codigo_estacao,
               case when event_type = 'click' then 'MG' else 'SP' end as uf,
               cast(concat('-2', cast(length(event_type) as varchar), '.5') as double) as latitude,
               case when event_type <> 'view' then cast(785.64 as double) end as altitude,
               cast(concat(cast(cents // 100 as varchar), '.',
                           lpad(cast(cents % 100 as varchar), 2, '0')) as double) as precipitacao_mm,
               cast(n as double) as pressao_estacao_mb,
               cast(null as double) as vento_velocidade_ms
            from ({_HOURLY_SQL})""",
    ),
    "silver_timeseries_years": Entry(
        silver_timeseries_years,
        f"""with h as ({_HOURLY_SQL}), n as (select count(*) as linhas from h),
                 x as (select upper(max(event_type)) as last from h)
            select 2021 as ano, 'OK' as status, null::varchar as motivo, linhas from n
            union all select 2022, 'ERRO', 'no archive landed', null
            union all select 2023, 'ERRO', concat('2023/INMET_SE_SP_', last, '_.CSV: wrong checksum'), null from x
            union all select 2024, 'ERRO', 'members ending in .csv: observed 4, expected 5', null""",
    ),
    "quality_report_stations": Entry(
        quality_report_stations,
        f"""with h as ({_HOURLY_SQL}), r as (select min(hora) - interval 3 year as a, max(hora) - interval 3 year as b from h)
            select 2021 as ano, concat('A-', event_type) as codigo_estacao, count(*) as n,
                   strftime(any_value(a), '%Y-%m-%d %H:%M:%S') as data_hora_utc_min,
                   strftime(any_value(b), '%Y-%m-%d %H:%M:%S') as data_hora_utc_max
            from h cross join r group by event_type""",
    ),
    "quality_report": Entry(quality_report, _weather_report_sql()),
    "quality_report_fact": Entry(quality_report_fact, _fact_report_sql()),
    "silver_dimension": Entry(
        silver_dimension,
        """select concat('35', lpad(cast(c_custkey as varchar), 12, '0')) as CD_MUN,
               substring(concat('35', lpad(cast(c_custkey as varchar), 12, '0')), 1, 6) as CD_MUN_6,
               concat('Município é ', c_name) as NM_MUN, 'SP' as SIGLA_UF,
               case when c_custkey % 5 <> 0 then cast(floor(abs(c_acctbal)) as bigint) + 0.25::double end
                 as AREA_KM2,
               latitude, longitude
           from customer left join (
               select user_id, round(avg(value), 9) as latitude,
                      round(avg(value * 2 - 50), 9) as longitude from events group by user_id)
             on c_custkey = user_id
           where c_custkey % 11 <> 0""",
    ),
}
