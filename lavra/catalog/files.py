"""Reading landed files and writing tables, each over files made from whole tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra import contracts as C
from lavra import sinks
from lavra.catalog import Entry, landing
from lavra.catalog.dirty import EVENTS_SQL, ORDERS_SQL, orders, table
from lavra.operators.periods import completeness, month_spine
from lavra.plans import admissions, municipalities, weather
from lavra.scratch import materialize, new_folder
from lavra.sources import tables
from lavra.sources.archive import list_archives, list_members, member_count_check
from lavra.sources.dbf import Field, read_dbf
from lavra.sources.delimited import read_delimited, read_preambles
from lavra.sources.landing import FITS, SECOND_FILE, UNKNOWN_NAME, WRONG_FOLDER, landed_files, landed_years, monthly_ledger

STATION = r"event_type=([^/]+)/"
BLOCK = r"pasta=([^/]+)\.zip/"


def sink_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "sink")
    rows = table(spark, sf_dir, "supplier")
    sinks.write_table(rows.limit(0), path)
    sinks.write_table(rows, path, codec="snappy")
    return tables.read_table(spark, path, rows.schema)


def scan_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-digit and mixed directory values, read back as the declared text."""
    path = new_folder(spark, "partitioned")
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        "value",
        F.when(F.col("event_type") == "click", "000").otherwise(F.col("event_type")).alias(
            "codigo_estacao"
        ),
    )
    sinks.write_partitioned(rows, path, ["codigo_estacao"])
    return tables.read_partitioned(spark, path, rows.schema)


def scan_recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree of periods, read whole; the period comes from the path."""
    path = f"{new_folder(spark, 'tree')}/sih"
    rows = orders(spark, sf_dir).select(
        "o_orderkey", "ano", F.lpad(F.col("mes").cast("string"), 2, "0").alias("mes")
    )
    sinks.write_partitioned(rows, path, ["ano", "mes"])
    stored = tables.read_tree(spark, path, T.StructType([T.StructField("o_orderkey", T.LongType())]))
    dated = tables.period_from_path(tables.with_source_path(stored), "_arquivo")
    return dated.select("o_orderkey", F.col("_ano").alias("ano"), F.col("_mes").alias("mes"))


def sink_period_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all periods, then March again with other values: only March changes."""
    path = new_folder(spark, "periods")
    rows = orders(spark, sf_dir).select("o_orderkey", "DIAG_PRINC", "ano", "mes")
    sinks.write_periods(rows, path)
    march = rows.filter(F.col("mes") == 3).withColumn("DIAG_PRINC", F.lit("corrigido"))
    sinks.write_periods(march, path)
    return tables.read_partitioned(spark, path, rows.schema)


def scan_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = read_delimited(spark, landing.event_files(spark, sf_dir), C.WEATHER_RAW_SCHEMA)
    return body.filter(F.col("data").rlike(C.WEATHER_DATE_PATTERN)).select(
        F.regexp_extract("_arquivo", STATION, 1).alias("event_type"),
        F.col("pressao_estacao_mb").cast("long").alias("event_id"),
        "data",
        "hora_utc",
        "precipitacao_mm",
        "pressao_max_mb",
        "pressao_min_mb",
        "vento_velocidade_ms",
    )


def file_preamble(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = read_preambles(spark, landing.event_files(spark, sf_dir), weather.PREAMBLE)
    return found.select(
        F.regexp_extract("_arquivo", STATION, 1).alias("event_type"), *weather.PREAMBLE
    )


def attach_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = weather.from_folder(spark, landing.event_files(spark, sf_dir))
    return weather.clean(raw, 2024).select(
        F.col("pressao_estacao_mb").cast("long").alias("event_id"),
        "ano",
        F.date_format("data_hora_utc", "yyyy-MM-dd HH:mm:ss").alias("data_hora_utc"),
        "codigo_estacao",
        "estacao",
        "uf",
        "regiao",
        "latitude",
        "longitude",
        "altitude",
        "precipitacao_mm",
        "pressao_max_mb",
        "pressao_min_mb",
    )


def archive_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matching members per archive, with the check that there are forty."""
    path, block = landing.event_archives(spark, sf_dir), F.regexp_extract("_arquivo", BLOCK, 1)
    members = list_members(spark, path, C.WEATHER_MEMBER_PATTERN).withColumn("_arquivo", block)
    archives = list_archives(spark, path).select(block.alias("_arquivo")).distinct()
    return member_count_check(archives, members, ".csv", C.WEATHER_STATION_COUNT).drop("position")


def archive_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same observations as from the folder, out of the archives."""
    raw = weather.from_archives(spark, landing.event_archives(spark, sf_dir))
    return weather.clean(raw, 2024).select(
        F.col("pressao_estacao_mb").cast("long").alias("event_id"),
        F.date_format("data_hora_utc", "yyyy-MM-dd HH:mm:ss").alias("data_hora_utc"),
        "codigo_estacao",
        "estacao",
        "uf",
        "latitude",
        "longitude",
        "altitude",
        "precipitacao_mm",
        "pressao_max_mb",
        "vento_velocidade_ms",
    )


def dbf_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = [Field(name, kind) for name, kind, _ in landing.CUSTOMER_FIELDS]
    return read_dbf(spark, landing.municipality_files(spark, sf_dir), fields, "UTF-8", exact_fields=True).drop("_arquivo")


def dbf_from_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return municipalities.read_attributes(spark, landing.municipality_archives(spark, sf_dir))


def dbf_to_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = [Field(name, kind) for name, kind, _ in landing.ORDER_FIELDS]
    staged = admissions.stage_dbf(spark, landing.whole_admission_files(spark, sf_dir), fields)
    return staged.drop("_arquivo").withColumn("CHAVE", F.col("CHAVE").cast("long"))


def landing_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of 1995 to 2001 for which no file has landed, and the files of each class."""
    ledger = materialize(monthly_ledger(landed_files(spark, landing.admission_files(spark, sf_dir))), "ledger")
    found = ledger.filter(F.col("classe") == FITS)
    classes = {"arquivos": None, "fora_da_pasta": WRONG_FOLDER, "nome_desconhecido": UNKNOWN_NAME, "repetidos": SECOND_FILE}
    counts = ledger.agg(
        *(F.count_if(F.lit(True) if c is None else F.col("classe") == c).alias(name) for name, c in classes.items())
    )
    expected = month_spine(spark, date(1995, 1, 1), date(2001, 12, 1)).withColumn(
        "periodo", F.date_format("mes_inicial", "yyyy-MM")
    )
    report = completeness(expected, found, ["ano", "mes"], "periodo")
    # One row each.
    return report.withColumn("ausentes", F.array_join("ausentes", ",")).join(counts)


def landing_completeness_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years of 1992 to 1999 for which no archive has landed."""
    found = landed_years(landed_files(spark, landing.yearly_files(spark, sf_dir)))
    expected = tables.local_rows(spark, [(y, str(y)) for y in range(1992, 2000)], "ano int, periodo string")
    return completeness(expected, found, ["ano"], "periodo").withColumn(
        "ausentes", F.array_join("ausentes", ",")
    )


_MUNICIPALITY_SQL = """
select concat('35', lpad(cast(c_custkey as varchar), 12, '0')) as CD_MUN,
       concat(' Município é ', c_name) as NM_MUN, 'SP' as SIGLA_UF,
       case when c_custkey % 5 <> 0 then cast(floor(abs(c_acctbal)) as bigint) + 0.25::double end
         as AREA_KM2
from customer where c_custkey % 11 <> 0
"""

_STATION_SQL = """
concat('A-', event_type) as codigo_estacao, concat('ESTAÇÃO ', upper(event_type)) as estacao,
case when event_type = 'click' then 'MG' else 'SP' end as uf,
cast(concat('-2', cast(length(event_type) as varchar), '.5') as double) as latitude,
cast(-46.62 as double) as longitude,
case when event_type <> 'view' then cast(785.64 as double) end as altitude
"""

_BODY_SQL = """
strftime(try_strptime(concat(data, ' ', substring(hora_utc, 1, 4)), '%Y/%m/%d %H%M'),
         '%Y-%m-%d %H:%M:%S') as data_hora_utc,
try_cast(replace(precipitacao_mm, ',', '.') as double) as precipitacao_mm,
try_cast(replace(pressao_max_mb, ',', '.') as double) as pressao_max_mb
"""

ENTRIES = {
    "sink_parquet": Entry(sink_parquet, "select * from supplier"),
    "scan_partitioned": Entry(
        scan_partitioned,
        """select event_id, value, case when event_type = 'click' then '000' else event_type end
             as codigo_estacao
           from events""",
    ),
    "scan_recursive": Entry(
        scan_recursive,
        """select o_orderkey, cast(year(o_orderdate) as integer) as ano,
               cast(month(o_orderdate) as integer) as mes from orders""",
    ),
    "sink_period_overwrite": Entry(
        sink_period_overwrite,
        f"""select o_orderkey, case when mes = 3 then 'corrigido' else DIAG_PRINC end as DIAG_PRINC,
               ano, mes from ({ORDERS_SQL})""",
    ),
    "scan_delimited": Entry(
        scan_delimited,
        f"""select event_type, event_id, data, nullif(hora_utc, '') as hora_utc, precipitacao_mm,
               nullif(pressao_max_mb, '') as pressao_max_mb, pressao_min_mb,
               case when event_id % 3 = 0 then '7' end as vento_velocidade_ms
            from ({EVENTS_SQL}) where data <> 'x'""",
    ),
    "file_preamble": Entry(
        file_preamble,
        f"""select event_type, concat('A-', event_type) as codigo_estacao,
               concat('ESTAÇÃO ', upper(event_type)) as estacao,
               case when event_type = 'click' then 'MG' else 'SP' end as uf, 'SE' as regiao,
               concat('-2', cast(length(event_type) as varchar), ',5') as latitude,
               '-46,62' as longitude,
               case when event_type = 'view' then '' else '785,64' end as altitude
            from (select distinct event_type, event_id // {landing.ROWS_PER_FILE} from events)""",
    ),
    "attach_metadata": Entry(
        attach_metadata,
        f"""select event_id, 2024 as ano, {_STATION_SQL}, 'SE' as regiao, {_BODY_SQL},
               cast(-9999 as double) as pressao_min_mb
            from ({EVENTS_SQL}) where data <> 'x'""",
    ),
    "archive_members": Entry(
        archive_members,
        f"""select concat('B', cast(b as varchar)) as "_arquivo", 'members ending in .csv' as "check",
               n as observed, cast(40 as bigint) as expected, n = 40 as passed
            from (select event_id // {landing.ROWS_PER_FILE} as b, count(distinct event_type) as n
                  from events group by 1)""",
    ),
    "archive_extract": Entry(
        archive_extract,
        f"""select event_id, {_STATION_SQL}, {_BODY_SQL},
               case when event_id % 3 = 0 then cast(7 as double) end as vento_velocidade_ms
            from ({EVENTS_SQL}) where data <> 'x'""",
    ),
    "dbf_table": Entry(dbf_table, _MUNICIPALITY_SQL),
    "dbf_from_archive": Entry(dbf_from_archive, _MUNICIPALITY_SQL),
    "dbf_to_parquet": Entry(
        dbf_to_parquet,
        f"""select o_orderkey as CHAVE, rtrim(MUNIC_RES) as MUNIC_RES, DT_INTER, DT_SAIDA, NASC,
               rtrim(DIAG_PRINC) as DIAG_PRINC
            from ({ORDERS_SQL}) where o_orderkey % 101 <> 0""",
    ),
    "landing_completeness_years": Entry(
        landing_completeness_years,
        """with e as (select unnest(generate_series(1992, 1999)) as y),
                f as (select distinct year(o_orderdate) as y from orders
                      where year(o_orderdate) <> 1996)
           select count(*) as total_esperado, count(f.y) as total_encontrado,
                  count(*) - count(f.y) as total_ausente,
                  coalesce(string_agg(cast(e.y as varchar), ',' order by e.y)
                           filter (where f.y is null), '') as ausentes,
                  count(*) = count(f.y) as completo
           from e left join f on e.y = f.y""",
    ),
    "landing_completeness": Entry(
        landing_completeness,
        f"""with e as (select strftime(x, '%Y-%m') as p from (select unnest(generate_series(
                        timestamp '1995-01-01', timestamp '2001-12-01', interval 1 month)) as x)),
                b as (select distinct strftime(o_orderdate, '%Y-%m') as p, o_orderkey // {landing.ROWS_PER_FILE} as b
                      from orders where month(o_orderdate) <> 5),
                f as (select distinct p from b),
                c as (select count(*) as n, count_if(p = '1997-03') as w, count_if(p = '1998-04') as u,
                      count_if(p = '1999-06') as s from b)
           select count(*) as total_esperado, count(f.p) as total_encontrado,
                  count(*) - count(f.p) as total_ausente,
                  string_agg(e.p, ',' order by e.p) filter (where f.p is null) as ausentes,
                  count(*) = count(f.p) as completo, cast(any_value(n + w + u + s) as bigint) as arquivos,
                  cast(any_value(w) as bigint) as fora_da_pasta, cast(any_value(u) as bigint) as nome_desconhecido,
                  cast(any_value(s) as bigint) as repetidos
           from e left join f on e.p = f.p cross join c""",
    ),
}
