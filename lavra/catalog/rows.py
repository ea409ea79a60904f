"""Scans, projections, filters and scalar functions, row by row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.catalog import Entry
from lavra.catalog.dirty import EVENTS_SQL, ORDERS_SQL, events, orders, table
from lavra.functions.moments import hour_code, hourly_timestamp
from lavra.functions.text import code_prefix
from lavra.operators import clean
from lavra.operators.sets import difference, union_by_name
from lavra.sources.tables import local_rows, period_from_path

DAY = "yyyy-MM-dd"


def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")


def project_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select("s_name", "s_acctbal", "s_suppkey")


def null_if_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = orders(spark, sf_dir).select("o_orderkey", "MUNIC_RES", "DT_INTER", "DIAG_PRINC")
    return clean.blanks_to_null(texts)


def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["DT_INTER", "DT_SAIDA", "NASC"]
    parsed = clean.parse_dates(orders(spark, sf_dir).select("o_orderkey", *names), names)
    return clean.map_columns(parsed, names, lambda day: F.date_format(day, DAY))


def decimal_comma(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.parse_decimals(
        orders(spark, sf_dir).select("o_orderkey", "VAL_TOT"), ["VAL_TOT"]
    )


def hour_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.map_columns(
        events(spark, sf_dir).select("event_id", "hora_utc"), ["hora_utc"], hour_code
    )


def build_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    moment = hourly_timestamp(F.col("data"), hour_code(F.col("hora_utc")))
    return events(spark, sf_dir).select(
        "event_id", F.date_format(moment, "yyyy-MM-dd HH:mm:ss").alias("data_hora_utc")
    )


def trim_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("p_name"),
        F.concat("p_brand", F.lit("\t ")).alias("p_brand"),
    )
    return clean.trim_columns(padded, ["p_name", "p_brand"])


def prefix_of_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.lpad(F.col("c_custkey").cast("string"), 7, "0")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", code_prefix(code).alias("CD_MUN_6")
    )


def period_of_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 5 == 0, "/x/y")
        .otherwise(
            F.concat(
                F.lit("/sih/"), F.date_format("o_orderdate", "yyyy/MM"), F.lit("/part.parquet")
            )
        )
        .alias("caminho"),
    )
    return period_from_path(paths, "caminho").select(
        "o_orderkey", F.col("_ano").alias("ano"), F.col("_mes").alias("mes")
    )


def filter_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = events(spark, sf_dir).select("event_id", "data")
    return clean.keep_matching(lines, "data", r"^\d{4}/\d{2}/\d{2}$")


def filter_equals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .filter(F.col("c_mktsegment") == "BUILDING")
        .select("c_custkey", "c_name")
    )


def filter_not_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = clean.blanks_to_null(orders(spark, sf_dir).select("o_orderkey", "DIAG_PRINC"))
    return cleaned.filter(F.col("DIAG_PRINC") != "1-URGENT")


def filter_not_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = clean.blanks_to_null(orders(spark, sf_dir).select("o_orderkey", "MUNIC_RES"))
    return cleaned.filter(~F.col("MUNIC_RES").startswith("00000000000"))


def rows_of_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = local_rows(
        spark,
        [("1-URGENT", 1, 0.5), ("2-HIGH", 2, 1.0), ("5-LOW", 5, None)],
        "o_orderpriority string, posto int, peso double",
    )
    return (
        table(spark, sf_dir, "orders")
        .groupBy("o_orderpriority")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(F.broadcast(ranks), "o_orderpriority", "left")
    )


def union_of_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("nome"), F.col("c_acctbal").alias("saldo")
    )
    firms = table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("saldo"), F.col("s_name").alias("nome")
    )
    return union_by_name([people, firms, people])


def set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("chave"))
    found = (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_orderpriority") == "1-URGENT")
        .select(F.col("o_custkey").alias("chave"))
    )
    return difference(expected, found, "chave")


ENTRIES = {
    "scan_parquet": Entry(
        scan_parquet, "select o_orderkey, o_custkey, o_totalprice from orders"
    ),
    "project_order": Entry(project_order, "select s_name, s_acctbal, s_suppkey from supplier"),
    "null_if_blank": Entry(
        null_if_blank,
        f"""select o_orderkey,
               case when trim(MUNIC_RES) = '' then null else MUNIC_RES end as MUNIC_RES,
               case when trim(DT_INTER) = '' then null else DT_INTER end as DT_INTER,
               case when trim(DIAG_PRINC) = '' then null else DIAG_PRINC end as DIAG_PRINC
            from ({ORDERS_SQL})""",
    ),
    "parse_dates": Entry(
        parse_dates,
        f"""select o_orderkey,
               strftime(try_strptime(DT_INTER, '%Y%m%d'), '%Y-%m-%d') as DT_INTER,
               strftime(try_strptime(DT_SAIDA, '%Y%m%d'), '%Y-%m-%d') as DT_SAIDA,
               strftime(try_strptime(NASC, '%Y%m%d'), '%Y-%m-%d') as NASC
            from ({ORDERS_SQL})""",
    ),
    "decimal_comma": Entry(
        decimal_comma,
        f"""select o_orderkey,
               try_cast(regexp_replace(trim(VAL_TOT), ',', '.', 'g') as double) as VAL_TOT
            from ({ORDERS_SQL})""",
    ),
    "hour_normalize": Entry(
        hour_normalize,
        f"select event_id, substring(trim(hora_utc), 1, 4) as hora_utc from ({EVENTS_SQL})",
    ),
    "build_timestamp": Entry(
        build_timestamp,
        f"""select event_id,
               strftime(try_strptime(concat(data, ' ', substring(trim(hora_utc), 1, 4)),
                                     '%Y/%m/%d %H%M'), '%Y-%m-%d %H:%M:%S') as data_hora_utc
            from ({EVENTS_SQL})""",
    ),
    "trim_codes": Entry(
        trim_codes,
        "select p_partkey, p_name, concat(p_brand, chr(9)) as p_brand from part",
    ),
    "code_prefix": Entry(
        prefix_of_code,
        """select c_custkey, substring(lpad(cast(c_custkey as varchar), 7, '0'), 1, 6) as CD_MUN_6
           from customer""",
    ),
    "period_from_path": Entry(
        period_of_path,
        """select o_orderkey,
               case when o_orderkey % 5 <> 0 then cast(year(o_orderdate) as integer) end as ano,
               case when o_orderkey % 5 <> 0 then cast(month(o_orderdate) as integer) end as mes
           from orders""",
    ),
    "filter_regex": Entry(
        filter_regex,
        f"""select event_id, data from ({EVENTS_SQL})
            where regexp_full_match(data, '[0-9]{{4}}/[0-9]{{2}}/[0-9]{{2}}')""",
    ),
    "filter_equals": Entry(
        filter_equals, "select c_custkey, c_name from customer where c_mktsegment = 'BUILDING'"
    ),
    "filter_not_equal": Entry(
        filter_not_equal,
        f"""select o_orderkey, DIAG_PRINC from ({ORDERS_SQL})
            where trim(DIAG_PRINC) <> '' and DIAG_PRINC <> '1-URGENT'""",
    ),
    "filter_not_prefix": Entry(
        filter_not_prefix,
        f"""select o_orderkey, MUNIC_RES from ({ORDERS_SQL})
            where trim(MUNIC_RES) <> '' and not starts_with(MUNIC_RES, '00000000000')""",
    ),
    "local_rows": Entry(
        rows_of_priority,
        """select o_orderpriority, count(*) as n,
               case o_orderpriority when '1-URGENT' then 1 when '2-HIGH' then 2
                    when '5-LOW' then 5 end as posto,
               case o_orderpriority when '1-URGENT' then cast(0.5 as double)
                    when '2-HIGH' then cast(1 as double) end as peso
           from orders group by o_orderpriority""",
    ),
    "union_by_name": Entry(
        union_of_segments,
        """select c_name as nome, c_acctbal as saldo from customer
           union all select s_name, s_acctbal from supplier
           union all select c_name, c_acctbal from customer""",
    ),
    "set_difference": Entry(
        set_difference,
        """select c_custkey as chave from customer
           except select o_custkey from orders where o_orderpriority = '1-URGENT'""",
    ),
}
