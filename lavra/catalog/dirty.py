"""Tables as they would land: text with blanks, bad dates and decimal commas.

The given tables have no NULL and no bad value, so every cleaning query derives
such columns by a rule, here for Spark and beside it for SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.sources.tables import read_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as an admission record of raw text."""
    key = F.col("o_orderkey")
    digits = F.date_format("o_orderdate", "yyyyMMdd")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(key % 13 == 0, "  ")
        .otherwise(F.lpad(F.col("o_custkey").cast("string"), 12, "0"))
        .alias("MUNIC_RES"),
        F.when(key % 11 == 0, "20230231").when(key % 17 == 0, "").otherwise(digits).alias("DT_INTER"),
        F.when(key % 19 == 0, "x").otherwise(digits).alias("DT_SAIDA"),
        F.lit("19800229").alias("NASC"),
        F.when(key % 7 == 0, "  ").otherwise(F.col("o_orderpriority")).alias("DIAG_PRINC"),
        F.when(key % 9 == 0, "1,2,3")
        .when(key % 23 == 0, ",8")
        .when(key % 29 == 0, "-9999")
        .otherwise(F.concat(key.cast("string"), F.lit(",25")))
        .alias("VAL_TOT"),
        F.year("o_orderdate").alias("ano"),
        F.month("o_orderdate").alias("mes"),
    )


ORDERS_SQL = """
select o_orderkey,
       case when o_orderkey % 13 = 0 then '  '
            else lpad(cast(o_custkey as varchar), 12, '0') end as MUNIC_RES,
       case when o_orderkey % 11 = 0 then '20230231' when o_orderkey % 17 = 0 then ''
            else strftime(o_orderdate, '%Y%m%d') end as DT_INTER,
       case when o_orderkey % 19 = 0 then 'x' else strftime(o_orderdate, '%Y%m%d') end as DT_SAIDA,
       '19800229' as NASC,
       case when o_orderkey % 7 = 0 then '  ' else o_orderpriority end as DIAG_PRINC,
       case when o_orderkey % 9 = 0 then '1,2,3' when o_orderkey % 23 = 0 then ',8'
            when o_orderkey % 29 = 0 then '-9999'
            else concat(cast(o_orderkey as varchar), ',25') end as VAL_TOT,
       cast(year(o_orderdate) as integer) as ano,
       cast(month(o_orderdate) as integer) as mes
from orders
"""


def dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of one segment as municipalities, so that some orders match none."""
    customer = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    return customer.select(
        F.lpad(F.col("c_custkey").cast("string"), 12, "0").alias("CD_MUN_6"),
        F.col("c_name").alias("NM_MUN"),
        F.concat(F.lit("U"), F.col("c_nationkey").cast("string")).alias("SIGLA_UF"),
        F.col("c_acctbal").alias("AREA_KM2"),
    )


DIMENSION_SQL = """
select lpad(cast(c_custkey as varchar), 12, '0') as CD_MUN_6, c_name as NM_MUN,
       concat('U', cast(c_nationkey as varchar)) as SIGLA_UF, c_acctbal as AREA_KM2
from customer where c_mktsegment = 'BUILDING'
"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a weather observation of raw text."""
    key = F.col("event_id")
    cents = F.floor(F.col("value") * 100).cast("long")
    return table(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        F.when(key % 50 == 0, "x").otherwise(F.date_format("ts", "yyyy/MM/dd")).alias("data"),
        F.when(key % 10 == 0, "")
        .otherwise(F.concat(F.date_format("ts", "HH"), F.lit("00 UTC")))
        .alias("hora_utc"),
        F.concat(
            F.floor(cents / 100).cast("string"),
            F.lit(","),
            F.lpad((cents % 100).cast("string"), 2, "0"),
        ).alias("precipitacao_mm"),
        F.when(key % 9 == 0, "1,2,3").when(key % 7 == 0, "").otherwise(",8").alias("pressao_max_mb"),
        F.lit("-9999").alias("pressao_min_mb"),
    )


EVENTS_SQL = """
select event_id, event_type,
       case when event_id % 50 = 0 then 'x' else strftime(ts, '%Y/%m/%d') end as data,
       case when event_id % 10 = 0 then '' else concat(strftime(ts, '%H'), '00 UTC') end as hora_utc,
       concat(cast(cast(floor(value * 100) as bigint) // 100 as varchar), ',',
              lpad(cast(cast(floor(value * 100) as bigint) % 100 as varchar), 2, '0'))
         as precipitacao_mm,
       case when event_id % 9 = 0 then '1,2,3' when event_id % 7 = 0 then '' else ',8' end
         as pressao_max_mb,
       '-9999' as pressao_min_mb
from events
"""
