"""Aggregations, sorts and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.catalog import Entry
from lavra.catalog.dirty import EVENTS_SQL, ORDERS_SQL, events, orders, table
from lavra.operators import aggregates as A
from lavra.operators.clean import blanks_to_null, parse_dates


def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("n"))


def distinct_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = blanks_to_null(orders(spark, sf_dir).select("DIAG_PRINC", "MUNIC_RES"))
    return cleaned.agg(
        A.distinct_count("DIAG_PRINC").alias("diagnosticos"),
        A.distinct_count("MUNIC_RES").alias("municipios"),
        A.distinct_count("DIAG_PRINC", "MUNIC_RES").alias("pares"),
    )


def count_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.group_counts(table(spark, sf_dir, "events"), "event_type").orderBy("event_type")


def count_by_key_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.group_counts(table(spark, sf_dir, "events"), "event_type").orderBy(
        F.desc("n"), "event_type"
    )


def count_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.group_counts(orders(spark, sf_dir), "ano", "mes").orderBy("ano", "mes")


def min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = A.value_range(table(spark, sf_dir, "events"), "ts", "value")
    return seen.withColumns(
        {
            name: F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS") for name in ("ts_min", "ts_max")
        }
    )


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.duplicate_groups(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


def duplicate_excess(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.duplicate_excess(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


def group_count_unexpected(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = table(spark, sf_dir, "events").select("event_type", F.to_date("ts").alias("dia"))
    return A.unexpected_groups(daily, ["event_type", "dia"], 67)


def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = orders(spark, sf_dir).select("MUNIC_RES", "DT_INTER", "DT_SAIDA", "DIAG_PRINC")
    cleaned = parse_dates(blanks_to_null(raw), ["DT_INTER", "DT_SAIDA"])
    return A.null_counts(cleaned, cleaned.columns)


def null_or_blank_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = events(spark, sf_dir).select("data", "hora_utc", "pressao_max_mb")
    return A.blank_counts(raw, raw.columns)


def distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = blanks_to_null(orders(spark, sf_dir).select("DIAG_PRINC"))
    return A.distinct_values(cleaned, "DIAG_PRINC")


def distinct_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.distinct_values(orders(spark, sf_dir), "ano", "mes")


def vertex_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    vertices = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("CD_MUN"),
        (F.col("value") * 2 - 50).alias("x"),
        F.col("value").alias("y"),
    )
    return A.vertex_mean(vertices, "CD_MUN", "x", "y").select(
        "CD_MUN",
        F.round("latitude", 9).alias("latitude"),
        F.round("longitude", 9).alias("longitude"),
    )


def sample_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_mktsegment", "c_custkey", "c_name")
    return A.first_sorted(rows, 10, "c_mktsegment", "c_custkey")


def sample_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.first_any(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), 10)


def sample_any_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which rows a sample holds is open; it must hold ten, all of them from the table."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    sampled = A.first_any(rows, 10)
    found = sampled.join(rows.withColumn("there", F.lit(1)), ["c_custkey", "c_name"], "left")
    return found.agg(F.count(F.lit(1)).alias("sampled"), F.count("there").alias("found"))


ENTRIES = {
    "row_count": Entry(row_count, "select count(*) as n from lineitem"),
    "distinct_count": Entry(
        distinct_count,
        f"""with c as (select nullif(trim(DIAG_PRINC), '') as d, nullif(trim(MUNIC_RES), '') as m
                       from ({ORDERS_SQL}))
            select (select count(*) from (select distinct d from c)) as diagnosticos,
                   (select count(*) from (select distinct m from c)) as municipios,
                   (select count(*) from (select distinct d, m from c)) as pares""",
    ),
    "count_by_key": Entry(
        count_by_key, "select event_type, count(*) as n from events group by event_type"
    ),
    "count_by_key_desc": Entry(
        count_by_key_desc, "select event_type, count(*) as n from events group by event_type"
    ),
    "count_by_period": Entry(
        count_by_period, f"select ano, mes, count(*) as n from ({ORDERS_SQL}) group by ano, mes"
    ),
    "min_max": Entry(
        min_max,
        """select strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') as ts_min,
               strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') as ts_max,
               min(value) as value_min, max(value) as value_max from events""",
    ),
    "duplicate_keys": Entry(
        duplicate_keys,
        """select count(*) as n from (select l_orderkey, l_linenumber from lineitem
           group by all having count(*) > 1)""",
    ),
    "duplicate_excess": Entry(
        duplicate_excess,
        """select (select count(*) from lineitem) - count(*) as n
           from (select distinct l_orderkey, l_linenumber from lineitem)""",
    ),
    "group_count_unexpected": Entry(
        group_count_unexpected,
        """select count(*) as n from (select event_type, cast(ts as date) as dia from events
           group by all having count(*) <> 67)""",
    ),
    "null_counts": Entry(
        null_counts,
        f"""select cast(count_if(trim(MUNIC_RES) = '') as bigint) as MUNIC_RES,
               cast(count_if(try_strptime(DT_INTER, '%Y%m%d') is null) as bigint) as DT_INTER,
               cast(count_if(try_strptime(DT_SAIDA, '%Y%m%d') is null) as bigint) as DT_SAIDA,
               cast(count_if(trim(DIAG_PRINC) = '') as bigint) as DIAG_PRINC from ({ORDERS_SQL})""",
    ),
    "null_or_blank_counts": Entry(
        null_or_blank_counts,
        f"""select cast(count_if(trim(data) = '') as bigint) as data,
               cast(count_if(trim(hora_utc) = '') as bigint) as hora_utc,
               cast(count_if(trim(pressao_max_mb) = '') as bigint) as pressao_max_mb from ({EVENTS_SQL})""",
    ),
    "distinct_values": Entry(
        distinct_values,
        f"select distinct nullif(trim(DIAG_PRINC), '') as DIAG_PRINC from ({ORDERS_SQL})",
    ),
    "distinct_periods": Entry(
        distinct_periods, f"select distinct ano, mes from ({ORDERS_SQL})"
    ),
    "vertex_centroid": Entry(
        vertex_centroid,
        """select user_id as CD_MUN, round(avg(value), 9) as latitude,
               round(avg(value * 2 - 50), 9) as longitude from events group by user_id""",
    ),
    "sample_top_n": Entry(
        sample_top_n,
        """select c_mktsegment, c_custkey, c_name from customer
           order by c_mktsegment, c_custkey limit 10""",
    ),
    "sample_any": Entry(sample_any),
    "sample_any_found": Entry(
        sample_any_found,
        "select least(count(*), 10) as sampled, least(count(*), 10) as found from customer",
    ),
}
