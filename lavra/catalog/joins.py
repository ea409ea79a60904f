"""Joins of a fact table to a dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.catalog import Entry
from lavra.catalog.dirty import DIMENSION_SQL, ORDERS_SQL, dimension, orders, table
from lavra.operators import quality as Q
from lavra.operators.clean import blanks_to_null
from lavra.operators.lookup import keep_matched, lookup_left
from lavra.plans import admissions

COLUMNS = ["NM_MUN", "SIGLA_UF", "AREA_KM2"]


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blanks_to_null(orders(spark, sf_dir).select("o_orderkey", "MUNIC_RES", "ano", "mes"))


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup_left(
        _fact(spark, sf_dir), dimension(spark, sf_dir), "MUNIC_RES", "CD_MUN_6", COLUMNS
    )


def join_left_equi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(spark, sf_dir).drop("ano", "mes")


def join_left_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same join on the path taken when the dimension is too large to broadcast."""
    return lookup_left(
        _fact(spark, sf_dir),
        dimension(spark, sf_dir),
        "MUNIC_RES",
        "CD_MUN_6",
        COLUMNS,
        broadcast_bytes=0,
    ).drop("ano", "mes")


def join_left_using(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").filter(F.col("n_regionkey") < 3)
    people = table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "n_nationkey")
    return people.join(nation.select("n_nationkey", "n_name"), on="n_nationkey", how="left").select(
        "c_custkey", "n_nationkey", "n_name"
    )


def join_left_matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        keep_matched(_joined(spark, sf_dir), "NM_MUN")
        .groupBy("ano", "mes")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def join_match_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return admissions.counts(_fact(spark, sf_dir), dimension(spark, sf_dir))


def join_cardinality_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The guard over a dimension in which every tenth key occurs twice."""
    once = dimension(spark, sf_dir)
    doubled = once.unionByName(once.filter(F.col("CD_MUN_6").endswith("0")))
    counted = admissions.counts(_fact(spark, sf_dir), doubled)
    return Q.evaluate(counted, admissions.conservation_checks()).drop("position")


_FACT_SQL = f"""select o_orderkey, ano, mes,
    case when trim(MUNIC_RES) <> '' then MUNIC_RES end as MUNIC_RES from ({ORDERS_SQL})"""
_JOIN_SQL = f"({_FACT_SQL}) f left join ({DIMENSION_SQL}) d on f.MUNIC_RES = d.CD_MUN_6"
_EQUI_SQL = f"select o_orderkey, MUNIC_RES, NM_MUN, SIGLA_UF, AREA_KM2 from {_JOIN_SQL}"

ENTRIES = {
    "join_left_equi": Entry(join_left_equi, _EQUI_SQL),
    "join_left_shuffled": Entry(join_left_shuffled, _EQUI_SQL),
    "join_left_using": Entry(
        join_left_using,
        """select c_custkey, c_nationkey as n_nationkey, n_name from customer
           left join (select * from nation where n_regionkey < 3) n on c_nationkey = n.n_nationkey""",
    ),
    "join_left_matched": Entry(
        join_left_matched,
        f"select ano, mes, count(*) as n from {_JOIN_SQL} where NM_MUN is not null group by ano, mes",
    ),
    "join_match_counts": Entry(
        join_match_counts,
        f"""select (select count(*) from orders) as total, count(*) as after_join,
               count(NM_MUN) as matched, count(*) - count(NM_MUN) as unmatched from {_JOIN_SQL}""",
    ),
    "join_cardinality_guard": Entry(
        join_cardinality_guard,
        f"""with d as ({DIMENSION_SQL}),
                 dd as (select * from d union all select * from d where ends_with(CD_MUN_6, '0')),
                 j as (select count(*) - (select count(*) from orders) as added
                       from ({_FACT_SQL}) f left join dd on f.MUNIC_RES = dd.CD_MUN_6)
            select 'rows added by the join' as "check", added as observed,
                   cast(0 as bigint) as expected, added = 0 as passed from j
            union all
            select 'rows neither matched nor unmatched', -added, 0, added = 0 from j""",
    ),
}
