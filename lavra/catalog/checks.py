"""Each kind of quality check, over whole tables, as a check frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.catalog import Entry
from lavra.catalog.dirty import ORDERS_SQL, orders, table
from lavra.functions.moments import hours_in_year
from lavra.operators import quality as Q
from lavra.operators.clean import blanks_to_null, parse_dates

LINEITEM_COLUMNS = [
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
]


def _frame(df: DataFrame, *checks: Q.Check) -> DataFrame:
    return Q.evaluate(df, checks).drop("position")


def check_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frame(table(spark, sf_dir, "customer"), Q.row_count("customers", 645))


def check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frame(
        table(spark, sf_dir, "customer"),
        Q.unique_count("nations", ["c_nationkey"], 25),
        Q.unique_count("names", ["c_name"], 645),
    )


def check_not_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frame(
        orders(spark, sf_dir),
        Q.not_blank("without municipality", "MUNIC_RES"),
        Q.not_blank("without birth date", "NASC"),
        Q.not_blank("without diagnosis", "DIAG_PRINC"),
    )


def check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = orders(spark, sf_dir).select("MUNIC_RES", "DT_INTER", "NASC")
    cleaned = parse_dates(blanks_to_null(raw), ["DT_INTER", "NASC"])
    return _frame(
        cleaned,
        Q.not_null("without municipality", "MUNIC_RES"),
        Q.not_null("without birth date", "NASC"),
        Q.reported_nulls("without admission date", "DT_INTER"),
    )


def check_allowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frame(
        table(spark, sf_dir, "orders"),
        Q.only_value("status other than O", "o_orderstatus", "O"),
        Q.value_set("statuses", "o_orderstatus", ["F", "O", "P"]),
        Q.value_set("two statuses and one that is absent", "o_orderstatus", ["F", "O", "?"]),
    )


def check_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frame(
        table(spark, sf_dir, "customer"),
        Q.only_prefix("name without Customer#", "c_name", "Customer#"),
        Q.only_prefix("name without Customer#00000000", "c_name", "Customer#00000000"),
    )


def check_no_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frame(
        table(spark, sf_dir, "lineitem"),
        Q.no_duplicates("duplicate order and line", ["l_orderkey", "l_linenumber"]),
    )


def check_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return _frame(
        lines,
        Q.column_count("columns", lines, 116),
        Q.column_names("column list", lines, LINEITEM_COLUMNS),
    )


def check_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frame(orders(spark, sf_dir), Q.unique_count("periods", ["ano", "mes"], 80))


def check_max_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frame(
        table(spark, sf_dir, "orders"),
        Q.max_distinct("customers", ["o_custkey"], 645),
        Q.max_distinct("priorities", ["o_orderpriority"], 645),
    )


def check_hourly_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per year: hourly rows of five stations, and the stations that are incomplete."""
    hourly = (
        table(spark, sf_dir, "events")
        .groupBy("event_type", F.date_trunc("hour", "ts").alias("hora"))
        .agg(F.year(F.first("ts")).alias("ano"))
    )
    hours = hours_in_year(F.col("ano"))
    checks = [
        Q.row_count("rows", hours * 5),
        Q.group_size("stations with an unexpected row count", ["event_type"], hours),
    ]
    return Q.evaluate(hourly, checks, ["ano"]).drop("position")


def _line(name: str, observed: str, expected: int | None, passed: str, source: str) -> str:
    limit = "null" if expected is None else expected
    return (
        f"""select '{name}' as "check", cast({observed} as bigint) as observed, """
        f"""cast({limit} as bigint) as expected, ({observed}) {passed} as passed from {source}"""
    )


def _lines(*lines: str) -> str:
    return "\nunion all\n".join(lines)


_ORDERS = f"({ORDERS_SQL})"

ENTRIES = {
    "check_row_count": Entry(
        check_row_count, _line("customers", "count(*)", 645, "= 645", "customer")
    ),
    "check_unique": Entry(
        check_unique,
        _lines(
            _line("nations", "count(distinct c_nationkey)", 25, "= 25", "customer"),
            _line("names", "count(distinct c_name)", 645, "= 645", "customer"),
        ),
    ),
    "check_not_blank": Entry(
        check_not_blank,
        _lines(
            _line("without municipality", "count_if(trim(MUNIC_RES) = '')", 0, "= 0", _ORDERS),
            _line("without birth date", "count_if(trim(NASC) = '')", 0, "= 0", _ORDERS),
            _line("without diagnosis", "count_if(trim(DIAG_PRINC) = '')", 0, "= 0", _ORDERS),
        ),
    ),
    "check_not_null": Entry(
        check_not_null,
        _lines(
            _line("without municipality", "count_if(trim(MUNIC_RES) = '')", 0, "= 0", _ORDERS),
            _line("without birth date", "count_if(NASC is null)", 0, "= 0", _ORDERS),
            _line(
                "without admission date",
                "count_if(try_strptime(DT_INTER, '%Y%m%d') is null)",
                None,
                ">= 0",
                _ORDERS,
            ),
        ),
    ),
    "check_allowed": Entry(
        check_allowed,
        _lines(
            _line("status other than O", "count_if(o_orderstatus <> 'O')", 0, "= 0", "orders"),
            _line(
                "statuses",
                """count_if(o_orderstatus not in ('F', 'O', 'P'))
                   + 3 - count(distinct case when o_orderstatus in ('F', 'O', 'P')
                                             then o_orderstatus end)""",
                0,
                "= 0",
                "orders",
            ),
            _line(
                "two statuses and one that is absent",
                """count_if(o_orderstatus not in ('F', 'O', '?'))
                   + 3 - count(distinct case when o_orderstatus in ('F', 'O', '?')
                                             then o_orderstatus end)""",
                0,
                "= 0",
                "orders",
            ),
        ),
    ),
    "check_prefix": Entry(
        check_prefix,
        _lines(
            _line(
                "name without Customer#",
                "count_if(not starts_with(c_name, 'Customer#'))",
                0,
                "= 0",
                "customer",
            ),
            _line(
                "name without Customer#00000000",
                "count_if(not starts_with(c_name, 'Customer#00000000'))",
                0,
                "= 0",
                "customer",
            ),
        ),
    ),
    "check_no_duplicates": Entry(
        check_no_duplicates,
        _line(
            "duplicate order and line",
            "count(*)",
            0,
            "= 0",
            """(select l_orderkey, l_linenumber from lineitem
                group by all having count(*) > 1)""",
        ),
    ),
    "check_schema": Entry(
        check_schema,
        """with c as (select count(*) as n, string_agg(column_name, ' ') as listed
             from (select column_name from (describe lineitem)))
           select 'columns' as "check", n as observed, cast(116 as bigint) as expected,
                  n = 116 as passed from c
           union all
           select 'column list', case when listed = '"""
        + " ".join(LINEITEM_COLUMNS)
        + """' then 0 else 1 end, 0, listed = '"""
        + " ".join(LINEITEM_COLUMNS)
        + "' from c",
    ),
    "check_periods": Entry(
        check_periods, _line("periods", "count(*)", 80, "= 80", f"(select distinct ano, mes from {_ORDERS})")
    ),
    "check_max_distinct": Entry(
        check_max_distinct,
        _lines(
            _line("customers", "count(distinct o_custkey)", 645, "<= 645", "orders"),
            _line("priorities", "count(distinct o_orderpriority)", 645, "<= 645", "orders"),
        ),
    ),
    "check_hourly_complete": Entry(
        check_hourly_complete,
        """with h as (select distinct event_type, date_trunc('hour', ts) as hora,
                             cast(year(ts) as integer) as ano from events),
                y as (select ano, count(*) as n,
                             cast(dayofyear(make_date(ano, 12, 31)) * 24 as bigint) as hours
                      from h group by ano),
                s as (select ano, event_type, count(*) as n from h group by all)
           select ano, 'rows' as "check", n as observed, hours * 5 as expected,
                  n = hours * 5 as passed from y
           union all
           select y.ano, 'stations with an unexpected row count',
                  cast(count_if(s.n <> hours) as bigint), 0,
                  count_if(s.n <> hours) = 0
           from y join s on y.ano = s.ano group by y.ano""",
    ),
}
