"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from lavra.catalog import entries
from tests.oracle import connect, difference

SF_DIR = "/root/testdata/sf0.001"
QUERIES = ["entry", *sorted(entries())]


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, duck, name):
    if name == "entry":
        assert entry.entry(spark).count() > 0
        return
    df = entry.queries()[name](spark, SF_DIR)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert difference(df, duck, sql) is None


def test_only_the_unordered_sample_lacks_sql():
    assert {name for name, query in entries().items() if not query.sql} == {"sample_any"}


@pytest.mark.parametrize(
    ("name", "wanted", "unwanted"),
    [
        ("filter_equals", ["PushedFilters: [IsNotNull(c_mktsegment), EqualTo"], ["Exchange"]),
        ("scan_parquet", ["ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>"], ["Exchange"]),
        ("null_if_blank", [], ["Exchange", "Python"]),
        ("parse_dates", [], ["Exchange", "Python"]),
        ("decimal_comma", [], ["Exchange", "Python"]),
        ("build_timestamp", [], ["Exchange", "Python"]),
        ("join_left_equi", ["BroadcastHashJoin"], ["hashpartitioning"]),
        ("join_left_matched", ["Inner"], ["LeftOuter"]),
        ("duplicate_keys", ["partial_count", "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>"], []),
        ("sample_top_n", ["TakeOrderedAndProject"], ["rangepartitioning"]),
        ("scan_partitioned", ["FileScan parquet"], ["Exchange"]),
        ("scan_delimited", ["PushedFilters: [IsNotNull(data)"], ["Exchange", "Python"]),
        ("dbf_table", ["MapInArrow"], ["EvalPython", "Exchange"]),
    ],
)
def test_plans(spark, name, wanted, unwanted):
    text = entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert [w for w in wanted if w not in text] == []
    assert [u for u in unwanted if u in text] == []
