from datetime import date

import pytest
from pyspark.sql import functions as F

from lavra.operators import aggregates as A
from lavra.operators import clean, lookup, periods, sets
from tests.helpers import plan, rows

ADDED = ["nome", "area"]


def test_type_driven_cleaning_touches_only_text_and_keeps_order(spark):
    df = spark.createDataFrame([(" ", 1, "a ", None)], "a string, n int, `b.c` string, d date")
    cleaned = clean.blanks_to_null(df)
    assert cleaned.columns == ["a", "n", "b.c", "d"]
    assert rows(cleaned) == [(None, 1, "a ", None)]


def test_cleaning_a_wide_table_is_one_projection(spark):
    wide = spark.range(1).select(*(F.lit(" ").alias(f"c{i}") for i in range(113)))
    logical = clean.blanks_to_null(wide)._jdf.queryExecution().logical().toString()
    assert logical.count("Project") == 2


@pytest.fixture
def fact(spark):
    keys = ["1", "1", "2", "3", "9", None] + ["1"] * 200
    return spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id int, chave string")


@pytest.fixture
def dimension(spark):
    return spark.createDataFrame(
        [("1", "um", 1.0), ("2", None, 2.0), ("3", "tres", None), (None, "nada", 0.0)],
        "cod string, nome string, area double",
    )


def expected_join(fact, dimension):
    known = {r["cod"]: (r["nome"], r["area"]) for r in dimension.collect() if r["cod"]}
    return sorted(
        ((r["id"], r["chave"], *known.get(r["chave"], (None, None))) for r in fact.collect()),
        key=lambda t: tuple((v is None, str(v)) for v in t),
    )


@pytest.mark.parametrize("limit", [lookup.BROADCAST_BYTES, 100, 0])
def test_lookup_gives_the_same_rows_on_every_path(spark, fact, dimension, limit):
    joined = lookup.lookup_left(fact, dimension, "chave", "cod", ADDED, broadcast_bytes=limit)
    assert joined.columns == ["id", "chave", "nome", "area"]
    assert rows(joined) == expected_join(fact, dimension)


def test_small_dimension_is_broadcast_and_the_fact_not_shuffled(spark, fact, dimension):
    text = plan(lookup.lookup_left(fact, dimension, "chave", "cod", ADDED))
    assert "BroadcastHashJoin" in text
    assert "hashpartitioning" not in text


def test_large_dimension_keeps_hot_and_null_keys_out_of_the_shuffle(spark, fact, dimension):
    assert lookup.hot_keys(fact, "chave") == ["1"]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup.lookup_left(fact, dimension, "chave", "cod", ADDED, broadcast_bytes=100)
        text = plan(joined)
        assert "Union" in text and "BroadcastHashJoin" in text and "SortMergeJoin" in text
        assert rows(joined) == expected_join(fact, dimension)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_lookup_without_hot_keys(spark, dimension):
    even = spark.range(1000).select("id", (F.col("id") % 500).cast("string").alias("chave"))
    joined = lookup.lookup_left(even, dimension, "chave", "cod", ADDED, broadcast_bytes=0)
    assert lookup.hot_keys(even, "chave") == []
    assert joined.count() == 1000
    assert joined.filter(F.col("nome").isNotNull()).count() == 4


def test_duplicate_dimension_keys_multiply_rows_on_every_path(spark, fact, dimension):
    doubled = dimension.unionByName(dimension)
    for limit in (lookup.BROADCAST_BYTES, 0):
        joined = lookup.lookup_left(fact, doubled, "chave", "cod", ADDED, broadcast_bytes=limit)
        assert joined.count() == 2 * 204 + 2


def test_measured_bytes_grows_with_the_data(spark, dimension):
    small = lookup.measured_bytes(dimension)
    assert small > 0
    assert lookup.measured_bytes(dimension.unionByName(dimension)) == 2 * small
    assert lookup.measured_bytes(dimension.limit(0)) == 0
    nested = spark.createDataFrame([([1, 2, 3],)], "v array<int>")
    assert lookup.measured_bytes(nested) > 16


def test_match_counts_equal_the_joined_rows(spark, fact, dimension):
    doubled = dimension.unionByName(dimension.filter("cod = '1'"))
    joined = lookup.lookup_left(fact, doubled, "chave", "cod", ADDED)
    counted = lookup.match_counts(fact, doubled, "chave", "cod", "nome").first()
    assert counted["total"] == fact.count()
    assert counted["after_join"] == joined.count()
    assert counted["matched"] == lookup.keep_matched(joined, "nome").count()
    assert counted["unmatched"] == joined.filter("nome is null").count()


def test_match_counts_of_nothing(spark, fact, dimension):
    counted = lookup.match_counts(fact.limit(0), dimension, "chave", "cod", "nome").first()
    assert tuple(counted) == (0, 0, 0, 0)


def test_left_join_then_not_null_becomes_inner(spark, fact, dimension):
    matched = lookup.keep_matched(
        lookup.lookup_left(fact, dimension, "chave", "cod", ADDED), "nome"
    )
    assert "Inner" in plan(matched) and "LeftOuter" not in plan(matched)


def test_distinct_counts_null_as_a_value(spark):
    df = spark.createDataFrame([("a", 1), (None, 1), ("a", 1), (None, 1)], "c string, d int")
    found = df.agg(
        A.distinct_count("c").alias("one"), A.distinct_count("c", "d").alias("two")
    ).first()
    assert tuple(found) == (2, 2)
    assert df.select("c").distinct().count() == 2


def test_counts_duplicates_and_ranges(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", 1), ("b", 2), (None, 2), (None, 2), (" ", 3)], "k string, v int"
    )
    assert A.duplicate_groups(df, "k", "v").first()[0] == 2
    assert A.duplicate_excess(df, "k", "v").first()[0] == 2
    assert A.unexpected_groups(df, ["k"], 2).first()[0] == 2
    assert tuple(A.value_range(df, "v").first()) == (1, 3)
    assert tuple(A.null_counts(df, ["k", "v"]).first()) == (2, 0)
    assert tuple(A.blank_counts(df, ["k"]).first()) == (3,)
    assert [r[0] for r in A.distinct_values(df, "k").collect()] == [None, " ", "a", "b"]
    assert rows(A.group_counts(df, "v")) == [(1, 2), (2, 3), (3, 1)]


def test_null_counts_scan_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id a", "id b", "id c").write.parquet(path)
    text = plan(A.null_counts(spark.read.parquet(path), ["a", "b"]))
    assert text.count("FileScan") == 1
    assert "ReadSchema: struct<a:bigint,b:bigint>" in text


def test_vertex_mean_counts_the_closing_point(spark):
    square = [("p", x, y) for x, y in [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]]
    df = spark.createDataFrame(square, "id string, x double, y double")
    assert tuple(A.vertex_mean(df, "id", "x", "y").first()) == ("p", 1.6, 1.6)


def test_top_n_is_a_top_k(spark):
    df = spark.range(100).selectExpr("id % 7 a", "id b")
    top = A.first_sorted(df, 3, "a", "b")
    assert "TakeOrderedAndProject" in plan(top)
    assert [tuple(r) for r in top.collect()] == [(0, 0), (0, 7), (0, 14)]
    assert A.first_any(df, 5).count() == 5


def test_union_matches_names_and_stays_one_node(spark):
    frames = [spark.range(1).selectExpr(f"{i} a", "id b") for i in range(40)]
    swapped = spark.range(1).selectExpr("id b", "99 a")
    union = sets.union_by_name([*frames, swapped])
    assert union.count() == 41
    assert union.filter("a = 99").count() == 1
    optimized = union._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("Union") == 1


def test_difference_is_distinct_and_sees_null(spark):
    left = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "k string")
    right = spark.createDataFrame([("b",)], "k string")
    assert rows(sets.difference(left, right, "k")) == [("a",), (None,)]
    assert rows(sets.difference(left, left, "k")) == []


def test_month_range_rolls_over_and_validates(spark):
    first, last = periods.month_range(2023, 11, 2024, 2, 2008)
    months = rows(periods.month_spine(spark, first, last).select("ano", "mes"))
    assert months == [(2023, 11), (2023, 12), (2024, 1), (2024, 2)]
    for arguments in [
        (2007, 1, 2024, 1),
        (2023, 0, 2024, 1),
        (2023, 1, 2024, 13),
        (2024, 2, 2024, 1),
    ]:
        with pytest.raises(ValueError):
            periods.month_range(*arguments, 2008)
    for arguments in [("2023", 1, 2024, 1), (2023, 1.0, 2024, 1), (True, 1, 2024, 1)]:
        with pytest.raises(TypeError):
            periods.month_range(*arguments, 2008)
    with pytest.raises(ValueError):
        periods.check_year(1999, 2000)


def test_the_batch_has_thirty_three_months(spark):
    first, last = periods.month_range(2023, 4, 2025, 12, 2008)
    assert periods.month_spine(spark, first, last).count() == 33


def test_month_spine_of_a_table(spark):
    df = spark.createDataFrame([(date(2023, 12, 31),), (date(2024, 2, 1),)], "d date")
    found = rows(periods.month_spine_of(df, "d"))
    assert [r[:2] for r in found] == [(2023, 12), (2024, 1), (2024, 2)]


def test_completeness_names_what_is_missing(spark):
    expected = periods.year_spine(spark, 2023, 2025).withColumn("nome", F.col("ano").cast("string"))
    found = spark.createDataFrame([(2024,), (2024,), (2031,)], "ano int")
    report = periods.completeness(expected, found, ["ano"], "nome").first()
    assert tuple(report) == (3, 1, 2, ["2023", "2025"], False)
    all_found = periods.completeness(expected, expected, ["ano"], "nome").first()
    assert tuple(all_found) == (3, 3, 0, [], True)
    assert rows(periods.missing_keys(expected.select("ano"), found, "ano")) == [(2023,), (2025,)]


def test_hourly_rows_expected(spark):
    years = periods.year_spine(spark, 2023, 2025)
    assert rows(periods.hourly_rows_expected(years, 40)) == [
        (2023, 350400),
        (2024, 351360),
        (2025, 350400),
    ]
