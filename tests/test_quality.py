import pytest
from pyspark.sql import functions as F

from lavra.functions.moments import hours_in_year
from lavra.operators import quality as Q
from tests.helpers import checks, plan

GOOD = [("350001", "SP", 1.0), ("350002", "SP", 2.0)]
SCHEMA = "cod string, uf string, lat double"


def good(spark):
    return spark.createDataFrame(GOOD, SCHEMA)


# Each check, and rows that must make it fail with the observed figure.
FAULTS = [
    (lambda: Q.row_count("c", 2), GOOD + [("350003", "SP", 1.0)], 3),
    (lambda: Q.unique_count("c", ["cod"], 2), [GOOD[0], GOOD[0]], 1),
    (lambda: Q.unique_count("c", ["cod"], 2), GOOD + [(None, "SP", 1.0)], 3),
    (lambda: Q.max_distinct("c", ["cod"], 2), GOOD + [("350003", "SP", 1.0)], 3),
    (lambda: Q.not_null("c", "lat"), GOOD + [("350003", "SP", None)], 1),
    (lambda: Q.not_blank("c", "cod"), GOOD + [("  ", "SP", 1.0), (None, "SP", 1.0)], 2),
    (lambda: Q.only_value("c", "uf", "SP"), GOOD + [("350003", "MG", 1.0), ("350003", None, 1.0)], 1),
    (lambda: Q.only_prefix("c", "cod", "35"), GOOD + [("310003", "SP", 1.0), (None, "SP", 1.0)], 1),
    (lambda: Q.value_set("c", "uf", ["SP"]), GOOD + [("350003", "MG", 1.0)], 1),
    (lambda: Q.value_set("c", "uf", ["SP"]), GOOD + [("350003", None, 1.0)], 1),
    (lambda: Q.value_set("c", "uf", ["SP"]), [], 1),
    (lambda: Q.no_duplicates("c", ["cod", "uf"]), GOOD + GOOD[:1], 1),
    (lambda: Q.no_duplicates("c", ["cod"]), GOOD + [(None, "SP", 1.0)] * 2, 1),
    (lambda: Q.group_size("c", ["uf"], 2), GOOD + [("350003", "MG", 1.0)], 1),
]


def test_every_check_passes_on_good_rows(spark):
    frame = Q.evaluate(good(spark), [check() for check, _, _ in FAULTS])
    assert frame.count() == len(FAULTS)
    assert frame.filter("not passed").count() == 0
    assert Q.enforce(frame) == []


@pytest.mark.parametrize(("check", "rows", "observed"), FAULTS)
def test_every_check_fails_on_its_fault(spark, check, rows, observed):
    frame = Q.evaluate(spark.createDataFrame(rows, SCHEMA), [check()])
    result = frame.first()
    assert (result["observed"], result["passed"]) == (observed, False)
    with pytest.raises(Q.QualityError):
        Q.enforce(frame)
    assert len(Q.enforce(frame, "collect")) == 1


def test_schema_checks(spark):
    df = good(spark)
    frame = checks(
        Q.evaluate(
            df,
            [
                Q.column_count("three", df, 3),
                Q.column_count("wrong", df, 116),
                Q.column_names("same", df, ["cod", "uf", "lat"]),
                Q.column_names("order", df, ["uf", "cod", "lat"]),
            ],
        )
    )
    assert {name: r["passed"] for name, r in frame.items()} == {
        "three": True,
        "wrong": False,
        "same": True,
        "order": False,
    }


def test_report_only_checks_never_fail(spark):
    df = spark.createDataFrame([("a", None, None)], SCHEMA)
    result = Q.evaluate(df, [Q.reported_nulls("nulls", "uf")]).first()
    assert (result["observed"], result["expected"], result["passed"]) == (1, None, True)


def test_raise_names_the_first_failure_and_collect_names_all_in_order(spark):
    df = spark.createDataFrame([("x", "MG", None)], SCHEMA)
    frame = Q.evaluate(
        df,
        [
            Q.row_count("rows", 1),
            Q.no_duplicates("duplicates", ["cod"]),
            Q.not_null("latitude", "lat"),
            Q.group_size("sizes", ["cod"], 5),
            Q.only_value("state", "uf", "SP"),
        ],
    )
    with pytest.raises(Q.QualityError, match="^latitude: observed 1, expected 0$"):
        Q.enforce(frame)
    assert [m.split(":")[0] for m in Q.enforce(frame, "collect")] == ["latitude", "sizes", "state"]
    with pytest.raises(ValueError):
        Q.enforce(frame, "ignore")


def test_checks_per_group_with_an_expectation_that_depends_on_it(spark):
    rows = [(y, s) for y, days in ((2023, 365), (2024, 365)) for s in "ab" for _ in range(days * 24)]
    df = spark.createDataFrame(rows, "ano int, estacao string")
    hours = hours_in_year(F.col("ano"))
    frame = Q.evaluate(
        df, [Q.row_count("rows", hours * 2), Q.group_size("sizes", ["estacao"], hours)], ["ano"]
    )
    found = {(r["ano"], r["check"]): (r["observed"], r["expected"], r["passed"]) for r in frame.collect()}
    assert found == {
        (2023, "rows"): (17520, 17520, True),
        (2023, "sizes"): (0, 0, True),
        (2024, "rows"): (17520, 17568, False),
        (2024, "sizes"): (2, 0, False),
    }
    assert Q.enforce(frame, "collect")[0].startswith("2024: rows")


def test_checks_on_rows_share_one_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    good(spark).write.parquet(path)
    df = spark.read.parquet(path)
    text = plan(
        Q.evaluate(
            df,
            [
                Q.row_count("rows", 2),
                Q.not_null("lat", "lat"),
                Q.unique_count("cod", ["cod"], 2),
                Q.max_distinct("uf", ["uf"], 2),
                Q.no_duplicates("one", ["cod", "uf"]),
                Q.group_size("two", ["cod", "uf"], 1),
            ],
        )
    )
    assert text.count("FileScan") == 2


def test_checks_of_the_schema_see_an_empty_table(spark):
    empty = spark.createDataFrame([], "a int, b int")
    results = Q.evaluate(empty, [Q.column_count("two", empty, 2), Q.column_names("wrong", empty, ["b", "a"])])
    assert [(r["observed"], r["passed"]) for r in results.orderBy("position").collect()] == [(2, True), (1, False)]
    assert "Scan" not in results._jdf.queryExecution().executedPlan().toString().replace("Range", "")
