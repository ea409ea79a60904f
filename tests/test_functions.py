from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lavra.functions import moments, text


def one_column(spark, values):
    return spark.createDataFrame([(v,) for v in values], "c string")


def apply(spark, values, function):
    df = one_column(spark, values).coalesce(1)
    return [r[0] for r in df.select(function(F.col("c"))).collect()]


def test_blank_means_spaces_only_and_keeps_the_rest_untrimmed(spark):
    assert apply(spark, ["", "  ", "\t", None, "a "], text.null_if_blank) == [
        None,
        None,
        "\t",
        None,
        "a ",
    ]
    assert apply(spark, ["", "  ", "\t", None, "a "], text.is_blank) == [
        True,
        True,
        False,
        True,
        False,
    ]


def test_decimal_comma(spark):
    values = ["926,1", ",8", "1,2,3", "-9999", "", None, " 7,5 ", "x", "12"]
    assert apply(spark, values, text.decimal_comma) == [
        926.1,
        0.8,
        None,
        -9999.0,
        None,
        None,
        7.5,
        None,
        12.0,
    ]


def test_code_prefix_keeps_null(spark):
    assert apply(spark, ["3529005", "35", None], text.code_prefix) == ["352900", "35", None]


def test_last_value_of_label(spark):
    lines = [
        ["UF:;SP", " UF: ; MG ; x", "sem separador", ";vazio"],
        ["OUTRO:;1"],
        [],
        ["UF:;"],
    ]
    df = spark.createDataFrame([(v,) for v in lines], "c array<string>").coalesce(1)
    found = [r[0] for r in df.select(text.last_value_of(F.col("c"), "UF:")).collect()]
    assert found == ["MG ; x", None, None, ""]


@pytest.mark.parametrize(
    ("digits", "expected"),
    [
        ("20230105", date(2023, 1, 5)),
        ("20230231", None),
        ("20240229", date(2024, 2, 29)),
        ("", None),
        ("x", None),
        (None, None),
        ("2023-01-05", None),
    ],
)
def test_date_from_digits(spark, digits, expected):
    assert apply(spark, [digits], moments.date_from_digits) == [expected]


def test_hour_code(spark):
    assert apply(spark, ["0000 UTC", " 2300 UTC", None], moments.hour_code) == [
        "0000",
        "2300",
        None,
    ]


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo"])
def test_hourly_timestamp_does_not_depend_on_the_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = [
            ("2023/01/01", "0000"),
            # Midnight that the clocks of Sao Paulo skipped.
            ("2017/10/15", "0000"),
            ("2023/01/01", "2330"),
            ("2023/01/01", None),
            (None, "0000"),
            ("2023/02/30", "0000"),
            ("2023/01/01", "2400"),
            ("2023/01/01", "00"),
            ("x", "0000"),
        ]
        df = spark.createDataFrame(rows, "d string, h string").coalesce(1)
        found = df.select(moments.hourly_timestamp(F.col("d"), F.col("h")).alias("t"))
        assert dict(found.dtypes) == {"t": "timestamp_ntz"}
        assert [r[0] for r in found.collect()] == [
            datetime(2023, 1, 1),
            datetime(2017, 10, 15),
            datetime(2023, 1, 1, 23, 30),
            None,
            None,
            None,
            None,
            None,
            None,
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_hours_in_year(spark):
    df = spark.createDataFrame([(2023,), (2024,), (1900,), (2000,)], "y int").coalesce(1)
    assert [r[0] for r in df.select(moments.hours_in_year(F.col("y"))).collect()] == [
        8760,
        8784,
        8760,
        8784,
    ]


def test_monthly_file_stem(spark):
    df = spark.createDataFrame([(date(2023, 4, 1),)], "d date")
    assert df.select(moments.monthly_file_stem(F.col("d"), "RDSP")).first()[0] == "RDSP2304"
