import pytest
from pyspark.sql import functions as F

from lavra import contracts as C
from lavra.operators import periods
from lavra.operators import quality as Q
from lavra.plans import admissions, municipalities, reports, weather
from lavra.sources.dbf import Field
from tests.helpers import PREAMBLE, checks, dbf_bytes, rows, station_text, write_zip

FACT = "MUNIC_RES string, DT_INTER string, DT_SAIDA string, NASC string, DIAG_PRINC string"


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(
        [
            ("352900", "20230105", "20230231", "19800101", "A00"),
            ("352900", " ", "20230110", "19800101", "  "),
            ("310620", "20230105", "20230106", "19800101", "A00"),
            (None, "20230105", "20230106", "19800101", "A00"),
            ("  ", "20230105", "20230106", "19800101", "A00"),
        ],
        FACT,
    )


@pytest.fixture
def dimension(spark):
    return spark.createDataFrame(
        [("352900", "Marília", "SP", 1170.5), ("350010", "Adamantina", "SP", 411.9)],
        "CD_MUN_6 string, NM_MUN string, SIGLA_UF string, AREA_KM2 double",
    )


def test_one_month_of_admissions(spark, tmp_path, raw, dimension):
    path = str(tmp_path / "silver")
    counted = admissions.run(raw, dimension, path).first()
    assert tuple(counted) == (5, 5, 2, 3)
    stored = spark.read.parquet(path)
    assert stored.columns == [*raw.columns, "NM_MUN", "SIGLA_UF", "AREA_KM2"]
    found = stored.select(
        F.date_format("DT_INTER", "yyyyMMdd"), F.date_format("DT_SAIDA", "yyyyMMdd"), "DIAG_PRINC", "NM_MUN"
    )
    assert rows(found) == [
        ("20230105", None, "A00", "Marília"),
        (None, "20230110", None, "Marília"),
    ]


def test_a_duplicate_dimension_key_stops_the_month_before_writing(spark, tmp_path, raw, dimension):
    path = tmp_path / "silver"
    with pytest.raises(Q.QualityError, match="rows added by the join: observed 2"):
        admissions.run(raw, dimension.unionByName(dimension), str(path))
    assert not path.exists()


def test_admissions_from_dbf_files(spark, tmp_path, dimension):
    fields = [("MUNIC_RES", "C", 6), ("DT_INTER", "C", 8), ("DT_SAIDA", "C", 8), ("NASC", "C", 8), ("DIAG_PRINC", "C", 4)]
    landing = tmp_path / "2023"
    landing.mkdir()
    for month in (1, 2):
        records = [(" ", ["352900", f"2023{month:02d}05", "", "19800101", "A00"])] * 25
        (landing / f"RDSP23{month:02d}.dbf").write_bytes(dbf_bytes(fields, records))
    staged = admissions.stage_dbf(spark, str(tmp_path), [Field(n) for n, _, _ in fields])
    counted = admissions.run(staged.drop("_arquivo"), dimension, str(tmp_path / "silver"))
    assert counted.first()["matched"] == 50


def with_periods(raw):
    months = raw.withColumns({"ano": F.lit(2023), "mes": F.lit(1)})
    return months.unionByName(months.withColumn("mes", F.lit(2)))


def test_a_bad_period_is_not_written_and_stops_no_other(spark, tmp_path, raw, dimension):
    path = str(tmp_path / "silver")
    first, last = periods.month_range(2023, 1, 2023, 4, C.ADMISSION_FIRST_YEAR)
    expected = periods.month_spine(spark, first, last)
    both = with_periods(raw)
    assert [tuple(r)[1:3] for r in rows(admissions.run_periods(both, dimension, path, expected))] == [
        (1, "OK"),
        (2, "OK"),
        (3, "ERRO"),
        (4, "ERRO"),
    ]
    assert rows(spark.read.parquet(path).groupBy("mes").count()) == [(1, 2), (2, 2)]

    # January now has a duplicate in the dimension; February comes with one row less.
    extra = spark.createDataFrame([("350010", "outra", "SP", 1.0)], dimension.schema)
    january = spark.createDataFrame([("350010", "", "", "", "", 2023, 1)], FACT + ", ano int, mes int")
    february = both.filter("mes = 2 and DT_INTER <> ' '")
    status = admissions.run_periods(
        february.unionByName(january), dimension.unionByName(extra), path, expected
    )
    assert rows(status) == [
        (2023, 1, "ERRO", "rows added by the join: 1"),
        (2023, 2, "OK", None),
        (2023, 3, "ERRO", "no rows landed"),
        (2023, 4, "ERRO", "no rows landed"),
    ]
    assert rows(spark.read.parquet(path).groupBy("mes").count()) == [(1, 2), (2, 1)]


def test_an_unreadable_month_stops_no_other(spark, tmp_path, dimension):
    names = ["MUNIC_RES", "DT_INTER", "DT_SAIDA", "NASC", "DIAG_PRINC"]
    fields = [(n, "C", 8) for n in names]
    good = dbf_bytes(fields, [(" ", ["352900", "20230105", "", "", "A00"])] * 3)
    folder = tmp_path / "landing" / "2023"
    folder.mkdir(parents=True)
    (folder / "RDSP2301.dbf").write_bytes(good)
    (folder / "RDSP2302.dbf").write_bytes(b"x")
    (folder / "RDSP2303.dbf").write_bytes(good[:-5])
    (folder / "RDSP2304.dbf").write_bytes(good)
    (folder / "leiame.dbf").write_bytes(b"")
    wanted = [Field(n) for n in names]
    rows_found, unreadable = admissions.stage_months(spark, str(tmp_path / "landing"), wanted)
    first, last = periods.month_range(2023, 1, 2023, 5, C.ADMISSION_FIRST_YEAR)
    status = admissions.run_periods(
        rows_found,
        dimension,
        str(tmp_path / "silver"),
        periods.month_spine(spark, first, last),
        unreadable=unreadable,
    )
    found = {r["mes"]: (r["status"], (r["motivo"] or "").split(":")[0]) for r in status.collect()}
    assert found == {
        1: ("OK", ""),
        2: ("ERRO", "no DBF header"),
        3: ("ERRO", "cut short"),
        4: ("OK", ""),
        5: ("ERRO", "no rows landed"),
    }
    stored = spark.read.parquet(str(tmp_path / "silver"))
    assert rows(stored.groupBy("ano", "mes").count()) == [(2023, 1, 3), (2023, 4, 3)]
    # Whichever bad file comes first.
    with pytest.raises(Exception, match="no DBF header|cut short"):
        admissions.stage_dbf(spark, str(tmp_path / "landing"), wanted)


def test_periods_that_lose_all_rows_or_are_not_expected(spark, tmp_path, raw, dimension):
    path = str(tmp_path / "silver")
    months = {m: raw.selectExpr("*", "2023 as ano", f"{m} as mes") for m in (1, 2, 4)}
    expected = periods.month_spine(spark, *periods.month_range(2023, 1, 2023, 2, C.ADMISSION_FIRST_YEAR))
    admissions.run_periods(months[1].unionByName(months[2]), dimension, path, expected)
    assert rows(spark.read.parquet(path).groupBy("mes").count()) == [(1, 2), (2, 2)]
    strange = months[1].withColumn("MUNIC_RES", F.lit("999999"))
    status = admissions.run_periods(strange.unionByName(months[4]), dimension, path, expected)
    assert rows(status) == [
        (2023, 1, "OK", None),
        (2023, 2, "ERRO", "no rows landed"),
        (2023, 4, "ERRO", "period not expected"),
    ]
    assert rows(spark.read.parquet(path).groupBy("mes").count()) == [(2, 2)]


def test_municipality_dimension(spark, tmp_path):
    fields = [("CD_MUN", "C", 7), ("NM_MUN", "C", 20), ("SIGLA_UF", "C", 2), ("AREA_KM2", "N", 9)]
    records = [(" ", ["3529005", "Marília", "SP", "1170.515"]), (" ", ["3500105", "Adamantina ", "SP", ""])]
    write_zip(tmp_path / "m.zip", {"SP.dbf": dbf_bytes(fields, records, "utf-8"), "SP.shp": b""})
    attributes = municipalities.read_attributes(spark, str(tmp_path / "m.zip"))
    vertices = spark.createDataFrame(
        [("3529005 ", -50.0, -22.0), ("3529005", -49.0, -23.0), ("9", 0.0, 0.0)],
        "CD_MUN string, x double, y double",
    )
    built = municipalities.build(attributes, vertices)
    assert built.columns == C.MUNICIPALITY_SILVER_COLUMNS
    assert rows(built) == [
        ("3500105", "350010", "Adamantina", "SP", None, None, None),
        ("3529005", "352900", "Marília", "SP", 1170.515, -22.5, -49.5),
    ]
    path = tmp_path / "silver"
    with pytest.raises(Q.QualityError, match="municipalities: observed 2, expected 645"):
        municipalities.run(attributes, vertices, str(path))
    with pytest.raises(Q.QualityError, match="without latitude: observed 1"):
        municipalities.run(attributes, vertices, str(path), municipalities.checks(2))
    assert not path.exists()
    complete = vertices.unionByName(vertices.limit(1).withColumn("CD_MUN", F.lit("3500105")))
    results = municipalities.run(attributes, complete, str(path), municipalities.checks(2))
    assert results.filter("passed").count() == 11
    stored = spark.read.parquet(str(path))
    assert rows(stored.filter(F.col("NM_MUN") == "Marília").select("CD_MUN")) == [("3529005",)]


def test_the_field_list_of_the_municipalities_is_exact(spark, tmp_path):
    fields = [("CD_MUN", "C", 7), ("SIGLA_UF", "C", 2), ("NM_MUN", "C", 9), ("AREA_KM2", "N", 9)]
    write_zip(tmp_path / "m.zip", {"a.dbf": dbf_bytes(fields, [(" ", ["1", "SP", "x", "1"])])})
    with pytest.raises(Exception, match="unexpected fields"):
        municipalities.read_attributes(spark, str(tmp_path / "m.zip")).collect()
    write_zip(tmp_path / "two.zip", {"a.dbf": b"", "b.dbf": b""})
    with pytest.raises(Q.QualityError, match="members ending in .dbf: observed 2, expected 1"):
        municipalities.read_attributes(spark, str(tmp_path / "two.zip"))


def land_year(tmp_path, year, stations, hours, extra=()):
    folder = tmp_path / "landing" / str(year)
    folder.mkdir(parents=True)
    lines = [
        f"{year}/01/{1 + h // 24:02d};{h % 24:02d}00 UTC;,8;926,1;x" for h in range(hours)
    ] + list(extra)
    content = {
        f"{year}/INMET_SE_SP_{s}_.CSV": station_text(lines, [l.replace("A716", s) for l in PREAMBLE])
        for s in stations
    }
    write_zip(folder / f"{year}.zip", content)
    return str(tmp_path / "landing"), str(tmp_path / "silver")


def test_a_year_of_weather(spark, tmp_path):
    landing, base = land_year(tmp_path, 2023, ["A701", "000"], 48)
    results = checks(weather.run_year(spark, 2023, landing, base, stations=2))
    assert all(r["passed"] for r in results.values())
    stored = spark.read.schema(C.WEATHER_SILVER_SCHEMA).parquet(f"{base}/2023")
    assert stored.count() == 96
    found = stored.filter(F.col("codigo_estacao") == "000").orderBy("data_hora_utc").first()
    assert (found["ano"], found["hora_utc"], found["precipitacao_mm"]) == (2023, "0000", 0.8)
    assert (found["pressao_estacao_mb"], found["pressao_max_mb"]) == (926.1, None)


def test_weather_is_not_written_when_a_check_fails(spark, tmp_path):
    landing, base = land_year(tmp_path, 2023, ["A701"], 2, ["2023/01/01;0000 UTC;1"])
    with pytest.raises(Q.QualityError, match="expected 40"):
        weather.run_year(spark, 2023, landing, base)
    with pytest.raises(Q.QualityError, match="duplicate station and timestamp: observed 1"):
        weather.run_year(spark, 2023, landing, base, stations=1)
    assert not (tmp_path / "silver").exists()


def test_weather_without_an_hour_is_refused(spark, tmp_path):
    landing, base = land_year(tmp_path, 2023, ["A701"], 2, ["2023/01/01;;1"])
    with pytest.raises(Q.QualityError, match="without timestamp: observed 1"):
        weather.run_year(spark, 2023, landing, base, stations=1)


def test_weather_report_checks_every_readable_year(spark, tmp_path):
    landing, base = land_year(tmp_path, 2023, ["A701", "A716"], 48)
    weather.run_year(spark, 2023, landing, base, stations=2)
    empty = spark.read.schema(C.WEATHER_SILVER_SCHEMA).parquet(f"{base}/2023").limit(0)
    empty.drop("codigo_estacao").write.parquet(f"{base}/2024")
    report = reports.weather_report(spark, base, [2023, 2024, 2025], reports.weather_checks(2))
    found = {(r["ano"], r["check"]): r["passed"] for r in report.collect()}
    assert found[2023, "stations"] and found[2023, "states"]
    assert not found[2023, "rows"]
    assert not found[2023, "stations with an unexpected row count"]
    assert not found[2024, "holds no rows"]
    assert not found[2025, "cannot be read"]
    assert len(found) == 11
    messages = Q.enforce(report, "collect")
    assert messages[0] == "2023: rows: observed 96, expected 17520"
    assert messages[-2:] == ["2024: holds no rows", "2025: cannot be read"]


def test_years_of_weather_go_on_past_bad_ones(spark, tmp_path):
    landing, base = land_year(tmp_path, 2023, ["A701", "A716"], 48)
    land_year(tmp_path, 2024, ["A701"], 2, ["2024/01/01;;1"])
    (tmp_path / "landing" / "2025").mkdir()
    (tmp_path / "landing" / "2025" / "2025.zip").write_bytes(b"damaged")
    status = weather.run_years(spark, [2022, 2023, 2024, 2025], landing, base, stations=2)
    found = {r["ano"]: (r["status"], r["motivo"]) for r in status.collect()}
    assert found[2023] == ("OK", None)
    assert found[2024][0] == "ERRO"
    assert found[2024][1].endswith("members ending in .csv: observed 1, expected 2")
    assert found[2022] == ("ERRO", "no archive landed") and found[2025] == ("ERRO", "File is not a zip file")
    stored = spark.read.schema(C.WEATHER_SILVER_SCHEMA).parquet(f"{base}/2023")
    assert rows(stored.groupBy("ano", "codigo_estacao").count()) == [(2023, "A701", 48), (2023, "A716", 48)]
    assert sorted(p.name for p in (tmp_path / "silver").iterdir() if not p.name.startswith("_")) == ["2023"]


def test_weather_report_survives_a_damaged_year(spark, tmp_path):
    landing, base = land_year(tmp_path, 2023, ["A701", "A716"], 48)
    weather.run_year(spark, 2023, landing, base, stations=2)
    (tmp_path / "silver" / "2024" / "codigo_estacao=A701").mkdir(parents=True)
    (tmp_path / "silver" / "2024" / "codigo_estacao=A701" / "part-0.parquet").write_bytes(b"PAR1 no table")
    report = reports.weather_series_report(spark, base, [2023, 2024], reports.weather_checks(2))
    assert {r["check"] for r in report.checks.collect() if r["ano"] == 2024} == {"cannot be read"}
    assert rows(report.stations) == [(2023, "A701", 48), (2023, "A716", 48)]
    assert report.range.first()["data_hora_utc_min"].isoformat() == "2023-01-01T00:00:00"
    assert report.sample.count() == 10


def test_admissions_report_over_a_tree(spark, tmp_path, raw, dimension):
    root = tmp_path / "sih"
    for year, month in [(2023, 1), (2023, 2), (2024, 1)]:
        admissions.run(raw, dimension, str(root / str(year) / f"{month:02d}"))
    report = reports.admissions_report(spark, str(root))
    found = {name: (r["observed"], r["passed"]) for name, r in checks(report.checks).items()}
    assert found == {
        "columns": (8, False),
        "periods": (3, False),
        "without municipality": (0, True),
        "without state": (0, True),
        "distinct municipalities": (1, True),
        "without main diagnosis": (3, True),
        "without admission date": (3, True),
        "states": (0, True),
    }
    assert rows(report.by_year) == [(2023, 4), (2024, 2)]
    assert rows(report.by_period) == [(2023, 1, 2), (2023, 2, 2), (2024, 1, 2)]
    assert rows(report.periods) == [(2023, 1), (2023, 2), (2024, 1)]
    assert rows(report.by_state) == [("SP", 6)]
    assert report.sample.count() == 6
    assert report.admission_range.first()["DT_INTER_min"].isoformat() == "2023-01-05"
