import gzip
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra import contracts as C
from lavra.operators import quality as Q
from lavra.plans import weather
from lavra.sources import archive, dbf, delimited, landing, tables
from tests.test_archive_ranges import bytes_read, counting
from tests.helpers import PREAMBLE, dbf_bytes, plan, rows, station_text, write_zip

SHORT = T.StructType([T.StructField(n, T.StringType()) for n in ("data", "hora", "a", "b")])

LINES = [
    "2023/01/01;0000 UTC;,8;x",
    "2023/01/01;0100 UTC",
    "2023/01/01;;1,5;;sobra;mais",
    "2023-01-01;0200 UTC;1;2",
    "",
]


def test_delimited_shapes_and_encoding(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(station_text(LINES))
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b.csv").write_bytes(station_text(["2024/01/01;0000 UTC;é;"]))
    df = delimited.read_delimited(spark, str(tmp_path), SHORT)
    kept = df.filter(F.col("data").rlike(C.WEATHER_DATE_PATTERN))
    assert rows(kept.select("data", "hora", "a", "b")) == [
        ("2023/01/01", "0000 UTC", ",8", "x"),
        ("2023/01/01", "0100 UTC", None, None),
        ("2023/01/01", None, "1,5", None),
        ("2024/01/01", "0000 UTC", "é", None),
    ]
    # The first line is gone as a header; the rest of the preamble is not.
    assert df.filter(F.col("data") == "REGIAO:").count() == 0
    assert df.filter(F.col("data") == "UF:").count() == 2


def test_preambles(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(station_text(LINES))
    late = [*PREAMBLE[:1], "UF:;MG", "sem separador", "", " UF: ; RJ ", *["x;y"] * 3, "UF:;BA"]
    (tmp_path / "b.csv").write_bytes(station_text(["2023/01/01;0000 UTC;1;2"] * 100, late))
    labels = {"uf": "UF:", "estacao": "ESTACAO:", "latitude": "LATITUDE:"}
    found = delimited.read_preambles(spark, str(tmp_path), labels)
    named = found.select(F.substring_index("_arquivo", "/", -1).alias("f"), "uf", "estacao", "latitude")
    # The last key within eight lines wins; the ninth line does not count.
    assert rows(named) == [("a.csv", "SP", "MARÍLIA", "-22,23"), ("b.csv", "RJ", None, None)]


def members(stations=("A701", "A716")):
    content = {
        f"2023/INMET_SE_SP_{s}_X.CSV": station_text(
            [f"2023/01/01;{h:02d}00 UTC;,{h}" for h in range(24)],
            [line.replace("A716", s) for line in PREAMBLE],
        )
        for s in stations
    }
    content["2023/INMET_NE_BA_A401_X.CSV"] = b"REGIAO:;NE\n"
    content["xINMET_SE_SP_A1.CSV"] = b"no"
    content["INMET_SE_SP_A2.TXT"] = b"no"
    content["inmet_se_sp_a999_.csv"] = station_text([])
    return content


def test_archive_members_by_pattern(spark, tmp_path):
    write_zip(tmp_path / "2023.zip", members())
    found = archive.list_members(spark, str(tmp_path), C.WEATHER_MEMBER_PATTERN)
    assert [r[1] for r in rows(found)] == [
        "2023/INMET_SE_SP_A701_X.CSV",
        "2023/INMET_SE_SP_A716_X.CSV",
        "inmet_se_sp_a999_.csv",
    ]
    assert archive.list_members(spark, str(tmp_path)).count() == 6
    archives = archive.list_archives(spark, str(tmp_path))
    assert Q.enforce(archive.member_count_check(archives, found, ".CSV", 3)) == []
    with pytest.raises(Q.QualityError):
        Q.enforce(archive.member_count_check(archives, found, ".csv", 40))


def test_exactly_one_member_rule(spark, tmp_path):
    write_zip(tmp_path / "none.zip", {"a.shp": b""})
    write_zip(tmp_path / "one.zip", {"a.DBF": b"", "a.shp": b""})
    write_zip(tmp_path / "two.zip", {"a.dbf": b"", "b.dbf": b""})
    write_zip(tmp_path / "empty.zip", {})
    archives, members = (f(spark, str(tmp_path)) for f in (archive.list_archives, archive.list_members))
    checked = archive.member_count_check(archives, members, ".dbf")
    found = {r["_arquivo"].split("/")[-1]: (r["observed"], r["passed"]) for r in checked.collect()}
    assert found == {
        "empty.zip": (0, False),
        "none.zip": (0, False),
        "one.zip": (1, True),
        "two.zip": (2, False),
    }


@pytest.mark.parametrize("size", [1, 50, archive.CHUNK_CHARACTERS])
def test_archive_lines_do_not_depend_on_the_chunk_size(spark, tmp_path, size):
    write_zip(tmp_path / "2023.zip", members())
    chunks = archive.read_member_chunks(
        spark, str(tmp_path), C.WEATHER_MEMBER_PATTERN, 8, chunk_characters=size
    )
    lines = archive.chunk_lines(chunks, "membro")
    data = lines.filter(F.col("linha").startswith("2023/"))
    assert data.count() == 48
    assert data.distinct().count() == 48
    assert lines.filter(F.col("linha").startswith("REGIAO")).count() == 0
    assert chunks.select("membro", "preambulo").distinct().count() == 3


def test_archive_and_folder_give_the_same_observations(spark, tmp_path):
    (tmp_path / "zip").mkdir()
    (tmp_path / "csv").mkdir()
    write_zip(tmp_path / "zip" / "2023.zip", members())
    for name, content in members().items():
        if "SE_SP_A7" in name:
            (tmp_path / "csv" / name.split("/")[-1]).write_bytes(content)
    zipped = weather.clean(weather.from_archives(spark, str(tmp_path / "zip")), 2023)
    loose = weather.clean(weather.from_folder(spark, str(tmp_path / "csv")), 2023)
    assert zipped.columns == C.WEATHER_SILVER_COLUMNS and len(zipped.columns) == 28
    assert rows(zipped) == rows(loose)
    assert zipped.count() == 48
    first = zipped.orderBy("codigo_estacao", "data_hora_utc").first()
    assert (first["codigo_estacao"], first["estacao"], first["latitude"]) == ("A701", "MARÍLIA", -22.23)


def test_plain_and_compressed_files_are_parsed_alike(spark, tmp_path):
    odd = ["", "   ", '"2023/01/01";"0000 UTC";",8"', " 2023/01/01;0100 UTC;1", *LINES]
    (tmp_path / "a.csv").write_bytes(station_text(odd))
    (tmp_path / "b.csv").write_bytes(station_text(odd, ["", *PREAMBLE]))
    (tmp_path / "c.csv").write_bytes(b"")
    columns = ["data", "hora_utc", *C.WEATHER_MEASURES, *weather.PREAMBLE]
    plain = rows(weather.from_folder(spark, str(tmp_path)).select(columns))
    packed = tmp_path.parent / f"{tmp_path.name}-gz"
    packed.mkdir()
    for name in ("a.csv", "b.csv"):
        (packed / f"{name}.gz").write_bytes(gzip.compress((tmp_path / name).read_bytes()))
    small = weather.from_folder(spark, str(packed)).select(columns)
    assert rows(small) == plain
    assert small.filter(F.col("data").rlike(C.WEATHER_DATE_PATTERN)).count() == 8


FIELDS = [("CD_MUN", "C", 7), ("NM_MUN", "C", 12), ("SIGLA_UF", "C", 2), ("AREA_KM2", "N", 9)]
WANTED = [dbf.Field(n, k) for n, k, _ in FIELDS]
RECORDS = [
    (" ", ["3529005", "Marília", "SP", "1170,515"]),
    ("*", ["3500000", "apagado", "SP", "1"]),
    (" ", ["3500105", " Adamantina", "", "  "]),
    (" ", ["3500204", "x", "SP", "***"]),
]
DECODED = [
    ("3500105", " Adamantina", "", None),
    ("3500204", "x", "SP", None),
    ("3529005", "Marília", "SP", 1170.515),
]


def decode(spark, path, fields=WANTED, encoding="ISO-8859-1", **options):
    return dbf.read_dbf(spark, str(path), fields, encoding, **options)


@pytest.mark.parametrize("batch", [1, 2, 3, 20_000])
@pytest.mark.parametrize("encoding", ["latin-1", "utf-8"])
def test_dbf_records(spark, tmp_path, batch, encoding):
    (tmp_path / "a.dbf").write_bytes(dbf_bytes(FIELDS, RECORDS, encoding))
    (tmp_path / "b.dbf").write_bytes(dbf_bytes(FIELDS, RECORDS[:1], encoding, extra_header=b"\0" * 263))
    (tmp_path / "empty.dbf").write_bytes(dbf_bytes(FIELDS, [], encoding))
    charset = {"latin-1": "ISO-8859-1", "utf-8": "UTF-8"}[encoding]
    found = decode(spark, tmp_path, encoding=charset, exact_fields=True, batch_records=batch)
    assert rows(found.drop("_arquivo")) == sorted([*DECODED, DECODED[2]])
    work = dbf.dbf_work(dbf.list_files(spark, str(tmp_path)), [f.name for f in WANTED], batch_records=batch)
    assert work.count() == {1: 5, 2: 3, 3: 3}.get(batch, 2)
    held = spark.read.format("binaryFile").load(str(tmp_path)).selectExpr("path as _arquivo", "content")
    again = dbf.decode_dbf(held, WANTED, charset, exact_fields=True, batch_records=batch)
    assert rows(again.drop("_arquivo")) == rows(found.drop("_arquivo"))


def test_describing_reads_headers_and_decoding_each_byte_once(spark, tmp_path):
    path = tmp_path / "a.dbf"
    path.write_bytes(dbf_bytes(FIELDS, RECORDS * 5000))
    fields = dbf.describe(spark, str(path), opener=counting)
    assert [f.name for f in fields] == [f[0] for f in FIELDS]
    assert bytes_read(path) < 300
    assert decode(spark, path, fields, batch_records=700, opener=counting).count() == 15_000
    assert bytes_read(path) < 1.05 * path.stat().st_size


def test_fractions_in_whole_fields_are_read(spark, tmp_path):
    (tmp_path / "a.dbf").write_bytes(dbf_bytes([("N", "N", 6), ("W", "N", 17)], [(" ", ["12.50", "12345678901234567"]), (" ", ["7", "1.5"])]))
    found = decode(spark, tmp_path, dbf.describe(spark, str(tmp_path))).drop("_arquivo")
    assert [t for _, t in found.dtypes] == ["double", "bigint"]
    assert rows(found) == [(12.5, 12345678901234567), (7.0, None)]


def test_truncated_dbf_is_an_error(spark, tmp_path):
    content = dbf_bytes(FIELDS, RECORDS, claimed=100)
    (tmp_path / "a.dbf").write_bytes(content[:-15])
    with pytest.raises(Exception, match="cut short: 3 of 100 records"):
        decode(spark, tmp_path).collect()
    complaints = decode(spark, tmp_path, keep_going=True).select("_erro").collect()
    assert [r["_erro"] for r in complaints] == ["cut short: 3 of 100 records"]


def test_wide_numbers_are_doubles_and_binary_types_are_refused(spark, tmp_path):
    (tmp_path / "a.dbf").write_bytes(dbf_bytes([("N", "N", 20)], [(" ", ["12345678901234567890"])]))
    fields = dbf.describe(spark, str(tmp_path))
    assert decode(spark, tmp_path, fields).first()["N"] == 12345678901234567890.0
    (tmp_path / "a.dbf").write_bytes(dbf_bytes([("I", "I", 4)], [(" ", ["abcd"])]))
    with pytest.raises(Exception, match="field I has the type I"):
        decode(spark, tmp_path, [dbf.Field("I")]).collect()


def test_fields_of_all_files_are_described(spark, tmp_path):
    (tmp_path / "a.dbf").write_bytes(dbf_bytes([("A", "C", 3), ("N", "N", 4)], [(" ", ["x", "12"])]))
    (tmp_path / "b.dbf").write_bytes(dbf_bytes([("A", "C", 3), ("NEW", "C", 2)], [(" ", ["y", "z"])]))
    (tmp_path / "c.dbf").write_bytes(b"no header")
    fields = dbf.describe(spark, str(tmp_path))
    assert [f.name for f in fields] == ["A", "N", "NEW"]
    found = decode(spark, tmp_path, fields, absent_is_null=True, keep_going=True)
    assert rows(found.filter("_erro is null").drop("_arquivo", "_erro")) == [
        ("x", 12, None),
        ("y", None, "z"),
    ]
    assert found.filter("_erro is not null").count() == 1


def test_dbf_text_of_all_bytes(spark, tmp_path):
    every = bytes(range(1, 256)).decode("latin-1")
    texts = [every[i : i + 51] for i in range(0, 255, 51)] + ["a\0b \0 ", "", "\0", "é", "ÿ\t"]
    content = dbf_bytes([("T", "C", 60)], [(" ", [t]) for t in texts])
    (tmp_path / "a.dbf").write_bytes(content)
    found = decode(spark, tmp_path, [dbf.Field("T")]).drop("_arquivo")
    assert rows(found) == sorted((t.rstrip(" \0"),) for t in texts)


def test_dbf_text_that_is_no_utf8_stops_the_job(spark, tmp_path):
    (tmp_path / "a.dbf").write_bytes(dbf_bytes([("T", "C", 3)], [(" ", ["é"])]))
    with pytest.raises(Exception, match="UTF8"):
        decode(spark, tmp_path, [dbf.Field("T")], "UTF-8").collect()


def test_dbf_types_and_subset_of_fields(spark, tmp_path):
    fields = [("D", "D", 8), ("L", "L", 1), ("N", "N", 5), ("N_2", "N", 6), ("C", "C", 3)]
    records = [
        (" ", ["20230105", "T", "-12", "1.50", "a"]),
        (" ", ["20230231", "?", "", "2,25", ""]),
    ]
    (tmp_path / "a.dbf").write_bytes(dbf_bytes(fields, records))
    described = dbf.describe(spark, str(tmp_path))
    assert described == [dbf.Field(n, k, None if n == "N" else 2 * n.endswith("_2")) for n, k, _ in fields]
    found = decode(spark, tmp_path, described).drop("_arquivo")
    assert [t for _, t in found.dtypes] == ["date", "boolean", "double", "double", "string"]
    assert rows(found) == [(date(2023, 1, 5), True, -12, 1.5, "a"), (None, None, None, 2.25, "")]
    subset = decode(spark, tmp_path, [dbf.Field("C"), dbf.Field("N", "N")]).drop("_arquivo")
    assert rows(subset) == [("", None), ("a", -12.0)]


def test_dbf_with_many_fields(spark, tmp_path):
    fields = [(f"F{i}", "C", 1 + i % 5) for i in range(113)]
    (tmp_path / "a.dbf").write_bytes(
        dbf_bytes(fields, [(" ", [str(i % 10) for i in range(113)])] * 3)
    )
    found = decode(spark, tmp_path, [dbf.Field(n) for n, _, _ in fields]).drop("_arquivo")
    assert rows(found) == [tuple(str(i % 10) for i in range(113))] * 3


def test_unexpected_dbf_fields_stop_the_job(spark, tmp_path):
    (tmp_path / "a.dbf").write_bytes(dbf_bytes(FIELDS, RECORDS))
    with pytest.raises(Exception, match="unexpected fields"):
        decode(spark, tmp_path, WANTED[:3], exact_fields=True).collect()
    with pytest.raises(Exception, match="unexpected fields"):
        decode(spark, tmp_path, [dbf.Field("OUTRO")]).collect()
    assert decode(spark, tmp_path, WANTED[:3]).count() == 3


def test_dbf_bytes_are_cut_in_batches_and_parsed_without_python(spark, tmp_path):
    (tmp_path / "a.dbf").write_bytes(dbf_bytes(FIELDS, RECORDS))
    text = plan(decode(spark, tmp_path))
    assert "MapInArrow" in text
    assert "EvalPython" not in text


def test_landed_files_by_name_and_year(spark, tmp_path):
    for name in ["2023/RDSP2301.dbc", "2023/RDSP2312.dbc", "2024/RDSP2301.dbc", "2023/outro.dbc"]:
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"x")
    for name in ["2023/2023.zip", "2024/2023.zip"]:
        (tmp_path / name).write_bytes(b"x")
    files = landing.landed_files(spark, str(tmp_path))
    assert "content" not in plan(files).split("ReadSchema")[-1]
    assert rows(landing.monthly_ledger(files).where(F.col("classe") == landing.FITS).select("ano", "mes")) == [(2023, 1), (2023, 12)]
    assert rows(landing.landed_years(files).select("ano")) == [(2023,)]


def test_tree_without_named_directories(spark, tmp_path):
    root = tmp_path / "sih"
    for year, month in [("2023", "01"), ("2023", "02"), ("2024", "01")]:
        spark.range(2).coalesce(1).write.parquet(str(root / year / month))
    df = tables.period_from_path(
        tables.with_source_path(tables.read_tree(spark, str(root))), "_arquivo"
    )
    assert rows(df.select("_ano", "_mes").distinct()) == [(2023, 1), (2023, 2), (2024, 1)]


def test_period_of_other_paths_is_null(spark):
    df = spark.createDataFrame([("/x/y",), ("/sih/ano=2023/mes=07/p.parquet",)], "p string")
    assert rows(tables.period_from_path(df, "p").select("_ano", "_mes")) == [(2023, 7), (None, None)]


def test_partition_values_keep_their_declared_type_and_prune(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "000"), (2, "A701")], "id int, codigo_estacao string")
    df.write.partitionBy("codigo_estacao").parquet(path)
    stored = tables.read_partitioned(spark, path, df.schema)
    assert rows(stored) == [(1, "000"), (2, "A701")]
    text = plan(stored.filter(F.col("codigo_estacao") == "000"))
    assert "PartitionFilters: [isnotnull(codigo_estacao" in text


def test_local_rows_have_the_declared_schema(spark):
    df = tables.local_rows(spark, [("b", None)], "z string, a double")
    assert df.columns == ["z", "a"]
    assert rows(df) == [("b", None)]
