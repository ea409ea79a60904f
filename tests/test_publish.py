"""Tables change by renames that survive a crash, and only after an audit."""

import pytest
from pyspark.sql import functions as F

from lavra import publish, sinks
from lavra.operators import periods
from lavra.plans import admissions
from lavra.sources import landing
from lavra.sources.dbf import Field
from tests.helpers import dbf_bytes, rows

SCHEMA = "ano int, mes int, v string"


def stored(spark, path):
    return rows(spark.read.parquet(path).select("ano", "mes", "v"))


class Crash(Exception):
    pass


def crash_after(monkeypatch, renames):
    """The manifest is put in place by the first rename; the others move folders."""
    real, done = publish.Folders.rename, []

    def rename(self, old, new):
        if len(done) == renames:
            raise Crash
        done.append(new)
        real(self, old, new)

    monkeypatch.setattr(publish.Folders, "rename", rename)


@pytest.mark.parametrize("renames", [0, 1, 2, 3])
def test_a_crash_between_renames_is_recovered(spark, tmp_path, monkeypatch, renames):
    path = str(tmp_path / "t")
    old = [(2023, 1, "a"), (2023, 2, "b"), (2023, 3, "c"), (2024, 1, "d")]
    new = [(2023, 1, "A"), (2023, 2, "B"), (2025, 1, "E")]
    sinks.write_periods(spark.createDataFrame(old, SCHEMA), path)
    with monkeypatch.context() as patched:
        crash_after(patched, renames)
        with pytest.raises(Crash):
            sinks.write_periods(spark.createDataFrame(new, SCHEMA), path)
    assert publish.recover(spark, path) == ((0, 1) if renames == 0 else (1, 0))
    assert stored(spark, path) == sorted(old if renames == 0 else [*old[2:], *new])
    assert publish.recover(spark, path) == (0, 0)
    assert publish.Folders(spark, path).children(f"{path}/{publish.STAGED}") == []


def test_a_crash_between_removal_and_rename_is_recovered(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    sinks.write_periods(spark.createDataFrame([(2023, 1, "a")], SCHEMA), path)
    staged = publish.stage_rows(spark.createDataFrame([(2023, 1, "A")], SCHEMA), path, ["ano", "mes"])
    assert staged.rows == 1
    with monkeypatch.context() as patched:
        patched.setattr(publish.Folders, "delete", lambda self, where: (_ for _ in ()).throw(Crash()))
        with pytest.raises(Crash):
            publish.publish(spark, path, staged, {"ano=2023/mes=1": "ano=2023/mes=1"}, ["ano=2022/mes=9"])
    # Old rows are read until the folder is replaced; staged ones are no data.
    assert stored(spark, path) == [(2023, 1, "a")]
    assert publish.recover(spark, path) == (1, 0)
    assert stored(spark, path) == [(2023, 1, "A")]


def test_rows_are_counted_while_they_are_written(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "id % 7 as ano", "id % 2 as mes")
    staged = publish.stage_rows(df, str(tmp_path), ["ano", "mes"])
    assert staged.rows == 1000 == staged.table.count()
    assert publish.recover(spark, str(tmp_path)) == (0, 1)


FACT = "MUNIC_RES string, DT_INTER string, DT_SAIDA string, NASC string, DIAG_PRINC string, ano int, mes int"


def test_stored_rows_are_compared_with_matched_ones(spark, tmp_path, monkeypatch):
    """A period that loses rows on its way to the disk keeps what it had."""
    dimension = spark.createDataFrame([("352900", "Marília", "SP", 1.0)], "CD_MUN_6 string, NM_MUN string, SIGLA_UF string, AREA_KM2 double")
    raw = spark.createDataFrame([("352900", "20230105", "", "", d, 2023, m) for m in (1, 2) for d in ("A", "B")], FACT)
    expected = periods.month_spine(spark, *periods.month_range(2023, 1, 2023, 2, 2008))
    path = str(tmp_path / "t")
    admissions.run_periods(raw, dimension, path, expected)
    real = admissions.stage_rows
    monkeypatch.setattr(admissions, "stage_rows", lambda df, *a, **k: real(df.where("not (mes = 2 and DIAG_PRINC = 'B')"), *a, **k))
    more = raw.unionByName(raw.where("mes = 1"))
    assert rows(admissions.run_periods(more, dimension, path, expected)) == [
        (2023, 1, "OK", None),
        (2023, 2, "ERRO", "stored rows: 1 of 2"),
    ]
    assert rows(spark.read.parquet(path).groupBy("mes").count()) == [(1, 4), (2, 2)]
    # A period that loses all its matches on a rerun is emptied.
    monkeypatch.setattr(admissions, "stage_rows", real)
    strange = raw.withColumn("MUNIC_RES", F.when(F.col("mes") == 2, "999999").otherwise(F.col("MUNIC_RES")))
    admissions.run_periods(strange, dimension, path, expected)
    assert rows(spark.read.parquet(path).groupBy("mes").count()) == [(1, 2)]


def test_every_landed_file_has_a_class(spark, tmp_path):
    names = {
        "2023/RDSP2301.dbf": (2023, 1, landing.FITS),
        "2023/rdsp2301.DBF": (2023, 1, landing.SECOND_FILE),
        "2023/RDSP2402.dbf": (2024, 2, landing.WRONG_FOLDER),
        "2024/RDSP2402.dbf": (2024, 2, landing.FITS),
        "2024/RDSP2413.dbf": (None, None, landing.UNKNOWN_NAME),
        "2024/notes.txt": (None, None, landing.UNKNOWN_NAME),
        "ano=2025/arquivo=RDSP2501.dbf/bloco=0/a": (2025, 1, landing.FITS),
        "ano=2025/arquivo=RDSP2501.dbf/bloco=1/a": (2025, 1, landing.FITS),
    }
    files = spark.createDataFrame([(f"/x/{name}",) for name in names], "arquivo string")
    found = landing.monthly_ledger(files, landing.MONTHLY_TABLE).collect()
    assert {r["arquivo"][3:]: (r["ano"], r["mes"], r["classe"]) for r in found} == names and len(found) == len(names)


def test_misplaced_files_are_reported(spark, tmp_path):
    folder = tmp_path / "landing" / "2023"
    folder.mkdir(parents=True)
    good = dbf_bytes([("MUNIC_RES", "C", 6)], [(" ", ["352900"])] * 3)
    for name in ("RDSP2301.dbf", "RDSP2302.dbf", "rdsp2302.DBF", "RDSP2405.dbf", "notes.txt"):
        (folder / name).write_bytes(good)
    found, unreadable = admissions.stage_months(spark, str(tmp_path / "landing"), [Field("MUNIC_RES")])
    assert rows(found.groupBy("ano", "mes").count()) == [(2023, 1, 3), (2023, 2, 3)]
    assert rows(unreadable) == [
        (2023, 2, landing.SECOND_FILE),
        (2024, 5, landing.WRONG_FOLDER),
        (None, None, landing.UNKNOWN_NAME),
    ]
