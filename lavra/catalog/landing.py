"""Landed files derived from the given tables: text, archives and DBF.

Spark writes every file in parallel. A file holds at most ``ROWS_PER_FILE``
rows by construction, because its rows share the quotient of a unique id, so
their number grows with the tables and their size does not.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.catalog.dirty import events, orders, table
from lavra.operators.sets import union_by_name
from lavra.publish import Folders
from lavra.scratch import new_folder

ROWS_PER_FILE = 50_000

_written: dict[tuple[str, str, str], str] = {}


def once(spark: SparkSession, sf_dir: str, label: str, write: Callable[[str], None]) -> str:
    """Path of landed files, written at most once per application and input."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key in _written and Folders(spark, _written[key]).exists(_written[key]):
        return _written[key]
    path = new_folder(spark, label)
    write(path)
    _written[key] = path
    return path


def write_binary(files: DataFrame, path: str, folders: Sequence[str], end: str) -> None:
    """One file per row of ``files`` (``folders``, ``content``), followed by ``end``.

    The text sink writes the bytes of a string as they are, so a binary value
    cast to string lands unchanged.
    """
    rows = files.select(*folders, F.col("content").cast("string").alias("value"))
    rows.write.partitionBy(*folders).option("lineSep", end).text(path)


# ---- weather text ------------------------------------------------------------


def _preamble(station: str) -> list[Column]:
    """Eight descriptive lines and the header of a station file."""
    name = F.col(station)
    return [
        F.lit("REGIAO:;SE"),
        F.when(name == "click", F.lit("UF: ;MG")).otherwise(F.lit("UF:;SP")),
        F.concat(F.lit("ESTACAO:;ESTAÇÃO "), F.upper(name)),
        F.concat(F.lit("CODIGO (WMO):;A-"), name),
        F.concat(F.lit("LATITUDE:;-2"), F.length(name).cast("string"), F.lit(",5")),
        F.lit("LONGITUDE:; -46,62 "),
        F.when(name == "view", F.lit("ALTITUDE:;")).otherwise(F.lit("ALTITUDE:;785,64")),
        F.lit("DATA DE FUNDACAO:;2006-07-25"),
        F.lit("Data;Hora UTC;PRECIPITAÇÃO TOTAL, HORÁRIO (mm)"),
    ]


def _with_preamble(rows: DataFrame, station: str, keys: Sequence[str]) -> DataFrame:
    """Body lines (``ordem``, ``linha``) joined by the preamble of each file."""
    heads = rows.select(station, *keys).distinct()
    preamble = heads.select(
        station, *keys, F.posexplode(F.array(*_preamble(station))).alias("ordem", "linha")
    )
    body = rows.select(station, *keys, (F.col("ordem") + 9).alias("ordem"), "linha")
    return preamble.withColumn("ordem", F.col("ordem").cast("long")).unionByName(body)


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as one line of a station file; some lines are short, some long."""
    key = F.col("event_id")
    fields = [
        F.col("data"),
        F.col("hora_utc"),
        F.col("precipitacao_mm"),
        key.cast("string"),
        F.col("pressao_max_mb"),
        F.col("pressao_min_mb"),
    ]
    line = F.concat_ws(";", *fields)
    rows = events(spark, sf_dir).select(
        "event_type",
        F.floor(key / ROWS_PER_FILE).alias("bloco"),
        key.alias("ordem"),
        F.when(key % 3 == 0, F.concat(line, F.repeat(F.lit(";7"), 13), F.lit(";sobra;")))
        .otherwise(line)
        .alias("linha"),
    )
    return _with_preamble(rows, "event_type", ["bloco"])


def hourly_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per event type and hour: the events of that hour, added up."""
    hour = F.date_trunc("hour", "ts")
    cents = F.sum(F.floor(F.col("value") * 100).cast("long"))
    hourly = (
        table(spark, sf_dir, "events")
        .groupBy("event_type", hour.alias("hora"))
        .agg(cents.alias("cents"), F.count(F.lit(1)).alias("n"))
    )
    line = F.concat_ws(
        ";",
        F.date_format("hora", "yyyy/MM/dd"),
        F.concat(F.date_format("hora", "HH"), F.lit("00 UTC")),
        F.concat(
            F.floor(F.col("cents") / 100).cast("string"),
            F.lit(","),
            F.lpad((F.col("cents") % 100).cast("string"), 2, "0"),
        ),
        F.col("n").cast("string"),
        F.lit(";;;;;;;;;;;;;"),
    )
    rows = hourly.select(
        "event_type",
        F.date_format("hora", "yyyy").alias("bloco"),
        F.unix_timestamp("hora").alias("ordem"),
        line.alias("linha"),
    )
    return _with_preamble(rows, "event_type", ["bloco"])


def write_text_files(lines: DataFrame, path: str, keys: Sequence[str]) -> None:
    """One latin-1 file per tuple of ``keys``, its lines in order."""
    (
        lines.repartition(*keys)
        .sortWithinPartitions(*keys, "ordem")
        .select(*keys, "linha")
        .write.partitionBy(*keys)
        .option("encoding", "ISO-8859-1")
        .option("sep", "\u0001")
        .option("quote", "")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(path)
    )


def zipped(lines: DataFrame, label: str) -> DataFrame:
    """One archive per block, one member per station, and two that do not match."""

    def pack(block: pd.DataFrame) -> pd.DataFrame:
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
            for i, (station, rows) in enumerate(sorted(block.groupby("event_type"))):
                folder = "" if i % 2 else "2024/"
                suffix = "csv" if i % 3 else "CSV"
                text = "\r\n".join(rows.sort_values("ordem")["linha"]) + "\r\n"
                archive.writestr(
                    f"{folder}INMET_SE_SP_{station.upper()}_.{suffix}", text.encode("latin-1")
                )
            archive.writestr("2024/INMET_NE_BA_A401_.CSV", "REGIAO:;NE\n")
            archive.writestr("LEIAME.txt", "INMET_SE_SP")
        name = f"{label}{block['bloco'].iloc[0]}.zip"
        return pd.DataFrame({"pasta": [name], "content": [buffer.getvalue()]})

    return lines.groupBy("bloco").applyInPandas(pack, "pasta string, content binary")


GOOD_YEAR, MISSING_YEAR, DAMAGED_YEAR, SHORT_YEAR = 2021, 2022, 2023, 2024


def yearly_series(spark: SparkSession, sf_dir: str) -> str:
    """Archives ``yyyy/yyyy.zip`` of the hourly lines, moved to three years: whole, with a damaged member, one member short.

    Members are stored as they are, so a changed byte shows in the checksum alone.
    """
    lines = hourly_lines(spark, sf_dir)
    years = F.explode(F.array(*map(F.lit, (GOOD_YEAR, DAMAGED_YEAR, SHORT_YEAR)))).alias("ano")
    moved = lines.select("event_type", "ordem", "linha", years).filter(f"not (ano = {SHORT_YEAR} and event_type = 'view')")
    moved = moved.withColumn("linha", F.regexp_replace("linha", F.lit(r"^\d{4}/"), F.concat(F.col("ano").cast("string"), F.lit("/"))))

    def pack(block: pd.DataFrame) -> pd.DataFrame:
        year = int(block["ano"].iloc[0])
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_STORED) as archive:
            for station, rows in sorted(block.groupby("event_type")):
                text = "\r\n".join(rows.sort_values("ordem")["linha"]) + "\r\n"
                archive.writestr(f"{year}/INMET_SE_SP_{station.upper()}_.CSV", text.encode("latin-1"))
            last = archive.infolist()[-1]
        content = bytearray(buffer.getvalue())
        if year == DAMAGED_YEAR:
            content[last.header_offset + last.file_size // 2] ^= 1
        return pd.DataFrame({"ano": [year], "arquivo": [f"{year}.zip"], "content": [bytes(content)]})

    files = moved.groupBy("ano").applyInPandas(pack, "ano int, arquivo string, content binary")

    def write(path: str) -> None:
        write_binary(files, f"{path}/raw", ["ano", "arquivo"], "\n")
        folders = Folders(spark, path)
        for year in (GOOD_YEAR, DAMAGED_YEAR, SHORT_YEAR):
            folders.rename(f"{path}/raw/ano={year}/arquivo={year}.zip", f"{path}/{year}/{year}.zip")

    return once(spark, sf_dir, "yearly-series", write)


def event_files(spark: SparkSession, sf_dir: str) -> str:
    lines = event_lines(spark, sf_dir)
    return once(
        spark, sf_dir, "texts", lambda path: write_text_files(lines, path, ["event_type", "bloco"])
    )


def event_archives(spark: SparkSession, sf_dir: str) -> str:
    files = zipped(event_lines(spark, sf_dir), "B")
    return once(spark, sf_dir, "archives", lambda path: write_binary(files, path, ["pasta"], "\n"))


def hourly_archives(spark: SparkSession, sf_dir: str) -> str:
    """One archive per year; its size is bounded by the hours of the year."""
    files = zipped(hourly_lines(spark, sf_dir), "")
    return once(spark, sf_dir, "hourly", lambda path: write_binary(files, path, ["pasta"], "\n"))


# ---- DBF ---------------------------------------------------------------------


def _little_endian(number: Column, size: int) -> Column:
    digits = F.lpad(F.hex(number.cast("long")), 2 * size, "0")
    return F.concat(*(F.substring(digits, 2 * i + 1, 2) for i in reversed(range(size))))


def dbf_content(
    rows: DataFrame, keys: Sequence[str], fields: Sequence[tuple[str, str, int]], encoding: str
) -> DataFrame:
    """One DBF per key tuple from text columns, as (``keys``, ``content``).

    Deleted records are marked by the boolean column ``apagado``. A group holds
    at most ``ROWS_PER_FILE`` rows, so the list of its records is bounded.
    """
    record_bytes = 1 + sum(size for _, _, size in fields)
    header_bytes = 32 + 32 * len(fields) + 1

    def padded(name: str, kind: str, size: int) -> Column:
        value = F.encode(F.coalesce(F.col(name), F.lit("")), encoding)
        fill = F.encode(F.repeat(F.lit(" "), F.lit(size) - F.octet_length(value)), encoding)
        return F.concat(fill, value) if kind == "N" else F.concat(value, fill)

    flag = F.encode(F.when(F.col("apagado"), "*").otherwise(" "), encoding)
    record = F.concat(flag, *(padded(*field) for field in fields))
    descriptors = "".join(
        name.encode().ljust(11, b"\0").hex()
        + kind.encode().hex()
        + "00" * 4
        + f"{size:02x}"
        + "00" * 15
        for name, kind, size in fields
    )
    header = F.concat(
        F.lit("03180101"),
        _little_endian(F.col("n"), 4),
        _little_endian(F.lit(header_bytes), 2),
        _little_endian(F.lit(record_bytes), 2),
        F.lit("00" * 20 + descriptors + "0D"),
    )
    # Records travel as hexadecimal text, which joins without regard to encoding.
    return (
        rows.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"), F.collect_list(F.hex(record)).alias("records"))
        .select(*keys, F.unhex(F.concat(header, F.array_join("records", ""))).alias("content"))
    )


CUSTOMER_FIELDS = [
    ("CD_MUN", "C", 14),
    ("NM_MUN", "C", 40),
    ("SIGLA_UF", "C", 2),
    ("AREA_KM2", "N", 14),
]

ORDER_FIELDS = [
    ("CHAVE", "N", 18),
    ("MUNIC_RES", "C", 12),
    ("DT_INTER", "C", 8),
    ("DT_SAIDA", "C", 8),
    ("NASC", "C", 8),
    ("DIAG_PRINC", "C", 16),
]


def customer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as municipalities; every fifth has no area, every eleventh is deleted."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.floor(key / ROWS_PER_FILE).alias("bloco"),
        (key % 11 == 0).alias("apagado"),
        F.concat(F.lit("35"), F.lpad(key.cast("string"), 12, "0")).alias("CD_MUN"),
        F.concat(F.lit(" Município é "), F.col("c_name"), F.lit(" ")).alias("NM_MUN"),
        F.lit("SP").alias("SIGLA_UF"),
        F.when(key % 5 == 0, "")
        .otherwise(F.format_string("%d.25", F.floor(F.abs("c_acctbal")).cast("long")))
        .alias("AREA_KM2"),
    )


def municipality_files(spark: SparkSession, sf_dir: str) -> str:
    files = dbf_content(customer_rows(spark, sf_dir), ["bloco"], CUSTOMER_FIELDS, "UTF-8")
    return once(spark, sf_dir, "dbf", lambda path: write_binary(files, path, ["bloco"], "\u001a"))


def municipality_archives(spark: SparkSession, sf_dir: str) -> str:
    """Each DBF in an archive of its own, beside a member that is not a DBF."""

    def pack(frames):
        for frame in frames:
            packed = []
            for content in frame["content"]:
                buffer = io.BytesIO()
                with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                    archive.writestr("SP_Municipios.dbf", content)
                    archive.writestr("SP_Municipios.prj", "GEOGCS")
                packed.append(buffer.getvalue())
            yield pd.DataFrame({"bloco": frame["bloco"], "content": packed})

    files = dbf_content(customer_rows(spark, sf_dir), ["bloco"], CUSTOMER_FIELDS, "UTF-8")
    archives = files.mapInPandas(pack, "bloco long, content binary")
    return once(spark, sf_dir, "dbf-zip", lambda path: write_binary(archives, path, ["bloco"], "\n"))


def yearly_files(spark: SparkSession, sf_dir: str) -> str:
    """A file ``ano=yyyy/arquivo=yyyy.zip`` for every year with orders but 1996."""
    years = orders(spark, sf_dir).filter(F.col("ano") != 1996).select("ano").distinct()
    files = years.select(
        "ano",
        F.concat(F.col("ano").cast("string"), F.lit(".zip")).alias("arquivo"),
        F.encode(F.lit("x"), "UTF-8").alias("content"),
    )
    return once(
        spark, sf_dir, "yearly", lambda path: write_binary(files, path, ["ano", "arquivo"], "\n")
    )


def damaged_admission_files(spark: SparkSession, sf_dir: str) -> str:
    """The monthly files again, strays among them; those of February are cut short by a few bytes."""
    keys = ["ano", "arquivo", "bloco"]
    whole = F.length("content")
    short = F.col("arquivo").endswith("02.dbc")
    files = _with_strays(_admission_content(spark, sf_dir)).withColumn(
        "content", F.when(short, F.substring(F.col("content"), F.lit(1), whole - 9)).otherwise(F.col("content"))
    )
    return once(
        spark, sf_dir, "admissions-cut", lambda path: write_binary(files, path, keys, "\u001a")
    )


def admission_files(spark: SparkSession, sf_dir: str) -> str:
    """Monthly DBF files ``ano=yyyy/arquivo=RDSPyymm.dbc/bloco=n/`` and strays; no file for May."""
    files, keys = _with_strays(_admission_content(spark, sf_dir)), ["ano", "arquivo", "bloco"]
    return once(spark, sf_dir, "admissions", lambda path: write_binary(files, path, keys, "\u001a"))


def _with_strays(files: DataFrame) -> DataFrame:
    """The files, and three months that land again: in a wrong folder, under a strange name, and as a second file."""
    def again(name: str, year: int, landed: str) -> DataFrame:
        return files.filter(F.col("arquivo") == name).withColumns({"ano": F.lit(year), "arquivo": F.lit(landed)})

    strays = (
        again("RDSP9703.dbc", 1996, "RDSP9703.dbc"),
        again("RDSP9804.dbc", 1998, "LEIAME.dbc"),
        again("RDSP9906.dbc", 1999, "rdsp9906.DBC"),
    )
    return union_by_name([files, *(stray.select(*files.columns) for stray in strays)])


def whole_admission_files(spark: SparkSession, sf_dir: str) -> str:
    """The same for every month that has orders."""
    files, keys = _admission_content(spark, sf_dir, missing=0), ["ano", "arquivo", "bloco"]
    return once(spark, sf_dir, "admissions-whole", lambda path: write_binary(files, path, keys, "\u001a"))


def _admission_content(spark: SparkSession, sf_dir: str, missing: int = 5) -> DataFrame:
    key = F.col("o_orderkey")
    rows = (
        orders(spark, sf_dir)
        .filter(F.col("mes") != missing)
        .withColumns(
            {
                "CHAVE": key.cast("string"),
                "apagado": key % 101 == 0,
                "bloco": F.floor(key / ROWS_PER_FILE),
                "arquivo": F.concat(
                    F.lit("RDSP"),
                    F.lpad((F.col("ano") % 100).cast("string"), 2, "0"),
                    F.lpad(F.col("mes").cast("string"), 2, "0"),
                    F.lit(".dbc"),
                ),
            }
        )
    )
    return dbf_content(rows, ["ano", "arquivo", "bloco"], ORDER_FIELDS, "ISO-8859-1")
