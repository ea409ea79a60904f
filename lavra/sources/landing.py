"""Which files have landed, from the listing alone; no content is read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lavra.sources.ranges import listed

# In any case: year/RDSPyymm.dbc, its unpacked form with .dbf, and year/year.zip; directories may be named (ano=2023).
MONTHLY_FILE = r"(?i)/(?:[^/=]+=)?(\d{4})/(?:[^/=]+=)?RDSP(\d{2})(\d{2})\.dbc(?:/|$)"
MONTHLY_TABLE = MONTHLY_FILE.replace("dbc", "dbf")
YEARLY_FILE = r"(?i)/(?:[^/=]+=)?(\d{4})/(?:[^/=]+=)?(\d{4})\.zip(?:/|$)"


def landed_files(spark: SparkSession, root: str) -> DataFrame:
    return listed(spark, root, F.col("path").alias("arquivo"))


FITS, UNKNOWN_NAME, WRONG_FOLDER, SECOND_FILE = "fits", "unknown name", "wrong folder", "second file of its period"


def monthly_ledger(files: DataFrame, pattern: str = MONTHLY_FILE, path: str = "arquivo") -> DataFrame:
    """Every file, whatever it is, with exactly one ``classe``: nothing that landed is passed over.

    A file fits if its name is that of a month and its two-digit year that of
    its directory. Of several files with one month in their name that fit, the first by path does,
    and the others are second files. ``ano`` and ``mes`` are those of the name (the century that of
    the directory); they are NULL for an unknown name. A file may lie in pieces below its name.
    """
    year, short = F.regexp_extract(path, pattern, 1), F.regexp_extract(path, pattern, 2)
    month = F.regexp_extract(path, pattern, 3).try_cast("int")
    known = F.col(path).rlike(pattern) & month.between(1, 12)
    whole = F.regexp_extract(path, r"(?i)^(.*\.(?:dbc|dbf))", 1)
    named = files.select(
        *files.columns,
        F.when(known, F.concat(F.substring(year, 1, 2), short).try_cast("int")).alias("ano"),
        F.when(known, month).alias("mes"),
        known.alias("_known"),
        (F.substring(year, 3, 2) == short).alias("_placed"),
        whole.alias("_whole"),
    )
    # A calendar has few files a month, so a month is a small group; a file of no month is its own.
    alone = F.when(~F.col("_known"), F.col(path))
    first = F.min(F.when(F.col("_placed"), F.col("_whole"))).over(Window.partitionBy("ano", "mes", alone))
    found = (
        F.when(~F.col("_known"), UNKNOWN_NAME)
        .when(~F.col("_placed"), WRONG_FOLDER)
        .when(F.col("_whole") != F.col("_first"), SECOND_FILE)
        .otherwise(FITS)
    )
    return named.withColumn("_first", first).select("ano", "mes", *files.columns, found.alias("classe"))


def landed_years(files: DataFrame, pattern: str = YEARLY_FILE) -> DataFrame:
    """``ano`` and path of the yearly files, where file and directory agree."""
    year = F.regexp_extract("arquivo", pattern, 1)
    return files.filter(
        F.col("arquivo").rlike(pattern) & (year == F.regexp_extract("arquivo", pattern, 2))
    ).select(year.try_cast("int").alias("ano"), "arquivo")
