"""The monthly hospital admissions, enriched with the municipality of residence."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra import contracts as C
from lavra.operators import quality as Q
from lavra.operators.clean import blanks_to_null, parse_dates
from lavra.operators.lookup import keep_matched, lookup_left, match_counts
from lavra.operators.sets import union_by_name
from lavra.scratch import materialize, new_folder
from lavra.publish import Folders, publish, stage_rows
from lavra.sinks import write_table
from lavra.sources.dbf import Field, read_dbf
from lavra.sources.landing import FITS, MONTHLY_TABLE, monthly_ledger
from lavra.sources.ranges import list_files

PERIOD = ["ano", "mes"]


@dataclass(frozen=True)
class Enrichment:
    """Which columns are dates, and how fact and dimension fit together."""

    date_columns: Sequence[str] = tuple(C.ADMISSION_DATE_COLUMNS)
    fact_key: str = C.ADMISSION_KEY
    dimension_key: str = "CD_MUN_6"
    columns: Sequence[str] = ("NM_MUN", "SIGLA_UF", "AREA_KM2")
    present: str = "NM_MUN"


def stage_dbf(
    spark: SparkSession, path: str | DataFrame, fields: Sequence[Field], keep_going: bool = False
) -> DataFrame:
    """Landed DBF files as a Parquet table in the shared folder.

    Fixed-width files are decoded once; all later passes read only the columns
    they need. Tasks read ranges of whole records, so that one large month is
    decoded by many of them. A field that a month lacks is NULL there.
    """
    rows = read_dbf(spark, path, fields, "ISO-8859-1", keep_going=keep_going, absent_is_null=True)
    staged = new_folder(spark, "admissions")
    write_table(rows, staged, codec="snappy")
    return spark.read.schema(rows.schema).parquet(staged)


def stage_months(
    spark: SparkSession, path: str | DataFrame, fields: Sequence[Field], pattern: str = MONTHLY_TABLE
) -> tuple[DataFrame, DataFrame]:
    """All landed months: their rows, and the periods that could not be read.

    Rows carry ``ano`` and ``mes`` of their file; an unreadable period has
    ``ano``, ``mes`` and ``motivo``. Every landed file is accounted for: one that lies in the wrong
    folder or comes second makes its period unreadable, one of an unknown name is an unreadable period
    without ``ano`` and ``mes``. Both come from one staged table and the ledger of the files, which
    are listed once, or not at all if ``path`` is their listing.
    """
    files = list_files(spark, path)
    staged = stage_dbf(spark, files, fields, keep_going=True)
    ledger = materialize(monthly_ledger(files.select("_arquivo"), pattern, "_arquivo"), "ledger")
    # One row per file.
    fitting = ledger.where(F.col("classe") == FITS).select("_arquivo", *PERIOD)
    dated = staged.join(fitting, "_arquivo")
    rows = dated.filter(F.col("_erro").isNull()).drop("_erro", "_arquivo")
    unreadable = dated.filter(F.col("_erro").isNotNull()).select(*PERIOD, F.col("_erro").alias("motivo"))
    misplaced = ledger.where(F.col("classe") != FITS).select(*PERIOD, F.col("classe").alias("motivo"))
    return rows, unreadable.unionByName(misplaced).distinct()


def clean(raw: DataFrame, spec: Enrichment = Enrichment()) -> DataFrame:
    """Blank texts to NULL, then the date columns from text to dates."""
    return parse_dates(blanks_to_null(raw), spec.date_columns)


def counts(
    cleaned: DataFrame,
    dimension: DataFrame,
    spec: Enrichment = Enrichment(),
    by: Iterable[str] = (),
) -> DataFrame:
    return match_counts(
        cleaned, dimension, spec.fact_key, spec.dimension_key, spec.present, by
    )


def conservation_checks() -> list[Q.Check]:
    """The join may neither add nor lose rows."""
    return [
        Q.Check("rows added by the join", F.sum(F.col("after_join") - F.col("total"))),
        Q.Check(
            "rows neither matched nor unmatched",
            F.sum(F.col("total") - F.col("matched") - F.col("unmatched")),
        ),
    ]


def enrich(
    cleaned: DataFrame, dimension: DataFrame, spec: Enrichment = Enrichment()
) -> DataFrame:
    """Rows of known municipalities, with the dimension columns."""
    joined = lookup_left(cleaned, dimension, spec.fact_key, spec.dimension_key, spec.columns)
    return keep_matched(joined, spec.present)


def run(
    raw: DataFrame, dimension: DataFrame, path: str, spec: Enrichment = Enrichment()
) -> DataFrame:
    """One period. Returns the match counts; raises before writing on a bad join."""
    cleaned = clean(raw, spec)
    counted = materialize(counts(cleaned, dimension, spec), "match-counts")
    Q.enforce(Q.evaluate(counted, conservation_checks()))
    # Written aside and counted on the way, before it is put in place of what is there.
    spark, (base, _, name) = raw.sparkSession, path.rstrip("/").rpartition("/")
    staged = stage_rows(enrich(cleaned, dimension, spec), base)
    stored = spark.range(1).select(F.lit(staged.rows).alias("stored"))
    try:
        Q.enforce(Q.evaluate(stored, [Q.Check("stored rows", F.max("stored"), counted.first()["matched"])]))
    except Q.QualityError:
        Folders(spark, base).delete(staged.folder)
        raise
    publish(spark, base, staged, {"": name})
    return counted


def period_status(results: DataFrame, expected: DataFrame) -> DataFrame:
    """``OK`` or ``ERRO`` with the reason, for each expected period and any other that has landed."""
    reason = F.min(
        F.when(
            ~F.col("passed"),
            F.struct("position", F.concat_ws(": ", "check", F.col("observed").cast("string"))),
        )
    )["col2"]
    judged = results.groupBy(*PERIOD).agg(reason.alias("motivo"), F.lit(True).alias("__landed"))
    return (
        expected.select(*PERIOD, F.lit(True).alias("__expected"))
        .join(judged, PERIOD, "full")
        .select(
            *PERIOD,
            F.when(F.col("__expected") & F.col("__landed") & F.col("motivo").isNull(), "OK")
            .otherwise("ERRO")
            .alias("status"),
            F.when(F.col("ano").isNull(), F.col("motivo"))
            .when(F.col("__expected").isNull(), "period not expected")
            .when(F.col("__landed").isNull(), "no rows landed")
            .otherwise(F.col("motivo"))
            .alias("motivo"),
        )
    )


def run_periods(
    raw: DataFrame,
    dimension: DataFrame,
    path: str,
    expected: DataFrame,
    spec: Enrichment = Enrichment(),
    extra_checks: Sequence[Q.Check] = (),
    unreadable: DataFrame | None = None,
) -> DataFrame:
    """All periods in one job; a bad period is not written and stops no other.

    ``raw`` carries ``ano`` and ``mes``. Returns one status row per expected
    period. Only passing periods are written; the others keep what they had. A
    period in ``unreadable`` (``ano``, ``mes``, ``motivo``) has failed already.
    A passing period without a known municipality ends up empty, even if it
    held rows before; one that is landed but not expected is an error. Periods are written aside, each is
    compared with its matched rows, and those that agree are put in place by renames.
    """
    cleaned = clean(raw, spec)
    counted = materialize(counts(cleaned, dimension, spec, PERIOD), "match-counts")
    judged = [Q.evaluate(counted, conservation_checks(), PERIOD)]
    if extra_checks:
        extra = Q.evaluate(cleaned, extra_checks, PERIOD)
        judged.append(extra.withColumn("position", F.col("position") + len(conservation_checks())))
    if unreadable is not None:
        judged.append(
            unreadable.select(
                *PERIOD,
                F.lit(-1).alias("position"),
                F.col("motivo").alias("check"),
                F.lit(None).cast("long").alias("observed"),
                F.lit(None).cast("long").alias("expected"),
                F.lit(False).alias("passed"),
            )
        )
    status = materialize(period_status(union_by_name(judged), expected), "period-status")
    passing = status.filter(F.col("status") == "OK").select(*PERIOD)
    accepted = cleaned.join(passing, PERIOD, "left_semi")
    staged = stage_rows(enrich(accepted, dimension, spec), path, PERIOD)
    # The stored rows of a period are counted from the footers. There is a row per period of a calendar.
    stored = staged.table.groupBy(*PERIOD).agg(F.count(F.lit(1)).alias("stored"))
    matched = counted.select(*PERIOD, "matched").join(passing, PERIOD, "left_semi")
    audit = matched.join(stored, PERIOD, "full").select(
        *PERIOD, *(F.coalesce(n, F.lit(0)).alias(n) for n in ("matched", "stored"))
    )
    found = audit.collect()
    if sum(period["stored"] for period in found) != staged.rows:
        raise Q.QualityError(f"{staged.rows} rows were written, {sum(p['stored'] for p in found)} are stored")
    agreed = {f"ano={p['ano']}/mes={p['mes']}": p["stored"] for p in found if p["stored"] == p["matched"]}
    kept = {name: name for name, rows in agreed.items() if rows}
    publish(raw.sparkSession, path, staged, kept, [name for name, rows in agreed.items() if not rows])
    lost = [(p["ano"], p["mes"], f"stored rows: {p['stored']} of {p['matched']}") for p in found if p["stored"] != p["matched"]]
    if not lost:
        return status
    lost = raw.sparkSession.createDataFrame(lost, "ano int, mes int, perda string")
    return status.join(lost, PERIOD, "left").select(
        *PERIOD,
        F.when(F.col("perda").isNull(), F.col("status")).otherwise("ERRO").alias("status"),
        F.coalesce("perda", "motivo").alias("motivo"),
    )
