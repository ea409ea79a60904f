"""The municipality dimension: attributes, short code and mean vertex."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra import contracts as C
from lavra.functions.text import code_prefix
from lavra.operators import quality as Q
from lavra.operators.aggregates import vertex_mean
from lavra.operators.clean import trim_columns
from lavra.scratch import materialize
from lavra.sinks import write_table
from lavra.sources.archive import extract_members, list_archives, list_members, member_count_check
from lavra.sources.dbf import Field, decode_dbf


def read_attributes(spark: SparkSession, archive: str) -> DataFrame:
    """Attributes from the one DBF in the archive, whose field list is exact."""
    members = list_members(spark, archive)
    Q.enforce(member_count_check(list_archives(spark, archive), members, ".dbf"))
    kinds = {"AREA_KM2": "N"}
    fields = [Field(name, kinds.get(name, "C")) for name in C.MUNICIPALITY_FIELDS]
    files = extract_members(spark, archive, r"\.DBF$")
    return decode_dbf(files, fields, "UTF-8", exact_fields=True).select(*C.MUNICIPALITY_FIELDS)


def build(attributes: DataFrame, vertices: DataFrame) -> DataFrame:
    """The seven dimension columns. A municipality without vertices is kept.

    ``vertices`` has ``CD_MUN``, ``x`` and ``y``: one row per vertex of every
    ring, closing points included.
    """
    centres = vertex_mean(trim_columns(vertices, ["CD_MUN"]), "CD_MUN", "x", "y")
    return (
        trim_columns(attributes, ["CD_MUN", "NM_MUN", "SIGLA_UF"])
        .withColumn("CD_MUN_6", code_prefix(F.col("CD_MUN")))
        .join(centres, on="CD_MUN", how="left")
        .select(*C.MUNICIPALITY_SILVER_COLUMNS)
    )


def checks(
    count: int = C.MUNICIPALITY_COUNT,
    state: str = C.MUNICIPALITY_STATE,
    prefix: str = C.MUNICIPALITY_PREFIX,
) -> list[Q.Check]:
    """In the order in which they stop the job."""
    return [
        Q.row_count("municipalities", count),
        Q.unique_count("distinct CD_MUN", ["CD_MUN"], count),
        Q.unique_count("distinct CD_MUN_6", ["CD_MUN_6"], count),
        Q.not_blank("without CD_MUN", "CD_MUN"),
        Q.not_blank("without CD_MUN_6", "CD_MUN_6"),
        Q.not_blank("without NM_MUN", "NM_MUN"),
        Q.not_blank("without SIGLA_UF", "SIGLA_UF"),
        Q.not_null("without latitude", "latitude"),
        Q.not_null("without longitude", "longitude"),
        Q.only_value(f"state other than {state}", "SIGLA_UF", state),
        Q.only_prefix(f"code outside {prefix}", "CD_MUN_6", prefix),
    ]


def run(
    attributes: DataFrame,
    vertices: DataFrame,
    path: str,
    required: list[Q.Check] | None = None,
) -> DataFrame:
    """Build, check, and only then write. Returns the check frame."""
    built = materialize(build(attributes, vertices), "municipalities")
    results = materialize(Q.evaluate(built, checks() if required is None else required), "municipality-checks")
    Q.enforce(results)
    write_table(built, path)
    return results
