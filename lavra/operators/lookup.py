"""Joining a fact table to a dimension, whatever the size or skew of either."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A dimension is broadcast only when its measured size is at most this.
BROADCAST_BYTES = 64 * 1024 * 1024

# A key is hot when it holds more than 1/64 of the fact rows, so there are
# never more than 63 hot keys.
HOT_PARTS = 64


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows of ``df``, summed over the data itself."""

    def width(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(value), F.lit(0)) + 8
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.coalesce(F.octet_length(F.to_json(F.struct(value))), F.lit(0)) + 8
        return F.lit(16)

    row = sum((width(field) for field in df.schema.fields), F.lit(16))
    return df.agg(F.coalesce(F.sum(row.cast("long")), F.lit(0))).first()[0]


def hot_keys(df: DataFrame, key: str) -> list:
    """Keys holding more than 1/64 of the rows with a key, in one pass.

    Fewer than 64 by arithmetic, so they are among the 64 most frequent.
    """
    seen = Observation()
    most = (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .observe(seen, F.sum("n").alias("total"))
        .orderBy(F.desc("n"))
        .limit(HOT_PARTS)
        .collect()
    )
    return [row[0] for row in most if row["n"] * HOT_PARTS > seen.get["total"]]


def lookup_left(
    fact: DataFrame,
    dimension: DataFrame,
    fact_key: str,
    dimension_key: str,
    columns: Iterable[str],
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Left join that adds ``columns`` of the dimension to every fact row.

    A dimension of small measured size is broadcast, so the fact is never
    shuffled. A larger one is joined by shuffle, except that rows with a NULL
    or a hot key never enter that shuffle: they meet only the few dimension
    rows of the hot keys.
    """
    helper = f"__{dimension_key}"
    side = dimension.filter(F.col(dimension_key).isNotNull()).select(
        F.col(dimension_key).alias(helper), *columns
    )

    def joined(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.join(right, left[fact_key] == right[helper], "left").drop(helper)

    if measured_bytes(side) <= broadcast_bytes:
        return joined(fact, F.broadcast(side))

    hot = hot_keys(fact, fact_key)
    if not hot and not fact.schema[fact_key].nullable:
        return joined(fact, side)
    is_hot = F.coalesce(F.col(fact_key).isin(hot), F.lit(True)) if hot else F.col(fact_key).isNull()
    hot_side = side.filter(F.col(helper).isin(hot)) if hot else side.limit(0)
    if measured_bytes(hot_side) <= broadcast_bytes:
        hot_side = F.broadcast(hot_side)
    return joined(fact.filter(~is_hot), side).unionByName(joined(fact.filter(is_hot), hot_side))


def keep_matched(joined: DataFrame, present: str) -> DataFrame:
    """Only the rows whose dimension column was found."""
    return joined.filter(F.col(present).isNotNull())


def match_counts(
    fact: DataFrame,
    dimension: DataFrame,
    fact_key: str,
    dimension_key: str,
    present: str,
    by: Iterable[str] = (),
) -> DataFrame:
    """What the left join would yield, without joining the fact rows.

    Both sides are first counted per key, so the join sees every key once and
    a key that holds a third of the rows is one row. Columns: ``total``,
    ``after_join``, ``matched``, ``unmatched``.
    """
    by = list(by)
    fact_counts = fact.groupBy(*by, F.col(fact_key).alias("__key")).agg(
        F.count(F.lit(1)).alias("__rows")
    )
    dimension_counts = (
        dimension.filter(F.col(dimension_key).isNotNull())
        .groupBy(F.col(dimension_key).alias("__key"))
        .agg(F.count(F.lit(1)).alias("__copies"), F.count(present).alias("__named"))
    )
    after_join = F.col("__rows") * F.coalesce("__copies", F.lit(1))
    matched = F.col("__rows") * F.coalesce("__named", F.lit(0))
    # Counted on its own: rows of keys that are absent, and copies without the wanted value.
    nameless = F.col("__copies") - F.col("__named")
    unmatched = F.col("__rows") * F.coalesce(nameless, F.lit(1))

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0)).cast("long")

    return (
        fact_counts.join(dimension_counts, "__key", "left")
        .groupBy(*by)
        .agg(
            total(F.col("__rows")).alias("total"),
            total(after_join).alias("after_join"),
            total(matched).alias("matched"),
            total(unmatched).alias("unmatched"),
        )
    )
