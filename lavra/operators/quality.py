"""Declared data-quality checks, measured together and reported as rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.functions.text import is_blank
from lavra.operators.aggregates import distinct_count
from lavra.operators.sets import union_by_name

RESULT_COLUMNS = ["position", "check", "observed", "expected", "passed"]


class QualityError(ValueError):
    """A check that had to pass did not."""


@dataclass(frozen=True)
class Check:
    """One figure to observe and what it has to be.

    ``observed`` is an aggregate over the rows. With ``keys`` it is an
    aggregate over the groups of these keys instead, where ``n`` is the size of
    a group. A ``constant`` comes from the schema and looks at no row at all, so it
    is the same for an empty table. ``expected`` may refer to the columns the report is grouped by;
    without one the figure is only reported.
    """

    name: str
    observed: Column
    expected: Column | int | None = 0
    at_most: bool = False
    keys: tuple[str, ...] = ()
    constant: bool = False


def row_count(name: str, expected: Column | int) -> Check:
    return Check(name, F.count(F.lit(1)), expected)


def unique_count(name: str, columns: Sequence[str], expected: Column | int) -> Check:
    return Check(name, distinct_count(*columns), expected)


def max_distinct(name: str, columns: Sequence[str], limit: int) -> Check:
    return Check(name, distinct_count(*columns), limit, at_most=True)


def not_null(name: str, column: str) -> Check:
    return Check(name, F.count_if(F.col(column).isNull()))


def not_blank(name: str, column: str) -> Check:
    return Check(name, F.count_if(is_blank(F.col(column))))


def reported_nulls(name: str, column: str) -> Check:
    return Check(name, F.count_if(F.col(column).isNull()), None)


def only_value(name: str, column: str, value: str) -> Check:
    """Rows with another value; NULL rows are not counted."""
    return Check(name, F.count_if(F.col(column) != value))


def only_prefix(name: str, column: str, prefix: str) -> Check:
    """Rows without the prefix; NULL rows are not counted."""
    return Check(name, F.count_if(~F.col(column).startswith(prefix)))


def value_set(name: str, column: str, values: Sequence[str]) -> Check:
    """The distinct values must be exactly ``values``.

    Observed are the rows with any other value or NULL, plus the values that do
    not occur at all: nothing is collected, however many values there are.
    """
    value = F.col(column)
    foreign = F.count_if(value.isNull() | ~value.isin(list(values)))
    absent = [F.when(F.count_if(value == v) == 0, 1).otherwise(0) for v in values]
    return Check(name, sum(absent, foreign))


def no_duplicates(name: str, keys: Sequence[str]) -> Check:
    return Check(name, F.count_if(F.col("n") > 1), 0, keys=tuple(keys))


def group_size(name: str, keys: Sequence[str], expected: Column | int) -> Check:
    """Groups whose number of rows is not the expected one."""
    return Check(name, F.count_if(F.col("n") != expected), 0, keys=tuple(keys))


def column_count(name: str, df: DataFrame, expected: int) -> Check:
    return Check(name, F.lit(len(df.columns)), expected, constant=True)


def column_names(name: str, df: DataFrame, expected: Sequence[str]) -> Check:
    """The columns must be exactly these, in this order."""
    differs = 0 if list(df.columns) == list(expected) else 1
    return Check(name, F.lit(differs), constant=True)


def evaluate(df: DataFrame, checks: Sequence[Check], by: Iterable[str] = ()) -> DataFrame:
    """The check frame: one row per check, or per check and group of ``by``.

    All checks on rows share one aggregation and so one column-pruned scan;
    checks on groups share one more per set of keys.
    """
    by = list(by)
    shared: dict[tuple[str, ...], list[tuple[int, Check]]] = {}
    fixed: list[tuple[int, Check]] = []
    for position, check in enumerate(checks):
        if check.constant and not by:
            fixed.append((position, check))
        else:
            shared.setdefault(check.keys, []).append((position, check))

    parts = []
    if fixed:
        one = df.sparkSession.range(1).select(
            *(check.observed.cast("long").alias(f"__{position}") for position, check in fixed)
        )
        parts.append(one.select(F.inline(F.array(*map(_result, fixed)))))
    for keys, members in shared.items():
        source = df
        if keys:
            names = list(dict.fromkeys([*by, *keys]))
            source = df.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
        measured = source.groupBy(*by).agg(
            *(
                F.coalesce(check.observed.cast("long"), F.lit(0)).alias(f"__{position}")
                for position, check in members
            )
        )
        parts.append(measured.select(*by, F.inline(F.array(*map(_result, members)))))
    return union_by_name(parts)


def _result(member: tuple[int, Check]) -> Column:
    position, check = member
    observed = F.col(f"__{position}")
    if check.expected is None:
        expected, passed = F.lit(None).cast("long"), F.lit(True)
    else:
        expected = check.expected if isinstance(check.expected, Column) else F.lit(check.expected)
        expected = expected.cast("long")
        passed = observed <= expected if check.at_most else observed == expected
    return F.struct(
        F.lit(position).alias("position"),
        F.lit(check.name).alias("check"),
        observed.alias("observed"),
        expected.alias("expected"),
        passed.alias("passed"),
    )


def error_row(spark: SparkSession, check: str, **group: object) -> DataFrame:
    """A failed check that stands for input that could not be read."""
    return spark.range(1).select(
        *(F.lit(value).alias(name) for name, value in group.items()),
        F.lit(-1).alias("position"),
        F.lit(check).alias("check"),
        F.lit(None).cast("long").alias("observed"),
        F.lit(None).cast("long").alias("expected"),
        F.lit(False).alias("passed"),
    )


def failures(results: DataFrame, first: int | None = None) -> list[str]:
    """Messages of the failed checks in declared order, all of them or the ``first`` few."""
    groups = [name for name in results.columns if name not in RESULT_COLUMNS]
    failed = results.filter(~F.col("passed")).orderBy(*groups, "position")
    messages = []
    for row in (failed if first is None else failed.limit(first)).collect():
        prefix = "".join(f"{row[name]}: " for name in groups)
        if row["observed"] is None:
            messages.append(f"{prefix}{row['check']}")
        else:
            messages.append(
                f"{prefix}{row['check']}: observed {row['observed']}, expected {row['expected']}"
            )
    return messages


def enforce(results: DataFrame, policy: str = "raise") -> list[str]:
    """``raise``: stop at the first failed check. ``collect``: return them all."""
    if policy not in ("raise", "collect"):
        raise ValueError(f"unknown policy: {policy}")
    messages = failures(results, 1 if policy == "raise" else None)
    if messages and policy == "raise":
        raise QualityError(messages[0])
    return messages
