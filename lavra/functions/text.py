"""Text cleaning that never raises under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_blank(text: Column) -> Column:
    """True for NULL and for text made of spaces only (a tab is not blank)."""
    return text.isNull() | (F.trim(text) == "")


def null_if_blank(text: Column) -> Column:
    """Blank text becomes NULL; anything else is kept untrimmed."""
    return F.when(F.trim(text) != "", text)


def decimal_comma(text: Column) -> Column:
    """``926,1`` becomes 926.1; text that is no number becomes NULL."""
    return F.translate(F.trim(text), ",", ".").try_cast("double")


def code_prefix(code: Column, digits: int = 6) -> Column:
    """The leading digits of a code; a NULL code stays NULL."""
    return F.substring(code, 1, digits)


def strip(text: Column) -> Column:
    """Drop every kind of whitespace at both ends."""
    return F.regexp_replace(text, r"^[\s\u00A0]+|[\s\u00A0]+$", "")


def last_value_of(lines: Column, label: str, separator: str = ";") -> Column:
    """Value of the last ``label<separator>value`` line in an array of lines.

    The split is made at the first separator, and lines without one are
    ignored. NULL when no line carries the label.
    """
    with_label = F.filter(
        lines,
        lambda line: line.contains(separator)
        & (strip(F.substring_index(line, separator, 1)) == label),
    )
    return strip(
        F.try_element_at(
            F.split(F.try_element_at(with_label, F.lit(-1)), separator, 2), F.lit(2)
        )
    )
