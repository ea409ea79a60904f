"""Places of regular expressions in texts, by column functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A match: code points [start, end), its text, and the text of one group.
SPAN = "array<struct<start:long,end:long,text:string,part:string>>"


def spans(text: Column, pattern: Column, group: int = 0) -> Column:
    """All leftmost non-overlapping matches of ``pattern`` in ``text``, in order.

    Splitting gives what lies between the matches, extracting gives the
    matches; the running sum of their lengths gives the places.
    """
    zipped = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("text"),
        F.regexp_extract_all(text, pattern, F.lit(group)).alias("part"),
    )
    empty = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPAN).alias("found"))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["gap"])
        end = start + F.length(x["text"])
        span = F.struct(start.cast("long").alias("start"), end.cast("long").alias("end"), x["text"].alias("text"), x["part"].alias("part"))
        more = F.struct(end.cast("long").alias("at"), F.concat(state["found"], F.array(span)).alias("found"))
        return F.when(x["text"].isNull(), state).otherwise(more)

    return F.aggregate(zipped, empty, step, lambda state: state["found"])


def no_spans() -> Column:
    return F.array().cast(SPAN)
