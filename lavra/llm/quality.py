"""Quality rules with thresholds that follow each language and source, from mergeable quantile sketches."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lavra.llm.staging import chunks, stage, texts_of

SYMBOLS = b"#*$%&|<>"
BLANK = b" \t\n\x0b\x0c\r"
REPEAT_WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Relative accuracy of a sketched quantile.
ACCURACY = 0.02
#: Passing documents from which a group's own sketch decides alone. Below, its fences move in proportion to the
#: wide ones of its language, and the spread of a language that is itself smaller is stretched in inverse proportion.
GROUP_LEAST = 200
#: How many times its spread a value may lie beyond the quartiles.
REACH = 8.0
#: How much wider the fences of a whole language are.
WIDE = 1.5
#: Metric, the least spread that counts (groups of near equal documents are not judged by noise), and the
#: distance from the median as which any longer one counts (outliers do not stretch their own fence).
#: Where no document has a repeat or sign, REACH times the least spread is the fence: far below the base's 0.3.
METRICS = {"word_length": (0.2, 0.5), "symbol_ratio": (0.0125, 0.1), "dup_line_ratio": (0.03, 0.1), "repeat_ratio": (0.015, 0.05)}

_U = np.uint64
_STEPS = [_U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9), _U(0xD6E8FEB86659FD93), _U(0xA0761D6478BD642F), _U(0xE7037ED1A0B428DB)]


def repeated_words(words: list[bytes], window: int = REPEAT_WINDOW) -> int:
    """Words inside windows of ``window`` words that occur twice or more, the first occurrence included."""
    if len(words) <= window:
        return 0
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), _U, len(words))
    n = len(words) - window + 1
    value = np.zeros(n, _U)
    for k in range(window):
        value += hashed[k : k + n] * _STEPS[k % len(_STEPS)]
        value ^= value >> _U(29)
    order = np.argsort(value)
    ranked = value[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, np.flatnonzero(twice), 1)
    np.add.at(edge, np.flatnonzero(twice) + window, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def duplicate_lines(content: bytes) -> tuple[int, int]:
    """Lines with a word, and those of them that equal an earlier line."""
    lines = [line for line in content.split(b"\n") if line.strip(BLANK)]
    return len(lines), len(lines) - len(set(lines))


def _counts(carried: list[str]):
    names = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, "text"):
            rows = []
            for text in texts_of(chunk, "text"):
                content = text.encode()
                words = content.split()
                lines, again = duplicate_lines(content)
                blank = len(content) - len(content.translate(None, BLANK))
                marks = len(content) - len(content.translate(None, SYMBOLS))
                rows.append((len(words), len(text) - blank, marks, lines, again, repeated_words(words)))
            table = np.array(rows, np.int64)
            columns = [chunk.column(c) for c in carried] + [pa.array(table[:, i]) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names=[*carried, *names])

    return run, ", ".join(f"{name} long" for name in names)


def measure(docs: DataFrame, carry: bool = False) -> DataFrame:
    """Counts and ratios per row of ``docs`` (doc_id, text, lang, source); with ``carry`` the row itself as ``whole``."""
    whole = [F.struct(*docs.columns).alias("whole")] if carry else []
    wanted = docs.select(
        F.col("doc_id").cast("long"),
        F.coalesce("lang", F.lit("")).alias("lang"),
        F.coalesce("source", F.lit("")).alias("source"),
        "text",
        *whole,
    )
    carried = ["doc_id", "lang", "source", *(["whole"] if carry else [])]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in wanted.select(*carried).schema)
    run, added = _counts(carried)
    counted = wanted.mapInArrow(run, f"{kinds}, {added}")
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    return counted.select(
        "*",
        ((F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))).alias("base_failed"),
        (F.col("word_chars") / words).alias("word_length"),
        (F.col("n_symbols") / words).alias("symbol_ratio"),
        (F.col("n_dup_lines") / lines).alias("dup_line_ratio"),
        (F.col("n_repeat_words") / words).alias("repeat_ratio"),
    )


def sketch(rows: DataFrame, keys: list[str]) -> DataFrame:
    """A quantile sketch per key and metric: counts of logarithmic buckets.

    A bucket holds values within ``ACCURACY`` of its middle, zero has its own.
    Sketches of parts merge by adding their counts, and so do those of groups
    into a language or the whole; a sketch has at most a few hundred rows.
    """
    base = math.log((1 + ACCURACY) / (1 - ACCURACY))
    named = F.explode(F.create_map(*[x for m in METRICS for x in (F.lit(m), F.col(m))])).alias("metric", "value")
    bucket = F.when(F.col("value") > 1e-6, F.ceil(F.log("value") / base)).otherwise(F.lit(-(1 << 30))).cast("int")
    return rows.select(*keys, named).groupBy(*keys, "metric", bucket.alias("bucket")).agg(F.count("*").alias("n"))


def merge(sketches: DataFrame, keys: list[str]) -> DataFrame:
    return sketches.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))


def _of_metric(place: int):
    return F.create_map(*[x for m, v in METRICS.items() for x in (F.lit(m), F.lit(v[place]))])[F.col("metric")]


def quartiles(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Per key and metric: total, q1 and q3, read off the cumulative counts, and the spread.

    The spread is the largest of the distance of the quartiles, the root mean square
    distance from the median with long distances cut, and the least one of the metric. So
    ratios that are zero for most documents have a spread that follows the others.
    """
    base = math.log((1 + ACCURACY) / (1 - ACCURACY))
    upto = Window.partitionBy(*keys, "metric").orderBy("bucket")
    all_rows = Window.partitionBy(*keys, "metric")
    value = F.when(F.col("bucket") == -(1 << 30), 0.0).otherwise(F.exp((F.col("bucket") - 0.5) * base))
    reached = lambda q: F.min(F.when(F.col("sum") >= q * F.col("total"), F.col("value")))
    summed = sketches.select(*keys, "metric", "n", value.alias("value"), F.sum("n").over(upto).alias("sum"), F.sum("n").over(all_rows).alias("total"))
    away = F.least(F.abs(F.col("value") - reached(0.5).over(all_rows)), _of_metric(1))
    met = summed.withColumn("away", away).groupBy(*keys, "metric")
    found = met.agg(
        F.max("total").alias("total"), reached(0.25).alias("q1"), reached(0.75).alias("q3"), F.sqrt(F.sum(F.col("n") * F.col("away") * F.col("away")) / F.max("total")).alias("rms")
    )
    return found.select(*keys, "metric", "total", "q1", "q3", F.greatest(F.col("q3") - F.col("q1"), "rms", _of_metric(0)).alias("spread"))


def thresholds(rows: DataFrame) -> DataFrame:
    """One row per language and source: the lowest and highest value of each metric that passes.

    No language is judged by another's documents. With few documents the fences
    widen steadily, until only the base rules decide; no count switches them.
    """
    groups = stage(sketch(rows.where(~F.col("base_failed")), ["lang", "source"]), "sketches")
    lang = quartiles(merge(groups, ["lang"]), ["lang"])
    stretch = WIDE * F.greatest(F.lit(1.0), GROUP_LEAST / F.col("total"))
    wide = lang.select(
        "lang", "metric", (F.col("q1") - REACH * stretch * F.col("spread")).alias("wide_low"), (F.col("q3") + REACH * stretch * F.col("spread")).alias("wide_high")
    )
    met = quartiles(groups, ["lang", "source"]).join(wide, ["lang", "metric"])
    own = F.least(F.lit(1.0), F.col("total") / GROUP_LEAST)
    mixed = lambda fence, side: (own * fence + (1 - own) * F.col(f"wide_{side}")).alias(side)
    reach = REACH * F.col("spread")
    fences = met.select("lang", "source", "metric", mixed(F.col("q1") - reach, "low"), mixed(F.col("q3") + reach, "high"))
    return fences.groupBy("lang", "source").agg(
        *[F.max(F.when(F.col("metric") == m, F.col(side))).alias(f"{m}_{side}") for m in METRICS for side in ("low", "high")]
    )


def judge(docs: DataFrame) -> DataFrame:
    """Judge ``docs`` (doc_id, text, lang, source): their counts, ``base_failed`` and ``kept``.

    A document fails the base with fewer than 20 words or when over 30 % of its
    words repeat in windows. Of the others, each language and source sketches
    its ratios, and a document goes whose ratio lies further beyond the quartiles
    than REACH times their spread. The fences of small groups move steadily to the
    wide ones of their language, those of a small language away. NULL languages and sources are groups of
    their own, NULL texts are empty (and fail). Repeated rows are judged alike.
    Other columns, with whatever names, are not read.

    Returns doc_id, lang, source, the counts, base_failed, kept.
    """
    return _judged(docs, carry=False)


def _judged(docs: DataFrame, carry: bool) -> DataFrame:
    rows = stage(measure(docs, carry), "measures")
    # Written first, so that its size is known: Spark sends it to all tasks only if it is small.
    limits = stage(thresholds(rows.drop("whole")), "limits")
    met = rows.join(limits, ["lang", "source"], "left")
    fine = ~F.col("base_failed")
    for m in METRICS:
        fine = fine & F.coalesce((F.col(m) >= F.col(f"{m}_low")) & (F.col(m) <= F.col(f"{m}_high")), F.lit(True))
    return met.select(*[c for c in rows.columns if c not in METRICS], fine.alias("kept"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps, all columns unchanged."""
    return _judged(docs, carry=True).where("kept").select("whole.*")
