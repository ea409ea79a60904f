"""Secret scan: fixed patterns, and sliding-window entropy over candidate strings, in SQL functions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.llm.native_spans import SPAN, no_spans, spans

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: These two find the longest runs, so the least length may stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
ASSIGN_LEAST = 6
#: Every access key, hexadecimal run and entropy candidate lies in such a run.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "entropy16", "entropy64", "entropy36")
#: Shapes of whole candidates that look random but are none: such a candidate gives no entropy span.
ALLOWED = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$|(?i)^sha(1|256|384|512)-|^[a-z]+([_/-][a-z]+)*[0-9]{0,3}$|^[0-9_/+=-]+$"
#: What stands for a secret or is none, with up to 32 letters and digits at either side, and runs of one character.
#: Such stretches are cut out of a candidate; what is left of it is measured.
HARMLESS = (
    r"(?i)[A-Z0-9]{0,32}(?:example|sample|dummy|changeme|placeholder|redacted|your[_-]|0123456|1234567|abcdefg|qwerty|deadbeef)[A-Z0-9]{0,32}"
    r"|(.)\1{5,}"
)
#: Name, candidate pattern, alphabet, window and least bits per character of each class.
CLASSES = (
    ("entropy16", r"(?<![0-9A-Za-z+/_=-])[0-9a-fA-F]{24,}(?![0-9A-Za-z+/_=-])", "0123456789abcdef", 24, 3.1),
    ("entropy64", CANDIDATE, "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 20, 3.85),
    ("entropy36", r"(?<![A-Za-z0-9])(?:[a-z0-9]{20,}|[A-Z0-9]{20,})(?![A-Za-z0-9])", "abcdefghijklmnopqrstuvwxyz0123456789", 20, 3.5),
)
#: What a candidate of each class must hold: long words have little of a key. Long hexadecimal runs are of entropy16.
MIXED = {"entropy16": ("[0-9]", "[a-fA-F]"), "entropy64": ("[a-z]", "[A-Z]", "[0-9]"), "entropy36": ("[0-9][A-Za-z]+[0-9]", "[g-zG-Z]|^.{20,23}$")}
_SCALE = 1 << 20


def _hot_range(text: Column, alphabet: str, window: int, bits: float) -> Column:
    """First and last edge of the windows of ``text`` with at least ``bits`` of entropy per character.

    One pass with a count per symbol: a character comes in, the one ``window``
    places back goes out, and the sum of c * log2(c) follows by table. The sum
    is kept in whole numbers, so it never drifts.
    """
    table = F.array(*[F.lit(round(c * math.log2(c) * _SCALE) if c else 0).cast("long") for c in range(window + 2)])
    limit = int((math.log2(window) - bits) * window * _SCALE)
    codes = F.transform(F.split(text, ""), lambda c: F.instr(F.lit(alphabet), c))
    codes = F.filter(codes, lambda c: c > 0)
    moves = F.arrays_zip(codes.alias("into"), F.concat(F.array_repeat(F.lit(0), window), codes).alias("out"))
    start = F.struct(
        F.lit(0).alias("at"),
        F.lit(0).cast("long").alias("total"),
        F.array_repeat(F.lit(0), len(alphabet)).alias("counts"),
        F.lit(None).cast("int").alias("first"),
        F.lit(None).cast("int").alias("last"),
    )

    def value(counts: Column, code: Column) -> Column:
        return F.when(code > 0, F.element_at(counts, F.when(code > 0, code).otherwise(1))).otherwise(0)

    def step(state: Column, x: Column) -> Column:
        into, out = x["into"], x["out"]
        counts = state["counts"]
        same = into == out
        c_in, c_out = value(counts, into), value(counts, out)
        term = lambda c: F.element_at(table, c + 1)
        came = F.when(same, 0).otherwise(term(c_in + 1) - term(c_in))
        went = F.when(same | (out == 0), 0).otherwise(term(c_out - 1) - term(c_out))
        total = (state["total"] + came + went).cast("long")
        moved = F.when(same, counts).otherwise(F.transform(counts, lambda c, k: c + (k + 1 == into).cast("int") - (k + 1 == out).cast("int")))
        at = state["at"] + 1
        hot = (at >= window) & (total <= limit)
        after = F.struct(
            at.alias("at"),
            total.alias("total"),
            moved.alias("counts"),
            F.when(hot & state["first"].isNull(), at - window).otherwise(state["first"]).alias("first"),
            F.when(hot, at).otherwise(state["last"]).alias("last"),
        )
        return F.when(into.isNull(), state).otherwise(after)

    return F.aggregate(moves, start, step, lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")))


def _left(span: Column) -> Column:
    """The stretches (start, text) of a candidate outside what is harmless."""
    cut = spans(span["text"], F.lit(HARMLESS))
    from_ = F.concat(F.array(F.lit(0).cast("long")), F.transform(cut, lambda c: c["end"]))
    to = F.concat(F.transform(cut, lambda c: c["start"]), F.array(F.length(span["text"]).cast("long")))
    return F.transform(
        F.arrays_zip(from_.alias("from"), to.alias("to")),
        lambda x: F.struct((span["start"] + x["from"]).alias("start"), F.substring(span["text"], (x["from"] + 1).cast("int"), (x["to"] - x["from"]).cast("int")).alias("text")),
    )


def _entropy_spans(text: Column, name: str, pattern: str, alphabet: str, window: int, bits: float) -> Column:
    def mixed(s: Column) -> Column:
        held = F.length(s["text"]) >= window
        for kind in MIXED[name]:
            held = held & s["text"].rlike(kind)
        return held

    shaped = F.filter(spans(text, F.lit(pattern)), lambda s: ~s["text"].rlike(ALLOWED))
    candidates = F.filter(F.flatten(F.transform(shaped, _left)), mixed)
    fold = (lambda c: c) if alphabet != alphabet.lower() else F.lower
    measured = F.transform(candidates, lambda s: F.struct(s.alias("span"), _hot_range(fold(s["text"]), alphabet, window, bits).alias("range")))
    hot = F.filter(measured, lambda m: m["range"]["first"].isNotNull())
    return F.transform(
        hot,
        lambda m: F.struct(
            (m["span"]["start"] + m["range"]["first"]).cast("long").alias("start"),
            F.lit(KINDS.index(name)).alias("rank"),
            (m["span"]["start"] + m["range"]["last"]).cast("long").alias("end"),
            F.lit(name).alias("kind"),
        ),
    )


def _ranked(found: Column, kind: str) -> Column:
    return F.transform(found, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def _said(found: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(found), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Secrets in ``docs`` (doc_id, text): doc_id, base, entropy.

    ``base`` and ``entropy`` are arrays of (start, rank, end, kind) in code
    points, sorted. Base spans follow the three fixed patterns; matches that are
    too short are dropped, not searched again. Entropy spans lie in candidates
    of mixed characters, outside what the allow-list explains of them. A NULL or empty text
    has none; repeated rows stay; other columns are ignored. Rows never leave
    their partition, and no Python runs.
    """
    text = F.coalesce("text", F.lit(""))
    thin = docs.select(F.col("doc_id").cast("long"), text.alias("text"))
    low = F.lower("text")
    word = low.contains("passw") | low.contains("secret") | low.contains("token") | low.contains("api")
    text = F.col("text")
    assign = F.when(word, F.filter(spans(text, F.lit(ASSIGN), 2), lambda s: F.length(s["part"]) >= ASSIGN_LEAST)).otherwise(no_spans())
    # Without a long run neither of the others can match; the generator keeps this test from being repeated.
    gated = thin.select("doc_id", F.inline(F.array(F.struct(text.alias("text"), text.rlike(CANDIDATE).alias("long"), assign.alias("assign")))))
    empty = F.array().cast("array<struct<start:long,rank:int,end:long,kind:string>>")
    base = F.concat(
        _ranked(F.col("assign"), "assign"),
        F.when(F.col("long"), F.concat(_ranked(spans(text, F.lit(ACCESS)), "access"), _ranked(spans(text, F.lit(HEX)), "hex"))).otherwise(empty),
    )
    entropy = F.when(F.col("long"), F.concat(*[_entropy_spans(text, *said) for said in CLASSES])).otherwise(empty)
    return gated.select("doc_id", F.inline(F.array(F.struct(F.array_sort(base).alias("base"), F.array_sort(entropy).alias("entropy")))))


def digest(found: DataFrame) -> DataFrame:
    """Counts, the hash of the base spans and all spans as text, per row of :func:`scan_secrets`."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[count(kind) for kind in KINDS[:3]],
        F.sha2(_said(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _said(F.concat("base", "entropy")).alias("spans"),
    )
