"""License scan: ordered signature rules behind a keyword prefilter, in SQL functions."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.llm.native_spans import spans

#: Everything that parts words, before A-Z are lower-cased.
APART = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Phrases whose places always count, and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
BASE_PATTERN = "(?<![^ ])(" + "|".join(BASE) + ")(?![^ ])"


class Rule(NamedTuple):
    """A signature over normalised words. Lower tiers are stronger; within a tier the order of the list decides."""

    tier: int
    label: str
    keyword: str
    pattern: str


#: Label, keyword that every match contains, and the name as it stands between single spaces.
FAMILIES = (
    ("agpl", "affero", r"gnu affero general public|affero general public|affero gpl"),
    ("agpl", "agpl", r"agpl(?: ?v?[123])?(?: 0)?"),
    ("lgpl", "lesser", r"gnu lesser general public|lesser general public|lesser gpl"),
    ("lgpl", "library general", r"gnu library general public|library general public"),
    ("lgpl", "lgpl", r"lgpl(?: ?v?[23])?(?: [01])?"),
    ("gpl", "general public", r"gnu general public|general public"),
    ("gpl", "gpl", r"(?:gnu )?gpl(?: ?v?[123])?(?: 0)?"),
    ("gfdl", "free documentation", r"gnu free documentation|free documentation"),
    ("apache", "apache", r"apache(?: software)?(?: license)?(?: version)?(?: ?v?[12])?(?: [01])?"),
    ("mit", "mit", r"mit(?: x11)?|massachusetts institute of technology mit"),
    ("mit", "expat", r"expat"),
    ("mit-0", "mit no attribution", r"mit no attribution"),
    ("bsd-2-clause", "bsd", r"bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd"),
    ("bsd-3-clause", "bsd", r"bsd 3 clause|3 clause bsd|three clause bsd|modified bsd|new bsd|revised bsd"),
    ("bsd-4-clause", "bsd", r"bsd 4 clause|4 clause bsd|four clause bsd|original bsd"),
    ("0bsd", "bsd", r"0bsd|zero clause bsd|bsd 0 clause|bsd zero clause"),
    ("bsd", "bsd", r"bsd"),
    ("isc", "isc", r"isc"),
    ("isc", "internet systems consortium", r"internet systems consortium"),
    ("mpl", "mozilla", r"mozilla public(?: license)?(?: version)?(?: ?v?[12])?(?: [01])?"),
    ("mpl", "mpl", r"mpl(?: ?v?[12])?(?: [01])?"),
    ("epl", "eclipse", r"eclipse public|eclipse distribution"),
    ("epl", "epl", r"epl(?: ?v?[12])?(?: 0)?"),
    ("cddl", "common development", r"common development and distribution"),
    ("cddl", "cddl", r"cddl(?: 1)?(?: [01])?"),
    ("cpl", "common public", r"common public(?: attribution)?"),
    ("eupl", "european union public", r"european union public"),
    ("eupl", "eupl", r"eupl(?: ?v?1)?(?: [012])?"),
    ("ofl", "open font", r"sil open font|open font"),
    ("artistic", "artistic", r"(?:clarified )?artistic(?: 2 0)?"),
    ("boost", "boost", r"boost software|boost"),
    ("zlib", "zlib", r"zlib(?: libpng)?"),
    ("libpng", "libpng", r"libpng"),
    ("openssl", "openssl", r"openssl(?: ssleay)?"),
    ("php", "php", r"php"),
    ("python", "python", r"python(?: software foundation)?"),
    ("postgresql", "postgresql", r"postgresql"),
    ("ruby", "ruby", r"ruby"),
    ("vim", "vim", r"vim"),
    ("x11", "x11", r"x11"),
    ("x11", "x consortium", r"x consortium"),
    ("ncsa", "ncsa", r"ncsa|university of illinois ncsa"),
    ("ms-pl", "microsoft public", r"microsoft public"),
    ("ms-rl", "microsoft reciprocal", r"microsoft reciprocal"),
    ("afl", "academic free", r"academic free"),
    ("osl", "open software", r"open software"),
    ("cecill", "cecill", r"cecill(?: [bc])?(?: [12])?(?: [01])?"),
    ("qpl", "q public", r"q public"),
    ("hpnd", "historical permission", r"historical permission notice and disclaimer"),
    ("unlicense", "unlicense", r"unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("odbl", "open database", r"open database|open data commons open database"),
    ("odbl", "odbl", r"odbl(?: 1 0)?"),
    ("odc-by", "open data commons attribution", r"open data commons attribution"),
    ("pddl", "public domain dedication", r"public domain dedication and"),
    ("cc-by-nc-nd", "nc nd", r"cc by nc nd|creative commons by nc nd"),
    ("cc-by-nc-sa", "nc sa", r"cc by nc sa|creative commons by nc sa"),
    ("cc-by-nc", "by nc", r"cc by nc|creative commons by nc"),
    ("cc-by-nd", "by nd", r"cc by nd|creative commons by nd"),
    ("cc-by-sa", "by sa", r"cc by sa|creative commons by sa"),
    ("cc-by", "cc by", r"cc by"),
    ("cc-by-nc-nd", "noncommercial no", r"attribution noncommercial no ?derivatives|attribution noncommercial no ?derivs"),
    ("cc-by-nc-sa", "noncommercial share", r"attribution noncommercial share ?alike"),
    ("cc-by-nc", "noncommercial", r"attribution noncommercial"),
    ("cc-by-nd", "attribution no", r"attribution no ?derivatives|attribution no ?derivs"),
    ("cc-by-sa", "attribution share", r"attribution share ?alike"),
    ("cc0", "cc0", r"cc0(?: 1 0)?|cc0 universal"),
    ("cc0", "cc zero", r"cc zero"),
    ("cc0", "creative commons zero", r"creative commons zero"),
)
#: Ways to say that something comes under a license.
UNDER = r"(?:licen[cs]ed|released|distributed|available|published|provided|covered|redistributed|shared) under"
#: Tier and form of a signature around the name of a license; NAME stands for it.
FORMS = (
    (0, r"spdx licen[cs]e identifier (?:NAME)(?: only| or later)?"),
    (1, UNDER + r" (?:the |a |an )?(?:terms of )?(?:the )?(?:NAME)(?: licen[cs]e)?(?: version)?(?: v?[0-9]+)?(?: [0-9]+)?"),
    (1, r"(?:under|of|by|with) the (?:terms of the )?(?:NAME) licen[cs]e(?: version)?(?: v?[0-9]+)?(?: [0-9]+)?"),
    (1, r"(?:NAME) licen[cs]e(?: version| v)? ?[0-9]+(?: [0-9]+)?"),
    (2, r"(?:NAME) licen[cs]e"),
    (2, r"licen[cs]e (?:is |type |name )?(?:NAME)"),
)
#: Signatures with no license name.
PLAIN = (
    Rule(0, "cc-by-nc-nd", "nc nd", r"cc by nc nd [1-4] [05]"),
    Rule(0, "cc-by-nc-sa", "nc sa", r"cc by nc sa [1-4] [05]"),
    Rule(0, "cc-by-nc", "by nc", r"cc by nc [1-4] [05]"),
    Rule(0, "cc-by-nd", "by nd", r"cc by nd [1-4] [05]"),
    Rule(0, "cc-by-sa", "by sa", r"cc by sa [1-4] [05]"),
    Rule(0, "cc-by", "cc by", r"cc by [1-4] [05]"),
    Rule(2, "cc-by-nc-nd", "nc nd", r"cc by nc nd"),
    Rule(2, "cc-by-nc-sa", "nc sa", r"cc by nc sa"),
    Rule(2, "cc-by-nc", "by nc", r"cc by nc"),
    Rule(2, "cc-by-nd", "by nd", r"cc by nd"),
    Rule(2, "cc-by-sa", "by sa", r"cc by sa"),
    Rule(1, "cc0", "cc0", r"cc0 1 0 universal|cc0 public domain dedication"),
    Rule(1, "mit", "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    Rule(1, "isc", "permission to use copy", r"permission to use copy modify and or distribute this software for any purpose with or without fee"),
    Rule(1, "bsd", "redistribution and use", r"redistribution and use in source and binary forms with or without modification are permitted"),
    Rule(1, "wtfpl", "what the", r"do what the fuck you want to public licen[cs]e"),
    Rule(1, "unlicense", "released into the public domain", r"free and unencumbered software released into the public domain"),
    Rule(2, "public-domain", "public domain", r"(?:released|placed|dedicated|is) (?:in|into|to) the public domain|this (?:work|text|file) is in the public domain"),
    Rule(2, "proprietary", "all rights reserved", r"all rights reserved"),
    Rule(2, "proprietary", "licen", r"proprietary licen[cs]e|commercial licen[cs]e only"),
)
#: A text without any of these matches no rule and no base phrase: every form holds the first or second, every
#: signature without a name the first or its keyword, and every base phrase the first or itself.
GATE = "(?i)" + "|".join(["licen[cs]", UNDER, *dict.fromkeys(rule.keyword for rule in PLAIN if "licen" not in rule.pattern), *(x for x in BASE if "licens" not in x)])


def rules() -> list[Rule]:
    """All signatures in order: each form for each family, then the plain ones; tier by tier."""
    made = [Rule(tier, label, keyword, form.replace("NAME", name)) for tier, form in FORMS for label, keyword, name in FAMILIES]
    return sorted([*made, *PLAIN], key=lambda rule: rule.tier)


#: Confidence of a finding by the tier of its rule.
STRENGTH = (1.0, 0.8, 0.5)


def _surviving(low: Column) -> Column:
    """Labels of findings that no stronger or earlier one contains, and the best tier.

    Findings are sorted by start, longest first; one is contained if an earlier
    one of its tier or a stronger tier ends no sooner.
    """
    table = F.array(*[F.struct(F.lit(r.tier).alias("tier"), F.lit(r.label).alias("label"), F.lit(r.keyword).alias("keyword"), F.lit(rf"(?<![^ ])(?:{r.pattern})(?![^ ])").alias("pattern"), F.lit(i).alias("place")) for i, r in enumerate(rules())])
    gated = F.filter(table, lambda rule: F.contains(low, rule["keyword"]))

    def found(rule: Column) -> Column:
        return F.transform(
            spans(low, rule["pattern"]),
            lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), rule["tier"].alias("tier"), rule["place"].alias("place"), rule["label"].alias("label")),
        )

    ordered = F.array_sort(F.flatten(F.transform(gated, found)))
    tiers = range(len(STRENGTH))
    none = F.struct(*[F.lit(-1).cast("long").alias(f"end{t}") for t in tiers], F.array().cast("array<string>").alias("labels"), F.lit(len(STRENGTH)).alias("best"))

    def step(state: Column, x: Column) -> Column:
        end = -x["back"]
        inside = F.lit(False)
        for t in tiers:
            inside = inside | ((x["tier"] >= t) & (state[f"end{t}"] >= end))
        ends = [F.when(x["tier"] == t, F.greatest(state[f"end{t}"], end)).otherwise(state[f"end{t}"]).alias(f"end{t}") for t in tiers]
        kept = F.struct(*ends, F.array_union(state["labels"], F.array(x["label"])).alias("labels"), F.least(state["best"], x["tier"]).alias("best"))
        return F.when(inside, state).otherwise(kept)

    return F.aggregate(ordered, none, step, lambda s: F.struct(s["labels"].alias("labels"), s["best"].alias("best")))


def _words_before(low: Column, at: Column) -> Column:
    prefix = F.substring(low, F.lit(1), at.cast("int"))
    return (F.length(prefix) - F.length(F.replace(prefix, F.lit(" "), F.lit("")))).cast("long")


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Licenses named in ``docs`` (doc_id, text).

    Texts are normalised to lower-case words with single spaces. Only texts
    that pass the gate are searched, and only by rules whose keyword they hold. A
    finding inside another of at least its priority is suppressed; base phrases
    always count. A NULL or empty text has no words; repeated rows stay; other
    columns are ignored. Rows never leave their partition, and no Python runs.

    Returns doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.
    """
    norm = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), APART, " "))
    first = docs.select(F.col("doc_id").cast("long"), F.inline(F.array(F.struct(norm.alias("norm")))))
    words = F.when(F.col("norm") == "", F.lit(0)).otherwise(F.length("norm") - F.length(F.replace("norm", F.lit(" "), F.lit(""))) + 1)
    gated = F.when(F.col("norm").rlike(GATE), F.translate("norm", UPPER, LOWER))
    second = first.select("doc_id", F.inline(F.array(F.struct(words.cast("long").alias("n_words"), gated.alias("low")))))
    low = F.col("low")
    nothing = F.struct(F.array().cast("array<string>").alias("labels"), F.lit(len(STRENGTH)).alias("best"))
    third = second.select(
        "doc_id",
        "n_words",
        F.inline(
            F.array(
                F.struct(
                    low.alias("low"),
                    F.when(low.isNotNull(), spans(low, F.lit(BASE_PATTERN))).alias("base"),
                    F.when(low.isNotNull(), _surviving(low)).otherwise(nothing).alias("found"),
                )
            )
        ),
    )
    count = F.when(low.isNull(), 0).otherwise(F.size("base")).cast("long")
    label = F.create_map(*[F.lit(x) for pair in BASE.items() for x in pair])
    base_labels = F.when(count > 0, F.array_distinct(F.transform("base", lambda s: label[s["text"]]))).otherwise(F.array().cast("array<string>"))
    best = F.element_at(F.array(*[F.lit(s) for s in (*STRENGTH, 0.0)]), F.col("found")["best"] + 1)
    return third.select(
        "doc_id",
        "n_words",
        count.alias("n_base"),
        F.when(count > 0, _words_before(low, F.element_at("base", 1)["start"])).alias("first_word"),
        F.when(count > 0, _words_before(low, F.element_at("base", -1)["start"])).alias("last_word"),
        F.array_join(F.array_sort(base_labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base_labels, F.col("found")["labels"])), ",").alias("labels"),
        F.greatest(best, F.when(count > 0, F.lit(0.9)).otherwise(F.lit(0.0))).alias("score"),
    )
