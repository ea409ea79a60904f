"""Operators that look at one text at a time, against plain Python."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from lavra.llm import html_text, license_scan, quality, queries, secret_scan
from tests.llm import brute
from tests.llm.fixtures import no_docs, odd_docs, odd_rows, prose


def values(df, *columns):
    return sorted((tuple(row) for row in df.select(*columns).collect()), key=str)


def test_base_secrets_equal_brute_force(spark):
    found = secret_scan.digest(secret_scan.scan_secrets(odd_docs(spark)))
    wanted = sorted(((r[0], *brute.secrets(r[1] or "")) for r in odd_rows()), key=str)
    assert values(found, "doc_id", "n_assign", "n_access", "n_hex", "base_sha256") == wanted
    assert secret_scan.scan_secrets(no_docs(spark)).count() == 0


def window_entropy(text, window):
    best = 0.0
    for k in range(len(text) - window + 1):
        part = text[k : k + window]
        best = max(best, -sum(part.count(c) / window * math.log2(part.count(c) / window) for c in set(part)))
    return best


def test_entropy_windows_equal_direct_entropy(spark):
    texts = ["Zx9Qw7Lk3Vb8Nm2Tp6Rs4Yd1Hf5Gj0Ca8Uu", "aaaaaaaaaaaaAAAAAAA1111aaaa", "Ab1Ab1Ab1Ab1Ab1Ab1Ab1Ab1Ab1", "Zx9Qw7Lk3VbZx9Qw7Lk3VbZx9Qw7Lk3Vb", "A1b2C3d4E5f6G7h8I9j0K1l2M3n4" + "a" * 60]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    name, _, alphabet, window, bits = secret_scan.CLASSES[1]
    ranges = docs.select("doc_id", secret_scan._hot_range(F.col("text"), alphabet, window, bits).alias("r")).collect()
    for row in ranges:
        text = texts[row["doc_id"]]
        hot = [k for k in range(len(text) - window + 1) if window_entropy(text[k : k + window], window) >= bits]
        wanted = (hot[0], hot[-1] + window) if hot else (None, None)
        assert tuple(row["r"]) == wanted


def test_allow_list_suppresses_entropy_but_not_base(spark):
    texts = ["key Zx9Qw7Lk3Vb8Nm2Tp6Rs4Yd1Hf5Gj0Ca8Uu", "key ZxExample9Qw7Lk3Vb8Nm2Tp6Rs4Yd1Hf5Gj0Ca", "token=ZxExample9Qw7Lk3Vb8Nm2Tp6Rs4Yd1Hf5Gj0Ca"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in secret_scan.scan_secrets(docs).collect()}
    assert [len(rows[i]["entropy"]) for i in range(3)] == [1, 0, 0]
    assert [len(rows[i]["base"]) for i in range(3)] == [0, 0, 1]


def test_keys_of_one_case_and_allowed_words_beside_keys(spark):
    key = "Zx9Qw7Lk3Vb8Nm2Tp6Rs4Yd1Hf5Gj0Ca8Uu"
    texts = ["at x7k2m9q4w8z3p5t1r6y0u2h8 end", "AT X7K2M9Q4W8Z3P5T1R6Y0U2H8", f"/sample/{key}", f"{key}AAAAAAAA", f"1234567_{key}"]
    texts += ["internationalization2024", "abcdefghijklmnopqrstuvwxyz0123456789", "d41d8cd98f00b204e9800998ecf8427e", "123e4567-e89b-12d3-a456-426614174000"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: [(s["kind"], texts[r["doc_id"]][s["start"] : s["end"]]) for s in r["entropy"]] for r in secret_scan.scan_secrets(docs).collect()}
    assert found[0] == [("entropy36", texts[0][3:27])] and found[1] == [("entropy36", texts[1][3:])]
    assert all(len(found[i]) == 1 and found[i][0][0] == "entropy64" and key[2:-2] in found[i][0][1] for i in (2, 3, 4))
    assert [found[i] for i in (5, 6, 8)] == [[], [], []]
    assert [kind for kind, _ in found[7]] == ["entropy16"]


def test_native_scans_run_no_python(spark):
    for df in (secret_scan.digest(secret_scan.scan_secrets(odd_docs(spark))), license_scan.scan_licenses(odd_docs(spark))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Exchange"))


def test_base_licenses_equal_brute_force(spark):
    found = license_scan.scan_licenses(odd_docs(spark))
    wanted = sorted(((r[0], *brute.licenses(r[1])) for r in odd_rows()), key=str)
    assert values(found, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == wanted
    assert license_scan.scan_licenses(no_docs(spark)).count() == 0


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc"),
        ("SPDX-License-Identifier: BSD-3-Clause", "bsd-3-clause"),
        ("released under the GNU Lesser General Public License version 3", "lgpl"),
        ("GNU Affero General Public License", "agpl"),
        ("Mozilla Public License 2.0 and MIT License", "mit,mpl"),
        ("a license to walk", ""),
        ("All Rights Reserved.", "proprietary"),
        ("this program is released under the GPL v3", "gpl"),
        ("distributed under the terms of the GNU GPL", "gpl"),
        ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "mit"),
        ("Internet Systems Consortium License", "isc"),
        ("shared under Creative Commons Zero", "cc0"),
        ("sleeping under a tree with a gnu", ""),
    ],
)
def test_license_rules(spark, text, labels):
    row = license_scan.scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row["labels"] == labels
    assert 0 <= row["score"] <= 1
    assert (row["score"] > 0) == bool(labels)


def said(tree, rng):
    """A random text of a parsed pattern."""
    out = []
    for kind, value in tree:
        match str(kind):
            case "LITERAL":
                out.append(chr(value))
            case "IN":
                out.append(chr(value[0][1] if str(value[0][0]) == "LITERAL" else rng.randint(*value[0][1])))
            case "BRANCH":
                out.append(said(rng.choice(value[1]), rng))
            case "SUBPATTERN":
                out.append(said(value[-1], rng))
            case "MAX_REPEAT":
                out += [said(value[2], rng) for _ in range(rng.randint(value[0], min(value[1], value[0] + 2)))]
            case _:
                raise ValueError(kind)
    return "".join(out)


def test_every_rule_passes_its_gates():
    rng = random.Random(3)
    for rule in license_scan.rules():
        for _ in range(40):
            text = said(re._parser.parse(rule.pattern), rng)
            assert re.fullmatch(rule.pattern, text)
            assert rule.keyword in text, (rule.label, text)
            assert re.search(license_scan.GATE, text), (rule.label, text)
    assert all(re.search(license_scan.GATE, phrase) for phrase in license_scan.BASE)


def test_there_are_hundreds_of_ordered_rules():
    rules = license_scan.rules()
    assert len(rules) > 300
    assert [r.tier for r in rules] == sorted(r.tier for r in rules)


def test_quality_counts_equal_brute_force(spark):
    found = quality.judge(odd_docs(spark))
    wanted = sorted(((r[0], *brute.quality(r[1])) for r in odd_rows()), key=str)
    assert values(found, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == wanted
    assert found.where("kept and base_failed").count() == 0
    assert quality.judge(no_docs(spark)).count() == 0
    assert quality.keep_good(odd_docs(spark)).columns == odd_docs(spark).columns


def test_sketched_quartiles_are_near_and_merge(spark):
    rows = spark.range(4000).selectExpr("id % 2 as g", "cast(id % 1000 + 1 as double) as word_length", "0.0 as symbol_ratio", "0.0 as dup_line_ratio", "0.0 as repeat_ratio")
    parts = quality.sketch(rows.where("word_length < 300"), ["g"]).unionByName(quality.sketch(rows.where("word_length >= 300"), ["g"]))
    whole = {(r["metric"]): r for r in quality.quartiles(quality.merge(parts, []), []).collect()}
    assert abs(whole["word_length"]["q1"] - 250) < 250 * 0.05
    assert abs(whole["word_length"]["q3"] - 750) < 750 * 0.05
    assert whole["word_length"]["total"] == 4000
    assert whole["symbol_ratio"]["q3"] == 0


def test_thresholds_follow_their_group(spark):
    words = " ".join(["word"] * 2 + [f"w{i}" for i in range(40)])
    odd = " ".join(f"w{i}####" for i in range(40))
    rows = [(i, words + f" end{i}", "en", "clean") for i in range(300)] + [(1000, odd, "en", "clean")]
    rows += [(2000 + i, odd + f" end{i}", "en", "code") for i in range(300)]
    kept = {r["doc_id"]: r["kept"] for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert kept[1] and not kept[1000] and kept[2001]


def test_each_metric_rejects_an_outlier_that_the_base_passes(spark):
    rows = [(i, f"{prose(i, 60)}\n{prose(1000 + i, 60)}", "en", "a") for i in range(300)]
    once = [prose(2000 + k, 12) for k in range(10)]
    passage = " ".join(once[0].split()[:12])
    outliers = {
        "word_length": " ".join(w * 2 for w in prose(3000, 100).split()),
        "symbol_ratio": " ".join(w + "#" * (k % 3 == 0) for k, w in enumerate(prose(3001, 60).split())),
        "dup_line_ratio": "\n".join([*once, *[x for x in ("one", "two", "one", "two", "one", "two", "one", "one", "one", "two")]]),
        "repeat_ratio": f"{passage} {prose(3002, 80)} {passage} {prose(3003, 20)}",
    }
    planted = [(5000 + k, text, "en", "a") for k, text in enumerate(outliers.values())]
    docs = spark.createDataFrame([*rows, *planted], "doc_id long, text string, lang string, source string")
    found = {r["doc_id"]: r for r in quality.judge(docs).collect()}
    assert all(found[i]["kept"] for i in range(300))
    limits = quality.thresholds(quality.measure(docs)).first()
    for row, metric in zip(quality.measure(docs.where("doc_id >= 5000")).orderBy("doc_id").collect(), outliers):
        assert not row["base_failed"] and not found[row["doc_id"]]["kept"]
        assert [m for m in quality.METRICS if not limits[f"{m}_low"] <= row[m] <= limits[f"{m}_high"]] == [metric]


def test_fences_follow_the_ratios_of_the_group(spark):
    rows = [(source, 0.04 if i < some else 0.0) for source, some in (("a", 0), ("b", 60)) for i in range(300)]
    measured = spark.createDataFrame(rows, "source string, r double").selectExpr("'en' as lang", "source", "false as base_failed", "5.0 as word_length", "r as symbol_ratio", "r as dup_line_ratio", "r as repeat_ratio")
    high = {r["source"]: r for r in quality.thresholds(measured).collect()}
    assert high["a"]["repeat_ratio_high"] < high["b"]["repeat_ratio_high"] < 0.3
    assert high["a"]["symbol_ratio_high"] < high["b"]["symbol_ratio_high"]


@pytest.mark.parametrize("count", [3, 199, 200])
def test_a_small_language_is_not_judged_by_another(spark, count):
    rows = [(i, prose(i, 60), "en", "a") for i in range(300)]
    rows += [(1000 + i, " ".join(w * 6 for w in prose(1000 + i, 40).split()), "zh", "a") for i in range(count)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert quality.judge(docs).where("kept").count() == len(rows)


def test_fences_have_no_switch(spark):
    rows = [(lang, 5.0 + i % 10 / 20) for lang, n in (("a", 198), ("b", 199), ("c", 200), ("d", 201)) for i in range(n)]
    measured = spark.createDataFrame(rows, "lang string, w double").selectExpr("lang", "'s' as source", "false as base_failed", "w as word_length", "0.0 as symbol_ratio", "0.0 as dup_line_ratio", "0.0 as repeat_ratio")
    high = [r["word_length_high"] for r in quality.thresholds(measured).orderBy("lang").collect()]
    assert all(0 <= a - b < 0.05 for a, b in zip(high, high[1:]))


PAGE = """<!DOCTYPE html><html><head><title>Title &amp; more</title><style>p{}</style><script>var t="</p>";</script></head>
<body class="has-sidebar"><header><h2>Site</h2></header><nav><ul><li><a href=/a>Menu entry</a><li>Other</ul></nav>
<div class="cookie-notice">We use cookies, please agree to all of them, now.</div>
<div id="wrap"><article><header><h1>Head   line</h1></header><!-- ad --><div class="ad">Buy, buy, buy.</div>
<p>First &eacute;t&eacute; paragraph,\n with <b>bold</b> text; and more of it.<p>Second one, <i>un</i>closed.
<ul><li>Item one, long enough.</li><li>Item two.</ul><form><input name=q>Search here</form></article>
<aside>Related things, and so on.</aside><section class="comments"><p>Nice article, thanks for it, really.</p></section></div>
<footer>&copy; somebody"""


@pytest.mark.parametrize("html", [PAGE, PAGE.replace("<article>", "<div class='content'>").replace("</article>", "</div>").replace("<header><h1>", "<h1>").replace("</h1></header>", "</h1>")])
def test_main_text(html):
    assert html_text.main_text(html) == "Head line\nFirst été paragraph, with bold text; and more of it.\nSecond one, unclosed.\nItem one, long enough.\nItem two."


LONG = "This is a long sentence, with marks; it goes on for a while. " * 8


@pytest.mark.parametrize("name", ["site has-sidebar", "content-sidebar-wrap", "search-results", "share-enabled"])
@pytest.mark.parametrize("tag", ["div", "form"])
@pytest.mark.parametrize("inner", ["article", "main", "div"])
def test_wrappers_are_no_surroundings(name, tag, inner):
    html = f"<body><{tag} class='{name}'><div class=sidebar><p>Side things, and more.</p></div><{inner}><p>{LONG}</p><p>{LONG}</p></{inner}><div class=comments><p>Well said, all of it.</p></div></{tag}></body>"
    assert html_text.main_text(html) == "\n".join([LONG.strip()] * 2)


def test_named_elements_beside_the_article_stay_out():
    teaser = "<div class=related><article><p>Other page, to be read.</p></article></div>"
    html = f"<body><article><p>{LONG}</p></article>{teaser}<div class=comments><article class=comment><p>{LONG}</p></article><p>{LONG}{LONG}</p></div></body>"
    assert html_text.main_text(html) == LONG.strip()


def test_short_parts_of_the_article_stay():
    sections = f"<div id=c><div class=s1><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div><div class=s2><p>A short closing, said last.</p></div></div>"
    assert html_text.main_text(f"<body>{sections}</body>").endswith("\nA short closing, said last.")
    articles = f"<article><p>{LONG}</p><p>{LONG}</p></article><article><p>A short second one, too.</p></article>"
    assert html_text.main_text(f"<body><div>{articles}</div></body>").endswith("\nA short second one, too.")


def test_odd_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "plain words only"), (4, "u", "<p>a</p>" * 3), (5, "u", "<<<&& <p"), (5, "u", "<<<&& <p"), (6, "u", "<div>" * 3000 + "deep" + "</div>" * 3000)]
    found = html_text.extract_text(spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string"))
    texts = {r["page_id"]: (r["text"], r["n_chars"]) for r in found.collect()}
    assert found.count() == 7
    assert texts[1] == ("", 0) and texts[2] == ("", 0)
    assert texts[3] == ("plain words only", 16) and texts[4] == ("a\na\na", 5) and texts[6] == ("deep", 4)
    assert html_text.extract_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_registered_pages_hold_their_paragraphs(spark):
    sf_dir = "/root/testdata/sf0.001"
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for row in queries.op8_html_text(spark, sf_dir).collect():
        html = pages[row["page_id"]]
        inside = html[html.index("<article>") : html.index("</article>")]
        assert row["text"].startswith(html_text.main_text(f"<p>{inside[13:inside.index('</h1>')]}</p>"))
        assert row["text"].count("\n") == inside.replace("<br>", "").count("<p>")
