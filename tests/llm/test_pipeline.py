"""The pipeline stage by stage on the smallest tables, each judged on its own input."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from lavra.llm.staging import stage
from tests.llm import brute
from tests.llm.fixtures import prose

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    made = [docs]
    for name, apply in corpus_pipeline.STAGES:
        made.append(stage(apply(spark, made[-1], SF_DIR), name))
    return made


def rows(df):
    return sorted((r["doc_id"], r["text"]) for r in df.collect())


def test_columns_stay_until_the_last_stage(stages):
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns
    assert all(r["n_chars"] == len(r["text"]) for r in stages[4].collect())


def test_quality_takes_nothing_but_junk(stages):
    before, after = rows(stages[0]), dict(rows(stages[1]))
    for doc, text in before:
        n_words, _, n_symbols, again, repeated, failed = brute.quality(text)
        if failed:
            assert doc not in after
        elif n_symbols == 0 and again == 0 and repeated == 0:
            assert after[doc] == text


def test_line_dedup_equals_brute_force(stages):
    wanted = [(d, text) for d, _, _, text in brute.lines(rows(stages[1])) if text.strip(" \t\n\x0b\x0c\r")]
    assert rows(stages[2]) == wanted


def test_one_document_of_each_group_stays(stages):
    before = rows(stages[2])
    stay = {d for d, _, root in brute.components(before) if d == root}
    assert rows(stages[3]) == [(d, t) for d, t in before if d in stay]


def test_rows_without_a_key_stay(spark):
    texts = [(1, prose(1, 60)), (1, prose(2, 60)), (1, prose(1, 60)), (None, prose(3, 60)), (2, None), (3, " \n "), (4, prose(1, 60))]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t or "")) for i, t in texts], "doc_id long, text string, lang string, source string, n_chars long")
    said = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)
    assert said(corpus_pipeline.jaccard_join(spark, docs, SF_DIR)) == sorted({x for x in texts if x[0] != 4}, key=str)
    assert said(corpus_pipeline.line_dedup(spark, docs, SF_DIR)) == sorted(texts[:-1], key=str)


def test_no_benchmark_passage_stays(spark, stages):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    hit = {d for d, _, n, _, _ in brute.contamination(rows(stages[3]), items) if n}
    assert all(n == 0 for _, _, n, _, _ in brute.contamination(rows(stages[4]), items))
    assert [r for r in rows(stages[4]) if r[0] not in hit] == [r for r in rows(stages[3]) if r[0] not in hit]


def test_packing_takes_every_document(stages):
    packed = stages[5].collect()
    assert {r["doc_id"] for r in packed} == {d for d, _ in rows(stages[4])}


def test_registered(stages, spark):
    names = entry.queries()
    assert "pipeline" in names
    assert [n.split("_")[0] for n in names if n.startswith("op")] == [f"op{i}" for i in range(1, 11)]
    assert entry.queries()["pipeline"](spark, SF_DIR).count() == stages[5].count()
