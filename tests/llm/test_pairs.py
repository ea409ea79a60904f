"""Operators that compare documents, against plain Python over all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest

from lavra.llm import components as stars
from lavra.llm import decontam, jaccard, line_dedup
from lavra.llm.cuckoo import CuckooFilter
from lavra.llm.fm_index import FMIndex
from lavra.scratch import new_folder
from tests.llm import brute
from tests.llm.fixtures import no_docs, odd_docs, odd_rows, prose


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    found = dict(map(tuple, stars.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert {found[i] for i in range(41)} == {0}
    assert {found[i] for i in range(100, 150)} == {100}
    assert {found[i] for i in (200, 201, 202)} == {200}
    assert stars.components(spark.createDataFrame([], "a long, b long")).count() == 0


def mutated(words, rng, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
    return " ".join(words)


def family_rows():
    """Chains and groups of near copies around the threshold, sharing one passage."""
    rng, rows = random.Random(5), []
    passage = prose(77, 60)
    for family in range(12):
        words = prose(family + 100, rng.choice([8, 40, 90, 200])).split()
        if family % 2:
            words = passage.split() + words
        for _ in range(8):
            rows.append((len(rows), mutated(words, rng, rng.choice([0, 1, 1, 2, 3]))))
            words = rows[-1][1].split() if rng.random() < 0.5 else words
    return rows


@pytest.mark.parametrize("block", [512, 2])
def test_jaccard_join_is_exact(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = family_rows()
    found = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, found.collect())) == brute.components(rows)


def test_jaccard_join_of_odd_documents(spark):
    rows = [(r[0], r[1]) for r in odd_rows()]
    once = dict(reversed(rows))
    wanted = {(i, n, c) for i, n, c in brute.components(sorted(once.items()))}
    found = jaccard.jaccard_components(odd_docs(spark)).collect()
    assert len(found) == len(rows)
    assert set(map(tuple, found)) == wanted
    assert jaccard.jaccard_components(no_docs(spark)).count() == 0


def test_bit_bound_never_hides_a_link():
    rng = np.random.default_rng(3)
    for _ in range(200):
        a = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 300)).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.9], rng.integers(0, 1 << 63, 5).astype(np.uint64)]))
        p, q = jaccard.bitmap(a), jaccard.bitmap(b)
        width = min(len(p), len(q))
        if jaccard.linked(len(a), len(b), len(np.intersect1d(a, b))):
            assert jaccard._may_link(jaccard.fold(p, width), len(a), jaccard.fold(q, width)[None], np.array([len(b)]), 80)[0]


@pytest.mark.parametrize("size", [1, 3, 7, 1000])
def test_holders_are_counted_across_batches(monkeypatch, size):
    monkeypatch.setattr(jaccard, "MANY", 5)
    times = [1, 4, 5, 6, 1, 23, 2, 11, 1]
    of = np.repeat(np.arange(len(times)), times)
    batches = [pa.record_batch({"shingle": of[i : i + size], "key_a": of[i : i + size], "key_b": np.arange(i, min(i + size, len(of)))}) for i in range(0, len(of), size)]
    found = pa.Table.from_batches(list(jaccard._counted(iter([batches[0].slice(0, 0), *batches]))))
    assert found.column("shingle").to_pylist() == of.tolist()
    assert found.column("key_b").to_pylist() == list(range(len(of)))
    assert found.column("holders").to_pylist() == np.minimum(times, 5)[of].tolist()
    assert list(jaccard._counted(iter([]))) == []


def test_a_pair_is_left_to_the_first_tile_it_shares():
    rng = random.Random(6)
    for _ in range(100):
        earlier, *others = (np.array(sorted(rng.sample(range(40), rng.randint(0, 6))), np.int64) for _ in range(5))
        assert jaccard._meet_first(earlier, others).tolist() == [set(earlier).isdisjoint(x) for x in others]


def test_fm_index_finds_every_phrase():
    rng = np.random.default_rng(1)
    for repeat in range(5):
        text = rng.integers(0, 4, 300)
        text = np.concatenate([text, text[50:120], np.tile([1, 2], 30 * repeat), [0]]).astype(np.int64)
        index = FMIndex(text)
        phrases = np.stack([rng.integers(1, 4, 3) for _ in range(40)])
        lo, hi = index.ranges(phrases)
        for phrase, a, b in zip(phrases, lo, hi):
            wanted = [i for i in range(len(text) - 2) if (text[i : i + 3] == phrase).all()]
            assert sorted(index.locate(np.arange(a, max(a, b)))) == wanted


ITEMS = [(1, prose(1, 30)), (2, "two words"), (3, None), (4, " ,. "), (10, "This passage of several words stands in many documents, always the same"), (5, prose(6, 40)), (10, "spam eggs ham")]


@pytest.mark.parametrize("limits", [{}, {"shard_words": 50}])
def test_contamination_equals_brute_force(spark, limits):
    rows = [(r[0], r[1]) for r in odd_rows()]
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    found = decontam.find_contamination(odd_docs(spark), items, **limits).collect()
    got = sorted((r["doc_id"], r["n_words"], sum(s["end"] - s["first"] for s in r["spans"]), len(r["items"]), brute.sha(",".join(sorted(map(str, r["items"]))))) for r in found)
    assert got == brute.contamination(rows, ITEMS)


def test_items_in_blocks_give_the_same(spark, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    key = lambda r: (r["doc_id"], r["n_words"], [tuple(s) for s in r["spans"]], sorted(r["items"]))
    once = sorted(map(key, decontam.find_contamination(odd_docs(spark), items).collect()))
    monkeypatch.setattr(decontam, "item_blocks", lambda benchmark, column: iter([[item] for item in ITEMS]))
    assert sorted(map(key, decontam.find_contamination(odd_docs(spark), items).collect())) == once


def test_removal_does_not_depend_on_blocks(spark, monkeypatch):
    a, b, c = ([f"{x}{k}" for k in range(15)] for x in "abc")
    items = [(1, " ".join(a[:10])), (2, " ".join([*a[6:], "z"])), (3, " ".join(b[:10])), (4, " ".join(c[:10])), (4, " ".join(c[:10]))]
    texts = [" ".join(["pre", *a, "z", "post"]), " ".join(["x", *b[:5], *c[:10], *b[5:10], "y"]), " ".join(a), " ".join(c[:10]), None, "", "clean words"]
    docs = spark.createDataFrame([(i // 2, t, len(t or ""), i) for i, t in enumerate([*texts, texts[0]])], "doc_id long, text string, n_chars long, row int")
    said = spark.createDataFrame(items, "item_id int, text string")
    assert all(len(r["items"]) == len(set(r["items"])) for r in decontam.find_contamination(docs, said).collect())
    got = lambda: sorted(map(tuple, decontam.remove_contamination(docs, said).collect()), key=str)
    once = got()
    assert {r[1] for r in once} == {"pre  post", "x  y", " a10 a11 a12 a13 a14", None, "", "clean words"}
    monkeypatch.setattr(decontam, "item_blocks", lambda benchmark, column: iter([[item] for item in items]))
    assert got() == once
    assert decontam.remove_contamination(docs, said).columns == docs.columns


def test_removal_leaves_no_window(spark):
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    clean = decontam.remove_contamination(odd_docs(spark), items)
    rows = [(r["doc_id"], r["text"]) for r in clean.collect()]
    assert all(hit == 0 for _, _, hit, _, _ in brute.contamination(rows, ITEMS))
    before = {r[0]: r[1] for r in odd_rows()}
    untouched = {d for d, _, hit, _, _ in brute.contamination(list(before.items()), ITEMS) if not hit}
    assert {d: t for d, t in rows if d in untouched} == {d: before[d] for d in untouched}
    assert clean.schema == odd_docs(spark).schema
    none = spark.createDataFrame([], "item_id int, text string")
    assert decontam.remove_contamination(odd_docs(spark), none).count() == len(odd_rows())
    assert decontam.find_contamination(odd_docs(spark), none).where("size(spans) > 0").count() == 0
    assert decontam.find_contamination(no_docs(spark), items).count() == 0


def test_cuckoo_filter_holds_and_forgets():
    keys = np.random.default_rng(2).integers(0, 1 << 63, 20000).astype(np.uint64)
    made = CuckooFilter.sized(len(keys))
    assert made.insert(keys)
    assert made.contains(keys).all()
    others = np.random.default_rng(4).integers(0, 1 << 63, 20000).astype(np.uint64)
    assert made.contains(others).mean() < 0.001
    made = CuckooFilter.from_bytes(made.to_bytes())
    made.delete(keys[:10000])
    assert made.contains(keys[10000:]).all()
    assert made.contains(keys[:10000]).mean() < 0.001
    assert not CuckooFilter(16).insert(keys[:200])


def kept(store, docs):
    return sorted((r["doc_id"], r["text"]) for r in store.kept(docs, with_text=True).collect())


def wanted(rows):
    out = []
    for (doc, *_, text), (_, before) in zip(brute.lines(rows), sorted(rows)):
        out.append((doc, None if before is None else text))
    return out


def line_rows():
    rng = random.Random(8)
    lines = [prose(i + 500, rng.randint(1, 6)) for i in range(60)]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(1, 9)))) for i in range(30)]
    return [*rows, (30, None), (31, ""), (32, "\n\n")]


def test_lines_go_in_and_out_again(spark):
    rows = line_rows()
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    store = line_dedup.LineStore(spark, new_folder(spark, "test-lines"), shards=4)
    store.insert(frame(rows[10:20]))
    assert kept(store, frame(rows[10:20])) == wanted(rows[10:20])
    store.insert(frame(rows[:10] + rows[20:]))
    assert kept(store, frame(rows)) == wanted(rows)
    store.delete(frame(rows[:12]).select("doc_id"))
    assert kept(store, frame(rows[12:])) == wanted(rows[12:])
    store.insert(frame(rows[:12]))
    assert kept(store, frame(rows)) == wanted(rows)


def test_line_digest_of_odd_documents(spark):
    store = line_dedup.dedup_lines(odd_docs(spark), new_folder(spark, "test-lines"))
    found = store.kept(odd_docs(spark)).collect()
    rows = sorted({(r[0], r[1]) for r in odd_rows()}, key=str)
    expected = {(d, n, m, brute.sha(text)) for d, n, m, text in brute.lines(rows)}
    assert set(map(tuple, found)) == expected
    assert len(found) == len(odd_rows())
    empty = line_dedup.dedup_lines(no_docs(spark), new_folder(spark, "test-lines"))
    assert empty.kept(no_docs(spark)).count() == 0
