"""Operators on words, phrases and tokens, against plain Python."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex
from tokenizers import Tokenizer

from lavra.llm import bloom, collocation, spelling, token_counts
from tests.llm.brute import low
from tests.llm.fixtures import no_docs, odd_docs, odd_rows, prose

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def phrases(rows, min_count, top=2000):
    """rows: (lang, text) -> the answer of the definition, by counting all grams of all sizes."""
    f, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in range(1, 5):
                f.update((lang, tuple(words[i : i + size])) for i in range(len(words) - size + 1))
    gone = set()
    for (lang, g), a in f.items():
        for size in range(2, len(g)):
            for i in range(len(g) - size + 1):
                if a >= min_count and 100 * a >= 80 * f[lang, g[i : i + size]]:
                    gone.add((lang, g[i : i + size]))
    found = defaultdict(list)
    for (lang, g), a in f.items():
        if len(g) > 1 and a >= min_count and (lang, g) not in gone:
            cuts = [(f[lang, g[:k]], f[lang, g[k:]]) for k in range(1, len(g))]
            score, k = min((2_000_000 * a // sum(cut), k) for k, cut in enumerate(cuts))
            found[lang].append((-score, -a, " ".join(g).encode(), *cuts[k]))
    return [
        (lang, i + 1, phrase.decode(), -a, left, right, total[lang], -score)
        for lang in sorted(found)
        for i, (score, a, phrase, left, right) in enumerate(sorted(found[lang])[:top])
    ]


def phrase_rows():
    """Passages repeated whole and in part, loops of one word, words of odd characters and a very long word."""
    rng = random.Random(3)
    passages = [prose(50 + i, rng.choice([3, 5, 12, 70])) for i in range(8)]
    vocabulary = prose(9, 25).split() + ["naïve", "Ünï", "\x02", "\x03a", "\x01", "日本", "\U0001f600", "a b", "w" * 200]
    rows = []
    for i in range(240):
        parts = []
        for _ in range(rng.randint(0, 4)):
            words = rng.choice(passages).split()
            a = rng.randrange(len(words))
            parts.append(" ".join(words[a : a + rng.choice([2, 6, 80])] if rng.random() < 0.5 else words))
            parts.append(" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 6))))
        parts.append("the " * rng.randint(0, 9))
        rows.append((("en", None, "de")[i % 3], rng.choice([" ", ". ", "\t", ",\n"]).join(parts).replace("e", rng.choice("eE"))))
    return [*rows, *rows[:20], ("en", None), (None, ""), ("de", " \t\n.,")]


@pytest.mark.parametrize("size", [collocation.DICTIONARY_WORDS, 8])
def test_phrases_are_those_of_all_grams(spark, size):
    rows = phrase_rows()
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    found = collocation.mine_phrases(docs, min_count=12, size=size).orderBy("lang", "rank").collect()
    assert [tuple(r) for r in found] == phrases(rows, 12)


def test_phrases_in_blocks_and_small_counters(spark, monkeypatch):
    monkeypatch.setattr(collocation, "BLOCK_BYTES", 40)
    monkeypatch.setattr(collocation, "HELD", 3)
    rows = phrase_rows()
    found = collocation.mine_phrases(spark.createDataFrame(rows, "lang string, text string"), min_count=12, top=7).collect()
    assert sorted(map(tuple, found)) == phrases(rows, 12, top=7)


def test_phrases_of_odd_documents(spark):
    rows = [(r[2], r[1]) for r in odd_rows()]
    found = collocation.mine_phrases(odd_docs(spark), min_count=2)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == sorted(phrases(rows, 2))
    assert collocation.mine_phrases(no_docs(spark)).count() == 0


def test_flow_gives_the_counts_of_words(spark):
    rows = phrase_rows()
    docs = spark.createDataFrame(rows, "lang string, text string")
    words = collocation.count_words(docs)
    dictionary = collocation.Dictionary(words, 12)
    counts = collocation.flow_counts(collocation.count_edges(docs, dictionary), 12)
    word_of = dict(zip(collocation.code_points(len(dictionary.words)), dictionary.words))
    flow = {(r["lang"], collocation.decoded(r["gram"], word_of)): r["n"] for r in counts.where("size = 1").collect()}
    assert flow == {(r["lang"], r["word"]): r["n"] for r in words.where("n >= 12").collect()}


def test_unary_paths_are_compacted(spark):
    passage = [f"w{i}" for i in range(40)]
    rows = [("en", " ".join(passage))] * 30 + [("en", "x " + " ".join(passage[20:24]) + " y")] * 30
    docs = spark.createDataFrame(rows, "lang string, text string")
    dictionary = collocation.Dictionary(collocation.count_words(docs), 30)
    counts = collocation.flow_counts(collocation.count_edges(docs, dictionary), 30)
    paths = collocation.compact_paths(counts).collect()
    lengths = Counter(r["path"] for r in paths)
    # The passage up to the shared words, the passage behind them, their own edge, and the two that lead elsewhere.
    assert sorted(lengths.values(), reverse=True) == [20, 16, 1, 1, 1]
    for path, count in lengths.items():
        assert sorted(r["steps"] for r in paths if r["path"] == path) == list(range(count))
        assert len({r["n"] for r in paths if r["path"] == path}) == 1


def variants(rows, min_chars, min_count, ratio, drop_every):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = low(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if drop_every and h % drop_every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {word: count for word, count in n.items() if len(word) >= min_chars and count >= min_count}

    def one_edit(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    near = {word: [other for other in n if one_edit(word, other)] for word in n}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda other: (-n[other], other), default=None)
        if best and n[best] >= ratio * n[word]:
            form[word] = best
    answer = set()
    for word in n:
        root = word
        while root in form:
            root = form[root]
        answer.add((word, form.get(word), root, n[word], len(near[word]), n.get(form.get(word))))
    return answer


def spelled_rows():
    rng, rows = random.Random(8), []
    letters = "abceäéßÿ÷×"
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(6, 10))) for _ in range(12)] + ["aaaaaaa", "ababababab", "z" * 300]
    for i in range(150):
        said = []
        for _ in range(25):
            word = rng.choice(words[: rng.choice([2, 6, len(words)])])
            for _ in range(rng.choice([0, 0, 0, 1, 2])):
                at = rng.randrange(len(word))
                word = rng.choice([word[:at] + word[at + 1 :], word[:at] + rng.choice(letters) + word[at:], word[:at] + rng.choice(letters) + word[at + 1 :]])
            said.append(rng.choice([word, word.upper() if word.isascii() else word]))
        rows.append((None if i % 50 == 7 else i, rng.choice([" ", "1", "_", "\n"]).join(said)))
    return [*rows, *rows[:5], (1, None), (2, "")]


@pytest.mark.parametrize("pass_blocks", [bloom.PASS_BLOCKS, 3])
def test_spelling_variants_are_those_of_all_pairs(spark, pass_blocks):
    rows = spelled_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = spelling.spelling_forms(docs, min_chars=5, ratio=3, drop_every=5, pass_blocks=pass_blocks).collect()
    wanted = variants(rows, 5, 2, 3, 5)
    assert any(w[1] and w[1] != w[2] for w in wanted)
    assert {tuple(r) for r in found} == wanted and len(found) == len(wanted)


def test_spelling_of_odd_documents(spark):
    rows = [(r[0], r[1]) for r in odd_rows()]
    found = spelling.spelling_forms(odd_docs(spark), min_chars=3, min_count=1, ratio=2, drop_every=31)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in found.collect()} == variants(rows, 3, 1, 2, 31)
    assert spelling.spelling_forms(no_docs(spark)).count() == 0


def test_filters_hold_every_key_and_little_else():
    keys = bloom.mix(np.arange(20_000, dtype=np.uint64))
    for passes in (bloom.plan_passes({7: len(keys)}), bloom.plan_passes({7: len(keys)}, pass_blocks=3000)):
        met, strange = np.zeros(len(keys), bool), 0
        for shards in passes:
            blocks = np.zeros(shards.total, np.uint64)
            _, block, bits = shards.places(7, keys)
            np.bitwise_or.at(blocks, block, bits)
            met[bloom.may_hold(blocks, shards, 7, keys)] = True
            strange += len(bloom.may_hold(blocks, shards, 7, bloom.mix(np.arange(10**6, 10**6 + 100_000, dtype=np.uint64))))
        assert met.all() and strange < 1000


def odd_texts():
    rng = random.Random(1)
    pool = ["<|endoftext|>", "<|endof", "text|>", " ", "  ", "\n", "\t", "don't", "'s", "'ll", "12", "½", "é", "ß", "́", "漢", "日本"]
    pool += ["֋", "₏", "\U0001f600", " ", " ", "\x1c", "…", "—", "hello", "\x00", "﻿", "\x85", "Ünïcode", "zqxjkv"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    return [*texts, "word " * 400_000 + "x" * 3000, "y" * 100_000, "", *(r[1] for r in odd_rows() if r[1])]


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
def test_token_counts_are_those_of_the_library(path):
    texts = odd_texts()
    counter = token_counts.Counter(path, token_counts.whole_tokens(path))
    wanted = [len(e.ids) for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert [counter.count(text) for text in texts] == wanted


def test_whole_tokens_encode_alone():
    tokenizer = Tokenizer.from_file(WORD_BPE)
    whole = set(token_counts.whole_tokens(WORD_BPE))
    assert 0 < len(whole) < tokenizer.get_vocab_size()
    assert all(len(tokenizer.model.tokenize(piece)) == 1 for piece in list(whole)[:500])


def test_characters_are_classed_as_the_library_does():
    library, split = Tokenizer.from_file(BYTE_BPE).pre_tokenizer, regex.compile(token_counts.BYTE_LEVEL_SPLIT)
    alike = regex.compile(f"[{token_counts.ALIKE}]")
    for point in [*range(0xD800), *range(0xE000, 0x10000)]:
        char = chr(point)
        if alike.match(char):
            text = f"x{char}1{char}!{char} {char}x"
            assert [m.span() for m in split.finditer(text)] == [at for _, at in library.pre_tokenize_str(text)], hex(point)


def test_token_counts_of_odd_documents(spark):
    rows = odd_rows()
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    wanted = []
    for r in rows:
        text = r[1] or ""
        n = len(tokenizer.encode(text, add_special_tokens=False).ids)
        wanted.append((r[0], len(text.encode()), n, n > 512))
    found = token_counts.count_tokens(odd_docs(spark), BYTE_BPE, 512).collect()
    assert sorted(map(tuple, found)) == sorted(wanted)
    assert token_counts.count_tokens(no_docs(spark), BYTE_BPE, 512).count() == 0
    no_id = spark.createDataFrame([(None, "a b")], "doc_id long, text string")
    assert [tuple(r) for r in token_counts.count_tokens(no_id, BYTE_BPE, 1).collect()] == [(None, 3, 2, True)]
    with pytest.raises(ValueError, match="only tokenizer files"):
        token_counts.count_tokens(no_id, public_tokenizers.path("piece_bpe_32k.model"), 1)
