"""Operators that lay documents out: token shards, packing, sharding."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lavra.llm import packing, sharding, token_store
from lavra.llm.staging import rank_within
from lavra.llm.tokens import Encoder
from lavra.llm.wavelet import WaveletFile, WaveletMatrix, to_bytes
from lavra.scratch import new_folder
from tests.llm.fixtures import no_docs, odd_docs, odd_rows, prose

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def encoded(path, texts, end):
    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    return [np.array([*e.ids, end], "<u4") for e in whole.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_encoder_equals_the_library(path):
    texts = [r[1] for r in odd_rows()] + ["a  b", "a \n b", "tab\tand nbsp   x", "don't it's I'LL we've", "\x1c x \x00 y", "été ﬁ ½ ² ª", " lead", "trail ", "日本語 テキスト", "🙂 👩‍👩‍👧 x"]
    coder = Encoder(path)
    for _ in range(2):
        ids, sizes = coder.encode([t or "" for t in texts])
        parts = np.split(ids, np.cumsum(sizes)[:-1])
        for text, got, want in zip(texts, parts, encoded(path, texts, 0)):
            assert got.tolist() == want[:-1].tolist(), text


@pytest.mark.parametrize(("n", "high"), [(1, 1), (2, 2), (1000, 7), (70000, 300), (0, 1)])
def test_wavelet_matrix_and_file(n, high):
    rng = np.random.default_rng(n)
    symbols = rng.integers(0, high, n).astype(np.uint16)
    built = WaveletMatrix.build(symbols, max(1, int(high).bit_length()))
    content = to_bytes(built, np.array([7, 9]), np.array([0, n // 2, n]))
    for matrix in (built, WaveletFile(content)):
        assert matrix.decode().tolist() == symbols.tolist()
        at = rng.integers(0, n, 50) if n else np.zeros(0, int)
        assert matrix.access(at).tolist() == symbols[at].tolist()
        for symbol in {0, high // 2, high - 1}:
            places = np.flatnonzero(symbols == symbol)
            assert matrix.count(symbol) == len(places)
            assert matrix.rank(symbol, at).tolist() == np.searchsorted(places, at).tolist()
            if len(places) and n < 5000:
                assert matrix.occurrences(symbol).tolist() == places.tolist()
    shard = WaveletFile(content)
    assert shard.document(1).tolist() == symbols[n // 2 :].tolist()
    with pytest.raises(ValueError, match="not a wavelet"):
        WaveletFile(b"abcd" + content)


def test_token_shards_hold_all_ids_in_order(spark):
    folder = new_folder(spark, "test-tokens")
    shards = token_store.write_tokens(odd_docs(spark), folder, WORD, end_id=1, shard_tokens=3000)
    rows = sorted(odd_rows(), key=lambda r: r[0])
    ids = encoded(WORD, [r[1] for r in rows], 1)
    base = {r["file"]: r["start"] for r in shards.collect()}
    got = sorted((r["doc_id"], base[r["file"]] + r["place"], r["n_tokens"], r["ids_crc32"]) for r in token_store.read_documents(spark, folder).collect())
    starts = np.cumsum([0, *map(len, ids)])[:-1]
    assert got == [(r[0], int(s), len(i), zlib.crc32(i.tobytes())) for r, s, i in zip(rows, starts, ids)]
    token = int(ids[-1][0])
    found = Counter(map(tuple, token_store.lookup_token(spark, folder, token).collect()))
    assert found == Counter((r[0], p) for r, i in zip(rows, ids) for p in np.flatnonzero(i == token).tolist())
    empty = new_folder(spark, "test-tokens")
    assert token_store.write_tokens(no_docs(spark), empty, WORD, end_id=1).count() == 0


def test_plan_places_every_item_once():
    rng = np.random.default_rng(9)
    for _ in range(30):
        capacity = int(rng.integers(5, 60))
        counts = Counter(rng.integers(1, capacity + 1, rng.integers(1, 400)).tolist())
        slots, bins = packing.plan_best_fit(counts, capacity)
        used = defaultdict(list)
        for length in counts:
            ranks = sorted((s.lo, s.hi) for s in slots if s.length == length)
            assert ranks[0][0] == 0 and ranks[-1][1] == counts[length]
            assert all(a[1] == b[0] for a, b in zip(ranks, ranks[1:]))
        for s in slots:
            for rank in range(s.lo, s.hi):
                used[s.first + (rank - s.lo) // s.each].append((s.offset + (rank - s.lo) % s.each * s.length, s.length))
        assert set(used) == set(range(bins))
        for items in used.values():
            ends = [0]
            for offset, length in sorted(items):
                assert offset == ends[-1]
                ends.append(offset + length)
            assert ends[-1] <= capacity
        total = sum(n * c for n, c in counts.items())
        assert bins <= 11 / 9 * max(-(-total // capacity), 1) + 6 / 9 + 1


def check_packed(rows, ids, capacity):
    by_doc, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc, pieces in by_doc.items():
        copies = [i for d, i in ids if d == doc]
        assert Counter((p["piece"], p["start"], p["length"], p["ids_crc32"]) for p in pieces) == Counter(
            (k, s, e - s, zlib.crc32(i[s:e].tobytes()))
            for i in copies
            for k, (s, e) in enumerate(zip([0, *range((len(i) - 1) % capacity + 1, len(i), capacity)], range((len(i) - 1) % capacity + 1, len(i) + 1, capacity)))
        )
    for items in sequences.values():
        end = 0
        for offset, length in sorted(items):
            assert offset == end
            end += length
        assert end <= capacity


def test_packing(spark):
    rows = odd_rows()
    ids = list(zip([r[0] for r in rows], encoded(BYTE, [r[1] for r in rows], 2)))
    for capacity in (1024, 16):
        check_packed(packing.pack(odd_docs(spark), BYTE, 2, capacity).collect(), ids, capacity)
    assert packing.pack(no_docs(spark), BYTE, 2).count() == 0


def test_deal_class_equals_a_plain_heap():
    import heapq

    for loads, count, weight in ([0.0] * 4, 10, 3.0), ([5.0, 0.0, 9.0], 1, 2.0), ([5.0, 0.0, 9.0], 20, 2.5), ([1e9, 0.0], 1000, 1e6):
        heap = [(load, i) for i, load in enumerate(loads)]
        heapq.heapify(heap)
        given = [0] * len(loads)
        for _ in range(count):
            load, i = heapq.heappop(heap)
            given[i] += 1
            heapq.heappush(heap, (load + weight, i))
        got = sharding.deal_class(list(loads), count, weight)
        ends = lambda g: sorted(load + n * weight for load, n in zip(loads, g))
        assert sum(got) == count
        assert max(ends(got)) == pytest.approx(max(ends(given)))


def test_shards(spark):
    rows = [*odd_rows(), *[(1000 + i, prose(i, 1 + i % 90), None, None, 0, 0, "", "", "", 0) for i in range(600)], *[(5000 + i, "the same text", None, None, 0, 0, "", "", "", 0) for i in range(300)]]
    docs = spark.createDataFrame(rows, odd_docs(spark).schema)
    found = sharding.assign_shards(docs, 5).collect()
    text = {r[0]: r[1] or "" for r in rows}
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == Counter((r[0], len(text[r[0]].encode()) + 1, zlib.crc32(text[r[0]].encode())) for r in rows)
    homes, load, slots = defaultdict(set), Counter(), defaultdict(list)
    for r in found:
        homes[text[r["doc_id"]]].add(r["shard"])
        load[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(len(shards) == 1 for shards in homes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(len(prose(6, 6000)) + 1, sum(load.values()) / 5)
    assert max(load.values()) <= 1.05 * largest
    assert sharding.assign_shards(no_docs(spark), 5).count() == 0


def test_ranks_of_a_hot_key_are_gapless(spark):
    df = spark.range(5000).selectExpr("id", "case when id % 3 = 0 then id % 7 end as k")
    found = rank_within(df, ["k"], [df["id"].desc()], "n", "test-ranks").collect()
    by = defaultdict(list)
    for r in sorted(found, key=lambda r: -r["id"]):
        by[r["k"]].append(r["n"])
    assert all(n == list(range(len(n))) for n in by.values())
    assert len(found) == 5000
