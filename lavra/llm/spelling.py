"""Spelling variants: words of a corpus that differ by one letter, found through Bloom filters.

The vocabulary is counted on the cluster. Every word makes the words at one
deletion and the words at one replacement by a later letter; two words that
differ by one edit are so met from exactly one of them. Of what was made only a
rolling hash exists, which is probed against broadcast Bloom filters sharded by
length. What passes goes, as hashes, to a join with the vocabulary, and the
texts of each pair found are then compared.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.llm import bloom
from lavra.llm.staging import chunks, stage
from lavra.scratch import new_folder

#: Lengths with a class of their own in the filters; longer words share classes.
OWN_CLASSES = 64
#: Words counted in a task before they are handed on, and hashes made at once.
HELD_WORDS = 200_000
MADE_AT_ONCE = 1 << 18

_U = np.uint64
#: Odd, so that it can be divided by.
BASE = _U(0x9E3779B97F4A7C15)
BASE_INVERSE = _U(pow(int(BASE), -1, 1 << 64))
#: All letters a word can hold: a to z, and Latin-1 from U+00C0 on.
LETTERS = np.array([*range(0x61, 0x7B), *range(0xC0, 0x100)], np.uint8)
LETTER_VALUES = bloom.mix(np.arange(1, 257, dtype=np.uint64) * BASE)


def count_words(docs: DataFrame, min_chars: int = 7, min_count: int = 2, drop_every: int | None = None) -> DataFrame:
    """The words of ``text`` and how often they occur: ``word``, ``n``.

    A word is a maximal run of letters (A-Z, a-z, U+00C0 to U+00FF), A-Z
    lower-cased, of at least ``min_chars`` letters and ``min_count`` occurrences.
    With ``drop_every`` a run whose crc32 with its ``doc_id`` (NULL: empty) is
    divisible by it first loses one letter, which seeds a known rate of variants.
    NULL texts have no words; repeated rows count again.
    """
    run = re.compile("[a-zÀ-ÿ]{%d,}" % min_chars)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in chunks(batches, "text"):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                found = Counter(run.findall(text.lower().decode())) if text else {}
                if not drop_every:
                    held.update(found)
                    continue
                seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in found.items():
                    h = zlib.crc32(word.encode(), seed)
                    if h % drop_every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < min_chars:
                            continue
                    held[word] += n
            if len(held) > HELD_WORDS:
                yield _counted(held)
                held.clear()
        if held:
            yield _counted(held)

    counted = docs.select("doc_id", "text").mapInArrow(tally, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _counted(held: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])


def class_of(length: int) -> int:
    """The filter class of a length."""
    return length if length < OWN_CLASSES else OWN_CLASSES + length % OWN_CLASSES


def _keys(hashes: np.ndarray, length: int) -> np.ndarray:
    return bloom.mix(hashes + _U(length * int(BASE) % (1 << 64)))


def _terms(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per letter of words of one length: its share of the word's hash, and its power of the base."""
    length = letters.shape[1]
    powers = np.concatenate([np.ones(1, np.uint64), np.full(length - 1, BASE)])
    powers = np.cumprod(powers, dtype=np.uint64)[::-1]
    return LETTER_VALUES[letters] * powers, powers


def word_keys(letters: np.ndarray) -> np.ndarray:
    """The keys of words of one length, given as rows of Latin-1 bytes."""
    return _keys(_terms(letters)[0].sum(axis=1, dtype=np.uint64), letters.shape[1])


def edits(letters: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, word row and key of each word at one deletion or one replacement by a later letter.

    Deleting any of several equal neighbours gives one word, so it is made once.
    """
    length = letters.shape[1]
    terms, powers = _terms(letters)
    whole = terms.sum(axis=1, dtype=np.uint64)
    upto = np.cumsum(terms, axis=1, dtype=np.uint64)
    if length > 1:
        row, at = np.nonzero(np.concatenate([np.ones((len(letters), 1), bool), letters[:, 1:] != letters[:, :-1]], axis=1))
        # What stands before the deleted letter has one letter less behind it.
        shorter = (upto[row, at] - terms[row, at]) * BASE_INVERSE + (whole[row] - upto[row, at])
        yield length - 1, row, _keys(shorter, length - 1)
    step = max(1, MADE_AT_ONCE // (len(letters) * len(LETTERS)))
    for start in range(0, length, step):
        here = letters[:, start : start + step]
        row, at, new = np.nonzero(LETTERS[None, None, :] > here[:, :, None])
        change = (LETTER_VALUES[LETTERS[new]] - LETTER_VALUES[here[row, at]]) * powers[start + at]
        yield length, row, _keys(whole[row] + change, length)


def _by_length(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and letters of words of one length at a time, bounded in letters."""
    rows = defaultdict(list)
    for i, word in enumerate(words):
        rows[len(word)].append(i)
    for length, found in rows.items():
        step = max(1, MADE_AT_ONCE // (length * len(LETTERS)))
        for start in range(0, len(found), step):
            part = found[start : start + step]
            yield np.array(part), np.frombuffer(b"".join(words[i] for i in part), np.uint8).reshape(len(part), length)


def _latin(batch: pa.RecordBatch) -> list[bytes]:
    return [word.encode("latin-1") for word in batch.column("word").to_pylist()]


def with_keys(words: DataFrame) -> DataFrame:
    """The words with their ``key`` and the ``kind`` (class) of their length."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "word"):
            latin = _latin(batch)
            key = np.zeros(len(latin), np.uint64)
            for rows, letters in _by_length(latin):
                key[rows] = word_keys(letters)
            kind = pa.array([class_of(len(word)) for word in latin], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, kind, pa.array(key.view(np.int64))], ["word", "n", "kind", "key"])

    return words.select("word", "n").mapInArrow(keyed, "word string, n long, kind int, key long")


def _probe(words: DataFrame, shards: bloom.Shards, blocks: np.ndarray) -> DataFrame:
    """Words with the keys of those of their edits that the filters of this pass may hold."""
    sent = words.sparkSession.sparkContext.broadcast(blocks)

    def positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sent.value
        for batch in chunks(batches, "word"):
            n = batch.column("n")
            for rows, letters in _by_length(_latin(batch)):
                for length, row, keys in edits(letters):
                    hit = bloom.may_hold(held, shards, class_of(length), keys)
                    if len(hit):
                        at = pa.array(rows[row[hit]])
                        columns = [batch.column("word").take(at), n.take(at), pa.array(keys[hit].view(np.int64))]
                        yield pa.RecordBatch.from_arrays(columns, ["word", "n", "made"])

    return words.select("word", "n").mapInArrow(positives, "word string, n long, made long")


def near_pairs(words: DataFrame, pass_blocks: int = bloom.PASS_BLOCKS) -> DataFrame:
    """All pairs of ``words`` (``word`` distinct, ``n``) at one edit, once each: word, n, other, other_n.

    ``words`` must be a written table that :func:`with_keys` made, since passes read it again.
    """
    spark = words.sparkSession
    counts = {row["kind"]: row["count"] for row in words.groupBy("kind").count().collect()}
    folder = new_folder(spark, "spelling-positives")
    schema = "word string, n long, made long"
    for shards in bloom.plan_passes(counts, pass_blocks):
        blocks = bloom.build(words, shards)
        _probe(words, shards, blocks).write.mode("append").option("compression", "zstd").parquet(folder)
    if not counts:
        return spark.createDataFrame([], "word string, n long, other string, other_n long")
    others = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"), F.col("key").alias("made"))
    met = spark.read.schema(schema).parquet(folder).join(others, "made")
    # A key may be equal by chance: the texts decide.
    exact = met.where(F.levenshtein("word", "other", 1) == 1)
    return exact.select("word", "n", "other", "other_n").dropDuplicates(["word", "other"])


def follow_forms(forms: DataFrame) -> DataFrame:
    """The end of each chain: ``word``, ``root`` from ``word``, ``form``.

    Every round doubles the steps taken. A form occurs more often than its
    word, so chains end.
    """
    reached = stage(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "spelling-roots")
    while reached.where("moved").limit(1).count():
        next_step = reached.select(F.col("word").alias("_at"), F.col("root").alias("_further"))
        moved = F.col("_further").isNotNull()
        joined = reached.join(next_step, F.col("root") == F.col("_at"), "left")
        reached = stage(joined.select("word", F.coalesce("_further", "root").alias("root"), moved.alias("moved")), "spelling-roots")
    return reached.select("word", "root")


def spelling_forms(
    docs: DataFrame,
    min_chars: int = 7,
    min_count: int = 2,
    ratio: int = 10,
    drop_every: int | None = None,
    pass_blocks: int = bloom.PASS_BLOCKS,
) -> DataFrame:
    """Group spelling variants of the words of ``docs`` (``doc_id``, ``text``; other columns are not read).

    One row per word of :func:`count_words`: ``word``, ``n``; ``n_near``, the
    number of words at exactly one inserted, deleted or replaced letter;
    ``form``, the most frequent of these (ties: the smallest by code points) if
    it occurs at least ``ratio`` times as often as the word, else NULL;
    ``form_n``; and ``root``, where following forms ends (the word itself
    without a form). Words of any length are compared whole. An empty table, NULL and empty
    texts give no rows; rows repeated or sharing a ``doc_id`` all count.
    """
    words = stage(with_keys(count_words(docs, min_chars, min_count, drop_every)), "spelling-words")
    pairs = stage(near_pairs(words, pass_blocks), "spelling-pairs")
    both = pairs.unionByName(
        pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    )
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form")))
    near = both.groupBy("word", "n").agg(F.count("*").alias("n_near"), best.alias("best"))
    common = -F.col("best.less") >= ratio * F.col("n")
    near = stage(
        near.select("word", "n_near", F.when(common, F.col("best.form")).alias("form"), F.when(common, -F.col("best.less")).alias("form_n")),
        "spelling-near",
    )
    roots = follow_forms(near.where("form is not null"))
    return (
        words.select("word", "n")
        .join(near, "word", "left")
        .join(roots, "word", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
    )
