"""Fixed phrases of a corpus, from a weighted de Bruijn graph of its word sequences.

Only the longest grams are counted in the text: each is an edge from the node of
its first words to the node of its last words, and what is left at the end of a
piece is an edge to a sink. The count of a shorter gram is what flows out of its
node: the sum of the edges that begin with it, corrected by the piece ends that
do. In sorted order these are neighbours, so one shuffle by ranges gives the
counts of all sizes. Paths of nodes with one way in and one way out are compacted;
their inner nodes share the count of the path.

Frequent words are written as one character each, so that a gram is a short text.
Words too rare for any phrase cut a piece, which changes no count of a phrase.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.llm import bloom
from lavra.llm.staging import chunks, rank_within, stage

#: Words with a character of their own, and the longest of these in bytes: 16 MB at most.
DICTIONARY_WORDS = 1 << 18
DICTIONARY_BYTES = 64
#: The first character used, and the range that no text may hold.
FIRST_CODE, SURROGATES, AFTER_SURROGATES = 0x20, 0xD800, 0xE000
#: Entries that a task counts before it hands them on, and the bytes of a text worked on at once.
HELD = 250_000
BLOCK_BYTES = 1 << 20

SEPARATORS = b".,;:!?\n\x0b\x0c\r"
BREAK, SINK, LANG_END = "\n", "\x01", "\x00"
#: A word outside the dictionary is written out in hexadecimal between these.
OPEN, CLOSE = "\x02", "\x03"
LITERAL = f"{OPEN}[^{CLOSE}]*{CLOSE}"
TOKEN = re.compile(f"{LITERAL}|[^{OPEN}]")


def _table(separator: bytes) -> bytes:
    """A-Z to a-z, tab to space, piece separators to ``separator``."""
    table = bytearray(range(256))
    for upper in range(0x41, 0x5B):
        table[upper] = upper + 0x20
    table[0x09] = 0x20
    for mark in SEPARATORS:
        table[mark] = separator[0]
    return bytes(table)


WORDS_ONLY, PIECES = _table(b" "), _table(b"\n")


def _blocks(data: bytes) -> Iterator[bytes]:
    """Parts of a text that end before a space."""
    first = 0
    while len(data) - first > BLOCK_BYTES:
        cut = data.find(b" ", first + BLOCK_BYTES)
        if cut < 0:
            break
        yield data[first:cut]
        first = cut
    yield data[first:]


def _texts_by_lang(batch: pa.RecordBatch) -> dict[str, list[bytes]]:
    found = defaultdict(list)
    for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
        if text:
            found["und" if lang is None else lang].append(text)
    return found


def count_words(docs: DataFrame) -> DataFrame:
    """All words and their number per language: lang, word, n."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, Counter] = defaultdict(Counter)

        def handed_on() -> Iterator[pa.RecordBatch]:
            for lang, counter in held.items():
                words = pa.array([word.decode() for word in counter], pa.string())
                columns = [pa.array([lang] * len(words), pa.string()), words, pa.array(list(counter.values()), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "word", "n"])
            held.clear()

        for batch in chunks(batches, "text"):
            for lang, texts in _texts_by_lang(batch).items():
                for block in _blocks(b"\n".join(texts).translate(WORDS_ONLY)):
                    held[lang].update(block.split())
            if sum(map(len, held.values())) > HELD:
                yield from handed_on()
        yield from handed_on()

    counted = docs.select("lang", "text").mapInArrow(tally, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def code_points(count: int) -> list[str]:
    """So many different characters, none of them special here."""
    points = np.arange(FIRST_CODE, FIRST_CODE + count)
    return list(map(chr, np.where(points >= SURROGATES, points + AFTER_SURROGATES - SURROGATES, points).tolist()))


def _hash(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


class Coder(dict):
    """Characters by word. A word that is too rare breaks a piece; a frequent one without a character is written out."""

    def __init__(self, words: list[str], shards: bloom.Shards | None, blocks: np.ndarray | None):
        super().__init__(zip((word.encode() for word in words), code_points(len(words))))
        self.update({b"": "", b"\n": BREAK})
        self.shards, self.blocks = shards, blocks

    def __missing__(self, word: bytes) -> str:
        if self.blocks is None:
            return BREAK
        key = np.array([_hash(word)], np.uint64)
        maybe = len(bloom.may_hold(self.blocks, self.shards, 0, key))
        return f"{OPEN}{word.hex()}{CLOSE}" if maybe else BREAK

    def code(self, block: bytes) -> str:
        """The words of pieces, as characters, with a break at piece ends and rare words."""
        words = block.replace(b"\n", b" \n ").split(b" ")
        if self.blocks is None:
            return "".join(map(self.get, words, repeat(BREAK)))
        return "".join(map(self.__getitem__, words))


class Dictionary:
    """The words that can be in a phrase: the most frequent by character, the others through a Bloom filter.

    Both are of bounded size. A filter that is too full only lets rare words
    pass, whose grams are counted and then found too rare.
    """

    def __init__(self, words: DataFrame, min_count: int, size: int = DICTIONARY_WORDS):
        frequent = words.where(F.col("n") >= min_count).groupBy("word").agg(F.max("n").alias("n"))
        short = F.octet_length("word") <= DICTIONARY_BYTES
        level = F.when(short, F.floor(F.log2("n"))).otherwise(-1).cast("int")
        frequent = stage(frequent.withColumn("level", level), "phrase-words")
        levels = {row["level"]: row["count"] for row in frequent.groupBy("level").count().collect()}
        least, room = 64, size
        while least > 0 and levels.get(least - 1, 0) <= room:
            least -= 1
            room -= levels.get(least, 0)
        chosen = frequent.where(F.col("level") >= least).select("word", "n").toArrow()
        order = np.argsort(-chosen.column("n").to_numpy(), kind="stable")
        self.words = chosen.column("word").take(pa.array(order)).to_pylist()
        left = sum(count for at, count in levels.items() if at < least)
        self.shards = self.blocks = None
        if left:
            blocks = min(bloom.PASS_BLOCKS, max(1, left * bloom.KEY_BITS // 64))
            self.shards = bloom.Shards({0: np.zeros(1, np.uint64)}, {0: np.array([blocks], np.uint64)}, blocks)
            self.blocks = bloom.build(_word_hashes(frequent.where(F.col("level") < least)), self.shards)


def decoded(gram: str, word_of: dict[str, str]) -> str:
    """The words of a coded gram, joined by spaces."""
    return " ".join(bytes.fromhex(token[1:-1]).decode() if token[0] == OPEN else word_of[token] for token in TOKEN.findall(gram))


def _word_hashes(words: DataFrame) -> DataFrame:
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.array([_hash(word.encode()) for word in batch.column("word").to_pylist()], np.uint64)
            kinds = pa.array(np.zeros(len(keys), np.int32))
            yield pa.RecordBatch.from_arrays([kinds, pa.array(keys.view(np.int64))], ["kind", "key"])

    return words.select("word").mapInArrow(hashed, "kind int, key long")


def _pieces_grams(piece: str, longest: int) -> list[str]:
    """The longest grams of a coded piece, and from each of its last words on an edge to the sink."""
    tokens = piece if OPEN not in piece else TOKEN.findall(piece)
    last = max(0, len(tokens) - longest + 1)
    if tokens is piece:
        return [piece[i : i + longest] for i in range(last)] + [piece[i:] + SINK for i in range(last, len(tokens))]
    ends = ["".join(tokens[i:]) + SINK for i in range(last, len(tokens))]
    return ["".join(tokens[i : i + longest]) for i in range(last)] + ends


def count_edges(docs: DataFrame, dictionary: Dictionary, longest: int = 4) -> DataFrame:
    """The edges of the graph, counted task by task: key (language and coded gram) and n.

    Tasks count before they hand on, so a phrase that fills a third of the text is one row a task.
    """
    sent = docs.sparkSession.sparkContext.broadcast((dictionary.words, dictionary.shards, dictionary.blocks))

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(*sent.value)
        held: dict[str, Counter] = defaultdict(Counter)

        def handed_on(lang: str) -> pa.RecordBatch:
            counter = held.pop(lang)
            said = pc.binary_join_element_wise(lang + LANG_END, pa.array(list(counter), pa.string()), "")
            return pa.RecordBatch.from_arrays([said, pa.array(list(counter.values()), pa.int64())], ["key", "n"])

        for batch in chunks(batches, "text"):
            for lang, texts in _texts_by_lang(batch).items():
                coded = "".join(map(coder.code, _blocks(b"\n".join(texts).translate(PIECES))))
                counter = held[lang]
                for piece, times in Counter(coded.split(BREAK)).items():
                    if times == 1:
                        counter.update(_pieces_grams(piece, longest))
                    else:
                        for gram in _pieces_grams(piece, longest):
                            counter[gram] += times
                if len(counter) > HELD:
                    yield handed_on(lang)
        for lang in list(held):
            yield handed_on(lang)

    return docs.select("lang", "text").mapInArrow(tally, "key string, n long")


def _size(gram: Column) -> Column:
    """The number of words of a coded gram."""
    return F.length(F.when(gram.contains(OPEN), F.regexp_replace(gram, LITERAL, "x")).otherwise(gram))


def _part(gram: Column, first: int, count: int) -> Column:
    """So many words of a coded gram, from the word ``first`` (from 0)."""
    token = f"(?:{LITERAL}|[^{OPEN}])"
    written = F.regexp_extract(gram, f"^{token}{{{first}}}({token}{{{count}}})", 1)
    return F.when(gram.contains(OPEN), written).otherwise(F.substring(gram, first + 1, count))


def flow_counts(edges: DataFrame, min_count: int, longest: int = 4) -> DataFrame:
    """Counts of all grams of 1 to ``longest`` words that occur at least ``min_count`` times: lang, gram, size, n.

    ``edges`` must be a written table. Sorted by ranges, all edges that begin with a gram lie side by
    side, so each run of them sums what flows out of its nodes and keeps the frequent ones. Only
    the nodes at the ends of a run may go on in the next one: they are kept at any count and
    summed again.
    """

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _flow(batch.column("key"), batch.column("n").to_numpy(), min_count, longest)

    key = F.col("key")
    ranges = edges.repartitionByRange(key).sortWithinPartitions(key)
    sums = ranges.mapInArrow(summed, "lang string, gram string, size int, n long")
    return sums.groupBy("lang", "gram", "size").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _tokens(keys: pa.StringArray, longest: int) -> np.ndarray:
    """One row of numbers per key: its language and each of its words, 0 where there is none."""
    first = keys[0].as_py()
    lang = first[: first.rindex(LANG_END) + 1]
    tokens = np.zeros((len(keys), longest + 1), np.uint32)
    if pc.all(pc.starts_with(keys, lang)).as_py():
        grams = pc.utf8_slice_codeunits(keys, len(lang))
        if not pc.any(pc.match_substring_regex(grams, f"[{OPEN}{LANG_END}]")).as_py():
            # One language and no written-out word: a word is a character.
            size = pc.utf8_length(grams).to_numpy()
            said = np.frombuffer(_joined(grams).encode("utf-32-le"), np.uint32)
            at = np.arange(len(said)) - np.repeat(np.cumsum(size) - size, size)
            tokens[np.repeat(np.arange(len(keys)), size), at + 1] = np.where(said == ord(SINK), 0, said)
            return tokens
    number: dict[str, int] = {}
    for row, key in zip(tokens, keys.to_pylist()):
        lang, _, gram = key.rpartition(LANG_END)
        said = [number.setdefault(token, len(number) + 1) for token in [lang + LANG_END, *TOKEN.findall(gram.rstrip(SINK))]]
        row[: len(said)] = said
    return tokens


def _joined(texts: pa.StringArray) -> str:
    """All texts in one, straight from their bytes."""
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    return data[int(ends[0]) : int(ends[-1])].to_pybytes().decode()


def _flow(keys: pa.StringArray, n: np.ndarray, min_count: int, longest: int) -> pa.RecordBatch:
    """What flows out of the nodes of a sorted run of edges: frequent nodes, and at any count those at both ends of the run."""
    tokens = _tokens(keys, longest)
    changed = np.ones(len(keys), bool)
    changed[1:] = tokens[1:, 0] != tokens[:-1, 0]
    found: list[tuple[str, str, int, int]] = []
    for size in range(1, longest + 1):
        changed[1:] |= tokens[1:, size] != tokens[:-1, size]
        first = np.flatnonzero(changed)
        sums = np.add.reduceat(n, first)
        kept = sums >= min_count
        kept[[0, -1]] = True
        for at, total in zip(first[kept].tolist(), sums[kept].tolist()):
            if tokens[at, size]:
                lang, _, gram = keys[at].as_py().rpartition(LANG_END)
                gram = gram.rstrip(SINK)
                found.append((lang, gram[:size] if OPEN not in gram else "".join(TOKEN.findall(gram)[:size]), size, total))
    types = [pa.string(), pa.string(), pa.int32(), pa.int64()]
    columns = list(zip(*found)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["lang", "gram", "size", "n"])


def compact_paths(counts: DataFrame, longest: int = 4) -> DataFrame:
    """Edges along paths whose inner nodes have one way in and one way out.

    One row per frequent edge: lang, gram, n; ``path``, the last edge of its
    path; ``steps``, how many edges follow on it. All edges of a path have the
    same weight, which is the count of its inner nodes, too. A node is an inner
    one when an edge into it and an edge out of it each have its whole count;
    every occurrence ends somewhere, so such paths never close to a ring. Each
    round doubles the steps taken.
    """
    edges = counts.where(F.col("size") == longest).select(
        "lang", "gram", "n", _part(F.col("gram"), 0, longest - 1).alias("first"), _part(F.col("gram"), 1, longest - 1).alias("last")
    )
    nodes = counts.where(F.col("size") == longest - 1).select("lang", F.col("gram").alias("last"), "n")
    follows = edges.select("lang", "n", F.col("first").alias("last"), F.col("gram").alias("next"))
    inner = nodes.join(follows, ["lang", "last", "n"])
    start = edges.join(inner, ["lang", "last", "n"], "left")
    step = F.when(F.col("next").isNull(), 0).otherwise(1)
    reached = stage(start.select("lang", "gram", "n", F.coalesce("next", "gram").alias("path"), step.alias("steps")), "phrase-paths")
    while True:
        ahead = reached.select("lang", F.col("gram").alias("path"), F.col("path").alias("_path"), F.col("steps").alias("_steps"))
        ahead = ahead.where("_steps > 0")
        if not reached.join(ahead, ["lang", "path"], "left_semi").limit(1).count():
            return reached
        joined = reached.join(ahead, ["lang", "path"], "left")
        steps = F.col("steps") + F.coalesce("_steps", F.lit(0))
        reached = stage(joined.select("lang", "gram", "n", F.coalesce("_path", "path").alias("path"), steps.alias("steps")), "phrase-paths")


def _contained(paths: DataFrame, counts: DataFrame, longest: int) -> DataFrame:
    """Shorter grams with the largest count of a longer one around them: lang, gram, longer.

    On a path only the first words of an edge count: the rest is in the next edge, with the same weight.
    """
    gram = F.col("gram")
    firsts = [_part(gram, 0, size) for size in range(2, longest)]
    others = [_part(gram, at, size) for size in range(2, longest) for at in range(1, longest - size + 1)]
    parts = F.when(F.col("steps") > 0, F.array(*firsts)).otherwise(F.array(*firsts, *others))
    around = paths.select("lang", F.explode(parts).alias("gram"), "n")
    for size in range(3, longest):
        parts = [_part(gram, at, short) for short in range(2, size) for at in range(size - short + 1)]
        around = around.unionByName(counts.where(F.col("size") == size).select("lang", F.explode(F.array(*parts)).alias("gram"), "n"))
    return around.groupBy("lang", "gram").agg(F.max("n").alias("longer"))


def _scored(candidates: DataFrame, counts: DataFrame, longest: int) -> DataFrame:
    """Candidates with the cut of least score: lang, gram, a, l, r, score."""
    gram = F.col("gram")
    cuts = F.array(
        *(
            F.when(F.col("size") == size, F.struct(F.lit(k).alias("k"), _part(gram, 0, k).alias("left"), _part(gram, k, size - k).alias("right")))
            for size in range(2, longest + 1)
            for k in range(1, size)
        )
    )
    rows = candidates.select("lang", "gram", F.col("n").alias("a"), F.explode(F.filter(cuts, lambda c: c.isNotNull())).alias("cut"))
    rows = rows.select("lang", "gram", "a", "cut.*")
    known = counts.select("lang", "gram", "n")
    rows = rows.join(known.select("lang", F.col("gram").alias("left"), F.col("n").alias("l")), ["lang", "left"])
    rows = rows.join(known.select("lang", F.col("gram").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    rows = rows.withColumn("score", F.expr("cast((cast(2000000 as decimal(20, 0)) * a) div (l + r) as long)"))
    return rows.groupBy("lang", "gram", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select("lang", "gram", "a", "cut.l", "cut.r", "cut.score")


def _decoded(rows: DataFrame, dictionary: Dictionary) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(dictionary.words)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_of = dict(zip(code_points(len(sent.value)), sent.value))
        for batch in batches:
            phrases = [decoded(gram, word_of) for gram in batch.column("gram").to_pylist()]
            at = batch.schema.get_field_index("gram")
            yield batch.set_column(at, "phrase", pa.array(phrases, pa.string()))

    schema = ", ".join(f"{'phrase' if f.name == 'gram' else f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(decode, schema)


def mine_phrases(docs: DataFrame, min_count: int = 30, longest: int = 4, share: int = 80, top: int = 2000, size: int = DICTIONARY_WORDS) -> DataFrame:
    """The strongest fixed phrases of each language of ``docs`` (``lang``, ``text``; other columns are not read).

    Texts are lower-cased (A-Z) and split at ``.,;:!?`` and line breaks into
    pieces, these at spaces and tabs into words. A phrase has 2 to ``longest``
    words of one piece and occurs ``a >= min_count`` times. Of its cuts into
    two parts, which occur ``l`` and ``r`` times, the least ``score``
    floor(2000000 a / (l + r)) counts (ties: the shortest first part). A phrase goes
    when a longer one around it occurs at least ``share`` % as often. The first
    ``top`` of each language come back by score, then ``a`` (both falling),
    then phrase (UTF-8 order): lang, rank (from 1), phrase, a, l, r, n (all words of the language), score.

    NULL ``lang`` is ``und``; NULL and empty texts hold no words; repeated rows
    count again; an empty table gives no rows. Very long texts are read in blocks; a
    piece is never cut but at words too rare for a phrase.
    """
    words = stage(count_words(docs), "phrase-vocabulary")
    dictionary = Dictionary(words, min_count, size)
    edges = stage(count_edges(docs, dictionary, longest), "phrase-edges")
    counts = stage(flow_counts(edges, min_count, longest), "phrase-counts")
    paths = compact_paths(counts, longest)
    candidates = counts.where(F.col("size") >= 2).join(_contained(paths, counts, longest), ["lang", "gram"], "left")
    wide = "cast(100 as decimal(20, 0)) * longer >= cast({} as decimal(20, 0)) * n"
    candidates = candidates.where(f"longer is null or not ({wide.format(share)})")
    phrases = _decoded(_scored(candidates, counts, longest), dictionary)
    ranked = rank_within(phrases, ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], "place", "phrase-ranks")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    best = ranked.where(F.col("place") < top).join(totals, "lang")
    return best.select("lang", (F.col("place") + 1).alias("rank"), "phrase", "a", "l", "r", "n", "score")
