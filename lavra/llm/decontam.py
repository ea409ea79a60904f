"""Benchmark decontamination: an FM-index per shard of training text, searched for test phrases."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.llm.fm_index import BREAK, FMIndex
from lavra.llm.staging import chunks, stage, texts_of

WINDOW = 10
#: Words of text per shard of the index.
SHARD_WORDS = 1 << 21
#: Bytes of test items that one pass searches for; more items take more passes.
BLOCK_BYTES = 16 << 20
#: A-Z lower-cased; all ASCII but digits and letters parts words; bytes of other letters stay.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(FOLD).split()


class Phrases:
    """The windows of a block of test items over their own vocabulary; symbol 0 is every other word."""

    def __init__(self, items: list[tuple[object, str | None]], window: int = WINDOW):
        self.symbol: dict[bytes, int] = {}
        grouped: dict[int, list[tuple[tuple[int, ...], int]]] = {}
        numbers: dict[object, int] = {}
        for item_id, text in items:
            said = [self.symbol.setdefault(w, len(self.symbol) + 1) for w in words_of(text or "")]
            if not said:
                continue
            number, size = numbers.setdefault(item_id, len(numbers)), min(window, len(said))
            for start in range(len(said) - size + 1):
                grouped.setdefault(size, []).append((tuple(said[start : start + size]), number))
        self.items = list(numbers)
        #: By window length: distinct windows, and (window, item) rows.
        self.windows = {}
        for size, found in grouped.items():
            rows, of = np.unique(np.array([w for w, _ in found], np.int64).reshape(-1, size), axis=0, return_inverse=True)
            self.windows[size] = rows, np.unique(np.stack([of.ravel(), [i for _, i in found]], axis=1), axis=0)
        self.shortest = min(self.windows, default=0)

    def search(self, texts: list[list[bytes]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text of words: which words lie in an occurring window, and the items with one.

        The index holds the stretches of test words that are long enough for a
        window; any other word ends a stretch, as no window can pass it.
        """
        counts = np.fromiter(map(len, texts), np.int64, len(texts))
        hits, found = [np.zeros(n, bool) for n in counts], [np.zeros(0, np.int64)] * len(texts)
        get = self.symbol.get
        said = [np.fromiter((get(w, BREAK) for w in words), np.int32, len(words)) for words in texts]
        flat = np.concatenate([x for pair in zip(said, [np.zeros(1, np.int32)] * len(said)) for x in pair]) if said else np.zeros(0, np.int32)
        if not self.shortest or not len(flat):
            return list(zip(hits, found))
        known = np.diff(np.concatenate([[0], (flat != BREAK).astype(np.int8), [0]]))
        lo, hi = np.flatnonzero(known == 1), np.flatnonzero(known == -1)
        long = hi - lo >= self.shortest
        lo, hi = lo[long], hi[long]
        if not len(lo):
            return list(zip(hits, found))
        size = hi - lo + 1  # with the break behind
        end = np.cumsum(size)
        place = np.arange(end[-1]) + np.repeat(lo - (end - size), size)
        shard = flat[place]
        index = FMIndex(shard)
        first = np.cumsum(counts + 1) - counts - 1
        pairs = []
        for length, (windows, of) in self.windows.items():
            low, high = index.ranges(windows)
            n = np.maximum(high - low, 0)
            if not n.any():
                continue
            which = np.repeat(np.arange(len(windows)), n)
            rows = np.arange(n.sum()) + np.repeat(low - (np.cumsum(n) - n), n)
            at = place[index.locate(rows)]
            doc = np.searchsorted(first, at, "right") - 1
            edge = np.zeros(len(flat) + 1, np.int32)
            np.add.at(edge, at, 1)
            np.add.at(edge, at + length, -1)
            covered = np.cumsum(edge)[:-1] > 0
            for d in np.unique(doc):
                hits[d] |= covered[first[d] : first[d] + counts[d]]
            seen = np.unique(np.stack([which, doc], axis=1), axis=0)
            left, right = np.searchsorted(of[:, 0], seen[:, 0]), np.searchsorted(of[:, 0], seen[:, 0], "right")
            n = right - left
            pairs.append(np.stack([np.repeat(seen[:, 1], n), of[np.arange(n.sum()) + np.repeat(left - (np.cumsum(n) - n), n), 1]], axis=1))
        if pairs:
            every = np.unique(np.concatenate(pairs), axis=0)
            for d in np.unique(every[:, 0]):
                found[d] = every[every[:, 0] == d, 1]
        return list(zip(hits, found))


def item_blocks(benchmark: DataFrame, id_col: str, block_bytes: int = BLOCK_BYTES) -> Iterator[list]:
    """The test items (a stated query set) in blocks of bounded bytes, one at a time."""
    held, size = [], 0
    for row in benchmark.select(F.col(id_col).alias("item"), "text").toLocalIterator():
        held.append((row["item"], row["text"]))
        size += len(row["text"] or "") * 2
        if size >= block_bytes:
            yield held
            held, size = [], 0
    if held:
        yield held


def _groups(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[list[pa.RecordBatch], list[list[bytes]]]]:
    held, texts, size = [], [], 0
    for chunk in chunks(batches, "text"):
        held.append(chunk)
        more = [words_of(text) for text in texts_of(chunk, "text")]
        texts += more
        size += sum(map(len, more))
        if size >= limit:
            yield held, texts
            held, texts, size = [], [], 0
    if held:
        yield held, texts


def spans_of(hit: np.ndarray) -> list[tuple[int, int]]:
    """Merged spans [first word, end) of hit words."""
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Search ``docs`` (doc_id, text) for the windows of ``benchmark`` (item_id, text).

    A window is ``window`` consecutive words of an item; an item of fewer words
    is one window, one without words none. Words are runs of digits, letters
    and non-ASCII characters, A-Z lower-cased. NULL texts have no words.

    Returns per row of ``docs``: doc_id, n_words, spans (merged spans of words
    to remove, [first, end)), items (distinct item ids that occur). Repeated
    rows stay; other columns are ignored; an empty table gives no rows. The
    items go to the tasks in blocks of bounded size; each block is one pass.
    """
    thin = docs.select(F.col("doc_id").cast("long"), "text", F.monotonically_increasing_id().alias("row"))
    return _found(thin, item_blocks(benchmark, "item_id"), benchmark, window, shard_words).drop("row")


def _found(thin: DataFrame, blocks: Iterator[list], benchmark: DataFrame, window: int, shard_words: int) -> DataFrame:
    """:func:`find_contamination` of rows (doc_id, text, row) with their row, for the items of ``blocks``."""
    spark = thin.sparkSession
    kind = dict(benchmark.dtypes)["item_id"]
    schema = f"doc_id long, n_words long, spans array<struct<first:int,end:int>>, items array<{kind}>, row long"
    passes = []

    def one_pass(items: list) -> DataFrame:
        sent = spark.sparkContext.broadcast(items)

        def run(batches):
            phrases = Phrases(sent.value, window)
            for held, texts in _groups(batches, shard_words):
                result = iter(phrases.search(texts))
                at = 0
                for chunk in held:
                    here = [next(result) for _ in range(chunk.num_rows)]
                    names = phrases.items
                    yield pa.RecordBatch.from_arrays(
                        [
                            chunk.column("doc_id"),
                            pa.array([len(t) for t in texts[at : at + chunk.num_rows]], pa.int64()),
                            pa.array([[{"first": a, "end": b} for a, b in spans_of(hit)] for hit, _ in here], pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))),
                            pa.array([[names[i] for i in found] for _, found in here], pa.list_(arrow_kind)),
                            chunk.column("row"),
                        ],
                        names=["doc_id", "n_words", "spans", "items", "row"],
                    )
                    at += chunk.num_rows

        return thin.mapInArrow(run, schema)

    from pyspark.sql.pandas.types import to_arrow_type

    arrow_kind = to_arrow_type(benchmark.schema["item_id"].dataType)
    for items in blocks:
        passes.append(one_pass(items))
    if len(passes) <= 1:
        return passes[0] if passes else one_pass([])
    every = passes[0]
    for more in passes[1:]:
        every = every.unionByName(more)
    merged = stage(every, "passes").groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
    )
    joined = F.aggregate(
        "spans",
        F.array().cast("array<struct<first:int,end:int>>"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= s["first"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(F.element_at(done, -1)["first"].alias("first"), F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end")))),
        ).otherwise(F.concat(done, F.array(s))),
    )
    return merged.select("doc_id", "n_words", F.when(F.size("spans") > 0, joined).otherwise(F.col("spans")).alias("spans"), "items", "row")


def _cut(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of ``spans``; what lies between two hit words of a span goes too."""
    content = text.encode()
    inside = np.frombuffer(content.translate(FOLD), np.uint8) != 32
    edge = np.diff(np.concatenate([[0], inside.astype(np.int8), [0]]))
    lo, hi = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    out, at = [], 0
    for first, end in spans:
        out.append(content[at : lo[first]])
        at = hi[end - 1]
    return b"".join([*out, content[at:]]).decode()


def remove_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``docs`` with all occurring windows cut out of ``text``, and ``n_chars`` set anew if it exists.

    Cutting repeats until no window occurs, as the words around a cut meet. Each
    round finds the windows of all items before it cuts, however many passes they take.
    Documents without words after a cut go; others, NULL and empty ones included, stay
    unchanged. All columns come back.
    """
    blocks = item_blocks(benchmark, "item_id")
    items, more = next(blocks, None), next(blocks, None)
    if items is None:
        return docs
    if more is not None:
        return _removed(docs, benchmark, window, shard_words)
    spark = docs.sparkSession
    names = docs.columns
    sent = spark.sparkContext.broadcast(items)

    def run(batches):
        phrases = Phrases(sent.value, window)
        for held, texts in _groups(batches, shard_words):
            result, at = phrases.search(texts), 0
            for chunk in held:
                said, keep = chunk.column("text").to_pylist(), np.ones(chunk.num_rows, bool)
                for i in range(chunk.num_rows):
                    hit = result[at + i][0]
                    while hit.any():
                        said[i] = _cut(said[i], spans_of(hit))
                        again = words_of(said[i])
                        keep[i] = bool(again)
                        ((hit, _),) = phrases.search([again])
                at += chunk.num_rows
                columns = {n: chunk.column(n) for n in names}
                columns["text"] = pa.array(said, pa.string())
                if "n_chars" in columns:
                    length = pa.array([None if t is None else len(t) for t in said], columns["n_chars"].type)
                    columns["n_chars"] = length
                yield pa.RecordBatch.from_pydict(columns).filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def _removed(docs: DataFrame, benchmark: DataFrame, window: int, shard_words: int) -> DataFrame:
    """:func:`remove_contamination` for several blocks: rounds over the rows that the round before has cut."""

    def run(batches):
        for chunk in chunks(batches, "text"):
            spans = [[(s["first"], s["end"]) for s in found] for found in chunk.column("spans").to_pylist()]
            said = [_cut(text, found) for text, found in zip(chunk.column("text").to_pylist(), spans)]
            made = pa.RecordBatch.from_arrays([chunk.column("row"), pa.array(said, pa.string())], names=["row", "said"])
            yield made.filter(pa.array([bool(words_of(text)) for text in said], pa.bool_()))

    rows = stage(docs.select(F.struct(*docs.columns).alias("whole"), F.monotonically_increasing_id().alias("row")), "rows")
    done = []
    while True:
        thin = rows.select(F.lit(0).cast("long").alias("doc_id"), F.col("whole.text").alias("text"), "row")
        found = stage(_found(thin, item_blocks(benchmark, "item_id"), benchmark, window, shard_words).where(F.size("spans") > 0).select("row", "spans"), "hits")
        if found.isEmpty():
            break
        done.append(rows.join(found, "row", "left_anti").select("whole"))
        cut = thin.join(found, "row").select("row", "text", "spans").mapInArrow(run, "row long, said string")
        rows = stage(rows.join(cut, "row").select(F.col("whole").withField("text", F.col("said")).alias("whole"), "row"), "cut")
    every = rows.select("whole")
    for other in done:
        every = every.unionByName(other)
    every = every.select("whole.*")
    return every.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else every
