"""Reversible line dedup: sharded cuckoo filters in front of exact reference counts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.llm.cuckoo import CuckooFilter
from lavra.llm.staging import chunks, stage, texts_of

BLANK = b" \t\n\x0b\x0c\r"
MIN_POINTS = 10
#: Postings per shard of the store, which bounds the keys of a group and of a filter.
SHARD_LINES = 1 << 20
KEY = ["shard", "hash_a", "hash_b"]
#: Column of the lost keys beside the documents; a reserved name.
LOST = "_lavra_lost_lines"


def line_key(line: bytes, min_points: int = MIN_POINTS) -> bytes | None:
    """128 bits for the line's key, or None when the key is too short to count."""
    key = line.strip(BLANK)
    if len(key) < min_points or (not key.isascii() and len(key.decode()) < min_points):
        return None
    return xxhash.xxh3_128_digest(key.lower())


def _postings(min_points: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, "text"):
            keys, counts = [], []
            for text in texts_of(chunk, "text"):
                found = {line_key(line, min_points) for line in text.encode().split(b"\n")}
                found.discard(None)
                keys.extend(found)
                counts.append(len(found))
            halves = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
            ids = chunk.column("doc_id").cast(pa.int64())
            of = ids.take(pa.array(np.repeat(np.arange(len(counts)), counts)))
            yield pa.RecordBatch.from_arrays([pa.array(halves[:, 0]), pa.array(halves[:, 1]), of], names=["hash_a", "hash_b", "doc_id"])

    return run


def line_postings(docs: DataFrame, min_points: int = MIN_POINTS) -> DataFrame:
    """One row per document and distinct line key: hash_a, hash_b, doc_id."""
    thin = docs.select(F.col("doc_id").cast("long"), "text")
    return thin.mapInArrow(_postings(min_points), "hash_a long, hash_b long, doc_id long")


class LineStore:
    """The lines of a growing set of documents, kept in generations of tables below ``folder``.

    - ``postings``: which document holds which line key, and its sign (+1 put in, -1 taken out).
    - ``counts``: per key the exact number of references, the first and the last document;
      a later generation of a key replaces the earlier ones.
    - ``filters``: per shard a cuckoo filter of the keys that have a count above zero.

    ``insert`` asks the filters first: a key that they don't know is new, and only
    the others are joined with the counts. ``delete`` takes documents out again:
    their keys are counted anew from the postings and keys without references
    leave the filters, so inserting and deleting cancel each other.

    Document ids name documents: rows that share an id are one document with all
    their lines, and inserting an id twice counts twice until it is deleted.
    """

    def __init__(self, spark: SparkSession, folder: str, shards: int = 64, min_points: int = MIN_POINTS):
        self.spark, self.folder, self.shards, self.min_points = spark, folder, shards, min_points
        self.generation = 0

    def _save(self, df: DataFrame, table: str) -> DataFrame:
        path = f"{self.folder}/{table}/generation={self.generation}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _table(self, table: str, schema: str) -> DataFrame:
        if not self.generation:
            return self.spark.createDataFrame([], f"{schema}, generation int")
        paths = [f"{self.folder}/{table}/generation={g}" for g in range(1, self.generation + 1)]
        return self.spark.read.option("basePath", f"{self.folder}/{table}").schema(f"{schema}, generation int").parquet(*paths)

    def postings(self) -> DataFrame:
        return self._table("postings", "shard int, hash_a long, hash_b long, doc_id long, sign int")

    def live_postings(self) -> DataFrame:
        """Document and key, with the number of times that it is in."""
        return self.postings().groupBy(*KEY, "doc_id").agg(F.sum("sign").alias("refs")).where("refs > 0")

    def counts(self) -> DataFrame:
        """The exact count of each key: refs, first_doc, last_doc."""
        schema = "shard int, hash_a long, hash_b long, refs long, first_doc long, last_doc long"
        table = self._table("counts", schema)
        if self.generation <= 1:
            return table.drop("generation")
        newest = F.max_by(F.struct("refs", "first_doc", "last_doc"), "generation").alias("newest")
        return table.groupBy(*KEY).agg(newest).select(*KEY, "newest.*")

    def _filters(self, generation: int) -> DataFrame:
        if not generation:
            return self.spark.createDataFrame([], "shard int, filter binary")
        return self.spark.read.schema("shard int, filter binary").parquet(f"{self.folder}/filters/generation={generation}")

    def _update_filters(self, changes: DataFrame) -> None:
        """Apply (KEY, state): put in new keys (1), take out those without references (-1).

        One group per shard, of distinct keys only, so none is hot.
        A filter that has become too full is rebuilt from the counts.
        """
        old = self._filters(self.generation - 1)
        known = self.counts().where("refs > 0").select("shard", F.col("hash_a").alias("key"))
        changed = changes.where("state != 0").select("shard", F.col("hash_a").alias("key"), "state")

        def apply(key, left: pa.Table, right: pa.Table) -> pa.Table:
            keys = left.column("key").to_numpy().view(np.uint64)
            state = left.column("state").to_numpy()
            new, gone = np.unique(keys[state > 0]), np.unique(keys[state < 0])
            made = CuckooFilter.from_bytes(right.column("filter")[0].as_py()) if right.num_rows else CuckooFilter.sized(2 * len(new))
            made.delete(gone)
            content = made.to_bytes() if made.insert(new) else None
            return pa.table({"shard": pa.array([int(key[0].as_py())], pa.int32()), "filter": pa.array([content], pa.binary())})

        built = stage(changed.groupBy("shard").cogroup(old.groupBy("shard")).applyInArrow(apply, "shard int, filter binary"), "filters")

        def rebuild(table: pa.Table) -> pa.Table:
            keys = np.unique(table.column("key").to_numpy().view(np.uint64))
            size = CuckooFilter.sized(2 * len(keys))
            while not size.insert(keys):
                size = CuckooFilter(2 * len(size.table))
            return pa.table({"shard": table.column("shard").slice(0, 1).cast(pa.int32()), "filter": pa.array([size.to_bytes()], pa.binary())})

        full = built.where("filter is null").select("shard")
        again = known.join(full, "shard", "left_semi").groupBy("shard").applyInArrow(rebuild, "shard int, filter binary")
        self._save(built.where("filter is not null").unionByName(again), "filters")

    def _seen(self, keys: DataFrame, filters: DataFrame) -> DataFrame:
        """Keys that the filters may know: all known ones and very few others."""

        def ask(key, left: pa.Table, right: pa.Table) -> pa.Table:
            if not right.num_rows or not left.num_rows:
                return left.slice(0, 0)
            made = CuckooFilter.from_bytes(right.column("filter")[0].as_py())
            return left.filter(pa.array(made.contains(left.column("hash_a").to_numpy().view(np.uint64))))

        columns = "shard int, hash_a long, hash_b long"
        return keys.select(*KEY).groupBy("shard").cogroup(filters.groupBy("shard")).applyInArrow(ask, columns)

    def insert(self, docs: DataFrame) -> None:
        """Put ``docs`` (doc_id, text) in. Texts that are NULL or empty hold no key."""
        self.insert_postings(line_postings(docs, self.min_points))

    def insert_postings(self, lines: DataFrame) -> None:
        """Put rows of :func:`line_postings` in."""
        before, filters = self.counts(), self._filters(self.generation)
        self.generation += 1
        shard = (F.shiftrightunsigned("hash_a", 32) % self.shards).cast("int")
        put = self._save(lines.select(shard.alias("shard"), "hash_a", "hash_b", "doc_id", F.lit(1).alias("sign")), "postings")
        batch = put.groupBy(*KEY).agg(F.count("*").alias("refs"), F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))
        if self.generation == 1:
            merged = batch.withColumn("state", F.lit(1))
        else:
            batch = stage(batch, "batch-keys")
            seen = stage(self._seen(batch, filters), "seen-keys")
            known = before.join(seen, KEY, "left_semi").select(*KEY, F.col("refs").alias("r"), F.col("first_doc").alias("f"), F.col("last_doc").alias("l"))
            asked = batch.join(seen, KEY, "left_semi").join(known, KEY, "left")
            fresh = batch.join(seen, KEY, "left_anti").withColumn("state", F.lit(1))
            merged = asked.select(
                *KEY,
                (F.col("refs") + F.coalesce("r", F.lit(0))).alias("refs"),
                F.when(F.col("r") > 0, F.least("first_doc", "f")).otherwise(F.col("first_doc")).alias("first_doc"),
                F.when(F.col("r") > 0, F.greatest("last_doc", "l")).otherwise(F.col("last_doc")).alias("last_doc"),
                F.when(F.col("r") > 0, F.lit(0)).otherwise(F.lit(1)).alias("state"),
            ).unionByName(fresh)
        merged = stage(merged, "merged")
        self._save(merged.drop("state"), "counts")
        self._update_filters(merged)

    def delete(self, doc_ids: DataFrame) -> None:
        """Take documents (doc_id) out, each with all its references."""
        ids = doc_ids.select(F.col("doc_id").cast("long")).distinct()
        live = self.live_postings()
        gone = stage(live.join(ids, "doc_id", "left_semi").select(*KEY, "doc_id", "refs"), "gone")
        touched = gone.select(*KEY).distinct()
        left = (
            live.join(ids, "doc_id", "left_anti")
            .join(touched, KEY, "left_semi")
            .groupBy(*KEY)
            .agg(F.sum("refs").alias("refs"), F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))
        )
        merged = stage(
            touched.join(left, KEY, "left").select(*KEY, F.coalesce("refs", F.lit(0)).alias("refs"), "first_doc", "last_doc", F.when(F.col("refs").isNull(), F.lit(-1)).otherwise(F.lit(0)).alias("state")),
            "merged",
        )
        self.generation += 1
        self._save(gone.select(*KEY, "doc_id", (-F.col("refs")).cast("int").alias("sign")), "postings")
        self._save(merged.drop("state"), "counts")
        self._update_filters(merged)

    def drops(self) -> DataFrame:
        """Per document the keys whose lines it loses: another, smaller document holds them."""
        shared = self.counts().where((F.col("refs") > 1) & (F.col("first_doc") < F.col("last_doc"))).select(*KEY, "first_doc")
        rows = self.postings().drop("sign", "generation") if self.generation == 1 else self.live_postings()
        lost = rows.join(shared, KEY).where(F.col("doc_id") > F.col("first_doc"))
        return lost.groupBy("doc_id").agg(F.collect_set(F.struct("hash_a", "hash_b")).alias(LOST))

    def kept(self, docs: DataFrame, with_text: bool = False) -> DataFrame:
        """What stays of ``docs`` (doc_id, text): n_lines, n_dropped, kept_sha256, or the text itself.

        All lines of a lost key go, other lines are joined by line feeds. A NULL
        or empty text is one empty line. With ``with_text`` all columns of
        ``docs`` come back with the new text, and its length in ``n_chars`` if
        that column exists; NULL stays NULL.
        """
        points = self.min_points
        if with_text:
            met = docs.join(self.drops(), "doc_id", "left")
            names = docs.columns

            def cut(batches):
                for chunk in chunks(batches, "text"):
                    texts = []
                    for text, lost in zip(chunk.column("text").to_pylist(), chunk.column(LOST).to_pylist()):
                        texts.append(text if not lost or text is None else _without(text, lost, points)[0].decode())
                    columns = {n: chunk.column(n) for n in names}
                    columns["text"] = pa.array(texts, pa.string())
                    if "n_chars" in columns:
                        columns["n_chars"] = pa.array([None if t is None else len(t) for t in texts], columns["n_chars"].type)
                    yield pa.RecordBatch.from_pydict(columns)

            return met.select(*names, LOST).mapInArrow(cut, docs.schema)

        def digest(batches):
            for chunk in chunks(batches, "text"):
                lines, dropped, sha = [], [], []
                for text, lost in zip(texts_of(chunk, "text"), chunk.column(LOST).to_pylist()):
                    kept, n, m = _without(text, lost or [], points)
                    lines.append(n), dropped.append(m), sha.append(hashlib.sha256(kept).hexdigest())
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": chunk.column("doc_id").cast(pa.int64()),
                        "n_lines": pa.array(lines, pa.int64()),
                        "n_dropped": pa.array(dropped, pa.int64()),
                        "kept_sha256": pa.array(sha, pa.string()),
                    }
                )

        met = docs.select("doc_id", "text").join(self.drops(), "doc_id", "left")
        return met.select("doc_id", "text", LOST).mapInArrow(digest, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def _without(text: str, lost: list, min_points: int) -> tuple[bytes, int, int]:
    """The text without lines of lost keys, its number of lines, and of those dropped."""
    content = text.encode()
    if not lost:
        return content, content.count(b"\n") + 1, 0
    keys = {np.array([x["hash_a"], x["hash_b"]], "<i8").tobytes() for x in lost}
    lines = content.split(b"\n")
    stay = [line for line in lines if line_key(line, min_points) not in keys]
    return b"\n".join(stay), len(lines), len(lines) - len(stay)


def dedup_lines(docs: DataFrame, folder: str, parts: int = 2) -> LineStore:
    """A store below ``folder`` with all ``docs``, put in as ``parts`` batches by a hash of the id.

    The number of shards follows the number of postings, so a filter stays small.
    """
    lines = stage(line_postings(docs), "lines")
    store = LineStore(docs.sparkSession, folder, max(16, -(-lines.count() // SHARD_LINES)))
    for part in range(parts):
        store.insert_postings(lines.where(F.pmod(F.xxhash64("doc_id"), F.lit(parts)) == part))
    return store
