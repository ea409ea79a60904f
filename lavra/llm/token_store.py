"""Token ids in wavelet-matrix shards: written in ascending document order, read back by Spark."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lavra.llm.staging import chunks, stage, texts_of
from lavra.llm.tokens import encoder
from lavra.llm.wavelet import WaveletFile, WaveletMatrix, to_bytes

#: Tokens of a full shard. A document is never split, so the last one may exceed it.
SHARD_TOKENS = 1 << 22


def _save(folder: str, name: str, content: bytes) -> None:
    """Write beside, then rename: a repeated task leaves the same one file."""
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    attempt = TaskContext.get().taskAttemptId()
    with store.open_output_stream(f"{root}/_{name}.{attempt}") as out:
        out.write(content)
    store.move(f"{root}/_{name}.{attempt}", f"{root}/{name}")


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and write shards of ids into ``folder``.

    Each document's ids are followed by ``end_id``. Documents are in ascending
    doc_id order within a shard and across shards. A NULL text counts as empty;
    repeated ids stay, one after another; a NULL id sorts first and is kept as
    the smallest number. Other columns are ignored. An empty table writes no shard.

    ``folder`` must be open to all executors by an Arrow file system (file,
    hdfs, s3, gs). Returns one row per shard: part, seq, file, n_docs, n_tokens,
    start (ids of all documents before the shard).
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts, part, seq = encoder(tokenizer).encode, TaskContext.get().partitionId(), 0
        held_ids, held_sizes, held_docs, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal seq, held
            ids, sizes, doc_ids = (np.concatenate(x) for x in (held_ids, held_sizes, held_docs))
            bits = max(1, int(ids.max()).bit_length())
            small = ids.astype(np.uint16) if bits <= 16 else ids
            name = f"shard-{part:06d}-{seq:06d}.wvm"
            starts = np.concatenate([[0], np.cumsum(sizes)])
            _save(folder, name, to_bytes(WaveletMatrix.build(small, bits), doc_ids, starts))
            row = pa.RecordBatch.from_pydict(
                {"part": [part], "seq": [seq], "file": [name], "n_docs": [len(doc_ids)], "n_tokens": [len(ids)]},
                schema=pa.schema([("part", pa.int64()), ("seq", pa.int64()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]),
            )
            held_ids.clear(), held_sizes.clear(), held_docs.clear()
            seq, held = seq + 1, 0
            return row

        for chunk in chunks(batches, "text"):
            ids, sizes = encode_texts(texts_of(chunk, "text"))
            ends = np.cumsum(sizes)
            ids = np.insert(ids, ends, np.uint32(end_id))
            held_ids.append(ids)
            held_sizes.append(sizes + 1)
            held_docs.append(chunk.column("doc_id").fill_null(-(1 << 63)).to_numpy(zero_copy_only=False))
            held += len(ids)
            if held >= shard_tokens:
                yield flush()
        if held:
            yield flush()

    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    shards = stage(ordered.mapInArrow(encode, "part long, seq long, file string, n_docs long, n_tokens long"), "token-shards")
    # One row per part: no more of them than tasks of the write.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("in_part")).select("part", F.coalesce(F.sum("in_part").over(earlier), F.lit(0)).alias("before"))
    in_part = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum("n_tokens").over(in_part), F.lit(0))
    return shards.withColumn("within", within).join(parts, "part").select("part", "seq", "file", "n_docs", "n_tokens", (F.col("before") + F.col("within")).alias("start"))


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document of the shards: file, doc_id, place (in the shard), n_tokens, ids_crc32."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                shard = WaveletFile(content.as_py())
                ids = shard.decode().astype("<u4")
                starts = shard.starts
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(starts[:-1], starts[1:])]
                yield pa.RecordBatch.from_pydict(
                    {
                        "file": pa.array([path.rpartition("/")[2]] * shard.docs, pa.string()),
                        "doc_id": pa.array(shard.doc_ids, pa.int64()),
                        "place": pa.array(starts[:-1], pa.int64()),
                        "n_tokens": pa.array(np.diff(starts), pa.int64()),
                        "ids_crc32": pa.array(crc, pa.int64()),
                    }
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wvm").load(folder).select("path", "content")
    return files.mapInArrow(digest, "file string, doc_id long, place long, n_tokens long, ids_crc32 long")


def lookup_token(spark: SparkSession, folder: str, token: int) -> DataFrame:
    """Where a token occurs, by select in each shard: doc_id, position (in the document)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                shard = WaveletFile(content.as_py())
                at = shard.occurrences(token) if token >> shard.bits == 0 else np.zeros(0, np.int64)
                doc = np.searchsorted(shard.starts, at, "right") - 1
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(shard.doc_ids[doc], pa.int64()), "position": pa.array(at - shard.starts[doc], pa.int64())})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wvm").load(folder).select("content")
    return files.mapInArrow(find, "doc_id long, position long")
