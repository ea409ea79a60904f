"""Write, audit, publish: tables change by renames of folders that have been checked.

What is written lies below ``_staged`` in the base folder, which Spark does not
read as data. Publishing is decided by one file, the manifest, which names every
folder that comes in and every one that goes. From then on it can be
finished by anyone: a rename that has been done is passed over. What
was staged without a manifest never counts.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.observation import Observation

STAGED = "_staged"
MANIFEST = "manifest.json"


class Folders:
    """The few file operations needed, through Hadoop, for any file system that Spark writes to."""

    def __init__(self, spark: SparkSession, base: str):
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._text = jvm.org.apache.commons.io.IOUtils
        self._utf8 = jvm.java.nio.charset.StandardCharsets.UTF_8
        self._system = self._path(base).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._system.exists(self._path(path))

    def children(self, path: str) -> list[str]:
        return sorted(status.getPath().getName() for status in self._system.listStatus(self._path(path))) if self.exists(path) else []

    def delete(self, path: str) -> None:
        self._system.delete(self._path(path), True)

    def rename(self, old: str, new: str) -> None:
        self._system.mkdirs(self._path(new).getParent())
        if not self._system.rename(self._path(old), self._path(new)):
            raise OSError(f"{old} cannot be renamed to {new}")

    def write(self, path: str, text: str) -> None:
        """All of the text or no file: written aside, then renamed."""
        stream = self._system.create(self._path(f"{path}.part"), True)
        try:
            self._text.write(text, stream, self._utf8)
        finally:
            stream.close()
        self.rename(f"{path}.part", path)

    def read(self, path: str) -> str:
        stream = self._system.open(self._path(path))
        try:
            return self._text.toString(stream, self._utf8)
        finally:
            stream.close()


@dataclass(frozen=True)
class Staged:
    """A table written aside: where it lies, and the rows that were seen while it was written."""

    folder: str
    rows: int
    table: DataFrame


def stage_rows(df: DataFrame, base: str, columns: Sequence[str] = (), codec: str | None = "snappy", max_records: int | None = None) -> Staged:
    """Write ``df`` below ``base/_staged``, by ``columns`` if there are any, and count its rows on the way."""
    folder = f"{base}/{STAGED}/{uuid.uuid4().hex}"
    seen = Observation()
    rows = df.hint("rebalance", *columns) if columns else df
    writer = rows.observe(seen, F.count(F.lit(1)).alias("rows")).write
    writer = writer.option("compression", codec) if codec else writer
    writer = writer.option("maxRecordsPerFile", max_records) if max_records else writer
    (writer.partitionBy(*columns) if columns else writer).parquet(f"{folder}/rows")
    table = df.sparkSession.read.schema(df.schema).parquet(f"{folder}/rows")
    return Staged(folder, seen.get["rows"], table)


def publish(spark: SparkSession, base: str, staged: Staged, folders: Mapping[str, str], emptied: Sequence[str] = ()) -> None:
    """Put staged folders in place: ``folders`` maps a path below the staged rows to one below ``base``.

    A folder that is in its place is replaced whole; those in ``emptied`` go. Both lists have a row per
    period or year. Readers see each folder old or new, but for the moment between two renames.
    """
    moves = [[f"{staged.folder}/rows/{old}".rstrip("/"), f"{base}/{new}"] for old, new in folders.items()]
    plan = {"moves": moves, "gone": [f"{base}/{name}" for name in emptied]}
    Folders(spark, base).write(f"{staged.folder}/{MANIFEST}", json.dumps(plan))
    _finish(Folders(spark, base), staged.folder)


def _finish(files: Folders, folder: str) -> None:
    plan = json.loads(files.read(f"{folder}/{MANIFEST}"))
    for new, place in plan["moves"]:
        # A folder that is no longer staged is in its place already.
        if files.exists(new):
            files.delete(place)
            files.rename(new, place)
    for place in plan["gone"]:
        files.delete(place)
    # Moved already, or not wanted: nothing of it may be published twice.
    files.delete(folder)


def recover(spark: SparkSession, base: str) -> tuple[int, int]:
    """Finish what was decided below ``base`` and drop what was not: how many of each.

    For a single writer, before it begins: another one's staged rows would go.
    """
    files, finished, dropped = Folders(spark, base), 0, 0
    for name in files.children(f"{base}/{STAGED}"):
        folder = f"{base}/{STAGED}/{name}"
        if files.exists(f"{folder}/{MANIFEST}"):
            _finish(files, folder)
            finished += 1
        else:
            files.delete(folder)
            dropped += 1
    return finished, dropped
