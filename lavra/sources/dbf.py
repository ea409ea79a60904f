"""Fixed-width DBF tables.

The header says how many records there are, how long each is and where each
field lies. From it a file becomes rows of work, so many records each; tasks
read the bytes of theirs and cut them into text columns, a batch of records at a
time and without a loop over records. Numbers and dates are then made of the
texts with column expressions.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.contracts import DBF_BATCH_RECORDS
from lavra.sources.ranges import Opener, list_files, open_file, spread, total_bytes

# Fixed values of the format.
PREFIX_BYTES = 32
DESCRIPTOR_BYTES = 32
NAME_BYTES = 11
SIZE_POSITION = 16
DECIMALS_POSITION = 17
DESCRIPTORS_END = 0x0D
LIVE_RECORD = 0x20
BLANK_BYTES = (0x20, 0x00)
NUMBER_KINDS = "NF"
# Types whose cells are text; the others hold binary numbers and are refused.
TEXT_KINDS = "CNFDLM"
# A number of so many characters is exact as a double, and of so many surely a 64-bit one.
DOUBLE_DIGITS, LONG_DIGITS = 15, 18


@dataclass(frozen=True)
class Field:
    """A field to read: its name, its one-letter type and its decimal places.

    A number without decimal places is a whole number; left open, a double. A header leaves
    them open where a double holds every number that fits into the field, since files hold
    fractions in fields said to have none.
    """

    name: str
    kind: str = "C"
    decimals: int | None = None


@dataclass(frozen=True)
class Layout:
    """What the header of one file says."""

    records: int
    header_bytes: int
    record_bytes: int
    fields: list[Field]
    places: dict[str, slice]

    @classmethod
    def of(cls, content: bytes | memoryview, length: int | None = None) -> Layout:
        """Read the header. Of a file of ``length`` bytes all records must be there, too."""
        try:
            return cls._of(content, length)
        except (struct.error, IndexError):
            raise ValueError("no DBF header") from None

    @classmethod
    def _of(cls, content: bytes | memoryview, length: int | None) -> Layout:
        records, header_bytes, record_bytes = struct.unpack_from("<IHH", content, 4)
        fields, places = [], {}
        # The first byte of a record is its deletion mark.
        offset = 1
        for start in range(PREFIX_BYTES, header_bytes - 1, DESCRIPTOR_BYTES):
            if content[start] == DESCRIPTORS_END:
                break
            name = bytes(content[start : start + NAME_BYTES]).split(b"\0")[0].decode("latin-1")
            kind, decimals = chr(content[start + NAME_BYTES]), content[start + DECIMALS_POSITION]
            size = content[start + SIZE_POSITION]
            if kind not in TEXT_KINDS:
                raise ValueError(f"field {name} has the type {kind}, which is no text")
            free = kind == "N" and not decimals and not DOUBLE_DIGITS < size <= LONG_DIGITS
            fields.append(Field(name, kind, None if free else decimals))
            places[name] = slice(offset, offset + size)
            offset += size
        if offset > record_bytes:
            raise ValueError(f"fields of {offset} bytes in records of {record_bytes}")
        if length is not None and length < header_bytes + records * record_bytes:
            found = max(0, length - header_bytes) // record_bytes
            raise ValueError(f"cut short: {found} of {records} records")
        return cls(records, header_bytes, record_bytes, fields, places)


def _header(file, length: int | None = None) -> Layout:
    """The layout of an open file, from its header alone."""
    prefix = file.read(PREFIX_BYTES)
    try:
        rest = file.read(max(0, struct.unpack_from("<H", prefix, 8)[0] - PREFIX_BYTES))
    except struct.error:
        raise ValueError("no DBF header") from None
    return Layout.of(prefix + rest, length)


def describe(spark: SparkSession, path: str | DataFrame, opener: Opener = open_file) -> list[Field]:
    """The fields of all files at ``path``, or of a listing, from their headers; no record is read.

    Fields are in the order of their place in a header. A field whose type
    differs between files is text, one with unlike decimal places a double.
    Headers that cannot be read are left to decoding, which complains.
    """
    kinds = pa.schema([("place", pa.int32()), ("name", pa.string()), ("kind", pa.string()), ("decimals", pa.int32())])

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name in batch.column(0).to_pylist():
                try:
                    with opener(name) as file:
                        rows += [(i, f.name, f.kind, f.decimals) for i, f in enumerate(_header(file).fields)]
                except ValueError:
                    continue
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds.types)], schema=kinds
            )

    headers = list_files(spark, path).select("_arquivo")
    found = headers.mapInArrow(listed, "place int, name string, kind string, decimals int")
    # One row per distinct field: a layout has at most 2,047 of them.
    merged = found.groupBy("name").agg(
        F.min("place").alias("place"),
        F.collect_set("kind").alias("kinds"),
        F.collect_set("decimals").alias("decimals"),
    )
    fields = []
    for row in merged.orderBy("place", "name").collect():
        kind = row["kinds"][0] if len(row["kinds"]) == 1 else "C"
        fields.append(Field(row["name"], kind, row["decimals"][0] if len(row["decimals"]) == 1 else None))
    return fields


def _checked(layout: Layout, names: list[str], exact_fields: bool, absent_is_null: bool) -> Layout:
    found = [field.name for field in layout.fields]
    enough = absent_is_null or set(names) <= set(found)
    if found != names if exact_fields else not enough:
        raise ValueError(f"unexpected fields: wanted {names}, found {found}")
    return layout


def _cut(path: str, records: bytes | memoryview, layout: Layout, names: list[str], encoding: str) -> pa.RecordBatch:
    """The live ones of whole records, as texts."""
    rows = np.frombuffer(records, np.uint8).reshape(-1, layout.record_bytes)
    live = rows[rows[:, 0] == LIVE_RECORD]
    texts = [
        _texts(live[:, layout.places[name]], encoding) if name in layout.places else pa.nulls(len(live), pa.string())
        for name in names
    ]
    return _batch(path, pa.nulls(len(live), pa.string()), texts, names)


def _batch(path: str, errors: pa.Array, texts: list, names: list[str]) -> pa.RecordBatch:
    where = pa.array([path] * len(errors), pa.string())
    return pa.RecordBatch.from_arrays([where, errors, *texts], ["_arquivo", "_erro", *names])


def _complaint(path: str, problem: object, names: list[str]) -> pa.RecordBatch:
    return _batch(path, pa.array([str(problem)], pa.string()), [pa.nulls(1, pa.string())] * len(names), names)


def _values(texts: DataFrame, fields: Sequence[Field], keep_going: bool) -> DataFrame:
    kept = ["_arquivo", "_erro"] if keep_going else ["_arquivo"]
    return texts.select(*kept, *(_value(field).alias(field.name) for field in fields))


def _text_schema(names: list[str]) -> str:
    return ", ".join(f"`{name}` string" for name in ["_arquivo", "_erro", *names])


def dbf_work(
    files: DataFrame,
    names: list[str],
    exact_fields: bool = False,
    absent_is_null: bool = False,
    keep_going: bool = False,
    batch_records: int = DBF_BATCH_RECORDS,
    opener: Opener = open_file,
) -> DataFrame:
    """Rows of work from the headers of listed files: path, first record, number of records.

    A file that cannot be used fails the job, or with ``keep_going`` is a row with ``_erro``.
    """

    def planned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, length in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                error = None
                try:
                    with opener(path) as file:
                        layout = _checked(_header(file, length), names, exact_fields, absent_is_null)
                    first = list(range(0, layout.records, batch_records))
                    count = [min(batch_records, layout.records - start) for start in first]
                except (ValueError, OSError) as problem:
                    if not keep_going:
                        raise ValueError(f"{problem} in {path}") from None
                    first, count, error = [0], [0], str(problem)
                yield pa.RecordBatch.from_pydict(
                    {"_arquivo": [path] * len(first), "primeiro": first, "registros": count, "_erro": [error] * len(first)},
                    schema=pa.schema(
                        [("_arquivo", pa.string()), ("primeiro", pa.int64()), ("registros", pa.int64()), ("_erro", pa.string())]
                    ),
                )

    return files.select("_arquivo", "_bytes").mapInArrow(planned, "_arquivo string, primeiro long, registros long, _erro string")


def read_dbf(
    spark: SparkSession,
    path: str | DataFrame,
    fields: Sequence[Field],
    encoding: str,
    exact_fields: bool = False,
    batch_records: int = DBF_BATCH_RECORDS,
    keep_going: bool = False,
    absent_is_null: bool = False,
    opener: Opener = open_file,
) -> DataFrame:
    """The live records of all files at ``path``, or of a listing, with ``_arquivo``.

    Each task reads the ranges of the records that it cuts, ``batch_records`` at a time, so one large
    file keeps many tasks busy and no file is held. A file that is no DBF, is
    cut short or lacks a field (unless ``absent_is_null``) fails the job before a
    record is read, as does, with ``exact_fields``, one whose field list is not
    exactly the given one; text that cannot be decoded fails it midway. With ``keep_going`` such a
    file yields a row with the complaint in ``_erro`` instead, which is NULL in
    all other rows; one that turns out bad midway has other records, too. Text
    loses its padding, bad numbers and dates become NULL.
    """
    names = [field.name for field in fields]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, first, count, error in zip(*(column.to_pylist() for column in batch.columns)):
                if error is not None:
                    yield _complaint(path, error, names)
                    continue
                try:
                    with opener(path) as file:
                        layout = _header(file)
                        file.seek(layout.header_bytes + first * layout.record_bytes)
                        records = file.read(count * layout.record_bytes)
                    if len(records) < count * layout.record_bytes:
                        raise ValueError(f"cut short while it was read, at record {first}")
                    cut = _cut(path, records, layout, names, encoding)
                except (ValueError, OSError, pa.ArrowException) as problem:
                    if not keep_going:
                        raise ValueError(f"{problem} in {path}") from None
                    cut = _complaint(path, problem, names)
                yield cut

    files = list_files(spark, path)
    work = dbf_work(files, names, exact_fields, absent_is_null, keep_going, batch_records, opener)
    dealt = spread(work, total_bytes(files), "_arquivo", "primeiro")
    return _values(dealt.mapInArrow(read, _text_schema(names)), fields, keep_going)


def decode_dbf(
    files: DataFrame, fields: Sequence[Field], encoding: str, exact_fields: bool = False, batch_records: int = DBF_BATCH_RECORDS
) -> DataFrame:
    """The live records of files held as rows (``_arquivo``, ``content``), as archives give them.

    As :func:`read_dbf` without ``keep_going``; every file is one task.
    """
    names = [field.name for field in fields]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, content in _contents(batches):
            try:
                layout = _checked(Layout.of(content, len(content)), names, exact_fields, False)
                for start in range(0, layout.records, batch_records):
                    count = min(batch_records, layout.records - start)
                    first = layout.header_bytes + start * layout.record_bytes
                    yield _cut(path, content[first : first + count * layout.record_bytes], layout, names, encoding)
            except (ValueError, pa.ArrowException) as problem:
                raise ValueError(f"{problem} in {path}") from None

    return _values(files.select("_arquivo", "content").mapInArrow(cut, _text_schema(names)), fields, False)


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, memoryview]]:
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1)):
            yield path.as_py(), memoryview(content.as_buffer())


def _texts(cells: np.ndarray, encoding: str) -> pa.Array:
    """One text per row of bytes, without the padding at its end."""
    count, size = cells.shape
    solid = ~np.isin(cells, BLANK_BYTES)
    lengths = np.where(solid.any(axis=1), size - np.argmax(solid[:, ::-1], axis=1), 0)
    kept = cells[np.arange(size) < lengths[:, None]]
    ends = np.cumsum(lengths)
    if encoding == "ISO-8859-1":
        # In UTF-8 each byte from 0x80 on becomes two.
        wide = kept >= 0x80
        if wide.any():
            ends = ends + np.concatenate([[0], np.cumsum(wide)])[ends]
            grown = np.repeat(kept, 1 + wide)
            first = np.flatnonzero(wide) + np.arange(np.count_nonzero(wide))
            grown[first] = 0xC0 | (kept[wide] >> 6)
            grown[first + 1] = 0x80 | (kept[wide] & 0x3F)
            kept = grown
    elif encoding != "UTF-8":
        raise ValueError(f"unsupported encoding: {encoding}")
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    texts = pa.StringArray.from_buffers(count, pa.py_buffer(offsets), pa.py_buffer(kept.copy()))
    texts.validate(full=True)
    return texts


def _value(field: Field) -> Column:
    text = F.col(f"`{field.name}`")
    if field.kind in NUMBER_KINDS:
        number = F.translate(F.trim(F.translate(text, "*\0", "")), ",", ".")
        whole = field.kind == "N" and field.decimals == 0
        return number.try_cast("long" if whole else "double")
    if field.kind == "D":
        return F.try_to_date(F.trim(text), "yyyyMMdd")
    if field.kind == "L":
        return F.when(text.isin(*"TtYy"), True).when(text.isin(*"FfNn"), False)
    return text
