"""ZIP archives, read by ranges.

Spark has no ZIP codec. A task reads the tail of each archive, which lists its
members; every member is then a row of work for a task of its own, which opens
the archive at that member and inflates it block by block. Size and checksum are
compared with the directory. Everything after that is column expressions.
"""

from __future__ import annotations

import re
import struct
import zipfile
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.operators.quality import Check, evaluate
from lavra.scratch import materialize
from lavra.sources.delimited import LINE_BREAK
from lavra.sources.ranges import Opener, list_files, open_file, spread

CHUNK_CHARACTERS = 1024 * 1024

LISTED = {"_arquivo": "string", "membro": "string", "bytes": "long"}
WORK = {**LISTED, "posicao": "long", "empacotado": "long", "metodo": "int", "cifrado": "boolean", "crc": "long", "_erro": "string"}
CHUNKS = {"_arquivo": "string", "membro": "string", "parte": "long", "preambulo": "string", "texto": "string", "_erro": "string"}
CONTENTS = {"_arquivo": "string", "membro": "string", "content": "binary", "_erro": "string"}
LINES = re.compile(r"[^\r\n]*(?:\r\n|\n|\r)|[^\r\n]+\Z")
# Fixed values of the format.
LOCAL_HEADER_BYTES = 30
LOCAL_SIZES = 26
LOCAL_SIGNATURE = b"PK\x03\x04"
#: What a damaged archive or member raises while it is read.
DAMAGE = (ValueError, OSError, EOFError, struct.error, zlib.error, zipfile.BadZipFile, NotImplementedError)


def _schema(columns: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in columns.items())


def _frame(columns: dict[str, str], rows: list[dict]) -> pd.DataFrame:
    return pd.DataFrame([[row.get(name) for name in columns] for row in rows], columns=list(columns), dtype=object)


def _work(spark: SparkSession, path: str | list[str], pattern: str | None, keep_going: bool, opener: Opener) -> DataFrame:
    """One row per member from the directory at the end of each archive; the rest of it is not read.

    With ``keep_going`` an archive without a readable directory is a row without a member, with the
    complaint in ``_erro``.
    """
    wanted = re.compile(pattern) if pattern else None

    def members(archive: str) -> list[dict]:
        with opener(archive) as file, zipfile.ZipFile(file) as directory:
            return [
                {
                    "_arquivo": archive,
                    "membro": info.filename,
                    "bytes": info.file_size,
                    "posicao": info.header_offset,
                    "empacotado": info.compress_size,
                    "metodo": info.compress_type,
                    "cifrado": bool(info.flag_bits & 1),
                    "crc": info.CRC,
                }
                for info in directory.infolist()
                if not info.is_dir() and (wanted is None or wanted.search(info.filename.upper()))
            ]

    def listed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for archive in frame["_arquivo"]:
                try:
                    found = members(archive)
                except DAMAGE as problem:
                    if not keep_going:
                        raise ValueError(f"{problem} in {archive}") from None
                    found = [{"_arquivo": archive, "_erro": str(problem)}]
                if found:
                    yield _frame(WORK, found)

    return list_files(spark, path).select("_arquivo").mapInPandas(listed, _schema(WORK))


def _dealt(spark: SparkSession, path: str | list[str], pattern: str, keep_going: bool, opener: Opener) -> DataFrame:
    """The work rows of the matching members, dealt over tasks by what they hold when inflated."""
    work = materialize(_work(spark, path, pattern, keep_going, opener), "archive-members")
    total = work.agg(F.sum("bytes").alias("total")).first()["total"] or 0
    return spread(work, total, "_arquivo", "membro")


def member_matches(member: Column, pattern: str) -> Column:
    """Match on the upper-cased member name."""
    return F.upper(member).rlike(pattern)


def list_members(
    spark: SparkSession, path: str | list[str], pattern: str | None = None, keep_going: bool = False, opener: Opener = open_file
) -> DataFrame:
    """The members of every archive whose upper-cased name matches, one row each: ``_arquivo``, ``membro``, ``bytes``.

    An archive that cannot be read fails the job; with ``keep_going`` it has no members.
    """
    return _work(spark, path, pattern, keep_going, opener).where(F.col("_erro").isNull()).select(*LISTED)


def list_archives(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The archives themselves, from the listing alone."""
    return list_files(spark, path).select("_arquivo")


def member_count_check(
    archives: DataFrame, members: DataFrame, suffix: str, expected: int = 1
) -> DataFrame:
    """Per archive: exactly so many members end in ``suffix``, whatever the case.

    An archive without any member is there in ``archives``, with a count of zero.
    """
    every = archives.select("_arquivo").join(members.select("_arquivo", "membro"), "_arquivo", "left")
    matching = F.count_if(F.lower(F.col("membro")).endswith(suffix.lower()))
    return evaluate(every, [Check(f"members ending in {suffix}", matching, expected)], ["_arquivo"])


def _blocks(file: BinaryIO, member, block_bytes: int) -> Iterator[bytes]:
    """The content of a member in blocks, compared with its size and checksum at the end."""
    if member.metodo not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED) or member.cifrado:
        raise ValueError("packed in an unknown way")
    file.seek(int(member.posicao))
    header = file.read(LOCAL_HEADER_BYTES)
    if header[:4] != LOCAL_SIGNATURE:
        raise ValueError("no member begins there")
    # The sizes of name and extra field in the local header may differ from the directory's.
    name, extra = struct.unpack_from("<HH", header, LOCAL_SIZES)
    file.seek(int(member.posicao) + LOCAL_HEADER_BYTES + name + extra)
    size = crc = 0
    for block in _raw_blocks(file, int(member.empacotado), member.metodo == zipfile.ZIP_DEFLATED, block_bytes):
        size += len(block)
        crc = zlib.crc32(block, crc)
        yield block
    if size != member.bytes:
        raise ValueError(f"{size} of {member.bytes} bytes")
    if crc != member.crc:
        raise ValueError("wrong checksum")


def _raw_blocks(file: BinaryIO, left: int, deflated: bool, block_bytes: int) -> Iterator[bytes]:
    inflate = zlib.decompressobj(-15)
    packed = b""
    while left or packed or (deflated and not inflate.eof):
        if left and not packed:
            packed = file.read(min(left, block_bytes))
            if not packed:
                raise ValueError("cut short")
            left -= len(packed)
        if deflated:
            block = inflate.decompress(packed, block_bytes)
            if inflate.eof:
                packed, left = b"", 0
            elif not (block or packed or left):
                raise ValueError("cut short")
            else:
                packed = inflate.unconsumed_tail
        else:
            block, packed = packed, b""
        if block:
            yield block


def _whole_lines(blocks: Iterator[bytes]) -> Iterator[bytes]:
    """The same bytes in blocks that end behind a line, but for the last."""
    rest = b""
    for block in blocks:
        rest += block
        end = max(rest.rfind(b"\n"), rest.rfind(b"\r", 0, -1)) + 1
        if end:
            yield rest[:end]
            rest = rest[end:]
    yield rest


def _read_members(
    dealt: DataFrame, columns: dict[str, str], rows_of, keep_going: bool, opener: Opener
) -> DataFrame:
    """Rows that ``rows_of(file, member)`` makes of each member; with ``keep_going`` complaints are rows, too."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for member in frame.itertuples(index=False):
                where = {"_arquivo": member[0], "membro": member[1]}
                if member[-1] is not None:
                    yield _frame(columns, [{**where, "_erro": member[-1]}])
                    continue
                try:
                    with opener(member[0]) as file:
                        for row in rows_of(file, member):
                            yield _frame(columns, [{**where, **row}])
                except DAMAGE as problem:
                    if not keep_going:
                        raise ValueError(f"{problem}: {member[1]} in {member[0]}") from None
                    yield _frame(columns, [{**where, "_erro": str(problem)}])

    found = dealt.select(*WORK).mapInPandas(read, _schema(columns))
    return found if keep_going else found.drop("_erro")


def extract_members(
    spark: SparkSession, path: str, pattern: str, keep_going: bool = False, opener: Opener = open_file
) -> DataFrame:
    """The content of the matching members, one row each.

    For members that are decoded as a whole, such as fixed-width tables. A member whose
    size or checksum is not that of the directory fails the job; with
    ``keep_going`` it is a row with the complaint in ``_erro`` instead.
    """

    def contents(file: BinaryIO, member) -> Iterator[dict]:
        yield {"content": b"".join(_blocks(file, member, CHUNK_CHARACTERS))}

    return _read_members(_dealt(spark, path, pattern, keep_going, opener), CONTENTS, contents, keep_going, opener)


def read_member_chunks(
    spark: SparkSession,
    path: str | list[str],
    pattern: str,
    preamble_lines: int,
    encoding: str = "ISO-8859-1",
    chunk_characters: int = CHUNK_CHARACTERS,
    keep_going: bool = False,
    opener: Opener = open_file,
) -> DataFrame:
    """Text of the matching members in chunks of whole lines.

    Each chunk carries the preamble of its member, so that no join is needed to
    attach it. The first non-blank line is a header and is left out of the
    text. Members are spread over the cluster and read by their ranges, block
    by block: neither an archive nor a member is held whole. A member that is damaged
    fails the job; with ``keep_going`` it has a row with the complaint in ``_erro``, which is NULL
    in all others, behind the chunks that came before the damage was met. An
    archive that cannot be read at all is such a row without a member.
    """

    def chunks(file: BinaryIO, member) -> Iterator[dict]:
        blocks = _whole_lines(_blocks(file, member, chunk_characters))
        start: list[str] = []
        opening = ""
        for block in blocks:
            opening += block.decode(encoding, errors="replace")
            start = LINES.findall(opening)
            if len(start) > preamble_lines and any(line.strip() for line in start):
                break
        preamble = "".join(start[:preamble_lines])
        header = next((i for i, line in enumerate(start) if line.strip()), None)
        text = "".join(line for i, line in enumerate(start) if i != header)
        yield {"parte": 0, "preambulo": preamble, "texto": text}
        for part, block in enumerate(blocks, 1):
            if block:
                yield {"parte": part, "preambulo": preamble, "texto": block.decode(encoding, errors="replace")}

    return _read_members(_dealt(spark, path, pattern, keep_going, opener), CHUNKS, chunks, keep_going, opener)


def chunk_lines(chunks: DataFrame, *keep: str) -> DataFrame:
    """One row per line of the chunks, as ``linha``, with the columns to keep.

    A chunk that stands for a damaged member, if ``_erro`` is kept, is one row without a line.
    """
    lines = chunks.select(*keep, F.explode_outer(F.split("texto", LINE_BREAK)).alias("linha"))
    wanted = F.col("linha") != ""
    return lines.filter(wanted | F.col("_erro").isNotNull() if "_erro" in keep else wanted)
