"""Archives are read by ranges, and what is damaged in them is found."""

import io
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from lavra.sources import archive
from tests.helpers import station_text

PATTERN = r"\.CSV$"
LINES = [f"2023/01/{day:02d};{hour:02d}00 UTC;{day},{hour}" for day in range(1, 29) for hour in range(24)]


class CountingFile(io.FileIO):
    """Counts the bytes read, in a file beside the archive, so that tasks in other processes count, too."""

    def read(self, size=-1):
        data = super().read(size)
        with open(f"{self.name}.read", "a") as log:
            log.write(f"{len(data)}\n")
        return data


def counting(path):
    return CountingFile("/" + path.removeprefix("file:").lstrip("/"))


def bytes_read(path):
    log = path.with_name(path.name + ".read")
    return sum(map(int, log.read_text().split())) if log.exists() else 0


def write_stored(path, members, method=zipfile.ZIP_STORED):
    with zipfile.ZipFile(path, "w", method) as file:
        for name, content in members.items():
            file.writestr(name, content)


def flip(path, place):
    content = bytearray(path.read_bytes())
    content[place] ^= 0x01
    path.write_bytes(bytes(content))


def chunks(spark, path, **options):
    return archive.read_member_chunks(spark, str(path), PATTERN, 8, **options)


def test_listing_reads_tails_only(spark, tmp_path):
    path = tmp_path / "big.zip"
    write_stored(path, {"a.csv": b"x" * 3_000_000, "b.csv": b"y" * 3_000_000, "c.txt": b"z" * 3_000_000})
    found = archive.list_members(spark, str(path), PATTERN, opener=counting)
    assert sorted((r["membro"], r["bytes"]) for r in found.collect()) == [("a.csv", 3_000_000), ("b.csv", 3_000_000)]
    assert 0 < bytes_read(path) < 100_000


def test_only_matching_members_are_read(spark, tmp_path):
    path = tmp_path / "big.zip"
    write_stored(path, {"a.csv": station_text(LINES), "c.txt": b"z" * 5_000_000})
    assert archive.chunk_lines(chunks(spark, path, opener=counting), "membro").filter("linha like '2023/%'").count() == len(LINES)
    assert bytes_read(path) < 300_000


@pytest.mark.parametrize("method", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED])
@pytest.mark.parametrize("size", [1, 7, 4096, 1 << 20])
def test_members_inflate_alike_in_blocks_of_any_size(spark, tmp_path, method, size):
    contents = {"a.csv": station_text(LINES[:30]), "b.csv": b"", "c.csv": b"\r\n" * 5, "d.csv": bytes(range(256)) * 9}
    write_stored(tmp_path / "z.zip", contents, method)
    with zipfile.ZipFile(tmp_path / "z.zip") as file:
        for info in file.infolist():
            member = type("Member", (), {"metodo": info.compress_type, "cifrado": False, "posicao": info.header_offset})()
            member.empacotado, member.bytes, member.crc = info.compress_size, info.file_size, info.CRC
            with open(tmp_path / "z.zip", "rb") as raw:
                assert b"".join(archive._blocks(raw, member, size)) == contents[info.filename]


@pytest.mark.parametrize("method", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED])
def test_a_flipped_byte_fails_its_member_only(spark, tmp_path, method):
    path = tmp_path / "z.zip"
    write_stored(path, {"a.csv": station_text(LINES), "b.csv": station_text(LINES)}, method)
    with zipfile.ZipFile(path) as file:
        start = file.getinfo("b.csv").header_offset + archive.LOCAL_HEADER_BYTES + len("b.csv")
        flip(path, start + file.getinfo("b.csv").compress_size // 2)
    with pytest.raises(Exception, match="b.csv in"):
        chunks(spark, path).collect()
    found = chunks(spark, path, keep_going=True)
    assert [r["membro"] for r in found.where("_erro is not null").collect()] == ["b.csv"]
    good = archive.chunk_lines(found.where("_erro is null and membro = 'a.csv'"), "membro")
    assert good.filter(F.col("linha").startswith("2023/")).count() == len(LINES)
    with pytest.raises(Exception, match="b.csv in"):
        archive.extract_members(spark, str(path), PATTERN).collect()
    kept = archive.extract_members(spark, str(path), PATTERN, keep_going=True).collect()
    assert [(r["membro"], r["content"] is None, r["_erro"] is None) for r in sorted(kept)] == [("a.csv", False, True), ("b.csv", True, False)]


def test_wrong_sizes_and_places_are_found(spark, tmp_path):
    """The directory says another size, another method, or a place where no member begins."""
    write_stored(tmp_path / "z.zip", {"a.csv": b"12345678"})
    whole = (tmp_path / "z.zip").read_bytes()
    entry = whole.rindex(b"PK\x01\x02")
    for at, value, complaint in ((24, 9, "8 of 9 bytes"), (10, 99, "unknown way"), (42, 3, "no member begins there"), (16, 5, "wrong checksum")):
        content = bytearray(whole)
        struct.pack_into("<H" if at == 10 else "<I", content, entry + at, value)
        (tmp_path / "bad.zip").write_bytes(bytes(content))
        found = archive.extract_members(spark, str(tmp_path / "bad.zip"), PATTERN, keep_going=True).collect()
        assert [complaint in r["_erro"] for r in found] == [True], found


def test_what_is_no_archive_is_an_error_row(spark, tmp_path):
    write_stored(tmp_path / "good.zip", {"a.csv": station_text(LINES[:2])})
    (tmp_path / "bad.zip").write_bytes(b"no archive at all")
    (tmp_path / "tail.zip").write_bytes((tmp_path / "good.zip").read_bytes()[-22:])
    found = chunks(spark, tmp_path, keep_going=True).collect()
    bad = sorted((r["_arquivo"].split("/")[-1], r["membro"]) for r in found if r["_erro"])
    assert bad == [("bad.zip", None), ("tail.zip", None)]
    assert [r["membro"] for r in found if not r["_erro"]] == ["a.csv"]
    with pytest.raises(Exception, match="zip"):
        archive.list_members(spark, str(tmp_path)).collect()
