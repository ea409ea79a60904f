"""The first lines of files, read from their heads."""

import gzip
import io

import pytest

from lavra.sources import delimited
from tests.test_archive_ranges import bytes_read, counting


@pytest.mark.parametrize("block", [1, 3, 4096])
@pytest.mark.parametrize(
    "content, wanted",
    [
        (b"", []),
        (b"a", [b"a"]),
        (b"a\r\nb\rc\nd\ne", [b"a", b"b", b"c"]),
        (b"\n\nx", [b"", b"", b"x"]),
        (b"a\r\n" + b"b" * 9000 + b"\r\nc\r\n", [b"a", b"b" * 9000, b"c"]),
        (b"a\nb\nc\r\n", [b"a", b"b", b"c"]),
    ],
)
def test_lines_do_not_depend_on_blocks(content, wanted, block):
    assert delimited.first_lines(io.BytesIO(content), 3, block) == wanted


def test_only_heads_are_read(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes("CÓDIGO;1\r\n".encode("latin-1") * 500_000)
    (row,) = delimited.read_first_lines(spark, str(path), 8, "ISO-8859-1", opener=counting).collect()
    assert row["linhas"] == ["CÓDIGO;1"] * 8
    assert bytes_read(path) <= delimited.HEAD


def test_heads_of_compressed_and_short_files(spark, tmp_path):
    (tmp_path / "a b.csv.gz").write_bytes(gzip.compress(b"x;1\ny;2\nz;3\n" * 9000))
    (tmp_path / "one.csv").write_bytes(b"x;1")
    (tmp_path / "none.csv").write_bytes(b"")
    found = delimited.read_first_lines(spark, str(tmp_path), 2, "ISO-8859-1").collect()
    assert sorted(r["linhas"] for r in found) == [["x;1"], ["x;1", "y;2"]]
