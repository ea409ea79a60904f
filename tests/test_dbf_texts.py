"""Array decoding of fixed-width cells against decoding them one by one."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lavra.sources.dbf import Layout, _texts
from tests.helpers import dbf_bytes

cells = st.integers(1, 9).flatmap(
    lambda size: st.lists(
        st.one_of(
            st.binary(min_size=size, max_size=size),
            st.lists(st.sampled_from(b" \0a\xe9"), min_size=size, max_size=size).map(bytes),
        ),
        max_size=20,
    ).map(lambda rows: (size, rows))
)


def matrix(size, rows):
    return np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), size)


@settings(deadline=None, max_examples=300)
@given(cells)
def test_latin_1(drawn):
    size, rows = drawn
    expected = [row.rstrip(b" \0").decode("latin-1") for row in rows]
    assert _texts(matrix(size, rows), "ISO-8859-1").to_pylist() == expected


@settings(deadline=None, max_examples=100)
@given(st.lists(st.text(st.sampled_from("aé€😀 "), max_size=3), max_size=20))
def test_utf_8(texts):
    rows = [text.encode().ljust(16) for text in texts]
    expected = [text.rstrip(" ") for text in texts]
    assert _texts(matrix(16, rows), "UTF-8").to_pylist() == expected


def test_layout_of_a_header():
    fields = [("A", "C", 3), ("ONZE_LETRAS", "N", 5)]
    layout = Layout.of(dbf_bytes(fields, [(" ", ["x", "1"])], extra_header=b"\0" * 263))
    assert (layout.records, layout.record_bytes) == (1, 9)
    assert layout.places == {"A": slice(1, 4), "ONZE_LETRAS": slice(4, 9)}
    assert Layout.of(dbf_bytes(fields, [], claimed=7)).records == 7
    short = dbf_bytes(fields, [], claimed=7)
    with pytest.raises(ValueError, match="cut short: 0 of 7 records"):
        Layout.of(short, len(short))
