"""Wavelet matrix: bit planes with rank and select, and its compressed file form.

File form of a shard, all numbers little-endian:

    magic "WVM1" | u32 length of the header | header (JSON) | sections

The header names the sections with offset and length: the numbers of the
documents and their first positions (int64, zstd), and for each plane the
blocks of ``BLOCK_BITS`` bits (zstd each), with the count of ones before each
block. A reader touches only the blocks that it needs.
"""

from __future__ import annotations

import json
import struct

import numpy as np
import zstandard

MAGIC = b"WVM1"
BLOCK_BITS = 1 << 16
_WORDS = BLOCK_BITS // 64
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def _pack(bits: np.ndarray) -> np.ndarray:
    packed = np.packbits(bits, bitorder="little")
    return np.concatenate([packed, np.zeros(-len(packed) % 8, np.uint8)]).view("<u8")


def _below(words: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Ones among the first ``count`` (0 to 63) bits of each word."""
    mask = (np.uint64(1) << count.astype(np.uint64)) - np.uint64(1)
    return np.bitwise_count(words & mask).astype(np.int64)


class WaveletMatrix:
    """Access, rank and select over ``n`` symbols of ``bits`` bits; all calls take arrays."""

    def __init__(self, n: int, bits: int, zeros: list[int], planes: list[np.ndarray]):
        self.n, self.bits, self.zeros, self.planes = n, bits, zeros, planes
        self.ones_before = [np.concatenate([[0], np.cumsum(np.bitwise_count(p), dtype=np.int64)]) for p in planes]

    @classmethod
    def build(cls, symbols: np.ndarray, bits: int) -> WaveletMatrix:
        zeros, planes = [], []
        for level in reversed(range(bits)):
            set_here = (symbols >> level) & 1 == 1
            planes.append(_pack(set_here))
            rest, ones = symbols[~set_here], symbols[set_here]
            zeros.append(len(rest))
            symbols = np.concatenate([rest, ones])
        return cls(len(symbols), bits, zeros, planes)

    # The two calls that touch the planes; the file reader replaces them.
    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ones before position ``at`` (0 to n)."""
        word = at >> 6
        padded = self.planes[level]
        inside = _below(padded[np.minimum(word, len(padded) - 1)], at & 63) if len(padded) else 0
        return self.ones_before[level][word] + np.where(at & 63 > 0, inside, 0)

    def _bit(self, level: int, at: np.ndarray) -> np.ndarray:
        return (self.planes[level][at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1

    def _find(self, level: int, bit: int, nth: np.ndarray) -> np.ndarray:
        """Position of the ``nth`` (from 0) bit of this value, by bisection over ranks."""
        lo, hi = np.zeros(len(nth), np.int64), np.full(len(nth), self.n, np.int64)
        while np.any(lo < hi):
            middle = (lo + hi) // 2
            ones = self._ones(level, middle + 1)
            seen = ones if bit else middle + 1 - ones
            enough = seen > nth
            hi, lo = np.where(enough & (lo < hi), middle, hi), np.where(~enough & (lo < hi), middle + 1, lo)
        return lo

    def access(self, at: np.ndarray) -> np.ndarray:
        at = np.asarray(at, np.int64)
        out = np.zeros(len(at), np.int64)
        for level in range(self.bits):
            bit, ones = self._bit(level, at), self._ones(level, at)
            out = out << 1 | bit
            at = np.where(bit, self.zeros[level] + ones, at - ones)
        return out

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the symbols' run begins on the last plane, and ``at`` followed down."""
        start = np.zeros(len(at), np.int64)
        for level in range(self.bits):
            bit = symbol >> (self.bits - 1 - level) & 1 == 1
            ones, first = self._ones(level, at), self._ones(level, start)
            at = np.where(bit, self.zeros[level] + ones, at - ones)
            start = np.where(bit, self.zeros[level] + first, start - first)
        return start, at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before position ``at``."""
        symbol, at = np.broadcast_arrays(np.asarray(symbol, np.int64), np.asarray(at, np.int64))
        start, end = self._descend(symbol.ravel(), at.ravel())
        return end - start

    def count(self, symbol: int, lo: int = 0, hi: int | None = None) -> int:
        ends = self.rank(np.array([symbol, symbol]), np.array([lo, self.n if hi is None else hi]))
        return int(ends[1] - ends[0])

    def select(self, symbol: int, nth: np.ndarray) -> np.ndarray:
        """Positions of the ``nth`` (from 0) occurrences of one symbol."""
        nth = np.asarray(nth, np.int64)
        start, _ = self._descend(np.array([symbol]), np.array([0]))
        at = start[0] + nth
        for level in reversed(range(self.bits)):
            bit = symbol >> (self.bits - 1 - level) & 1
            at = self._find(level, bit, at - self.zeros[level] if bit else at)
        return at

    def occurrences(self, symbol: int) -> np.ndarray:
        """All positions of a symbol, ascending."""
        return self.select(symbol, np.arange(self.count(symbol)))

    def decode(self) -> np.ndarray:
        """All symbols, plane by plane from the last one up."""
        out = np.zeros(self.n, np.uint32)
        for level in reversed(range(self.bits)):
            bit = np.unpackbits(self.planes[level].view(np.uint8), bitorder="little", count=self.n).view(bool)
            up = np.empty_like(out)
            up[~bit] = out[: self.zeros[level]]
            up[bit] = out[self.zeros[level] :] | np.uint32(1 << (self.bits - 1 - level))
            out = up
        return out


def to_bytes(matrix: WaveletMatrix, doc_ids: np.ndarray, starts: np.ndarray) -> bytes:
    """The file form; ``starts`` holds the first position of each document, then ``n``."""
    pack = zstandard.ZstdCompressor(level=1).compress
    sections, place = [], 0

    def put(raw: bytes) -> tuple[int, int]:
        nonlocal place
        sections.append(raw)
        place += len(raw)
        return place - len(raw), len(raw)

    header = {"n": matrix.n, "bits": matrix.bits, "zeros": matrix.zeros, "docs": len(doc_ids)}
    header["doc_ids"] = put(pack(doc_ids.astype("<i8").tobytes()))
    header["starts"] = put(pack(starts.astype("<i8").tobytes()))
    header["planes"] = []
    for words, before in zip(matrix.planes, matrix.ones_before):
        edges = range(0, len(words), _WORDS)
        header["planes"].append([[*put(pack(words[e : e + _WORDS].tobytes())), int(before[e])] for e in edges])
    said = json.dumps(header, separators=(",", ":")).encode()
    return b"".join([MAGIC, struct.pack("<I", len(said)), said, *sections])


class WaveletFile(WaveletMatrix):
    """A shard read from its bytes; blocks are unpacked when first touched."""

    def __init__(self, content: bytes):
        if content[:4] != MAGIC:
            raise ValueError("not a wavelet shard")
        (length,) = struct.unpack_from("<I", content, 4)
        said = json.loads(content[8 : 8 + length])
        self.content, self.base, self.blocks = content, 8 + length, said["planes"]
        self.n, self.bits, self.zeros, self.docs = said["n"], said["bits"], said["zeros"], said["docs"]
        self.doc_ids = np.frombuffer(self._section(*said["doc_ids"]), "<i8")
        self.starts = np.frombuffer(self._section(*said["starts"]), "<i8")
        self.first_ones = [np.array([b[2] for b in blocks], np.int64) for blocks in self.blocks]
        self._open: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def _section(self, place: int, length: int) -> bytes:
        start = self.base + place
        return zstandard.ZstdDecompressor().decompress(self.content[start : start + length])

    def _block(self, level: int, block: int) -> tuple[np.ndarray, np.ndarray]:
        if (level, block) not in self._open:
            words = np.frombuffer(self._section(*self.blocks[level][block][:2]), "<u8")
            ones = np.cumsum(np.bitwise_count(words), dtype=np.int64)
            self._open[level, block] = words, np.concatenate([[0], ones])
        return self._open[level, block]

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at), np.int64)
        if not self.n:
            return out
        block = np.minimum(at // BLOCK_BITS, len(self.blocks[level]) - 1)
        for b in np.unique(block):
            here = block == b
            words, before = self._block(level, int(b))
            inside = at[here] - int(b) * BLOCK_BITS
            word = inside >> 6
            part = _below(words[np.minimum(word, len(words) - 1)], inside & 63)
            out[here] = self.first_ones[level][b] + before[word] + np.where(inside & 63 > 0, part, 0)
        return out

    def _bit(self, level: int, at: np.ndarray) -> np.ndarray:
        return self._ones(level, at + 1) > self._ones(level, at)

    def decode(self) -> np.ndarray:
        planes = [np.concatenate([self._block(k, b)[0] for b in range(len(row))] or [np.zeros(0, "<u8")]) for k, row in enumerate(self.blocks)]
        return WaveletMatrix(self.n, self.bits, self.zeros, planes).decode()

    def document(self, index: int) -> np.ndarray:
        """The symbols of one document, by its place in the shard."""
        return self.access(np.arange(self.starts[index], self.starts[index + 1]))
