"""FM-index over a shard of symbols: BWT in a wavelet matrix, backward search, sampled positions."""

from __future__ import annotations

import numpy as np

from lavra.llm.wavelet import WaveletMatrix

#: The symbol between stretches; no phrase may hold it.
BREAK = 0
#: Every so many positions (and at each start of a stretch) the place of a suffix is stored.
SAMPLE = 16


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; breaks differ from one another, in text order.

    Only suffixes whose rank is still shared are sorted again, so repeats cost
    a few passes over themselves.
    """
    n = len(text)
    breaks = text == BREAK
    first = np.where(breaks, np.cumsum(breaks) - 1, text.astype(np.int64) + int(breaks.sum()))
    order = np.argsort(first, kind="stable")
    sorted_first = first[order]
    start = np.concatenate([[True], sorted_first[1:] != sorted_first[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(start, np.arange(n), 0))
    shared = ~(start & np.concatenate([start[1:], [True]]))
    places, step = np.flatnonzero(shared), 1
    while len(places):
        rows = order[places]
        after = np.minimum(rows + step, n)
        second = np.where(rows + step < n, rank[np.minimum(after, n - 1)], -1)
        head = rank[rows]
        by = np.lexsort((second, head))
        rows, head, second = rows[by], head[by], second[by]
        order[places] = rows
        start = np.concatenate([[True], (head[1:] != head[:-1]) | (second[1:] != second[:-1])])
        rank[rows] = places[np.maximum.accumulate(np.where(start, np.arange(len(places)), 0))]
        places = places[~(start & np.concatenate([start[1:], [True]]))]
        step *= 2
    return order


class FMIndex:
    """Counts and places of phrases in ``text``, an array of symbols that ends with a BREAK."""

    def __init__(self, text: np.ndarray, sample: int = SAMPLE):
        n = len(text)
        order = suffix_order(text)
        before = text[order - 1]  # row 0 of the text takes its last symbol, a break
        bits = max(1, int(text.max()).bit_length())
        self.n, self.symbols = n, 1 << bits
        self.bwt = WaveletMatrix.build(before, bits)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=self.symbols))]).astype(np.int64)
        starts = np.concatenate([[True], text[:-1] == BREAK])
        stored = (np.arange(n) % sample == 0) | starts
        kept = stored[order]
        self.marks = WaveletMatrix.build(kept.astype(np.uint8), 1)
        self.places = order[kept]

    def _back(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        return self.smaller[symbol] + self.bwt.rank(symbol, row)

    def ranges(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of equally long phrases (rows); their rows of the index are [lo, hi)."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        alive = np.flatnonzero((phrases < self.symbols).all(axis=1) & (phrases != BREAK).all(axis=1))
        hi[:] = np.where(np.isin(np.arange(len(phrases)), alive), hi, 0)
        for column in reversed(range(phrases.shape[1])):
            if not len(alive):
                break
            symbol = phrases[alive, column]
            lo[alive], hi[alive] = self._back(symbol, lo[alive]), self._back(symbol, hi[alive])
            alive = alive[lo[alive] < hi[alive]]
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of index rows, walking back to the next stored place."""
        row, steps = rows.astype(np.int64).copy(), np.zeros(len(rows), np.int64)
        place, open_rows = np.zeros(len(rows), np.int64), np.arange(len(rows))
        while len(open_rows):
            here = row[open_rows]
            stored = self.marks.access(here) == 1
            done = open_rows[stored]
            place[done] = self.places[self.marks.rank(np.ones(len(done), np.int64), row[done])] + steps[done]
            open_rows = open_rows[~stored]
            here = row[open_rows]
            row[open_rows] = self._back(self.bwt.access(here), here)
            steps[open_rows] += 1
        return place
