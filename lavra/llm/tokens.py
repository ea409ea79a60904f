"""Token ids of many texts by a public tokenizer, with a memo of pieces.

Most words of a corpus repeat. A text is cut at single spaces, where the
tokenizers of the two kinds below never join anything, and each distinct piece
goes through the tokenizers library once per worker. Any other tokenizer, and
any text whose cuts could matter, is encoded whole by the library.
"""

from __future__ import annotations

import json
import os
import re
from itertools import chain
from operator import attrgetter

import numpy as np
from tokenizers import Tokenizer

from lavra.llm.staging import worker_wide

#: A piece that every pre-tokenizer here leaves in one part: letters of Latin-1, one space before.
PLAIN = re.compile(" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")
#: A space that white space or the end follows: there a cut could change the parts.
DOUBTFUL = re.compile(r" (?:\s|\Z)")
#: One mark right behind a letter, with white space or the end behind it: always a part of its own.
#: It begins with the mark, so that a search runs from mark to mark instead of from letter to letter.
MARK = re.compile(r"[.,](?<=[A-Za-zÀ-ÖØ-öø-ÿ][.,])(?=[ \n]|\Z)")
#: One line feed between other characters: a part of its own, too.
FEED = re.compile(r"(?<=\S)\n(?=\S)")
#: Bounds of the memo, about 100 MB; beyond them it starts anew.
MEMO_PIECES = 690_000
MEMO_CHARS = 10_000_000


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level vocabularies write for bytes: printable ones stay."""
    stay = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    moved = [b for b in range(256) if b not in set(stay)]
    return {b: chr(b) for b in stay} | {b: chr(256 + i) for i, b in enumerate(moved)}


class _Numbers(dict):
    """A number for each piece, given when it is first asked for; the ``new`` ones are yet to be encoded."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        self.new.append(piece)
        return number


class Encoder:
    """Encode texts with the tokenizer file at ``path``, without special tokens."""

    def __init__(self, path: str):
        # Tasks keep the cores busy; threads of the library's own would only wait for each other.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        self.kind = self._kind(said)
        self.letters = _byte_letters()
        self._forget()

    @staticmethod
    def _kind(said: dict) -> str:
        before, norm = said.get("pre_tokenizer") or {}, said.get("normalizer")
        if before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and not norm:
            return "leading"
        steps = [s.get("type") for s in (norm or {}).get("normalizers", [])]
        parts = [p.get("type") for p in before.get("pretokenizers", [])]
        if steps == ["NFC", "Replace", "Lowercase"] and parts == ["Split", "ByteLevel"]:
            return "dropped"
        return "whole"

    def _forget(self) -> None:
        self.memo = _Numbers()
        self.chars = 0
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.first, self.length = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def pieces(self, text: str) -> list[str]:
        """Parts of ``text`` whose ids, one after another, are the ids of the text."""
        if not text:
            return []
        if self.kind == "dropped":
            text = MARK.sub(r" \g<0>", text).replace("\n", " ")
            return (text.lower() if text.isascii() else text).split(" ")
        if self.kind == "leading" and "\0" not in text and not DOUBTFUL.search(text):
            text = MARK.sub("\0\\g<0>", FEED.sub("\0\n\0", text))
            return text.replace(" ", "\0 ").split("\0")
        return [text]

    def _spelled(self, plain: list[str]) -> list[str]:
        """Plain pieces in the letters of the vocabulary, all at once: none of them holds a line feed."""
        joined = "\n".join(plain)
        joined = joined.lower() if self.kind == "dropped" else joined
        return joined.encode().decode("latin-1").translate(self.letters).split(self.letters[10]) if plain else []

    def _learn(self, new: list[str]) -> None:
        """Ids of the pieces that have got the last numbers of the memo."""
        plain, rest, plain_at, rest_at = [], [], [], []
        for at, piece in enumerate(new):
            if self.kind != "whole" and PLAIN.fullmatch(piece):
                plain.append(piece), plain_at.append(at)
            else:
                rest.append(piece), rest_at.append(at)
        tokenize, id_of = self.tokenizer.model.tokenize, attrgetter("id")
        ids, sizes = [], []
        for piece in self._spelled(plain):
            tokens = tokenize(piece)
            sizes.append(len(tokens))
            ids.extend(map(id_of, tokens))
        for encoding in self.tokenizer.encode_batch_fast(rest, add_special_tokens=False) if rest else []:
            sizes.append(len(encoding))
            ids.extend(encoding.ids)
        size, start, more = np.array(sizes, np.int64), len(self.memo) - len(new), len(ids)
        self.ids = _room(self.ids, self.used + more)
        self.first, self.length = _room(self.first, len(self.memo)), _room(self.length, len(self.memo))
        self.ids[self.used : self.used + more] = ids
        numbers = start + np.array(plain_at + rest_at, np.int64)
        self.first[numbers] = self.used + np.cumsum(size) - size
        self.length[numbers] = size
        self.used += more
        self.chars += sum(map(len, new))
        new.clear()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, text after text, and the number of ids of each text."""
        if len(self.memo) > MEMO_PIECES or self.chars > MEMO_CHARS:
            self._forget()
        cut = [self.pieces(text) for text in texts]
        counts = np.fromiter(map(len, cut), np.int64, len(cut))
        flat = list(chain.from_iterable(cut))
        try:
            at = np.fromiter(map(self.memo.__getitem__, flat), np.int64, len(flat))
            if self.memo.new:
                self._learn(self.memo.new)
        except BaseException:
            # No piece may keep a number without ids.
            self._forget()
            raise
        length = self.length[at]
        end = np.cumsum(length)
        total = int(end[-1]) if len(end) else 0
        ids = self.ids[np.arange(total) + np.repeat(self.first[at] - (end - length), length)]
        edges = np.concatenate([[0], end])[np.concatenate([[0], np.cumsum(counts)])]
        return ids, np.diff(edges)


def _room(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    grown = np.zeros(max(size, 2 * len(array)), array.dtype)
    grown[: len(array)] = array
    return grown


def encoder(path: str) -> Encoder:
    """The worker's encoder of this file; its memo lasts as long as the worker."""
    return worker_wide(f"encoder:{path}", lambda: Encoder(path))
