"""Token counts of texts without tokenizing most of them.

Most pre-tokens of a text are in the vocabulary as they stand, and most of
these come out of the merges as that one token. Which ones do is proved once,
before the job, by letting the library merge every vocabulary string alone. In
the job such a pre-token counts one; only the others are merged.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lavra.llm.staging import chunks, worker_wide

# The split of byte-level vocabularies, as published with them.
BYTE_LEVEL_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters that this module and the library class alike (tested one by one); texts with others are split by the library.
ALIKE = "\\x00-\u052f\u2000-\u2070\u3000-\u9fff\uac00-\ud7a3"
#: Here a pre-token always begins, so a long text may be cut.
SURE_CUT = regex.compile(r"(?<=\S) (?=\S)")
#: Long texts are counted in blocks of about so many characters.
BLOCK_CHARS = 1 << 20
#: Counts of merged pre-tokens that a worker keeps, and the longest of these.
MEMO_PIECES = 300_000
MEMO_CHARS = 64


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: printable Latin-1 stays, others follow from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = sorted(set(range(256)) - set(printable))
    return dict(zip(printable, map(chr, printable))) | {byte: chr(0x100 + i) for i, byte in enumerate(others)}


def _load(path: str) -> tuple[Tokenizer, dict]:
    if not path.endswith(".json"):
        raise ValueError(f"{path}: only tokenizer files of the tokenizers library (.json) are counted")
    with open(path, encoding="utf-8") as file:
        said = json.load(file)
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer, said


def _is_byte_level(said: dict) -> bool:
    before = said.get("pre_tokenizer") or {}
    return before.get("type") == "ByteLevel" and bool(before.get("use_regex")) and not before.get("add_prefix_space") and not said.get("normalizer")


def whole_tokens(path: str) -> list[str]:
    """The vocabulary strings that the merges leave as one token when they stand alone, as the model writes them."""
    tokenizer, said = _load(path)
    if (said["model"].get("dropout") or 0) > 0:
        raise ValueError(f"{path}: merges with dropout give no fixed count")
    return sorted(piece for piece in tokenizer.get_vocab(with_added_tokens=False) if _merged(tokenizer, piece) == 1)


def _merged(tokenizer: Tokenizer, piece: str) -> int:
    return len(tokenizer.model.tokenize(piece))


class Counter:
    """Counts the tokens of texts: whole ones by a look, the rest by merging."""

    def __init__(self, path: str, whole: list[str]):
        self.tokenizer, said = _load(path)
        added = [token for token in said.get("added_tokens") or [] if token["content"]]
        plain = not any(token[how] for token in added for how in ("single_word", "lstrip", "rstrip", "normalized"))
        # A special string that takes white space with it, or is looked for after normalizing, is left to the library.
        self.by_library = not plain
        longest_first = sorted((token["content"] for token in added), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, longest_first))) if added else None
        self.byte_level = _is_byte_level(said)
        self.letters = byte_letters()
        if self.byte_level:
            self.split = regex.compile(BYTE_LEVEL_SPLIT)
            self.unlike = regex.compile(f"[^{ALIKE}]")
            byte_of = {letter: byte for byte, letter in self.letters.items()}
            self.whole = set()
            for piece in whole:
                try:
                    self.whole.add(bytes(byte_of[letter] for letter in piece).decode())
                except (KeyError, UnicodeDecodeError):
                    continue  # no text is written so: part of a character
        else:
            self.whole = set(whole)
        self.memo = _Counts(self)

    def merged(self, piece: str) -> int:
        if self.byte_level:
            piece = piece.encode().decode("latin-1").translate(self.letters)
        return _merged(self.tokenizer, piece)

    def pieces(self, text: str) -> list[str]:
        """The pre-tokens: of a byte-level split as they stand in the text, else as the model takes them."""
        before, norm = self.tokenizer.pre_tokenizer, self.tokenizer.normalizer
        if self.byte_level and not self.unlike.search(text):
            return self.split.findall(text)
        if self.byte_level:
            return [text[first:end] for _, (first, end) in before.pre_tokenize_str(text)]
        text = norm.normalize_str(text) if norm else text
        return [piece for piece, _ in before.pre_tokenize_str(text)] if before else [text]

    def count(self, text: str) -> int:
        if self.by_library:
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        parts = self.special.split(text) if self.special else [text]
        total = len(parts) - 1
        for part in parts:
            for block in self._blocks(part):
                total += sum(map(self.memo.__getitem__, self.pieces(block)))
        return total

    def _blocks(self, text: str) -> Iterator[str]:
        first = 0
        while self.byte_level and len(text) - first > BLOCK_CHARS:
            cut = SURE_CUT.search(text, first + BLOCK_CHARS)
            if not cut:
                break
            yield text[first : cut.start()]
            first = cut.start()
        yield text[first:] if first else text


class _Counts(dict):
    """Tokens by pre-token; those proved whole are there from the start."""

    def __init__(self, counter: Counter):
        super().__init__(dict.fromkeys(counter.whole, 1))
        self.counter = counter

    def __missing__(self, piece: str) -> int:
        found = self.counter.merged(piece)
        if len(piece) <= MEMO_CHARS:
            if len(self) > MEMO_PIECES + len(self.counter.whole):
                self.clear()
                self.update(dict.fromkeys(self.counter.whole, 1))
            self[piece] = found
        return found


def count_tokens(docs: DataFrame, path: str, limit: int) -> DataFrame:
    """Count the tokens of each ``text`` as the tokenizers library gives them for the file at ``path``.

    One row per row of ``docs`` with ``doc_id`` as it is (also NULL), ``n_bytes`` (UTF-8), ``n_tokens`` without
    begin, end or added special tokens, and ``over_limit`` (more than ``limit``). Strings of special
    tokens inside a text count as one token, as is the library's default. NULL and empty texts have no
    bytes and no tokens; very long texts are counted in blocks between sure cuts; other columns are not read.
    The whole tokens sent to the tasks are bounded by the vocabulary of the file.
    """
    whole = docs.sparkSession.sparkContext.broadcast(whole_tokens(path))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_wide(f"token-counter:{path}", lambda: Counter(path, whole.value))
        for batch in chunks(batches, "text"):
            texts = batch.column("text")
            n_bytes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            n_tokens = np.fromiter((counter.count(text) if text else 0 for text in texts.to_pylist()), np.int64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), n_bytes, pa.array(n_tokens)], ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select("doc_id", "text").mapInArrow(counted, f"doc_id {id_type}, n_bytes long, n_tokens long")
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)
