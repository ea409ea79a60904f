"""The memo of the encoder: what new pieces cost, and that none is left half known."""

import os
import re
from time import process_time

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lavra.llm.tokens import MARK, Encoder

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]
TEXTS = [
    "Straße, ÉTÉ. naïve word,word. don't 12,5 x!, a.b. É, end.",
    "",
    " word  word \n\nStraße,\nÀß. end,",
    "new$$$ pieces&&& among known, ones. word $$$",
    "word word new$$$ 漢字, ẞ. İ, \0 <|endoftext|> end",
]
#: The marks as they were written before, from letter to letter.
BEFORE = re.compile(r"(?<=[A-Za-zÀ-ÖØ-öø-ÿ])[.,](?=[ \n]|\Z)")


def whole(path, texts):
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    return [library.encode(text, add_special_tokens=False).ids for text in texts]


def cut(ids, sizes):
    out, at = [], 0
    for size in sizes:
        out.append(ids[at : at + size].tolist())
        at += size
    return out


@pytest.mark.parametrize("name", FILES)
def test_new_and_known_pieces_give_the_ids_of_the_library(name):
    path = public_tokenizers.path(name)
    encoder = Encoder(path)
    for texts in (TEXTS[:2], TEXTS, TEXTS[::-1], [], [""], ["word"]):
        assert cut(*encoder.encode(texts)) == whole(path, texts)


@pytest.mark.parametrize("name", FILES)
def test_a_failed_batch_leaves_no_piece_without_ids(name, monkeypatch):
    path = public_tokenizers.path(name)
    encoder = Encoder(path)
    with monkeypatch.context() as patch:
        patch.setattr(encoder, "_spelled", lambda plain: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            encoder.encode(["some words. and more, of them"])
    assert cut(*encoder.encode(["some words. and more, of them"])) == whole(path, ["some words. and more, of them"])


def test_marks_are_the_same_and_are_found_from_mark_to_mark():
    for text in [*TEXTS, ",", "a,", "a.\n.", "aa,. b., c", "×, ÷. ÿ,"]:
        assert MARK.sub(r" \g<0>", text) == BEFORE.sub(r" \g<0>", text)

    def seconds(pattern):
        start = process_time()
        pattern.sub("", "lettersand spaces" * 100_000)
        return process_time() - start

    assert min(seconds(MARK) for _ in range(5)) < 0.7 * min(seconds(BEFORE) for _ in range(5))


def test_tasks_start_no_threads_of_the_library(monkeypatch):
    monkeypatch.setenv("TOKENIZERS_PARALLELISM", "true")
    Encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert os.environ["TOKENIZERS_PARALLELISM"] == "false"
