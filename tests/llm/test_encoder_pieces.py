"""A word before a comma is the word's own piece, and no finer cut changes an id."""

from __future__ import annotations

import random

import numpy as np
import pytest

from fxtape.llm import simple8b
from fxtape.llm.texts import PIECES

public_tokenizers = pytest.importorskip("public_tokenizers")


def model() -> bytes:
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as file:
        return file.read()


def test_words_are_encoded_once_whatever_follows():
    pieces = simple8b.tokenizer_pieces(model())
    pieces.ids(["so the word, the word. the word; the word"])
    assert set(pieces.known) == {"so", " the", " word", ",", ".", ";"}


def test_ids_are_those_of_whole_texts():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_str(model().decode())
    whole.encode_special_tokens = True
    rnd = random.Random(3)
    some = ["".join(rnd.choice("abZ'st  \n\té,.9ñ'll日—́_") for _ in range(rnd.randint(0, 30))) for _ in range(3000)]
    some += ["don't I'll we've it's, 'tis'", "abcé,abc", " <|endoftext|> x"]
    want = [np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in some]
    assert simple8b.tokenizer_pieces(model()).ids(some) == want


def test_other_patterns_keep_the_cuts_that_all_share():
    import json

    told = json.loads(model())
    told["pre_tokenizer"]["use_regex"] = False
    assert not simple8b.gpt2_pattern(json.dumps(told).encode()) and simple8b.gpt2_pattern(model())
    assert simple8b.tokenizer_pieces(json.dumps(told).encode()).cuts is PIECES
