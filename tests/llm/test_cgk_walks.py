"""The walks alone find copies with all the edits allowed, in every class of lengths; stretches are for the rest."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest

from fxtape.llm import cgk
from fxtape.llm.texts import Words

VOCABULARY = [f"w{i}" for i in range(3000)]


def item_words(rnd: random.Random, n: int) -> list[str]:
    """Words of falling frequency, as in prose."""
    return [VOCABULARY[int(3000 ** rnd.random()) - 1] for _ in range(n)]


def copy_of(rnd: random.Random, words: list[str], edits: int) -> list[str]:
    """``edits`` words changed, removed or preceded by another word."""
    out = list(words)
    for place in sorted(rnd.sample(range(len(words)), edits), reverse=True):
        how = rnd.randrange(3)
        out[place : place + 1] = [["other"], [], ["other", out[place]]][how]
    return out


def index_of(items: list[list[str]], repetitions: int = 300, percent: int = 20) -> cgk.ItemIndex:
    rows = pd.DataFrame({"item": range(len(items)), "text": [" ".join(w) for w in items]})
    return cgk.ItemIndex(rows, repetitions, percent)


@pytest.mark.parametrize("shortest,longest", [(1, 4), (5, 9), (10, 19), (20, 39), (40, 80), (200, 300)])
def test_recall_of_walks(shortest, longest):
    rnd = random.Random(shortest)
    items = [item_words(rnd, rnd.randint(shortest, longest)) for _ in range(40)]
    index = index_of(items)
    assert index.straight == []
    texts, wanted = [], []
    for k, words in enumerate(items * 5):
        edits = len(words) * 20 // 100
        texts.append(" ".join([*item_words(rnd, 60), *copy_of(rnd, words, edits), *item_words(rnd, 60)]))
        wanted.append((k, k % 40))
    found = {(d, at) for d, at, _ in index.candidates(Words(texts))}
    assert len(found & set(wanted)) >= 0.95 * len(wanted)


def test_equal_copies_are_always_found():
    rnd = random.Random(9)
    items = [item_words(rnd, n) for n in range(1, 70)]
    index = index_of(items)
    texts = [" ".join([*item_words(rnd, n % 7), *words]) for n, words in enumerate(items)]
    found = {(d, at, begin - int(first)) for texts_ in [Words(texts)] for d, at, begin in index.candidates(texts_)
             for first in [texts_.first[d]]}
    assert {(n, n, n % 7) for n in range(69)} <= found


def test_items_whose_copies_need_more_walks_get_stretches():
    rnd = random.Random(2)
    items = [item_words(rnd, 30) for _ in range(5)]
    index = index_of(items, repetitions=1)
    assert index.straight == [0, 1, 2, 3, 4]
    texts = [" ".join(copy_of(rnd, words, 6)) for words in items]
    assert {(n, n) for n in range(5)} <= {(d, at) for d, at, _ in index.candidates(Words(texts))}


def test_edited_copies_say_where_the_words_are():
    rng = np.random.default_rng(1)
    words = np.arange(1, 21, dtype=np.uint64)
    for kind in range(cgk.COPIES):
        copy, place = cgk.edited(words, 4, kind, rng)
        kept = place >= 0
        assert (copy[place[kept]] == words[kept]).all() and kept.sum() >= 16
    assert (cgk.edited(words, 0, 9, rng)[0] == words).all()
