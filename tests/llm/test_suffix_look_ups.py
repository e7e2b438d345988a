"""Answers are looked up once for each distinct window and in order, with the places as before."""

from __future__ import annotations

import numpy as np

from fxtape.llm import suffix_tree


def test_distinct_and_in_order(monkeypatch):
    rnd = np.random.default_rng(2)
    keys = np.unique(rnd.integers(0, 1 << 56, 5000, dtype=np.uint64))
    codes = rnd.choice(keys[:900], 20_000)
    want, asked, plain = np.searchsorted(keys, codes), [], np.searchsorted
    monkeypatch.setattr(np, "searchsorted", lambda k, c, *a: asked.append(np.array(c)) or plain(k, c, *a))
    assert np.array_equal(suffix_tree.found_at(keys, codes), want)
    assert len(asked) == 1 and len(asked[0]) <= 900 and np.all(np.diff(asked[0].astype(np.int64)) > 0)
    assert len(suffix_tree.found_at(keys, codes[:0])) == 0
