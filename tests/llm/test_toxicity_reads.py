"""Words of a text are told once, by bytes where ASCII characters part them, and stored without loss."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from fxtape.llm import toxicity


def test_words_by_bytes_are_those_of_the_pattern():
    rnd = random.Random(4)
    some = ["".join(rnd.choice("aB é—’_9Σß日 .\x1c\x85\n  ́İ") for _ in range(rnd.randint(0, 25))) for _ in range(5000)]
    for t in [*some, "", "Élan vital_9, ΟΔΟΣ"]:
        assert {w.decode(): n for w, n in toxicity.counted(t).items()} == Counter(toxicity.words(t))


@pytest.mark.parametrize("n, others", [(0, 0), (0, 3), (5, 0), (300, 7)])
def test_counts_are_stored_whole(n, others):
    rnd = np.random.default_rng(n)
    terms = np.sort(rnd.choice(2**31 - 1, n, replace=False)).astype(np.int32)
    given = terms, rnd.integers(1, 70_000, n, dtype=np.int32), np.sort(rnd.integers(1, 9, others, dtype=np.int32))
    for a, b in zip(given, toxicity.unpacked(toxicity.packed(*given)), strict=True):
        assert np.array_equal(a, b)


def test_texts_are_read_once(spark):
    rows = [(i, f"word{i % 7} some text") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, toxic int")
    plan = toxicity.scored(docs, labels)._jdf.queryExecution().analyzed().toString()
    assert "hits" in plan and "text#" not in plan
