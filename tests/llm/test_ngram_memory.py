"""The n-gram sets of a task's texts take memory by the slice, however many texts there are."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa

from fxtape.llm import ngram_join, texts


class Local:
    """Takes the place of a table and its session: what would run in its tasks is given back."""

    sparkSession = property(lambda self: self)
    sparkContext = property(lambda self: self)

    def broadcast(self, value):
        self.value = value
        return self

    def select(self, *columns):
        return self

    def mapInArrow(self, run, kind):
        return run


def test_peak_of_a_task(monkeypatch):
    words = [" ".join(f"w{(i * 37 + k) % 5000}" for k in range(300)) for i in range(2500)]
    batch = pa.RecordBatch.from_pydict({"doc_id": range(len(words)), "text": words})
    monkeypatch.setattr(ngram_join, "counters", lambda *a: np.zeros(1 << ngram_join.COUNTERS, np.int64))
    run = ngram_join.prefixes(Local(), "doc_id", "text", 3, 90)
    texts._POWERS.clear()
    tracemalloc.start()
    rows = [b.column("n").to_pylist() for b in run(iter([batch]))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(rows, []) == [298] * len(words) and len(rows) > 2
    assert peak < 60e6


def test_hashes_do_not_depend_on_the_slice():
    some = ["one two three four", "", "Äpfel und Birnen und Äpfel", "two three"]
    whole = texts.Words(some).shingles(3)
    for part, sets in ngram_join.slices([pa.RecordBatch.from_pydict({"text": some})], "text", 3):
        assert all(np.array_equal(a, b) for a, b in zip(sets, whole, strict=True)) and part.num_rows == 4
