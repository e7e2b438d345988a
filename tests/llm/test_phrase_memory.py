"""The words of a task's texts take memory by the slice, however many texts there are."""

from __future__ import annotations

import tracemalloc

import pyarrow as pa

from fxtape.llm import phrases


class Local:
    """Takes the place of a table: what would run in its tasks is given back."""

    def mapInArrow(self, run, kind):
        return run


def test_peak_of_a_task():
    texts = [" ".join(f"w{(i * 37 + k) % 5000}" for k in range(300)) for i in range(2500)]
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * len(texts), "text": texts})
    seen = []
    run = phrases.emitted(Local(), "n long", lambda p: seen.append(len(p.hash)) or pa.RecordBatch.from_pydict({"n": [len(p.hash)]}))
    phrases.Pieces(["warm"], ["en"])
    tracemalloc.start()
    total = sum(b.column(0)[0].as_py() for b in run(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert total == 300 * len(texts) and len(seen) > 2
    assert peak < 50e6
