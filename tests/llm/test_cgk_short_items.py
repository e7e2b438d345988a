"""Items of every length are found with their first words, or any others, edited."""

from __future__ import annotations

import pytest

from fxtape.llm import cgk


@pytest.mark.parametrize("edit", ["first changed", "first missing", "spread"])
def test_recall_by_length(spark, edit):
    items, rows = [], []
    for n in range(1, 31):
        words, allowed = [f"w{n}x{i}" for i in range(n)], n * 20 // 100
        items.append((n, " ".join(words)))
        if edit == "first missing":
            words = words[allowed:]
        else:
            for k in range(allowed):
                words[k if edit == "first changed" else k * n // allowed] = f"other{k}"
        rows.append((n, " ".join(["before", "it", *words, "after", "it"])))
    found = cgk.searched(
        spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    assert {(r.doc_id, r.item_id): r.distance for r in found} == {(n, n): n * 20 // 100 for n, _ in items}
