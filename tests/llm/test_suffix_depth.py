"""The tree decides on contexts that reach past the previous word."""

from __future__ import annotations

from fxtape.llm import suffix_tree


def test_sixth_byte_decides(spark):
    rows = [(i, "a-----x b-----y " * 40) for i in range(6)] + [(100, "b-----y"), (101, "b-----x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.score for r in suffix_tree.scored(frame, parts=7, held=8).collect()}
    assert found[100] > found[101] + 1
