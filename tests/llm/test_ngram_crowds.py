"""Columns of many documents: they link no documents by themselves, and hide no link."""

from __future__ import annotations

import random

from fxtape.llm import ngram_join


def rows_of(texts: list[str]) -> tuple[list[tuple[int, str]], list[set]]:
    sets = []
    for t in texts:
        w = t.split()
        sets.append({tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))})
    return list(enumerate(texts)), sets


def test_a_phrase_of_many_documents_makes_no_cluster(spark):
    """Prefixes of 60 documents with one column in common; a pair of their size shares six at least."""
    rows = [(i, 100, i.to_bytes(24, "little"), [1, *range(100 * i, 100 * i + 15)]) for i in range(1, 61)]
    prefixed = spark.createDataFrame(rows, "id long, n long, identity binary, prefix array<bigint>")
    assert ngram_join.prefix_sizes(100, 90) == (16, 6)
    assert ngram_join.clusters(prefixed, 90, 32).count() == 0


def test_links_through_wide_columns_are_found(spark):
    """Near copies beside documents with parts of them, so that a pair's prefix columns are wide, narrow or both."""
    rnd, texts = random.Random(6), []
    for length in (8, 25, 60, 130):
        base = [f"b{length}x{i}" for i in range(length)]
        for i in range(9):
            words = list(base)
            for _ in range(rnd.randrange(3)):
                words[rnd.randrange(length)] = f"c{rnd.randrange(10**6)}"
            texts.append(" ".join(words))
            begin = rnd.randrange(length - 5)
            texts.append(" ".join(base[begin : begin + rnd.randrange(4, length)] + [f"d{rnd.randrange(10**6)}" for _ in range(rnd.randrange(9))]))
    rows, sets = rows_of(texts)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for percent, wide in ((60, 1), (80, 3), (90, 6)):
        parent = list(range(len(sets)))
        for i in range(len(sets)):
            for j in range(i):
                if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                    a, b = parent[i], parent[j]
                    parent = [min(a, b) if p in (a, b) else p for p in parent]
        found = {r.doc_id: r.component_id for r in ngram_join.joined(docs, percent=percent, wide=wide).collect()}
        assert found == dict(enumerate(parent)), (percent, wide)
