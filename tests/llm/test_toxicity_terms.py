"""Words that are rare among the examples find the example they stand in."""

from __future__ import annotations

import math

import numpy as np
import pytest

from fxtape.llm import toxicity


def test_near_copy_of_a_toxic_example_with_rare_words(spark):
    rows = [(i, f"plain{i} words{i} here{i} stand{i}") for i in range(40)] + [(100, "zarf quux blort"), (101, "zarf quux blort again")]
    labels = [(i, int(i % 8 == 0)) for i in range(40)] + [(100, 1)]
    found = toxicity.scored(
        spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"), parts=1, held=1
    ).collect()
    near = {r.doc_id: r for r in found}[101]
    # Three equal words of four: the word no example has counts in the norm with the largest idf.
    factor = 1 + toxicity.ratio(np.array([1.0]), np.array([1.0]), 6, 41)[0] / toxicity.RATIO
    shared, other = factor * (math.log(43 / 3) + 1), math.log(43) + 1
    cosine = math.sqrt(3) * shared / math.sqrt(3 * shared**2 + other**2)
    assert near.evidence == [100] and near.cosines[0] == pytest.approx(cosine, abs=1e-5) and near.score > 0.1
    assert near.score > max(r.score for r in found if r.doc_id < 40 and r.doc_id % 8)
