"""Many examples that share common words: few of them are scored a second time, and none is lost."""

from __future__ import annotations

import numpy as np
import pandas as pd

from fxtape.llm import toxicity


def test_long_texts_against_many_examples(monkeypatch):
    rnd, terms = np.random.default_rng(5), 4000
    share = 1 / np.arange(1, terms + 1)

    def some(n: int) -> np.ndarray:
        return np.sort(rnd.choice(terms, n, replace=False, p=share / share.sum())).astype(np.int32)

    made = [some(150) for _ in range(3000)]
    rows = pd.DataFrame([{"key": i, "y": i % 2, "terms": t, "counts": np.ones(len(t), np.int32)} for i, t in enumerate(made)])
    index = toxicity.Index(rows, 1 + np.log(1 / share) * rnd.random(terms))
    queries = [some(150) for _ in range(300)]
    again, met = [], toxicity.Lists.met
    monkeypatch.setattr(toxicity.Lists, "met", lambda *a: again.append(len(a[-1])) or met(*a))
    judged = list(index.judged([(t, np.ones(len(t)), 0.0) for t in queries], (1.0, 0.0)))
    assert len(again) == 300 and max(again) < 2 * toxicity.NEAREST
    whole = index.weights[np.arange(terms)].astype(float)
    for t, (_, _, cosines) in zip(queries, judged, strict=True):
        terms_of, w = index.vector(t, np.ones(len(t)))
        found, score = index.nearest(t, np.ones(len(t)))
        plain = w.astype(float) @ whole[terms_of]
        best = np.lexsort((np.arange(len(plain)), -plain))[: toxicity.NEAREST]
        assert np.allclose(score, plain[best], atol=1e-6) and set(np.round(cosines, 6)) <= set(np.round(score, 6))
        assert np.all(plain[found] >= plain[best[-1]] - 1e-6)
