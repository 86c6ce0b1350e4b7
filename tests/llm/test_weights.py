"""Weights of shingles follow one rule at every size of the table."""

import numpy as np
import pytest

from chatloom.llm import minhash as M


@pytest.mark.parametrize("n", [18, 24, 150])
def test_weights_are_exact_and_without_a_jump(spark, monkeypatch, n):
    """Shingle k is in k documents. What is counted makes no difference, and weights fall with a shingle's share of the documents, which has a least value."""
    words = [f"shared{k} words in some rows" for k in range(1, 18)]
    texts = [" . ".join(w for k, w in enumerate(words, 1) if i < k) or "none of these here today" for i in range(n)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(M, "RAREST", 20, raising=False)
    s = np.concatenate([M.shingles([w])[0] for w in words])
    df = np.arange(1, 18)
    want = 1 + np.log((n + 1) / (np.maximum(df, n / 20) + 1)) / np.log(n + 2)
    for common in (20, 4096):
        monkeypatch.setattr(M, "COMMON", common)
        frequencies, total = M.document_frequencies(docs)
        got = M.idf(frequencies, total)[s]
        assert total == n and got == pytest.approx(want, abs=1e-12)
