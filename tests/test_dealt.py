"""Phrases beyond PHRASES meet messages by shuffle: none passes the driver but those that tell that there are more."""

import numpy as np
import pytest

from chatloom.operators import assign


@pytest.mark.parametrize("copies", [1, 4])
def test_many_phrases_are_dealt(spark, monkeypatch, copies):
    rng = np.random.default_rng(4)
    p, x = np.repeat(rng.integers(-2, 3, (40, 3)), copies, 0).astype(float), rng.integers(-2, 3, (90, 3)).astype(float)
    themes = rng.integers(0, 6, len(p))
    phrases = spark.createDataFrame([(int(t), i, v) for i, (t, v) in enumerate(zip(themes, p.tolist(), strict=True))], "theme long, phrase long, v array<double>")
    messages = spark.createDataFrame(list(enumerate(x.tolist())), "message long, v array<double>")
    whole = sorted(map(tuple, assign.theme_scores(messages, phrases).select("message", "theme", "phrase").collect()))

    unit = lambda m: np.divide(m, np.linalg.norm(m, axis=1, keepdims=True), out=np.zeros_like(m), where=np.linalg.norm(m, axis=1, keepdims=True) > 0)
    s = (unit(x) @ unit(p).T).round(9)
    want = sorted((i, int(t), int(np.flatnonzero(themes == t)[s[i, themes == t].argmax()])) for i in range(len(x)) for t in np.unique(themes))
    assert whole == want

    monkeypatch.setattr(assign, "PHRASES", 7)
    monkeypatch.setattr(assign, "MESSAGES", 25, raising=False)
    frame, collected = type(phrases), []
    collect = frame.collect
    monkeypatch.setattr(frame, "collect", lambda self: collected.append(rows := collect(self)) or rows)
    monkeypatch.setattr(frame, "toLocalIterator", lambda self, *_: collected.append(rows := collect(self)) or iter(rows))
    dealt = assign.theme_scores(messages, phrases)
    assert sum(map(len, collected)) <= 8 + 2  # and two counts
    rows = collect(dealt)
    assert sorted((r.message, r.theme, r.phrase) for r in rows) == want
    assert all(round(r.score, 9) == s[r.message, r.phrase] for r in rows)
