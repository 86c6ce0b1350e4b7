"""The sums that the quality classifier learns from: by Spark, so that a task that makes features has one Python worker."""

import numpy as np

from chatloom.llm import quality


def test_moments_take_no_worker_of_their_own(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x, y = rng.standard_normal((60, len(quality.FEATURES))), rng.integers(0, 2, 60)
    taught = spark.createDataFrame([(a, b) for a, b in zip(x.tolist(), y.tolist(), strict=True)], "x array<double>, quality int")

    def called(*_):
        raise AssertionError("a second Python function")

    monkeypatch.setattr(type(taught), "mapInArrow", called)
    got = quality.moments(taught)
    for k in (0, 1):
        rows = np.c_[np.ones((y == k).sum()), x[y == k]]
        assert np.allclose(got[k], rows.T @ rows, atol=1e-9)
    none = quality.moments(taught.where("quality > 1"))
    assert not none[0].any() and none[1].shape == (1 + len(quality.FEATURES),) * 2
