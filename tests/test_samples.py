"""Samples and reduced vectors, by invariants and against numpy."""

import numpy as np

from chatloom.operators import sampling as S


def _vectors(n=200):
    rng = np.random.default_rng(3)
    return np.concatenate([rng.normal(c, 0.1, (n // 4, 6)) for c in (0, 3, -3, 6)])


def test_kmeans_sample_covers_all_clusters(spark):
    v = _vectors()
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>")
    ids = [r.id for r in S.kmeans_sample(df, 40).collect()]
    assert len(set(ids)) == len(ids) == 40
    assert {i // 50 for i in ids} == {0, 1, 2, 3}
    assert ids == [r.id for r in S.kmeans_sample(df, 40).collect()]
    assert S.kmeans_sample(df, 500).count() == 200
    near = {r.id: r.distance for r in S.kmeans_strata(df, 4).collect()}
    assert len(near) == 200 and max(near.values()) < 30


def test_density_sample_keeps_small_groups(spark):
    rows = [(i, -2 if i < 5 else -1 if i < 8 else 0 if i < 900 else 1) for i in range(902)]
    df = spark.createDataFrame(rows, "id long, label long")
    got = S.density_sample(df, 50).collect()
    by = {k: sum(r.label == k for r in got) for k in (-2, -1, 0, 1)}
    assert len(got) == 50 and by[-2] >= 1 and by[-1] >= 1 and by[1] >= 1


def test_fewer_dimensions_are_principal_components(spark):
    v = _vectors()
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>")
    got = np.array([r.v for r in S.fewer_dimensions(df, 2).orderBy("id").collect()])
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    w, axes = np.linalg.eigh(np.cov(u.T))
    want = u @ axes[:, ::-1][:, :2]
    assert np.allclose(np.abs(got), np.abs(want), atol=1e-6)
