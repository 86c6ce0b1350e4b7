"""Projection by neighbour graphs, and the chain of reduction, outliers, clusters and quotas against plain Python."""

import hashlib

import numpy as np
import pytest
from test_density import plain_labels

from chatloom import catalog
from chatloom.operators import density, projection
from chatloom.operators.sampling import fewer_dimensions


def trust(x, y, k=15):
    """Trustworthiness: 1 if no row has neighbours in y that are far off in x."""
    n = len(x)
    rank = lambda v: np.argsort(np.argsort(((v[:, None] - v[None]) ** 2).sum(2) + np.diag([-1.0] * n), 1, kind="stable"), 1, kind="stable")
    rx, ry = rank(x), rank(y)
    near = (ry >= 1) & (ry <= k)
    return 1 - 2 / (n * k * (2 * n - 3 * k - 1)) * np.maximum(rx - k, 0)[near].sum()


def test_weights_add_up_to_the_logarithm():
    rng = np.random.default_rng(1)
    d = np.sort(rng.random((20, 14)), 1)
    w = projection._weights(d, np.log2(15))
    assert np.allclose(w.sum(1), np.log2(15), atol=1e-6) and np.allclose(w[:, 0], 1) and (np.diff(w, axis=1) <= 0).all()
    assert np.isfinite(projection._weights(np.array([[0.0, 0.0, np.inf]]), 2.0)).all()


def test_projection_keeps_neighbours_better_than_components(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").selectExpr("vec_id AS id", "embedding AS v")
    x = np.array([r.v for r in rows.orderBy("id").collect()], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    both = [np.array([r.v for r in f(rows, 2).orderBy("id").collect()]) for f in (projection.projected, fewer_dimensions)]
    new, components = (trust(x, y) for y in both)
    assert new > components + 0.02, (new, components)
    again = np.array([r.v for r in projection.projected(rows.repartition(5), 2).orderBy("id").collect()])
    assert np.allclose(again, both[0], atol=1e-6)


def _plain_chain(ids, v, size):
    n = len(v)
    d = np.round(np.sqrt(((v[:, None] - v[None]) ** 2).sum(2)), 9)
    np.fill_diagonal(d, np.inf)
    near = np.argsort(d, 1, kind="stable")[:, : min(20, n - 1)]
    reach = np.take_along_axis(d, near, 1)[:, -1]
    density_ = 1 / np.maximum(np.maximum(np.take_along_axis(d, near, 1), reach[near]).mean(1), 1e-10)
    lof = np.round(density_[near].mean(1) / density_, 6)
    out = set(sorted(range(n), key=lambda i: (-lof[i], ids[i]))[: int(n * 0.1)])
    inner = [i for i in range(n) if i not in out]
    labels = dict.fromkeys(out, -2) | dict(zip(inner, plain_labels(v[inner], *density.sizes_for(len(inner))).tolist(), strict=True))
    counts = {k: sum(x == k for x in labels.values()) for k in set(labels.values())}
    quota = {k: min(c, max(size * c // n, 3 if k >= 0 else 2)) for k, c in counts.items()}
    given = sum(quota.values())
    if given > size:
        quota = {k: max(1, int(q * (size / given))) for k, q in quota.items()}
    draw = lambda i: (hashlib.md5(f"42:{ids[i]}".encode()).hexdigest(), ids[i])
    picked = [i for k, q in quota.items() for i in sorted((i for i in labels if labels[i] == k), key=draw)[:q]]
    rest = sorted((i for i in range(n) if i not in picked), key=draw)
    picked += rest[: max(0, size - len(picked))]
    return sorted((ids[i], labels[i]) for i in picked)[:size]


def test_chain_equals_plain(spark):
    rng = np.random.default_rng(4)
    v = np.concatenate([rng.normal(c, 0.2, (60, 6)) for c in (0, 2, -2)] + [rng.uniform(-6, 6, (20, 6))])
    df = spark.createDataFrame([(3 * i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>")
    reduced = df.selectExpr("id", "slice(v, 1, 3) AS v")
    got = sorted((r.id, r.label) for r in projection.density_sample(projection.labelled(reduced), 40).collect())
    assert got == _plain_chain([3 * i for i in range(len(v))], v[:, :3], 40)
    assert projection.density_chain(df, 500).where("label is null").count() == len(v)


def test_query_of_the_chain(spark, sf):
    rows = catalog.queries()["t7_density_chain"](spark, sf).collect()
    assert len({r.id for r in rows}) == len(rows) == 60 and -2 in {r.label for r in rows} and max(r.label for r in rows) >= 0


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_few_rows(spark, n):
    df = spark.createDataFrame([(i, [1.0, float(i), 2.0]) for i in range(n)], "id long, v array<double>")
    assert projection.projected(df, 2).count() == n
