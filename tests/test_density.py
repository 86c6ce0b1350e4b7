"""Density clusters against a plain version that walks the tree from the top."""

import numpy as np
import pytest

from chatloom import catalog
from chatloom.operators import density as D
from chatloom.operators import neighbours


def plain_tree(v, samples):
    n = len(v)
    d = np.round(np.sqrt(((v[:, None] - v[None]) ** 2).sum(2)), 9)
    np.fill_diagonal(d, np.inf)
    core = np.sort(d, 1)[:, min(samples, n - 1) - 1]
    w = np.maximum(np.maximum(core[:, None], core[None]), d)
    edges = sorted((w[i, j], i, j) for i in range(n) for j in range(i + 1, n))
    group = list(range(n))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    out = []
    for e in edges:
        a, b = find(e[1]), find(e[2])
        if a != b:
            group[a] = b
            out.append(e)
    return out


def plain_labels(v, least, samples):
    edges = plain_tree(v, samples)
    near = {i: [] for i in range(len(v))}
    for e in edges:
        near[e[1]].append((e, e[2]))
        near[e[2]].append((e, e[1]))

    def part(start, limit):
        seen, todo = {start}, [start]
        while todo:
            for e, other in near[todo.pop()]:
                if e < limit and other not in seen:
                    seen.add(other)
                    todo.append(other)
        return seen

    clusters = []  # points, birth, parent, sum of densities

    def split(points, limit, birth, parent):
        """A cluster of points, connected by edges below limit."""
        me = len(clusters)
        clusters.append([points, birth, parent, 0.0])
        while True:
            inner = [e for p in points for e, _ in near[p] if e < limit and e[1] in points and e[2] in points]
            top = max(inner)
            density = 1 / max(top[0], 1e-9)
            a, b = part(top[1], top), part(top[2], top)
            if len(a) >= least and len(b) >= least:
                clusters[me][3] += len(points) * density
                return split(a, top, density, me), split(b, top, density, me)
            if len(a) < least and len(b) < least:
                clusters[me][3] += len(points) * density
                return None
            points, small = (a, b) if len(a) >= least else (b, a)
            clusters[me][3] += len(small) * density
            limit = top

    labels = np.full(len(v), -1)
    if len(v) < least:
        return labels
    split(set(range(len(v))), (np.inf,), 0.0, None)
    best, good = {}, {}
    for i in reversed(range(len(clusters))):
        points, birth, parent, total = clusters[i]
        below = sum(best[j] for j in range(len(clusters)) if clusters[j][2] == i)
        stable = total - len(points) * birth
        good[i] = parent is not None and round(stable, 6) >= round(below, 6)
        best[i] = stable if good[i] else below
    picked = [i for i in range(len(clusters)) if good[i]]
    tops = []
    for i in picked:
        p = clusters[i][2]
        while p is not None and not good[p]:
            p = clusters[p][2]
        if p is None:
            tops.append(i)
    for k, i in enumerate(sorted(tops, key=lambda i: min(clusters[i][0]))):
        labels[list(clusters[i][0])] = k
    return labels


def _blobs(seed):
    rng = np.random.default_rng(seed)
    v = np.concatenate([rng.normal(c, s, (n, 3)) for c, s, n in ((0, 0.3, 40), (4, 0.5, 50), (4.8, 0.1, 25), (-6, 1.5, 30))])
    v[5], v[6], v[7] = v[4], v[4], v[4]
    return np.round(v, 2)


@pytest.mark.parametrize("pivots,rows,piece", [(256, 2048, None), (6, 7, 20)])
def test_labels_equal_plain(spark, monkeypatch, pivots, rows, piece):
    """The second case has many cells and blocks and a tree in many pieces."""
    for name, value in (("PIVOTS", pivots), ("PIVOT_ROWS", 4), ("BLOCK_ROWS", rows), ("QUERY_ROWS", 40)):
        monkeypatch.setattr(neighbours, name, value)
    v = _blobs(1)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>").repartition(3)
    tree = sorted((r.w, r.lo, r.hi) for r in D.spanning_tree(df, 4).collect())
    assert tree == [(pytest.approx(w), i, j) for w, i, j in plain_tree(v, 4)]
    got = {r.id: r.label for r in D.density_clusters(df, 6, 4, piece).collect()}
    want = plain_labels(v, 6, 4)
    assert len(set(want)) > 3
    assert [got[i] for i in range(len(v))] == want.tolist()


def test_many_equal_vectors_and_few_rows(spark):
    v = np.array([[1.0, 2.0]] * 40 + [[5.0, 5.0]] * 12 + [[9.0, float(i)] for i in range(7)])
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>")
    got = {r.id: r.label for r in D.density_clusters(df, 5, 3).collect()}
    assert [got[i] for i in range(len(v))] == plain_labels(v, 5, 3).tolist()
    assert [r.label for r in D.density_clusters(df.limit(1), 5, 3).collect()] == [-1]
    assert D.density_clusters(df.limit(0), 5, 3).collect() == []
    assert {r.label for r in D.density_clusters(df.where("id < 4"), 5, 3).collect()} == {-1}


def test_query_labels_all_embeddings(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    v = np.array([r.embedding for r in rows], np.float64)
    got = {r.id: r.label for r in catalog.queries()["m17_density_clusters"](spark, sf).collect()}
    assert [got[r.vec_id] for r in rows] == plain_labels(v, *D.sizes_for(len(v))).tolist()
