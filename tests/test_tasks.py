"""Groups have tasks of their own, rows are not written once for each party, and the faster kernels find what plain ones find."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from chatloom.operators import neighbours, projection


@pytest.mark.parametrize("most,want", [(100, [1] * 7), (3, [2, 2, 3])])
def test_groups_are_dealt_evenly(spark, most, want):
    rows = spark.range(70).select("id", (F.col("id") % 7 * 5).alias("number"))
    keys, tasks = neighbours.keyed(rows, "number", "key", most)
    dealt = rows.join(keys, "number").repartition(tasks, "key").withColumn("task", F.spark_partition_id())
    assert sorted(r.n for r in dealt.groupBy("task").agg(F.countDistinct("key").alias("n")).collect()) == want
    assert dealt.select("number", "key").distinct().count() == dealt.select("key").distinct().count() == 7


def test_rows_are_written_once(spark, monkeypatch):
    n = 1200
    v = np.random.default_rng(5).standard_normal((n, 16))  # no clusters: every party meets every slab
    df = spark.createDataFrame(list(enumerate(v.tolist())), "id long, v array<double>")
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 12)
    kept, sent = neighbours.checkpointed, []

    def counted(rows):
        out = kept(rows)
        sent.append(out.count())
        return out

    monkeypatch.setattr(neighbours, "checkpointed", counted)
    assert neighbours.nearest(df, 4).count() == 4 * n
    assert sum(sent) < 8 * n  # each party's copy of the rows makes 8 more


@pytest.mark.parametrize("dims,shift,scale", [(64, 0, 1), (64, 50, 1e-3), (8, 0, 1), (3, 1e6, 1e-6), (64, 0, 1e-25), (5, 0, 1e25)])
def test_short_floats_leave_out_no_pair(dims, shift, scale):
    rng = np.random.default_rng(dims)
    x, y = (shift + scale * rng.standard_normal((n, dims)) for n in (70, 301))
    d = np.array([neighbours.exact(np.broadcast_to(a, y.shape), y) for a in x])
    most = np.sort(d, 1)[:, 9]  # bounds that a pair meets exactly
    most[0] = np.inf
    i, j, got = neighbours.within(x, y, most)
    want = np.nonzero(d <= most[:, None])
    assert (i == want[0]).all() and (j == want[1]).all() and (got == d[want]).all()
    assert all(len(a) == 0 for a in neighbours.within(x, y[:0], most))


def _plain_steps(ids, y, a, b, w, at, names, others, seed, rates):
    """One edge after the other; at: where rows of other blocks are."""
    rng = np.random.default_rng([seed, int(ids[0])])
    own = {k: i for i, k in enumerate(ids.tolist())}
    force_of = lambda x, f: np.clip(f * x, -projection.CLIP, projection.CLIP)
    for rate in rates:
        drawn = np.flatnonzero(rng.random(len(w)) < w)
        pushed = rng.integers(0, len(names), len(drawn) * projection.PUSHES).reshape(len(drawn), -1)
        force, times = np.zeros_like(y), np.zeros(len(y))
        for e, pushes in zip(drawn, pushed, strict=True):
            i = own[a[e]]
            times[i] += 1
            x = y[i] - (y[own[b[e]]] if b[e] in own else at[b[e]])
            d2 = (x**2).sum()
            if d2 > 0:
                force[i] += force_of(x, -2 * projection.A * projection.B * max(d2, 1e-12) ** (projection.B - 1) / (1 + projection.A * d2**projection.B))
            for p in pushes:
                x = y[i] - (y[own[names[p]]] if names[p] in own else others[p])
                d2 = (x**2).sum()
                if d2 > 0:
                    force[i] += force_of(x, 2 * projection.B / ((0.001 + d2) * (1 + projection.A * d2**projection.B)))
        y = y + rate * force / np.maximum(times, 1)[:, None]
    return y


def test_steps_equal_plain():
    rng = np.random.default_rng(3)
    everyone, y = np.arange(0, 120, 3), rng.standard_normal((40, 5))
    rows = np.arange(10, 26)
    ids, names = everyone[rows], rng.choice(everyone, 9, replace=False)
    a, b = np.repeat(ids, 6), np.concatenate([np.sort(rng.choice(everyone[everyone != i], 6, replace=False)) for i in ids])
    w, rates = rng.random(len(a)), np.array([1.0, 0.9, 0.8])
    still = np.setdiff1d(b, ids)
    other = np.where(np.isin(b, ids), np.searchsorted(ids, b), len(ids) + np.searchsorted(still, b))
    args = names, y[names // 3], 7, rates
    got = projection._steps(ids, y[rows].copy(), np.searchsorted(ids, a), other, w, y[still // 3], *args)
    want = _plain_steps(ids, y[rows], a, b, w, dict(zip(everyone.tolist(), y, strict=True)), *args)
    assert np.allclose(got, want, rtol=0, atol=1e-9)
