"""Rows travel once for each group that they meet, not once for each block."""

import numpy as np

from chatloom.operators import neighbours


def test_rows_sent_grow_with_the_table(spark, monkeypatch):
    n, k = 1200, 4
    v = np.random.default_rng(5).standard_normal((n, 16))  # no clusters: every row needs nearly every block
    df = spark.createDataFrame(list(enumerate(v.tolist())), "id long, v array<double>")
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 12)
    sent, kept = [], neighbours.checkpointed

    def counted(rows):
        out = kept(rows)
        sent.append(out.count())
        return out

    monkeypatch.setattr(neighbours, "checkpointed", counted)
    got = {(r.a, r.b, r.d) for r in neighbours.nearest(df, k).collect()}
    assert sum(sent) < 30 * n  # a row for each visit makes about n / 12 a row
    d = np.round(np.sqrt(((v[:, None] - v[None]) ** 2).sum(2)), 9)
    np.fill_diagonal(d, np.inf)
    want = {(i, int(j), float(d[i, j])) for i in range(n) for j in np.lexsort((np.arange(n), d[i]))[:k]}
    assert got == want
