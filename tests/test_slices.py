"""What a task of the assignment queries holds at once, however many rows an Arrow batch has."""

import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa

from chatloom.operators import assign, lexical


class Messages:
    """Keeps the function that a table's batches would go through."""

    sparkSession = SimpleNamespace(sparkContext=SimpleNamespace(broadcast=lambda x: SimpleNamespace(value=x)))

    def select(self, *_):
        return self

    def mapInArrow(self, run, _):
        self.run = run
        return self


def _peak(run, batch):
    tracemalloc.start()
    try:
        rows = [(len(b), b) for b in run([batch])]
        return tracemalloc.get_traced_memory()[1], pa.Table.from_batches([b for _, b in rows])
    finally:
        tracemalloc.stop()


def test_scores_of_a_large_batch(spark):
    rng = np.random.default_rng(1)
    phrases = [{"theme": i // 1000, "phrase": i, "v": v} for i, v in enumerate(rng.standard_normal((4000, 4)).tolist())]
    x = rng.standard_normal((5000, 4))
    peak, got = _peak(assign._block_scores(Messages(), phrases).run, pa.RecordBatch.from_arrays([pa.array(range(5000)), pa.array(x.tolist())], ["message", "v"]))
    assert peak < 100e6  # all scores at once take 160 MB, and again for each copy
    p = np.array([r["v"] for r in phrases])
    s = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ (p / np.linalg.norm(p, axis=1, keepdims=True)).T
    want = {(i, t): (round(float(s[i, a : a + 1000].max()), 9), a + int(s[i, a : a + 1000].round(9).argmax())) for i in range(0, 5000, 97) for t, a in enumerate(range(0, 4000, 1000))}
    found = {(r["message"], r["theme"]): (round(r["score"], 9), r["phrase"]) for r in got.to_pylist()}
    assert len(found) == got.num_rows == 20_000 and {k: found[k] for k in want} == want
