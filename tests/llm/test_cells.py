import random

import numpy as np
import pytest

from chatloom.llm import cells as C
from chatloom.llm import minhash as M


def _texts(rng, n):
    base = [rng.choice(["ab", "cd", "ef", "gh", "ij", "kl"]) + str(rng.randint(0, 40)) for _ in range(60)]
    out = []
    for _ in range(n):
        w = base[:]
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(60)] = str(rng.random())
        out.append(" ".join(w + ["x"] * rng.randint(0, 3)))
    return out


def _vectors(texts):
    out = []
    for t in texts:
        s, tf, _ = M.shingles([t])
        out.append((s, tf))
    return out


def test_common_weights_match_pairwise_similarity():
    rng = random.Random(2)
    vectors = _vectors(_texts(rng, 30))
    weigh = lambda s: 1 + (s % np.uint64(7)).astype(float) / 7
    total, common = C.common_weights(vectors, weigh)
    for i in range(30):
        for j in set(range(30)) - {i}:
            want = M.similarity(*((s, tf * weigh(s)) for s, tf in (vectors[i], vectors[j])))
            assert common[i, j] / (total[i] + total[j] - common[i, j]) == pytest.approx(want)


@pytest.mark.parametrize("rare", [False, True])
def test_links_connect_what_all_pairs_connect(rare):
    rng = random.Random(3)
    n = 40
    vectors, keys = _vectors(_texts(rng, n)), [bytes([i]) for i in range(n)]
    labels = [keys[i % 30] for i in range(n)]
    few = [rng.random() < 0.6 for _ in range(n)]
    weigh = lambda s: np.ones(len(s))

    def closure(pairs):
        root = {v: v for v in labels}

        def top(v):
            while root[v] != v:
                v = root[v]
            return v

        for a, b in pairs:
            root[top(labels[keys.index(a)])] = top(labels[keys.index(b)])
        return [[top(a) == top(b) for b in labels] for a in labels]

    allowed = lambda i, j: labels[i] != labels[j] and few[i] and (few[j] if rare else not few[j])
    every = [(keys[i], keys[j]) for i in range(n) for j in range(n) if allowed(i, j) and M.similarity(*((s, tf * weigh(s)) for s, tf in (vectors[i], vectors[j]))) >= 0.8]
    got = C.links(keys, labels, few, rare, vectors, weigh, M.similarity, 0.8)
    assert every and {(a, b) for a, b, _ in got} <= set(every) | {(b, a) for a, b in every}
    assert closure([x[:2] for x in got]) == closure(every)


def test_candidates_are_of_other_labels():
    x = np.array([[1, 2, 3], [1, 2, 3], [9, 9, 9], [1, 2, 4]], np.uint16)
    assert C.candidates(x, [b"a", b"b", b"b", b"b"], [True, False, False, False], False, 0.6).tolist() == [True, True, False, True]
    assert C.candidates(x, [b"a", b"a", b"b", b"a"], [True, True, True, True], True, 0.6).tolist() == [False] * 4
