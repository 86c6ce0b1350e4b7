"""Exact weighted Jaccard links between the members of one cell, a bounded block of texts, without a row for each pair."""

from __future__ import annotations

import numpy as np

from chatloom.llm.common import mix

#: Columns of the dense product that counts what texts have in common.
TILE = 2048


def candidates(x: np.ndarray, labels: list, few: list, rare: bool, least: float) -> np.ndarray:
    """Whether each member has one that it is to be compared with and that shares `least` or more of the samples x: a member
    whose label is rare is compared with those of other labels, rare too or not."""
    marked, few, labels = np.zeros(len(few), bool), np.array(few, bool), np.array(labels, object)
    for i in np.flatnonzero(few).tolist():
        other = np.flatnonzero((labels != labels[i]) & (few if rare else ~few))
        hit = other[(x[other] == x[i]).mean(1) >= least]
        if len(hit):
            marked[i] = marked[hit] = True
    return marked


def common_weights(vectors: list[tuple[np.ndarray, np.ndarray]], weigh) -> tuple[np.ndarray, np.ndarray]:
    """Of texts as (shingles, counts): total weight of each, and the weight that each two different ones have in common. weigh: shingles to
    the weight of one occurrence. The k-th occurrence of a shingle is a feature of its own, so a minimum becomes a product."""
    n = len(vectors)
    sizes = np.array([len(s) for s, _ in vectors])
    s, tf = np.concatenate([s for s, _ in vectors]), np.concatenate([tf for _, tf in vectors]).astype(np.int64)
    row, weight = np.repeat(np.arange(n), sizes), weigh(s)
    total = np.bincount(row, weight * tf, n)
    nth = np.arange(tf.sum()) - np.repeat(np.cumsum(tf) - tf, tf)
    feature = mix(np.repeat(s, tf) + mix(nth.astype(np.uint64)))
    row, weight = np.repeat(row, tf), np.repeat(weight, tf)
    _, first, column, count = np.unique(feature, return_index=True, return_inverse=True, return_counts=True)
    shared = np.cumsum(count > 1) - 1
    keep = np.flatnonzero(count[column] > 1)
    keep = keep[np.argsort(shared[column[keep]], kind="stable")]
    at, row, weight = shared[column[keep]], row[keep], weight[first[count > 1]]
    common = np.zeros((n, n))
    for low in range(0, len(weight), TILE):
        a, b = np.searchsorted(at, (low, low + TILE))
        width = min(TILE, len(weight) - low)
        has = np.zeros((n, width))
        has[row[a:b], at[a:b] - low] = 1
        common += (has * weight[low : low + width]) @ has.T
    return total, common


def links(keys: list, labels: list, few: list, rare: bool, vectors: list[tuple[np.ndarray, np.ndarray]], weigh, similarity, threshold: float) -> list[tuple]:
    """(key, key, similarity) of members with threshold or more and different labels, enough to connect all labels that such
    pairs connect; which members are compared: see candidates()."""
    total, common = common_weights(vectors, weigh)
    number = {v: k for k, v in enumerate(dict.fromkeys(labels))}
    label, few = np.array([number[v] for v in labels]), np.array(few, bool)
    maybe = common >= (threshold - 1e-9) * (total[:, None] + total[None, :] - common)
    maybe &= (label[:, None] != label[None, :]) & few[:, None] & (few if rare else ~few)[None, :]
    if rare:
        maybe = np.triu(maybe)
    root = list(range(len(number)))

    def top(k: int) -> int:
        while root[k] != k:
            root[k] = k = root[root[k]]
        return k

    out = []
    for i, j in zip(*(x.tolist() for x in np.nonzero(maybe)), strict=True):
        a, b = top(int(label[i])), top(int(label[j]))
        if a != b:
            exact = similarity(*((s, tf * weigh(s)) for s, tf in (vectors[i], vectors[j])))
            if exact >= threshold:
                root[a] = b
                out.append((keys[i], keys[j], exact))
    return out
