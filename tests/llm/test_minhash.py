import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import Row

from chatloom.llm import minhash as M


def _sets(texts):
    out = []
    for t in texts:
        w = re.findall(r"[^\W_]+", t.lower())
        grams = [tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if w else []
        out.append({g: grams.count(g) for g in set(grams)} if len(grams) < 4000 else dict(zip(*np.unique([str(g) for g in grams], return_counts=True))))
    return out


def _variants():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    docs = []
    for g in range(12):
        base = [word() for _ in range(rng.randint(40, 160))]
        docs.append(" ".join(base))
        for k in range(rng.randint(1, 6)):
            v = list(base)
            for _ in range(k):
                v[rng.randrange(len(v))] = word()
            docs.append(" ".join(v))
    return docs + docs[:3] + ["", "  ", "one two", "one two", "%%%", "Ünïcode short text", None]


def test_classes_match_brute_force(spark):
    texts = _variants()
    docs = spark.createDataFrame([Row(doc_id=i, text=t, node="clash", bands=1) for i, t in enumerate(texts)], "doc_id long, text string, node string, bands int")
    frequencies, total = M.document_frequencies(docs)
    weight = M.idf(frequencies, total)
    vecs = []
    for t in texts:
        s, tf, _ = M.shingles([t or ""])
        vecs.append((s, tf * weight[M.buckets(s)]))
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(texts)), 2):
        if len(vecs[i][0]) and len(vecs[j][0]) and M.similarity(vecs[i], vecs[j]) >= 0.8:
            a, b = sorted((find(i), find(j)))
            parent[b] = a
    want = {i: find(i) for i in range(len(texts))}
    got = {r.doc_id: r.class_id for r in M.near_duplicate_classes(docs).collect()}
    assert got == want
    assert len(set(want.values())) < len(texts)


def test_shingles_and_similarity_agree_with_sets():
    texts = _variants()[:20]
    sets = _sets(texts)
    for i, j in itertools.combinations(range(len(texts)), 2):
        a, b = ((s, tf) for s, tf, _ in (M.shingles([texts[i]]), M.shingles([texts[j]])))
        both = sum(min(n, sets[j].get(g, 0)) for g, n in sets[i].items())
        want = both / (sum(sets[i].values()) + sum(sets[j].values()) - both)
        assert M.similarity(a, b) == pytest.approx(want)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert M.near_duplicate_classes(docs).collect() == []


def test_samples_estimate_weighted_similarity():
    rng = np.random.default_rng(3)
    s = np.sort(rng.integers(0, 2**63, 400, dtype=np.uint64))
    w = rng.uniform(1, 3, 400)
    a, b = slice(0, 350), slice(50, 400)
    x = M.samples(np.r_[s[a], s[b]], np.r_[w[a], w[b]], np.array([350, 350]))
    want = w[50:350].sum() / w.sum()
    assert abs((x[0] == x[1]).mean() - want) < 0.2


def test_frequencies_are_of_shingles_not_of_buckets(spark, monkeypatch):
    """With more shingles than buckets: exact above the bound, one weight below it."""
    monkeypatch.setattr(M, "DF_BUCKETS", 64)
    monkeypatch.setattr(M, "COMMON", 20, raising=False)
    texts = [f"often seen words in a row {'and in some rows more ' * (i % 4 == 0)}" + " ".join(f"w{i}x{k}" for k in range(30)) for i in range(100)] + ["", None]
    frequencies, total = M.document_frequencies(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3))
    assert total == 102
    want = {}
    for t in texts:
        for x in M.shingles([t or ""])[0].tolist():
            want[x] = want.get(x, 0) + 1
    s = np.array(list(want), np.uint64)
    n = np.array([v if v >= 6 else 1 for v in want.values()])
    assert frequencies[M.buckets(s)].tolist() == n.tolist() and (n > 1).sum() > 4
    assert M.idf(frequencies, total)[M.buckets(s)] == pytest.approx(1 + np.log(103 / (n + 1)) / np.log(104))
