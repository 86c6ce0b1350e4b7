"""Buckets larger than a block: results, and rows in proportion to members."""

import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from chatloom.llm import minhash as M


def _template(rng, n, fixed=300, own=30):
    same = [f"t{k}" for k in range(fixed)]
    return [" ".join(same + [f"{rng.random():.9f}"[2:] for _ in range(own)]) for _ in range(n)]


def _near(rng, text, k):
    w = text.split()
    for _ in range(k):
        w[rng.randrange(300, len(w))] = f"x{rng.randrange(10**9)}"
    return " ".join(w)


def _vectors(docs, texts):
    frequencies, total = M.document_frequencies(docs)
    weight = M.idf(frequencies, total)
    return [(s, tf * weight[M.buckets(s)]) for s, tf, _ in (M.shingles([t or ""]) for t in texts)]


def _links(vecs, pairs):
    return [(i, j) for i, j in pairs if len(vecs[i][0]) and len(vecs[j][0]) and M.similarity(vecs[i], vecs[j]) >= M.THRESHOLD]


def _classes(n, links):
    root = list(range(n))

    def top(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for i, j in links:
        a, b = sorted((top(i), top(j)))
        root[b] = a
    return {i: top(i) for i in range(n)}


def test_template_bucket_equals_brute_force(spark, monkeypatch):
    rng = random.Random(4)
    texts = _template(rng, 90)
    texts += [_near(rng, texts[i], 1 + i % 3) for i in range(0, 60, 2)] + ["one two three four five six seven"] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    links = _links(_vectors(docs, texts), itertools.combinations(range(len(texts)), 2))
    assert len(links) >= 15
    monkeypatch.setattr(M, "BLOCK", 8)
    monkeypatch.setattr(M, "SPLIT", 1)
    asked = []
    prefixes = M.prefixes
    monkeypatch.setattr(M, "prefixes", lambda *a: asked.append(1) or prefixes(*a))
    assert {r.doc_id: r.class_id for r in M.near_duplicate_classes(docs).collect()} == _classes(len(texts), links)
    assert asked  # buckets over a block did occur


def test_similar_texts_share_a_prefix(spark):
    rng = random.Random(6)
    texts = _template(rng, 40)
    texts += [_near(rng, t, 3) for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    vecs = _vectors(docs, texts)
    frequencies, total = M.document_frequencies(docs)
    weights = spark.sparkContext.broadcast(M.idf(frequencies, total))
    by = {}
    for r in M.prefixes(docs, spark.sparkContext.broadcast(M.ranks(docs)), weights).collect():
        by.setdefault(bytes(r.node), set()).add(r.key)
    keys = [M.node_keys(*M.shingles([t]))[0] for t in texts]
    links = _links(vecs, itertools.combinations(range(len(texts)), 2))
    assert links and all(by[keys[i]] & by[keys[j]] for i, j in links)
    assert all(len(by[k]) < 60 for k in keys)


def _rows_of_a_bucket(spark, monkeypatch, n):
    """Rows compared for n texts of one template in as many components under one key, in a corpus so large that the template counts as rare."""
    texts = [" ".join(f"t{k}" for k in range(30)) + " " + " ".join(f"w{i}x{k}" for k in range(12)) for i in range(n)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    weights = spark.sparkContext.broadcast(M.idf(M.Weights(np.zeros(0, np.uint64), np.zeros(0, np.int64), 1), 5000 * n))
    signed = M.materialize(M.signatures(docs, weights), "signed")
    nodes = M.materialize(signed.select("node", F.col("doc_id").alias("rep"), F.lit(1).cast("long").alias("copies"), F.array(F.lit(7).cast("long")).alias("bands"), "samples"), "nodes")
    shared = M.materialize(M.shared_bands(nodes), "shared")
    assert shared.count() == n
    seen = []
    grouped = M._grouped
    with monkeypatch.context() as m:
        m.setattr(M, "_grouped", lambda table, *a: seen.append(table.count()) or grouped(table, *a))
        m.setattr(M, "SPLIT", 4)
        labels = nodes.select("node", F.col("node").alias("label")).limit(0)
        assert M.other_links(docs, nodes, shared, labels, weights).count() == 0
    return sum(seen)


def test_rows_grow_with_members_of_a_bucket(spark, monkeypatch):
    for n in (4_000, 16_000):
        assert _rows_of_a_bucket(spark, monkeypatch, n) < 10 * n


def test_both_sides_of_the_split_give_equal_classes(spark, monkeypatch):
    """Templates whose fillings are less and more than a fifth of the text, and texts right at the threshold."""
    rng = random.Random(8)
    texts = _template(rng, 60, 300, 30) + _template(rng, 60, 60, 40)
    texts += [_near(rng, texts[i], 1 + i % 4) for i in range(0, 60, 2)] + [" ".join(texts[i].split()[:-k]) for i in range(60, 120, 3) for k in (2, 6)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    links = _links(_vectors(docs, texts), itertools.combinations(range(len(texts)), 2))
    want = _classes(len(texts), links)
    assert 30 < len(links)
    monkeypatch.setattr(M, "BLOCK", 8)
    for split in (0, 10**6):
        monkeypatch.setattr(M, "SPLIT", split)
        assert {r.doc_id: r.class_id for r in M.near_duplicate_classes(docs).collect()} == want


def test_recall_against_all_pairs(spark):
    """2,100 documents, with pairs right at and above the threshold."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    texts = []
    for _ in range(700):
        base = [word() for _ in range(rng.randint(60, 140))]
        texts.append(" ".join(base))
        for k in (1, 2):
            w = list(base)
            for _ in range(k):
                w[rng.randrange(len(w))] = word()
            texts.append(" ".join(w))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.class_id for r in M.near_duplicate_classes(docs).collect()}
    links = _links(_vectors(docs, texts), ((i, j) for g in range(0, len(texts), 3) for i, j in itertools.combinations(range(g, g + 3), 2)))
    assert len(links) > 1100 and np.mean([got[i] == got[j] for i, j in links]) > 0.999
    assert all(got[i] // 3 == i // 3 for i in got)


def test_counts_over_sixteen_bits_are_exact():
    a, b = M.shingles(["a " * 200_004])[:2], M.shingles(["a " * 100_004])[:2]
    assert a[1].tolist() == [200_000] and abs(M.similarity(a, b) - 0.5) < 1e-9
