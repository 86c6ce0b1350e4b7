"""Vectors of texts: paraphrases find their originals, anagrams don't look alike."""

import random

import numpy as np

from chatloom import catalog
from chatloom.operators.embed import text_vectors


def paraphrase(text, rng):
    """One word in ten goes, one in ten gets another ending, and sentences change places."""
    sentences = text.split(". ")
    rng.shuffle(sentences)
    out = []
    for w in " ".join(sentences).split():
        x = rng.random()
        if x >= 0.1:
            out.append(w + "s" if x < 0.2 else w)
    return " ".join(out)


def test_paraphrases_find_their_originals(spark, sf):
    rng = random.Random(7)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect() if r.text and len(r.text.split()) >= 8]
    planted = [(-1 - i, paraphrase(t, rng)) for i, t in rows]
    df = spark.createDataFrame(rows + planted, "id long, text string").repartition(5)
    v = {r.id: np.array(r.v) for r in text_vectors(df).collect()}
    ids = [i for i, _ in rows]
    near = np.array([v[i] for i in ids]) @ np.array([v[-1 - i] for i in ids]).T
    hits = [i == ids[j] or v[i] @ v[ids[j]] > 0.95 for i, j in zip(ids, near.argmax(0), strict=True)]  # a near copy of the original counts
    assert np.mean(hits) >= 0.9


def test_anagrams_nulls_and_empty_tables(spark):
    rows = [(1, "listen to the silent"), (2, "enlist ot eht tinsel"), (3, "Listen, to the SILENT!"), (4, None), (5, ""), (6, "..."), (7, "one"), (7, "one")]
    df = spark.createDataFrame(rows, "id long, text string")
    got = [(r.id, np.array(r.v)) for r in text_vectors(df, 64).collect()]
    v = dict(got)
    assert len(got) == 8 and v[1] @ v[3] > 0.999 and v[1] @ v[2] < 0.5
    assert all(not v[i].any() for i in (4, 5, 6)) and np.isclose(np.linalg.norm(v[7]), 1)
    assert text_vectors(df.limit(0)).collect() == []


def test_query_gives_every_document_a_vector(spark, sf):
    rows = catalog.queries()["m25_text_vectors"](spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count() and {len(r.v) for r in rows} == {64}
