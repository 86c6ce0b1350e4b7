"""The pipeline, stage by stage, against plain Python, with null and repeated ids, clashing columns, very long texts and empty tables."""

import itertools
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from chatloom.llm import common
from chatloom.llm import minhash as M
from chatloom.llm import quality as Q

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, h int, start long, kept boolean"


def _sentences(rng, n):
    return ". ".join(" ".join("".join(rng.choice("aeinrst") for _ in range(rng.randint(2, 7))) for _ in range(9)).capitalize() for _ in range(n))


def _quality(rows, labels):
    x = Q.features([t or "" for _, t in rows])
    sums = {k: np.zeros((x.shape[1] + 1,) * 2) for k in (0, 1)}
    for (i, _), v in zip(rows, x, strict=True):
        if i is not None and zlib.crc32(str(i).encode()) % 3 != 1:
            for j, y in labels:
                if j == i:
                    z = np.r_[1, v]
                    sums[y] += np.outer(z, z)
    keep = Q.score(Q.fit(sums), x) >= 0.5
    return [r for r, k in zip(rows, keep, strict=True) if k]


def _together(rows, kept):
    """Rows whose id is kept at least once."""
    ids = {i for (i, _), k in zip(rows, kept, strict=True) if k}
    return [r for r in rows if r[0] in ids]


def _exact(rows):
    last = {}
    for i, t in rows:
        last.setdefault(t or "", []).append(i)
    most = {t: max((i for i in ids if i is not None), default=None) for t, ids in last.items()}
    return _together(rows, [i == most[t or ""] for i, t in rows])


def _near(spark, rows):
    texts = [t or "" for _, t in rows]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    frequencies, total = M.document_frequencies(docs)
    weight = M.idf(frequencies, total)
    vecs = [(s, tf * weight[M.buckets(s)]) for s, tf, _ in (M.shingles([t]) for t in texts)]
    root = list(range(len(rows)))

    def top(x):
        return x if root[x] == x else top(root[x])

    for a, b in itertools.combinations(range(len(rows)), 2):
        if len(vecs[a][0]) and len(vecs[b][0]) and M.similarity(vecs[a], vecs[b]) >= 0.8:
            root[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[top(k)] = min(i, least.get(top(k), i))
    return _together(rows, [i == least.get(top(k)) for k, (i, _) in enumerate(rows)])


def _words(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def _benchmark(rows, items):
    grams = lambda w: Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    frequency = Counter(g for t in items for g in grams(_words(t)))
    idf = lambda g: round(1000 * (1 + np.log((len(items) + 1) / (frequency[g] + 1)) / np.log(len(items) + 2))) if g in frequency else 2000

    def bad(t):
        w = _words(t)
        for item in map(_words, items):
            a = grams(item)
            for s in range(1 - len(item), len(w)):
                b = grams(w[max(s, 0) : s + len(item)])
                common_weight = sum(min(n, b[g]) * idf(g) for g, n in a.items())
                if common_weight and common_weight / (sum(n * idf(g) for c in (a, b) for g, n in c.items()) - common_weight) >= 0.8:
                    return True
        return False

    gone = {i for i, t in rows if bad(t)}
    return [r for r in rows if r[0] not in gone]


def _frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "n", 1, 2, True) for i, t in rows], SCHEMA).repartition(3)


def test_stages_equal_plain_python(spark, tmp_path):
    rng = random.Random(5)
    item = _sentences(rng, 3)
    rows = [(i, _sentences(rng, rng.randint(8, 14))) for i in range(50)]
    rows += [(100, rows[1][1]), (101, rows[2][1] + " Esta tira nesa"), (102, f"{_sentences(rng, 3)} {item} {_sentences(rng, 3)}"), (None, rows[3][1]), (None, _sentences(rng, 9)), (7, rows[7][1]), (7, _sentences(rng, 9))]
    rows += [(150, _sentences(rng, 2500)), (151, None), (152, ""), (153, rows[4][1]), (153, rows[5][1] + " " + item)]
    rows += [(200 + i, "!!! ".join(_sentences(rng, 6).upper().split())) for i in range(30)]
    labels = [(i, int(i < 200)) for i, _ in rows if i is not None and i % 4] + [(10**9, 1)]
    _frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, y, 0) for i, y in labels], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    want = [_quality(rows, labels)]
    want.append(_exact(want[-1]))
    want.append(_near(spark, want[-1]))
    want.append(_benchmark(want[-1], [item]))
    assert len({len(w) for w in want}) == 4
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for (name, stage), rows_left in zip(corpus_pipeline.STAGES[:-1], want, strict=False):
        docs = common.materialize(stage(spark, docs, str(tmp_path)), name.replace(" ", "-"))
        assert docs.columns == [c.split()[0] for c in SCHEMA.split(", ")]
        got = [(r.doc_id, r.text) for r in docs.collect()]
        assert sorted(got, key=repr) == sorted(rows_left, key=repr), name

    before = set(common._tables)
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    left = set(common._tables) - before
    assert len(left) == 1 and all(map(os.path.isdir, left))
    tokens = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = Counter((i, len(tokens.encode(t or "", add_special_tokens=False).ids) + 1) for i, t in want[-1])
    assert Counter((p.doc_id, p.doc_tokens) for p in pieces if p.start == 0) == ids
    assert sum(p.length for p in pieces) == sum(n * k for (_, n), k in ids.items())


def test_empty_tables(spark, tmp_path):
    _frame(spark, [(1, "x")]).limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_exact_stage_keeps_the_largest_id_of_equal_texts(spark):
    rows = [(1, "a"), (3, "a"), (2, "b"), (None, "a"), (None, "c")]
    got = corpus_pipeline.STAGES[1][1](spark, _frame(spark, rows), "")
    assert {r.doc_id for r in got.collect()} == {2, 3, None}
