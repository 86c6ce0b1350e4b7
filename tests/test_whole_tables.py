"""Queries that once read the first ids alone, on tables with more rows than that, against plain Python."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from chatloom import catalog
from chatloom.functions.text import clean_english, round_half_even
from chatloom.operators import assign, facts, neighbours
from chatloom.operators import vector_quality as quality
from chatloom.plans.fixtures import frame

ROWS = 4020
NAMES = ["red linen box", "blue linen", "green tin box", "red"]


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("parts"))
    rows = [(i, NAMES[i % len(NAMES)], "TIN Plate" if i % 3 else "Linen") for i in range(1, ROWS + 1)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_type string").write.parquet(f"{path}/part.parquet")
    return path, {i: f"{n} {t.lower()}" for i, n, t in rows}


def _bm25(texts):
    words = {n: n.split() for n in NAMES}
    df, mean = Counter(w for ws in words.values() for w in set(ws)), sum(map(len, words.values())) / len(NAMES)
    idf = {w: math.log((len(NAMES) + 1) / c) for w, c in df.items()}
    return {t: {n: sum(q * idf[w] * (1 + ws.count(w) * 2.5 / (1.5 * (0.25 + 0.75 * len(ws) / mean) + ws.count(w))) for w, q in Counter(t.split()).items() if w in idf) for n, ws in words.items()} for t in set(texts.values())}


def _ratio(a, b):
    a, b = (" ".join(sorted(x.split())) for x in (a, b))
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return 2 * row[-1] / (len(a) + len(b))


def _cosine(a, b):
    x, y = ([t.count(c) for c in "abcdefghijklmnopqrstuvwxyz"] for t in (a, b))
    return sum(i * j for i, j in zip(x, y, strict=True)) / math.sqrt(sum(i * i for i in x) * sum(j * j for j in y))


def test_every_message_has_its_best_bm25(spark, parts):
    path, texts = parts
    best = _bm25(texts)
    got = {r.message: r.raw for r in catalog.queries()["m2_best_bm25"](spark, path).collect()}
    assert got == {i: pytest.approx(max(best[t].values()), abs=1e-6) for i, t in texts.items()}


def test_signals_of_every_message_and_theme(spark, parts, monkeypatch):
    path, texts = parts
    raw = _bm25(texts)
    themes = {}
    for n in NAMES:
        themes.setdefault(ord(n[0]), []).append(n)
    want = {}
    for t in set(texts.values()):
        for k, names in themes.items():
            phrase = min(names, key=lambda n: (-round(_cosine(t, n), 9), n))
            cosine, r, fuzzy = _cosine(t, phrase), max(raw[t][n] for n in names), max(_ratio(t, n) for n in names)
            norm = 1 / (1 + math.exp(-(r - 3) / 2))
            want[t, k] = (phrase, *(pytest.approx(v, abs=2e-6) for v in (cosine, norm, fuzzy, 0.55 * cosine + 0.3 * norm + 0.15 * fuzzy)))
    for most in (assign.PHRASES, 1):  # 1: phrases in blocks of one
        monkeypatch.setattr(assign, "PHRASES", most)
        rows = catalog.queries()["m4_fusion"](spark, path).collect()
        assert len(rows) == ROWS * len(themes)
        assert all((r.phrase, r.cosine, r.norm, r.fuzzy, r.fusion) == want[texts[r.message], r.theme] for r in rows)


def test_phrase_matches_count_each_assigned_message_once(spark, parts):
    path, _ = parts
    decided = catalog.queries()["m5_decide_fused"](spark, path).where("theme >= 0").count()
    got = catalog.queries()["a31_phrase_matches"](spark, path).collect()
    assert decided > 0 and sum(r.n for r in got) == decided and all(r.phrase[0] == chr(r.theme) for r in got)


def test_local_outliers_equal_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(2)
    v = np.r_[rng.normal(0, 1, (60, 5)), rng.normal(4, 0.3, (30, 5)), [[20.0] * 5]].astype(np.float32)
    v[7] = v[8]
    k, n = 6, len(v)
    d = np.round(np.sqrt(((v[:, None].astype(float) - v[None]) ** 2).sum(2)), 9)
    np.fill_diagonal(d, np.inf)
    near = [sorted(range(n), key=lambda j: (d[i, j], j))[:k] for i in range(n)]
    reach = [max(d[i, j] for j in near[i]) for i in range(n)]
    density = [1 / np.mean([max(d[i, j], reach[j]) for j in near[i]]) for i in range(n)]
    lof = {i: round(np.mean([density[j] for j in near[i]]) / density[i], 6) for i in range(n)}
    first = sorted(lof, key=lambda i: (-lof[i], i))[: n // 10]
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<float>").repartition(3)
    for pivots, rows in ((256, 2048), (7, 5)):  # few pivots and small blocks, so rows visit others
        monkeypatch.setattr(neighbours, "PIVOTS", pivots)
        monkeypatch.setattr(neighbours, "PIVOT_ROWS", 4)
        monkeypatch.setattr(neighbours, "BLOCK_ROWS", rows)
        monkeypatch.setattr(neighbours, "QUERY_ROWS", 20)
        got = {r.id: (r.lof, r.outlier) for r in quality.local_outliers(df, k).collect()}
        assert got == {i: (pytest.approx(x, abs=2e-6), int(i in first)) for i, x in lof.items()}
    assert quality.local_outliers(df.limit(0), k).collect() == []


def test_half_even_is_pythons(spark, sf):
    df = spark.createDataFrame(list(enumerate([2.675, 0.125, 1.005, -2.5, None, 1234567.0, 0.5, 1.5])), "id long, x double")
    got = [r.x for r in df.select("id", round_half_even(F.col("x"), 2).alias("x")).orderBy("id").collect()]
    assert got == [2.67, 0.12, 1.0, -2.5, None, 1234567.0, 0.5, 1.5]
    given = {r.id: r.x for r in frame(spark, sf, "numbers").collect()}
    got = {r.id: r.x for r in catalog.queries()["f26_half_even"](spark, sf).collect()}
    assert got == {i: x if x is None else round(x, 2) for i, x in given.items()} and len(got) > 100


def test_long_text_without_blanks_is_cleaned_in_time(spark):
    text = "a1" * 500_000
    df = spark.createDataFrame([(text,), (text + "@x",), ("5$ or a.b@c d",)], "t string")
    assert [r.c for r in df.select(clean_english(F.col("t")).alias("c")).collect()] == [text, "", "5 or d"]


def test_many_events_of_one_user_take_time_in_proportion(spark):
    events = spark.range(60_000).select(F.lit(1).alias("u"), F.col("id").alias("t"), F.col("id").alias("e"))
    got = facts.next_event(events.where("e % 2 = 0"), events.where("e % 10 = 5"), "u", "t", "e")
    assert got.where("next_e = t + (15 - t % 10) % 10").count() == got.where("t < 59996").count()
