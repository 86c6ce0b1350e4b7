import hashlib
import random
import re
from collections import Counter

import numpy as np

import corpus_pipeline
from chatloom.llm import chunks as C
from chatloom.llm import decontam as D


def _words(rng, n, letters="abcdefgh"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))


def _chunks(data):
    starts, _ = C.edges(np.frombuffer(data, np.uint8), np.array([len(data)]))
    ends = [*starts[1:].tolist(), len(data)] if len(starts) else []
    return list(zip(starts.tolist(), ends, strict=True))


def test_chunks_resist_shifts_and_keep_bounds():
    rng = random.Random(1)
    data = _words(rng, 800).encode()
    a = {data[s:e] for s, e in _chunks(data)}
    moved = b"inserted " + data
    b = {moved[s:e] for s, e in _chunks(moved)}
    assert len(a & b) > 0.95 * len(a)
    for x in (data, b"a" * 5000, b"", b"abc"):
        spans = _chunks(x)
        assert b"".join(x[s:e] for s, e in spans) == x
        assert all(e - s <= C.MAX for s, e in spans) and all(e - s >= C.MIN for s, e in spans[:-1])


def test_duplicate_runs_match_brute_force(spark):
    rng = random.Random(2)
    passage = _words(rng, 60)
    texts = {i: _words(rng, rng.randint(0, 200)) + (f" {passage} " if i % 3 == 0 else "") + _words(rng, 20) for i in range(40)}
    texts |= {40: texts[1], 41: "", 42: None}
    seen, want = {}, {}
    for i in sorted(texts):
        data = (texts[i] or "").encode()
        spans, run = [], None
        for s, e in _chunks(data):
            digest = hashlib.blake2b(data[s:e], digest_size=16).digest()
            if seen.setdefault(digest, (i, s)) != (i, s):
                run = (run[0], e) if run and run[1] == s else ((spans.append(run) if run else None), (s, e))[1]
        if run:
            spans.append(run)
        want[i] = [x for x in spans if x and x[1] - x[0] >= C.RUN]
    df = spark.createDataFrame([(i, t, 1) for i, t in texts.items()], "doc_id long, text string, size int").repartition(4)
    got = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in C.duplicate_runs(df).collect()}
    assert got == want
    assert all(want[i] for i in range(3, 40, 3)) and sum(map(bool, want.values())) == 14
    assert C.duplicate_runs(df.limit(0)).collect() == []


def _weighted(text, idf, default):
    w = [x for x in re.split(r"[^\w]+|_", text.lower()) if x]
    return {g: n * idf.get(g, default) for g, n in Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)).items()}


def test_leaks_match_brute_force(spark):
    rng = random.Random(3)
    items = {k: _words(rng, rng.randint(15, 40)) for k in range(15)} | {90: "two words", 91: "", 92: None}
    docs = {}
    for i in range(60):
        item = items[i % 15].split()
        for _ in range(i // 15):
            item[rng.randrange(len(item))] = "changed"
        docs[i] = f"{_words(rng, rng.randint(0, 50))} {' '.join(item)}. {_words(rng, rng.randint(0, 30))}"
    docs |= {60: None, 61: "", 62: "only Two  WORDS here", 63: _words(rng, 3000)}
    grams = [set(_weighted(t, {}, 1)) for k, t in items.items() if k < 90]
    df = Counter(g for s in grams for g in s)
    n = len(grams)
    idf = {g: round(1000 * (1 + np.log((n + 1) / (c + 1)) / np.log(n + 2))) for g, c in df.items()}
    want = set()
    for i, text in docs.items():
        w = re.findall(r"[^\W_]+", (text or "").lower())
        for k, item in items.items():
            size = len(re.findall(r"[^\W_]+", (item or "").lower()))
            if size < 5:
                continue
            a = _weighted(item, idf, 2000)
            for s in range(1 - size, len(w)):
                b = _weighted(" ".join(w[max(s, 0) : s + size]), idf, 2000)
                common = sum(min(v, b.get(g, 0)) for g, v in a.items())
                if common and common / (sum(a.values()) + sum(b.values()) - common) >= 0.8:
                    want.add((i, k))
                    break
    want.add((62, 90))
    rows = spark.createDataFrame([(i, t, "x") for i, t in docs.items()], "doc_id long, text string, h string")
    bench = spark.createDataFrame([(k, t, 1) for k, t in items.items()], "item_id long, text string, place int")
    got = {(r.doc_id, r.item_id) for r in D.contaminated(rows, bench).collect()}
    assert got == want and len(want) > 15
    assert D.contaminated(rows.limit(0), bench).collect() == [] and D.contaminated(rows, bench.limit(0)).collect() == []


def test_near_values_cover_the_radius(spark):
    from pyspark.sql import functions as F

    rng = random.Random(4)
    pairs = []
    for _ in range(200):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), D.RADIUS):
            b ^= 1 << bit
        pairs.append((a - (1 << 63), b - (1 << 63)))
    df = spark.createDataFrame(pairs, "a long, b long")
    meet = F.size(F.array_intersect(D.near_block_values(F.col("a")), D.block_values(F.col("b"))))
    assert df.where(meet == 0).count() == 0


def test_pipeline_stages(spark, tmp_path):
    rng = random.Random(5)
    good = lambda n: ". ".join(_words(rng, 9, "aeinrst").capitalize() for _ in range(n))
    texts = {i: good(12) for i in range(60)}
    texts |= {100: texts[1], 101: texts[2] + " One more ending here", 102: good(3) + " " + (item := good(3)) + " " + good(3)}
    texts |= {200 + i: "!!! ".join(_words(rng, 60, "ABC").split()) for i in range(30)}
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 200), 0) for i in texts], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, str(tmp_path))
        assert left.columns == docs.columns
        kept.append({r.doc_id for r in left.select("doc_id").collect()})
    assert kept[0] == {i for i in texts if i < 200}
    assert kept[1] == kept[0] - {1}
    assert kept[2] == kept[1] - {101}
    assert kept[3] == kept[2] - {102}
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in packed.select("doc_id").collect()} == kept[3]


def test_short_runs_count_and_passages_reach_over_edges(spark):
    rng = random.Random(8)
    passage = _words(rng, 51)
    texts, where = {}, {}
    for i in range(30):
        head = _words(rng, rng.randint(5, 60)) + f" {i}# "
        texts[i], where[i] = f"{head}{passage} @{i} {_words(rng, 20)}", (len(head), len(head) + len(passage))
    texts |= {100 + i: f"{_words(rng, 30)} {i} {passage[90:200]} {i} {_words(rng, 30)}" for i in range(10)} | {200: "q" * 900, 201: "q" * 900}
    seen, dups = {}, {}
    for i in sorted(texts):
        data = texts[i].encode()
        dups[i] = sum(seen.setdefault(data[s:e], (i, s)) != (i, s) for s, e in _chunks(data))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in C.duplicate_runs(df).collect()}
    assert {i: r.n_duplicates for i, r in got.items()} == dups
    assert any(0 < sum(e - s for s, e in _chunks(texts[i].encode())[:1]) and dups[i] and not got[i].spans for i in range(100, 110))
    for i in range(1, 30):
        a, b = where[i]
        assert any(s.start <= a and b <= s.end and b - a <= s.end - s.start <= b - a + 12 for s in got[i].passages), i
        assert got[i].n_repeated == sum(s.end - s.start for s in got[i].passages)
    assert [(s.start, s.end) for s in got[201].passages] == [(0, 900)]
