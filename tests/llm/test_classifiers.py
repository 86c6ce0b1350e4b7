import random
import re

import numpy as np
from pyspark.sql import functions as F

from chatloom.llm import langid as L
from chatloom.llm import pii as S
from chatloom.llm import quality as Q

PATTERNS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def _base(t):
    out = []
    for kind, p in PATTERNS:
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 16 <= len(d) <= 19 and S.luhn(d), "phone": 8 <= len(d) <= 15}[kind]:
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_match_the_patterns():
    rng = random.Random(3)
    for _ in range(20000):
        t = "".join(rng.choice("a@@..1 -+2(b3é") for _ in range(rng.randint(0, 40)))
        assert _base(t) == S.base_spans(t), t
    assert S.base_spans("9" * 200_000 + "." * 1000) == []  # linear in the length


def test_field_adds_spans_and_keeps_base_ones():
    rng = random.Random(5)
    texts = [f"write to user{k}@mail{k}.example.org or +49 30 {rng.randint(10**6, 10**7 - 1)} from 10.0.{k % 250}.7 page {k}" for k in range(40)]
    field = S.train(texts)
    key = "".join(rng.choice("0123456789abcdef") for _ in range(40))
    text = f'mail a@b.cd, token = "{key}" end'
    base, found = S.find(text, field)
    assert base == [("email", 5, 11)] and set(base) <= set(found)
    at = text.index(key)
    assert ("secret", at, at + 40) in found
    assert S.find("in the year 1999 we saw 12 birds", field) == ([], [])


def test_personal_data_table(spark):
    rows = [(1, "a@b.cd +1 555 010 9999"), (2, None), (3, ""), (None, "10.0.0.1"), (1, "a@b.cd +1 555 010 9999")]
    df = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, base string")
    got = {r.doc_id: r for r in S.digest(S.find_personal_data(df)).collect()}
    assert (got[1].n_email, got[1].n_phone, got[None].n_ip, got[2].spans) == (1, 1, 1, "")
    assert got[1].base_sha256 == S.base_sha256(rows[0][1]) and got[2].base_sha256 == got[3].base_sha256 == S.base_sha256("")
    assert S.find_personal_data(df.limit(0), S.Field()).collect() == []


def _naive_phrases(text, reference):
    n, i = 0, 0
    while i < len(text):
        k = 1
        while i + k <= len(text) and text[i : i + k] in reference:
            k += 1
        i += max(k - 1, 1)
        n += 1
    return n


def _text(x):
    return "".join(chr(c) if c else " " for c in x.tolist())


def test_phrases_match_longest_matches(monkeypatch):
    """Exactly, also over the edges of blocks, where nothing meets for long, and for letters beyond the dense table."""
    rng = random.Random(7)
    word = lambda a: "".join(rng.choice(a) for _ in range(rng.randint(1, 7)))
    han = [chr(0x4E00 + i) for i in range(300)]
    samples = {"x": [" ".join(word("abcde") for _ in range(300))], "y": [" ".join(word("defgh") for _ in range(300)), "zzzz"], "z": ["".join(rng.choice(han) for _ in range(900))]}
    model = L.Model(samples)
    many = lambda a, n: " ".join(word(a) for _ in range(n))
    texts = [many("abcdefgh", 40) for _ in range(20)] + [many("abcdefgh", 2500), "z" * 5001, many(han, 2000), "ab" * 3000, "", "ÿ" * 1500, many("abcdefgh", 1) * 1500]
    x, sizes = L.letters(texts)
    whole = model.phrases(x, sizes)
    parts = np.split(x, np.cumsum(sizes)[:-1])
    for k, lang in enumerate(model.langs):
        reference = _text(L.reference(samples[lang], L.REFERENCE_CHARS))
        assert whole[k].tolist() == [_naive_phrases(_text(p), reference) for p in parts]
    assert max(map(len, parts)) > 10_000
    for block, dense in ((7, L.DENSE), (100, 5)):
        monkeypatch.setattr(L, "BLOCK", block)
        monkeypatch.setattr(L, "DENSE", dense)
        assert (L.Model(samples).phrases(x, sizes) == whole).all()
    assert model.predict(["abc abd", "", "123 %%", "hgf fgh", "".join(han[:20])])[0] == ["x", "und", "und", "y", "z"]


def test_eight_scripts_are_told_apart():
    rng = random.Random(3)
    alphabets = {"latin": (0x61, 24), "greek": (0x3B1, 24), "cyrillic1": (0x430, 30), "cyrillic2": (0x430, 30), "hebrew": (0x5D0, 22), "arabic": (0x628, 24), "kana": (0x3042, 60), "han1": (0x4E00, 2500), "han2": (0x4E00, 2500)}
    words = {k: ["".join(chr(a + rng.randrange(n)) for _ in range(rng.randint(1, 3) if n > 100 else rng.randint(2, 8))) for _ in range(800)] for k, (a, n) in alphabets.items()}
    made = lambda k, n: " ".join(rng.choices(words[k], k=n))
    model = L.Model({k: [made(k, 300) for _ in range(60)] for k in words})
    for k in words:
        got = model.predict([made(k, 40) for _ in range(100)])[0]
        assert got.count(k) >= 95, k


def test_the_reference_takes_equal_shares():
    assert _text(L.reference(["aaaa", "bb", "c" * 90], 12)) == "aaaa bb cccccc "
    assert len(L.reference(["d" * 50] * 4, 20)) == 24 and len(L.reference([], 20)) == 0


def test_ties_repeated_rows_and_clashing_columns(spark):
    rows = [(i, "ab ba ab", "one") for i in range(40)] + [(100 + i, "ab ba ab", "two") for i in range(40)] + [(7, "ab ba ab", "one")] * 30
    df = spark.createDataFrame([(i, t, k, 1, 0.5) for i, t, k in rows], "doc_id long, text string, lang string, lang_pred int, score double")
    got = L.detect_language(df).collect()
    assert len(got) == len(rows) and len({(r.lang_pred, r.score) for r in got}) == 1
    language, score = L.Model({"two": ["ab ba ab"], "one": ["ab ba ab"]}).predict(["ab ba", "q"])
    assert language == ["one", "one"] and score.tolist() == [0.0, 0.0]
    assert L.detect_language(df.limit(0)).collect() == []
    assert {r.lang_pred for r in L.detect_language(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_language_of_held_out_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = L.detect_language(docs).join(docs.select("doc_id", F.col("lang")), "doc_id").where("held_out")
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.9
    odd = spark.createDataFrame([(1, None, "en"), (2, "", None), (3, "12 !", "en"), (None, "word " * 5000, None)], "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in L.detect_language(odd).collect()}
    assert got == {1: "und", 2: "und", 3: "und", None: "und"} or got[None] == "en"


def test_quality_of_held_out_documents(spark, sf):
    big = sf.replace("sf0.001", "sf0.01")  # more labels, if they are there
    docs, labels = spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet")
    found = Q.quality_scores(docs, labels)
    assert found.count() == docs.count()
    right = found.where("held_out").join(labels, "doc_id").agg(F.avg((F.col("quality") == F.col("predicted")).cast("int"))).first()[0]
    assert right > 0.95
    kept = Q.drop_low_quality(docs, labels)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()


def test_quality_without_labels_and_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 5), (2, "", 5), (None, "x " * 3000, 5)], "doc_id long, text string, score int")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in Q.quality_scores(docs, none).collect()] == [0.5] * 3
    assert Q.quality_scores(docs.limit(0), none).collect() == []


def test_features_and_scores_are_consistent():
    texts = ["Some words, here.\nAnd more 12!", "", "  ", "ÉÉ!! É!!", "same same same same"]
    together = Q.features(texts)
    assert np.allclose(together, np.concatenate([Q.features([t]) for t in texts]))
    rng = np.random.default_rng(1)
    d = len(Q.FEATURES)
    a, b = rng.normal(0, 1, (500, d)), rng.normal(1, 2, (300, d))
    sums = {k: np.c_[np.ones(len(x)), x].T @ np.c_[np.ones(len(x)), x] for k, x in ((0, a), (1, b))}
    model = Q.fit(sums, 0.0, 0.0)
    x = rng.normal(0.5, 1, (5, d))
    logs = []
    for k, m in ((0, a), (1, b)):
        c = np.cov(m.T, bias=True) + 0.0
        diff = x - m.mean(0)
        logs.append(np.log(len(m) / 800) - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * np.einsum("ij,jk,ik->i", diff, np.linalg.inv(c), diff))
    assert np.allclose(Q.score(model, x), 1 / (1 + np.exp(logs[0] - logs[1])), atol=1e-6)
