import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from chatloom.llm import exact_dedup as E
from chatloom.llm import packing as P

ROWS = [(1, "a"), (2, "b"), (3, "a"), (4, None), (5, ""), (6, "é" * 70000), (7, "é" * 70000), (8, "é" * 69999 + "e"), (9, " a"), (None, "b"), (3, "a")]


def _frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, keep_id string, f1 int")


def _want(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t in rows:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def test_exact_groups_match_brute_force(spark):
    for modulus in (E.P, 3):  # 3: nearly all fingerprints collide, so the texts decide
        got = sorted((tuple(r) for r in E.exact_groups(_frame(spark, ROWS), modulus).collect()), key=repr)
        assert got == _want(ROWS)
    assert E.exact_groups(_frame(spark, []).limit(0)).collect() == []


def test_fingerprints_compose():
    rng = random.Random(1)
    for base in E.BASES:
        pw = E.powers(base, 8)
        for n in (0, 1, 7, 8, 9, 40):
            data = bytes(rng.randrange(256) for _ in range(n))
            whole, direct = int(E.fingerprints([data], base, pw, 8)[0]), 0
            for b in data:
                direct = (direct * base + b + 1) % E.P
            assert whole == direct
            cut = rng.randint(0, n)
            a, b = (int(x) for x in E.fingerprints([data[:cut], data[cut:]], base, pw, 8))
            assert E.combine(a, b, n - cut, base) == whole


def test_drop_exact_copies_keeps_columns(spark):
    df = _frame(spark, ROWS)
    kept = E.drop_exact_copies(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 3, 5, 7, 8, 9]


def test_words_give_the_tokenisers_ids():
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = P.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(2)
    pieces = ["a", "Word", " ", "\n", "\t", "é", "é", " ́", "Σ", "ς", "<|endoftext|>", "'s", "12", "ß", "İ", "中", " ", "\x1c", "🙂", "<|", "%%", "  "]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 30))) for _ in range(3000)] + ["x" * 300, ""]
    signs = [chr(i) for i in range(128)]
    texts += ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(3000)] + ["can't WE'LL i'd 'S x's9'T <|endoftext|>it <|ENDOFTEXT|>", "\x0bA\x0c\x1d b\x00c"]
    want = [np.array([*t.encode(x, add_special_tokens=False).ids, 2], "<u4").tobytes() for x in texts]
    assert ids.of(texts) == want
    assert ids.of(texts) == want  # now from the words remembered


def test_differencing_is_balanced_and_complete():
    rng = random.Random(3)
    sizes = [rng.randint(1, 1000) for _ in range(300)]
    sets = P.differencing(sizes, 7)
    assert sorted(i for s in sets for i in s) == list(range(300))
    sums = [sum(sizes[i] for i in s) for s in sets]
    assert max(sums) - min(sums) <= 5
    assert P.windows([], 10) == [] and all(sum([9, 9, 9][i] for i in s) <= 10 for s in P.windows([9, 9, 9], 10))


def test_packing_round_trip(spark):
    rng = random.Random(4)
    texts = {i: " ".join(rng.choice(["alpha", "beta", "gamma", "delta's", "42"]) for _ in range(rng.choice([0, 3, 50, 900, 9000]))) for i in range(60)}
    rows = [*texts.items(), (60, None), (None, "nobody")]
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, start int").repartition(3)
    packed = P.pack_documents(df)
    pieces = packed.collect()
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for i, text in [*texts.items(), (60, "")]:
        mine = sorted((p for p in pieces if p.doc_id == i), key=lambda p: p.start)
        want = [*t.encode(text, add_special_tokens=False).ids, 2]
        assert np.frombuffer(b"".join(bytes(p.ids) for p in mine), "<u4").tolist() == want
        assert all(p.doc_tokens == len(want) for p in mine)
        assert [p.start for p in mine] == [sum(x.length for x in mine[:k]) for k in range(len(mine))]
    windows = {}
    for p in pieces:
        windows.setdefault(p.sequence_id, []).append(p)
    for w in windows.values():
        w.sort(key=lambda p: p.offset)
        assert [p.offset for p in w] == [sum(x.length for x in w[:k]) for k in range(len(w))]
        total = sum(p.length for p in w)
        assert total <= 4096 and {p.padded_to for p in w} == {total if total & (total - 1) == 0 else 4096}
    total = sum(p.length for p in pieces)
    assert len(windows) <= -(-total // 4096) + 2 * 3
    crc = {(r.doc_id, r.start): r.ids_crc32 for r in P.digest(packed).collect()}
    assert crc == {(p.doc_id, p.start): zlib.crc32(bytes(p.ids)) for p in pieces}
    assert P.pack_documents(df.limit(0)).collect() == []
