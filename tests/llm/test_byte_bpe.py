import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from chatloom.llm import byte_bpe as B

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def known():
    return B.Vocabulary(PATH, public_tokenizers.PATTERN)


def _want(library, text):
    ids = library.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_the_perfect_hash_is_minimal():
    keys = [b"%d" % i for i in range(5000)]
    h = B.hashes(keys)
    index = B.PerfectHash(h)
    assert sorted(index.numbers(h).tolist()) == list(range(5000))
    other = index.numbers(B.hashes([b"x%d" % i for i in range(5000)]))
    assert other.min() >= -1 and other.max() < 5000
    assert B.PerfectHash(np.zeros(0, np.uint64)).numbers(h[:3]).tolist() == [-1, -1, -1]


def test_ids_are_the_librarys(known, library):
    rng = random.Random(3)
    kinds = ["abc ", " \n\t\r", "0123456789", "'st'll've", "äöüß éà", "日本語中文 ", "ёжик ", "हिंदी ", "🙂👍🏽‍", "!?.,-", "  　\u0085\x1c\x1f", "՘꟎\U00010940\U000323b1\U0003d000", "ʻʼ²½Ⅷ٣", "퟿�\x00\x7f"]
    for _ in range(3000):
        text = "".join(rng.choice(rng.choice(kinds)) for _ in range(rng.randint(0, 60)))
        ids = np.frombuffer(known.encode([text])[0], "<u4").tolist()
        assert ids == library.encode_ordinary(text), ascii(text)
        assert known.decode(np.array(ids, np.int64), np.array([len(ids)]))[0].tobytes() == text.encode()


def test_classes_of_signs_are_the_librarys():
    """Pairs of a letter, digit or sign with each contested or Asian and European code point are one piece for both or for neither."""
    ranks = {bytes([i]): i for i in range(256)}
    for a in b"a1!":
        for b in range(256):
            ranks[bytes([a, b])] = len(ranks)
    probe, split = tiktoken.Encoding("probe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), B.splitter(public_tokenizers.PATTERN)
    edges = [int(x, 16) + d for r in B.NEWER for x in r.split("-") for d in (-1, 0, 1)]
    for o in [*range(0x3100), *edges, *range(0xA000, 0x12000, 7)]:
        if not 0xD800 <= o < 0xE000:
            for a in "a1!":
                assert (probe.encode_ordinary(a + chr(o))[0] > 255) == (len(split(a + chr(o))) == 1), (a, hex(o))


def test_long_pieces_and_ties(known, library):
    for text in ("a" * 20_000, "ab" * 3000 + "c", "=" * 5001, " " * 777, "é" * 3000, "x" * 47 + "y" * 49):
        assert np.frombuffer(known.encode([text])[0], "<u4").tolist() == library.encode_ordinary(text)


ROWS = [(1, "Hello world, it's 2024!"), (2, None), (3, ""), (None, "null id"), (1, "Hello world, it's 2024!"), (5, "ü" * 700_000 + " end"), (6, "\n\n  x"), (7, "🙂 ՘a")]


def test_rows_of_odd_cases(spark, library):
    df = spark.createDataFrame([(i, t, [9], b"x", 1) for i, t in ROWS], "doc_id long, text string, ids array<int>, decoded binary, n_tokens int")
    got = sorted((tuple(r) for r in B.digest(B.decode(B.encode(df))).collect()), key=repr)
    assert got == sorted(((i, *_want(library, t)) for i, t in ROWS), key=repr)
    assert B.digest(B.decode(B.encode(df.limit(0)))).collect() == []


def test_decoding_takes_any_ids(spark):
    df = spark.createDataFrame([(1, [0, 1, None, 255]), (2, None), (3, [])], "doc_id long, ids array<int>")
    out = {r.doc_id: bytes(r.decoded) for r in B.decode(df).collect()}
    v = B.Vocabulary(PATH, public_tokenizers.PATTERN)
    single = {r: t for t, r in v.ranks.items()}
    assert out == {1: single[0] + single[1] + single[255], 2: b"", 3: b""}


def test_query_equals_the_library(spark, sf, library):
    from chatloom.llm.queries import queries

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries()["op13_byte_bpe"](spark, sf).collect()}
    assert got == {i: _want(library, t) for i, t in texts.items()}
