"""The learned part of personal data: the field against enumeration, and what it finds beside the base spans."""

import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest

from chatloom.llm import pii as S


@pytest.fixture(scope="module")
def field():
    rng = random.Random(5)
    texts = [f"write to user{k}@mail{k}.example.org or +49 30 {rng.randint(10**6, 10**7 - 1)} from 10.0.{k % 250}.7 page {k}, {k} of 12 in 19{k:02}" for k in range(60)]
    return S.train(texts)


def _labellings(n, segments):
    """All ways to cut n tokens into single tokens and labelled segments."""
    by = {}
    for k, (i, j) in enumerate(segments):
        by.setdefault(i, []).append((k, j))

    def rest(i):
        if i == n:
            yield ()
            return
        yield from rest(i + 1)
        for k, j in by.get(i, ()):
            for kind in range(len(S.ALL_KINDS)):
                for more in rest(j):
                    yield ((k, kind), *more)

    return list(rest(0))


@pytest.mark.parametrize("text", ["ab 12.34 x", "key=12345", "a@b.cd 12", "(123) 4-5", "token: abcdefghij"])
def test_decoder_and_gradient_equal_enumeration(text):
    rng = np.random.default_rng(len(text))
    field = S.Field(rng.normal(0, 0.5, (S.N_FEATURES, len(S.ALL_KINDS))))
    stretches = list(S.zones(text))
    c = S.Candidates(text, *S.tokens_of(text, stretches))
    first, end, x = c.all
    v = field.weights[x].sum(1)
    every = _labellings(len(c.starts), list(zip(first.tolist(), end.tolist(), strict=True)))
    scores = np.array([sum(v[k, kind] for k, kind in lab) for lab in every])
    name = lambda lab: [(S.ALL_KINDS[kind], int(c.starts[first[k]]), int(c.ends[end[k] - 1])) for k, kind in lab]
    assert len(every) > 1 and field.decode(text, stretches) == name(every[int(scores.argmax())])
    p = np.exp(scores - np.logaddexp.reduce(scores))
    for place in {0, len(every) // 2, len(every) - 1}:
        want = np.zeros_like(v)
        for lab, q in zip(every, p, strict=True):
            for k, kind in lab:
                want[k, kind] -= q
        for k, kind in every[place]:
            want[k, kind] += 1
        likelihood, _, got = field.gradient(c, set(name(every[place])))
        assert np.allclose(got, want, atol=1e-9) and likelihood == pytest.approx(np.log(p[place]))


def test_blocks_change_nothing(field, monkeypatch):
    """An entity is found wherever it lies in a long zone."""
    texts = ["12 " * k + "0049 123 456789 and (123) 456-7890 x" for k in itertools.chain(range(3, 12), range(40, 52), (95, 96, 97))]
    whole = [S.find(t, field) for t in texts]
    assert all(sum(k == "phone" for k, _, _ in found) == 2 for _, found in whole)
    for block in (1, 7, 30):
        monkeypatch.setattr(S, "BLOCK", block)
        assert [S.find(t, field) for t in texts] == whole


def test_more_real_lessons_than_the_bound_leave_the_synthetic_ones():
    rng = random.Random(2)
    texts = [" and ".join(f"{rng.randint(1000, 9999)} or u{k}@m{k}.example.org" for k in range(20)) for _ in range(200)]
    made = len(S.lessons([]))
    assert len(S.lessons(texts)) == S.REAL_LESSONS + made and len(S.lessons(texts[:2])) < 100 + made
    field = S.train(texts)
    key = "".join(rng.choice("0123456789abcdef") for _ in range(40))
    assert S.find(f'see token = "{key}" there', field)[1] == [("secret", 13, 53)]


def test_secrets_of_any_length_and_letters_after_a_cue(field):
    rng = random.Random(9)
    for n in (32, 40, 130, 200, 400, 5000):
        key = "".join(rng.choice("0123456789abcdef") for _ in range(n))
        assert S.find(f'mail a@b.cd, token = "{key}" end', field)[1] == [("email", 5, 11), ("secret", 22, 22 + n)]
    assert S.find("password = correcthorsebatterystapleabcde and", field)[1] == [("secret", 11, 41)]
    assert S.find("correcthorsebatterystapleabcde and other words", field)[1] == []


def test_phones_in_parentheses_and_other_spellings(field):
    assert S.find("(123) 456-7890", field)[1] == [("phone", 0, 14)]
    assert S.find("call (123) 456-7890 now", field)[1] == [("phone", 5, 19)]
    assert S.find("host 20fe:0db8:85a3:0a00:0b00:8a2e:0370:7334 up", field)[1] == [("ip", 5, 44)]


def test_harmless_text_stays(field):
    for t in ("a1.b2.c3.d4." * 6, "no. 4111 1111 1111 1112 here", "in 1999 we saw 12 birds", "on 2024-01-15 at 12:30:45", "key: something else", "v1.2.3 of 4711"):
        assert S.find(t, field) == ([], []), t


def test_held_out_precision_and_recall_by_kind(field):
    found, right, gold_of = Counter(), Counter(), Counter()
    for text, gold in S.synthetic(seed=1234, lines=2000):
        added = set(S.find(text, field)[1]) - set(S.base_spans(text))
        found.update(k for k, _, _ in added)
        right.update(k for k, _, _ in added & gold)
        gold_of.update(k for k, _, _ in gold - set(S.base_spans(text)))
    for kind in ("secret", "phone", "ip"):
        assert right[kind] >= 0.95 * found[kind] > 0, kind
        assert right[kind] >= 0.88 * gold_of[kind], kind


def test_added_spans_overlap_nothing(field):
    rng = random.Random(8)
    parts = ["+1 555 010 9999", "a@b.cd", "10.0.0.1", "4111 1111 1111 1111", 'token="' + "0af3" * 10 + '"', "(123) 456-7890", "12", "words", "x1y2"]
    for _ in range(60):
        text = " ".join(rng.choice(parts) for _ in range(rng.randint(1, 150)))
        base, found = S.find(text, field)
        assert set(base) <= set(found)
        taken = [(s, e) for _, s, e in base]
        for _, s, e in sorted(set(found) - set(base), key=lambda x: x[1]):
            assert all(e <= a or b <= s for a, b in taken)
            taken.append((s, e))


def test_sample_is_bounded_for_repeated_rows(spark):
    rows = [(1, f"call +1 555 010 9999 or {'9' * 20}")] * 3000
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = S.find_personal_data(df, S.learn(df, train_docs=10))
    assert found.where("n_phone = 1").count() == 3000


def test_long_texts_are_searched_whole(field):
    text = "a1b2" * 200_000 + " password = correcthorsebatterystapleabcde " + "word " * 200_000 + "(123) 456-7890"
    found = {k for k, _, _ in S.find(text, field)[1]}
    assert {"secret", "phone"} <= found and len(re.findall(" ", text)) > 200_000
