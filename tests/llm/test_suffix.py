import random

from chatloom.llm import suffix as S


def _docs(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcé") for _ in range(rng.randint(1, 7)))
    passages = [" ".join(word() for _ in range(rng.randint(10, 80))) for _ in range(12)]
    out = []
    for _ in range(120):
        parts = []
        for _ in range(rng.randint(0, 6)):
            p = rng.choice(passages)
            k = rng.random()
            parts.append(p if k < 0.4 else p[rng.randint(0, 40) :] if k < 0.6 else p[: rng.randint(50, 300)] if k < 0.7 else " ".join(word() for _ in range(rng.randint(1, 60))))
        out.append(rng.choice(("", " ")).join(parts))
    return out + ["a" * 350, "ab" * 200, "a" * 120, "", "x" * 99, "y" * 100, "y" * 100, out[3], out[3]]


def test_matches_brute_force(spark):
    for seed in (1, 2):
        texts = dict(enumerate(_docs(seed)))
        rows = [(i, t, 7) for i, t in texts.items()] + [(1000, None, 7)]
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "doc_id long, text string, tag int").repartition(5)
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.digest(S.cut_repeats(df)).collect()}
        want = S.brute_force(texts | {1000: ""})
        assert {k: (got[k], want[k]) for k in want if got[k] != want[k]} == {}
        assert sum(w[1] for w in want.values()) > 1000


def test_small_blocks_and_segments_change_nothing(spark, monkeypatch):
    texts = dict(enumerate(_docs(3)))
    monkeypatch.setattr(S, "SEGMENT", 150)
    monkeypatch.setattr(S, "BLOCK_FRAGMENTS", 10)
    blobs = [t.encode() for t in texts.values()]
    assert any(len(b) > 400 for b in blobs)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.digest(S.cut_repeats(df)).collect()}
    assert got == S.brute_force(texts)


def test_null_ids_and_empty_table(spark):
    rng = random.Random(4)
    a = "".join(rng.choice("abcdefgh ") for _ in range(200))
    df = spark.createDataFrame([(None, a), (5, a), (5, a)], "doc_id long, text string")
    got = sorted((r.doc_id is not None, r.n_removed) for r in S.digest(S.cut_repeats(df)).collect())
    assert got == [(False, 0), (True, 200), (True, 200)]
    assert S.digest(S.cut_repeats(df.limit(0))).collect() == []


def test_no_block_holds_more_than_its_bound(spark, monkeypatch, tmp_path):
    """A phrase in other surroundings in most documents, with more fragments than a block holds."""
    rng = random.Random(6)
    near = lambda: "".join(rng.choice("abcdefgh ") for _ in range(120))
    phrase, some = "the same phrase of forty bytes, or so it is"[:40], [near() for _ in range(5)]
    texts = {i: near() + (rng.choice(some) if i % 3 else near()[:60]) + phrase + near() for i in range(120)} | {i: near() + rng.choice(some) for i in range(120, 150)}
    solve, sizes = S.repeated_windows, str(tmp_path / "sizes")

    def counted(anchor, *rest):
        with open(sizes, "a") as f:
            f.write(f"{len(anchor)}\n")
        return solve(anchor, *rest)

    monkeypatch.setattr(S, "BLOCK_FRAGMENTS", 20)
    monkeypatch.setattr(S, "repeated_windows", counted)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.digest(S.cut_repeats(df)).collect()}
    assert got == S.brute_force(texts)
    with open(sizes) as f:
        held = [int(x) for x in f]
    assert held and max(held) <= 20
