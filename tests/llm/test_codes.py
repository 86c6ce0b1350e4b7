import hashlib
import math
import random

import duckdb
import numpy as np

from chatloom.llm import codes as C
from chatloom.llm.queries import oracle_sql, queries

SCHEMA = "vec_id long, embedding array<float>, label int, code int, error string, v double"


def _brute(rows, parts=8, entries=16, rounds=6):
    """Rows (vec_id, vector, label) of equal lengths, plain Python integers."""
    kept = [(i, [math.floor(4096 * float(np.float32(x))) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max(1, -(-max((len(v) for _, v, _ in kept), default=0) // parts)) * parts
    kept = [(i, v + [0] * (width - len(v)), label) for i, v, label in kept]
    w = width // parts
    cut = lambda v: [v[p * w : p * w + w] for p in range(parts)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    books = [[cut(v)[p] for _, v, _ in kept[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    best = lambda x, p: min((far(x, c), e) for e, c in enumerate(books[p]))
    for _ in range(rounds):
        new = [list(b) for b in books]
        for p in range(parts):
            at = [best(cut(v)[p], p)[1] for _, v, _ in kept]
            for e in set(at):
                own = [cut(v)[p] for (_, v, _), a in zip(kept, at, strict=True) if a == e]
                new[p][e] = [sum(c) // len(own) for c in zip(*own, strict=True)]
        books = new
    out = []
    for i, v, label in kept:
        found = [best(x, p) for p, x in enumerate(cut(v))]
        out.append((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), label))
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return [(i, c, d, sum(e for _, _, e, m in out if m == label), digest) for i, c, d, label in out]


def _rows(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, "x", 2.0) for i, v, label in rows], SCHEMA)


def _got(spark, rows):
    coded, books = C.compress(_rows(spark, rows))
    return sorted((tuple(r) for r in C.digest(coded, books).collect()), key=repr)


def test_codes_match_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range(24)], rng.choice([None, 1, 2, 3])) for i in range(70)]
    rows += [(100 + i, rows[3][1], 7) for i in range(40)]  # a common vector
    rows += [(200, None, 1), (201, [None] + [0.5] * 23, 1), (202, [float("nan")] * 24, 1), (203, [float("inf")] + [0.0] * 23, 2), (None, [0.25] * 24, None), (5, rows[9][1], 2)]
    assert _got(spark, rows) == sorted(_brute(rows), key=repr)


def test_odd_lengths_few_rows_and_none(spark):
    for rows in ([(3, [1.0, -1.5], 1), (1, [], None), (2, [0.1] * 11, 1)], [(9, [2.5] * 8, None)]):
        assert _got(spark, rows) == sorted(_brute(rows), key=repr)
    assert _got(spark, [(1, None, 1)]) == []
    coded, books = C.compress(_rows(spark, []))
    assert coded.collect() == [] and books.shape[1] == 0


def test_huge_components_count_as_the_bound(spark):
    rows = [(1, [3e38] * 8, 1), (2, [-3e38] * 8, 1), (3, [0.0] * 8, 2)]
    coded, books = C.compress(_rows(spark, rows), entries=1, rounds=0)
    most = min(1 << 30, math.isqrt(((1 << 61) - 1) // 8))
    assert {r.vec_id: r.error for r in coded.collect()} == {1: 0, 2: 8 * (2 * most) ** 2, 3: 8 * most**2}


def test_filtered_distances_are_exact():
    rng = np.random.default_rng(2)
    for spread in (3, 5000, 1 << 27):
        books, x = rng.integers(-spread, spread, (8, 16, 8)), rng.integers(-spread, spread, (500, 8, 8))
        x[::3] = books.transpose(1, 0, 2)[rng.integers(0, 16, len(x[::3]))] + rng.integers(-1, 2, (len(x[::3]), 8, 8))
        books[:, 5] = books[:, 2]  # ties go to the lower index
        nearest = C.Nearest(books)
        index, far = nearest(x)
        every = ((x[:, :, None] - books[None]) ** 2).sum(3)
        assert (far == every.min(2)).all() and (index == every.argmin(2)).all()
        assert (np.diff(nearest.counted) <= 0).all() and nearest.counted[-1] < nearest.counted[0]


def test_codes_decode_to_their_entries(spark):
    rows = [(i, [float(i % 5), 1.0, 2.0, -1.0] * 4, 1) for i in range(30)]
    coded, books = C.compress(_rows(spark, rows))
    back = {r.vec_id: (r.v, r.error) for r in C.decoded(coded, books).collect()}
    for i, v, _ in rows:
        assert sum((4096 * int(x) - y) ** 2 for x, y in zip(v, back[i][0], strict=True)) == back[i][1]


def test_query_equals_its_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    want = con.execute(oracle_sql()["op12_code_compression"])
    columns = [c[0] for c in want.description]
    got = queries()["op12_code_compression"](spark, sf).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())
