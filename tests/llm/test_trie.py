import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest

from chatloom.llm import trie as T
from chatloom.llm.queries import queries

SCHEMA = "conv_id long, turn long, role string, text string, depth string, f int, conv double"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}
    made = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        host = c - (c % 5 if c >= 0 else -(-c % 5))
        made[c] = tuple(convs.get(host, [])[:h] + own[h:])
    nodes = {}
    for c, ts in made.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(ts[:d], []).append(c)
    children = {}
    for key in nodes:
        if key:
            children.setdefault(key[:-1], []).append(key)
    leaves, saved = {}, {}
    for key in sorted(nodes, key=len, reverse=True):
        below = children.get(key, [])
        leaves[key] = sum(leaves[k] for k in below) if below else 1
        saved[key] = (len(nodes[key]) - 1) * (len(key[-1][1].encode()) if key else 0) + sum(saved[k] for k in below)
    digest = lambda key: hashlib.sha256(",".join(map(str, sorted(c for c in nodes[key] if made[c] == key))).encode()).hexdigest()
    return sorted(((min(nodes[k]), len(k), min(nodes[k[:-1]]) if k else None, len(nodes[k]), len(children.get(k, [])), leaves[k], saved[k], digest(k)) for k in nodes), key=repr)


def _got(spark, rows, spread=T.P):
    df = spark.createDataFrame([(*r, "x", 1, 2.0) for r in rows], SCHEMA)
    return sorted((tuple(r) for r in T.prefix_trie(df, spread).select(*COLUMNS).collect()), key=repr)


def _some(seed, n=60):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-20, 400), n):
        for t in range(rng.randint(1, 9)):
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "bot", None]), rng.choice(["hi", "ok", "é", "", None])))
    return rows


ODD = [(None, 1, "user", "no conversation"), (5, None, None, None), (5, None, None, None), (5, 3, "user", "x" * 100_000), (6, 3, "user", "a"), (6, 3, "bot", "a"), (7, 0, "ab", "c"), (8, 0, "a", "bc"), (2**40, 1, "user", "far")]


@pytest.mark.parametrize("spread", [T.P, 2, 1])
def test_nodes_match_brute_force(spark, spread):
    """1: all, 2: nearly all fingerprints of a depth collide, so turns decide."""
    rows = _some(1) + ODD
    assert _got(spark, rows, spread) == _brute(rows)


def test_copies_and_a_long_conversation(spark):
    rows = [(10 * c, t, "user", f"turn {t}") for c in range(40) for t in range(12)]  # copies
    rows += [(1001, t, "user", f"{t % 7}") for t in range(700)] + [(1000, t, "user", f"{t % 7}") for t in range(650)]
    assert _got(spark, rows) == _brute(rows)


def test_blocks_of_ids_and_none(spark, monkeypatch):
    monkeypatch.setattr(T, "BLOCK", 3)
    rows = [(5 * c, 0, "user", "same") for c in range(50)]
    assert _got(spark, rows) == _brute(rows)
    assert _got(spark, []) == []
    assert _got(spark, [(None, 1, "user", "a")]) == []


def test_scans_go_on_over_batches_and_partitions():
    rng = np.random.default_rng(1)
    keys = np.repeat([3, 4, 4, 9, 2], [5, 40, 1, 200, 3])
    values = rng.integers(0, T.P, len(keys))
    want = {}
    for k, v in zip(keys.tolist(), values.tolist(), strict=True):
        n, s = want.get(k, [(0, 0)])[-1]
        want.setdefault(k, [(0, 0)]).append((n + 1, (s + v * pow(T.BASES[0], n + 1, T.P)) % T.P))
    flat = [x for k in (3, 4, 9, 2) for x in want[k][1:]]
    for cuts in ([], [5], [1, 2, 47, 100, 101, 248]):
        scan, got = T.Scan(T.BASES[:1]), []
        for a, b in zip([0, *cuts], [*cuts, len(keys)], strict=True):  # batches of one task
            place, (s,), _ = scan(keys[a:b], [values[a:b]])
            got += zip(place.tolist(), s.tolist(), strict=True)
        assert got == flat
        edges, parts = [], []
        for n, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(keys)], strict=True)):  # tasks
            place, (s,), run = T.Scan(T.BASES[:1])(keys[a:b], [values[a:b]])
            ends = [{"key": int(keys[a + i]), "place": int(place[i]), "run": int(run[i]), "s0": int(s[i])} for i in (np.flatnonzero(run == 0)[-1], -1)]
            edges.append({"part": n, "first": ends[0], "last": {**ends[1], "key": int(keys[b - 1])}})
            parts.append((place, s, run))
        carry = {c[0]: c[1:] for c in T.carries(edges, T.BASES[:1])}
        got = []
        for n, (place, s, run) in enumerate(parts):
            n0, c, f = carry.get(n, (0, 0, 1))
            got += [(p + n0, (c + f * x) % T.P) if r == 0 else (p, x) for p, x, r in zip(place.tolist(), s.tolist(), run.tolist(), strict=True)]
        assert got == flat


def test_query_equals_its_sql_and_brute_force(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    got = sorted((tuple(r) for r in queries()["op11_prefix_trie"](spark, sf).select(*COLUMNS).collect()), key=repr)
    want = con.execute(T.ORACLE)
    at = [[c[0] for c in want.description].index(c) for c in COLUMNS]
    assert got == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=repr)
    assert got == _brute(con.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall())
