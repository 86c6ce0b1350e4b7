"""The plan of op5's index stays small: its masks are constants, and its values are those of plain Python."""

import itertools
import random

from pyspark.sql import functions as F

from chatloom.llm import decontam as D


def test_masks_are_constants_and_values_are_whole(spark):
    assert str(D.near_block_values(F.col("s"))).count("struct(") <= 2 * D.BLOCKS
    rng = random.Random(3)
    sims = [0, -1, -(1 << 63), (1 << 63) - 1, *(rng.randrange(-(1 << 63), 1 << 63) for _ in range(20))]
    got = spark.createDataFrame([(s,) for s in sims], "s long").select("s", D.near_block_values(F.col("s")).alias("v")).collect()
    for r in got:
        want = []
        for k, (a, b) in enumerate(itertools.pairwise(D._EDGES)):
            value = ((r.s & ((1 << 64) - 1)) >> a) & ((1 << (b - a)) - 1)
            want += [(k, value ^ sum(1 << x for x in c)) for n in range(D.FLIPS + 1) for c in itertools.combinations(range(b - a), n)]
        assert [tuple(x) for x in r.v] == want


def test_simhash_sets_bits_of_more_than_half_the_weight(spark):
    rng = random.Random(4)
    rows = [(k, rng.randrange(-(1 << 63), 1 << 63), rng.randint(1, 2000)) for k in range(30) for _ in range(rng.randint(1, 9))]
    rows += [(30, -1, 5), (30, 0, 5), (31, -(1 << 63), 1)]
    got = {r.k: (r.total, r.sim & ((1 << 64) - 1)) for r in D.simhash(spark.createDataFrame(rows, "k long, h long, weight long"), ["k"]).collect()}
    for k in range(32):
        own = [(h, w) for i, h, w in rows if i == k]
        sim = sum(1 << b for b in range(64) if sum(w if h >> b & 1 else -w for h, w in own) > 0)
        assert got[k] == (sum(w for _, w in own), sim)
