"""A round of the projection sends a position to a party of blocks once, and edges without positions."""

from chatloom.operators import projection as P


def test_a_party_gets_each_place_once(spark):
    blocks = spark.createDataFrame([(1, 5, 7), (2, 6, 7), (3, 8, 8), (4, 9, 9)], "id long, block long, party long")
    held = spark.createDataFrame([(7, 5, 1, [2, 3]), (7, 6, 2, [1, 3]), (8, 8, 3, [1, 2]), (9, 9, 4, [3])], "party long, block long, a long, b array<long>")
    got = sorted((r.party, r.block, r.id) for r in P.seated(blocks, held).collect())
    assert got == [(7, -1, 3), (7, 5, 1), (7, 6, 2), (8, -1, 1), (8, -1, 2), (8, 8, 3), (9, -1, 3), (9, 9, 4)]
