"""Arrow batches while tables are written, and groups that go over their edges."""

import random

import pyarrow as pa
from pyspark.sql import functions as F

from chatloom.llm import common as K
from chatloom.llm import minhash as M
from chatloom.llm import packing as P


def test_batches_are_small_only_while_a_table_is_written(spark, monkeypatch):
    monkeypatch.setattr(K, "BATCH_BYTES", 1 << 16)
    before = spark.conf.get(K._BATCH, None)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    rows = spark.range(4000).select(F.repeat(F.lit("x"), 500).alias("text")).coalesce(1)
    got = [r.n for r in K.materialize(rows.mapInArrow(sizes, "n long"), "sizes").collect()]
    assert len(got) > 10 and max(got) < 1 << 18
    assert spark.conf.get(K._BATCH, None) == before


def test_groups_over_edges_of_batches(spark, monkeypatch):
    monkeypatch.setattr(K, "BATCH_BYTES", 1 << 12)
    monkeypatch.setattr(M, "GROUP_ROWS", 7)
    rng = random.Random(2)
    sizes = [rng.choice([1, 2, 3, 50, 300]) for _ in range(60)]
    rows = [(g, bytes([k % 256, k // 256]), b"v" * 40) for g, n in enumerate(sizes) for k in range(n)]
    rng.shuffle(rows)
    table = spark.createDataFrame(rows, "g long, node binary, v binary")
    got = K.materialize(M._grouped(table, ["g"], lambda x: [(x["g"][0], len(x["g"]))], "g long, n long"), "groups").collect()
    assert sorted((r.g, r.n) for r in got) == list(enumerate(sizes))


def test_packing_with_few_remembered_words_gives_equal_rows(spark):
    rng = random.Random(5)
    texts = [None, "", *(" ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randrange(1, 400))) for _ in range(60))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    few, many = (sorted(map(tuple, P.digest(P.pack_documents(docs, remembered=n)).collect())) for n in (10, None))
    assert few == many and len({r[0] for r in few}) == len(texts)
