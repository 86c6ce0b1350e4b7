"""Events fed day by day, out of order and twice, against one batch over all."""

import pytest
from pyspark.sql import functions as F

from chatloom.streaming.upserts import Upserts


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_days_out_of_order_and_twice(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet").select(F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("k"), F.to_date("ts").alias("day"), "ts", "event_id", "value", "props")
    days = [r.day for r in events.select("day").distinct().orderBy("day").collect()][:6]
    some = events.where(F.col("day") <= days[-1])
    want = _rows(some.groupBy("k").agg(F.max(F.struct("ts", "event_id", "day", "value", "props")).alias("r")).select("k", "r.day", "r.ts", "r.event_id", "r.value", "r.props"))
    store = Upserts(spark, str(tmp_path / "a"), ["k"], ["ts", "event_id"], 5)
    for i in (3, 0, 5, 1, 0, 4, 2, 3):
        fresh = str(days[i]) not in store.manifest()["batches"]
        assert store.apply(some.where(F.col("day") == days[i]), str(days[i])) == fresh
    assert _rows(store.table()) == want
    assert store.manifest()["number"] == 6


def test_what_dies_half_way_is_not_seen(spark, tmp_path, monkeypatch):
    store = Upserts(spark, str(tmp_path / "b"), ["k"], ["n"], 3)
    df = lambda *rows: spark.createDataFrame(list(rows), "k string, n long, v string")
    assert store.table() is None
    assert store.apply(df(("a", 1, "x"), ("b", 1, "y"), ("a", 1, "z"), (None, 1, "null key")), 0)
    with monkeypatch.context() as m:
        m.setattr(store, "_commit", lambda state: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            store.apply(df(("a", 9, "never")), 1)
    assert _rows(store.table()) == sorted([("a", 1, "z"), ("b", 1, "y"), (None, 1, "null key")], key=repr)
    assert store.apply(df(("a", 0, "older"), ("c", 2, None)), 1) and not store.apply(df(("a", 99, "replayed")), 1)
    assert store.apply(df().limit(0), 2)
    assert _rows(store.table()) == sorted([("a", 1, "z"), ("b", 1, "y"), ("c", 2, None), (None, 1, "null key")], key=repr)


def test_a_stream_feeds_the_table(spark, sf, tmp_path):
    source = str(tmp_path / "in")
    spark.read.parquet(f"{sf}/events.parquet").select("user_id", "event_id", "event_type").repartition(4).write.parquet(source)
    store = Upserts(spark, str(tmp_path / "c"), ["user_id"], ["event_id"], 4)
    stream = spark.readStream.schema("user_id long, event_id long, event_type string").option("maxFilesPerTrigger", 2).parquet(source)
    stream.writeStream.foreachBatch(lambda df, n: store.apply(df, n) and None).option("checkpointLocation", str(tmp_path / "c-state")).trigger(availableNow=True).start().awaitTermination()
    want = spark.read.parquet(source).groupBy("user_id").agg(F.max(F.struct("event_id", "event_type")).alias("r")).select("user_id", "r.event_id", "r.event_type")
    assert _rows(store.table()) == _rows(want) and store.manifest()["number"] == 2
