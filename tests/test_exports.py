"""Layouts of exports against plain Python."""

import random
from collections import defaultdict

from chatloom.operators import exports as E

MESSAGE = "cluster_id long, message_id long, session string, text string"


def _messages(spark):
    rng = random.Random(3)
    rows = [(0 if k % 3 else rng.randrange(1, 6), k, rng.choice([None, *(f"s{i}" for i in range(150))]), rng.choice([None, "", "hi", "é|\n"])) for k in range(900)]
    return rows, spark.createDataFrame(rows, MESSAGE).repartition(5)


def test_parts_of_clusters_hold_every_message_once(spark):
    rows, df = _messages(spark)
    got = E.cluster_layout(df, 50).collect()
    whole = defaultdict(list)
    for r in got:
        assert r.n == len(r.messages) < 120  # about 50, dealt by digest
        whole[r.cluster_id] += [(m.message_id, m.session, m.text) for m in r.messages]
    want = defaultdict(list)
    for c, *m in rows:
        want[c].append(tuple(m))
    assert {c: sorted(m, key=lambda x: x[0]) for c, m in whole.items()} == want
    assert len([r for r in got if r.cluster_id == 0]) == 12
    again = {(r.cluster_id, r.part): r.messages for r in E.cluster_layout(df.repartition(2), 50).collect()}
    assert again == {(r.cluster_id, r.part): r.messages for r in got}


def test_sessions_are_distinct(spark, monkeypatch):
    rows, df = _messages(spark)
    want = defaultdict(set)
    for c, _, s, _ in rows:
        if s is not None:
            want[c].add(s)
    for few in (E.BROADCAST_CLUSTERS, 0):  # sizes by broadcast and by a shuffled join
        monkeypatch.setattr(E, "BROADCAST_CLUSTERS", few)
        whole = defaultdict(list)
        for r in E.session_layout(df, 10).collect():
            whole[r.cluster_id] += r.session_ids
        assert {c: sorted(s) for c, s in whole.items()} == {c: sorted(s) for c, s in want.items()}


def test_totals(spark):
    rows, df = _messages(spark)
    r = E.layout_totals(df, "x.json").first()
    assert (r.source_file, r.clustering_method, r.total_clusters, r.total_messages) == ("x.json", "concern_based", len({x[0] for x in rows}), 900)
    assert r.total_sessions == len({x[2] for x in rows} - {None})
    none = E.layout_totals(spark.createDataFrame([], MESSAGE), "x").first()
    assert (none.total_clusters, none.total_sessions, none.total_messages) == (0, 0, 0)
    assert E.cluster_layout(spark.createDataFrame([], MESSAGE)).count() == 0
    labels = spark.createDataFrame([("a", 9, "regular"), ("b", 2, "low_frequency"), ("a,b", 7, "multi_tag"), ("c", 1, "deleted")], "label string, n long, kind string")
    t = E.categorised_totals(labels, "x", False, 5).first()
    assert (t.clustering_method, t.total_clusters, t.regular_clusters, t.multi_tags_removed, t.labels_deleted, t.total_messages) == ("concern_based", 2, 1, 1, 1, 11)


def test_metadata_frame_fills_gaps(spark):
    clusters = spark.createDataFrame([(0, "Sizes", 7, "sizes"), (1, None, None, "none")], "cluster_id long, title string, messages long, cluster string")
    metrics = spark.createDataFrame([("sizes", 3, 2.5)], "cluster string, sessions long, avg_messages double")
    assert sorted(map(tuple, E.metadata_frame(clusters, metrics, "f").collect())) == [("f", 0, "Sizes", 7, 3, 2.5), ("f", 1, "N/A", 0, 0, 0.0)]


def test_deltas(spark):
    m = spark.createDataFrame([("a", 10.0), ("b", 10.25), ("c", 9.96), ("d", 30.0), ("e", None)], "cluster string, v double")
    assert {r.cluster: r.shown for r in E.deltas(m, "v").collect()} == {"a": "▼ -0.1%", "b": "▲ +0.1%", "c": "▼ -0.2%", "d": "▲ +19.9%", "e": None}
    assert {r.cluster: r["diff"] for r in E.deltas(m, "v", "mean").collect()} == {"a": -5.05, "b": -4.8, "c": -5.09, "d": 14.95, "e": None}
