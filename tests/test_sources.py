"""Readers, writers and streams on small invented inputs."""

import datetime as dt
import json

from chatloom.sources import sinks, tables
from chatloom.streaming import windows


def test_session_documents_of_both_layouts(spark, tmp_path):
    report = [{"s1": {"chat": [{"id": 1, "actor": "customer", "text": "hi"}], "user_field": [{"key_field": "location", "val_field": "Pune"}]}}, {"s2": {"chat": []}}]
    daily = {"s3": {"messages": [{"id": 2, "actor": "AI", "text": "yes"}], "user_fields": [{"key": "location", "value": "Goa"}]}, "s4": {"messages": None}}
    (tmp_path / "a.json").write_text(json.dumps(report))
    (tmp_path / "b.json").write_text(json.dumps(daily).replace("yes", "y\x01es"))
    (tmp_path / "c.json").write_text(json.dumps({"s1": {"chat": [{"id": 9, "actor": "customer", "text": "later"}]}}))
    got = {r.session_id: r for r in tables.session_documents(spark, str(tmp_path)).collect()}
    assert set(got) == {"s1", "s3"}
    assert got["s1"].chat[0].text == "later" and got["s1"].user_field is None
    assert got["s3"].chat[0].text == "yes" and got["s3"].user_field[0].value == "Goa"


def test_missing_vectors(spark):
    texts = spark.createDataFrame([("a",), ("b",), ("c",), ("a",), (None,)], "text string")
    cache = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [1.0]), ("c", None)], "text string, embedding array<double>")
    assert sorted(r.text for r in tables.missing_vectors(texts, cache, 2).collect()) == ["b", "c"]


def test_json_and_markdown(spark, tmp_path):
    df = spark.createDataFrame([(1, "a|b", 2.5), (2, None, 1.0)], "rank int, name string, share double")
    sinks.write_json(df, str(tmp_path / "j"))
    assert sorted(r.rank for r in spark.read.json(str(tmp_path / "j")).collect()) == [1, 2]
    assert json.loads(sinks.as_json(df).where("value like '%null%'").first().value) == {"rank": 2, "name": None, "share": 1.0}
    sinks.write_markdown(df, ["name", "share"], "rank", str(tmp_path / "m"))
    assert [r.value for r in spark.read.text(str(tmp_path / "m")).collect()] == ["| name | share |", "|---|---|", "| a b | 2.5 |", "|  | 1.0 |"]


def test_theme_export(spark):
    rows = spark.createDataFrame([(1, "x"), (1, "x"), (1, "y"), (2, None)], "theme_id int, phrase string")
    got = {r.theme_id: (r.messages, r.phrase_counts) for r in sinks.theme_export(rows).collect()}
    assert got == {1: (3, {"x": 2, "y": 1}), 2: (1, {})}


def test_streams_equal_batches(spark, tmp_path):
    at = lambda h, m: dt.datetime(2024, 1, 1, h, m)
    rows = [(1, at(1, 0), 7), (2, at(1, 10), 7), (3, at(1, 50), 7), (4, at(2, 5), 8), (5, at(9, 0), 9)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long").write.parquet(str(tmp_path / "in"))
    events = windows.events_stream(spark, str(tmp_path / "in"))
    for name, df in (("hours", windows.hourly_messages(events)), ("sessions", windows.sessions(events))):
        windows.append_table(df, str(tmp_path / name), str(tmp_path / f"{name}-c")).awaitTermination()
    hours = {r.hour.hour: r.messages for r in spark.read.parquet(str(tmp_path / "hours")).collect()}
    assert hours == {1: 3, 2: 1}  # the last hour is still open
    found = sorted((r.user_id, r.messages) for r in spark.read.parquet(str(tmp_path / "sessions")).collect())
    assert found == [(7, 1), (7, 2), (8, 1)]
