"""Events read day by day through the data source, against a direct scan; days that fail."""

import datetime
import os

import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from chatloom.sources.days import days_failed, read_days


def _fetcher(path, folder, failures):
    """failures: how often a day fails before it works; every call leaves a file."""

    def fetch(day):
        n = sum(f.startswith(str(day)) for f in os.listdir(folder))
        open(f"{folder}/{day}-{n}", "w").close()
        if n < failures.get(day, 0):
            raise ConnectionError(f"try {n}")
        t = pq.read_table(path, columns=["event_id", "ts", "event_type"])
        return t.filter(pc.equal(pc.cast(t["ts"], "date32"), day)).select(["event_id", "event_type"]).to_batches()

    return fetch


def test_days_equal_a_direct_scan(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet").withColumn("day", F.to_date("ts"))
    days = [r.day for r in events.select("day").distinct().orderBy("day").collect()]
    first, last = days[0], days[0] + datetime.timedelta(days=9)
    broken = {first: 2, first + datetime.timedelta(days=3): 99}
    rows = read_days(spark, _fetcher(f"{sf}/events.parquet", str(tmp_path), broken), "event_id long, event_type string", first, last, tries=3, wait=0.01)
    got = sorted((r.day, r.event_id, r.event_type) for r in rows.where("error is null").collect())
    lost = first + datetime.timedelta(days=3)
    assert got == sorted((r.day, r.event_id, r.event_type) for r in events.where(F.col("day").between(first, last) & (F.col("day") != lost)).collect())
    assert [(r.day, r.error) for r in days_failed(rows).collect()] == [(lost, "ConnectionError: try 5")]  # three tries in each of two reads


def test_only_wanted_days_are_asked_for(spark, sf, tmp_path):
    first = datetime.date(2024, 1, 1)
    rows = read_days(spark, _fetcher(f"{sf}/events.parquet", str(tmp_path), {}), "event_id long, event_type string", first, first + datetime.timedelta(days=400))
    rows.where((F.col("day") > F.lit(first)) & (F.col("day") <= F.lit(first + datetime.timedelta(days=2)))).collect()
    assert {f[:10] for f in os.listdir(tmp_path)} == {"2024-01-02", "2024-01-03"}
