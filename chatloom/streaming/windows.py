"""Streaming forms of the session reports: watermarks bound the state that late events may still change."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def events_stream(spark: SparkSession, path: str, files_per_trigger: int = 16) -> DataFrame:
    """A folder of Parquet files as a stream, with the schema of the files that are there."""
    schema = spark.read.parquet(path).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def hourly_messages(events: DataFrame, offset_minutes: int = 0, late: str = "1 hour") -> DataFrame:
    """hour (start, local), messages and approximate distinct sessions of each hour; events later than `late` are left out."""
    local = events.withColumn("at", F.col("ts") + F.make_dt_interval(mins=F.lit(offset_minutes)))
    counted = local.withWatermark("at", late).groupBy(F.window("at", "1 hour"))
    made = counted.agg(F.count("*").alias("messages"), F.approx_count_distinct("user_id", 0.01).alias("sessions"))
    return made.select(F.col("window.start").alias("hour"), "messages", "sessions")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """user_id, start, end, messages of each session: events of a user with gaps under `gap`."""
    made = events.withWatermark("ts", late).groupBy("user_id", F.session_window("ts", gap).alias("s")).agg(F.count("*").alias("messages"))
    return made.select("user_id", F.col("s.start").alias("start"), F.col("s.end").alias("end"), "messages")


def first_seen(events: DataFrame, keys: list[str], late: str = "1 hour") -> DataFrame:
    """Events without those that repeat keys within the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


def append_table(df: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Write finished windows as Parquet; a restart goes on from the checkpoint, so no window is written twice."""
    writer = df.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
