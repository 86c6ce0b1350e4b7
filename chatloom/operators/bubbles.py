"""Suggested messages ("bubbles"): texts that many sessions send word for word."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chatloom.functions.text import word_count


def candidates(messages: DataFrame, text: str, least: int, words: int = 3) -> DataFrame:
    return messages.groupBy(text).agg(F.count("*").alias("clicks")).where((F.col("clicks") >= least) & (word_count(F.col(text)) >= words))


def without(messages: DataFrame, found: DataFrame, text: str) -> DataFrame:
    return messages.join(found.select(text), text, "left_anti")


def first_of_session(messages: DataFrame, session: str, text: str, pos: str) -> DataFrame:
    """The first time that each session sends each text."""
    w = W.partitionBy(session, text).orderBy(pos)
    return messages.withColumn("nth", F.row_number().over(w)).where("nth = 1").drop("nth")


def messages_after(messages: DataFrame, session: str, pos: str) -> DataFrame:
    return messages.withColumn("msgs_after", F.max(pos).over(W.partitionBy(session)) - F.col(pos))


def stats(messages: DataFrame, least: int = 7) -> DataFrame:
    """For each bubble: clicks, share of clicks, mean place, mean messages after it, shares of sessions with cart and order. Columns
    session, text, pos, did_a2c, order_placed."""
    rows = messages_after(messages, "session", "pos").join(candidates(messages, "text", least), "text", "left_semi")
    once = first_of_session(rows, "session", "text", "pos")
    out = once.groupBy("text").agg(
        F.count("*").alias("clicks"), F.round(F.avg("pos"), 4).alias("avg_click_position"), F.round(F.avg("msgs_after"), 4).alias("avg_msgs_after_click"),
        F.round(100 * F.avg(F.col("did_a2c").cast("double")), 4).alias("did_a2c_pct"), F.round(100 * F.avg(F.col("order_placed").cast("double")), 4).alias("placed_order_pct"),
    )
    return out.withColumn("clicks_pct", F.round(F.lit(100.0) * F.col("clicks") / F.sum("clicks").over(W.partitionBy()), 4))
