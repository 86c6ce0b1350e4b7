"""Report metrics over session events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def local_time(ts: str, offset_minutes: int):
    return F.col(ts) + F.make_dt_interval(mins=F.lit(offset_minutes))


def totals(df: DataFrame, session: str) -> DataFrame:
    return df.agg(F.countDistinct(session).alias("sessions"), F.count("*").alias("messages"))


def hourly_sessions(events: DataFrame, session: str, ts: str, offset_minutes: int) -> DataFrame:
    """Distinct sessions for each local hour that has any."""
    return events.groupBy(F.hour(local_time(ts, offset_minutes)).cast("long").alias("hour_of_day")).agg(F.countDistinct(session).alias("sessions"))


def hourly_share(spark: SparkSession, events: DataFrame, session: str, ts: str, offset_minutes: int) -> DataFrame:
    """Distinct sessions for each of the 24 local hours, their share and the hour's rank."""
    counted = hourly_sessions(events, session, ts, offset_minutes).withColumnRenamed("sessions", "n")
    filled = spark.range(24).withColumnRenamed("id", "hour_of_day").join(F.broadcast(counted), "hour_of_day", "left")  # at most 24 rows
    filled = filled.select("hour_of_day", F.coalesce("n", F.lit(0)).cast("long").alias("sessions"))
    total = F.sum("sessions").over(W.partitionBy())
    share = F.round(F.coalesce(F.lit(100.0) * F.col("sessions") / F.nullif(total, F.lit(0)), F.lit(0.0)), 4)
    rank = F.row_number().over(W.orderBy(F.desc("sessions"), "hour_of_day")).cast("long")
    return filled.select("hour_of_day", "sessions", share.alias("share_pct"), rank.alias("peak_rank"))


def bar_scale(hourly: DataFrame) -> DataFrame:
    """Each hour's bar as a share of the highest."""
    return hourly.select("hour_of_day", "sessions", F.round(F.lit(100.0) * F.col("sessions") / F.nullif(F.max("sessions").over(W.partitionBy()), F.lit(0)), 2).alias("bar_pct"))


def after_hours(hourly: DataFrame, opens: int = 10, closes: int = 19) -> DataFrame:
    late = (F.col("hour_of_day") < opens) | (F.col("hour_of_day") >= closes)
    s = F.sum(F.when(late, F.col("sessions")).otherwise(0))
    return hourly.agg(s.alias("after_hours_sessions"), F.round(F.lit(100.0) * s / F.sum("sessions"), 2).alias("after_hours_pct"))


def distribution(df: DataFrame, value: str, threshold: float, top: int) -> DataFrame:
    """Values with at least `threshold` of all rows, the `top` commonest of them, their share of what is shown."""
    counted = df.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("string").alias("value")).agg(F.count("*").alias("n"))
    counted = counted.withColumn("total", F.sum("n").over(W.partitionBy()))  # one row a value
    shown = counted.where(F.col("n") >= threshold * F.col("total")).orderBy(F.desc("n"), "value").limit(top)
    return shown.select("value", "n", F.round(F.lit(100.0) * F.col("n") / F.sum("n").over(W.partitionBy()), 2).alias("pct"))


def cohort(df: DataFrame, value: str, top: int) -> DataFrame:
    """The commonest values and their share of the rows that have one."""
    counted = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("n"))
    counted = counted.select(F.col(value).alias("value"), "n", F.round(F.lit(100.0) * F.col("n") / F.sum("n").over(W.partitionBy()), 1).alias("pct"))
    return counted.orderBy(F.desc("n"), "value").limit(top)


def flag_share(df: DataFrame, flag) -> DataFrame:
    n = F.sum(F.when(flag, 1).otherwise(0))
    yes = F.round(F.coalesce(F.lit(100.0) * n / F.nullif(F.count("*"), F.lit(0)), F.lit(0.0)), 2)
    return df.agg(F.count("*").alias("n"), yes.alias("prompt_pct"), F.round(100 - yes, 2).alias("free_text_pct"))


def savings(df: DataFrame, cost: float = 3.79, per_hour: float = 60.0) -> DataFrame:
    return df.agg(F.round(F.count("*") * F.lit(cost), 2).alias("money_saved"), F.round(F.count("*") / F.lit(per_hour), 2).alias("hours_saved"))


def order_value(df: DataFrame, key: str, value: str, is_order) -> DataFrame:
    """Average order value for each key, 0 without orders."""
    n, v = F.sum(F.when(is_order, 1).otherwise(0)), F.sum(F.when(is_order, F.col(value)).otherwise(0.0))
    return df.groupBy(key).agg(n.alias("orders"), F.round(F.coalesce(F.try_divide(v, n), F.lit(0.0)), 2).alias("aov"))


def top_pages(df: DataFrame, page, session: str, keyword: str, k: int) -> DataFrame:
    """The k pages with most distinct sessions among those that contain the keyword."""
    return df.withColumn("page", page).where(F.lower("page").contains(keyword.lower())).groupBy("page").agg(F.countDistinct(session).alias("sessions")).orderBy(F.desc("sessions"), "page").limit(k)
