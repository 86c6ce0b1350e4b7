"""Clusters of sessions: counts, conversion, bands, merges, names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def concern_clusters(df: DataFrame, key: str, session: str) -> DataFrame:
    """Clusters by lower-cased key: title is the commonest spelling (ties: alphabetical), numbered from 0 by falling count."""
    spelled = df.groupBy(F.lower(key).alias("concern"), F.col(key).alias("spelling")).agg(F.count("*").alias("n"))
    title = spelled.groupBy("concern").agg(F.sum("n").cast("long").alias("messages"), F.min_by("spelling", F.struct((-F.col("n")).alias("n"), "spelling")).alias("title"))
    sessions = df.groupBy(F.lower(key).alias("concern")).agg(F.countDistinct(session).alias("sessions"))
    out = title.join(sessions, "concern")
    return out.withColumn("cluster_id", (F.row_number().over(W.orderBy(F.desc("messages"), "concern")) - 1).cast("long"))  # one row a cluster


def metrics(df: DataFrame) -> DataFrame:
    """Of columns cluster, session, messages, did_a2c, order_placed, utm: distinct sessions, mean messages, counts and shares."""
    one = df.groupBy("cluster", "session").agg(F.max("messages").alias("messages"), *(F.max(c).alias(c) for c in ("did_a2c", "order_placed", "utm")))
    n = F.count("*")
    out = [n.alias("sessions"), F.round(F.avg("messages"), 2).alias("avg_messages")]
    for c in ("did_a2c", "order_placed", "utm"):
        s = F.sum(c).cast("long")
        out += [s.alias(f"{c}_sessions"), F.round(F.lit(100.0) * s / n, 2).alias(f"{c}_pct")]
    return one.groupBy("cluster").agg(*out)


def atomic_labels(df: DataFrame, labels: str) -> DataFrame:
    return df.select(F.explode(labels).alias("label")).groupBy("label").agg(F.count("*").alias("n"))


def median_bands(m: DataFrame, names: tuple[str, ...] = ("did_a2c_pct", "order_placed_pct", "utm_pct"), only=None) -> DataFrame:
    """One row: p25, median and p75 of each share over the clusters where `only` holds, over all if there are none, and 0 without clusters."""
    only = F.lit(True) if only is None else F.coalesce(only, F.lit(False))
    out = []
    for c in names:
        for label, p in (("p25", 0.25), ("median", 0.5), ("p75", 0.75)):
            some, every = F.percentile(F.when(only, F.col(c)), F.lit(p)), F.percentile(c, F.lit(p))
            out.append(F.round(F.coalesce(some, every, F.lit(0.0)), 2).alias(f"{c}_{label}"))
    return m.agg(*out)


def banded(m: DataFrame, value: str, sessions_least: int = 25, volume_least: float = 2.5) -> DataFrame:
    """poor up to p25, good from p75, else average; share of all sessions, and whether a cluster is large enough to show."""
    cut = F.broadcast(m.agg(F.percentile(value, F.lit(0.25)).alias("low"), F.percentile(value, F.lit(0.75)).alias("high"), F.sum("sessions").alias("all")))  # one row
    out = m.join(cut, F.lit(True))
    volume = F.lit(100.0) * F.col("sessions") / F.col("all")
    band = F.when(F.col(value) <= F.col("low"), "poor").when(F.col(value) >= F.col("high"), "good").otherwise("average")
    return out.select("cluster", value, band.alias("band"), F.round(volume, 4).alias("volume_pct"), ((volume >= volume_least) & (F.col("sessions") >= sessions_least)).cast("int").alias("significant"))


def category_share(m: DataFrame, category: str) -> DataFrame:
    total = F.sum("n").over(W.partitionBy())
    return m.groupBy(category).agg(F.sum("sessions").cast("long").alias("n"), F.round(F.percentile("order_placed_pct", F.lit(0.5)), 4).alias("median_pct")).withColumn("share_pct", F.round(F.lit(100.0) * F.col("n") / total, 4))


def significant(m: DataFrame, sessions_over: int = 10, share_over: float = 2.0) -> DataFrame:
    share = F.lit(100.0) * F.col("sessions") / F.sum("sessions").over(W.partitionBy())
    return m.withColumn("share", share).where((F.col("sessions") > sessions_over) & (F.col("share") > share_over) & ~F.lower("cluster").startswith("other")).select("cluster", "sessions", F.round("share", 4).alias("share"))


def summary(m: DataFrame) -> DataFrame:
    return m.agg(F.sum("sessions").cast("long").alias("sessions"), F.sum("order_placed_sessions").cast("long").alias("orders"), F.round(F.avg("order_placed_pct"), 4).alias("mean_conversion"))


def distinct_names(m: DataFrame, name: str, count: str, key: str) -> DataFrame:
    """Clusters with the same name: the largest keeps it, the others get " 2", " 3" and so on."""
    nth = F.row_number().over(W.partitionBy(name).orderBy(F.desc(count), key))
    return m.withColumn("unique_name", F.when(nth == 1, F.col(name)).otherwise(F.concat_ws(" ", F.col(name), nth.cast("string"))))


def merged_labels(df: DataFrame, label: str, merges: DataFrame) -> DataFrame:
    """Labels by their canonical one; merges has columns old and canonical."""
    return df.join(merges, df[label] == merges["old"], "left").withColumn("canonical", F.coalesce("canonical", F.col(label))).drop("old")


def phrase_union(df: DataFrame, by: str, phrase: str, order: list, most: int = 12) -> DataFrame:
    """The first `most` phrases of each theme, without repeats in other case."""
    once = df.withColumn("k", F.lower(phrase)).withColumn("nth", F.row_number().over(W.partitionBy(by, "k").orderBy(*order))).where("nth = 1")
    return once.withColumn("place", F.row_number().over(W.partitionBy(by).orderBy(*order)).cast("long")).where(F.col("place") <= most).select(by, "place", "k")


def nearest_label(low: DataFrame, regular: DataFrame, distance, key: str) -> DataFrame:
    """Each rare label's nearest regular label, if it is no farther than the median of all distances; else it goes. Labels are few."""
    pairs = low.join(regular, F.lit(True)).withColumn("d", distance)
    median = F.broadcast(pairs.agg(F.percentile("d", F.lit(0.5)).alias("median")))  # one row
    best = pairs.withColumn("nth", F.row_number().over(W.partitionBy(key).orderBy("d"))).where("nth = 1")
    return best.join(median, F.lit(True)).where(F.col("d") <= F.col("median"))


def adaptive_sample_size(n):
    """Fixed steps: all up to 500, then shares with a cap, then 800."""
    return F.when(n <= 500, n).when(n <= 1000, F.least(F.lit(500), F.floor(n * 0.75))).when(n <= 1500, F.least(F.lit(650), F.floor(n * 0.33))).otherwise(800).cast("long")


def sessions_of(df: DataFrame, key: str, session: str, order: list[str]) -> DataFrame:
    """key, sessions: the different sessions of each cluster in the order in which they were first seen."""
    first = df.groupBy(key, session).agg(F.min(F.struct(*order)).alias("seen"))
    packed = first.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("seen", session))).alias("all"))  # one cluster's sessions
    return packed.select(key, F.transform("all", lambda x: x[session]).alias("sessions"))


def quality_report(decided: DataFrame, coherence: DataFrame) -> DataFrame:
    """One row: confident and assigned share of all messages, miscellaneous ones, themes in use, and the themes' mean coherence, 0 without any."""
    counts = decided.agg(
        F.round(100 * F.avg((F.col("status") == "confident").cast("double")), 2).alias("confident_pct"), F.round(100 * F.avg((F.col("theme") >= 0).cast("double")), 2).alias("assigned_pct"),
        F.sum((F.col("theme") < 0).cast("long")).alias("miscellaneous"), F.countDistinct(F.when(F.col("theme") >= 0, F.col("theme"))).alias("themes"),
    )
    return counts.join(F.broadcast(coherence.agg(F.round(F.coalesce(F.avg("coherence"), F.lit(0.0)), 6).alias("mean_coherence"))), F.lit(True))  # one row
