"""What an export of clusters holds: a metadata frame, and layouts with messages or sessions in blocks of bounded size.

One JSON object with all messages of all clusters can't be written in parts, so a layout is two frames: one row of totals, and rows of (cluster_id, part) whose
arrays hold about BLOCK items each; a cluster's array is its parts' arrays together, and no task ever holds a large cluster.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Items of one array, on average.
BLOCK = 1000


def part_of(item: Column, n: Column, block: int = BLOCK) -> Column:
    """Which of ceil(n / block) parts an item belongs to, by its digest: the same on every run, whatever the order of rows."""
    digest = F.conv(F.substring(F.md5(item.cast("string").cast("binary")), 1, 8), 16, 10).cast("long")
    return F.pmod(digest, F.greatest(F.ceil(n / block), F.lit(1))).cast("long")


def metadata_frame(clusters: DataFrame, metrics: DataFrame, source: str) -> DataFrame:
    """A row for each of clusters (cluster_id, title, messages, cluster), with its session metrics (cluster, sessions, avg_messages, counts and shares); 0
    for clusters without sessions, N/A for a null title."""
    numbers = [c for c in metrics.columns if c != "cluster"]
    rows = clusters.select("cluster_id", F.coalesce("title", F.lit("N/A")).alias("cluster_name"), F.coalesce("messages", F.lit(0)).cast("long").alias("messages"), "cluster")
    rows = rows.join(metrics, "cluster", "left")
    return rows.select(F.lit(source).alias("source_file"), "cluster_id", "cluster_name", "messages", *(F.coalesce(c, F.lit(0)).alias(c) for c in numbers))


def _blocks(items: DataFrame, key: str, columns: list[str], name: str, block: int) -> DataFrame:
    """cluster_id, part, n (items of the part) and the array called name, sorted, of items (cluster_id, columns)."""
    sizes = items.groupBy("cluster_id").agg(F.count("*").alias("of_cluster"))
    dealt = items.join(F.broadcast(sizes) if _few(sizes) else sizes, "cluster_id").withColumn("part", part_of(F.col(key), F.col("of_cluster"), block))
    item = F.col(columns[0]) if len(columns) == 1 else F.struct(*columns)
    return dealt.groupBy("cluster_id", "part").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(item)).alias(name))


#: Clusters (some 20 bytes each) whose sizes are broadcast, so that a hot cluster's rows aren't gathered by a join.
BROADCAST_CLUSTERS = 1_000_000


def _few(sizes: DataFrame) -> bool:
    return sizes.limit(BROADCAST_CLUSTERS + 1).count() <= BROADCAST_CLUSTERS


def cluster_layout(messages: DataFrame, block: int = BLOCK) -> DataFrame:
    """Parts of clusters with their messages (message_id, session, text), of messages (cluster_id, message_id, session, text)."""
    return _blocks(messages, "message_id", ["message_id", "session", "text"], "messages", block)


def session_layout(messages: DataFrame, block: int = BLOCK) -> DataFrame:
    """Parts of clusters with their distinct sessions, null ones left out."""
    return _blocks(messages.where("session is not null").select("cluster_id", "session").distinct(), "session", ["session"], "session_ids", block)


def layout_totals(messages: DataFrame, source: str, method: str = "concern_based") -> DataFrame:
    """One row: source_file, clustering_method, total_clusters, total_sessions (distinct over all clusters), total_messages."""
    # two levels of distinct counts, so that the sessions of all clusters don't end in one task
    sessions = messages.where("session is not null").select("session").distinct().agg(F.count("*").alias("total_sessions"))
    clusters = messages.groupBy("cluster_id").agg(F.count("*").alias("n")).agg(F.count("*").alias("total_clusters"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total_messages"))
    both = clusters.join(F.broadcast(sessions), F.lit(True))  # one row each
    return both.select(F.lit(source).alias("source_file"), F.lit(method).alias("clustering_method"), "total_clusters", "total_sessions", "total_messages")


def categorised_totals(labels: DataFrame, source: str, merged: bool, least: int) -> DataFrame:
    """One row about labels (label, n, kind: regular, low_frequency, multi_tag or deleted): how many of each kind, and the messages of those that stay."""
    of = lambda kind: F.count(F.when(F.col("kind") == kind, 1))
    stays = F.col("kind").isin("regular", "low_frequency")
    method = "concern_based_with_label_merging" if merged else "concern_based"
    return labels.agg(
        F.lit(source).alias("source_file"), F.lit(method).alias("clustering_method"), F.lit(merged).alias("merge_enabled"), F.lit(least).cast("long").alias("min_message_threshold"),
        F.count(F.when(stays, 1)).alias("total_clusters"), of("regular").alias("regular_clusters"), of("multi_tag").alias("multi_tags_removed"), of("deleted").alias("labels_deleted"),
        F.coalesce(F.sum(F.when(stays, F.col("n"))), F.lit(0)).cast("long").alias("total_messages"),
    )


def deltas(m: DataFrame, value: str, against: str = "median") -> DataFrame:
    """cluster, value, diff (value minus the median or mean over all clusters, two decimals) and shown: an arrow, the sign and one decimal (half up), as in a
    report. No difference points up; a null value has no difference."""
    middle = {"median": F.percentile(value, F.lit(0.5)), "mean": F.avg(value)}[against]
    cut = F.broadcast(m.agg(middle.alias("middle")))  # one row
    diff = F.round(F.col(value) - F.col("middle"), 2).cast("decimal(18,2)")
    rows = m.join(cut, F.lit(True)).select("cluster", value, diff.alias("diff"))
    short = F.round("diff", 1).cast("decimal(18,1)").cast("string")
    return rows.withColumn("shown", F.concat(F.when(F.col("diff") >= 0, "▲ +").otherwise("▼ "), short, F.lit("%"))).withColumn("diff", F.col("diff").cast("double"))
