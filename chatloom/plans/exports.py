"""Queries of exports: the metadata frame, the layouts and their totals, differences with arrows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.operators import clusters as C
from chatloom.operators import exports as E
from chatloom.operators import labels as B
from chatloom.plans import views as V
from chatloom.plans.clusters import METRICS
from chatloom.session import table

#: Items of a part in the queries, so that clusters of small tables have several parts too.
BLOCK = 20
LEAST = 5


def _metrics(s, d: str) -> DataFrame:
    return C.metrics(V.nation_clusters(s, d))


def _named(s, d: str) -> DataFrame:
    """Clusters with the messages of their sessions and the segment as title; null for one segment."""
    sums = V.nation_clusters(s, d).groupBy("cluster", "session").agg(F.max("messages").alias("n")).groupBy("cluster").agg(F.sum("n").cast("long").alias("messages"))
    segment = F.split("cluster", "/")[1]
    return sums.select("cluster", "messages", F.when(segment != "BUILDING", segment).alias("title"), F.md5(F.col("cluster").cast("binary")).alias("cluster_id"))


def _messages(s, d: str) -> DataFrame:
    """Orders as messages: clusters by priority and status, the customer as the session."""
    return table(s, d, "orders").select(F.concat_ws("/", "o_orderpriority", "o_orderstatus").alias("cluster_id"), F.col("o_orderkey").alias("message_id"), F.col("o_custkey").alias("session"), F.col("o_orderpriority").alias("text"))


MESSAGES = "ms AS (SELECT o_orderpriority || '/' || o_orderstatus AS cluster_id, o_orderkey AS message_id, o_custkey AS session FROM orders)"


def _part(item: str) -> str:
    return f"CAST('0x' || substr(md5(CAST({item} AS VARCHAR)), 1, 8) AS BIGINT) % CAST(ceil(of_cluster / {BLOCK}.0) AS BIGINT)"


def _ids(name: str, item) -> object:
    return F.array_join(F.transform(name, lambda x: item(x).cast("string")), ",").alias("ids")


def _kinds(s, d: str) -> DataFrame:
    """Brand and type as labels: brands that end in 1 stand for labels with several tags, rare labels of brands that end in 2 for deleted ones."""
    n = table(s, d, "part").groupBy("p_brand", "p_type").agg(F.count("*").alias("n")).withColumn("label", F.concat_ws(" ", "p_brand", "p_type"))
    n = B.by_size(n, LEAST)
    kind = F.when(F.col("p_brand").endswith("1"), "multi_tag").when(F.col("p_brand").endswith("2") & (F.col("kind") == "low_frequency"), "deleted").otherwise(F.col("kind"))
    return n.select("label", "n", kind.alias("kind"))


QUERIES = {
    "k4_cluster_metadata": (
        lambda s, d: E.metadata_frame(_named(s, d), _metrics(s, d).where("sessions > 1"), "customer.parquet"),
        f"""WITH {METRICS}, o AS (SELECT cluster, session, max(messages) AS n FROM nc GROUP BY 1, 2), n AS (SELECT cluster, CAST(sum(n) AS BIGINT) AS messages FROM o GROUP BY 1), k AS (SELECT * FROM m WHERE sessions > 1)
        SELECT 'customer.parquet' AS source_file, md5(cluster) AS cluster_id, CASE WHEN cluster LIKE '%/BUILDING' THEN 'N/A' ELSE string_split(cluster, '/')[2] END AS cluster_name, messages, coalesce(sessions, 0) AS sessions,
        coalesce(avg_messages, 0) AS avg_messages, coalesce(did_a2c_sessions, 0) AS did_a2c_sessions, coalesce(did_a2c_pct, 0) AS did_a2c_pct, coalesce(order_placed_sessions, 0) AS order_placed_sessions,
        coalesce(order_placed_pct, 0) AS order_placed_pct, coalesce(utm_sessions, 0) AS utm_sessions, coalesce(utm_pct, 0) AS utm_pct FROM n LEFT JOIN k USING (cluster)""",
    ),
    "k3_cluster_parts": (
        lambda s, d: E.cluster_layout(_messages(s, d), BLOCK).select("cluster_id", "part", "n", _ids("messages", lambda x: x["message_id"])),
        f"""WITH {MESSAGES}, z AS (SELECT *, count(*) OVER (PARTITION BY cluster_id) AS of_cluster FROM ms), p AS (SELECT cluster_id, message_id, {_part("message_id")} AS part FROM z)
        SELECT cluster_id, part, count(*) AS n, string_agg(CAST(message_id AS VARCHAR), ',' ORDER BY message_id) AS ids FROM p GROUP BY 1, 2""",
    ),
    "k3_session_parts": (
        lambda s, d: E.session_layout(_messages(s, d), BLOCK).select("cluster_id", "part", "n", _ids("session_ids", lambda x: x)),
        f"""WITH {MESSAGES}, u AS (SELECT DISTINCT cluster_id, session FROM ms WHERE session IS NOT NULL), z AS (SELECT *, count(*) OVER (PARTITION BY cluster_id) AS of_cluster FROM u),
        p AS (SELECT cluster_id, session, {_part("session")} AS part FROM z) SELECT cluster_id, part, count(*) AS n, string_agg(CAST(session AS VARCHAR), ',' ORDER BY session) AS ids FROM p GROUP BY 1, 2""",
    ),
    "k3_totals": (
        lambda s, d: E.layout_totals(_messages(s, d), "orders.parquet"),
        f"WITH {MESSAGES} SELECT 'orders.parquet' AS source_file, 'concern_based' AS clustering_method, count(DISTINCT cluster_id) AS total_clusters, count(DISTINCT session) AS total_sessions, count(*) AS total_messages FROM ms",
    ),
    "k3_categorised_totals": (
        lambda s, d: E.categorised_totals(_kinds(s, d), "part.parquet", True, LEAST),
        f"""WITH g AS (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY 1, 2), k AS (SELECT n, CASE WHEN p_brand LIKE '%1' THEN 'multi_tag' WHEN p_brand LIKE '%2' AND n < {LEAST} THEN 'deleted' WHEN n >= {LEAST} THEN 'regular' ELSE 'low_frequency' END AS kind FROM g)
        SELECT 'part.parquet' AS source_file, 'concern_based_with_label_merging' AS clustering_method, true AS merge_enabled, CAST({LEAST} AS BIGINT) AS min_message_threshold, count(*) FILTER (kind IN ('regular', 'low_frequency')) AS total_clusters,
        count(*) FILTER (kind = 'regular') AS regular_clusters, count(*) FILTER (kind = 'multi_tag') AS multi_tags_removed, count(*) FILTER (kind = 'deleted') AS labels_deleted,
        CAST(coalesce(sum(n) FILTER (kind IN ('regular', 'low_frequency')), 0) AS BIGINT) AS total_messages FROM k""",
    ),
} | {
    f"f27_{against}_deltas": (
        lambda s, d, against=against: E.deltas(_metrics(s, d), "order_placed_pct", against),
        f"""WITH {METRICS}, k AS (SELECT {middle} AS middle FROM m), d AS (SELECT cluster, order_placed_pct, CAST(round(order_placed_pct - middle, 2) AS DECIMAL(18, 2)) AS diff FROM m, k)
        SELECT cluster, order_placed_pct, CAST(diff AS DOUBLE) AS diff, CASE WHEN diff >= 0 THEN '▲ +' ELSE '▼ ' END || CAST(CAST(round(diff, 1) AS DECIMAL(18, 1)) AS VARCHAR) || '%' AS shown FROM d""",
    )
    for against, middle in (("median", "quantile_cont(order_placed_pct, 0.5)"), ("mean", "avg(order_placed_pct)"))
}
