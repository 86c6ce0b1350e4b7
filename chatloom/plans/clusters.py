"""Queries of clusters: metrics, bands, merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from chatloom.operators import clusters as C
from chatloom.plans import views as V
from chatloom.session import table

METRICS = f"""{V.NATION_CLUSTERS}, m AS (SELECT cluster, count(*) AS sessions, round(avg(messages), 2) AS avg_messages, CAST(sum(did_a2c) AS BIGINT) AS did_a2c_sessions, round(100.0::DOUBLE * sum(did_a2c) / count(*), 2) AS did_a2c_pct,
    CAST(sum(order_placed) AS BIGINT) AS order_placed_sessions, round(100.0::DOUBLE * sum(order_placed) / count(*), 2) AS order_placed_pct, CAST(sum(utm) AS BIGINT) AS utm_sessions, round(100.0::DOUBLE * sum(utm) / count(*), 2) AS utm_pct FROM nc GROUP BY cluster)"""
_metrics = lambda s, d: C.metrics(V.nation_clusters(s, d))
_spelled = lambda s, d: table(s, d, "part").select(F.col("p_partkey").alias("session"), F.when(F.col("p_partkey") % 3 == 0, F.upper("p_type")).otherwise(F.col("p_type")).alias("label"))
SPELLED = "sp AS (SELECT p_partkey AS session, CASE WHEN p_partkey % 3 = 0 THEN upper(p_type) ELSE p_type END AS label FROM part)"
_segment = lambda m: m.withColumn("segment", F.split("cluster", "/")[1])


def _percent(name: str) -> str:
    return ", ".join(f"round(quantile_cont(CAST({name} AS DOUBLE), {p}), 2) AS {name}_{k}" for k, p in (("p25", 0.25), ("median", 0.5), ("p75", 0.75)))


QUERIES = {
    "a15_concern_clusters": (
        lambda s, d: C.concern_clusters(_spelled(s, d), "label", "session"),
        f"""WITH {SPELLED}, g AS (SELECT lower(label) AS concern, label, count(*) AS n FROM sp GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY concern ORDER BY n DESC, label) AS k FROM g),
        t AS (SELECT concern, CAST(sum(n) AS BIGINT) AS messages, max(label) FILTER (k = 1) AS title FROM r GROUP BY 1), z AS (SELECT lower(label) AS concern, count(DISTINCT session) AS sessions FROM sp GROUP BY 1)
        SELECT concern, messages, title, sessions, row_number() OVER (ORDER BY messages DESC, concern) - 1 AS cluster_id FROM t JOIN z USING (concern)""",
    ),
    "a16_sessions_of_cluster": (lambda s, d: _spelled(s, d).groupBy(F.lower("label").alias("concern")).agg(F.min("session").alias("first_session"), F.countDistinct("session").alias("sessions")), f"WITH {SPELLED} SELECT lower(label) AS concern, min(session) AS first_session, count(DISTINCT session) AS sessions FROM sp GROUP BY 1"),
    "a17_atomic_labels": (lambda s, d: C.atomic_labels(table(s, d, "part").select(F.split(F.lower("p_type"), " ").alias("labels")), "labels"), "WITH l AS (SELECT unnest(string_split(lower(p_type), ' ')) AS label FROM part) SELECT label, count(*) AS n FROM l GROUP BY 1"),
    "a18_cluster_metrics": (_metrics, f"WITH {METRICS} SELECT * FROM m"),
    "a19_summary": (lambda s, d: C.summary(_metrics(s, d)), f"WITH {METRICS} SELECT CAST(sum(sessions) AS BIGINT) AS sessions, CAST(sum(order_placed_sessions) AS BIGINT) AS orders, round(avg(order_placed_pct), 4) AS mean_conversion FROM m"),
    "a20_median_bands": (lambda s, d: C.median_bands(_metrics(s, d)), f"WITH {METRICS} SELECT {_percent('did_a2c_pct')}, {_percent('order_placed_pct')}, {_percent('utm_pct')} FROM m"),
    "a20_bands_of_segment": (lambda s, d: C.median_bands(_metrics(s, d), only=F.col("cluster").endswith("BUILDING")), f"WITH {METRICS} SELECT {_percent('did_a2c_pct')}, {_percent('order_placed_pct')}, {_percent('utm_pct')} FROM m WHERE cluster LIKE '%BUILDING'"),
    "a20_bands_fall_back": (lambda s, d: C.median_bands(_metrics(s, d), only=F.col("cluster") == "none"), f"WITH {METRICS} SELECT {_percent('did_a2c_pct')}, {_percent('order_placed_pct')}, {_percent('utm_pct')} FROM m"),
    "a16_first_seen_sessions": (
        lambda s, d: C.sessions_of(table(s, d, "events"), "event_type", "user_id", ["ts", "event_id"]).select("event_type", F.array_join(F.transform("sessions", lambda x: x.cast("string")), ",").alias("sessions")),
        "WITH f AS (SELECT event_type, user_id, min(struct_pack(t := ts, e := event_id)) AS seen FROM events GROUP BY 1, 2) SELECT event_type, string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY seen) AS sessions FROM f GROUP BY 1",
    ),
    "a21_banded": (
        lambda s, d: C.banded(_metrics(s, d), "did_a2c_pct", 5, 0.5),
        f"""WITH {METRICS}, k AS (SELECT quantile_cont(did_a2c_pct, 0.25) AS low, quantile_cont(did_a2c_pct, 0.75) AS high, sum(sessions) AS al FROM m)
        SELECT cluster, did_a2c_pct, CASE WHEN did_a2c_pct <= low THEN 'poor' WHEN did_a2c_pct >= high THEN 'good' ELSE 'average' END AS band, round(100.0::DOUBLE * sessions / al, 4) AS volume_pct,
        CASE WHEN 100.0::DOUBLE * sessions / al >= 0.5 AND sessions >= 5 THEN 1 ELSE 0 END AS significant FROM m, k""",
    ),
    "a22_category_share": (
        lambda s, d: C.category_share(_segment(_metrics(s, d)), "segment"),
        f"WITH {METRICS}, g AS (SELECT string_split(cluster, '/')[2] AS segment, CAST(sum(sessions) AS BIGINT) AS n, round(quantile_cont(order_placed_pct, 0.5), 4) AS median_pct FROM m GROUP BY 1) SELECT *, round(100.0::DOUBLE * n / sum(n) OVER (), 4) AS share_pct FROM g",
    ),
    "a34_segment_share": (
        lambda s, d: _segment(_metrics(s, d)).agg(F.round(F.coalesce(F.lit(100.0) * F.try_divide(F.sum(F.when(F.col("segment") == "BUILDING", F.col("sessions"))), F.sum("sessions")), F.lit(0.0)), 4).alias("share_pct")),
        f"WITH {METRICS} SELECT round(100.0::DOUBLE * sum(sessions) FILTER (string_split(cluster, '/')[2] = 'BUILDING') / sum(sessions), 4) AS share_pct FROM m",
    ),
    "p14_significant": (lambda s, d: C.significant(_metrics(s, d), 2, 0.9), f"WITH {METRICS}, h AS (SELECT cluster, sessions, 100.0::DOUBLE * sessions / sum(sessions) OVER () AS share FROM m) SELECT cluster, sessions, round(share, 4) AS share FROM h WHERE sessions > 2 AND share > 0.9"),
    "p19_renumbered": (
        lambda s, d: C.concern_clusters(_spelled(s, d), "label", "session").where("messages >= 3").select("concern", "cluster_id"),
        f"WITH {SPELLED}, t AS (SELECT lower(label) AS concern, count(*) AS n FROM sp GROUP BY 1), r AS (SELECT concern, n, row_number() OVER (ORDER BY n DESC, concern) - 1 AS cluster_id FROM t) SELECT concern, cluster_id FROM r WHERE n >= 3",
    ),
    "w11_distinct_names": (
        lambda s, d: C.distinct_names(_segment(_metrics(s, d)), "segment", "sessions", "cluster").select("cluster", "unique_name"),
        f"WITH {METRICS}, r AS (SELECT cluster, string_split(cluster, '/')[2] AS segment, row_number() OVER (PARTITION BY string_split(cluster, '/')[2] ORDER BY sessions DESC, cluster) AS nth FROM m) SELECT cluster, CASE WHEN nth = 1 THEN segment ELSE segment || ' ' || nth END AS unique_name FROM r",
    ),
    "j17_merged_labels": (
        lambda s, d: C.merged_labels(table(s, d, "customer").select("c_custkey", F.col("c_nationkey").alias("label")), "label", table(s, d, "nation").where("n_nationkey % 2 = 0").select(F.col("n_nationkey").alias("old"), F.col("n_regionkey").alias("canonical"))).groupBy("canonical").agg(F.count("*").alias("n")),
        "SELECT CASE WHEN c_nationkey % 2 = 0 THEN n_regionkey ELSE c_nationkey END AS canonical, count(*) AS n FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1",
    ),
    "j9_cluster_facts": (
        lambda s, d: V.nation_clusters(s, d).select("cluster", "session").join(table(s, d, "orders").groupBy(F.col("o_custkey").alias("session")).agg(F.sum("o_totalprice").alias("v")), "session", "left").groupBy("cluster").agg(F.count("*").alias("n"), F.count("v").alias("known"), F.round(F.sum("v"), 2).alias("value")),
        f"WITH {V.NATION_CLUSTERS}, v AS (SELECT o_custkey, sum(o_totalprice) AS v FROM orders GROUP BY 1) SELECT cluster, count(*) AS n, count(v) AS known, round(sum(v), 2) AS value FROM nc LEFT JOIN v ON o_custkey = session GROUP BY cluster",
    ),
    "u3_phrase_union": (
        lambda s, d: C.phrase_union(V.product_names(s, d), "theme", "phrase", ["phrase"], 5),
        f"WITH {V.NAMES} SELECT theme, row_number() OVER (PARTITION BY theme ORDER BY phrase) AS place, lower(phrase) AS k FROM names QUALIFY row_number() OVER (PARTITION BY theme ORDER BY phrase) <= 5",
    ),
    "m20_nearest_label": (
        lambda s, d: C.nearest_label(table(s, d, "nation").where("n_nationkey < 5").select("n_nationkey", F.length("n_name").alias("x")), table(s, d, "nation").where("n_nationkey >= 5").select(F.col("n_nationkey").alias("target"), F.length("n_name").alias("y")), F.abs(F.col("x") - F.col("y")) + F.col("target") / 1000.0, "n_nationkey").select("n_nationkey", "target"),
        """WITH p AS (SELECT a.n_nationkey, b.n_nationkey AS target, abs(length(a.n_name) - length(b.n_name)) + b.n_nationkey / 1000.0::DOUBLE AS d FROM nation a, nation b WHERE a.n_nationkey < 5 AND b.n_nationkey >= 5)
        SELECT n_nationkey, target FROM (SELECT *, row_number() OVER (PARTITION BY n_nationkey ORDER BY d) AS nth FROM p) WHERE nth = 1 AND d <= (SELECT quantile_cont(d, 0.5) FROM p)""",
    ),
    "t4_sample_size": (lambda s, d: table(s, d, "orders").select((F.col("o_orderkey") * 37 % 3001).alias("id")).distinct().select("id", C.adaptive_sample_size(F.col("id")).alias("size")), "SELECT DISTINCT range AS id, CAST(CASE WHEN range <= 500 THEN range WHEN range <= 1000 THEN least(500, floor(range * 0.75)) WHEN range <= 1500 THEN least(650, floor(range * 0.33)) ELSE 800 END AS BIGINT) AS size FROM (SELECT o_orderkey * 37 % 3001 AS range FROM orders)"),
    "a32_label_groups": (
        lambda s, d: table(s, d, "part").groupBy("p_brand", "p_type").agg(F.count("*").alias("n")).groupBy("p_brand").agg(F.count("*").alias("labels"), F.sum("n").cast("long").alias("parts"), F.array_join(F.transform(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "p_type"))), 1, 5), lambda x: x["p_type"]), ",").alias("top")),
        "WITH g AS (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_type) AS k FROM g) SELECT p_brand, count(*) AS labels, CAST(sum(n) AS BIGINT) AS parts, string_agg(p_type, ',' ORDER BY k) FILTER (k <= 5) AS top FROM r GROUP BY 1",
    ),
    "a33_inverted_index": (lambda s, d: V.product_names(s, d).select("theme", F.explode(F.split("phrase", " ")).alias("word")).groupBy("word").agg(F.countDistinct("theme").alias("themes")), f"WITH {V.NAMES}, w AS (SELECT theme, unnest(string_split(phrase, ' ')) AS word FROM names) SELECT word, count(DISTINCT theme) AS themes FROM w GROUP BY 1"),
}
