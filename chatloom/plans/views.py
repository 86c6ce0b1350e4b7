"""The driver's tables as the engine's inputs, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.session import table

IST = 330  # minutes


def chat(spark: SparkSession, sf: str) -> DataFrame:
    """session, pos, actor, text."""
    actor = F.when(F.col("role") == "user", "customer").when(F.col("role") == "assistant", "AI")
    return table(spark, sf, "conversations").select(F.col("conv_id").alias("session"), F.col("turn").alias("pos"), actor.alias("actor"), "text").where("actor is not null")


CHAT = "chat AS (SELECT conv_id AS session, turn AS pos, CASE role WHEN 'user' THEN 'customer' WHEN 'assistant' THEN 'AI' END AS actor, text FROM conversations WHERE role IN ('user', 'assistant'))"


def events(spark: SparkSession, sf: str) -> DataFrame:
    """events with session (user and day)."""
    return table(spark, sf, "events").withColumn("session", F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")))


EVENTS = "ev AS (SELECT *, user_id || '-' || strftime(ts, '%Y-%m-%d') AS session FROM events)"


def doc_lines(spark: SparkSession, sf: str) -> DataFrame:
    """session (doc_id), pos, text, did_a2c, order_placed: each line of a document as a message."""
    labels = table(spark, sf, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    lines = table(spark, sf, "documents").select(F.col("doc_id").alias("session"), F.posexplode_outer(F.split("text", "\n")).alias("i", "text"))
    lines = lines.select("session", (F.col("i") + 1).cast("long").alias("pos"), "text")
    return lines.join(labels.withColumnRenamed("doc_id", "session"), "session", "left").select("session", "pos", "text", F.coalesce("quality", F.lit(0)).alias("did_a2c"), F.coalesce("toxic", F.lit(0)).alias("order_placed"))


DOC_LINES = """lb AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY 1),
    parts AS (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents),
    raw_lines AS (SELECT doc_id AS session, unnest(p) AS text, CAST(unnest(range(1, len(p) + 1)) AS BIGINT) AS pos FROM parts),
    doc_lines AS (SELECT r.session, r.pos, r.text, coalesce(lb.quality, 0) AS did_a2c, coalesce(lb.toxic, 0) AS order_placed FROM raw_lines r LEFT JOIN lb ON lb.doc_id = r.session)"""


def vec_messages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").where("vec_id % 10 <> 0").select(F.col("vec_id").alias("message"), F.col("embedding").alias("v"))


def vec_phrases(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").where("vec_id % 10 = 0").select(F.col("vec_id").alias("phrase"), F.col("label").cast("long").alias("theme"), F.col("embedding").alias("v"))


VECTORS = """vm AS (SELECT vec_id AS message, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id % 10 <> 0),
    vp AS (SELECT vec_id AS phrase, CAST(label AS BIGINT) AS theme, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id % 10 = 0)"""


def product_names(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct part names as phrases; the first word is the theme."""
    return table(spark, sf, "part").select(F.col("p_name").alias("phrase")).distinct().withColumn("theme", F.split("phrase", " ")[0])


NAMES = "names AS (SELECT DISTINCT p_name AS phrase, string_split(p_name, ' ')[1] AS theme FROM part)"


def nation_clusters(spark: SparkSession, sf: str) -> DataFrame:
    """One cluster a nation and brand-like segment: customers as sessions, orders as conversions."""
    c, o = table(spark, sf, "customer"), table(spark, sf, "orders")
    orders = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("orders"), F.max((F.col("o_orderstatus") == "F").cast("int")).alias("utm"))
    return c.join(orders, "c_custkey", "left").select(F.concat_ws("/", F.col("c_nationkey").cast("string"), F.col("c_mktsegment")).alias("cluster"), F.col("c_custkey").alias("session"), F.coalesce("orders", F.lit(0)).cast("long").alias("messages"), (F.col("c_acctbal") > 5000).cast("int").alias("did_a2c"), (F.coalesce("orders", F.lit(0)) > 8).cast("int").alias("order_placed"), F.coalesce("utm", F.lit(0)).alias("utm"))


NATION_CLUSTERS = """no AS (SELECT o_custkey, count(*) AS orders, max(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS utm FROM orders GROUP BY 1),
    nc AS (SELECT c_nationkey || '/' || c_mktsegment AS cluster, c_custkey AS session, coalesce(orders, 0) AS messages, CASE WHEN c_acctbal > 5000 THEN 1 ELSE 0 END AS did_a2c,
           CASE WHEN coalesce(orders, 0) > 8 THEN 1 ELSE 0 END AS order_placed, coalesce(utm, 0) AS utm FROM customer LEFT JOIN no ON o_custkey = c_custkey)"""
