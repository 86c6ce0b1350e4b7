"""Queries of sources, message facts and loader filters."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chatloom.functions import text as T
from chatloom.operators import facts as O
from chatloom.plans import views as V
from chatloom.session import table

LABELS = {"view": "Product discovery", "click": "Product interest", "purchase": "Order", "signup": "Account"}
PURCHASES = "event_type = 'purchase'"


def _events(kind: str):
    return lambda s, d: table(s, d, "events").where(F.col("event_type") == kind).select("user_id", "ts", "event_id")


def _doc_case():
    return F.expr("CASE WHEN text LIKE 'The%' THEN NULL ELSE text END")


QUERIES = {
    "s1_sessions_in_range": (lambda s, d: V.events(s, d).where("ts between timestamp_ntz'2024-01-05 00:00:00' and timestamp_ntz'2024-01-08 23:59:59'").select("session").distinct(), f"WITH {V.EVENTS} SELECT DISTINCT session FROM ev WHERE ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-08 23:59:59'"),
    "s2_chat_scan": (
        lambda s, d: V.chat(s, d).join(V.chat(s, d).where("pos = 2").select("session").distinct(), "session", "left_semi").where(~F.col("text").startswith("The ")).select("session", "pos", "actor"),
        f"WITH {V.CHAT} SELECT session, pos, actor FROM chat WHERE session IN (SELECT session FROM chat WHERE pos = 2) AND text NOT LIKE 'The %'",
    ),
    "s3_metadata_nested": (
        lambda s, d: V.chat(s, d).groupBy("session").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "actor"))), lambda x: F.concat_ws(":", x["pos"], x["actor"])), ",").alias("messages")),
        f"WITH {V.CHAT} SELECT session, string_agg(pos || ':' || actor, ',' ORDER BY pos) AS messages FROM chat GROUP BY session",
    ),
    "s5_user_fields": (lambda s, d: table(s, d, "events").select("user_id", "event_type", F.get_json_object("props", "$.k").alias("val")).dropDuplicates(), "SELECT DISTINCT user_id, event_type, props ->> '$.k' AS val FROM events"),
    "s8_keep_last_day": (
        lambda s, d: O.keep_last(V.events(s, d), "user_id", [F.desc("ts"), F.desc("event_id")]).select("user_id", "session", "event_id"),
        f"WITH {V.EVENTS} SELECT user_id, session, event_id FROM ev QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
    ),
    "s11_tenants": (lambda s, d: table(s, d, "supplier").select(F.lower("s_name").alias("tenant")).where("trim(tenant) <> ''").distinct(), "SELECT DISTINCT lower(s_name) AS tenant FROM supplier WHERE trim(s_name) <> ''"),
    "p1_customer_messages": (lambda s, d: O.customer_messages(V.chat(s, d)).select("session", "pos", "msg_number"), f"WITH {V.CHAT} SELECT session, pos, row_number() OVER (PARTITION BY session ORDER BY pos) AS msg_number FROM chat WHERE actor = 'customer'"),
    "w2_handed_off": (
        lambda s, d: O.handed_off(V.chat(s, d), "the").select("session", "pos", "talk_to_agent"),
        f"WITH {V.CHAT}, l AS (SELECT *, lead(actor) OVER w AS na, lead(text) OVER w AS nt FROM chat WINDOW w AS (PARTITION BY session ORDER BY pos)) SELECT session, pos, CASE WHEN na = 'AI' AND contains(lower(nt), 'the') THEN 1 ELSE 0 END AS talk_to_agent FROM l WHERE actor = 'customer'",
    ),
    "p8_asked_before": (
        lambda s, d: O.asked_before(V.chat(s, d), "and"),
        f"""WITH {V.CHAT}, l AS (SELECT *, last_value(CASE WHEN actor = 'customer' THEN pos END IGNORE NULLS) OVER (PARTITION BY session ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS asked_pos FROM chat)
        SELECT session, pos, asked_pos FROM l WHERE actor <> 'customer' AND contains(lower(text), 'and') AND asked_pos IS NOT NULL""",
    ),
    "j1_next_purchase": (
        lambda s, d: O.next_event(_events("view")(s, d), _events("purchase")(s, d), "user_id", "ts", "event_id").select("event_id", "user_id", "next_event_id"),
        f"""WITH p AS (SELECT user_id, ts, max(event_id) AS next_event_id FROM events WHERE {PURCHASES} GROUP BY 1, 2)
        SELECT v.event_id, v.user_id, p.next_event_id FROM (SELECT * FROM events WHERE event_type = 'view') v ASOF LEFT JOIN p ON v.user_id = p.user_id AND v.ts <= p.ts""",
    ),
    "j2_next_snapshot": (
        lambda s, d: O.next_event(_events("view")(s, d), table(s, d, "events").where(PURCHASES).select("user_id", "ts", F.get_json_object("props", "$.k").alias("k")), "user_id", "ts", "k").select("event_id", "next_k"),
        f"""WITH p AS (SELECT user_id, ts, max(props ->> '$.k') AS next_k FROM events WHERE {PURCHASES} GROUP BY 1, 2)
        SELECT v.event_id, p.next_k FROM (SELECT * FROM events WHERE event_type = 'view') v ASOF LEFT JOIN p ON v.user_id = p.user_id AND v.ts <= p.ts""",
    ),
    "j3_positional": (
        lambda s, d: O.zipped(_events("view")(s, d), _events("purchase")(s, d).select("user_id", F.col("event_id").alias("bought"), F.col("ts").alias("bts")), "user_id", ["ts", "event_id"], ["bts", "bought"]).select("event_id", "nth", F.coalesce(F.col("bought").cast("string"), F.lit("unknown")).alias("bought")),
        f"""WITH a AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nth FROM events WHERE event_type = 'view'), b AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nth FROM events WHERE {PURCHASES})
        SELECT a.event_id, a.nth, coalesce(CAST(b.event_id AS VARCHAR), 'unknown') AS bought FROM a LEFT JOIN b ON a.user_id = b.user_id AND a.nth = b.nth""",
    ),
    "j4_positional_inner": (
        lambda s, d: O.zipped(_events("view")(s, d), _events("purchase")(s, d).select("user_id", F.col("event_id").alias("bought"), F.col("ts").alias("bts")), "user_id", ["ts", "event_id"], ["bts", "bought"], "inner").select("event_id", "nth", "bought"),
        f"""WITH a AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nth FROM events WHERE event_type = 'view'), b AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nth FROM events WHERE {PURCHASES})
        SELECT a.event_id, a.nth, b.event_id AS bought FROM a JOIN b ON a.user_id = b.user_id AND a.nth = b.nth""",
    ),
    "p4_session_flags": (
        lambda s, d: O.session_flags(V.events(s, d), F.col("session"), {"did_a2c": "click", "order_placed": "purchase"}),
        f"WITH {V.EVENTS} SELECT session, count(*) AS events, max(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS did_a2c, max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS order_placed FROM ev GROUP BY session",
    ),
    "p2_p3_first_field": (
        lambda s, d: V.chat(s, d).groupBy("session").agg(F.array_sort(F.collect_list(F.struct("pos", "actor", "text"))).alias("c")).select("session", F.expr("try_element_at(c, 1).actor").alias("first_actor"), F.expr("substring(try_element_at(filter(c, x -> x.actor = 'AI'), 1).text, 1, 20)").alias("first_answer")),
        f"WITH {V.CHAT} SELECT session, arg_min(actor, pos) AS first_actor, substring(arg_min(text, pos) FILTER (actor = 'AI'), 1, 20) AS first_answer FROM chat GROUP BY session",
    ),
    "p6_drop_null_label": (lambda s, d: table(s, d, "documents").select("doc_id", _doc_case().alias("label")).dropna(subset=["label"]).select("doc_id"), "SELECT doc_id FROM documents WHERE text NOT LIKE 'The%'"),
    "p7_page_filter": (lambda s, d: table(s, d, "pages").where(F.coalesce(F.lower("url").contains("en"), F.lit(False)) & F.element_at(F.split("url", "/"), 4).isin("en", "fr")).select("page_id"), "SELECT page_id FROM pages WHERE contains(lower(url), 'en') AND string_split(url, '/')[4] IN ('en', 'fr')"),
    "p9_prefix_filter": (lambda s, d: V.chat(s, d).where(~(F.lower(F.trim("text")).startswith("the") | F.lower(F.trim("text")).startswith("and"))).select("session", "pos"), f"WITH {V.CHAT} SELECT session, pos FROM chat WHERE NOT (starts_with(lower(trim(text)), 'the') OR starts_with(lower(trim(text)), 'and'))"),
    "p10_length_filter": (lambda s, d: V.doc_lines(s, d).where(F.length(T.strip(F.col("text"))) >= 7).groupBy("session").agg(F.count("*").alias("n")), f"WITH {V.DOC_LINES} SELECT session, count(*) AS n FROM doc_lines WHERE length(trim(text)) >= 7 GROUP BY session"),
    "p11_special_tenant": (lambda s, d: table(s, d, "customer").select("c_custkey", F.coalesce(F.expr("c_mktsegment like 'A%' or c_mktsegment like 'B%'"), F.lit(False)).cast("int").alias("special")), "SELECT c_custkey, CASE WHEN starts_with(c_mktsegment, 'A') OR starts_with(c_mktsegment, 'B') THEN 1 ELSE 0 END AS special FROM customer"),
    "j5_semi": (lambda s, d: table(s, d, "orders").join(table(s, d, "customer").where("c_acctbal > 9000").select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "left_semi").select("o_orderkey"), "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 9000)"),
    "j8_label_map": (lambda s, d: table(s, d, "events").select("event_id", O.mapped(F.col("event_type"), LABELS).alias("label")), "SELECT event_id, CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LABELS.items()) + " ELSE event_type END AS label FROM events"),
    "u1_union_keep_last": (
        lambda s, d: O.keep_last(V.events(s, d).select("session", "event_id", F.lit(1).alias("day")).unionByName(V.events(s, d).where("event_id % 2 = 0").select("session", "event_id", F.lit(2).alias("day"))), "session", [F.desc("day"), F.desc("event_id")]).select("session", "event_id", "day"),
        f"WITH {V.EVENTS}, u AS (SELECT session, event_id, 1 AS day FROM ev UNION ALL SELECT session, event_id, 2 FROM ev WHERE event_id % 2 = 0) SELECT session, event_id, day FROM u QUALIFY row_number() OVER (PARTITION BY session ORDER BY day DESC, event_id DESC) = 1",
    ),
    "k11_job_upsert": (
        lambda s, d: (lambda jobs, new: jobs.withColumn("status", F.when(F.col("status") == "PENDING", "IN_PROGRESS").otherwise(F.col("status"))).unionByName(new.join(jobs.select("id"), "id", "left_anti").withColumn("status", F.lit("IN_PROGRESS"))))(
            table(s, d, "orders").where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderstatus") == "O", "PENDING").otherwise("COMPLETED").alias("status")),
            table(s, d, "orders").where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("id")),
        ),
        """WITH jobs AS (SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'O' THEN 'PENDING' ELSE 'COMPLETED' END AS status FROM orders WHERE o_orderkey % 3 = 0)
        SELECT id, CASE WHEN status = 'PENDING' THEN 'IN_PROGRESS' ELSE status END AS status FROM jobs UNION ALL SELECT o_orderkey, 'IN_PROGRESS' FROM orders WHERE o_orderkey % 2 = 0 AND o_orderkey NOT IN (SELECT id FROM jobs)""",
    ),
    "t3_hash_sample": (lambda s, d: table(s, d, "documents").orderBy(F.md5(F.concat(F.lit("42:"), F.col("doc_id").cast("string"))), "doc_id").limit(250).select("doc_id"), "SELECT doc_id FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 250"),
    "t5_ordered_sample": (
        lambda s, d: table(s, d, "documents").orderBy(F.md5(F.concat(F.lit("42:"), F.col("doc_id").cast("string"))), "doc_id").limit(100).select("doc_id", F.row_number().over(W.orderBy("doc_id")).cast("long").alias("place")),  # 100 rows
        "WITH p AS (SELECT doc_id FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 100) SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS place FROM p",
    ),
    "w10_stratified": (
        lambda s, d: table(s, d, "documents").withColumn("nth", F.row_number().over(W.partitionBy("source").orderBy(F.md5(F.col("doc_id").cast("string"))))).where("nth <= 5").select("doc_id", "source"),
        "SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY md5(CAST(doc_id AS VARCHAR))) <= 5",
    ),
    "w8_dedupe_keep_first": (
        lambda s, d: V.doc_lines(s, d).groupBy("text").agg(F.min(F.struct("session", "pos")).alias("f")).select("f.session", "f.pos"),
        f"WITH {V.DOC_LINES} SELECT session, pos FROM doc_lines QUALIFY row_number() OVER (PARTITION BY text ORDER BY session, pos) = 1",
    ),
    "j10_text_sessions": (lambda s, d: V.doc_lines(s, d).groupBy("text").agg(F.countDistinct("session").alias("sessions")).where("sessions > 1"), f"WITH {V.DOC_LINES} SELECT text, count(DISTINCT session) AS sessions FROM doc_lines GROUP BY text HAVING count(DISTINCT session) > 1"),
    "j10_messages_of_texts": (
        lambda s, d: V.doc_lines(s, d).groupBy("text", "session").agg(F.count("*").alias("times")).join(V.doc_lines(s, d).groupBy("text").agg(F.countDistinct("session").alias("all")).where(F.col("all") > 1), "text").select(F.md5("text").alias("text_md5"), "session", "times"),
        f"WITH {V.DOC_LINES}, m AS (SELECT text FROM doc_lines GROUP BY 1 HAVING count(DISTINCT session) > 1) SELECT md5(text) AS text_md5, session, count(*) AS times FROM doc_lines JOIN m USING (text) GROUP BY text, session",
    ),
}
