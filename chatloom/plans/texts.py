"""Queries of text clean-up, labels and JSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from chatloom.functions import text as T
from chatloom.plans import views as V
from chatloom.session import table

CLEAN = r"trim(regexp_replace(regexp_replace(lower(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, 'http\S+', '', 'g'), '\S+@\S+', '', 'g'), '\+?\d[\d -]{8,}\d', '', 'g'), '[$€₹¥]', '', 'g')), '[^\p{L}\p{N}_\s]', ' ', 'g'), '\s+', ' ', 'g'))"
MARKS = r"array_to_string(list_slice(regexp_extract_all(text, '[!]{2,}|[?]{2,}|[.]{3,}'), 1, 2), ' ')"
_docs = lambda s, d: table(s, d, "documents")
_events = lambda s, d: table(s, d, "events")


def _kinds():
    """Four spellings of the same label list."""
    k = F.col("event_type")
    return (
        F.when(F.col("event_id") % 4 == 0, F.concat(F.lit('["'), k, F.lit('", "Other"]')))
        .when(F.col("event_id") % 4 == 1, F.concat(F.lit("['Other', '"), k, F.lit("']")))
        .when(F.col("event_id") % 4 == 2, F.concat(F.lit('"[\\"'), k, F.lit('\\",\\"other\\"]"')))
        .otherwise(k)
    )


QUERIES = {
    "f7_word_count": (lambda s, d: _docs(s, d).select("doc_id", T.word_count(F.col("text")).alias("words")), r"SELECT doc_id, CAST(len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) AS BIGINT) AS words FROM documents"),
    "f9_urgency_markers": (lambda s, d: _docs(s, d).select("doc_id", T.urgency_markers(F.col("text")).alias("markers")), f"SELECT doc_id, {MARKS} AS markers FROM documents"),
    "f10_f12_clean_text": (lambda s, d: _docs(s, d).select("doc_id", F.md5(T.clean_english(F.col("text"))).alias("clean_md5")), f"SELECT doc_id, md5({CLEAN}) AS clean_md5 FROM documents"),
    "f9_clean_message": (lambda s, d: _docs(s, d).select("doc_id", F.md5(T.clean_message(F.col("text"))).alias("clean_md5")), f"SELECT doc_id, md5(trim({CLEAN} || CASE WHEN {MARKS} = '' THEN '' ELSE ' ' || {MARKS} END)) AS clean_md5 FROM documents"),
    "f15_canonical_key": (
        lambda s, d: _events(s, d).select("event_id", T.canonical_key(T.labels_of(_kinds())).alias("key")),
        """SELECT event_id, CASE event_id % 4 WHEN 0 THEN lower('["' || array_to_string(list_sort([event_type, 'Other']), '", "') || '"]') WHEN 1 THEN lower('["' || array_to_string(list_sort([event_type, 'Other']), '", "') || '"]')
        WHEN 2 THEN '["' || array_to_string(list_sort([event_type, 'other']), '", "') || '"]' ELSE '["' || event_type || '"]' END AS key FROM events""",
    ),
    "f1_local_time": (lambda s, d: _events(s, d).select("event_id", F.date_format(F.col("ts") + F.expr("interval 330 minutes"), "yyyy-MM-dd HH:mm:ss").alias("ist")), "SELECT event_id, strftime(ts + INTERVAL 330 MINUTE, '%Y-%m-%d %H:%M:%S') AS ist FROM events"),
    "f3_json_array_length": (lambda s, d: _events(s, d).select("event_id", F.json_array_length(F.concat(F.lit("["), F.array_join(F.transform(F.sequence(F.lit(1), (F.col("event_id") % 3 + 1).cast("int")), lambda x: x.cast("string")), ","), F.lit("]"))).cast("long").alias("days")), "SELECT event_id, event_id % 3 + 1 AS days FROM events"),
    "f6_utm_value": (lambda s, d: _docs(s, d).select("doc_id", T.utm_value(F.concat(F.lit("  "), F.when(F.col("doc_id") % 3 == 0, "NaN").otherwise(F.upper("source")), F.lit(" \t"))).alias("utm")), "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE lower(source) END AS utm FROM documents"),
    "f17_page_slug": (lambda s, d: table(s, d, "pages").select("page_id", T.page_slug(F.col("url")).alias("slug")), r"SELECT page_id, substring(regexp_replace(regexp_replace(regexp_replace(url, '^[a-z]+://[^/]*/?', ''), '[?#].*$', ''), '[^A-Za-z0-9_\-]', '_', 'g'), 1, 50) AS slug FROM pages"),
    "f18_labels_of_time": (
        lambda s, d: _events(s, d).select("event_id", T.twelve_hour(F.hour("ts")).alias("hour_label"), T.ordinal_day(F.dayofmonth("ts")).alias("day_label"), F.date_format("ts", "MMM dd").alias("short_date")),
        """SELECT event_id, (CASE WHEN hour(ts) % 12 = 0 THEN 12 ELSE hour(ts) % 12 END) || CASE WHEN hour(ts) < 12 THEN ' AM' ELSE ' PM' END AS hour_label,
        day(ts) || CASE WHEN day(ts) % 100 BETWEEN 11 AND 13 THEN 'th' WHEN day(ts) % 10 = 1 THEN 'st' WHEN day(ts) % 10 = 2 THEN 'nd' WHEN day(ts) % 10 = 3 THEN 'rd' ELSE 'th' END AS day_label, strftime(ts, '%b %d') AS short_date FROM events""",
    ),
    "f25_stage_rule": (lambda s, d: V.doc_lines(s, d).select("session", "pos", F.when(F.lower("text").rlike("order|return|refund|the"), "post-sales").otherwise("pre-sales").alias("stage")), f"WITH {V.DOC_LINES} SELECT session, pos, CASE WHEN regexp_matches(lower(text), 'order|return|refund|the') THEN 'post-sales' ELSE 'pre-sales' END AS stage FROM doc_lines"),
    "f28_html_links": (lambda s, d: table(s, d, "pages").select("page_id", F.regexp_extract("html", 'href="([^"]*)"', 1).alias("link")), "SELECT page_id, regexp_extract(html, 'href=\"([^\"]*)\"', 1) AS link FROM pages"),
    "f29_seed_match": (lambda s, d: table(s, d, "part").select("p_partkey", F.exists(F.array(F.lit("red"), F.lit("small blue")), lambda x: F.lower("p_name").contains(x) | x.contains(F.lower("p_name"))).cast("int").alias("seed")), "SELECT p_partkey, CASE WHEN contains(lower(p_name), 'red') OR contains('red', lower(p_name)) OR contains(lower(p_name), 'small blue') OR contains('small blue', lower(p_name)) THEN 1 ELSE 0 END AS seed FROM part"),
    "f30_dates": (lambda s, d: table(s, d, "orders").select("o_orderkey", F.date_format(F.date_add("o_orderdate", 1), "yyyy-MM-dd").alias("next_day"), F.date_format(F.date_sub("o_orderdate", 30), "yyyy-MM-dd").alias("from_day"), F.date_format("o_orderdate", "yyyy_MM").alias("month")), "SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE) + 1, '%Y-%m-%d') AS next_day, strftime(CAST(o_orderdate AS DATE) - 30, '%Y-%m-%d') AS from_day, strftime(o_orderdate, '%Y_%m') AS month FROM orders"),
    "f31_clean_title": (lambda s, d: table(s, d, "part").select("p_partkey", T.clean_title(F.concat(F.lit('"'), F.when(F.col("p_partkey") % 3 == 0, F.concat_ws(" ", "p_name", "p_name", "p_name")).otherwise(F.col("p_name")), F.lit('"')), F.lit("old")).alias("title")), "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'old' ELSE p_name END AS title FROM part"),
    "p15_noise_share": (
        lambda s, d: V.doc_lines(s, d).groupBy("session").agg((F.avg(((F.length("text") < 40) | F.lower("text").contains("hi")).cast("double")) > 0.6).cast("int").alias("noise")),
        f"WITH {V.DOC_LINES} SELECT session, CASE WHEN avg(CASE WHEN length(text) < 40 OR contains(lower(text), 'hi') THEN 1.0::DOUBLE ELSE 0 END) > 0.6 THEN 1 ELSE 0 END AS noise FROM doc_lines GROUP BY session",
    ),
    "p12_p16_membership": (lambda s, d: table(s, d, "part").where(F.col("p_brand").isin("Brand#11", "Brand#12", "Brand#21") | F.lower("p_type").rlike("steel|tin")).select("p_partkey"), "SELECT p_partkey FROM part WHERE p_brand IN ('Brand#11', 'Brand#12', 'Brand#21') OR regexp_matches(lower(p_type), 'steel|tin')"),
    "t10_cluster_sample": (
        lambda s, d: V.doc_lines(s, d).where("pos <= 10").select("session", "pos", F.substring("text", 1, 150).alias("text")),
        f"WITH {V.DOC_LINES} SELECT session, pos, substring(text, 1, 150) AS text FROM doc_lines WHERE pos <= 10",
    ),
}
