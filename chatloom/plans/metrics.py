"""Queries of session metrics, cohorts and suggested messages."""

from __future__ import annotations

from pyspark.sql import functions as F

from chatloom.functions import text as T
from chatloom.operators import bubbles as B
from chatloom.operators import metrics as M
from chatloom.plans import views as V
from chatloom.session import table

HOURS = """h AS (SELECT CAST(hour(ts + INTERVAL 330 MINUTE) AS BIGINT) AS hour_of_day, count(DISTINCT user_id) AS sessions FROM events GROUP BY 1)"""
_hourly = lambda s, d: M.hourly_sessions(table(s, d, "events"), "user_id", "ts", V.IST)

QUERIES = {
    "a1_totals": (lambda s, d: M.totals(V.events(s, d), "session"), f"WITH {V.EVENTS} SELECT count(DISTINCT session) AS sessions, count(*) AS messages FROM ev"),
    "a2_hourly_sessions": (_hourly, f"WITH {HOURS} SELECT * FROM h"),
    "a3_hourly_share": (
        lambda s, d: M.hourly_share(s, table(s, d, "events"), session="user_id", ts="ts", offset_minutes=V.IST),
        f"""WITH {HOURS}, z AS (SELECT CAST(r.range AS BIGINT) AS hour_of_day, coalesce(h.sessions, 0) AS sessions FROM range(24) r LEFT JOIN h ON h.hour_of_day = r.range)
        SELECT hour_of_day, sessions, round(coalesce(100.0::DOUBLE * sessions / nullif(sum(sessions) OVER (), 0), 0.0::DOUBLE), 4) AS share_pct,
               row_number() OVER (ORDER BY sessions DESC, hour_of_day) AS peak_rank FROM z""",
    ),
    "a4_after_hours": (lambda s, d: M.after_hours(_hourly(s, d)), f"WITH {HOURS} SELECT CAST(sum(sessions) FILTER (hour_of_day < 10 OR hour_of_day >= 19) AS BIGINT) AS after_hours_sessions, round(100.0::DOUBLE * sum(sessions) FILTER (hour_of_day < 10 OR hour_of_day >= 19) / sum(sessions), 2) AS after_hours_pct FROM h"),
    "a36_bar_scale": (lambda s, d: M.bar_scale(_hourly(s, d)), f"WITH {HOURS} SELECT hour_of_day, sessions, round(100.0::DOUBLE * sessions / max(sessions) OVER (), 2) AS bar_pct FROM h"),
    "a5_bubble_candidates": (lambda s, d: B.candidates(V.doc_lines(s, d), "text", 5), f"WITH {V.DOC_LINES} SELECT text, count(*) AS clicks FROM doc_lines GROUP BY text HAVING count(*) >= 5 AND len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) >= 3"),
    "a6_bubble_stats": (
        lambda s, d: B.stats(V.doc_lines(s, d)),
        f"""WITH {V.DOC_LINES}, c AS (SELECT text FROM doc_lines GROUP BY text HAVING count(*) >= 7 AND len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) >= 3),
        a AS (SELECT *, max(pos) OVER (PARTITION BY session) - pos AS after, row_number() OVER (PARTITION BY session, text ORDER BY pos) AS nth FROM doc_lines),
        o AS (SELECT * FROM a WHERE nth = 1 AND text IN (SELECT text FROM c)),
        g AS (SELECT text, count(*) AS clicks, round(avg(pos), 4) AS avg_click_position, round(avg(after), 4) AS avg_msgs_after_click, round(100 * avg(did_a2c), 4) AS did_a2c_pct, round(100 * avg(order_placed), 4) AS placed_order_pct FROM o GROUP BY text)
        SELECT *, round(100.0::DOUBLE * clicks / sum(clicks) OVER (), 4) AS clicks_pct FROM g""",
    ),
    "j6_without_bubbles": (
        lambda s, d: B.without(V.doc_lines(s, d), B.candidates(V.doc_lines(s, d), "text", 5), "text").groupBy("session").agg(F.count("*").alias("messages")),
        f"WITH {V.DOC_LINES}, c AS (SELECT text FROM doc_lines GROUP BY text HAVING count(*) >= 5 AND len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) >= 3) SELECT session, count(*) AS messages FROM doc_lines WHERE text NOT IN (SELECT text FROM c) GROUP BY session",
    ),
    "w3_messages_after": (lambda s, d: B.messages_after(V.chat(s, d), "session", "pos").select("session", "pos", "msgs_after"), f"WITH {V.CHAT} SELECT session, pos, max(pos) OVER (PARTITION BY session) - pos AS msgs_after FROM chat"),
    "w4_first_of_session": (lambda s, d: B.first_of_session(V.doc_lines(s, d), "session", "text", "pos").select("session", "pos"), f"WITH {V.DOC_LINES} SELECT session, min(pos) AS pos FROM doc_lines GROUP BY session, text"),
    "a7_distribution": (
        lambda s, d: M.distribution(table(s, d, "events"), "event_type", 0.05, 3),
        """WITH c AS (SELECT event_type AS value, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY 1), t AS (SELECT *, sum(n) OVER () AS total FROM c),
        k AS (SELECT value, n FROM t WHERE n >= 0.05::DOUBLE * total ORDER BY n DESC, value LIMIT 3) SELECT value, n, round(100.0::DOUBLE * n / sum(n) OVER (), 2) AS pct FROM k""",
    ),
    "a8_geo_cohort": (lambda s, d: M.cohort(table(s, d, "documents"), "lang", 5), "WITH c AS (SELECT lang AS value, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY 1), p AS (SELECT value, n, round(100.0::DOUBLE * n / sum(n) OVER (), 1) AS pct FROM c) SELECT * FROM p ORDER BY n DESC, value LIMIT 5"),
    "a9_utm_cohort": (
        lambda s, d: M.cohort(table(s, d, "documents").withColumn("utm", T.utm_value(F.concat(F.lit(" "), F.upper("source"), F.lit("  ")))), "utm", 3),
        "WITH c AS (SELECT lower(trim(source)) AS value, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY 1), p AS (SELECT value, n, round(100.0::DOUBLE * n / sum(n) OVER (), 1) AS pct FROM c) SELECT * FROM p ORDER BY n DESC, value LIMIT 3",
    ),
    "a10_share_table": (
        lambda s, d: M.distribution(table(s, d, "events").withColumn("kind", F.coalesce("event_type", F.lit("Unspecified"))), "kind", 0.05, 100),
        """WITH c AS (SELECT coalesce(event_type, 'Unspecified') AS value, count(*) AS n FROM events GROUP BY 1), t AS (SELECT *, sum(n) OVER () AS total FROM c), k AS (SELECT value, n FROM t WHERE n >= 0.05::DOUBLE * total)
        SELECT value, n, round(100.0::DOUBLE * n / sum(n) OVER (), 2) AS pct FROM k""",
    ),
    "a11_prompt_share": (lambda s, d: M.flag_share(table(s, d, "events"), F.col("event_type") == "click"), "SELECT count(*) AS n, round(100.0::DOUBLE * count(*) FILTER (event_type = 'click') / count(*), 2) AS prompt_pct, round(100 - round(100.0::DOUBLE * count(*) FILTER (event_type = 'click') / count(*), 2), 2) AS free_text_pct FROM events"),
    "a12_savings": (lambda s, d: M.savings(V.chat(s, d)), f"WITH {V.CHAT} SELECT round(count(*) * 3.79::DOUBLE, 2) AS money_saved, round(count(*) / 60.0::DOUBLE, 2) AS hours_saved FROM chat"),
    "a13_order_value": (
        lambda s, d: M.order_value(table(s, d, "orders"), "o_orderpriority", "o_totalprice", F.col("o_orderstatus") == "F"),
        "SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS orders, round(coalesce(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END) / nullif(count(*) FILTER (o_orderstatus = 'F'), 0), 0), 2) AS aov FROM orders GROUP BY 1",
    ),
    "a14_top_pages": (
        lambda s, d: M.top_pages(table(s, d, "pages"), F.element_at(F.split("url", "/"), 4), "page_id", "", 3),
        "SELECT string_split(url, '/')[4] AS page, count(DISTINCT page_id) AS sessions FROM pages GROUP BY 1 ORDER BY sessions DESC, page LIMIT 3",
    ),
}
