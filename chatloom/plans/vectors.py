"""Queries of matching, assignment and cluster quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from chatloom.functions.vectors import cosine, euclidean
from chatloom.operators import assign as A
from chatloom.operators import clusters as C
from chatloom.operators import density as D
from chatloom.operators import embed as E
from chatloom.operators import lexical as L
from chatloom.operators import projection as P
from chatloom.operators import vector_quality as Q
from chatloom.plans import views as V
from chatloom.session import table

#: Scaled to the synthetic vectors, so that every status occurs.
LOOSE = A.Thresholds(primary=0.28, gap=0.02, borderline=0.25)
SCORES = f"{V.VECTORS}, sc AS (SELECT message, theme, max(list_cosine_similarity(vm.v, vp.v)) AS score FROM vm, vp GROUP BY 1, 2)"
DECIDED = """rk AS (SELECT message, theme, round(score, 9) AS s, lead(round(score, 9)) OVER w AS second, row_number() OVER w AS nth FROM sc WINDOW w AS (PARTITION BY message ORDER BY round(score, 9) DESC, theme)),
    de AS (SELECT message, theme, s, coalesce(s - second, 1.0) AS gap, CASE WHEN s >= {p} AND round(coalesce(s - second, 1.0), 9) >= {g} THEN 'confident' WHEN s >= {b} THEN 'borderline' ELSE 'miscellaneous' END AS status FROM rk WHERE nth = 1)"""
_loose = DECIDED.format(p=0.28, g=0.02, b=0.25)
_strict = DECIDED.format(p=0.5, g=0.04, b=0.45)
_scores = lambda s, d: A.theme_scores(V.vec_messages(s, d), V.vec_phrases(s, d))
_clusters = lambda s, d: table(s, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").cast("long").alias("cluster"), F.col("embedding").alias("v"))
_texts = lambda s, d: table(s, d, "part").select(F.col("p_partkey").alias("message"), F.concat_ws(" ", "p_name", F.lower("p_type")).alias("text"))
TEXTS = "tx AS (SELECT p_partkey AS message, p_name || ' ' || lower(p_type) AS text FROM part)"
CL = "cl AS (SELECT vec_id AS id, CAST(label AS BIGINT) AS cluster, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"
BM25 = f"""{TEXTS}, {V.NAMES}, pw AS (SELECT phrase, list_filter(regexp_split_to_array(lower(phrase), '\\s+'), lambda w: w <> '') AS w FROM names),
    sz AS (SELECT count(*) AS n, avg(CAST(len(w) AS DOUBLE)) AS mean FROM pw), pt AS (SELECT phrase, len(w) AS dl, unnest(w) AS word FROM pw), tf AS (SELECT phrase, dl, word, count(*) AS tf FROM pt GROUP BY 1, 2, 3),
    idf AS (SELECT word, ln((n + 1) / count(*)) AS idf, mean FROM tf, sz GROUP BY word, n, mean),
    qw AS (SELECT message, unnest(list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda w: w <> '')) AS word FROM tx), q AS (SELECT message, qw.word, count(*) AS q, any_value(idf) AS idf, any_value(mean) AS mean FROM qw JOIN idf USING (word) GROUP BY 1, 2),
    bs AS (SELECT message, sum(q * idf) AS base FROM q GROUP BY 1), hit AS (SELECT message, phrase, sum(q * idf * (tf * 2.5 / (1.5 * (0.25 + 0.75 * dl / mean) + tf))) AS more FROM q JOIN tf USING (word) GROUP BY 1, 2),
    bm AS (SELECT tx.message, hit.phrase, coalesce(base, 0) AS base, coalesce(base, 0) + coalesce(more, 0) AS raw FROM tx LEFT JOIN bs USING (message) LEFT JOIN hit USING (message))"""


_themed = lambda s, d: V.product_names(s, d).select(F.ascii("theme").cast("long").alias("theme"), "phrase")
_signals = lambda s, d: L.signals(_texts(s, d), _themed(s, d))
MEET = A.Thresholds(primary=0.55, gap=0.02, borderline=0.5, rescue=0.7, rescue_norm=0.8, rescue_fusion=0.6)
_letters = lambda c: f"list_transform(string_split('a b c d e f g h i j k l m n o p q r s t u v w x y z', ' '), lambda z: CAST(len({c}) - len(replace({c}, z, '')) AS DOUBLE))"
_sorted = lambda c: f"array_to_string(list_sort(list_filter(regexp_split_to_array(lower({c}), '\\s+'), lambda z: z <> '')), ' ')"
LCS = "list_reduce(range(1, len(a) + 1), lambda row, i: list_reduce(range(1, len(b) + 1), lambda acc, j: list_append(acc, CASE WHEN a[i] = b[j] THEN row[j] + 1 ELSE greatest(row[j + 1], acc[j]) END), [0::BIGINT]), list_transform(range(0, len(b) + 1), lambda z: 0::BIGINT))[-1]"
#: The three signals of each different text and theme, in SQL; sg has them for each message.
SIGNALS = f"""{BM25}, dt AS (SELECT text, min(message) AS message FROM tx GROUP BY 1), th AS (SELECT phrase, CAST(ascii(theme) AS BIGINT) AS theme FROM names),
    cs AS (SELECT message, theme, phrase, list_cosine_similarity({_letters('lower(text)')}, {_letters('lower(phrase)')}) AS c FROM dt, th), bc AS (SELECT message, theme, max(c) AS cosine, arg_max(phrase, struct_pack(c := round(c, 9), p := -pos)) AS phrase
        FROM (SELECT *, row_number() OVER (PARTITION BY message, theme ORDER BY phrase) AS pos FROM cs) GROUP BY 1, 2),
    br AS (SELECT message, theme, max(raw) AS raw FROM bm JOIN th USING (phrase) GROUP BY 1, 2), bb AS (SELECT message, max(base) AS base FROM bm GROUP BY 1),
    lc AS (SELECT message, theme, {_sorted('text')} AS a, {_sorted('phrase')} AS b FROM dt, th), fz AS (SELECT message, theme, max(CASE WHEN a = '' AND b = '' THEN 1.0::DOUBLE ELSE 2.0::DOUBLE * {LCS} / (len(a) + len(b)) END) AS fuzzy FROM lc GROUP BY 1, 2),
    s0 AS (SELECT bc.message, bc.theme, bc.phrase, cosine, coalesce(br.raw, base) AS raw, fuzzy FROM bc JOIN bb USING (message) LEFT JOIN br ON br.message = bc.message AND br.theme = bc.theme JOIN fz ON fz.message = bc.message AND fz.theme = bc.theme),
    s1 AS (SELECT *, 1 / (1 + exp(-(raw - 3) / 2)) AS norm FROM s0),
    sg AS (SELECT tx.message, theme, phrase, cosine, raw, norm, fuzzy, 0.55::DOUBLE * cosine + 0.30::DOUBLE * norm + 0.15::DOUBLE * fuzzy AS fusion FROM s1 JOIN dt USING (message) JOIN tx ON tx.text = dt.text)"""
_meets = f"""rk AS (SELECT message, theme, phrase, round(fusion, 9) AS s, lead(round(fusion, 9)) OVER w AS second, row_number() OVER w AS nth FROM sg WINDOW w AS (PARTITION BY message ORDER BY round(fusion, 9) DESC, theme)),
    de AS (SELECT message, theme, phrase, s, CASE WHEN s >= 0.55 AND round(coalesce(s - second, 1.0), 9) >= 0.02 THEN 'confident' WHEN s >= 0.5 THEN 'borderline' ELSE 'miscellaneous' END AS status FROM rk WHERE nth = 1)"""


def _by_text(s, d, step):
    """What step finds in the signals, for every message; it looks at each different text once."""
    messages = _texts(s, d)
    texts, scores = L.text_signals(messages, _themed(s, d))
    return L.for_messages(messages, texts, step(scores.withColumn("score", F.col("fusion"))))


def _assigned(s, d):
    """Each message's theme by fusion, with the phrase of that theme that it is closest to."""
    return _by_text(s, d, lambda scores: A.decide(scores, MEET).join(scores.select("message", "theme", "phrase"), ["message", "theme"]))


def _density(vectors):
    return D.density_clusters(vectors, *D.sizes_for(vectors.count()))


_ids = lambda s, d: table(s, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))

QUERIES = {
    "f19_cosine": (lambda s, d: table(s, d, "embeddings").alias("a").join(table(s, d, "embeddings").alias("b"), F.expr("a.vec_id + 1 = b.vec_id")).select(F.col("a.vec_id").alias("vec_id"), F.round(cosine(F.col("a.embedding"), F.col("b.embedding")), 6).alias("cos")), "SELECT a.vec_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS cos FROM embeddings a JOIN embeddings b ON a.vec_id + 1 = b.vec_id"),
    "f20_euclidean": (lambda s, d: table(s, d, "embeddings").alias("a").join(table(s, d, "embeddings").alias("b"), F.expr("a.vec_id + 1 = b.vec_id")).select(F.col("a.vec_id").alias("vec_id"), F.round(euclidean(F.col("a.embedding"), F.col("b.embedding")), 6).alias("dist")), "SELECT a.vec_id, round(list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS dist FROM embeddings a JOIN embeddings b ON a.vec_id + 1 = b.vec_id"),
    "m1_theme_scores": (lambda s, d: _scores(s, d).select("message", "theme", F.round("score", 6).alias("score")), f"WITH {SCORES} SELECT message, theme, round(score, 6) AS score FROM sc"),
    "m5_decide": (lambda s, d: A.decide(_scores(s, d)).select("message", "theme", F.round("score", 6).alias("score"), F.round("gap", 6).alias("gap"), "status"), f"WITH {SCORES}, {_strict} SELECT message, CASE WHEN status = 'miscellaneous' THEN -1 ELSE theme END AS theme, round(s, 6) AS score, round(gap, 6) AS gap, status FROM de"),
    "m5_decide_loose": (lambda s, d: A.decide(_scores(s, d), LOOSE).select("message", "theme", F.round("score", 6).alias("score"), F.round("gap", 6).alias("gap"), "status"), f"WITH {SCORES}, {_loose} SELECT message, CASE WHEN status = 'miscellaneous' THEN -1 ELSE theme END AS theme, round(s, 6) AS score, round(gap, 6) AS gap, status FROM de"),
    "a29_status_counts": (lambda s, d: A.decide(_scores(s, d), LOOSE).groupBy("status").agg(F.count("*").alias("n")), f"WITH {SCORES}, {_loose} SELECT status, count(*) AS n FROM de GROUP BY status"),
    "m6_boosted": (
        lambda s, d: A.boosted(_scores(s, d), V.vec_messages(s, d).select("message", (F.col("message") % 10).alias("theme"))).select("message", "theme", F.round("score", 6).alias("score")),
        f"WITH {SCORES} SELECT message, theme, round(CASE WHEN theme = message % 10 THEN least(score + 0.25, 1.0) ELSE score END, 6) AS score FROM sc",
    ),
    "m7_reassigned": (
        lambda s, d: A.reassigned(A.decide(_scores(s, d), LOOSE), _scores(s, d), s.range(0, 9, 2).withColumnRenamed("id", "theme"), 0.26).select("message", "theme", "status", "moved"),
        f"""WITH {SCORES}, {_loose}, best AS (SELECT message, arg_max(theme, struct_pack(s := round(score, 9), t := -theme)) AS better FROM sc WHERE theme % 2 = 0 AND theme < 9 GROUP BY 1)
        SELECT message, CASE WHEN status = 'borderline' AND s > 0.26 THEN better WHEN status = 'miscellaneous' THEN -1 ELSE theme END AS theme, CASE WHEN status = 'borderline' AND s > 0.26 THEN 'confident' ELSE status END AS status,
        CASE WHEN status = 'borderline' AND s > 0.26 THEN 1 ELSE 0 END AS moved FROM de JOIN best USING (message)""",
    ),
    "a28_dissolve_small": (
        lambda s, d: A.dissolve_small(A.decide(_scores(s, d), LOOSE), 40).groupBy("theme", "status").agg(F.count("*").alias("n")),
        f"""WITH {SCORES}, {_loose}, th AS (SELECT message, CASE WHEN status = 'miscellaneous' THEN -1 ELSE theme END AS theme, status FROM de), sm AS (SELECT theme FROM th WHERE theme >= 0 GROUP BY 1 HAVING count(*) < 40)
        SELECT CASE WHEN theme IN (SELECT theme FROM sm) THEN -1 ELSE theme END AS theme, CASE WHEN theme IN (SELECT theme FROM sm) THEN 'borderline' ELSE status END AS status, count(*) AS n FROM th GROUP BY 1, 2""",
    ),
    "a27_coverage": (
        lambda s, d: A.decide(_scores(s, d), LOOSE).agg(F.round(100 * F.avg((F.col("status") == "confident").cast("double")), 2).alias("confident_pct"), F.round(100 * F.avg((F.col("theme") >= 0).cast("double")), 2).alias("assigned_pct")),
        f"WITH {SCORES}, {_loose} SELECT round(100 * avg(CASE WHEN status = 'confident' THEN 1.0::DOUBLE ELSE 0 END), 2) AS confident_pct, round(100 * avg(CASE WHEN status <> 'miscellaneous' THEN 1.0::DOUBLE ELSE 0 END), 2) AS assigned_pct FROM de",
    ),
    "m1_best_phrase": (
        lambda s, d: _scores(s, d).select("message", "theme", "phrase"),
        f"WITH {V.VECTORS}, c AS (SELECT message, theme, phrase, round(list_cosine_similarity(vm.v, vp.v), 9) AS c FROM vm, vp) SELECT message, theme, phrase FROM c QUALIFY row_number() OVER (PARTITION BY message, theme ORDER BY c DESC, phrase) = 1",
    ),
    "a27_quality_report": (
        lambda s, d: C.quality_report(A.decide(_scores(s, d), LOOSE), Q.coherence(_clusters(s, d))),
        f"""WITH {SCORES}, {_loose}, {CL}, p AS (SELECT a.cluster, list_cosine_similarity(a.v, b.v) AS c FROM cl a JOIN cl b ON a.cluster = b.cluster AND a.id < b.id), g AS (SELECT cluster, avg(c) * (1 - stddev_pop(c)) AS co FROM p GROUP BY 1)
        SELECT round(100 * avg(CASE WHEN status = 'confident' THEN 1.0::DOUBLE ELSE 0 END), 2) AS confident_pct, round(100 * avg(CASE WHEN status <> 'miscellaneous' THEN 1.0::DOUBLE ELSE 0 END), 2) AS assigned_pct, count(*) FILTER (status = 'miscellaneous') AS miscellaneous,
        count(DISTINCT CASE WHEN status <> 'miscellaneous' THEN theme END) AS themes, round((SELECT avg(co) FROM g), 6) AS mean_coherence FROM de""",
    ),
    "m2_best_bm25": (lambda s, d: L.best_bm25(_texts(s, d), V.product_names(s, d)).select("message", F.round("raw", 6).alias("raw")), f"WITH {BM25} SELECT message, round(max(raw), 6) AS raw FROM bm GROUP BY 1"),
    "m2_bm25plus": (lambda s, d: _signals(s, d).select("message", "theme", F.round("raw", 6).alias("raw")), f"WITH {SIGNALS} SELECT message, theme, round(raw, 6) AS raw FROM sg"),
    "m3_token_sort_ratio": (lambda s, d: _signals(s, d).select("message", "theme", F.round("fuzzy", 6).alias("fuzzy")), f"WITH {SIGNALS} SELECT message, theme, round(fuzzy, 6) AS fuzzy FROM sg"),
    "m4_fusion": (
        lambda s, d: _signals(s, d).select("message", "theme", "phrase", *(F.round(c, 6).alias(c) for c in ("cosine", "norm", "fuzzy", "fusion"))),
        f"WITH {SIGNALS} SELECT message, theme, phrase, round(cosine, 6) AS cosine, round(norm, 6) AS norm, round(fuzzy, 6) AS fuzzy, round(fusion, 6) AS fusion FROM sg",
    ),
    "m5_decide_fused": (lambda s, d: _by_text(s, d, lambda scores: A.decide(scores, MEET)).select("message", "theme", "status"), f"WITH {SIGNALS}, {_meets} SELECT message, CASE WHEN status = 'miscellaneous' THEN -1 ELSE theme END AS theme, status FROM de"),
    "m9_rescued": (
        lambda s, d: _by_text(s, d, lambda scores: A.rescued(scores, MEET)),
        f"WITH {SIGNALS} SELECT message, arg_max(theme, struct_pack(f := round(fusion, 9), t := -theme)) AS theme FROM sg WHERE raw <> 0 AND (fusion > 0.7 OR (norm > 0.8 AND fusion > 0.6)) GROUP BY 1",
    ),
    "a31_phrase_matches": (lambda s, d: L.phrase_matches(_assigned(s, d)), f"WITH {SIGNALS}, {_meets} SELECT theme, phrase, count(*) AS n FROM de WHERE status <> 'miscellaneous' GROUP BY 1, 2"),
    "m6_intent_boost": (
        lambda s, d: A.intent_boost(_scores(s, d), V.vec_messages(s, d).select("message", (F.col("message") % 10).alias("theme"))),
        f"""WITH {SCORES}, b AS (SELECT message, theme, score, CASE WHEN theme = message % 10 THEN least(score + 0.25, 1.0) ELSE score END AS boosted FROM sc)
        SELECT message, arg_max(theme, struct_pack(s := round(boosted, 9), t := -theme)) AS theme, arg_max(theme, struct_pack(s := round(score, 9), t := -theme)) AS before FROM b GROUP BY 1""",
    ),
    "m8_intent_rescue": (
        lambda s, d: A.intent_rescue(A.decide(_scores(s, d), LOOSE), _scores(s, d), V.vec_messages(s, d).select("message", (F.col("message") % 10).alias("theme")), 3.0, 0.2),
        f"WITH {SCORES}, {_loose} SELECT sc.message, sc.theme FROM sc JOIN de USING (message) WHERE status = 'miscellaneous' AND sc.theme = message % 10 AND round(score * 3.0, 9) >= 0.2",
    ),
    "a23_centroids": (
        lambda s, d: Q.centroids(_clusters(s, d)).select("cluster", "n", F.posexplode("centroid").alias("pos", "x")).select("cluster", "n", F.col("pos").cast("long").alias("pos"), F.round("x", 6).alias("x")),
        f"WITH {CL}, l AS (SELECT cluster, unnest(v) AS x, unnest(range(len(v))) AS pos FROM cl) SELECT cluster, count(*) AS n, pos, round(avg(x), 6) AS x FROM l GROUP BY cluster, pos",
    ),
    "a24_coherence": (
        lambda s, d: Q.coherence(_clusters(s, d)).select("cluster", "n", F.round("coherence", 6).alias("coherence")),
        f"WITH {CL}, p AS (SELECT a.cluster, list_cosine_similarity(a.v, b.v) AS c FROM cl a JOIN cl b ON a.cluster = b.cluster AND a.id < b.id), g AS (SELECT cluster, avg(c) * (1 - stddev_pop(c)) AS co FROM p GROUP BY 1) SELECT cl.cluster, count(*) AS n, round(coalesce(any_value(co), 1.0), 6) AS coherence FROM cl LEFT JOIN g ON g.cluster = cl.cluster GROUP BY 1",
    ),
    "a24_mean_cosine": (
        lambda s, d: Q.mean_cosine(_clusters(s, d)).select("cluster", "n", F.round("mean_cosine", 6).alias("mean_cosine")),
        f"WITH {CL}, p AS (SELECT a.cluster, avg(list_cosine_similarity(a.v, b.v)) AS c FROM cl a JOIN cl b ON a.cluster = b.cluster AND a.id < b.id GROUP BY 1) SELECT cl.cluster, count(*) AS n, round(coalesce(any_value(c), 1.0), 6) AS mean_cosine FROM cl LEFT JOIN p ON p.cluster = cl.cluster GROUP BY 1",
    ),
    "a26_silhouette": (
        lambda s, d: Q.silhouette_report(_clusters(s, d)),
        f"""WITH {CL}, di AS (SELECT a.id, a.cluster, b.cluster AS other, avg(1 - list_cosine_similarity(a.v, b.v)) AS d FROM cl a JOIN cl b ON a.id <> b.id GROUP BY 1, 2, 3),
        s AS (SELECT id, cluster, max(d) FILTER (other = cluster) AS a, min(d) FILTER (other <> cluster) AS b FROM di GROUP BY 1, 2), x AS (SELECT cluster, coalesce((b - a) / greatest(a, b), 0) AS si FROM s)
        SELECT cluster, count(*) AS n, round(avg(si), 6) AS avg_silhouette, round(avg(CASE WHEN round(si, 9) > 0 THEN 1.0::DOUBLE ELSE 0 END), 4) AS positive_share FROM x GROUP BY 1""",
    ),
    "a25_dispersion": (
        lambda s, d: Q.dispersion(_clusters(s, d)),
        f"""WITH {CL}, l AS (SELECT cluster, unnest(v) AS x, unnest(range(len(v))) AS pos FROM cl), ce AS (SELECT cluster, pos, avg(x) AS x FROM l GROUP BY 1, 2), cv AS (SELECT cluster, list(x ORDER BY pos) AS c FROM ce GROUP BY 1),
        d AS (SELECT cl.cluster, list_distance(v, c) AS d FROM cl JOIN cv USING (cluster)), st AS (SELECT cluster, quantile_cont(d, 0.25) AS q1, quantile_cont(d, 0.75) AS q3, stddev_pop(d) / avg(d) AS cv FROM d GROUP BY 1)
        SELECT cluster, round(any_value(q1), 6) AS q1, round(any_value(q3), 6) AS q3, round(any_value(cv), 6) AS cv, count(*) FILTER (round(d, 9) > round(q3 + 0.5 * (q3 - q1), 9)) AS outliers FROM d JOIN st USING (cluster) GROUP BY 1""",
    ),
    "j12_similar_themes": (
        lambda s, d: Q.similar_pairs(Q.centroids(_clusters(s, d)), 0.0).select("a", "b", F.round("similarity", 6).alias("similarity")),
        f"""WITH {CL}, l AS (SELECT cluster, unnest(v) AS x, unnest(range(len(v))) AS pos FROM cl), ce AS (SELECT cluster, pos, avg(x) AS x FROM l GROUP BY 1, 2), cv AS (SELECT cluster, list(x ORDER BY pos) AS c FROM ce GROUP BY 1)
        SELECT a.cluster AS a, b.cluster AS b, round(list_cosine_similarity(a.c, b.c), 6) AS similarity FROM cv a JOIN cv b ON a.cluster < b.cluster WHERE round(list_cosine_similarity(a.c, b.c), 9) >= 0""",
    ),
    "m16_local_outliers": (lambda s, d: Q.local_outliers(_clusters(s, d)), None),  # tested against brute force
    "m15_projected": (lambda s, d: P.projected(_ids(s, d), 8).select("id", F.transform("v", lambda x: F.round(x, 6)).alias("v")), None),  # tested by trustworthiness
    "t7_density_chain": (lambda s, d: P.density_chain(_ids(s, d), 60, 8), None),  # tested against plain Python
    "m25_text_vectors": (lambda s, d: E.text_vectors(table(s, d, "documents").select(F.col("doc_id").alias("id"), "text"), 64).select("id", F.transform("v", lambda x: F.round(x, 6)).alias("v")), None),  # tested by planted paraphrases
    "m17_density_clusters": (lambda s, d: _density(_clusters(s, d).select("id", "v")), None),  # tested against plain Python over the whole table
}
