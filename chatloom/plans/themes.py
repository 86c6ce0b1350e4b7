"""Queries of themes, labels and samples, over rows with odd cases derived from the tables, and over vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from chatloom.functions import text as T
from chatloom.operators import labels as B
from chatloom.operators import sampling as S
from chatloom.operators import themes as H
from chatloom.operators.graph import checkpointed
from chatloom.plans import views as V
from chatloom.plans.fixtures import frame, values
from chatloom.session import table
from chatloom.sources.tables import assembled

_merges = lambda s, d: H.merge_map(H.redundant(frame(s, d, "alike")), frame(s, d, "themes").select("theme", "n"))
_joined = lambda c: F.array_join(F.coalesce(c, F.array().cast("array<string>")), ",")
MERGES = """pr AS (SELECT a, b FROM alike WHERE similarity >= 0.65), bo AS (SELECT a, b FROM pr UNION SELECT b, a FROM pr),
    re AS (WITH RECURSIVE r(a, b) AS (SELECT a, a FROM bo UNION SELECT r.a, bo.b FROM r JOIN bo ON r.b = bo.a) SELECT * FROM r),
    mg AS (SELECT re.a AS theme, arg_max(re.b, struct_pack(n := t.n, t := -re.b)) AS canonical FROM re JOIN themes t ON t.theme = re.b GROUP BY 1)"""
_metas = lambda s, d: B.valid_metas(frame(s, d, "meta_groups"), B.group_distances(frame(s, d, "labels_of"), frame(s, d, "label_groups")))
_used = lambda s, d: B.without_conflicts(_metas(s, d), frame(s, d, "meta_groups"))
_first = lambda s, d: B.first_round(frame(s, d, "labels_of").select("label", "n"), frame(s, d, "label_groups"), frame(s, d, "meta_groups"), _used(s, d))
_second = lambda s, d: B.second_round(frame(s, d, "labels_of"), B.known_suggestions(frame(s, d, "suggested"), frame(s, d, "labels_of")), ["price"])
DISTANCES = """ce AS (SELECT grp, avg(v[1]) AS x, avg(v[2]) AS y FROM label_groups JOIN labels_of USING (label) GROUP BY 1), di AS (SELECT p.grp AS a, q.grp AS b, round(sqrt((p.x - q.x) ** 2 + (p.y - q.y) ** 2), 9) AS d FROM ce p JOIN ce q ON p.grp < q.grp)"""
VALID = f"""{DISTANCES}, mp AS (SELECT p.meta, d FROM meta_groups p JOIN meta_groups q ON p.meta = q.meta AND p.grp < q.grp JOIN di ON a = p.grp AND b = q.grp), va AS (SELECT meta, round(avg(d), 9) AS average FROM mp GROUP BY 1 HAVING max(d) <= (SELECT quantile_cont(d, 0.5) * 1.02 FROM di))"""
SECOND = """lo AS (SELECT label AS low, v AS a FROM labels_of WHERE n < 5), rg AS (SELECT label AS target, v AS b FROM labels_of WHERE n >= 5 AND label <> 'price'),
    pd AS (SELECT low, target, round(1 - list_cosine_similarity(a, b), 9) AS d FROM lo, rg), ok AS (SELECT low, target FROM pd JOIN suggested USING (low, target) WHERE d <= (SELECT round(quantile_cont(d, 0.5), 9) FROM pd) QUALIFY row_number() OVER (PARTITION BY low ORDER BY d, target) = 1),
    se AS (SELECT lo.low, ok.target FROM lo LEFT JOIN ok ON ok.low = lo.low)"""
_batch = lambda s, d, rest: frame(s, d, "themes").where(F.col("theme") % 2 == rest).select("name", "phrases", "examples")
_named = lambda s, d, c: frame(s, d, "themes").select(F.col("theme").alias(f"t{c}"), F.col("name").alias(f"n{c}"))
_pairs = lambda s, d: H.redundant(frame(s, d, "alike")).where("a % 2 = 1 and b % 2 = 0").join(_named(s, d, "a"), F.col("a") == F.col("ta")).join(_named(s, d, "b"), F.col("b") == F.col("tb")).select(F.col("na").alias("a"), F.col("nb").alias("b"))
_seeds = lambda s, d: frame(s, d, "themes").where("theme % 9 = 0").select(F.upper("name").alias("name"))
JOINED = """b1 AS (SELECT name, phrases, examples FROM themes WHERE theme % 2 = 1), b2 AS (SELECT name, phrases, examples FROM themes WHERE theme % 2 = 0),
    pr AS (SELECT x.name AS a, y.name AS b FROM alike JOIN themes x ON x.theme = a JOIN themes y ON y.theme = b WHERE similarity >= 0.65 AND a % 2 = 1 AND b % 2 = 0 AND a % 9 <> 0 AND b % 9 <> 0),
    al AS (SELECT name, 0 AS o, '' AS b, phrases, examples FROM b1 WHERE name IN (SELECT a FROM pr) UNION ALL SELECT pr.a, 1, pr.b, phrases, examples FROM pr JOIN b2 ON b2.name = pr.b),
    p1 AS (SELECT name, o, b, unnest(phrases) AS x, unnest(range(len(phrases))) AS i FROM al), p2 AS (SELECT * FROM p1 QUALIFY row_number() OVER (PARTITION BY name, lower(trim(x)) ORDER BY o, b, i) = 1),
    p3 AS (SELECT name, string_agg(x, ',' ORDER BY o, b, i) AS phrases FROM (SELECT * FROM p2 QUALIFY row_number() OVER (PARTITION BY name ORDER BY o, b, i) <= 12) GROUP BY 1),
    e1 AS (SELECT name, o, b, unnest(examples) AS x, unnest(range(len(examples))) AS i FROM al), e2 AS (SELECT * FROM e1 QUALIFY row_number() OVER (PARTITION BY name, x ORDER BY o, b, i) = 1),
    e3 AS (SELECT name, string_agg(x, ',' ORDER BY o, b, i) AS examples FROM (SELECT * FROM e2 QUALIFY row_number() OVER (PARTITION BY name ORDER BY o, b, i) <= 4) GROUP BY 1)
    SELECT name, p3.phrases, e3.examples FROM p3 JOIN e3 USING (name) UNION ALL SELECT name, array_to_string(phrases, ','), array_to_string(examples, ',') FROM (SELECT * FROM b1 WHERE name NOT IN (SELECT a FROM pr) UNION ALL SELECT * FROM b2 WHERE name NOT IN (SELECT b FROM pr))"""
USED = f"""{VALID}, ra AS (SELECT meta, row_number() OVER (ORDER BY average, meta) AS k FROM va), gs AS (SELECT k, ra.meta, list(grp) AS g FROM ra JOIN meta_groups m ON m.meta = ra.meta GROUP BY 1, 2),
    us AS (WITH RECURSIVE r(k, used, claimed) AS (SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[]), CAST([] AS BIGINT[]) UNION ALL SELECT gs.k, CASE WHEN list_has_any(claimed, g) THEN used ELSE list_append(used, gs.meta) END, CASE WHEN list_has_any(claimed, g) THEN claimed ELSE list_concat(claimed, g) END FROM r JOIN gs ON gs.k = r.k + 1) SELECT unnest(used) AS meta FROM (SELECT used FROM r ORDER BY k DESC LIMIT 1))"""
FIRST = f"""{USED}, um AS (SELECT grp, meta FROM meta_groups JOIN us USING (meta)), fi AS (SELECT label, coalesce(-um.meta - 1, g.grp) AS f FROM label_groups g LEFT JOIN um USING (grp)),
    bs AS (SELECT f, arg_min(label, struct_pack(n := -n, l := label)) AS canonical FROM fi JOIN labels_of USING (label) GROUP BY 1), fr AS (SELECT label AS old, canonical FROM fi JOIN bs USING (f) WHERE label <> canonical)"""
_has = lambda c, words: "(" + " OR ".join(f"contains({c}, '{w}')" for w in words) + ")"
NOISE = f"""gr AS (SELECT theme, avg(CASE WHEN length(trim(text)) <= 3 OR {_has('lower(text)', T.NOISE_TEXTS)} THEN 1.0::DOUBLE ELSE 0 END) AS g FROM assigned GROUP BY 1),
    no AS (SELECT t.theme FROM themes t LEFT JOIN gr ON gr.theme = t.theme WHERE regexp_matches(lower(name || ' ' || description), '{"|".join(T.NOISE_PATTERNS)}') OR ({_has('lower(name)', T.NOISE_TITLES)} AND coalesce(g, 0) > 0.6))"""
_asked = lambda s, d: V.chat(s, d).where("actor = 'customer' and text is not null").select((F.col("session") * 100_000 + F.col("pos")).alias("message"), "text")
_strata = lambda s, d: table(s, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").cast("long").alias("cluster"), F.round(F.abs(F.element_at("embedding", 1)).cast("double"), 9).alias("distance"))
STRATA = "st AS (SELECT vec_id AS id, CAST(label AS BIGINT) AS cluster, round(CAST(abs(embedding[1]) AS DOUBLE), 9) AS distance FROM embeddings)"
_noisy = lambda s, d: table(s, d, "embeddings").select(F.col("vec_id").alias("id"), (F.col("label").cast("long") - 2).alias("label"))
QUOTAS = """nl AS (SELECT vec_id AS id, CAST(label AS BIGINT) - 2 AS label FROM embeddings), sz AS (SELECT label, count(*) AS n FROM nl GROUP BY 1), q1 AS (SELECT label, n, least(n, greatest(floor(60.0::DOUBLE * n / (SELECT sum(n) FROM sz)), CASE WHEN label >= 0 THEN 3 ELSE 2 END)) AS q FROM sz),
    qu AS (SELECT label, n, CAST(CASE WHEN (SELECT sum(q) FROM q1) > 60 THEN greatest(1, floor(q * (60.0::DOUBLE / (SELECT sum(q) FROM q1)))) ELSE q END AS BIGINT) AS quota FROM q1)"""



def _history(s, d):
    first, second = checkpointed(_first(s, d)), checkpointed(_second(s, d))
    final = frame(s, d, "labels_of").where("n >= 5").join(first, F.col("label") == F.col("old"), "left_anti").select("label")
    return B.merge_history(final, first, second, B.split_multiple(frame(s, d, "concern_messages"), "concern")[1].select(F.col("concern").alias("label")).distinct())


QUERIES = {
    "m12_redundant": (lambda s, d: H.redundant(frame(s, d, "alike")), f"WITH {values('alike')} SELECT a, b FROM alike WHERE similarity >= 0.65"),
    "m13_merge_map": (lambda s, d: _merges(s, d), f"WITH {values('alike', 'themes')}, {MERGES} SELECT theme, canonical FROM mg"),
    "m13_u4_merged_themes": (
        lambda s, d: H.merge_themes(frame(s, d, "themes"), _merges(s, d)).select("theme", "name", _joined(F.col("phrases")).alias("phrases"), "merged"),
        f"""WITH {values('alike', 'themes')}, {MERGES}, al AS (SELECT t.theme, coalesce(canonical, t.theme) AS c, phrases FROM themes t LEFT JOIN mg ON mg.theme = t.theme), ph AS (SELECT c, theme, unnest(phrases) AS p, unnest(range(len(phrases))) AS i FROM al),
        fp AS (SELECT c, p, min(struct_pack(o := c <> theme, t := theme, i := i)) AS k FROM ph GROUP BY 1, 2), jo AS (SELECT c, string_agg(p, ',' ORDER BY k) AS phrases FROM fp GROUP BY 1), ct AS (SELECT c, count(*) - 1 AS merged FROM al GROUP BY 1)
        SELECT t.theme, t.name, coalesce(jo.phrases, '') AS phrases, ct.merged FROM ct JOIN themes t ON t.theme = ct.c LEFT JOIN jo ON jo.c = ct.c""",
    ),
    "m13_reassigned": (
        lambda s, d: H.reassign(frame(s, d, "assigned"), _merges(s, d)).groupBy("theme").agg(F.count("*").alias("n")),
        f"WITH {values('alike', 'themes', 'assigned')}, {MERGES} SELECT coalesce(canonical, a.theme) AS theme, count(*) AS n FROM assigned a LEFT JOIN mg ON mg.theme = a.theme GROUP BY 1",
    ),
    "u2_u3_joined_batches": (
        lambda s, d: H.join_batches(_batch(s, d, 1), _batch(s, d, 0), _pairs(s, d), _seeds(s, d)).select("name", _joined(F.col("phrases")).alias("phrases"), _joined(F.col("examples")).alias("examples")),
        f"WITH {values('themes', 'alike')}, {JOINED}",
    ),
    "m11_word_run_themes": (
        lambda s, d: H.word_run_themes(table(s, d, "part").select(F.col("p_partkey").alias("message"), F.concat_ws(" ", "p_name", "p_type").alias("text")), 2, 5).select("name", _joined(F.col("phrases")).alias("phrases"), "messages"),
        """WITH ms AS (SELECT p_partkey AS message, string_split(lower(p_name || ' ' || p_type), ' ') AS w FROM part), rn AS (SELECT DISTINCT message, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS phrase FROM ms),
        pn AS (SELECT phrase, count(*) AS n FROM rn GROUP BY 1 HAVING count(*) >= 2), wd AS (SELECT DISTINCT message, unnest(w) AS word FROM ms), df AS (SELECT word, count(*) AS df FROM wd GROUP BY 1), pw AS (SELECT DISTINCT phrase, n, unnest(string_split(phrase, ' ')) AS word FROM pn),
        ow AS (SELECT phrase, n, word AS name FROM pw JOIN df USING (word) QUALIFY row_number() OVER (PARTITION BY phrase ORDER BY df DESC, word) = 1), ss AS (SELECT name, count(DISTINCT message) AS messages FROM rn JOIN ow USING (phrase) GROUP BY 1),
        ls AS (SELECT name, string_agg(phrase, ',' ORDER BY n DESC, phrase) AS phrases FROM (SELECT * FROM ow QUALIFY row_number() OVER (PARTITION BY name ORDER BY n DESC, phrase) <= 12) GROUP BY 1)
        SELECT name, phrases, messages FROM ss JOIN ls USING (name) ORDER BY messages DESC, name LIMIT 5""",
    ),
    "m11_u2_themes_in_batches": (lambda s, d: H.fold_batches(H.batch_themes(H.numbered_batches(_asked(s, d), 200), 2, 30, least_phrases=3), ["the"]).select("name", _joined(F.col("phrases")).alias("phrases"), _joined(F.col("examples")).alias("examples"), "messages", "batches"), None),  # tested against a plain fold
    "j18_titled": (
        lambda s, d: H.titled(frame(s, d, "assigned"), frame(s, d, "themes")).select("message", "title"),
        f"""WITH {values('themes', 'assigned')}, bp AS (SELECT phrase, arg_max(name, theme) AS name FROM (SELECT theme, name, unnest(phrases) AS phrase FROM themes) GROUP BY 1)
        SELECT message, CASE WHEN a.theme >= 0 THEN t.name ELSE bp.name END AS title FROM assigned a LEFT JOIN themes t ON t.theme = a.theme LEFT JOIN bp ON bp.phrase = a.phrase""",
    ),
    "p17_matched_phrases": (
        lambda s, d: H.matched_phrases(frame(s, d, "themes"), frame(s, d, "assigned").where("theme >= 0 and phrase is not null").groupBy("theme", "phrase").agg(F.count("*").alias("n"))),
        f"WITH {values('themes', 'assigned')}, p AS (SELECT theme, unnest(phrases) AS phrase FROM themes) SELECT theme, phrase, count(*) AS n FROM assigned JOIN p USING (theme, phrase) GROUP BY 1, 2",
    ),
    "p15_noise_themes": (lambda s, d: H.noise_themes(frame(s, d, "themes"), frame(s, d, "assigned")), f"WITH {values('themes', 'assigned')}, {NOISE} SELECT theme FROM no"),
    "p18_presales_significant": (
        lambda s, d: frame(s, d, "themes").where(T.sales_stage(F.col("name"), F.col("description")) == "pre-sales").where("n >= 25").select("theme"),
        f"WITH {values('themes')} SELECT theme FROM themes WHERE n >= 25 AND NOT {_has(chr(39).join(['lower(name || ', ' ', ' || description)']), T.POST_SALES)}",
    ),
    "p22_f27_customer_report": (
        lambda s, d: H.customer_report(frame(s, d, "themes").withColumn("order_pct", F.col("n") / 10.0).withColumn("sessions", F.col("n") * 2), H.noise_themes(frame(s, d, "themes"), frame(s, d, "assigned")), 200, 2.5),
        f"WITH {values('themes', 'assigned')}, {NOISE} SELECT theme, name, n, round(100.0::DOUBLE * n / 200, 2) AS share_pct, round(n / 10.0::DOUBLE - 2.5, 4) AS difference, row_number() OVER (ORDER BY n DESC, theme) AS place, CAST(sum(n * 2) OVER () AS BIGINT) AS shown FROM themes WHERE theme NOT IN (SELECT theme FROM no)",
    ),
    "p23_debug_report": (
        lambda s, d: H.debug_report(frame(s, d, "assigned").groupBy("theme").agg(F.count("*").alias("n"))),
        f"WITH {values('assigned')} SELECT theme, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 2) AS share_pct, CASE WHEN theme >= 0 THEN 'theme' ELSE 'miscellaneous' END AS kind FROM assigned GROUP BY theme",
    ),
    "k12_borderline_lines": (
        lambda s, d: H.borderline_lines(frame(s, d, "assigned"), frame(s, d, "themes")),
        f"WITH {values('assigned', 'themes')} SELECT message, printf('%s | %s %.4f | %s %.4f | gap %.4f', text, coalesce(t.name, 'Unknown'), best, coalesce(u.name, 'Unknown'), second, best - second) AS line FROM assigned a LEFT JOIN themes t ON t.theme = a.theme LEFT JOIN themes u ON u.theme = a.second_theme WHERE was_borderline = 1",
    ),
    "k12_miscellaneous": (lambda s, d: frame(s, d, "assigned").where("theme = -1").select("message", "text"), f"WITH {values('assigned')} SELECT message, text FROM assigned WHERE theme = -1"),
    # labels
    "j14_group_distances": (lambda s, d: B.group_distances(frame(s, d, "labels_of"), frame(s, d, "label_groups")), f"WITH {values('labels_of', 'label_groups')}, {DISTANCES} SELECT * FROM di"),
    "m19_valid_metas": (lambda s, d: _metas(s, d), f"WITH {values('labels_of', 'label_groups', 'meta_groups')}, {VALID} SELECT * FROM va"),
    "u6_without_conflicts": (lambda s, d: _used(s, d), f"WITH {values('labels_of', 'label_groups', 'meta_groups')}, {USED} SELECT meta FROM us"),
    "m19_first_round": (lambda s, d: _first(s, d), f"WITH {values('labels_of', 'label_groups', 'meta_groups')}, {FIRST} SELECT old, canonical FROM fr"),
    "u5_merged_tags": (
        lambda s, d: B.merged_tags(frame(s, d, "concern_messages"), "concern", _first(s, d), "id"),
        f"""WITH {values('labels_of', 'label_groups', 'meta_groups', 'concern_messages')}, {FIRST}, tl AS (SELECT id, CASE WHEN concern LIKE '[%' AND json_valid(concern) THEN from_json(concern, '["VARCHAR"]') ELSE [concern] END AS ts FROM concern_messages), tt AS (SELECT id, unnest(ts) AS tag FROM tl),
        tm AS (SELECT id, list_sort(list(DISTINCT coalesce(canonical, tag)) FILTER (tag IS NOT NULL)) AS ts FROM tt LEFT JOIN fr ON old = tag GROUP BY 1) SELECT id, CASE WHEN len(ts) = 1 THEN ts[1] WHEN len(ts) > 1 THEN '["' || array_to_string(ts, '", "') || '"]' END AS label FROM tm""",
    ),
    "m21_by_size": (lambda s, d: B.by_size(frame(s, d, "labels_of")).select("label", "kind"), f"WITH {values('labels_of')} SELECT label, CASE WHEN n < 5 THEN 'low_frequency' ELSE 'regular' END AS kind FROM labels_of"),
    "p21_known_suggestions": (lambda s, d: B.known_suggestions(frame(s, d, "suggested"), frame(s, d, "labels_of")), f"WITH {values('suggested', 'labels_of')} SELECT low, target FROM suggested WHERE low IN (SELECT label FROM labels_of WHERE n < 5) AND target IN (SELECT label FROM labels_of WHERE n >= 5)"),
    "j15_m20_second_round": (lambda s, d: _second(s, d), f"WITH {values('suggested', 'labels_of')}, {SECOND} SELECT low, target FROM se"),
    "a35_merge_history": (
        lambda s, d: _history(s, d),
        f"""WITH {values('suggested', 'labels_of', 'label_groups', 'meta_groups', 'concern_messages')}, {FIRST}, {SECOND}, fl AS (SELECT label FROM labels_of WHERE n >= 5 AND label NOT IN (SELECT old FROM fr)),
        r1 AS (SELECT canonical AS label, list(old ORDER BY old) AS l FROM fr GROUP BY 1), r2 AS (SELECT target AS label, list(low ORDER BY low) AS l FROM se WHERE target IS NOT NULL GROUP BY 1)
        SELECT fl.label AS name, 1 + coalesce(len(r1.l), 0) + coalesce(len(r2.l), 0) AS labels, array_to_string(list_concat([fl.label], list_concat(coalesce(r1.l, []), coalesce(r2.l, []))), ', ') AS originals,
        CASE WHEN r1.l IS NOT NULL AND r2.l IS NOT NULL THEN 'Round 1 + Round 2 Merge' WHEN r1.l IS NOT NULL THEN 'Round 1 Merge' WHEN r2.l IS NOT NULL THEN 'Round 2 Merge' ELSE 'No Merge' END AS kind FROM fl LEFT JOIN r1 ON r1.label = fl.label LEFT JOIN r2 ON r2.label = fl.label
        UNION ALL SELECT '[DELETED]', 0, low, 'Round 2 Deleted' FROM se WHERE target IS NULL
        UNION ALL SELECT '[REMOVED]', 0, concern, 'Multi-tag Removed' FROM (SELECT DISTINCT concern FROM concern_messages WHERE json_valid(concern) AND json_array_length(concern) > 1)""",
    ),
    "a30_status_counts": (lambda s, d: B.status_counts(frame(s, d, "history")), f"WITH {values('history')} SELECT status, step, count(DISTINCT label) AS n FROM history GROUP BY 1, 2"),
    "p13_single_labels": (lambda s, d: B.split_multiple(frame(s, d, "concern_messages"), "concern")[0].select("id"), f"WITH {values('concern_messages')} SELECT id FROM concern_messages WHERE concern IS NULL OR NOT json_valid(concern) OR json_array_length(concern) < 2"),
    "p13_multi_label": (lambda s, d: B.split_multiple(frame(s, d, "concern_messages"), "concern")[1].select("id"), f"WITH {values('concern_messages')} SELECT id FROM concern_messages WHERE json_valid(concern) AND json_array_length(concern) > 1"),
    "a17_a33_atomic_labels": (
        lambda s, d: B.atomic_counts(frame(s, d, "concern_messages"), "concern", "id").select("label", "n", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids")),
        f"""WITH {values('concern_messages')}, l AS (SELECT id, CASE WHEN json_valid(concern) THEN unnest(from_json(concern, '["VARCHAR"]')) ELSE concern END AS label FROM concern_messages WHERE concern IS NOT NULL AND json_valid(concern) UNION ALL SELECT id, concern FROM concern_messages WHERE NOT json_valid(concern))
        SELECT label, count(*) AS n, array_to_string(list_sort(list(DISTINCT id)), ',') AS ids FROM l GROUP BY 1""",
    ),
    # samples
    "t7_density_quotas": (lambda s, d: S.density_quotas(_noisy(s, d).groupBy("label").agg(F.count("*").alias("n")), 60), f"WITH {QUOTAS} SELECT * FROM qu"),
    "t7_density_sample": (
        lambda s, d: S.density_sample(_noisy(s, d), 60),
        f"""WITH {QUOTAS}, rk AS (SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || id), id) AS k FROM nl), ch AS (SELECT id, label FROM rk JOIN qu USING (label) WHERE k <= quota),
        ad AS (SELECT id, label FROM nl WHERE id NOT IN (SELECT id FROM ch) ORDER BY md5('42:' || id), id LIMIT (SELECT greatest(0, 60 - count(*)) FROM ch)) SELECT id, label FROM (SELECT * FROM ch UNION ALL SELECT * FROM ad) ORDER BY id LIMIT 60""",
    ),
    "t6_stratified_sample": (
        lambda s, d: S.stratified(_strata(s, d), 50),
        f"""WITH {STRATA}, rk AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY distance, id) AS nth FROM st), f AS (SELECT id FROM rk WHERE nth = 1), r AS (SELECT *, count(*) OVER (PARTITION BY cluster) AS size, row_number() OVER (PARTITION BY cluster ORDER BY md5('42:' || id), id) AS place FROM rk WHERE nth > 1),
        ch AS (SELECT id FROM f UNION ALL SELECT id FROM r WHERE place <= greatest(1, floor(CAST(50 - (SELECT count(*) FROM f) AS DOUBLE) * size / (SELECT count(*) FROM r)))), ad AS (SELECT id FROM st WHERE id NOT IN (SELECT id FROM ch) ORDER BY md5('42:' || id), id LIMIT (SELECT greatest(0, 50 - count(*)) FROM ch))
        SELECT id FROM (SELECT * FROM ch UNION ALL SELECT * FROM ad) ORDER BY id LIMIT 50""",
    ),
    "m18_kmeans_sample": (lambda s, d: S.kmeans_sample(table(s, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v")), 60), None),  # tested by invariants
    "m15_fewer_dimensions": (lambda s, d: S.fewer_dimensions(table(s, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v")), 8).select("id", F.round(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x), 6).alias("squared_length")), None),  # tested against numpy
    # sources
    "s4_use_cases": (
        lambda s, d: table(s, d, "events").groupBy("user_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ts", "event_id", "event_type"))), lambda x: x["event_type"]), ",").alias("use_cases")),
        "SELECT user_id, string_agg(event_type, ',' ORDER BY ts, event_id) AS use_cases FROM events GROUP BY 1",
    ),
    "s6_link_events": (
        lambda s, d: table(s, d, "events").where("event_type = 'click'").join(table(s, d, "events").where("event_type = 'purchase'").select("user_id").distinct(), "user_id", "left_semi").groupBy("user_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ts", "event_id"))), lambda x: x["event_id"].cast("string")), ",").alias("links")),
        "SELECT user_id, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY ts, event_id) AS links FROM events WHERE event_type = 'click' AND user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase') GROUP BY 1",
    ),
    "s7_assembled": (
        lambda s, d: assembled(frame(s, d, "chat_rows"), frame(s, d, "field_rows"), frame(s, d, "link_rows")).select("session", F.array_join(F.transform("chat", lambda x: x["text"]), ",").alias("chat"), F.size("fields").cast("long").alias("fields"), F.array_join(F.transform("bought", lambda x: x["v"]), ",").alias("bought"), F.array_join(F.transform("links", lambda x: x["link"]), ",").alias("links")),
        f"""WITH {values('chat_rows', 'field_rows', 'link_rows')}, c AS (SELECT session, string_agg(text, ',' ORDER BY made, id) AS chat FROM chat_rows WHERE text NOT LIKE 'img:%' GROUP BY 1), f AS (SELECT session, count(*) AS fields, string_agg(v, ',' ORDER BY made) FILTER (k = 'product_added_to_cart') AS bought FROM field_rows GROUP BY 1),
        l AS (SELECT session, string_agg(link, ',' ORDER BY made) AS links FROM link_rows GROUP BY 1) SELECT c.session, chat, fields, bought, links FROM c LEFT JOIN f ON f.session = c.session LEFT JOIN l ON l.session = c.session""",
    ),
    "a14_pages_of_a_kind": (
        lambda s, d: frame(s, d, "pages_seen").where(F.lower("page").rlike("red|about")).groupBy(F.lower("page").alias("page")).agg(F.countDistinct("id").alias("sessions")).orderBy(F.desc("sessions"), "page").limit(2),
        f"WITH {values('pages_seen')} SELECT lower(page) AS page, count(DISTINCT id) AS sessions FROM pages_seen WHERE regexp_matches(lower(page), 'red|about') GROUP BY 1 ORDER BY sessions DESC, page LIMIT 2",
    ),
}
