"""Queries of parsing and labels, over rows with odd cases derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from chatloom.functions import scripts as S
from chatloom.functions import text as T
from chatloom.operators import facts as O
from chatloom.plans.fixtures import frame, values
from chatloom.session import table
from chatloom.sources.tables import CONTROL

THEMES = "array<struct<theme_name string, key_phrases array<string>>>"
NOT_WORD = r"'[^\p{L}\p{N}_\s]'"


def _case(column: str, groups: dict) -> str:
    return "CASE " + " ".join(f"WHEN {column} IN ({', '.join(repr(x) for x in v)}) THEN {repr(k) if k else 'NULL'}" for k, v in groups.items()) + f" ELSE {column} END"


def _spelled(column: str) -> str:
    for word, spellings in T.HINGLISH.items():
        column = rf"regexp_replace({column}, '\b(?:{'|'.join(spellings)})\b', '{word}', 'gi')"
    return column


def _any(column: str, parts: list[str]) -> str:
    return "(" + " OR ".join(f"contains({column}, '{p}')" for p in parts) + ")"


_WORDS = lambda c: rf"trim(regexp_replace(regexp_replace({c}, {NOT_WORD}, ' ', 'g'), '\s+', ' ', 'g'))"
_LOW = r"lower(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(nfc_normalize(t), 'http\S+', '', 'g'), '\S+@\S+', '', 'g'), '\+?\d[\d -]{8,}\d', '', 'g'), '[$€₹¥]', '', 'g')))"
_MARKS = r"array_to_string(list_slice(regexp_extract_all(nfc_normalize(t), '[!]{2,}|[?]{2,}|[.]{3,}'), 1, 2), ' ')"
_REPLY = r"nullif(regexp_extract(regexp_replace(reply, '```(json)?', '', 'g'), '(?s)\[.*\]'), '')"



def _latin(column: str) -> str:
    for letter, spelt in S.TABLE.items():
        column = f"replace({column}, '{letter}', '{spelt.replace(chr(39), chr(39) * 2)}')"
    return column


_PLAIN = _latin("strip_accents(" + _latin(_LOW) + ")")
QUERIES = {
    "f8_mended": (
        lambda s, d: table(s, d, "documents").select(F.col("doc_id").alias("id"), F.md5(S.mended(F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")).cast("binary")).alias("mended"), F.md5(S.mended("text").cast("binary")).alias("untouched")),
        "SELECT doc_id AS id, md5(text) AS mended, md5(text) AS untouched FROM documents",
    ),
    "f14_transliterated": (
        lambda s, d: table(s, d, "documents").select(F.col("doc_id").alias("id"), F.md5(S.transliterated(F.concat("text", F.lit(" Привет Καλημέρα नमस्ते ß"))).cast("binary")).alias("latin")),
        f"SELECT doc_id AS id, md5({_latin('strip_accents(' + _latin(chr(39).join(['nfc_normalize(text || ', ' Привет Καλημέρα नमस्ते ß', ')'])) + ')')}) AS latin FROM documents",
    ),
    "f1_iso_to_local": (
        lambda s, d: frame(s, d, "times").select("id", T.local_from_iso(F.col("t")).alias("ist")),
        r"""WITH """ + values("times") + r""", p AS (SELECT id, regexp_extract(t, '^(\d{4}-\d{2}-\d{2})(?:[T ](\d{2}:\d{2}(?::\d{2})?)(?:[.]\d+)?)?(?:Z|[+-]\d{2}:\d{2})?$', ['day', 'clock']) AS m FROM times)
        SELECT id, strftime(TRY_CAST(m.day || ' ' || CASE WHEN m.clock = '' THEN '00:00:00' ELSE m.clock END AS TIMESTAMP) + INTERVAL 330 MINUTE, '%Y-%m-%d %H:%M:%S') AS ist FROM p""",
    ),
    "f2_json_scalar_or_list": (
        lambda s, d: frame(s, d, "states").select("id", T.json_first(F.col("j"), "utm_source").alias("source")),
        f"WITH {values('states')} SELECT id, CASE WHEN json_valid(j) THEN CASE json_type(j, '$.utm_source') WHEN 'ARRAY' THEN j ->> '$.utm_source[0]' ELSE j ->> '$.utm_source' END END AS source FROM states",
    ),
    "f3_visited_days": (
        lambda s, d: frame(s, d, "states").select("id", F.json_array_length(F.get_json_object("j", "$.days")).cast("long").alias("days")),
        f"WITH {values('states')} SELECT id, CASE WHEN json_valid(j) AND json_type(j, '$.days') = 'ARRAY' THEN CAST(json_array_length(j, '$.days') AS BIGINT) END AS days FROM states",
    ),
    "p3_first_location": (
        lambda s, d: O.first_field(frame(s, d, "fields"), "session", "n", "k", "v", "location"),
        f"WITH {values('fields')}, f AS (SELECT session, v, row_number() OVER (PARTITION BY session ORDER BY n) AS nth FROM fields WHERE lower(k) = 'location') SELECT session, CASE WHEN lower(trim(v)) <> 'unknown' THEN v END AS location FROM f WHERE nth = 1",
    ),
    "p5_attribution": (
        lambda s, d: O.attributed(frame(s, d, "orders_made"), "session", "n", "details", "by_chat"),
        f"""WITH {values('orders_made')}, f AS (SELECT session, details AS x FROM orders_made QUALIFY row_number() OVER (PARTITION BY session ORDER BY n) = 1),
        o AS (SELECT session, CASE WHEN NOT json_valid(x) THEN NULL WHEN json_type(x) = 'VARCHAR' THEN x ->> '$' ELSE x END AS y FROM f), z AS (SELECT session, CASE WHEN json_valid(y) AND json_type(y) = 'OBJECT' THEN y ->> '$.by_chat' END AS v FROM o)
        SELECT session, CASE WHEN v IS NULL OR v IN ('false', '0', '') THEN 0 ELSE 1 END AS attributed FROM z""",
    ),
    "s14_repair_json": (
        lambda s, d: frame(s, d, "broken").select("id", F.get_json_object(F.regexp_replace("raw", CONTROL, ""), "$.k").alias("k")),
        f"WITH {values('broken')}, r AS (SELECT id, regexp_replace(raw, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F]', '', 'g') AS j FROM broken) SELECT id, CASE WHEN json_valid(j) THEN j ->> '$.k' END AS k FROM r",
    ),
    "f16_json_reply": (
        lambda s, d: frame(s, d, "replies").select("id", F.from_json(T.json_reply(F.col("reply")), THEMES).alias("t")).select("id", F.coalesce(F.size(F.filter("t", lambda x: x.isNotNull())), F.lit(0)).cast("long").alias("themes")),
        f"WITH {values('replies')}, r AS (SELECT id, {_REPLY} AS j FROM replies) SELECT id, CASE WHEN json_valid(j) THEN CAST(json_array_length(j) AS BIGINT) ELSE 0 END AS themes FROM r",
    ),
    "p20_valid_themes": (
        lambda s, d: frame(s, d, "replies").select("id", F.explode(F.from_json(T.json_reply(F.col("reply")), THEMES)).alias("t")).where(F.col("t.theme_name").isNotNull() & (F.size("t.key_phrases") >= 6)).select("id", "t.theme_name", F.size("t.key_phrases").cast("long").alias("phrases")),
        f"""WITH {values('replies')}, r AS (SELECT id, {_REPLY} AS j FROM replies), e AS (SELECT id, unnest(from_json(j, '[{{"theme_name": "VARCHAR", "key_phrases": ["VARCHAR"]}}]')) AS t FROM r WHERE json_valid(j))
        SELECT id, t.theme_name AS theme_name, len(t.key_phrases) AS phrases FROM e WHERE t.theme_name IS NOT NULL AND len(t.key_phrases) >= 6""",
    ),
    "f8_nfc": (lambda s, d: frame(s, d, "spoken").select("id", T.nfc(F.col("t")).alias("t")), f"WITH {values('spoken')} SELECT id, nfc_normalize(t) AS t FROM spoken"),
    "f13_one_spelling": (lambda s, d: frame(s, d, "spoken").select("id", T.one_spelling(F.lower("t")).alias("t")), f"WITH {values('spoken')} SELECT id, {_spelled('lower(t)')} AS t FROM spoken"),
    "f14_without_accents": (lambda s, d: frame(s, d, "spoken").select("id", T.without_accents(F.col("t")).alias("t")), f"WITH {values('spoken')} SELECT id, strip_accents(t) AS t FROM spoken"),
    "f8_f14_clean_in": (
        lambda s, d: frame(s, d, "spoken").select("id", T.clean_in(F.col("t"), F.col("lang")).alias("cleaned")),
        f"""WITH {values('spoken')} SELECT id, trim(CASE WHEN lang IS NULL OR starts_with(lang, 'en') THEN {_WORDS(_LOW)} WHEN contains(lang, 'hi') OR lang = 'ta' THEN {_WORDS(_spelled(_LOW))} ELSE {_WORDS(_PLAIN)} END
        || CASE WHEN {_MARKS} = '' THEN '' ELSE ' ' || {_MARKS} END) AS cleaned FROM spoken""",
    ),
    "m26_phrase_text": (lambda s, d: frame(s, d, "spoken").select("id", T.phrase_text(F.col("t")).alias("phrase")), f"WITH {values('spoken')}, c AS (SELECT id, t, {_WORDS(_LOW.replace('nfc_normalize(t)', 't'))} AS x FROM spoken) SELECT id, CASE WHEN x = '' THEN t ELSE x END AS phrase FROM c"),
    "f5_synonyms": (lambda s, d: frame(s, d, "use_cases").select("id", T.one_use_case(F.col("u")).alias("label")), f"WITH {values('use_cases')} SELECT id, {_case('u', T.USE_CASE_SYNONYMS)} AS label FROM use_cases"),
    "j8_shown_names": (
        lambda s, d: frame(s, d, "use_cases").select("id", T.shown_use_case(T.one_use_case(F.col("u"))).alias("label")),
        f"WITH {values('use_cases')}, o AS (SELECT id, {_case('u', T.USE_CASE_SYNONYMS)} AS label FROM use_cases) SELECT id, {_case('label', {v: [k] for k, v in T.USE_CASE_NAMES.items()})} AS label FROM o",
    ),
    "f25_sales_stage": (lambda s, d: frame(s, d, "named").select("id", T.sales_stage(F.col("name"), F.col("description")).alias("stage")), f"WITH {values('named')} SELECT id, CASE WHEN {_any(chr(39).join(['lower(name || ', ' ', ' || description)']), T.POST_SALES)} THEN 'post-sales' ELSE 'pre-sales' END AS stage FROM named"),
    "p12_concern_keys": (lambda s, d: frame(s, d, "concern_keys").where(F.lower("k").contains("concern")).select("id"), f"WITH {values('concern_keys')} SELECT id FROM concern_keys WHERE contains(lower(k), 'concern')"),
    "p16_insufficient": (
        lambda s, d: frame(s, d, "lists").select("id", T.insufficient(F.col("themes")).alias("insufficient")),
        f"WITH {values('lists')} SELECT id, themes IS NULL OR len(themes) = 0 OR len(list_filter(themes, lambda x: {_any('lower(x)', T.INSUFFICIENT)})) > 0 AS insufficient FROM lists",
    ),
    "f18_thousands": (lambda s, d: frame(s, d, "numbers").select("id", T.thousands(F.col("x")).alias("shown")), f"WITH {values('numbers')} SELECT id, '₹' || format('{{:,}}', CAST(round_even(x, 0) AS BIGINT)) AS shown FROM numbers"),
    "f18_tenant_slug": (lambda s, d: frame(s, d, "use_cases").select("id", T.tenant_slug(F.col("u")).alias("slug")), f"WITH {values('use_cases')} SELECT id, trim(regexp_replace(lower(u), '[^a-z0-9]+', '_', 'g'), '_') AS slug FROM use_cases"),
    "f26_half_even": (lambda s, d: frame(s, d, "numbers").select("id", T.round_half_even(F.col("x"), 2).alias("x")), None),  # no SQL rounds the binary number; tested against Python
    "j7_case_insensitive": (
        lambda s, d: O.first_match(frame(s, d, "channels"), "channel", frame(s, d, "channel_rows"), "source", "n"),
        f"WITH {values('channels', 'channel_rows')}, f AS (SELECT lower(source) AS k, sessions FROM channel_rows QUALIFY row_number() OVER (PARTITION BY lower(source) ORDER BY n) = 1) SELECT id, channel, sessions FROM channels LEFT JOIN f ON k = lower(channel)",
    ),
    "j2_next_snapshot_map": (
        lambda s, d: O.next_snapshot(frame(s, d, "asked"), frame(s, d, "snapshots"), "session", "made", "k", "v").select("id", F.array_join(F.transform(F.array_sort(F.map_entries("snapshot")), lambda e: F.concat_ws("=", e["key"], e["value"])), ",").alias("snapshot")),
        f"""WITH {values('asked', 'snapshots')}, l AS (SELECT session, made, k, max(v) AS v FROM snapshots GROUP BY 1, 2, 3), p AS (SELECT session, made, string_agg(k || '=' || v, ',' ORDER BY k) AS snapshot FROM l GROUP BY 1, 2)
        SELECT a.id, p.snapshot FROM asked a ASOF LEFT JOIN p ON a.session = p.session AND a.made <= p.made""",
    ),
}
