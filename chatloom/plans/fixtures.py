"""Inputs with the odd cases that the tables lack, derived row by row from the given tables: as a DataFrame and as SQL.

Each case is a list of select expressions over a table, read alike by both engines, and sometimes a grouping of what they give; a row's key says which odd spelling its values
are put into, so the work grows with the table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.session import table


def pick(key: str, *options: str) -> str:
    """The option of a row by its key, in turn; options are SQL texts."""
    return f"CASE {key} % {len(options)} " + " ".join(f"WHEN {i} THEN {o}" for i, o in enumerate(options)) + " END"


_q = lambda *texts: [f"'{t}'" for t in texts]
_day, _clock = "substr(CAST(ts AS STRING), 1, 10)", "substr(CAST(ts AS STRING), 12, 8)"
_theme = "CAST(substr(p_brand, 7, 5) AS BIGINT)"
_up = lambda x, by: f"CAST(floor({x} / {by}) AS BIGINT)"
_phrases = lambda n: "[" + ", ".join(f'"p{i}"' for i in range(n)) + "]"
NAMES = _q("Delivery time", "Delivery delay", "Late parcels", "Price", "Costs", "Greetings", "General talk", "Sizes")
DESCRIPTIONS = _q("when it comes", "late parcels", "late", "cost", "money", "hello and bye", "various", "fit")
TEXTS = ["p_name", "'when will it come'", "'late again'", "'how much'", "'hi'", "'hey there'", "'ok'", "'zzz'", "'yes'", "'a long and winding text'", "p_type"]

#: Name -> table, select expressions, condition or None, keys of a grouping or None, expressions of the groups.
CASES: dict[str, tuple] = {
    "times": ("events", ["event_id AS id", pick("event_id", f"{_day} || 'T' || {_clock} || 'Z'", f"{_day} || 'T' || {_clock} || '.123456'", f"{_day} || 'T23:59:59+00:00'", f"{_day} || ' ' || substr({_clock}, 1, 5)", _day, f"'2024-02-30T' || {_clock} || 'Z'", "event_type", "NULL", "''", f"{_day} || 'T' || {_clock} || '+02:00'", f"{_day} || 'T' || {_clock} || '.5Z'") + " AS t"]),
    "states": ("events", ["event_id AS id", pick("event_id", """'{"utm_source": "' || event_type || '", "days": ["a", "b"]}'""", """'{"utm_source": ["' || event_type || '", "mail"], "days": []}'""", """'{"utm_source": [], "days": "x"}'""", "props", "'{}'", "'not json'", "NULL", """'{"utm_source": ' || CAST(user_id AS STRING) || ', "days": [1, 2, 3]}'""", """'{"utm_source": null}'""") + " AS j"]),
    "orders_made": (
        "orders",
        ["o_custkey AS session", "o_orderkey AS n", pick("o_orderkey", """'{"by_chat": true}'""", """'{"by_chat": false}'""", """'"{' || chr(92) || '"by_chat' || chr(92) || '": true}"'""", "'\"just text\"'", "'broken {'", "NULL", """'{"by_chat": ' || CAST(o_custkey % 2 AS STRING) || '}'""", """'{"by_chat": ""}'""", """'["by_chat"]'""", """'{"by_chat": "' || o_orderpriority || '"}'""") + " AS details"],
    ),
    "fields": ("events", ["user_id AS session", "event_id AS n", pick("event_id", *_q("Location", "location", "LOCATION", "page", "location")) + " AS k", pick("event_id", "'Pune'", "'Goa'", "' Unknown '", "NULL", "'unknown'", "event_type", "'Delhi'") + " AS v"]),
    "replies": (
        "events",
        [
            "event_id AS id",
            pick(
                "event_id", f"""'Sure:' || chr(10) || '```json' || chr(10) || '[{{"theme_name": "' || event_type || '", "key_phrases": {_phrases(6)}}}]' || chr(10) || '``` done'""",
                f"""'[{{"theme_name": "Price", "key_phrases": {_phrases(5)}}}, {{"theme_name": "' || event_type || '", "key_phrases": {_phrases(7)}}}]'""", """'[{"theme_name": "Cut", "key_phrases": ["a"'""", "'no list at all'", "NULL", "'```[]```'", """'{"theme_name": "Alone"}'""", f"""'[{{"key_phrases": {_phrases(6)}}}]'""", "'Here is [1, 2'",
            ) + " AS reply",
        ],
    ),
    "broken": ("events", ["event_id AS id", pick("event_id", """'{"k": ' || CAST(user_id AS STRING) || '}'""", """'{"k": "a' || chr(1) || event_type || '"}'""", """chr(11) || '{"k": 2}' || chr(31)""", """'{"k": '""", """'{"k": "t' || chr(127) || 'x"}'""", "NULL", "props") + " AS raw"]),
    "spoken": (
        "documents",
        [
            "doc_id AS id", pick("doc_id", "lang", "'hi'", "lang", "'hi-Latn'", "'ta'", "NULL", "lang") + " AS lang",
            pick("doc_id", *(f"'{t} ' || source" for t in ("Is  it IN stock?? mail a@b.cd or +91 98765 43210 now!!!", "APP kya h? Price nhi pata", "paise kitne, mughe chiye... ok!!", "Où est l été déjà?", "Größe ÄÖÜ $5 http://x.y/z end", "Plain Text", "café au lait", "napa na napa", "han haa ha!", "5$ off...", "¿Cuánto? ¡Mañana! ??")), "''", "source") + " AS t",
        ],
    ),
    "named": ("part", ["p_partkey AS id", pick("p_partkey", *(f"'{t} ' || p_name" for t in ("Where is my order", "Prices", "Wrong Product", "Greetings", "Sizes", "Contents"))) + " AS name", pick("p_partkey", *_q("tracking and delays", "what it costs", "arrived", "hello", "refund of sizes", "", "courier")) + " AS description"]),
    "use_cases": ("events", ["event_id AS id", pick("event_id", *_q("Customer Problem", "Complaint", "product_benefits", "ecommerce_quick_commerce", "side_effects", "physical_store", "durability", "No More Product Query", "Pricing"), "event_type", "NULL", *_q("All Products", "Inquiry about availability on other platforms")) + " AS u"]),
    "lists": ("part", ["p_partkey AS id", pick("p_partkey", "split(p_name, ' ')", "SLICE(split('a', ' '), 1, 0)", "NULL", "split('  Not Enough Data here ', ';')", "split('No patterns detected.', ';')", "split('patterns detected', ';')", "split(p_type || ';Insufficient message volume', ';')") + " AS themes"]),
    "concern_keys": ("events", ["event_id AS id", pick("event_id", "'concern'", "'Concern'", "'customer_concern'", "event_type || ' concerns'", "'location'", "NULL", "'main_CONCERN_tag'") + " AS k"]),
    "numbers": ("orders", ["o_orderkey AS id", pick("o_orderkey", "o_totalprice", "floor(o_totalprice) / 8", "NULL", "-floor(o_totalprice) / 2", "floor(o_totalprice) / 1000") + " AS x"]),
    "channels": ("customer", ["c_custkey AS id", pick("c_custkey", *_q("Mail", "MAIL", "Ads", "other"), "NULL") + " AS channel"]),
    "channel_rows": ("orders", [pick("o_orderkey", *_q("mail", "Mail", "ADS", "none")) + " AS source", "o_orderkey AS n", "o_custkey AS sessions"]),
    "pages_seen": ("events", ["user_id AS id", pick("event_id", *_q("Shop/red", "shop/RED", "blog/red"), "NULL", *_q("SHOP/blue", "about", "shop/red"), "event_type") + " AS page"]),
    # themes and assignments: one theme a brand, one message a part
    "themes": ("part", [f"{_theme} AS theme", "p_name", "p_type"], None, ["theme"], [pick("theme", *NAMES) + " || ' ' || CAST(theme AS STRING) AS name", pick("theme", *DESCRIPTIONS) + " AS description", "count(*) AS n", "array_sort(array_agg(DISTINCT p_name)) AS phrases", "array_sort(array_agg(DISTINCT p_type)) AS examples"]),
    "alike": ("part", [f"{_theme} AS a", f"{_theme} + 1 + p_size % 3 AS b"], f"{_theme} + 1 + p_size % 3 <= 25", ["a", "b"], ["CAST((count(*) * 37 + a * 11 + b) % 101 AS DOUBLE) / 100 AS similarity"]),
    "assigned": (
        "part",
        ["p_partkey AS message", pick("p_partkey", *TEXTS) + " AS text", f"CASE WHEN p_size % 6 = 0 THEN -1 ELSE {_theme} END AS theme", "CASE WHEN p_size % 6 = 0 THEN 'miscellaneous' ELSE 'confident' END AS status", "CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_name END AS phrase", "CAST(p_size % 16 AS DOUBLE) / 16 AS best", "CAST(p_size % 5 AS DOUBLE) / 16 AS second", f"CASE WHEN p_size % 7 = 0 THEN NULL ELSE {_theme} % 25 + 1 END AS second_theme", "CASE WHEN p_size % 3 = 0 THEN 1 ELSE 0 END AS was_borderline"],
    ),
    # labels of concerns: the names of parts
    "labels_of": ("part", ["p_name AS label", "p_size", "p_partkey"], None, ["label"], ["count(*) % 14 AS n", "LIST(CAST(sum(p_size) % 37 + 1 AS DOUBLE), CAST(sum(p_partkey) % 29 AS DOUBLE)) AS v"]),
    "label_groups": ("part", ["p_name AS label", "p_size"], None, ["label"], ["sum(p_size) % 9 AS grp"]),
    "meta_groups": ("part", ["CAST(p_size % 6 AS BIGINT) AS meta", "CAST(p_size * p_size % 11 AS BIGINT) AS grp"], None, ["meta", "grp"], []),
    "concern_messages": ("part", ["p_partkey AS id", pick("p_partkey", "p_name", """'["' || p_name || '", "cold bolt"]'""", "p_name", """'["' || p_name || '"]'""", """'[broken ' || p_name""", "NULL", """'["small ring", "' || p_name || '", "hot gear"]'""") + " AS concern"]),
    "suggested": ("part", ["p_name AS low", pick("p_size", "'cold '", "'hot '", "'large '", "'no '") + " || split_part(p_name, ' ', 2) AS target"], None, ["low", "target"], []),
    "history": ("part", ["p_name AS label", "p_size"], None, ["label"], [pick("sum(p_size)", "'round1'", "'round2'", "NULL", "'round2'") + " AS step", pick("sum(p_size)", *_q("merged", "merged", "retained", "deleted")) + " AS status"]),
    # sessions and messages
    "snapshots": ("events", ["user_id AS session", f"{_up('event_id', 8)} AS made", pick("event_id", *_q("a", "b", "c")) + " AS k", "event_type AS v"], "event_type <> 'view'"),
    "asked": ("events", ["user_id AS session", "event_id AS id", f"{_up('event_id', 8)} AS made"], "event_type = 'view'"),
    "chat_rows": ("conversations", ["CAST(conv_id AS STRING) AS session", "conv_id * 1000 + turn AS id", "CAST(turn AS STRING) AS made", "role AS actor", "CASE WHEN (conv_id + turn) % 5 = 0 THEN 'img:' || role ELSE text END AS text"]),
    "field_rows": ("events", ["CAST(user_id AS STRING) AS session", pick("event_id", *_q("product_added_to_cart", "location", "page")) + " AS k", "event_type || CAST(event_id AS STRING) AS v", "CAST(event_id + 1000000000 AS STRING) AS made"]),
    "link_rows": ("events", ["CAST(user_id AS STRING) AS session", "CAST(event_id + 1000000000 AS STRING) AS made", "props AS link"], "event_type = 'click'"),
}


def _parts(name: str) -> tuple:
    return (*CASES[name], *(None, None, None))[:5]


def frame(spark: SparkSession, sf: str, name: str) -> DataFrame:
    source, select, where, keys, groups = _parts(name)
    plain = lambda x: x.replace("SLICE(", "slice(").replace("LIST(", "array(")
    df = table(spark, sf, source)
    df = (df.where(where) if where else df).selectExpr(*map(plain, select))
    if keys is None:
        return df
    return df.groupBy(*keys).agg(*(F.expr(plain(g)) for g in groups)) if groups else df.distinct()


def values(*names: str) -> str:
    """Common table expressions with the same rows."""
    out = []
    for name in names:
        source, select, where, keys, groups = _parts(name)
        text = f"SELECT {', '.join(select)} FROM {source}" + (f" WHERE {where}" if where else "")
        if keys is not None:
            text = f"SELECT {', '.join(keys + groups)} FROM ({text}) GROUP BY {', '.join(keys)}"
        out.append(f"{name} AS ({text.replace('SLICE(', 'list_slice(').replace('LIST(', 'list_value(')})")
    return ", ".join(out)
