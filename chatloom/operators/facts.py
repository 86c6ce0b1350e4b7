"""Message facts: one row for each customer message, with what happened next in its session."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chatloom.functions.text import json_flag


def customer_messages(chat: DataFrame) -> DataFrame:
    """Customer messages with their number in the session; columns session, pos, actor, text."""
    w = W.partitionBy("session").orderBy("pos")
    return chat.where("actor = 'customer'").withColumn("msg_number", F.row_number().over(w).cast("long"))


def handed_off(chat: DataFrame, phrase: str) -> DataFrame:
    """Customer messages and whether the next message is the AI's and has the phrase."""
    w = W.partitionBy("session").orderBy("pos")
    nxt = (F.lead("actor").over(w) == "AI") & F.lower(F.lead("text").over(w)).contains(phrase.lower())
    return chat.withColumn("talk_to_agent", F.coalesce(nxt, F.lit(False)).cast("int")).where("actor = 'customer'")


def asked_before(chat: DataFrame, phrase: str) -> DataFrame:
    """Of each other message that has the phrase, the last customer message before it: session, pos, asked_pos."""
    w = W.partitionBy("session").orderBy("pos").rowsBetween(W.unboundedPreceding, -1)
    last = F.last(F.when(F.col("actor") == "customer", F.col("pos")), ignorenulls=True).over(w)
    hit = (F.col("actor") != "customer") & F.lower("text").contains(phrase.lower())
    return chat.withColumn("asked_pos", last).where(hit & F.col("asked_pos").isNotNull()).select("session", "pos", "asked_pos")


def next_event(left: DataFrame, right: DataFrame, by: str, ts: str, value: str) -> DataFrame:
    """Forward as-of join: each left row with the value of the first right row at its time or later. One shuffle on `by`: both
    sides are merged into one stream for each key, the latest first and right rows before left ones of the same time, and the right row
    last seen is carried along, so the work of a key grows with its rows."""
    rows = left.withColumn("_right", F.lit(0)).unionByName(right.select(by, ts, F.col(value).alias("_value")).groupBy(by, ts).agg(F.max("_value").alias("_value")).withColumn("_right", F.lit(1)), allowMissingColumns=True)
    w = W.partitionBy(by).orderBy(F.desc(ts), F.desc("_right")).rowsBetween(W.unboundedPreceding, 0)
    seen = F.last(F.when(F.col("_right") == 1, F.struct(F.col(ts).alias("ts"), F.col("_value").alias("v"))), ignorenulls=True).over(w)
    out = rows.withColumn("_next", seen).where("_right = 0")
    return out.withColumn("next_ts", F.col("_next.ts")).withColumn(f"next_{value}", F.col("_next.v")).drop("_right", "_value", "_next")


def next_snapshot(left: DataFrame, attributes: DataFrame, by: str, ts: str, key: str, value: str) -> DataFrame:
    """Each left row with the map of the attributes set at its time or at the next one that has any; of one attribute set twice at a time the larger."""
    each = attributes.groupBy(by, ts, key).agg(F.max(value).alias(value))
    packed = each.groupBy(by, ts).agg(F.array_sort(F.collect_list(F.struct(key, value))).alias("pairs"))  # one row a time
    out = next_event(left, packed, by, ts, "pairs")
    return out.withColumn("snapshot", F.map_from_entries("next_pairs")).drop("next_pairs", "next_ts")


def first_field(fields: DataFrame, by: str, order: str, key: str, value: str, name: str) -> DataFrame:
    """The value of each session's first field of a name in any case; "unknown" is null, also where a later one is known."""
    first = fields.where(F.lower(key) == name).groupBy(by).agg(F.min(F.struct(F.col(order).alias("o"), F.col(value).alias("v"))).alias("f"))
    return first.select(by, F.when(F.lower(F.trim("f.v")) != "unknown", F.col("f.v")).alias(name))


def attributed(orders: DataFrame, by: str, order: str, details: str, flag: str) -> DataFrame:
    """1 if the details of a session's first order have the flag, else 0; sessions without orders have no row."""
    first = orders.groupBy(by).agg(F.min(F.struct(F.col(order).alias("o"), F.col(details).alias("d"))).alias("f"))
    return first.select(by, json_flag(F.col("f.d"), flag).alias("attributed"))


def first_match(left: DataFrame, key: str, right: DataFrame, name: str, order: str) -> DataFrame:
    """Left rows with the first right row of the same name in any case, nulls if there is none."""
    rest = [c for c in right.columns if c not in (name, order)]
    first = right.groupBy(F.lower(name).alias("_k")).agg(F.min(F.struct(order, *rest)).alias("_f"))
    return left.join(first, F.lower(key) == F.col("_k"), "left").select(*left.columns, *(F.col(f"_f.{c}") for c in rest))


def zipped(left: DataFrame, right: DataFrame, by: str, left_order: list, right_order: list, how: str = "left") -> DataFrame:
    """The i-th left row of a key with its i-th right row."""
    a = left.withColumn("nth", F.row_number().over(W.partitionBy(by).orderBy(*left_order)).cast("long"))
    b = right.withColumn("nth", F.row_number().over(W.partitionBy(by).orderBy(*right_order)).cast("long"))
    return a.join(b, [by, "nth"], how)


def mapped(column: Column, rules: dict[str, str]) -> Column:
    """A label's replacement, else the label."""
    return F.coalesce(*(F.when(column == k, v) for k, v in rules.items()), column)


def session_flags(events: DataFrame, session: Column, kinds: dict[str, str]) -> DataFrame:
    """For each session its events and whether it has an event of each kind."""
    flags = [F.max((F.col("event_type") == v).cast("int")).alias(k) for k, v in kinds.items()]
    return events.groupBy(session.alias("session")).agg(F.count("*").alias("events"), *flags)


def keep_last(days: DataFrame, key: str, order: list) -> DataFrame:
    """Of rows with the same key, the last in order."""
    return days.withColumn("nth", F.row_number().over(W.partitionBy(key).orderBy(*order))).where("nth = 1").drop("nth")
