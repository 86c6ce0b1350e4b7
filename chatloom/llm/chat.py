"""Chat formatting by quotation linking (operator 2); DataFrame functions only.

A line's quote level is the number of > signs it starts with. Runs of lines of one level in a message are passages; a passage,
each of its lines, each message's own text and each of its own lines are normalised (lower case, letters and digits) and hashed. Quoted
hashes are joined to the first message of the same conversation that wrote them, if it is earlier. A message's parent is the
message that its outermost linked quotes take most characters from (then the latest). Threads are followed by pointer jumping, so their depth
costs a logarithm of rounds, and no conversation gathers in one task: originals are reduced to one row for each (conversation, hash)
before the join, and what is quoted very often is joined by broadcast of those few hashes (common.attach). Quoted lines are left out of the text, and so is a line ending in "wrote:" right before a quote.

Order by conv_id, thread, turn gives each thread's messages after what they reply to.

Defined results: one row for each message; null text counts as empty and null role as "unknown"; messages with null conv_id or turn have
no links; rows with the same conv_id and turn share their links; a quote that nothing earlier wrote stays unlinked; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chatloom.llm.common import attach, materialize

MARK = r"^[ \t]*>[ \t>]*"
WROTE = r"wrote:[ \t]*$"


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, MARK, 0), r"[^>]", ""))


def parse(messages: DataFrame) -> DataFrame:
    """row, conv_id, turn, role, lines (arrays of level and body), own text."""
    base = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("unknown")).alias("role"), F.split(F.coalesce("text", F.lit("")), r"\r?\n").alias("raw"))
    base = base.withColumn("row", F.monotonically_increasing_id())
    quoted = lambda x: x.rlike(MARK)
    own = F.filter("raw", lambda x, i: ~quoted(x) & ~(x.rlike(WROTE) & F.coalesce(quoted(F.get(F.col("raw"), i + 1)), F.lit(False))))
    lines = F.transform("raw", lambda x: F.struct(level(x).alias("level"), F.regexp_replace(x, MARK, "").alias("body")))
    return base.select("row", "conv_id", "turn", "role", lines.alias("lines"), F.trim(F.array_join(own, "\n")).alias("own"), own.alias("own_lines"))


def links(parsed: DataFrame) -> DataFrame:
    """conv_id, turn, level, source turn, chars: what each message quotes from which earlier one."""
    known = parsed.where("conv_id is not null and turn is not null")
    texts = F.concat(F.array("own"), F.col("own_lines"))
    written = known.select("conv_id", "turn", F.explode_outer(F.array_distinct(F.transform(texts, normalised))).alias("t")).where("t <> ''")
    written = written.select("conv_id", "turn", F.sha2("t", 256).alias("hash")).groupBy("conv_id", "hash").agg(F.min("turn").alias("source"))
    line = known.select("row", "conv_id", "turn", F.posexplode_outer("lines").alias("pos", "line")).select("row", "conv_id", "turn", "pos", "line.level", "line.body")
    w = W.partitionBy("row").orderBy("pos")  # one message's lines
    line = line.withColumn("new", (F.col("level") != F.coalesce(F.lag("level").over(w), F.lit(-1))).cast("int")).withColumn("run", F.sum("new").over(w)).where("level > 0")
    each = line.select("row", "conv_id", "turn", "level", "run", normalised(F.col("body")).alias("t"), F.lit(False).alias("whole"))
    runs = line.groupBy("row", "conv_id", "turn", "level", "run").agg(F.array_sort(F.collect_list(F.struct("pos", "body"))).alias("parts"))
    runs = runs.select("row", "conv_id", "turn", "level", "run", normalised(F.array_join(F.transform("parts", lambda p: p["body"]), " ")).alias("t"), F.lit(True).alias("whole"))
    asked = each.unionByName(runs).where("t <> ''").select("conv_id", "turn", "level", F.length("t").alias("size"), F.sha2("t", 256).alias("hash"))
    asked = materialize(asked, "quotes")
    key = ["conv_id", "hash"]
    groups = materialize(asked.groupBy(*key).agg(F.count("*").alias("copies")).join(written, key), "written")
    found = attach(asked, groups, key, "copies", asked.count()).where(F.col("source") < F.col("turn"))
    return found.groupBy("conv_id", "turn", "level", F.col("source").alias("parent")).agg(F.sum("size").alias("chars"))


def threads(replies: DataFrame) -> DataFrame:
    """conv_id, turn, thread, depth from conv_id, turn, parent: the root's turn and the steps to it."""
    step = materialize(replies.select("conv_id", "turn", F.col("parent").alias("thread"), F.lit(1).cast("long").alias("depth")), "threads")
    while True:
        upper = step.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("further"), F.col("depth").alias("more"))
        ahead = materialize(step.join(upper, ["conv_id", "thread"], "left").select("conv_id", "turn", F.coalesce("further", "thread").alias("thread"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("further").isNotNull().alias("moved")), "threads")
        if ahead.where("moved").isEmpty():
            return ahead.select("conv_id", "turn", "thread", "depth")
        step = ahead.drop("moved")


def reply_ordered(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, text (without quotes), formatted, n_quoted_lines, max_level, parent, thread, depth for each message."""
    parsed = materialize(parse(messages), "parsed")
    found = materialize(links(parsed), "links")
    best = W.partitionBy("conv_id", "turn").orderBy("level", F.desc("chars"), F.desc("parent"))  # what one message quotes
    replies = materialize(found.withColumn("nth", F.row_number().over(best)).where("nth = 1").select("conv_id", "turn", "parent"), "replies")
    ordered = replies.join(threads(replies), ["conv_id", "turn"])
    levels = F.transform("lines", lambda x: x["level"])
    out = parsed.join(ordered, ["conv_id", "turn"], "left")
    text = F.col("own")
    return out.select(
        "conv_id", "turn", "role", text.alias("text"), F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), text, F.lit("\n")).alias("formatted"),
        F.size(F.filter(levels, lambda x: x > 0)).cast("long").alias("n_quoted_lines"), F.coalesce(F.array_max(levels), F.lit(0)).cast("long").alias("max_level"),
        "parent", F.coalesce("thread", "turn").alias("thread"), F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
    )
