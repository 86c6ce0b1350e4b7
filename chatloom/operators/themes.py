"""Themes: discovery from word runs, batches, redundancy and merging, titles, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chatloom.functions import text as T
from chatloom.operators.graph import checkpointed, components, ranked

#: Phrases and examples that a merged theme keeps, phrases that a theme must have.
MOST_PHRASES, MOST_EXAMPLES, LEAST_PHRASES = 12, 4, 6
#: Batches that are joined at once.
FAN = 16


def redundant(similar: DataFrame, least: float = 0.65) -> DataFrame:
    """The pairs a, b whose themes say the same: similarity `least` or more. Stands in for a model's verdict."""
    return similar.where(F.round("similarity", 9) >= least).select("a", "b")


def merge_map(pairs: DataFrame, counts: DataFrame) -> DataFrame:
    """theme, canonical for each theme in pairs: the theme with most messages of those it is linked to, directly or not (ties: the smallest id).
    Counts has theme, n; a theme without a row has none."""
    linked = components(pairs).withColumnRenamed("node", "theme").join(counts, "theme", "left")
    best = linked.groupBy("label").agg(F.max(F.struct(F.coalesce("n", F.lit(0)).alias("n"), (-F.col("theme")).alias("t"))).alias("b"))
    return linked.join(best, "label").select("theme", (-F.col("b.t")).alias("canonical"))


def merge_themes(themes: DataFrame, merges: DataFrame) -> DataFrame:
    """theme, name, phrases, merged: the themes that stay, with the phrases of those that went into them after their own (in order of theme;
    case counts), and how many those are."""
    named = themes.join(merges, "theme", "left").withColumn("canonical", F.coalesce("canonical", "theme"))
    listed = named.groupBy("canonical").agg(F.array_sort(F.collect_list(F.struct((F.col("theme") != F.col("canonical")).alias("other"), "theme", "phrases"))).alias("all"), (F.count("*") - 1).alias("merged"))
    union = F.array_distinct(F.flatten(F.transform("all", lambda x: x["phrases"])))
    return themes.select("theme", "name").join(listed, F.col("theme") == F.col("canonical")).select("theme", "name", union.alias("phrases"), "merged")


def reassign(assigned: DataFrame, merges: DataFrame) -> DataFrame:
    """Messages of merged themes go to the one that stays."""
    return assigned.join(merges, "theme", "left").withColumn("theme", F.coalesce("canonical", "theme")).drop("canonical")


def without_case(values):
    """An array without what repeats in other case or with outer blanks: the first spelling stays."""
    return F.filter(values, lambda x, i: F.array_position(F.transform(values, lambda y: F.lower(T.strip(y))), F.lower(T.strip(x))) == i + 1)


def join_batches(first: DataFrame, second: DataFrame, pairs: DataFrame, seeds: DataFrame) -> DataFrame:
    """name, phrases, examples of two batches of themes: those of the second that pairs (a, b by name) match go into the first's, at most
    MOST_PHRASES phrases and MOST_EXAMPLES examples; a pair with a seed's name, in any case, isn't used; nor a name that is in no batch; of several pairs of one name in
    the second batch all are used."""
    protected = seeds.select(F.lower("name").alias("seed"))
    used = pairs.join(first.select(F.col("name").alias("a")), "a", "left_semi").join(second.select(F.col("name").alias("b")), "b", "left_semi")
    used = used.join(protected, (F.lower("a") == F.col("seed")) | (F.lower("b") == F.col("seed")), "left_anti")  # seeds are few
    more = used.join(second.withColumnRenamed("name", "b"), "b").groupBy(F.col("a").alias("name")).agg(F.array_sort(F.collect_list(F.struct("b", "phrases", "examples"))).alias("m"))
    grown = first.join(more, "name", "left")
    extra = lambda c: F.coalesce(F.flatten(F.transform("m", lambda x: x[c])), F.array().cast("array<string>"))
    grown = grown.select("name", F.when(F.col("m").isNull(), F.col("phrases")).otherwise(F.slice(without_case(F.concat("phrases", extra("phrases"))), 1, MOST_PHRASES)).alias("phrases"), F.when(F.col("m").isNull(), F.col("examples")).otherwise(F.slice(F.array_distinct(F.concat("examples", extra("examples"))), 1, MOST_EXAMPLES)).alias("examples"))
    return grown.unionByName(second.join(used.select(F.col("b").alias("name")), "name", "left_anti").select("name", "phrases", "examples"))


def word_run_themes(messages: DataFrame, least: int, most_themes: int, stop: list[str] = ()) -> DataFrame:
    """name, phrases, messages: offline discovery. Runs of two words that occur in `least` messages are phrases; a phrase's commoner word (ties:
    alphabetical) names its theme; the themes with most messages stay, each with its commonest MOST_PHRASES phrases. Columns message, text."""
    words = messages.select("message", F.filter(F.split(T.clean_english(F.col("text")), " "), lambda w: ~w.isin("", *stop)).alias("w"))
    pair = lambda i: F.concat_ws(" ", F.get(F.col("w"), i - 1), F.get(F.col("w"), i))
    runs = words.where(F.size("w") > 1).select("message", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.size("w") - 1), pair))).alias("phrase"))
    phrases = runs.groupBy("phrase").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    counted = words.select("message", F.explode(F.array_distinct("w")).alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    owner = phrases.select("phrase", "n", F.explode(F.array_distinct(F.split("phrase", " "))).alias("word")).join(counted, "word")
    owner = owner.groupBy("phrase", "n").agg(F.min(F.struct((-F.col("df")).alias("df"), "word")).alias("o")).select("phrase", "n", F.col("o.word").alias("name"))
    size = runs.join(owner, "phrase").groupBy("name").agg(F.countDistinct("message").alias("messages"))
    listed = owner.groupBy("name").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "phrase"))).alias("p"))
    top = size.join(listed, "name").orderBy(F.desc("messages"), "name").limit(most_themes)
    return top.select("name", F.slice(F.transform("p", lambda x: x["phrase"]), 1, MOST_PHRASES).alias("phrases"), "messages")


def numbered_batches(messages: DataFrame, size: int) -> DataFrame:
    """messages with batch: `size` rows at a time, in order of message."""
    return ranked(messages, [F.col("message")], "place").withColumn("batch", F.floor(F.col("place") / size)).drop("place")


def batch_themes(messages: DataFrame, least: int, most_themes: int, stop: list[str] = (), least_phrases: int = LEAST_PHRASES) -> DataFrame:
    """batch, name, phrases, examples, messages: what word_run_themes finds in each batch (columns batch, message, text) on its own, all batches at once; themes with fewer than
    `least_phrases` phrases aren't valid. Groups are no larger than a batch."""
    words = messages.select("batch", "message", "text", F.filter(F.split(T.clean_english(F.col("text")), " "), lambda w: ~w.isin("", *stop)).alias("w"))
    pair = lambda i: F.concat_ws(" ", F.get(F.col("w"), i - 1), F.get(F.col("w"), i))
    runs = words.where(F.size("w") > 1).select("batch", "message", "text", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.size("w") - 1), pair))).alias("phrase"))
    phrases = runs.groupBy("batch", "phrase").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    counted = words.select("batch", F.explode(F.array_distinct("w")).alias("word")).groupBy("batch", "word").agg(F.count("*").alias("df"))
    owner = phrases.select("batch", "phrase", "n", F.explode(F.array_distinct(F.split("phrase", " "))).alias("word")).join(counted, ["batch", "word"])
    owner = owner.groupBy("batch", "phrase", "n").agg(F.min(F.struct((-F.col("df")).alias("df"), "word")).alias("o")).select("batch", "phrase", "n", F.col("o.word").alias("name"))
    found = runs.join(owner, ["batch", "phrase"]).groupBy("batch", "name").agg(F.array_sort(F.collect_set(F.struct("message", "text"))).alias("m"))
    listed = owner.groupBy("batch", "name").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "phrase"))).alias("p")).where(F.size("p") >= least_phrases)
    rows = found.join(listed, ["batch", "name"]).withColumn("messages", F.size("m").cast("long"))
    nth = F.row_number().over(W.partitionBy("batch").orderBy(F.desc("messages"), "name"))
    rows = rows.withColumn("nth", nth).where(F.col("nth") <= most_themes)
    texts = lambda c, field, most: F.slice(F.transform(c, lambda x: x[field]), 1, most)
    return rows.select("batch", "name", texts("p", "phrase", MOST_PHRASES).alias("phrases"), F.array_distinct(texts("m", "text", MOST_EXAMPLES)).alias("examples"), "messages")


def fold_batches(themes: DataFrame, seeds: list[str] = ()) -> DataFrame:
    """name, phrases, examples, messages, batches: themes of all batches with those of one name, in any case, made one: the first one's spelling, phrases and examples in order of batches
    without repeats, up to the most that a theme keeps. Themes with a seed's name stay apart. Taking the first few of an ordered union is associative, so
    FAN batches are joined at a time, level by level, and no group holds more."""
    low = F.lower(T.strip(F.col("name")))
    alone = F.concat_ws("#", low, F.col("batch").cast("string"))
    rows = themes.withColumn("key", F.when(low.isin(*(s.lower() for s in seeds)), alone).otherwise(low) if seeds else low).withColumn("batches", F.lit(1).cast("long"))
    rows = checkpointed(rows.select("key", F.col("batch").cast("long").alias("batch"), "name", "phrases", "examples", "messages", "batches"))
    top = rows.agg(F.max("batch")).first()[0] or 0
    joined = lambda c: F.flatten(F.transform("all", lambda x: x[c]))
    total = lambda c: F.aggregate(F.transform("all", lambda x: x[c]), F.lit(0).cast("long"), lambda a, x: a + x)
    while top > 0:
        part = rows.groupBy("key", F.floor(F.col("batch") / FAN).alias("batch")).agg(F.array_sort(F.collect_list(F.struct(F.col("batch").alias("b"), "name", "phrases", "examples", "messages", "batches"))).alias("all"))
        more = F.size("all") > 1
        phrases = F.when(more, F.slice(without_case(joined("phrases")), 1, MOST_PHRASES)).otherwise(joined("phrases"))
        examples = F.when(more, F.slice(F.array_distinct(joined("examples")), 1, MOST_EXAMPLES)).otherwise(joined("examples"))
        rows = checkpointed(part.select("key", "batch", F.get("all", F.lit(0))["name"].alias("name"), phrases.alias("phrases"), examples.alias("examples"), total("messages").alias("messages"), total("batches").alias("batches")))
        top //= FAN
    return rows.select("name", "phrases", "examples", "messages", "batches")


def titled(assigned: DataFrame, themes: DataFrame) -> DataFrame:
    """Adds title: the theme's name; for messages without a theme the name of the last theme that has their best phrase."""
    by_phrase = themes.select(F.explode("phrases").alias("phrase"), "theme", "name").groupBy("phrase").agg(F.max(F.struct("theme", "name")).alias("p")).select("phrase", F.col("p.name").alias("by_phrase"))
    out = assigned.join(themes.select("theme", F.col("name").alias("by_theme")), "theme", "left").join(by_phrase, "phrase", "left")
    return out.withColumn("title", F.when(F.col("theme") >= 0, F.col("by_theme")).otherwise(F.col("by_phrase"))).drop("by_theme", "by_phrase")


def matched_phrases(themes: DataFrame, counts: DataFrame) -> DataFrame:
    """theme, phrase, n of a theme's phrases that any message matched; counts: theme, phrase, n."""
    return themes.select("theme", F.explode("phrases").alias("phrase")).join(counts, ["theme", "phrase"])


def noise_themes(themes: DataFrame, assigned: DataFrame) -> DataFrame:
    """theme of those that say nothing: by title and description, or a vague title and over 60 % of messages that only greet."""
    shares = assigned.groupBy("theme").agg(F.avg(T.greets(F.coalesce("text", F.lit(""))).cast("double")).alias("greeting"))
    vague = T.any_of(F.lower("name"), T.NOISE_TITLES) & (F.coalesce("greeting", F.lit(0.0)) > 0.6)
    return themes.join(shares, "theme", "left").where(T.says_nothing(F.col("name"), F.col("description")) | vague).select("theme")


def customer_report(themes: DataFrame, noise: DataFrame, messages: int, median: float) -> DataFrame:
    """theme, name, n, share_pct, difference, place, shown: themes that say something by falling n; of all messages; columns n, order_pct, sessions."""
    out = themes.where("theme >= 0").join(noise, "theme", "left_anti")
    place = F.row_number().over(W.orderBy(F.desc("n"), "theme")).cast("long")  # one row a theme
    share = F.round(F.lit(100.0) * F.col("n") / messages, 2) if messages else F.lit(0.0)
    return out.select("theme", F.replace("name", F.lit('"'), F.lit("")).alias("name"), "n", share.alias("share_pct"), F.round(F.col("order_pct") - median, 4).alias("difference"), place.alias("place"), F.sum("sessions").over(W.partitionBy()).alias("shown"))


def debug_report(sizes: DataFrame) -> DataFrame:
    """theme, n, share_pct, kind: themes and the rest apart, of all messages."""
    total = F.broadcast(sizes.agg(F.sum("n").alias("all")))  # one row
    return sizes.join(total, F.lit(True)).select("theme", "n", F.round(F.lit(100.0) * F.col("n") / F.col("all"), 2).alias("share_pct"), F.when(F.col("theme") >= 0, "theme").otherwise("miscellaneous").alias("kind"))


def borderline_lines(assigned: DataFrame, themes: DataFrame) -> DataFrame:
    """message, line: what each borderline message was assigned to, what came second, and the gap."""
    names = themes.select("theme", "name")
    second = names.select(F.col("theme").alias("second_theme"), F.col("name").alias("second_name"))
    out = assigned.where("was_borderline = 1").join(names, "theme", "left").join(second, "second_theme", "left")
    unknown = lambda c: F.coalesce(c, F.lit("Unknown"))
    line = F.format_string("%s | %s %.4f | %s %.4f | gap %.4f", "text", unknown(F.col("name")), "best", unknown(F.col("second_name")), "second", F.col("best") - F.col("second"))
    return out.select("message", line.alias("line"))
