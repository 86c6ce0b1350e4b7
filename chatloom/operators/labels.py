"""Labels of concerns: merging in two rounds, multiple labels, history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions.vectors import cosine, euclidean
from chatloom.operators.graph import checkpointed
from chatloom.operators.vector_quality import centroids

#: Distances up to the median times this merge, in the first round and in the second; messages that a label needs to stay.
FIRST_ROUND, SECOND_ROUND, LEAST_MESSAGES = 1.02, 1.0, 5


def tags(label: Column) -> Column:
    """The labels of a JSON list, null if it isn't one."""
    return F.when(label.startswith("["), F.from_json(label, "array<string>", {"mode": "PERMISSIVE"}))


def split_multiple(df: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """Rows with one label or none, and rows with a list of several."""
    many = F.coalesce(F.size(tags(F.col(label))) > 1, F.lit(False))
    return df.where(~many), df.where(many)


def atomic_counts(df: DataFrame, label: str, ident: str) -> DataFrame:
    """label, n, ids: each single label with its rows, lists taken apart, and the ids that have it, in order."""
    each = df.where(F.col(label).isNotNull()).select(ident, F.explode(F.coalesce(tags(F.col(label)), F.array(label))).alias("label"))
    return each.groupBy("label").agg(F.count("*").alias("n"), F.array_sort(F.collect_set(ident)).alias("ids"))


def group_distances(labels: DataFrame, groups: DataFrame) -> DataFrame:
    """a, b, d: Euclidean distances of the centroids of all groups, a < b. Groups of labels are few."""
    middle = centroids(groups.join(labels.select("label", "v"), "label"), "grp")
    a, b = (middle.select(F.col("grp").alias(c), F.col("centroid").alias(f"v{c}")) for c in "ab")
    return a.join(b, F.col("a") < F.col("b")).select("a", "b", F.round(euclidean(F.col("va"), F.col("vb")), 9).alias("d"))


def valid_metas(metas: DataFrame, distances: DataFrame, factor: float = FIRST_ROUND) -> DataFrame:
    """meta, average: suggested unions of groups all of whose known pairs are no farther apart than the median of all pairs times factor; metas: meta, grp."""
    limit = F.broadcast(distances.agg((F.percentile("d", F.lit(0.5)) * factor).alias("limit")))  # one row
    a, b = metas.select("meta", F.col("grp").alias("a")).distinct(), metas.select("meta", F.col("grp").alias("b")).distinct()
    pairs = a.join(b, "meta").where("a < b").join(distances, ["a", "b"]).join(limit, F.lit(True))
    good = pairs.groupBy("meta").agg(F.max((F.round("d", 9) > F.round("limit", 9)).cast("int")).alias("far"), F.round(F.avg("d"), 9).alias("average"))
    return good.where("far = 0").select("meta", "average")


def without_conflicts(valid: DataFrame, metas: DataFrame) -> DataFrame:
    """meta of the unions that are used: by rising average (ties: the smaller meta), each whose groups no used one has. A union that no better one
    touches is used, what it touches is not, and so on with the rest: rounds, not a loop over unions."""
    touching = metas.alias("x").join(metas.alias("y"), F.expr("x.grp = y.grp and x.meta <> y.meta")).select(F.col("x.meta").alias("meta"), F.col("y.meta").alias("other")).distinct()
    touching = checkpointed(touching)
    rest = checkpointed(valid.select("meta", F.struct("average", "meta").alias("rank")))
    used = rest.select("meta").limit(0)
    while not rest.isEmpty():  # a table for each round
        ranks = rest.select(F.col("meta").alias("other"), F.col("rank").alias("theirs"))
        beaten = touching.join(rest, "meta").join(ranks, "other").where("theirs < rank").select("meta").distinct()
        best = checkpointed(rest.join(beaten, "meta", "left_anti").select("meta"))
        used = used.union(best)
        gone = best.union(touching.join(best.withColumnRenamed("meta", "other"), "other", "left_semi").select("meta")).distinct()
        rest = checkpointed(rest.join(gone, "meta", "left_anti"))
    return used


def first_round(labels: DataFrame, groups: DataFrame, metas: DataFrame, used: DataFrame) -> DataFrame:
    """old, canonical of labels that the first round merges: labels of a group, or of a used union of groups, take its commonest label (ties: the first
    in alphabetical order)."""
    union = groups.join(metas.join(used, "meta", "left_semi"), "grp", "left").select("label", F.coalesce((-F.col("meta") - 1), F.col("grp")).alias("final"))
    known = union.join(labels.select("label", "n"), "label", "left")
    best = known.groupBy("final").agg(F.min(F.struct((-F.coalesce("n", F.lit(0))).alias("n"), "label")).alias("b")).select("final", F.col("b.label").alias("canonical"))
    return known.join(best, "final").where("label <> canonical").select(F.col("label").alias("old"), "canonical")


def merged_tags(df: DataFrame, label: str, merges: DataFrame, ident: str) -> DataFrame:
    """ident, label: the rows with merged labels; in a list each label is merged, repeats go, one that is left stands alone, several are a sorted
    list again; what only looks like a list is a plain label."""
    listed = df.select(ident, label, F.posexplode(F.coalesce(tags(F.col(label)), F.array(label))).alias("at", "tag"))
    named = listed.join(merges, F.col("tag") == F.col("old"), "left").select(ident, "at", F.coalesce("canonical", "tag").alias("tag"))
    packed = named.groupBy(ident).agg(F.array_sort(F.collect_set("tag")).alias("tags"))  # one row's labels
    out = F.when(F.size("tags") == 1, F.get("tags", F.lit(0))).when(F.size("tags") > 1, F.concat(F.lit('["'), F.array_join("tags", '", "'), F.lit('"]')))
    return packed.select(ident, out.alias("label"))


def by_size(labels: DataFrame, least: int = LEAST_MESSAGES) -> DataFrame:
    """Adds kind: regular from `least` messages on, else low_frequency."""
    return labels.withColumn("kind", F.when(F.col("n") >= least, "regular").otherwise("low_frequency"))


def known_suggestions(suggested: DataFrame, labels: DataFrame) -> DataFrame:
    """Suggestions low, target whose low label is rare and whose target is regular."""
    kinds = by_size(labels)
    return suggested.join(kinds.where("kind = 'low_frequency'").select(F.col("label").alias("low")), "low", "left_semi").join(kinds.where("kind = 'regular'").select(F.col("label").alias("target")), "target", "left_semi")


def second_round(labels: DataFrame, suggested: DataFrame, excluded: list[str] = (), factor: float = SECOND_ROUND) -> DataFrame:
    """low, target of each rare label: the suggested regular label if it isn't farther (1 - cosine) than the median over all rare and regular labels but the excluded
    ones (case counts) times factor; else null: the label goes."""
    kinds = by_size(labels)
    rare = kinds.where("kind = 'low_frequency'").select(F.col("label").alias("low"), F.col("v").alias("a"))
    regular = kinds.where((F.col("kind") == "regular") & ~F.col("label").isin("", *excluded)).select(F.col("label").alias("target"), F.col("v").alias("b"))
    pairs = rare.join(regular, F.lit(True)).select("low", "target", F.round(1 - cosine(F.col("a"), F.col("b")), 9).alias("d"))  # labels are few
    limit = F.broadcast(pairs.agg((F.percentile("d", F.lit(0.5)) * factor).alias("limit")))  # one row
    near = pairs.join(suggested, ["low", "target"]).join(limit, F.lit(True)).where(F.col("d") <= F.round("limit", 9))
    best = near.groupBy("low").agg(F.min(F.struct("d", "target")).alias("b")).select("low", F.col("b.target").alias("target"))
    return rare.select("low").join(best, "low", "left")


def merge_history(final: DataFrame, first: DataFrame, second: DataFrame, removed: DataFrame) -> DataFrame:
    """name, labels, originals, kind of every final label (label), deleted rare label and removed list (label): how it came about. first: old,
    canonical; second: low, target (null: deleted)."""
    one = first.groupBy(F.col("canonical").alias("label")).agg(F.array_sort(F.collect_list("old")).alias("r1"))
    two = second.where("target is not null").groupBy(F.col("target").alias("label")).agg(F.array_sort(F.collect_list("low")).alias("r2"))
    none = F.array().cast("array<string>")
    rows = final.select("label").join(one, "label", "left").join(two, "label", "left")
    kind = F.when(F.col("r1").isNotNull() & F.col("r2").isNotNull(), "Round 1 + Round 2 Merge").when(F.col("r1").isNotNull(), "Round 1 Merge").when(F.col("r2").isNotNull(), "Round 2 Merge").otherwise("No Merge")
    every = F.concat(F.array("label"), F.coalesce("r1", none), F.coalesce("r2", none))
    rows = rows.select(F.col("label").alias("name"), F.size(every).cast("long").alias("labels"), F.array_join(every, ", ").alias("originals"), kind.alias("kind"))
    gone = lambda df, c, name, kind: df.select(F.lit(name).alias("name"), F.lit(0).cast("long").alias("labels"), F.col(c).alias("originals"), F.lit(kind).alias("kind"))
    return rows.unionByName(gone(second.where("target is null"), "low", "[DELETED]", "Round 2 Deleted")).unionByName(gone(removed, "label", "[REMOVED]", "Multi-tag Removed"))


def status_counts(history: DataFrame) -> DataFrame:
    """status, step, n of the labels' history; a label counts once."""
    return history.groupBy("status", "step").agg(F.countDistinct("label").alias("n"))
