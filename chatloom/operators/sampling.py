"""Samples that keep the variety of messages: by clusters of their vectors, by density; fewer dimensions."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chatloom.functions.vectors import euclidean

SEED, DIVISOR = 42, 10


def drawn(ident: str = "id", seed: int = SEED) -> Column:
    """An order of rows as good as random, the same in every run and engine."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(ident).cast("string")))


def kmeans_strata(df: DataFrame, k: int, seed: int = SEED) -> DataFrame:
    """id, cluster, distance (to the cluster's centre) of id, v, by k-means."""
    table = df.select("id", array_to_vector(F.transform("v", lambda x: x.cast("double"))).alias("features"))
    model = KMeans(k=k, seed=seed, maxIter=20).fit(table)
    centres = table.sparkSession.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())], "cluster int, centre array<double>")
    found = model.transform(table).withColumnRenamed("prediction", "cluster").join(F.broadcast(centres), "cluster")  # k rows
    return found.select("id", F.col("cluster").cast("long").alias("cluster"), F.round(euclidean(vector_to_array("features"), F.col("centre")), 9).alias("distance"))


def stratified(strata: DataFrame, size: int) -> DataFrame:
    """id of about `size` rows of id, cluster, distance: of each cluster the one nearest to its centre (ties: the smaller id), then its share of the
    rest, at least one, drawn at random; what is still missing is drawn from all, and of too many those with the smallest ids stay."""
    w = W.partitionBy("cluster")
    rows = strata.withColumn("nth", F.row_number().over(w.orderBy("distance", "id"))).withColumn("draw", drawn())
    first, rest = rows.where("nth = 1"), rows.where("nth > 1")
    n_first, n_rest = first.count(), rest.count()
    if size >= n_first + n_rest:
        return strata.select("id")
    left = size - n_first
    quota = F.greatest(F.lit(1), F.floor(F.lit(float(left)) * F.col("size") / max(n_rest, 1)))
    rest = rest.withColumn("size", F.count("*").over(w)).withColumn("place", F.row_number().over(w.orderBy("draw", "id")))
    chosen = first.select("id") if left <= 0 else first.select("id").union(rest.where(F.col("place") <= quota).select("id"))
    missing = size - chosen.count()
    if missing > 0:
        chosen = chosen.union(strata.join(chosen, "id", "left_anti").orderBy(drawn(), "id").select("id").limit(missing))
    return chosen.orderBy("id").limit(size)


def kmeans_sample(df: DataFrame, size: int) -> DataFrame:
    """id of `size` rows of id, v, spread over max(5, size / DIVISOR) k-means clusters; all rows if they are no more than `size`."""
    n = df.limit(size + 1).count()
    return df.select("id") if n <= size else stratified(kmeans_strata(df, min(max(5, size // DIVISOR), n - 1)), size)


def density_quotas(sizes: DataFrame, size: int) -> DataFrame:
    """label, n, quota: shares of `size`, at least three of a cluster (label 0 or more) and two of noise, never more than there are; if that is too
    many in all, each is scaled down, to one at least."""
    total, quota = F.broadcast(sizes.agg(F.sum("n").alias("all"))), F.floor(F.lit(float(size)) * F.col("n") / F.col("all"))  # one row
    first = sizes.join(total, F.lit(True)).withColumn("quota", F.least("n", F.greatest(quota, F.when(F.col("label") >= 0, 3).otherwise(2))))
    given = F.broadcast(first.agg(F.sum("quota").alias("given")))  # one row
    scaled = F.greatest(F.lit(1), F.floor(F.col("quota") * (F.lit(float(size)) / F.col("given"))))
    return first.join(given, F.lit(True)).select("label", "n", F.when(F.col("given") > size, scaled).otherwise(F.col("quota")).cast("long").alias("quota"))


def density_sample(labelled: DataFrame, size: int) -> DataFrame:
    """id, label: each label's quota of id, label, drawn at random; what is still missing is drawn from all, and of too many those with the smallest
    ids stay."""
    quotas = density_quotas(labelled.groupBy("label").agg(F.count("*").alias("n")), size)
    ranked = labelled.withColumn("place", F.row_number().over(W.partitionBy("label").orderBy(drawn(), "id")))
    chosen = ranked.join(F.broadcast(quotas), "label").where("place <= quota").select("id", "label")  # one row a label
    missing = size - chosen.count()
    if missing > 0:
        chosen = chosen.union(labelled.join(chosen.select("id"), "id", "left_anti").orderBy(drawn(), "id").limit(missing).select("id", "label"))
    return chosen.orderBy("id").limit(size)


def fewer_dimensions(df: DataFrame, k: int) -> DataFrame:
    """id, v with k principal components of the vectors at length 1."""
    norm = F.col("norm")  # a column of its own, or it is worked out again for each number
    table = df.select("id", "v", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("norm"))
    table = table.select("id", array_to_vector(F.transform("v", lambda x: F.when(norm > 0, x / norm).otherwise(0.0).cast("double"))).alias("features"))
    return PCA(k=k, inputCol="features", outputCol="reduced").fit(table).transform(table).select("id", vector_to_array("reduced").alias("v"))
