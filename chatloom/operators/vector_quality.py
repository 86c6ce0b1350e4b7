"""Centroids, coherence, silhouette, outliers of clustered vectors.

Coherence and silhouette with cosine distance need no pairs: with unit vectors u, the sum of cosines of a vector with a whole cluster is its
product with the cluster's sum S, so each row meets one vector for each cluster, and the work grows with rows x clusters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.functions.vectors import cosine, dot, euclidean, norm
from chatloom.operators.graph import checkpointed, ranked
from chatloom.operators.neighbours import nearest


def unit(df: DataFrame) -> DataFrame:
    n = F.col("_norm")  # a column of its own, or it is worked out again for each number
    return df.withColumn("_norm", norm(F.col("v"))).withColumn("u", F.when(n > 0, F.transform("v", lambda x: x.cast("double") / n)).otherwise(F.transform("v", lambda x: F.lit(0.0)))).drop("_norm")


def vector_sums(df: DataFrame, by: str, v: str) -> DataFrame:
    """by, n, sums: the element-wise sum of vectors, added up place by place before the shuffle."""
    long = df.select(by, F.posexplode(v).alias("pos", "x")).groupBy(by, "pos").agg(F.sum(F.col("x").cast("double")).alias("s"), F.count("*").alias("n"))
    return long.groupBy(by).agg(F.max("n").alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("pos", "s"))), lambda x: x["s"]).alias("sums"))


def centroids(df: DataFrame, by: str = "cluster") -> DataFrame:
    return vector_sums(df, by, "v").select(by, "n", F.transform("sums", lambda x: x / F.col("n")).alias("centroid"))


def mean_cosine(df: DataFrame) -> DataFrame:
    """cluster, n, mean pairwise cosine: (|S|^2 - sum |u|^2) / (n (n - 1)); 1 for a single vector."""
    u = unit(df)
    own = u.groupBy("cluster").agg(F.sum(dot(F.col("u"), F.col("u"))).alias("own"))
    s = vector_sums(u, "cluster", "u").join(own, "cluster")
    n = F.col("n")
    return s.select("cluster", "n", F.when(n > 1, (dot(F.col("sums"), F.col("sums")) - F.col("own")) / (n * (n - 1))).otherwise(1.0).alias("mean_cosine"))


def coherence(df: DataFrame) -> DataFrame:
    """cluster, n, coherence: mean pairwise cosine times (1 - its population deviation), 1 for a single vector. With unit vectors u and S their sum,
    the cosines of all ordered pairs add up to |S|^2 and their squares to the squared Frobenius norm of the sum of u u^T, so a cluster
    takes one d x d sum, added up in each task before the shuffle, and no pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple] = {}
        for b in batches:
            if len(b):
                cluster, u = b.column(0).to_numpy(), np.array(b.column(1).to_pylist(), np.float64)
                for k in np.unique(cluster).tolist():
                    x = u[cluster == k]
                    own = (x * x).sum(1)
                    part = (len(x), own.sum(), (own * own).sum(), x.sum(0), x.T @ x)
                    sums[k] = tuple(a + c for a, c in zip(sums[k], part, strict=True)) if k in sums else part
        for k, (n, own, squares, s, gram) in sums.items():
            flat = np.concatenate([[n, own, squares], s, gram.ravel()])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(flat), k)), pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat), pa.array(np.full(len(flat), len(s), np.int32))], ["cluster", "at", "x", "d"])

    sums = unit(df).select("cluster", "u").mapInArrow(run, "cluster long, at int, x double, d int").groupBy("cluster", "at").agg(F.sum("x").alias("x"), F.max("d").alias("d"))
    x, at, d = F.col("x"), F.col("at"), F.col("d")
    total = lambda where, v=x: F.sum(F.when(where, v).otherwise(0.0))
    each = sums.groupBy("cluster").agg(total(at == 0).alias("n"), total(at == 1).alias("own"), total(at == 2).alias("squares"), total((at > 2) & (at < 3 + d), x * x).alias("sum"), total(at >= 3 + d, x * x).alias("gram"))
    pairs = F.col("n") * (F.col("n") - 1)
    mean = (F.col("sum") - F.col("own")) / pairs
    deviation = F.sqrt(F.greatest((F.col("gram") - F.col("squares")) / pairs - mean * mean, F.lit(0.0)))
    return each.select("cluster", F.col("n").cast("long").alias("n"), F.when(F.col("n") > 1, mean * (1 - deviation)).otherwise(1.0).alias("coherence"))


def silhouette(df: DataFrame) -> DataFrame:
    """id, cluster, silhouette with cosine distance; 0 in clusters of one. The clusters' sums are a small table."""
    u = unit(df)
    sums = vector_sums(u, "cluster", "u").select(F.col("cluster").alias("other"), "n", "sums")
    met = u.join(F.broadcast(sums), F.lit(True))  # rows x clusters
    same = F.col("cluster") == F.col("other")
    total = F.col("n") - dot(F.col("u"), F.col("sums"))
    far = met.select("id", "cluster", F.when(same, F.when(F.col("n") > 1, (total - (1 - dot(F.col("u"), F.col("u")))) / (F.col("n") - 1))).alias("a"), F.when(~same, total / F.col("n")).alias("b"), F.when(same, F.col("n")).alias("own"))
    each = far.groupBy("id", "cluster").agg(F.max("a").alias("a"), F.min("b").alias("b"), F.max("own").alias("own"))
    s = F.when((F.col("own") > 1) & F.col("b").isNotNull(), (F.col("b") - F.col("a")) / F.greatest("a", "b")).otherwise(0.0)
    return each.select("id", "cluster", s.alias("silhouette"))


def silhouette_report(df: DataFrame) -> DataFrame:
    return silhouette(df).groupBy("cluster").agg(F.count("*").alias("n"), F.round(F.avg("silhouette"), 6).alias("avg_silhouette"), F.round(F.avg((F.round("silhouette", 9) > 0).cast("double")), 4).alias("positive_share"))


def dispersion(df: DataFrame) -> DataFrame:
    """Distances to the centroid: quartiles, coefficient of variation, upper fence (q3 + 0.5 IQR) and outliers beyond it."""
    d = df.join(F.broadcast(centroids(df)), "cluster").select("cluster", euclidean(F.col("v"), F.col("centroid")).alias("d"))
    stat = d.groupBy("cluster").agg(F.percentile("d", F.lit(0.25)).alias("q1"), F.percentile("d", F.lit(0.75)).alias("q3"), (F.stddev_pop("d") / F.avg("d")).alias("cv"))
    fence = F.col("q3") + 0.5 * (F.col("q3") - F.col("q1"))
    out = d.join(F.broadcast(stat), "cluster").withColumn("beyond", (F.round("d", 9) > F.round(fence, 9)).cast("int"))
    return out.groupBy("cluster").agg(F.round(F.first("q1"), 6).alias("q1"), F.round(F.first("q3"), 6).alias("q3"), F.round(F.first("cv"), 6).alias("cv"), F.sum("beyond").alias("outliers"))


def similar_pairs(themes: DataFrame, least: float) -> DataFrame:
    """a, b, similarity of theme centroids; themes are few."""
    a, b = themes.select(F.col("cluster").alias("a"), F.col("centroid").alias("va")), themes.select(F.col("cluster").alias("b"), F.col("centroid").alias("vb"))
    return a.join(b, F.col("a") < F.col("b")).select("a", "b", F.round(cosine(F.col("va"), F.col("vb")), 9).alias("similarity")).where(F.col("similarity") >= least)


def local_outliers(df: DataFrame, k: int = 20, share: float = 0.1) -> DataFrame:
    """id, lof, outlier: exact local outlier factors; the `share` of all vectors with the highest ones (ties: the smaller id) are outliers."""
    near = checkpointed(nearest(df, k))
    reach = near.groupBy(F.col("a").alias("b")).agg(F.max("d").alias("kd"))
    density = checkpointed(near.join(reach, "b").groupBy("a").agg((1 / F.greatest(F.avg(F.greatest("d", "kd")), F.lit(1e-10))).alias("lrd")))
    lof = near.join(density.select(F.col("a").alias("b"), F.col("lrd").alias("their")), "b").join(density, "a").groupBy("a").agg(F.round(F.avg("their") / F.first("lrd"), 6).alias("lof"))
    places = ranked(lof, [F.desc("lof"), F.asc("a")], "nth")
    most = int(places.count() * share)
    return places.select(F.col("a").alias("id"), "lof", (F.col("nth") < most).cast("int").alias("outlier"))
