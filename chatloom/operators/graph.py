"""Connected components of pairs, by minimum labels and pointer jumping; places in an order."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _folder(spark: SparkSession) -> str:
    """The application's own folder below spark.checkpoint.dir, cleared when Python ends."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="chatloom-"))
    folder = context.getCheckpointDir()
    if folder not in _cleared:
        _cleared.add(folder)
        atexit.register(_clear, spark, folder)
    return folder


_cleared: set[str] = set()


def _clear(spark: SparkSession, folder: str) -> None:
    with contextlib.suppress(Exception):  # the session may have ended before
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage: df as a table in the folder of spark.checkpoint.dir. Dataset.checkpoint keeps the size estimates of the plan it cuts, and in loops of joins these
    numbers grow to thousands of digits; a table has its real size."""
    path = f"{_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranked(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """df with the place (from 0) of each row in an order without ties: a range sort, and one count a partition to begin from."""
    spark = df.sparkSession
    rows = checkpointed(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    counts = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("n")).orderBy("_part").collect()  # one row a partition
    begins, n = [], 0
    for c in counts:
        begins.append((c["_part"], n))
        n += c["n"]
    begin = F.broadcast(spark.createDataFrame(begins, "_part long, _begin long"))
    return rows.withColumn("_part", part).join(begin, "_part").withColumn(name, F.col("_begin") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_part", "_begin", "_at")


def components(pairs: DataFrame) -> DataFrame:
    """node, label (the smallest node that it is connected to) of pairs a, b; the rounds grow with the logarithm of a component's diameter."""
    both = checkpointed(pairs.select("a", "b").union(pairs.select("b", "a")).where("a <> b").distinct())
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("label"))
    while True:
        seen = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("low"))
        step = labels.join(seen, "node").select("node", F.col("label").alias("old"), F.least("label", "low").alias("label"))
        jump = step.select(F.col("node").alias("label"), F.col("label").alias("further"))
        step = checkpointed(step.join(jump, "label").select("node", "old", F.col("further").alias("label")))
        labels = step.select("node", "label")
        if step.where("label <> old").isEmpty():
            return labels
