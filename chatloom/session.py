"""Session defaults and table readers shared by every query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, partitions: int = 8, app: str = "chatloom", **conf: str) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.host", "127.0.0.1")
    )
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables, a file or a folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
