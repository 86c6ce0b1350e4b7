"""From documents to token windows: quality, exact copies, near copies, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written to the shared folder and read again as
the next stage's docs. All but the last return the columns of documents. No row is rewritten, rows are only dropped: first
those that the quality classifier rejects, then all but the largest doc_id of equal texts, then all but the smallest doc_id of
near copies, then those that hold a benchmark item. Rows that share a doc_id, also a null one, go or stay together but in the first stage, which judges
each row by its text. Empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chatloom.llm import packing
from chatloom.llm.common import discard, last_table, materialize, only_last_table
from chatloom.llm.decontam import drop_contaminated
from chatloom.llm.exact_dedup import drop_exact_copies
from chatloom.llm.minhash import drop_near_copies
from chatloom.llm.quality import drop_low_quality


#: Words that a worker remembers while it packs.
REMEMBERED = 100_000


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_low_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Written in small batches; workers that earlier stages have used remember fewer words."""
    return materialize(packing.digest(packing.pack_documents(docs, remembered=REMEMBERED)), "packed")


STAGES = [("quality", quality), ("exact dedup", exact), ("near dedup", near), ("decontamination", benchmark), ("packing", pack)]
#: The first, third and fifth stage can't be said in SQL; tests hold each stage and the run against a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, read from its table. Of the tables that a stage writes only its result is left, and that until the next stage's result is written."""
    docs, read = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        with only_last_table(spark):
            docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if read:
            discard(spark, [read])
        read = last_table()
    packed = STAGES[-1][1](spark, docs, sf_dir)
    discard(spark, [read])
    return packed
