"""Helpers that the text operators share: shared-folder tables, bounded slices of Arrow batches, skew-safe joins."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Python workers are reused, and what a pool keeps for the next batch of one operator isn't there for the other worker or the JVM: freed buffers go back at once.
pa.set_memory_pool(pa.system_memory_pool())

#: Characters that one numpy step holds; a longer text forms a step of its own.
SLICE_CHARS = 300_000
#: A key is hot beyond a 256th of the rows, so there are never more than 256 hot keys.
HOT_SHARE = 256


_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. Only a session without one (tests) gets a folder of its own."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = spark.sparkContext.applicationId
        found = _own_dirs.get(app) or _own_dirs.setdefault(app, tempfile.mkdtemp(prefix="chatloom-"))
    return found.rstrip("/")


#: Folders that materialize() wrote and that are still there, in order.
_tables: list[str] = []


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Cut lineage: write df as Parquet to the shared folder and read it again."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    with small_batches(spark):
        df.write.option("compression", "zstd").parquet(path)
    _tables.append(path)
    _give_back()
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of an Arrow batch: executors hold some of them outside the heap for each task, and workers hold them as Python objects too.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Batches of at most BATCH_BYTES (a row is never divided) while a table is written; smaller ones that the session asks for stay."""
    before = spark.conf.get(_BATCH, None)
    bytes_asked = before.removesuffix("b") if before else ""
    if bytes_asked.isdigit() and 0 < int(bytes_asked) <= BATCH_BYTES:
        yield
        return
    spark.conf.set(_BATCH, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before) if before else spark.conf.unset(_BATCH)


def _give_back() -> None:
    """The driver's Python returns what models and counts of earlier steps took."""
    gc.collect()
    trim()


def trim() -> None:
    """Freed memory goes back to the system: a reused worker that waits for its next task holds none."""
    with suppress(OSError, AttributeError):  # only the GNU library has it
        ctypes.CDLL(None).malloc_trim(0)


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables that nothing reads any more."""
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        _tables.remove(path)


@contextmanager
def only_last_table(spark: SparkSession) -> Iterator[None]:
    """Of the tables written within, delete all but the last one, which must not be read through the others."""
    before = set(_tables)
    yield
    discard(spark, [p for p in _tables if p not in before][:-1])


def last_table() -> str:
    return _tables[-1]


#: Ids (some 50 bytes each) that are broadcast at most.
BROADCAST_IDS = 500_000


def without_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, whose doc_id isn't in column gone of ids, null ids included. Ids are broadcast if a count shows
    that they are few, else both sides are shuffled."""
    if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["gone"]), "left_anti")


def dropped_ids(decided: DataFrame, tag: str) -> DataFrame:
    """gone: the ids of which decided (doc_id, kept) keeps no row."""
    gone = decided.groupBy(F.col("doc_id").alias("gone")).agg(F.max("kept").alias("kept")).where("not kept")
    return materialize(gone.select("gone"), tag)


def documents(docs: DataFrame) -> DataFrame:
    """doc_id and text alone, null text as empty: other columns can't clash with what an operator adds."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def slices(batches: Iterator[pa.RecordBatch], limit: int = SLICE_CHARS) -> Iterator[tuple[pa.Array, list[str]]]:
    """(doc_id, texts) of batches with columns doc_id and text, at most `limit` characters at a time."""
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        size = np.diff(np.frombuffer(texts.buffers()[1], _offset_type(texts), len(texts) + 1, texts.offset * (8 if pa.types.is_large_string(texts.type) else 4))) if len(texts) else np.zeros(0, int)
        start, total = 0, 0
        for i, n in enumerate(size.tolist()):
            if total + n > limit and i > start:
                yield ids.slice(start, i - start), texts.slice(start, i - start).to_pylist()
                start, total = i, 0
            total += n
        if start < len(texts):
            yield ids.slice(start), texts.slice(start).to_pylist()
    trim()


def _offset_type(x: pa.Array):
    return np.int64 if pa.types.is_large_string(x.type) else np.int32


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row, and the length of each text."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), sizes


@lru_cache(1)
def word_table() -> np.ndarray:
    """For each code point a 64-bit value of its lower case; 0 for what isn't part of a word."""
    out = np.zeros(0x110000, np.uint64)
    for i in range(0x110000):
        c = chr(i)
        if c.isalnum():
            out[i] = ord(c.lower()[0])
    return np.where(out > 0, mix(out) | np.uint64(1), np.uint64(0))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values with well-spread bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_POWERS = np.cumprod(np.full(256, 0x9E3779B97F4A7C15, np.uint64))


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words (lower-cased runs of letters and digits) of all texts in a row, and how many each text has."""
    cps, sizes = code_points(texts)
    if not len(cps):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    value = word_table()[cps]
    inside = value > 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = np.cumsum(sizes) - sizes
    first = first[(sizes > 0)]
    begins[first] = inside[first]  # a word ends with its text
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    at = np.arange(len(cps), dtype=np.int64)
    since = at - np.maximum.accumulate(np.where(begins, at, 0))
    value *= _POWERS[since & 255] + (since.astype(np.uint64) >> np.uint64(8))
    hashes = mix(np.add.reduceat(value, starts))
    owner = np.searchsorted(np.cumsum(sizes), starts, side="right")
    return hashes, np.bincount(owner, minlength=len(texts))


def attach(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int) -> DataFrame:
    """Left join of rows with one row a key; `size` in groups counts the key's rows. Keys with over a HOT_SHAREth of
    the `total` rows, of which there are fewer than HOT_SHARE, are broadcast, so no key gathers in one task."""
    most = max(1000, total // HOT_SHARE)
    hot = F.broadcast(groups.where(F.col(size) > most))
    a = rows.join(hot, keys, "inner")
    b = rows.join(F.broadcast(groups.where(F.col(size) > most).select(*keys)), keys, "left_anti").join(groups.where(F.col(size) <= most), keys, "left")
    return a.unionByName(b)
