"""Exact deduplication by composable polynomial fingerprints (operator 4).

A text's fingerprint is the polynomial of its UTF-8 bytes at two bases, modulo the prime 2^31-1. Chunks are hashed side
by side, and the hash of xy is hash(x) * base^len(y) + hash(y), so a huge text is never hashed in one go. Rows with equal
(length, fingerprint) are candidates; their texts are then compared chunk by chunk in a grouping with map-side partial
aggregates. Should different texts share a fingerprint, those groups are split by the texts themselves.

Defined results: null text counts as empty; empty texts are equal to each other; a null doc_id is smaller than any other;
rows that repeat a doc_id are returned as often as they occur (each is kept if its id is the group's); an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import attach, documents, dropped_ids, materialize, slices, without_ids

P = (1 << 31) - 1
BASES = (1_103_515_245, 1_812_433_253)
CHUNK = 1 << 16
#: Characters of a chunk in the comparison.
COMPARE_CHARS = 1 << 15
#: Groups with more than one row are broadcast up to this number (24 bytes each), else joined by shuffle.
BROADCAST_GROUPS = 200_000
KEY = ["n_bytes", "f1", "f2"]


def powers(base: int, n: int = CHUNK) -> np.ndarray:
    """base^0 .. base^n modulo P."""
    out = np.ones(1, np.uint64)
    while len(out) <= n:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), P)) % np.uint64(P)])
    return out[: n + 1]


def combine(left: int, right: int, right_len: int, base: int) -> int:
    """Hash of a concatenation from the hashes of its parts."""
    return (left * pow(base, right_len, P) + right) % P


def fingerprints(blobs: list[bytes], base: int, pw: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    sizes = np.fromiter(map(len, blobs), np.int64, len(blobs))
    out = np.zeros(len(blobs), np.int64)
    full = sizes > 0
    if not full.any():
        return out
    data = np.frombuffer(b"".join(blobs), np.uint8)
    ends = np.cumsum(sizes)
    parts = -(-sizes // chunk)
    owner = np.repeat(np.arange(len(blobs)), parts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
    starts = (ends - sizes)[owner] + nth * chunk
    lengths = np.minimum(chunk, ends[owner] - starts)
    exponent = np.repeat(starts + lengths - 1, lengths) - np.arange(len(data))
    values = np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * pw[exponent], starts) % np.uint64(P)
    for o, v, n in zip(owner.tolist(), values.tolist(), lengths.tolist(), strict=True):
        out[o] = combine(int(out[o]), v, n, base)
    return out


def add_fingerprints(docs: DataFrame, modulus: int = P) -> DataFrame:
    """doc_id, text and KEY. A modulus smaller than P makes collisions likely; tests use it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pws = [powers(b) for b in BASES]
        for ids, texts in slices(batches):
            blobs = [t.encode() for t in texts]
            f = [fingerprints(blobs, b, pw) % modulus for b, pw in zip(BASES, pws, strict=True)]
            yield pa.RecordBatch.from_arrays([ids, pa.array(texts, pa.string()), pa.array(map(len, blobs), pa.int64()), pa.array(f[0]), pa.array(f[1])], ["doc_id", "text", *KEY])

    return documents(docs).mapInArrow(run, "doc_id long, text string, n_bytes long, f1 long, f2 long")


def exact_groups(docs: DataFrame, modulus: int = P) -> DataFrame:
    """One row for each of docs: doc_id, keep_id, group_size, kept, text_sha256. See the module's text."""
    prints = materialize(add_fingerprints(docs, modulus).select("doc_id", *KEY, F.sha2("text", 256).alias("text_sha256")), "exact")
    total = prints.count()
    stats = [F.count("*").alias("group_size"), F.max("doc_id").alias("keep_id")]
    groups = materialize(prints.groupBy(*KEY).agg(*stats).where("group_size > 1"), "exact")
    found = groups.select(*KEY)
    found = F.broadcast(found) if groups.count() <= BROADCAST_GROUPS else found
    members = add_fingerprints(docs, modulus).join(found, KEY)
    chunks = members.select(*KEY, F.posexplode(F.expr(f"transform(sequence(0, greatest(length(text) - 1, 0) div {COMPARE_CHARS}), i -> substring(text, i * {COMPARE_CHARS} + 1, {COMPARE_CHARS}))")).alias("nth", "chunk"))
    differ = chunks.groupBy(*KEY, "nth").agg(F.min("chunk").alias("low"), F.max("chunk").alias("high")).where("low <> high").select(*KEY).distinct()
    differ = materialize(differ, "exact")
    clash = differ.count()
    out = attach(prints if not clash else prints.join(differ, KEY, "left_anti"), groups if not clash else groups.join(differ, KEY, "left_anti"), KEY, "group_size", total)
    if clash:  # equal fingerprints of different texts: group by the text itself
        own = add_fingerprints(docs, modulus).join(differ, KEY, "left_semi")
        texts = own.groupBy("text").agg(*stats)
        out = out.unionByName(own.join(texts, "text").select("doc_id", *KEY, F.sha2("text", 256).alias("text_sha256"), "group_size", "keep_id"))
    size = F.coalesce("group_size", F.lit(1)).cast("long")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return out.select("doc_id", keep.alias("keep_id"), size.alias("group_size"), F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256")


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with all their columns; rows that share an id stay together."""
    return without_ids(docs, dropped_ids(exact_groups(docs), "exact"))
