"""Vectors of texts without a model: signed hashed features, idf and a random projection.

Features are words, runs of two words and groups of three letters within words, each with a sign of its own hash, counted in BUCKETS buckets. How many texts have a bucket is one
aggregate over all texts, and only those BUCKETS counts pass the driver. A text's vector is the sum of its buckets' weights times the rows of a
random matrix that every task draws from the same seed, at length 1; a text without features has zeros."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS, DIMENSIONS, SEED = 1 << 15, 256, 42
#: How much a word, a run of two words and a group of letters count.
SHARES = (1.0, 0.7, 0.3)
#: ASCII signs but letters and digits as blanks; most texts need no look at each sign.
_BLANKS = {i: " " for i in range(128) if not chr(i).isalnum()}


#: Words whose letter groups, and parts whose hashes, a worker remembers at most; longer ones are made each time.
REMEMBERED, REMEMBERED_CHARS = 100_000, 32
_groups: dict[str, list[str]] = {}
_hashes: dict[float, dict[str, int]] = {}


def _groups_of(word: str) -> list[str]:
    found = _groups.get(word)
    if found is None:
        found = [f"^{word}$"[i : i + 3] for i in range(len(word))]
        if len(word) <= REMEMBERED_CHARS:
            if len(_groups) >= REMEMBERED:
                _groups.clear()
            _groups[word] = found
    return found


def _hashes_of(parts: Iterable[str], share: float) -> list[int]:
    """crc32 of each part with its share."""
    known = _hashes.setdefault(share, {})
    if len(known) >= REMEMBERED:
        known.clear()
    out = []
    for p in parts:
        h = known.get(p)
        if h is None:
            h = crc32(f"{share}:{p}".encode())
            if len(p) <= REMEMBERED_CHARS and len(known) < REMEMBERED:
                known[p] = h
        out.append(h)
    return out


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Different buckets of a text, in order, and their signed weights before idf (1 + ln of how often)."""
    words = (text.lower().translate(_BLANKS) if text.isascii() else "".join([c if c.isalnum() else " " for c in text.lower()])).split()
    if not words:
        return np.zeros(0, np.int64), np.zeros(0)
    single = Counter(words)
    pairs = Counter(map(" ".join, zip(words, words[1:])))
    groups: dict[str, int] = {}
    for w, n in single.items():
        for g in _groups_of(w):
            groups[g] = groups.get(g, 0) + n
    kinds = list(zip(SHARES, (single, pairs, groups), strict=True))
    hashes = np.array([h for share, counts in kinds for h in (_hashes_of(counts, share) if counts is not pairs else [crc32(f"{share}:{p}".encode()) for p in counts])], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    weight = np.concatenate([share * (1 + np.log(np.fromiter(counts.values(), np.float64, len(counts)))) for share, counts in kinds])
    signed = np.where(hashes >> np.uint64(63) > 0, weight, -weight)
    bucket = (hashes >> np.uint64(20)).astype(np.int64) % BUCKETS
    at, inverse = np.unique(bucket, return_inverse=True)
    return at, np.bincount(inverse, signed, len(at))


@lru_cache(2)
def projection(dimensions: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((BUCKETS, dimensions)).astype(np.float32) / np.sqrt(dimensions)


def text_vectors(texts: DataFrame, dimensions: int = DIMENSIONS, seed: int = SEED) -> DataFrame:
    """id, v of id, text; a null text has no features."""
    spark = texts.sparkSession
    rows = texts.select("id", F.coalesce("text", F.lit("")).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(BUCKETS, np.int64), 0
        for b in batches:
            for t in b.column(0):
                seen[features(t.as_py())[0]] += 1
                n += 1
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, used].astype(np.int32)), pa.array(np.r_[n, seen[used]])], ["bucket", "n"])

    found = rows.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # BUCKETS rows
    counts = np.zeros(BUCKETS)
    total = 0
    for r in found:
        if r["bucket"] < 0:
            total = r["n"]
        else:
            counts[r["bucket"]] = r["n"]
    idf = spark.sparkContext.broadcast(np.log((total + 1) / (counts + 1)) + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = projection(dimensions, seed)
        for b in batches:
            for low in range(0, len(b), 256):
                part = b.slice(low, 256)
                out = np.zeros((len(part), dimensions))
                for i, t in enumerate(part.column(1)):
                    at, weight = features(t.as_py())
                    if len(at):
                        v = (weight * idf.value[at]) @ matrix[at]
                        out[i] = v / max(np.linalg.norm(v), 1e-12)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * dimensions), pa.array(out.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], ["id", "v"])

    kind = texts.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, v array<double>")
