"""Substring deduplication by content-defined chunking (operator 10).

A gear hash rolls over the UTF-8 bytes; a chunk ends where its top bits are zero, after MIN to MAX bytes. Where chunks end
depends on the last WINDOW bytes alone, so the chunks of a passage are the same wherever it stands but for its edges. Of chunks
with the same 128-bit digest the first stays, in order of (doc_id, row, place); others are duplicates, which are all counted, and runs of
duplicates of at least RUN bytes are removed. Every run, however short, is also extended byte by byte over its edges, as far as the text
around its first and last chunk agrees with the text around their first copies; those that then touch are joined, and passages are those
of RUN bytes or more. Digests are grouped with map-side partial aggregates, and keys with many rows are joined
by broadcast of those few keys, so a passage that a third of all documents share doesn't gather in one task.

Defined results: a null text counts as empty; rows with the same doc_id are documents of their own, in an arbitrary order;
a null doc_id is the smallest; an empty text has no chunk; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chatloom.llm.common import attach, documents, materialize, slices

#: A hash of 16 bits rolls over 16 bytes; BITS zeros end a chunk.
BITS, MIN, MAX, WINDOW = 5, 16, 256, 16
RUN = 120
GEAR = np.random.default_rng(20).integers(0, 1 << 16, 256, dtype=np.uint16)


def cuts(data: np.ndarray) -> np.ndarray:
    """Places whose rolling hash allows an end, from the sixteenth byte on."""
    h = GEAR[data]
    for k in (1, 2, 4, 8):  # h over 2k bytes from h over k bytes
        if len(h) > k:
            more = h.copy()
            more[k:] += h[:-k] << np.uint16(k)
            h = more
    return np.flatnonzero(h >> np.uint16(16 - BITS) == 0) + 1


def edges(data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all chunks of all texts in a row, and each chunk's text."""
    starts, owner = [], []
    at = cuts(data).tolist()
    i, n, begin = 0, len(at), 0
    for k, size in enumerate(sizes.tolist()):
        end, last = begin + size, begin
        if size:
            starts.append(begin)
            owner.append(k)
        while i < n and at[i] < end:
            c = at[i]
            i += 1
            while c - last > MAX:
                last += MAX
                starts.append(last)
                owner.append(k)
            if c - last >= MIN:
                last = c
                starts.append(c)
                owner.append(k)
        while end - last > MAX:
            last += MAX
            starts.append(last)
            owner.append(k)
        while i < n and at[i] <= end:
            i += 1
        begin = end
    return np.array(starts, np.int64), np.array(owner, np.int64)


def chunk_table(numbered: DataFrame) -> DataFrame:
    """Of doc_id, text and row: row, doc_id, n_bytes, start, size, d1, d2; a text without bytes has one row of size 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(2)
            done = 0
            for ids, texts in slices(iter([batch])):
                blobs = [t.encode() for t in texts]
                sizes = np.fromiter(map(len, blobs), np.int64, len(blobs))
                whole = b"".join(blobs)
                starts, owner = edges(np.frombuffer(whole, np.uint8), sizes)
                first = np.cumsum(sizes) - sizes
                ends = np.r_[starts[1:], len(whole)] if len(starts) else starts
                digests = b"".join(hashlib.blake2b(whole[a:b], digest_size=16).digest() for a, b in zip(starts.tolist(), ends.tolist(), strict=True))
                d = np.frombuffer(digests, "<i8").reshape(-1, 2)
                none = np.flatnonzero(sizes == 0)
                owner_all = np.r_[owner, none]
                zeros = np.zeros(len(none), np.int64)
                own = rows.slice(done, len(texts)).take(pa.array(owner_all))
                yield pa.RecordBatch.from_arrays([own, ids.take(pa.array(owner_all)), pa.array(sizes[owner_all]), pa.array(np.r_[starts - first[owner], zeros]), pa.array(np.r_[ends - starts, zeros]), pa.array(np.r_[d[:, 0], zeros]), pa.array(np.r_[d[:, 1], zeros])], ["row", "doc_id", "n_bytes", "start", "size", "d1", "d2"])
                done += len(texts)

    return numbered.mapInArrow(run, "row long, doc_id long, n_bytes long, start long, size long, d1 long, d2 long")


def contexts(numbered: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """row, at, side, around: up to `size` bytes before (side 0, reversed) or after (side 1) place at; wanted: distinct row, at, side."""
    places = wanted.groupBy("row").agg(F.collect_list(F.struct("at", "side")).alias("places"))  # up to a text's length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, text, found in zip(*(b.column(k) for k in range(3)), strict=True):
                row, data, found = row.as_py(), text.as_py().encode(), found.as_py()
                at, side = [x["at"] for x in found], [x["side"] for x in found]
                around = [data[a : a + size] if s else data[max(a - size, 0) : a][::-1] for a, s in zip(at, side, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([row] * len(at)), pa.array(at), pa.array(side, pa.int32()), pa.array(around, pa.binary())], ["row", "at", "side", "around"])

    return numbered.join(places, "row").select("row", "text", "places").mapInArrow(run, "row long, at long, side int, around binary")


def _agreement(both: DataFrame) -> DataFrame:
    """row, edge, side, first_row, first_edge, more: common bytes at the start of a and b."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            more = []
            for a, b in zip(t.column(5).to_pylist(), t.column(6).to_pylist(), strict=True):
                n = min(len(a), len(b))
                x = np.flatnonzero(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)) if n else ()
                more.append(int(x[0]) if len(x) else n)
            yield pa.RecordBatch.from_arrays([*t.columns[:5], pa.array(more, pa.int64())], ["row", "edge", "side", "first_row", "first_edge", "more"])

    return both.select("row", "edge", "side", "first_row", "first_edge", "a", "b").mapInArrow(run, "row long, edge long, side int, first_row long, first_edge long, more long")


def extensions(numbered: DataFrame, edges: DataFrame) -> DataFrame:
    """row, edge, side, more: bytes over which the text beyond an edge agrees with that of the first copy; edges: row, edge, side,
    first_row, first_edge. In rounds of MAX bytes, then twice as many each, until none goes on."""
    todo, steps, done, size = edges, [], 0, MAX
    key = ["row", "edge", "side", "first_row", "first_edge"]
    while True:
        shift = F.when(F.col("side") == 1, F.lit(done)).otherwise(F.lit(-done)).cast("long")
        asked = [todo.select(*(F.col(c).alias(f"k_{c}") for c in key), F.lit(own).alias("own"), F.col(r).alias("row"), (F.col(e) + shift).alias("at"), "side") for own, r, e in ((True, "row", "edge"), (False, "first_row", "first_edge"))]
        asked = materialize(asked[0].unionByName(asked[1]), "asked")
        wanted = asked.groupBy("row", "at", "side").agg(F.count("*").alias("copies"))
        found = materialize(contexts(numbered, wanted, size).join(wanted, ["row", "at", "side"]), "around")
        got = attach(asked, found, ["row", "at", "side"], "copies", asked.count())
        both = got.groupBy(*(F.col(f"k_{c}").alias(c) for c in key)).agg(F.max(F.when(F.col("own"), F.col("around"))).alias("a"), F.max(F.when(~F.col("own"), F.col("around"))).alias("b"))
        step = materialize(_agreement(both), "agreement")
        steps.append(step.select("row", "edge", "side", "more"))
        todo = step.where(F.col("more") == size).select(*key)
        if todo.isEmpty():
            return materialize(reduce(DataFrame.unionByName, steps).groupBy("row", "edge", "side").agg(F.sum("more").alias("more")), "extensions")
        done, size = done + size, 2 * size


def passages(numbered: DataFrame, runs: DataFrame, least: int) -> DataFrame:
    """row, n_repeated, passages (arrays of start, end in bytes): runs over their edges, joined where they touch, of `least` bytes or more."""
    left = runs.select("row", F.col("start").alias("edge"), F.lit(0).alias("side"), F.col("head.frow").alias("first_row"), F.col("head.fstart").alias("first_edge"))
    right = runs.select("row", F.col("end").alias("edge"), F.lit(1).alias("side"), F.col("tail.frow").alias("first_row"), (F.col("tail.fstart") + F.col("tail.size")).alias("first_edge"))
    more = extensions(numbered, left.unionByName(right))
    a, b = (more.where(F.col("side") == k).select("row", F.col("edge").alias(c), F.col("more").alias(f"more_{c}")) for k, c in ((0, "start"), (1, "end")))
    wide = runs.select("row", "start", "end").join(a, ["row", "start"]).join(b, ["row", "end"]).select("row", (F.col("start") - F.col("more_start")).alias("start"), (F.col("end") + F.col("more_end")).alias("end"))
    w = W.partitionBy("row").orderBy("start", "end")
    new = F.col("start") > F.coalesce(F.max("end").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(-1))
    wide = wide.withColumn("new", new.cast("int")).withColumn("nth", F.sum("new").over(w.rowsBetween(W.unboundedPreceding, 0))).groupBy("row", "nth").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return wide.where(F.col("end") - F.col("start") >= least).groupBy("row").agg(F.sum(F.col("end") - F.col("start")).alias("n_repeated"), F.array_sort(F.collect_list(F.struct("start", "end"))).alias("passages"))


def duplicate_runs(docs: DataFrame, run_bytes: int = RUN) -> DataFrame:
    """A row for each of docs: row, doc_id, n_bytes, n_chunks, n_duplicates, n_removed, spans (arrays of start, end in bytes), n_repeated,
    passages (the same over their edges)."""
    numbered = materialize(documents(docs).withColumn("row", F.monotonically_increasing_id()), "numbered")
    table = materialize(chunk_table(numbered), "chunks")
    full = table.where("size > 0")
    total = full.count()
    key = ["d1", "d2"]
    groups = full.groupBy(*key).agg(F.count("*").alias("copies"), F.min(F.struct("doc_id", "row", "start")).alias("first")).where("copies > 1")
    groups = materialize(groups, "chunks")
    place = full.select(*key, "doc_id", "row", "start", "size")
    again = attach(place, groups, key, "copies", total).where("copies > 1 and not (first.row = row and first.start = start)")
    w = W.partitionBy("row").orderBy("start")
    runs = again.select("row", "start", "size", F.col("first.row").alias("frow"), F.col("first.start").alias("fstart"), (F.col("start") != F.coalesce(F.lag(F.col("start") + F.col("size")).over(w), F.lit(-1))).cast("int").alias("new"))
    runs = runs.withColumn("nth", F.sum("new").over(w)).groupBy("row", "nth").agg(F.min("start").alias("start"), F.max(F.col("start") + F.col("size")).alias("end"), F.count("*").alias("n"), F.min(F.struct("start", "size", "frow", "fstart")).alias("head"), F.max(F.struct("start", "size", "frow", "fstart")).alias("tail"))
    runs = materialize(runs, "runs")
    wide = passages(numbered, runs, run_bytes)
    size = F.col("end") - F.col("start")
    long = size >= run_bytes
    runs = runs.groupBy("row").agg(F.sum("n").alias("dups"), F.sum(F.when(long, size)).alias("removed"), F.array_sort(F.collect_list(F.when(long, F.struct("start", "end")))).alias("spans"))
    each = table.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("n_bytes").alias("n_bytes"), F.sum((F.col("size") > 0).cast("long")).alias("n_chunks"))
    zero = F.lit(0).cast("long")
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    out = each.join(runs, "row", "left").join(wide, "row", "left")
    return out.select("row", "doc_id", "n_bytes", "n_chunks", F.coalesce("dups", zero).alias("n_duplicates"), F.coalesce("removed", zero).alias("n_removed"), F.coalesce("spans", none).alias("spans"), F.coalesce("n_repeated", zero).alias("n_repeated"), F.coalesce("passages", none).alias("passages"))


def digest(runs: DataFrame) -> DataFrame:
    listed = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return runs.select("doc_id", "n_bytes", "n_chunks", "n_duplicates", "n_removed", F.size("spans").cast("long").alias("n_spans"), listed("spans").alias("spans"), "n_repeated", listed("passages").alias("passages"))
