"""Assigning messages to themes: best cosine, fused score, gap, status, rescue."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chatloom.functions.vectors import sigmoid

#: Phrases that each task holds at once (8 MB of vectors for 64 numbers each) and that pass the driver at most; more are met block by block.
PHRASES = 16_384
#: Scores that a task holds at once (8 MB): as many messages as that allows meet a block of phrases together.
CELLS = 1 << 20
#: Messages of a share, which meets every block of phrases in a task; its messages pass through in Arrow batches.
MESSAGES = 65_536


@dataclass(frozen=True)
class Thresholds:
    """Fixed values of the assignment."""

    primary: float = 0.5
    gap: float = 0.04
    borderline: float = 0.45
    weights: tuple[float, float, float] = (0.55, 0.30, 0.15)
    boost: float = 0.25
    reassign: float = 0.60
    rescue: float = 0.75
    rescue_norm: float = 0.95
    rescue_fusion: float = 0.65

    def __post_init__(self):
        if abs(sum(self.weights) - 1) > 0.01:
            raise ValueError("the weights must sum to 1")


def phrase_blocks(phrases: DataFrame) -> Iterator[list]:
    """Rows of phrases, ordered by theme and phrase, at most PHRASES at a time."""
    block: list = []
    for row in phrases.orderBy("theme", "phrase").toLocalIterator():
        block.append(row)
        if len(block) == PHRASES:
            yield block
            block = []
    if block:
        yield block


def theme_scores(messages: DataFrame, phrases: DataFrame) -> DataFrame:
    """message, theme, score, phrase: the best cosine over a theme's phrases (ties to nine digits: the first phrase). Each task multiplies
    slices of messages with a block of phrases at a time, CELLS scores at once. Up to PHRASES phrases are broadcast; more are cut into blocks that
    meet shares of the messages by shuffle, and a theme's best of several blocks is an aggregate."""
    rows = phrases.orderBy("theme", "phrase").limit(PHRASES + 1).collect()
    if len(rows) <= PHRASES:
        return _block_scores(messages, rows)
    best = F.max(F.struct(F.round("score", 9).alias("s"), (-F.col("phrase")).alias("p"), "score"))
    return _dealt_scores(messages, phrases).groupBy("message", "theme").agg(best.alias("b")).select("message", "theme", "b.score", (-F.col("b.p")).alias("phrase"))


def _block(rows: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors, ids and themes of (theme, phrase, v), ordered by theme and phrase, and where a theme starts."""
    themes = np.array([r[0] for r in rows], np.int64)
    ids = np.array([r[1] for r in rows], np.int64)
    m = np.array([r[2] for r in rows], np.float64).reshape(len(rows), -1) if rows else np.zeros((0, 0))
    length = np.sqrt((m * m).sum(1, keepdims=True))
    m = np.divide(m, length, out=np.zeros_like(m), where=length > 0)
    return m, ids, themes, np.flatnonzero(np.r_[True, themes[1:] != themes[:-1]]) if len(rows) else np.zeros(0, int)


def _best_of_block(whole: pa.RecordBatch, block: tuple) -> Iterator[pa.RecordBatch]:
    """The best phrase of each theme in the block, for messages (message, v)."""
    m, ids, themes, starts = block
    step = max(1, CELLS // len(m))
    for low in range(0, len(whole), step):
        b = whole.slice(low, step)
        x = np.array(b.column(1).to_pylist(), np.float64).reshape(len(b), -1)
        size = np.sqrt((x * x).sum(1, keepdims=True))
        s = np.divide(x, size, out=np.zeros_like(x), where=size > 0) @ m.T
        rounded = np.round(s, 9)
        ends = np.r_[starts[1:], len(m)]
        at = np.stack([a + rounded[:, a:e].argmax(1) for a, e in zip(starts.tolist(), ends.tolist(), strict=True)], 1)
        found = [np.tile(themes[starts], len(b)), np.take_along_axis(s, at, 1).ravel(), ids[at].ravel()]
        messages = b.column(0).take(pa.array(np.repeat(np.arange(len(b)), len(starts))))
        yield pa.RecordBatch.from_arrays([messages, *map(pa.array, found)], ["message", "theme", "score", "phrase"])


def _block_scores(messages: DataFrame, rows: list) -> DataFrame:
    shared = messages.sparkSession.sparkContext.broadcast(_block([(r["theme"], r["phrase"], r["v"]) for r in rows]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if len(shared.value[0]):
            for b in batches:
                yield from _best_of_block(b, shared.value)

    return messages.select("message", "v").mapInArrow(run, "message long, theme long, score double, phrase long")


def _dealt_scores(messages: DataFrame, phrases: DataFrame) -> DataFrame:
    """The best of each block of phrases for each message. Ranges of about PHRASES phrases go to every share of about MESSAGES messages, and each share
    to every range; a task holds one range and an Arrow batch of messages."""
    blocks, shares = (max(1, -(-df.count() // most)) for df, most in ((phrases, PHRASES), (messages, MESSAGES)))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    a = phrases.select(F.col("theme").cast("long").alias("theme"), F.col("phrase").cast("long").alias("id"), "v").repartitionByRange(blocks, "theme", "id")
    a = a.withColumn("block", F.spark_partition_id()).select(every(shares).alias("share"), "block", "theme", "id", "v", F.lit(0).alias("side"))
    b = messages.select(F.pmod(F.xxhash64("message", "v"), F.lit(shares)).cast("int").alias("share"), every(blocks).alias("block"), F.lit(None).cast("long").alias("theme"), F.col("message").cast("long").alias("id"), "v", F.lit(1).alias("side"))
    rows = a.unionByName(b).repartition("share", "block").sortWithinPartitions("share", "block", "side", "theme", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, phrases, block = None, [], None
        for whole in batches:
            keys = np.stack([whole.column(i).to_numpy() for i in range(3)])
            edges = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1).tolist(), len(whole)]
            for low, high in pairwise(edges):
                b = whole.slice(low, high - low)
                if not len(b):
                    continue
                share, number, side = keys[:, low].tolist()
                if key != (share, number):
                    key, phrases, block = (share, number), [], None
                if not side:
                    phrases += zip(*(b.column(i).to_pylist() for i in (3, 4, 5)), strict=True)
                    continue
                if block is None:
                    block, phrases = _block(phrases), []
                if len(block[0]):
                    yield from _best_of_block(b.select([4, 5]), block)

    return rows.select("share", "block", "side", "theme", "id", "v").mapInArrow(run, "message long, theme long, score double, phrase long")


def decide(scores: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """message, theme, score, gap, status of each message; columns message, theme, score. With one theme the gap is 1."""
    w = W.partitionBy("message").orderBy(F.desc("s"), "theme")
    ranked = scores.withColumn("s", F.round("score", 9)).withColumn("nth", F.row_number().over(w)).withColumn("second", F.lead("s").over(w)).where("nth = 1")
    gap = F.coalesce(F.col("s") - F.col("second"), F.lit(1.0))
    status = F.when((F.col("s") >= t.primary) & (F.round("gap", 9) >= t.gap), "confident").when(F.col("s") >= t.borderline, "borderline").otherwise("miscellaneous")
    out = ranked.withColumn("gap", gap).withColumn("status", status)
    return out.select("message", F.when(F.col("status") == "miscellaneous", -1).otherwise(F.col("theme")).cast("long").alias("theme"), F.col("s").alias("score"), "gap", "status")


def fused(scores: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Adds norm and fusion to columns cosine, raw (BM25Plus) and fuzzy."""
    a, b, c = t.weights
    out = scores.withColumn("norm", sigmoid(F.col("raw")))
    return out.withColumn("fusion", a * F.col("cosine") + b * F.col("norm") + c * F.col("fuzzy"))


def boosted(scores: DataFrame, intents: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Adds the boost to the score of the themes that a message's intent belongs to, up to 1; columns message, theme."""
    hit = intents.select("message", "theme").distinct().withColumn("hit", F.lit(True))
    return scores.join(hit, ["message", "theme"], "left").withColumn("score", F.when(F.col("hit"), F.least(F.col("score") + t.boost, F.lit(1.0))).otherwise(F.col("score"))).drop("hit")


def winners(scores: DataFrame) -> DataFrame:
    """message, theme: the best theme of each message (ties: the smallest)."""
    best = F.max(F.struct(F.round("score", 9).alias("s"), (-F.col("theme")).alias("t")))
    return scores.groupBy("message").agg(best.alias("b")).select("message", (-F.col("b.t")).alias("theme"))


def intent_boost(scores: DataFrame, intents: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """message, theme, before: the best theme with the boost and the one that was best without it."""
    return winners(boosted(scores, intents, t)).join(winners(scores).withColumnRenamed("theme", "before"), "message")


def intent_rescue(decided: DataFrame, scores: DataFrame, intents: DataFrame, factor: float = 1.2, least: float = 0.5) -> DataFrame:
    """message, theme of miscellaneous messages of which a theme of their intent scores `least` or more when multiplied by factor (no cap)."""
    miscellaneous = decided.where("status = 'miscellaneous'").select("message")
    tried = scores.join(intents.select("message", "theme").distinct(), ["message", "theme"]).withColumn("score", F.col("score") * factor)
    return winners(tried.where(F.round("score", 9) >= least).join(miscellaneous, "message", "left_semi"))


def reassigned(decided: DataFrame, scores: DataFrame, valid: DataFrame, above: float) -> DataFrame:
    """Borderline messages with a best score over `above` go to the best theme that is still valid."""
    best = scores.join(valid.select("theme"), "theme", "left_semi").groupBy("message").agg(F.max(F.struct(F.round("score", 9).alias("s"), (-F.col("theme")).alias("t"))).alias("b")).select("message", (-F.col("b.t")).alias("better"))
    out = decided.join(best, "message", "left")
    move = (F.col("status") == "borderline") & (F.col("score") > above) & F.col("better").isNotNull()
    out = out.withColumn("moved", F.coalesce(move, F.lit(False)).cast("int"))
    moved = F.col("moved") == 1
    return out.withColumn("theme", F.when(moved, F.col("better")).otherwise(F.col("theme"))).withColumn("status", F.when(moved, "confident").otherwise(F.col("status"))).drop("better")


def rescued(scores: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """message, theme: messages that share words with phrases and score high enough in fusion."""
    ok = (F.col("raw") != 0) & ((F.col("fusion") > t.rescue) | ((F.col("norm") > t.rescue_norm) & (F.col("fusion") > t.rescue_fusion)))
    return scores.where(ok).groupBy("message").agg(F.max(F.struct(F.round("fusion", 9).alias("f"), (-F.col("theme")).alias("t"))).alias("b")).select("message", (-F.col("b.t")).alias("theme"))


def dissolve_small(decided: DataFrame, least: int = 5) -> DataFrame:
    """Messages of themes with fewer than `least` messages become borderline without a theme."""
    small = decided.where("theme >= 0").groupBy("theme").agg(F.count("*").alias("n")).where(F.col("n") < least).select("theme", F.lit(True).alias("small"))
    out = decided.join(small, "theme", "left")
    return out.select("message", F.when(F.col("small"), -1).otherwise(F.col("theme")).cast("long").alias("theme"), "score", F.when(F.col("small"), "borderline").otherwise(F.col("status")).alias("status"))
