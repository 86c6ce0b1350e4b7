"""Benchmark decontamination by SimHash windows (operator 5); DataFrame functions only.

Words are lower-cased runs of letters and digits, shingles are five words, and a shingle weighs its count times an inverse
item frequency in [1, 2]. A window of a document is as long as an item and lies where a shingle stands that the item has at
that place; every window of similarity over 0 with an item shares a shingle with it, so leaving out the other places loses
nothing. Windows with the same shingles, such as those of a passage that many documents share, are one from here on. Each window and item
has a 64-bit SimHash of its weighted shingles. The fingerprints are cut into BLOCKS blocks, and
items are indexed under their length and all block values with up to FLIPS bits changed: of two fingerprints within RADIUS bits, at least one
block differs in RADIUS // BLOCKS = FLIPS bits or fewer, so all of them are found. A window meets items of its own length only. Candidates are
verified by the exact weighted Jaccard similarity of window and item, which must be THRESHOLD or more.

The index is joined by shuffle. The benchmark's shingles, the places of windows and the windows that match are broadcast while they have at most BROADCAST_ROWS rows,
else joined by shuffle too; then windows that many documents have (common.attach) are broadcast alone, so no passage gathers in one task.

Defined results: one row for each (doc_id, item_id) that matches, with its best window (most similar, then first); rows with the
same doc_id count as one document, also null ids; an item with fewer than five words matches where its words stand in a row;
null and empty texts match nothing; items that repeat an item_id count as one row each; empty tables give an empty result; other
columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import attach, materialize, without_ids

SHINGLE, THRESHOLD = 5, 0.8
BLOCKS, RADIUS = 7, 20
FLIPS = RADIUS // BLOCKS
BROADCAST_ROWS = 500_000
_EDGES = [64 * k // BLOCKS for k in range(BLOCKS + 1)]
#: Weights are whole numbers, so sums don't depend on their order.
SCALE = 1000


def words(text: str) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(F.col(text).cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(column: str, n: int) -> Column:
    """Hashes of all runs of n words."""
    w = F.col(column)
    made = F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(n))))
    return F.when(F.size(w) >= n, made).otherwise(F.array().cast("array<bigint>"))


def simhash(table: DataFrame, keys: list[str]) -> DataFrame:
    """keys, sim (64 bits) and total weight from rows of keys, h, weight: a bit is set if its rows weigh more than half of the total."""
    ones = [F.expr(f"sum((shiftright(h, {b}) & 1) * weight) AS b{b}") for b in range(64)]
    summed = table.groupBy(*keys).agg(F.sum("weight").alias("total"), *ones)
    sim = F.expr(" | ".join(f"shiftleft(CAST(2 * b{b} > total AS bigint), {b})" for b in range(64)))
    return summed.select(*keys, "total", sim.alias("sim"))


def block_values(sim: Column) -> Column:
    """Array of (block, value)."""
    return F.array(*(F.struct(F.lit(k).alias("block"), F.shiftrightunsigned(sim, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("value")) for k, (a, b) in enumerate(itertools.pairwise(_EDGES))))


def near_block_values(sim: Column) -> Column:
    """Array of (block, value) with up to FLIPS bits changed. The masks are one constant a block: hundreds of structs in the plan, and its many copies, took the driver's memory."""
    out = []
    for k, (a, b) in enumerate(itertools.pairwise(_EDGES)):
        value = F.shiftrightunsigned(sim, a).bitwiseAND(F.lit((1 << (b - a)) - 1))
        masks = [sum(1 << x for x in c) for n in range(FLIPS + 1) for c in itertools.combinations(range(b - a), n)]
        masks = F.split(F.lit(",".join(map(str, masks))), ",").cast("array<bigint>")
        out.append(F.transform(masks, _masked(k, value)))
    return F.flatten(F.array(*out))


def _masked(block: int, value: Column) -> Callable[[Column], Column]:
    return lambda mask: F.struct(F.lit(block).alias("block"), value.bitwiseXOR(mask).alias("value"))


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, item_id, start, n_words, hamming, similarity. See the module's text."""
    items = benchmark.select(F.col("item_id"), words("text").alias("w")).where(F.size("w") > 0).withColumn("item", F.monotonically_increasing_id())
    items = materialize(items.select("item", "item_id", "w", F.size("w").alias("n_words")), "items")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tag"), "text")
    found = _long_items(texts, items.where(F.col("n_words") >= SHINGLE), threshold)
    for (n,) in items.where(F.col("n_words") < SHINGLE).select("n_words").distinct().collect():  # at most four lengths
        found = found.unionByName(_short_items(texts, items.where(F.col("n_words") == n), n))
    best = F.min(F.struct((-F.col("similarity")).alias("s"), "start", "n_words", "hamming")).alias("b")
    found = found.groupBy("doc_id", "item_id").agg(best)
    return found.select("doc_id", "item_id", "b.start", "b.n_words", "b.hamming", (-F.col("b.s")).alias("similarity"))


def _small(df: DataFrame) -> DataFrame:
    """A hint to broadcast df if it is within the bound."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _hits(texts: DataFrame, places: DataFrame, n: int) -> DataFrame:
    """doc_id, tag, at, h where a document has a shingle of places (h)."""
    # explode_outer: for explode, Catalyst filters on the array's size below the projections, which makes the words again for each shingle
    hashed = texts.select("doc_id", "tag", words("text").alias("w")).select("doc_id", "tag", shingles("w", n).alias("hs"))
    return hashed.select("doc_id", "tag", F.posexplode_outer("hs").alias("at", "h")).join(_small(places.select("h").distinct()), "h", "left_semi")


def _short_items(texts: DataFrame, items: DataFrame, n: int) -> DataFrame:
    places = items.select("item_id", shingles("w", n).getItem(0).alias("h"))
    hits = _hits(texts, places, n).join(_small(places), "h")
    return hits.select("doc_id", "item_id", F.col("at").cast("long").alias("start"), F.lit(n).cast("long").alias("n_words"), F.lit(0).alias("hamming"), F.lit(1.0).alias("similarity"))


def _long_items(texts: DataFrame, items: DataFrame, threshold: float) -> DataFrame:
    places = materialize(items.select("item", "n_words", F.posexplode_outer(shingles("w", SHINGLE)).alias("place", "h")), "items")
    total = items.count()
    frequency = places.groupBy("h").agg(F.countDistinct("item").alias("df"))
    most = SCALE * 2
    weight = frequency.select("h", F.round(SCALE * (1 + F.log((total + 1) / (F.col("df") + 1)) / F.log(F.lit(total + 2.0)))).cast("long").alias("idf"))
    weight = materialize(weight, "items")
    counts = materialize(places.groupBy("item", "h").agg(F.count("*").alias("n")).join(weight, "h").select("item", "h", (F.col("n") * F.col("idf")).alias("weight")), "items")
    prints = materialize(simhash(counts, ["item"]), "items")

    hits = materialize(_hits(texts, places, SHINGLE), "hits")
    at = places.select("h", "place", F.col("n_words").alias("long")).distinct()  # what items have in common counts once
    starts = hits.join(_small(at), "h").select("doc_id", "tag", (F.col("at") - F.col("place")).alias("start"), "long").distinct()
    spots = starts.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("start", "long")).alias("spots"))  # up to a text's words times the item lengths
    contents, spots = _windows(texts, materialize(spots, "spots"))

    inside = contents.select("content", "long", F.explode_outer("hs").alias("h")).where("h is not null").groupBy("content", "long", "h").agg(F.count("*").alias("n"))
    inside = inside.join(_small(weight), "h", "left").select("content", "long", "h", (F.col("n") * F.coalesce("idf", F.lit(most))).alias("weight"))
    inside = materialize(inside, "windows")
    seen = simhash(inside, ["content", "long"])

    size = items.select("item", F.col("n_words").alias("long"))
    index = prints.join(_small(size), "item").select("item", "long", F.col("sim").alias("item_sim"), F.col("total").alias("item_total"), F.explode(near_block_values(F.col("sim"))).alias("b")).select("item", "long", "item_sim", "item_total", "b.block", "b.value")
    probe = seen.select("content", "long", "total", "sim", F.explode(block_values(F.col("sim"))).alias("b")).select("content", "long", "total", "sim", "b.block", "b.value")
    probe, index = probe.hint("merge").alias("p"), index.alias("i")  # hundreds of rows an item: as a broadcast they would all pass the driver
    hamming = F.bit_count(F.col("p.sim").bitwiseXOR(F.col("i.item_sim")))
    same = [F.col(f"p.{c}") == F.col(f"i.{c}") for c in ("long", "block", "value")]
    near = probe.join(index, [*same, hamming <= RADIUS])
    near = materialize(near.select("content", "total", "item", "item_total", hamming.alias("hamming")).distinct(), "near")

    common = near.select("content", "item").join(inside, "content").join(_small(counts.withColumnRenamed("weight", "other")), ["item", "h"])
    common = common.groupBy("content", "item").agg(F.sum(F.least("weight", "other")).alias("common"))
    similarity = F.col("common") / (F.col("total") + F.col("item_total") - F.col("common"))
    good = near.join(common, ["content", "item"]).withColumn("similarity", similarity).where(F.col("similarity") >= threshold)
    good = good.join(_small(items.select("item", "item_id")), "item").select("content", F.struct("item_id", "hamming", "similarity").alias("match"))
    good = materialize(good.groupBy("content").agg(F.collect_list("match").alias("matches")), "good")  # up to the items of a length
    if good.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        out = spots.join(F.broadcast(good), "content")
    else:
        copies = spots.groupBy("content").agg(F.count("*").alias("copies"))
        out = attach(spots, materialize(copies.join(good, "content"), "good"), ["content"], "copies", spots.count()).where("matches is not null")
    out = out.select("doc_id", "start", "stop", F.explode("matches").alias("m"))
    return out.select("doc_id", "m.item_id", F.col("start").cast("long").alias("start"), (F.col("stop") - F.col("start")).cast("long").alias("n_words"), "m.hamming", "m.similarity")


def _windows(texts: DataFrame, spots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (content, long, hs), and where they are (doc_id, start, stop, content); spots: doc_id, tag and arrays of start, long."""
    named = texts.select(F.col("doc_id").alias("id"), F.col("tag").alias("own"), "text")
    mine = named.join(_small(spots), F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("own") == F.col("tag"))).select("doc_id", "spots", words("text").alias("w"))
    mine = mine.select("doc_id", "spots", F.size("w").alias("size"), shingles("w", SHINGLE).alias("hs"))
    low, high = (lambda s: F.greatest(s["start"], F.lit(0))), (lambda s: F.least(s["start"] + s["long"], F.col("size")))
    cut = F.transform("spots", lambda s: F.struct(low(s).alias("start"), high(s).alias("stop"), s["long"].alias("long"), F.slice(F.col("hs"), low(s) + 1, high(s) - low(s) - (SHINGLE - 1)).alias("hs")))
    spot = mine.select("doc_id", F.explode_outer(cut).alias("s")).select("doc_id", "s.start", "s.stop", "s.long", F.array_sort("s.hs").alias("hs"))
    content = F.struct("long", F.xxhash64("hs").alias("h1"), F.xxhash64(F.lit(1), "hs").alias("h2"))  # 128 bits for each length
    spot = materialize(spot.where(F.size("hs") > 0).withColumn("content", content), "windows")
    return spot.groupBy("content").agg(F.first("long").alias("long"), F.first("hs").alias("hs")), spot.select("doc_id", "start", "stop", "content")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that match no item, with all their columns."""
    return without_ids(docs, materialize(contaminated(docs, benchmark).select(F.col("doc_id").alias("gone")).distinct(), "leaks"))
