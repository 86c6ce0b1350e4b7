"""Near-duplicates by improved consistent weighted sampling over TF-IDF shingles (operator 9).

Shingles are five words (lower-cased runs of letters and digits). A shingle weighs its count in the text times an inverse
document frequency, damped to [1, 2]: 1 + ln((N + 1) / (df + 1)) / ln(N + 2), where df is the larger of the documents with it and a
RAREST-th of all, which is below one document up to RAREST of them: one rule for tables of any size, in which a weight has no jump. So only frequencies of common
shingles, in at least a COMMON-th of all documents and in two, are needed, and weights are exact. There are at most COMMON times as many common ones as
a document has shingles on average. They are found in two passes: counts in DF_BUCKETS hash buckets, which are no less than the
frequencies of the shingles in them, and then a count by shingle of what full buckets hold, partial before the shuffle.
BANDS x ROWS samples a text give bands; texts that share a band are candidates. With weighted Jaccard similarity 0.8 a pair shares one with probability 0.9998.

Texts with the same shingle multiset are one node from the start. In a band's bucket, dealt in blocks, each member is first
paired with the one before it that shares the most samples: pairs grow in proportion to members. Candidate pairs are
verified on the exact vectors, and components of verified links of THRESHOLD or more are made. Then all pairs that share a
bucket, may be similar and lie in different components are verified too: of each, one is not in the bucket's commonest component,
so those few are compared with all members. That is done block by block on the exact vectors, so these pairs are never listed. A bucket with
more than SPLIT * BLOCK such members, as that of a template with many fillings, is first split by prefixes: texts of similarity THRESHOLD have in common one of the
features that make up the first 1 - THRESHOLD of their weight, so only members that share such a feature are compared. Features go by how many members of
those buckets have them, rarest first, counted by DF_BUCKETS hash buckets: a table of fixed size, whatever the corpus holds. Rows grow in proportion to members where the
fillings are over 1 - THRESHOLD of a text's weight; where they are less, the template itself is in the prefixes and its texts are compared block by block of both sides. Of links of similarity 0.8 the bands and the first look at samples leave out about 2 in 10,000 each, of closer ones fewer. Classes are the components of all verified links.

Defined results: null counts as empty text; a text with fewer than five words has one shingle of all its words; a text without
words is a class of its own; class_id is the smallest doc_id of the class; rows that repeat are returned as often; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm import cells
from chatloom.llm.common import BROADCAST_IDS, attach, documents, dropped_ids, materialize, mix, slices, small_batches, trim, without_ids, words
from chatloom.llm.graph import components

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 16, 4
DF_BUCKETS, DF_PARTS = 1 << 22, 64
COMMON = 4096
#: The share of documents below which shingles weigh alike is one in RAREST; at most COMMON, so that weights don't depend on what is counted.
RAREST = 4096
#: Shares of equal samples from which a pair is a candidate (0.8 is 3.5 standard deviations above).
MAYBE = 0.625
BLOCK = 512
#: Rows of groups that are Python objects at a time.
GROUP_ROWS = 1024
#: Blocks of texts outside a bucket's commonest class from which on prefixes make fewer rows than blocks do: SPLIT blocks make 2 SPLIT rows a text, a prefix
#: has about a fifth of a text's shingles.
SPLIT = 32
_STEP = np.cumprod(np.full(SHINGLE, 0xD6E8FEB86659FD93, np.uint64))
_K = BANDS * ROWS
_rng = np.random.default_rng(9)
_SEEDS = _rng.integers(1, 2**63, _K, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_UNIT = (np.arange(1 << 14) + 0.5) / (1 << 14)
_GAMMA = np.sort(_rng.gamma(2.0, 1.0, 1 << 20)).reshape(1 << 14, -1).mean(1)
_LOG_GAMMA = np.log(_GAMMA)


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of all texts in a row, sorted within each text; the count of each in its text; how many each text has."""
    w, n = words(texts)
    owner = np.repeat(np.arange(len(n)), n)
    total = np.zeros(len(w), np.uint64)
    for k in range(SHINGLE):
        if len(w) > k:
            total[: len(w) - k] += w[k:] * _STEP[k]
    left = np.repeat(np.cumsum(n), n) - np.arange(len(w))
    keep = left >= SHINGLE
    for i in np.flatnonzero((n > 0) & (n < SHINGLE)).tolist():  # a short text's words make one shingle
        a = int(n[:i].sum()) if i else 0
        total[a] = (w[a : a + n[i]] * _STEP[: n[i]]).sum(dtype=np.uint64)
        keep[a] = True
    s, owner = mix(total[keep]), owner[keep]
    order = np.lexsort((s, owner))
    s, owner = s[order], owner[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return s[at], np.diff(np.r_[at, len(s)]), np.bincount(owner[at], minlength=len(n))


class Weights:
    """Numbers of shingles: those of sorted keys, and one for all others."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, other: float):
        self.keys, self.values, self.other = keys, values, other

    def __getitem__(self, s: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(s), self.other)
        at = np.minimum(np.searchsorted(self.keys, s), len(self.keys) - 1)
        return np.where(self.keys[at] == s, self.values[at], self.other)


def buckets(s: np.ndarray) -> np.ndarray:
    """What a shingle's weight is kept under: the shingle, so that none shares another's."""
    return s


def _places(s: np.ndarray, n: int) -> np.ndarray:
    return (s >> np.uint64(20)).astype(np.int64) & (n - 1)


def full_buckets(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Documents in each hash bucket of shingles, and all documents. A task's counts are DF_PARTS rows of at most a fixed size."""
    size = DF_BUCKETS // DF_PARTS

    def packed(x: np.ndarray) -> bytes:
        return x.astype(np.min_scalar_type(x.max())).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, n = np.zeros(DF_BUCKETS, np.uint32), 0
        for _, texts in slices(batches):
            s, _, _ = shingles(texts)
            at, more = np.unique(_places(s, DF_BUCKETS), return_counts=True)
            count[at] += more.astype(np.uint32)
            n += len(texts)
        if n:
            rows = [*(packed(count[k * size : (k + 1) * size]) for k in range(DF_PARTS)), np.array([n]).tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array(range(DF_PARTS + 1), pa.int32()), pa.array(rows, pa.binary())], ["part", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for part, counts in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                x = np.frombuffer(counts.as_buffer(), f"u{counts.as_buffer().size // size}" if part < DF_PARTS else np.int64).astype(np.int64)
                sums[part] = sums[part] + x if part in sums else x
        for part, x in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([x.tobytes()], pa.binary())], ["part", "counts"])

    schema = "part int, counts binary"
    out, total = np.zeros(DF_BUCKETS, np.int64), 0
    with small_batches(docs.sparkSession):
        for part, counts in documents(docs).mapInArrow(run, schema).repartition(DF_PARTS, "part").mapInArrow(add, schema).toLocalIterator():
            x = np.frombuffer(counts, np.int64)
            if part < DF_PARTS:
                out[part * size : (part + 1) * size] = x
            else:
                total = int(x[0])
    return out, total


def document_frequencies(docs: DataFrame) -> tuple[Weights, int]:
    """Documents of each common shingle, 1 for all others; and all documents. See the module's text."""
    counts, total = full_buckets(docs)
    least = max(2, -(-total // COMMON))
    full = docs.sparkSession.sparkContext.broadcast(np.packbits(counts >= least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(full.value).astype(bool)
        for _, texts in slices(batches):
            s, _, _ = shingles(texts)
            keys, n = np.unique(s[wanted[_places(s, len(wanted))]], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], ["shingle", "n"])

    counted = documents(docs).mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    with small_batches(docs.sparkSession):
        found = counted.toPandas()
    keys = found["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return Weights(keys[order], found["n"].to_numpy(np.int64)[order], 1), total


def idf(frequencies: Weights, total: int) -> Weights:
    """See the module's text."""
    weight = lambda df: 1 + np.log((total + 1) / (np.minimum(np.maximum(df, total / RAREST), total) + 1)) / np.log(total + 2)
    return Weights(frequencies.keys, weight(frequencies.values), float(weight(frequencies.other)))


def samples(s: np.ndarray, weight: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """texts x (BANDS * ROWS) consistent weighted samples as 64-bit values; 0 for a text without shingles."""
    out = np.zeros((len(sizes), _K), np.uint64)
    full = np.flatnonzero(sizes > 0)
    if not len(full):
        return out
    starts = (np.cumsum(sizes) - sizes)[full]
    owner = np.repeat(np.arange(len(full)), sizes[full])
    log_w = np.log(weight)
    for k in range(_K):
        h = (s ^ (s >> np.uint64(29))) * _SEEDS[k]
        h ^= h >> np.uint64(32)
        r = _GAMMA[(h & np.uint64(0x3FFF)).astype(np.int64)]
        beta = _UNIT[((h >> np.uint64(14)) & np.uint64(0x3FFF)).astype(np.int64)]
        t = np.floor(log_w / r + beta)
        value = _LOG_GAMMA[((h >> np.uint64(28)) & np.uint64(0x3FFF)).astype(np.int64)] - r * (t - beta + 1)
        low = np.minimum.reduceat(value, starts)
        hit = np.flatnonzero(value == low[owner])
        first = hit[np.searchsorted(owner[hit], np.arange(len(full)))]
        out[full, k] = mix(s[first] + mix(t[first].astype(np.int64).astype(np.uint64)))
    return out


def node_keys(s: np.ndarray, tf: np.ndarray, sizes: np.ndarray) -> list[bytes | None]:
    """16 bytes for each text that are equal for equal shingle multisets; None for a text without shingles."""
    full = np.flatnonzero(sizes > 0)
    out: list[bytes | None] = [None] * len(sizes)
    if len(full):
        starts = (np.cumsum(sizes) - sizes)[full]
        a = np.add.reduceat(mix(s + mix(tf.astype(np.uint64))), starts)
        b = np.add.reduceat(mix(mix(s ^ np.uint64(0x5851F42D4C957F2D)) + tf.astype(np.uint64)), starts)
        blob = np.stack([mix(a), mix(b)], 1).astype(">u8").tobytes()
        for n, i in enumerate(full.tolist()):
            out[i] = blob[16 * n : 16 * n + 16]
    return out


def signatures(docs: DataFrame, weights) -> DataFrame:
    """doc_id, node, bands, samples (16 bits of each) for each of docs; weights: broadcast inverse document frequencies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in slices(batches):
            s, tf, sizes = shingles(texts)
            x = samples(s, tf * weights.value[buckets(s)], sizes)
            bands = np.zeros((len(texts), BANDS), np.uint64)
            for r in range(ROWS):
                bands = mix(bands * np.uint64(31) + x[:, r::ROWS])
            low = (x & np.uint64(0xFFFF)).astype(np.uint16)
            keys = node_keys(s, tf, sizes)
            yield pa.RecordBatch.from_arrays([ids, pa.array(keys, pa.binary()), pa.array(list(bands.view(np.int64)), pa.list_(pa.int64())), pa.array([v.tobytes() for v in low], pa.binary())], ["doc_id", "node", "bands", "samples"])

    return documents(docs).mapInArrow(run, "doc_id long, node binary, bands array<long>, samples binary")


def _partners(keys: list, x: np.ndarray) -> list[tuple]:
    """For each member of a group but the first, the most similar one before it, if it may be similar."""
    pairs = []
    for i in range(1, len(keys)):
        share = (x[:i] == x[i]).mean(1)
        j = int(share.argmax())
        if share[j] >= MAYBE:
            pairs.append((keys[i], keys[j]))
    return pairs


def _grouped(table: DataFrame, by: list[str], kernel, schema: str) -> DataFrame:
    """kernel(table of one group) -> list of rows, over groups sorted within partitions; groups are bounded by BLOCK rows a block."""
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def groups(t: pa.Table, last: bool):
            n = len(t)
            keys = np.stack([t.column(c).to_numpy() for c in by], 1)
            edge = np.r_[0, np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1, n]
            stop = len(edge) - 1 if last else len(edge) - 2
            out, first = [], 0
            while first < stop:  # whole groups, some GROUP_ROWS rows at a time
                end = min(stop, max(first + 1, int(np.searchsorted(edge, edge[first] + GROUP_ROWS, "right")) - 1))
                low = int(edge[first])
                data = {c: t.column(c).slice(low, int(edge[end]) - low).to_pylist() for c in t.column_names}
                for a, b in zip((edge[first:end] - low).tolist(), (edge[first + 1 : end + 1] - low).tolist(), strict=True):
                    out += kernel({c: v[a:b] for c, v in data.items()})
                first = end
            left = t.slice(int(edge[stop])) if not last else None
            return out, left

        def packed(rows):
            return pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=arrow)

        kinds = {"binary": pa.binary(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "double": pa.float64()}
        arrow = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in schema.split(", ")])
        for b in batches:
            t = pa.Table.from_batches([b]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([b])])
            if len(t):
                rows, rest = groups(t, False)
                if rows:
                    yield packed(rows)
        if rest is not None and len(rest):
            rows, _ = groups(rest, True)
            if rows:
                yield packed(rows)
        trim()

    return table.repartition(*by).sortWithinPartitions(*by, "node").mapInArrow(run, schema)


def shared_bands(nodes: DataFrame) -> DataFrame:
    """band, key, n, node, samples of the nodes that share a band with another; nodes: node, bands, samples."""
    rows = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    shared = rows.groupBy("band", "key").agg(F.count("*").alias("n"), F.min("node").alias("centre")).where("n > 1")
    rows = attach(rows, materialize(shared, "buckets"), ["band", "key"], "n", BANDS * nodes.count()).where("n is not null")
    return rows.join(nodes.select("node", "samples"), "node").select("band", "key", "n", "centre", "node", "samples")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def first_pairs(shared: DataFrame) -> DataFrame:
    """Each member with its most similar one before it in its block of each bucket; the bucket's smallest node is in every block."""
    blocks = F.ceil(F.col("n") / BLOCK).cast("long")
    dealt = shared.withColumn("blocks", F.when(F.col("node") == F.col("centre"), F.sequence(F.lit(0).cast("long"), blocks - 1)).otherwise(F.array(F.pmod(F.xxhash64("node", "band"), blocks))))
    dealt = dealt.select("band", "key", F.explode("blocks").alias("block"), "node", "samples")

    def kernel(g: dict) -> list[tuple]:
        return _partners(g["node"], np.frombuffer(b"".join(g["samples"]), np.uint16).reshape(len(g["node"]), -1))

    return _ordered(_grouped(dealt, ["band", "key", "block"], kernel, "a binary, b binary"))


def with_commonest(named: DataFrame) -> DataFrame:
    """The rows of buckets with more than one label, with the commonest label (most) and its rows (c)."""
    counts = named.groupBy("band", "key", "label").agg(F.count("*").alias("c"), F.first("n").alias("n"))
    top = counts.groupBy("band", "key").agg(F.max(F.struct("c", "label")).alias("top"), F.count("*").alias("kinds"), F.first("n").alias("n")).where("kinds > 1")
    top = materialize(top.select("band", "key", "n", F.col("top.label").alias("most"), F.col("top.c").alias("c")), "top")
    return attach(named.drop("n"), top, ["band", "key"], "n", named.count()).where("most is not null")


def ranks(members: DataFrame) -> np.ndarray:
    """For each hash bucket of shingles 1,024 times the logarithm of how many of the members have one of it, at least."""
    counts, _ = full_buckets(members)
    return np.rint(1024 * np.log2(counts + 1)).astype(np.uint16)


def prefixes(members: DataFrame, order, weights, threshold: float = THRESHOLD) -> DataFrame:
    """band (-1), key, node: of each member (doc_id, text) the features (shingle and its number in the text) that make up the first 1 - threshold
    of its weight, in one order for all texts: by the broadcast ranks() in order, ties by hash. Two texts of similarity threshold share one of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in slices(batches):
            s, tf, sizes = shingles(texts)
            edge = np.r_[0, np.cumsum(sizes)].tolist()
            keys, features = [], []
            for i, node in enumerate(node_keys(s, tf, sizes)):
                if node is None:
                    continue
                mine, n = s[edge[i] : edge[i + 1]], tf[edge[i] : edge[i + 1]]
                weight = np.repeat(weights.value[buckets(mine)], n)
                nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                feature = mix(np.repeat(mine, n) + mix(nth.astype(np.uint64)))
                rarest = np.lexsort((feature, np.repeat(order.value[_places(mine, len(order.value))], n)))
                before = np.cumsum(weight[rarest]) - weight[rarest]
                taken = feature[rarest][before <= (1 - threshold + 1e-9) * weight.sum()]
                features.append(taken)
                keys += [node] * len(taken)
            key = np.concatenate([np.zeros(0, np.uint64), *features]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), -1), pa.int32()), pa.array(key), pa.array(keys, pa.binary())], ["band", "key", "node"])

    return members.mapInArrow(run, "band int, key long, node binary").distinct()


def chosen(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc_id and text of the documents with an id in column wanted."""
    if wanted.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    return (d := documents(docs)).join(wanted, d["doc_id"].eqNullSafe(wanted["wanted"]), "left_semi")


def other_links(docs: DataFrame, nodes: DataFrame, shared: DataFrame, labels: DataFrame, weights, threshold: float = THRESHOLD) -> DataFrame:
    """a, b, similarity: verified links between components, enough to join all components that pairs of a bucket link. Of such
    a pair at least one is not in the bucket's commonest component, so those few are compared with all members, cell by cell: first by
    samples, then those that may be similar by their exact vectors. Pairs aren't listed, so a bucket of n texts makes n rows a cell. Buckets with
    over SPLIT * BLOCK of the few are split by prefixes() first; a feature that over BLOCK of their texts begin with is compared block by block of both sides."""
    named = materialize(shared.drop("centre").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "named")
    named = materialize(with_commonest(named), "named")
    split = F.col("n") - F.col("c") > SPLIT * BLOCK  # many that aren't in the commonest component: in blocks, rows would grow with their square
    large = named.where(split).groupBy("node").agg(F.first("samples").alias("samples"), F.first("label").alias("label"), F.max(F.col("label") != F.col("most")).alias("few"))
    small = named.where(~split)
    if not (large := materialize(large, "large")).isEmpty():
        asked = [nodes.join(large.where(who).select("node"), "node", "left_semi").select(F.col("rep").alias("wanted")) for who in ("few", "not few")]
        members = [chosen(docs, a) for a in asked]
        order = docs.sparkSession.sparkContext.broadcast(ranks(members[0].unionByName(members[1])))
        rows = materialize(prefixes(members[0], order, weights, threshold), "prefixes")
        rest = prefixes(members[1], order, weights, threshold).join(rows.select("key").distinct(), "key", "left_semi").select("band", "key", "node")
        rows = materialize(rows.unionByName(rest).join(large.drop("few"), "node"), "prefixes")
        order.destroy()
        sizes = rows.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1")
        rows = attach(rows, materialize(sizes, "sizes"), ["band", "key"], "n", rows.count()).where("n is not null")
        small = small.unionByName(with_commonest(rows).select(*named.columns))
    named = small
    few = F.col("label") != F.col("most")
    blocks, rare = F.ceil(F.col("n") / BLOCK).cast("long"), F.ceil((F.col("n") - F.col("c")) / BLOCK).cast("long")
    h = F.xxhash64("node", "band")
    all_of = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    named = named.withColumn("few", few).withColumn("own", F.pmod(h, rare)).withColumn("rare", rare).withColumn("blocks", blocks)
    columns = ["band", "key", "node", "samples", "label", "few"]
    # the rare against the common: a cell for each block of the common and each of the rare
    mixed = named.select(*columns, "own", "rare", F.explode(F.when(F.col("few"), all_of(F.col("blocks"))).otherwise(F.array(F.pmod(h, F.col("blocks"))))).alias("low"))
    mixed = mixed.select(*columns, "low", F.explode(F.when(F.col("few"), F.array("own")).otherwise(all_of(F.col("rare")))).alias("high"), F.lit(0).alias("kind"))
    # the rare among each other: a cell for each two blocks
    rares = named.where("few").select(*columns, "own", F.explode(all_of(F.col("rare"))).alias("other"))
    rares = rares.select(*columns, F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), F.lit(1).alias("kind"))
    cell = mixed.unionByName(rares)

    names = ["band", "key", "kind", "low", "high", "node", "label", "few"]

    def marked(g: dict) -> list[tuple]:
        x = np.frombuffer(b"".join(g["samples"]), np.uint16).reshape(len(g["node"]), -1)
        keep = cells.candidates(x, g["label"], g["few"], g["kind"][0] == 1, MAYBE)
        return [tuple(g[c][i] for c in names) for i in np.flatnonzero(keep).tolist()]

    by = names[:5]
    maybe = materialize(_grouped(cell, by, marked, "band int, key long, kind int, low long, high long, node binary, label binary, few boolean"), "cells")
    wanted = nodes.join(maybe.select("node").distinct(), "node", "left_semi").select(F.col("rep").alias("wanted"))

    def linked(g: dict) -> list[tuple]:
        pairs = [(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint32)) for x, y in zip(g["s"], g["tf"], strict=True)]
        return cells.links(g["node"], g["label"], g["few"], g["kind"][0] == 1, pairs, lambda x: weights.value[buckets(x)], similarity, threshold)

    return materialize(_grouped(maybe.join(vectors(docs, wanted), "node"), by, linked, "a binary, b binary, similarity double"), "links")


def vectors(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, shingles, counts of the documents with an id in column wanted; one row a node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in slices(batches):
            s, tf, sizes = shingles(texts)
            edge = np.r_[0, np.cumsum(sizes)].tolist()
            keys = node_keys(s, tf, sizes)
            at = [i for i, k in enumerate(keys) if k is not None]
            counts = tf.astype(np.uint32)
            yield pa.RecordBatch.from_arrays([pa.array([keys[i] for i in at], pa.binary()), pa.array([s[edge[i] : edge[i + 1]].tobytes() for i in at], pa.binary()), pa.array([counts[edge[i] : edge[i + 1]].tobytes() for i in at], pa.binary())], ["node", "s", "tf"])

    return chosen(docs, wanted).mapInArrow(run, "node binary, s binary, tf binary").dropDuplicates(["node"])


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of (sorted shingles, weights)."""
    at = np.minimum(np.searchsorted(a[0], b[0]), len(a[0]) - 1)
    hit = a[0][at] == b[0]
    common = np.minimum(a[1][at[hit]], b[1][hit]).sum()
    return float(common / (a[1].sum() + b[1].sum() - common))


def verified(pairs: DataFrame, vecs: DataFrame, weights, threshold: float = THRESHOLD) -> DataFrame:
    """The pairs with similarity of threshold or more."""
    left = vecs.select(F.col("node").alias("a"), F.col("s").alias("sa"), F.col("tf").alias("ta"))
    right = vecs.select(F.col("node").alias("b"), F.col("s").alias("sb"), F.col("tf").alias("tb"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "ta", "sb", "tb")

    def vector(s: bytes, tf: bytes) -> tuple[np.ndarray, np.ndarray]:
        x = np.frombuffer(s, np.uint64)
        return x, np.frombuffer(tf, np.uint32) * weights.value[buckets(x)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, sim = [], [], []
            for i in range(len(batch)):
                x, y, sa, ta, sb, tb = (batch.column(c)[i].as_py() for c in range(6))
                v = similarity(vector(sa, ta), vector(sb, tb))
                if v >= threshold:
                    a.append(x)
                    b.append(y)
                    sim.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(sim, pa.float64())], ["a", "b", "similarity"])

    return both.mapInArrow(run, "a binary, b binary, similarity double")


def near_duplicate_classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, class_size, kept for each of docs. See the module's text."""
    context = docs.sparkSession.sparkContext
    frequencies, total = document_frequencies(docs)
    weights = context.broadcast(idf(frequencies, total))
    signed = materialize(signatures(docs, weights), "signatures")
    some = signed.where("node is not null")
    groups = some.groupBy("node").agg(F.count("*").alias("copies"), F.min("doc_id").alias("rep"), F.first(F.struct("bands", "samples")).alias("s"))  # equal shingles, equal samples
    nodes = materialize(groups.select("node", "rep", "copies", "s.bands", "s.samples"), "nodes")
    shared = materialize(shared_bands(nodes), "shared")

    def linked(pairs: DataFrame) -> DataFrame:
        ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        wanted = nodes.join(ends, "node", "left_semi").select(F.col("rep").alias("wanted"))
        return materialize(verified(pairs, vectors(docs, wanted), weights), "links")

    links = linked(materialize(first_pairs(shared), "pairs"))
    labels = components(links)
    more = other_links(docs, nodes, shared, labels, weights)
    if not more.isEmpty():
        labels = components(links.unionByName(more))
    named = nodes.select("node", "rep", "copies").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    sizes = named.groupBy("label").agg(F.min("rep").alias("class_id"), F.sum("copies").alias("class_size"))
    named = materialize(named.join(sizes, "label").select("node", "copies", "class_id", "class_size"), "classes")
    weights.destroy()  # all that needs them is written; reused workers would keep them
    out = attach(some.select("doc_id", "node"), named, ["node"], "copies", total).select("doc_id", "class_id", "class_size")
    alone = signed.where("node is null").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"))
    return out.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The document of each class with the smallest id, with all columns; rows that share an id stay together."""
    return without_ids(docs, dropped_ids(near_duplicate_classes(docs), "near"))
