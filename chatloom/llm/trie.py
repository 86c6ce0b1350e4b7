"""A prefix trie over conversations (operator 11).

Turns are ordered by a range shuffle, and numpy scans number them and add up the polynomial t_1 B + t_2 B^2 + ... of their hashes modulo the prime 2^31-1, at two
bases; what a conversation holds in earlier partitions is added by one carry a partition. The fingerprint of any rebuilt prefix follows from two such sums. Prefixes
with one depth and fingerprint are a group; sorted by (depth, fingerprint, conversation), each member's last turn is compared with the turn of the group's
representative. Members of a group with equal last turns were in one group a turn before, so a group whose turns all agree, like all groups above it, is one node; groups that
don't agree are split by the turn, and all that follow carry that split in their key.

A node is named by its smallest conversation. That conversation's nodes are the end of its path (it is the smallest of every later prefix too), so a node's subtree is
what its smallest conversation has from there on and what the other members have on their own: sums over rows (conversation, depth), without rounds over
levels. Joins by conversation or node deal hot keys apart, and the ids that end in a node are joined to text in blocks before they meet.

Defined results: rows with a null conv_id belong to no conversation; a null turn comes first; equal turns go by role, then text; a null role or text is empty;
turns that repeat count as often; with negative ids conv_id % 5 has the sign of conv_id; an empty table gives an empty result; other columns are ignored. The digest of one node's ids is sequential by
definition: one task reads that node's blocks, a batch at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import attach, discard, last_table, materialize

P = (1 << 31) - 1
BASES = (1_103_515_245, 1_812_433_253)
#: Conversations that share a host's head, and one more than the turns a head can have.
HOSTED, HEADS = 5, 9
#: Characters of role and text that a range shuffle looks at; ids of one block of text.
SEEN_CHARS, BLOCK = 24, 1024
#: Groups with a collision that are broadcast at most (16 bytes each).
BROADCAST_GROUPS = 200_000
NODE = ["depth", "f", "tag"]


def power(base: int, exponent: np.ndarray, modulus: int = P) -> np.ndarray:
    """base^exponent modulo `modulus`, value by value."""
    out, factor, e = np.ones(len(exponent), np.uint64), base % modulus, exponent.astype(np.uint64)
    while e.any():
        out = np.where(e & np.uint64(1), out * np.uint64(factor) % np.uint64(modulus), out)
        factor, e = factor * factor % modulus, e >> np.uint64(1)
    return out


class Scan:
    """Running sums of value * base^place along runs of equal keys, over batches. Values below P; base 1: plain sums."""

    def __init__(self, bases: tuple[int, ...]):
        self.bases, self.key, self.place, self.sums, self.runs = bases, None, 0, [0] * len(bases), 0

    def __call__(self, keys: np.ndarray, values: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """Place in the run (from 1), sums, number of the run."""
        n = len(keys)
        fresh = np.r_[self.key is None or keys[0] != self.key, keys[1:] != keys[:-1]]
        at = np.arange(n)
        start = np.maximum.accumulate(np.where(fresh, at, -1))
        place = np.where(start < 0, at + 1 + self.place, at - start + 1)
        out = []
        for k, (base, v) in enumerate(zip(self.bases, values, strict=True)):
            v = v.astype(np.int64) if base == 1 else (v.astype(np.uint64) * power(base, place) % np.uint64(P)).astype(np.int64)
            total = np.cumsum(v)
            total = total - np.where(start > 0, total[np.maximum(start, 1) - 1], 0) + np.where(start < 0, self.sums[k], 0)
            out.append(total if base == 1 else total % P)
        run = self.runs + np.cumsum(fresh) - 1
        self.key, self.place, self.runs = keys[-1], int(place[-1]), int(run[-1]) + 1
        self.sums = [int(s[-1]) for s in out]
        return place, out, run


def carries(edges: list, bases: tuple[int, ...]) -> list[tuple]:
    """(part, n, sums..., factors...) that the first run of a part has before it; edges: for each part in order the end of its first and last run."""
    out, key, n, sums = [], None, 0, [0] * len(bases)
    for e in edges:
        goes_on = e["first"]["key"] == key
        before = (n, list(sums)) if goes_on else (0, [0] * len(bases))
        if goes_on:
            out.append((e["part"], before[0], *before[1], *(pow(b, before[0], P) for b in bases)))
        alone = e["first"]["run"] == e["last"]["run"]
        n0, s0 = before if alone else (0, [0] * len(bases))
        key, n = e["last"]["key"], n0 + e["last"]["place"]
        sums = [s + pow(b, n0, P) * e["last"][f"s{k}"] for k, (b, s) in enumerate(zip(bases, s0, strict=True))]
        sums = [s if b == 1 else s % P for s, b in zip(sums, bases, strict=True)]
    return out


def running(rows: DataFrame, key: str, ranged: list[Column], order: list[Column], values: list[Column], bases: tuple[int, ...]) -> tuple[DataFrame, int]:
    """rows with place and s0, s1, ... along each key, whatever a key's size, and how many rows there are. The result is written to the shared folder."""
    spark = rows.sparkSession
    kept = rows.columns
    dealt = rows.withColumns({f"v{k}": v for k, v in enumerate(values)}).repartitionByRange(*ranged).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan, seq, part = Scan(bases), 0, TaskContext.get().partitionId()
        for b in batches:
            if not len(b):
                continue
            place, sums, runs = scan(b.column(key).to_numpy(), [b.column(f"v{k}").to_numpy() for k in range(len(bases))])
            extra = [place, *sums, runs, np.arange(seq, seq + len(b)), np.full(len(b), part)]
            seq += len(b)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), *(pa.array(x.astype(np.int64)) for x in extra)], [*kept, "place", *(f"s{k}" for k in range(len(bases))), "run", "seq", "part"])

    kinds = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), "place long", *(f"s{k} long" for k in range(len(bases))), "run long, seq long, part long"])
    local = materialize(dealt.mapInArrow(run, kinds), "scan")
    end = F.struct(F.col(key).alias("key"), "place", "run", "seq", *(f"s{k}" for k in range(len(bases))))
    edges = local.groupBy("part").agg(F.max_by(end, "seq").alias("last"), F.max_by(end, F.when(F.col("run") == 0, F.col("seq"))).alias("first")).orderBy("part").collect()  # one row a partition
    names = [f"c{k}" for k in range(len(bases))] + [f"b{k}" for k in range(len(bases))]
    carry = spark.createDataFrame(carries(edges, bases), "part long, n long, " + ", ".join(f"{c} long" for c in names)).withColumn("run", F.lit(0).cast("long"))
    out = local.join(F.broadcast(carry), ["part", "run"], "left")  # no more rows than partitions
    sums = [F.when(F.col("n").isNull(), F.col(f"s{k}")).otherwise(F.col(f"c{k}") + F.col(f"b{k}") * F.col(f"s{k}") if b == 1 else (F.col(f"c{k}") + F.col(f"b{k}") * F.col(f"s{k}")) % P).alias(f"s{k}") for k, b in enumerate(bases)]
    return out.select(*kept, (F.col("place") + F.coalesce("n", F.lit(0))).alias("place"), *sums), sum(e["last"]["seq"] + 1 for e in edges)


def head_turns(conv: Column) -> Column:
    """Turns that a conversation takes from its host."""
    return F.crc32(conv.cast("string").cast("binary")) % HEADS


def rebuilt(conversations: DataFrame, spread: int = P) -> tuple[DataFrame, DataFrame, int]:
    """conv, depth, length, f, role, text: every prefix of every rebuilt conversation with its last turn and fingerprint (depth 0: no turn);
    conv, length of all conversations; the number of turns. A small spread of the turns' hashes makes collisions likely; tests use it."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text")).where("conv is not null")
    t, first = F.xxhash64("role", "text"), F.asc_nulls_first("turn")
    seen = [F.substring(c, 1, SEEN_CHARS) for c in ("role", "text")]
    numbered, total = running(turns, "conv", [F.col("conv"), first, *seen], [F.col("conv"), first, F.col("role"), F.col("text")], [F.pmod(x, F.lit(spread)) for x in (t, F.shiftrightunsigned(t, 31))], BASES)
    scan = last_table()
    h = head_turns(F.col("conv"))
    at_h = [F.coalesce(F.max(F.when(F.col("place") == h, F.col(f"s{k}"))), F.lit(0)).alias(f"g{k}") for k in (0, 1)]
    convs = numbered.groupBy("conv").agg(F.count("*").alias("n"), *at_h).withColumn("h", head_turns(F.col("conv"))).withColumn("host", F.col("conv") - F.col("conv") % HOSTED)
    heads = numbered.where((F.col("conv") % HOSTED == 0) & (F.col("place") < HEADS))
    sums = heads.groupBy(F.col("conv").alias("host")).agg(F.array_sort(F.collect_list(F.struct("place", "s0", "s1"))).alias("head"))  # HEADS - 1 at most
    m = F.when(F.col("head").isNull(), 0).otherwise(F.least(F.col("h"), F.size("head"))).cast("long")
    last = F.get("head", F.col("m").cast("int") - 1)
    info = convs.join(sums, "host", "left").withColumn("m", m)
    info = info.select("conv", "host", "n", "h", "m", "g0", "g1", *(F.coalesce(last[f"s{k}"], F.lit(0)).alias(f"q{k}") for k in (0, 1)), (F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    info = materialize(info, "convs")
    shift = lambda k: F.element_at(F.array(*(F.lit(pow(BASES[k], e, P)) for e in range(1 - HEADS, HEADS))), (F.col("m") - F.col("h")).cast("int") + HEADS)
    own = attach(numbered.where(F.col("place") > h), info, ["conv"], "n", total)
    f = [F.pmod(F.col(f"q{k}") + shift(k) * F.pmod(F.col(f"s{k}") - F.col(f"g{k}"), F.lit(P)), F.lit(P)) for k in (0, 1)]
    row = lambda depth, f: [depth.alias("depth"), "length", (f[0] * (P + 1) + f[1]).alias("f")]
    own = own.select("conv", *row(F.col("m") + F.col("place") - F.col("h"), f), "role", "text")
    taken = heads.withColumnRenamed("conv", "host").join(info.select("conv", "host", "m", "length"), "host").where("place <= m")  # HOSTED conversations a host
    taken = taken.select("conv", *row(F.col("place"), [F.col("s0"), F.col("s1")]), "role", "text")
    roots = info.select("conv", *row(F.lit(0).cast("long"), [F.lit(0).cast("long")] * 2), F.lit("").alias("role"), F.lit("").alias("text"))
    rows = materialize(own.unionByName(taken).unionByName(roots), "prefixes")
    discard(rows.sparkSession, [scan])
    return rows, info.select("conv", "length"), total


def disagreeing(rows: DataFrame) -> DataFrame:
    """depth, f of groups whose last turns differ. Each task compares a group's members with the first one; what it can't decide alone (groups at the ends of
    its range) meets by text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, found, out, first = None, {}, [], True

        def end(edge: bool) -> None:
            if group is not None and (edge or len(found) > 1):
                out.extend((*group, *turn) for turn in found)

        for b in batches:
            for depth, f, role, text in zip(*(b.column(c).to_pylist() for c in ("depth", "f", "role", "text")), strict=True):
                if group != (depth, f):
                    end(first)
                    first = first and group is None
                    group, role0, text0 = (depth, f), role, text
                    found = {(role, text): True}
                elif text != text0 or role != role0:
                    found[role, text] = True
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)], ["depth", "f", "role", "text"])
                out = []
        end(True)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)], ["depth", "f", "role", "text"])

    key = ["depth", "f", "conv"]
    dealt = rows.select("depth", "f", "conv", "role", "text").repartitionByRange(*key).sortWithinPartitions(*key)
    open_ = dealt.mapInArrow(run, "depth long, f long, role string, text string")
    return open_.distinct().groupBy("depth", "f").agg(F.count("*").alias("turns")).where("turns > 1").select("depth", "f")


def keyed(rows: DataFrame, total: int) -> DataFrame:
    """conv, depth, length, f, tag, bytes: (depth, f, tag) is one node."""
    slim = rows.select("conv", "depth", "length", "f", F.octet_length("text").cast("long").alias("bytes"))
    bad = materialize(disagreeing(rows), "collisions")
    n_bad = bad.limit(BROADCAST_GROUPS + 1).count()
    if not n_bad:
        return slim.withColumn("tag", F.lit(""))
    turn = ["depth", "f", "role", "text"]
    members = materialize(rows.select("conv", *turn).join(F.broadcast(bad) if n_bad <= BROADCAST_GROUPS else bad, ["depth", "f"]), "members")
    variants = members.groupBy(*turn).agg(F.min("conv").alias("v"), F.count("*").alias("size"))
    others = variants.join(variants.groupBy("depth", "f").agg(F.min("v").alias("least")), ["depth", "f"]).where("v <> least").drop("least")
    odd = attach(members, others, turn, "size", total).where("v is not null")
    tags = odd.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("depth", "v"))).alias("splits"), F.count("*").alias("size"))  # a conversation's collisions
    until = F.filter("splits", lambda x: x["depth"] <= F.col("depth"))
    tag = F.coalesce(F.array_join(F.transform(until, lambda x: F.concat_ws(":", x["depth"].cast("string"), x["v"].cast("string"))), ","), F.lit(""))
    return materialize(attach(slim, tags, ["conv"], "size", total).withColumn("tag", tag).drop("splits", "size"), "keyed")


def ends(rows: DataFrame) -> DataFrame:
    """NODE and ends_sha256: the digest of the ids of conversations that end in a node, in order. Ids are written out in blocks where a range shuffle put
    them, so a node with many is spread over tasks, and only blocks meet."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string())
        node, ids, out = None, [], []

        def end() -> None:
            if ids:
                out.append((*node, ids[0], ",".join(map(str, ids))))

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], [*NODE, "low", "ids"])

        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in [*NODE, "conv"]), strict=True):
                if row[:3] != node or len(ids) == BLOCK:
                    end()
                    node, ids = row[:3], []
                ids.append(row[3])
            if out:
                yield batch()
                out.clear()
        end()
        if out:
            yield batch()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, out = None, None, []
        for b in batches:
            for *key, ids in zip(*(b.column(c).to_pylist() for c in [*NODE, "ids"]), strict=True):
                if key != node:
                    if node:
                        out.append((*node, state.hexdigest()))
                    node, state = key, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], [*NODE, "ends_sha256"])
                out = []
        if node:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, state.hexdigest())], [*NODE, "ends_sha256"])

    last = rows.where("depth = length").select(*NODE, "conv").repartitionByRange(*NODE, "conv").sortWithinPartitions(*NODE, "conv")
    written = last.mapInArrow(blocks, "depth long, f long, tag string, low long, ids string")
    return written.repartition(*NODE).sortWithinPartitions(*NODE, "low").mapInArrow(digests, "depth long, f long, tag string, ends_sha256 string")


def prefix_trie(conversations: DataFrame, spread: int = P) -> DataFrame:
    """A row for each node; see the module's text and the columns at the end."""
    rows, convs, total = rebuilt(conversations, spread)
    keys = keyed(rows, total)
    nodes = materialize(keys.groupBy(*NODE).agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.max("bytes").alias("bytes")).withColumn("saved", (F.col("n_convs") - 1) * F.col("bytes")), "nodes")
    # where each conversation's own nodes begin, and what they save in all
    own = nodes.groupBy("conv").agg(F.count("*").alias("nodes"), F.sum("saved").alias("all_saved"))
    begin = convs.join(own, "conv", "left").select("conv", (F.col("length") + 1 - F.coalesce("nodes", F.lit(0))).alias("begin"), F.coalesce("all_saved", F.lit(0)).alias("all_saved"), (F.col("length") + 1).alias("size"))
    guests = materialize(attach(keys, materialize(begin, "begins"), ["conv"], "size", total).where("depth < begin").drop("size", "bytes"), "guests")
    arrive = guests.where("depth = begin - 1 and begin <= length")  # a conversation's last prefix that isn't its own
    arrivals = arrive.groupBy(*NODE).agg(F.count("*").alias("arrivals"))
    tree = materialize(nodes.join(arrivals, NODE, "left").join(convs, "conv").withColumn("n_children", F.coalesce("arrivals", F.lit(0)) + (F.col("length") > F.col("depth")).cast("long")).drop("arrivals"), "tree")
    leafy = tree.where("depth = length and n_children = 0").select("conv", F.lit(1).cast("long").alias("leaf"), F.lit(1).cast("long").alias("own"))
    leaves = convs.join(leafy, "conv", "left").select("conv", F.coalesce("leaf", F.lit(0)).alias("leaf"), (F.col("length") + 1).alias("size"))
    below = attach(guests, materialize(leaves, "leaves"), ["conv"], "size", total).groupBy(*NODE).agg(F.sum("leaf").alias("guest_leaves"), F.sum("all_saved").alias("guest_saved"))
    back = F.desc("depth")
    saved, _ = running(tree.where("n_convs > 1").select("conv", "depth", "saved"), "conv", [F.col("conv"), back], [F.col("conv"), back], [F.col("saved")], (1,))
    parents = attach(arrive.select(*NODE, F.col("conv").alias("heir")), nodes.select(*NODE, F.col("conv").alias("parent"), F.col("n_convs").alias("size")), NODE, "size", total)
    parents = parents.select(F.col("heir").alias("conv"), (F.col("depth") + 1).alias("depth"), "parent")
    out = tree.join(below, NODE, "left").join(ends(keys), NODE, "left").join(saved.select("conv", "depth", F.col("s0").alias("own_saved")), ["conv", "depth"], "left").join(parents, ["conv", "depth"], "left").join(leaves.select("conv", "leaf"), "conv")
    zero = F.lit(0)
    return out.select(
        F.col("conv").alias("conv_id"), "depth", F.when(F.col("depth") > 0, F.coalesce("parent", "conv")).alias("parent_conv_id"), "n_convs", "n_children", (F.col("leaf") + F.coalesce("guest_leaves", zero)).alias("n_leaves"),
        (F.coalesce("own_saved", zero) + F.coalesce("guest_saved", zero)).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


CRC = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, len(s) + 1), lambda i: CAST(ascii(s[i]) AS BIGINT))),
        lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)), lambda v, z: xor(v >> 1, (v & 1) * 3988292384))))"""
ORACLE = f"""WITH o AS (SELECT conv_id AS c, {{{{'r': coalesce(role, ''), 'x': coalesce(text, '')}}}} AS t, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos FROM conversations WHERE conv_id IS NOT NULL),
    k AS (SELECT c, count(*) AS n, CAST(c AS VARCHAR) AS s FROM o GROUP BY 1), q AS (SELECT c, n, CAST({CRC} % 9 AS BIGINT) AS h FROM k), i AS (SELECT q.c, q.h, least(q.h, coalesce(p.n, 0)) AS m FROM q LEFT JOIN q p ON p.c = q.c - q.c % 5),
    rb AS (SELECT i.c, o.pos AS d, t FROM i JOIN o ON o.c = i.c - i.c % 5 AND o.pos <= i.m UNION ALL SELECT i.c, i.m + o.pos - i.h, t FROM i JOIN o USING (c) WHERE o.pos > i.h),
    l AS (SELECT i.c, coalesce(list(t ORDER BY d) FILTER (d IS NOT NULL), []) AS ts FROM i LEFT JOIN rb USING (c) GROUP BY 1),
    e AS (SELECT c, CAST(len(ts) AS BIGINT) AS len, d, ts[1:d] AS key, strlen(coalesce(ts[d].x, '')) AS b FROM l, LATERAL (SELECT unnest(range(0, len(ts) + 1)) AS d)),
    mm AS (SELECT c, len, d, b, min(c) OVER (PARTITION BY d, key) AS rep FROM e),
    nd AS (SELECT rep, d, count(*) AS n_convs, max(b) AS b, sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (len = d), '')) AS ends FROM mm GROUP BY 1, 2),
    pa AS (SELECT nd.*, mm.rep AS parent FROM nd LEFT JOIN mm ON mm.c = nd.rep AND mm.d = nd.d - 1), ch AS (SELECT parent, d - 1 AS d, count(*) AS n FROM pa WHERE d > 0 GROUP BY 1, 2),
    sub AS (SELECT a.rep, a.d, count(*) FILTER (ch.n IS NULL) AS leaves, sum((y.n_convs - 1) * y.b) AS saved FROM nd y LEFT JOIN ch ON ch.parent = y.rep AND ch.d = y.d JOIN mm a ON a.c = y.rep AND a.d <= y.d GROUP BY 1, 2)
    SELECT pa.rep AS conv_id, pa.d AS depth, pa.parent AS parent_conv_id, n_convs, coalesce(ch.n, 0) AS n_children, leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, ends AS ends_sha256
    FROM pa JOIN sub ON sub.rep = pa.rep AND sub.d = pa.d LEFT JOIN ch ON ch.parent = pa.rep AND ch.d = pa.d""".replace("{{", "{").replace("}}", "}")
