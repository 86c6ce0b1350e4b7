"""Vectors in fewer dimensions by their neighbour graph.

Each row's weights to its nearest others (cosine distance) fall off from the nearest one, at a rate solved so that they add up to log2 of the neighbours; the
two directions of an edge are joined as a fuzzy union. The layout begins with principal components and goes on in rounds: rows are dealt to blocks of near rows,
and each block moves its own rows for STEPS steps, drawn by sampled edges and pushed by a sample of all rows; rows of other blocks stand still until the next
round. A block holds BLOCK_ROWS rows with their own edges, so memory is bounded, and the driver sees SAMPLE positions a round. Blocks are packed once for all rounds, with edges between numbered
seats; the position of a row goes once a round to a party of neighbouring blocks (about PARTY_ROWS rows), however many of its edges lead there, and each party is a task of its own."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chatloom.operators.density import density_clusters, sizes_for
from chatloom.operators.graph import checkpointed
from chatloom.operators.neighbours import Space, keyed, listed, numbers
from chatloom.operators.sampling import density_sample, fewer_dimensions
from chatloom.operators.vector_quality import local_outliers, unit

#: Neighbours of a row (itself counts), the curve 1 / (1 + A d^2B) of a layout without a least distance, the largest step of one force.
NEIGHBOURS, A, B, CLIP = 25, 1.93, 0.79, 4.0
#: Rounds, steps of a block in each, positions that push, pushes for each pull.
ROUNDS, STEPS, SAMPLE, PUSHES = 24, 10, 512, 5
#: Rows of a party at most (but for one block), and parties of a table that isn't too large for them.
PARTY_ROWS, MOVERS = 8192, 24


def _weights(d: np.ndarray, target: float) -> np.ndarray:
    """Weights of rows of distances (inf: none), by bisection for each row."""
    there = np.isfinite(d)
    low = np.where(there & (d > 0), d, np.inf).min(1)
    rest = np.where(there, np.maximum(d - np.where(np.isfinite(low), low, 0)[:, None], 0), np.inf)
    lo, hi = np.zeros(len(d)), np.full(len(d), np.inf)
    rate = np.ones(len(d))
    for _ in range(64):
        total = np.exp(-rest / rate[:, None]).sum(1)
        over = total > target
        hi, lo = np.where(over, rate, hi), np.where(over, lo, rate)
        rate = np.where(np.isfinite(hi), (lo + hi) / 2, rate * 2)
    mean = np.where(there, d, 0).sum(1) / np.maximum(there.sum(1), 1)
    return np.exp(-rest / np.maximum(rate, 1e-3 * np.maximum(mean, 1e-12))[:, None])


def neighbour_graph(df: DataFrame, neighbours: int = NEIGHBOURS) -> DataFrame:
    """a, b, w: each row's own edges of id, v with the weight of both directions."""
    near = listed(unit(df).select("id", F.col("u").alias("v")), neighbours - 1)
    lists = near.select("a", F.transform("near", lambda x: F.struct((x["d"] * x["d"] / 2).alias("d"), x["b"].alias("b"))).alias("l"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            sizes = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
            flat = batch.column(1).flatten()
            d = np.full((len(sizes), neighbours - 1), np.inf)
            place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            row = np.repeat(np.arange(len(sizes)), sizes)
            d[row, place] = flat.field(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(numbers(batch.column(0))[row]), flat.field(1), pa.array(_weights(d, np.log2(neighbours))[row, place])], ["a", "b", "w"])

    one = checkpointed(lists.mapInArrow(run, "a long, b long, w double"))
    both = one.join(one.select(F.col("a").alias("b"), F.col("b").alias("a"), F.col("w").alias("back")), ["a", "b"], "left")
    back = F.coalesce("back", F.lit(0.0))
    return both.select("a", "b", (F.col("w") + back - F.col("w") * back).alias("w"))


def _packed(seats: pa.Table, edges: pa.Table) -> pa.Table:
    """The blocks of a party, ready for all rounds. seats: party, block, id, home, seat of its own rows and, with block -1, of the others that its edges lead to; edges: party, block, a, b, w (lists).
    Positions come as the party's own rows by seat, then the others by home and seat; `still` are the places there that a block's edges lead to, and `other` of an edge is one of the block's own rows or, after those, of `still`."""
    block, ids = numbers(seats.column("block")), numbers(seats.column("id"))
    order = np.lexsort((numbers(seats.column("seat")), np.where(block < 0, numbers(seats.column("home")), -1)))
    block, ids = block[order], ids[order]
    by_id = np.argsort(ids, kind="stable")
    many = numbers(pc.list_value_length(edges.column("b")))
    a, home = (np.repeat(numbers(edges.column(c)), many) for c in ("a", "block"))
    b, w = (numbers(pc.list_flatten(edges.column(c))) for c in ("b", "w"))
    order = np.lexsort((b, a, home))
    a, b, w, home = (by_id[np.searchsorted(ids, a[order], sorter=by_id)], by_id[np.searchsorted(ids, b[order], sorter=by_id)], w[order], home[order])
    out: dict[str, list] = {"block": [], "ids": [], "mine": [], "other": [], "w": [], "still": []}
    for k in np.unique(block[block >= 0]).tolist():
        begin, end = np.searchsorted(block[: np.count_nonzero(block >= 0)], [k, k + 1]).tolist()
        part = slice(*np.searchsorted(home, [k, k + 1]).tolist())
        inside = (b[part] >= begin) & (b[part] < end)
        still, place = np.unique(b[part][~inside], return_inverse=True)
        other = b[part] - begin
        other[~inside] = end - begin + place
        for name, x in zip(out, (k, ids[begin:end], (a[part] - begin).astype(np.int32), other.astype(np.int32), w[part], still.astype(np.int32)), strict=True):
            out[name].append(x)
    return pa.table({"party": pa.array(np.full(len(out["block"]), seats.column("party")[0].as_py(), np.int64)), **{name: pa.array(x) for name, x in out.items()}})


def _moved(posts: pa.Table, blocks: pa.Table, names: np.ndarray, others: np.ndarray, seed: int, rates: np.ndarray) -> pa.Table:
    """The positions of a party's rows after their steps. posts: positions from each party (home -1: its own); blocks: as packed; names, others: ids and positions of the rows that push."""
    posts = posts.sort_by("home")
    size = len(others[0])
    every = numbers(pc.list_flatten(posts.column("y"))).reshape(-1, size)
    blocks, begin, moved = blocks.sort_by("block"), 0, []
    for k in range(len(blocks)):
        ids, mine, other, w, still = (numbers(blocks.column(c)[k].values) for c in ("ids", "mine", "other", "w", "still"))
        moved.append(_steps(ids, every[begin : begin + len(ids)], mine, other, w, every[still], names, others, seed, rates))
        begin += len(ids)
    return pa.table({"party": pa.array([posts.column("party")[0].as_py()], pa.int64()), "y": pa.array([np.concatenate(moved).ravel()])})


def _squared(delta: np.ndarray) -> np.ndarray:
    """Sums of squares over the first axis, added in pairs."""
    s = delta * delta
    while len(s) > 1:
        even = len(s) // 2 * 2
        s = np.concatenate([s[0:even:2] + s[1:even:2], s[even:]])
    return s[0]


def _steps(ids: np.ndarray, y: np.ndarray, mine: np.ndarray, other: np.ndarray, w: np.ndarray, still: np.ndarray, names: np.ndarray, others: np.ndarray, seed: int, rates: np.ndarray) -> np.ndarray:
    """Positions y of a block's rows (ids) after its steps along edges from rows `mine` to rows `other` (from len(ids) on: of still, which don't move)."""
    rng = np.random.default_rng([seed, int(ids[0]) & 0xFFFFFFFF])
    n = len(ids)
    every = np.ascontiguousarray(np.concatenate([y, still, others]).T)  # one dimension after the other
    if len(mine):
        inner = np.minimum(np.searchsorted(ids, names), n - 1)
        pushing = np.where(ids[inner] == names, inner, n + len(still) + np.arange(len(names)))  # own rows push from where they are by now
        for rate in rates:
            drawn = np.flatnonzero(rng.random(len(w)) < w)
            i = mine[drawn]
            near = np.take(every, i, axis=1) - np.take(every, other[drawn], axis=1)
            d2 = _squared(near)
            near *= np.where(d2 > 0, -2 * A * B * np.maximum(d2, 1e-12) ** (B - 1) / (1 + A * d2**B), 0)
            i5 = np.repeat(i, PUSHES)
            far = np.take(every, i5, axis=1) - np.take(every, pushing[rng.integers(0, len(pushing), len(i5))], axis=1)
            d2 = _squared(far)
            far *= np.where(d2 > 0, 2 * B / ((0.001 + d2) * (1 + A * d2**B)), 0)
            at, force = np.concatenate([i, i5]), np.clip(np.concatenate([near, far], axis=1), -CLIP, CLIP)
            times = np.maximum(np.bincount(i, minlength=n), 1)
            for x, f in zip(every, force, strict=True):
                x[:n] += rate * np.bincount(at, f, n) / times
    return every[:, :n].T


def _mover(names: np.ndarray, others: np.ndarray, seed: int, rates: np.ndarray) -> Callable[[pa.Table, pa.Table], pa.Table]:
    return lambda posts, blocks: _moved(posts, blocks, names, others, seed, rates)


def _posted(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """party, home, y: what each party gets of positions with `size` dimensions, out of party, y, and to, seats (the parties that want some of its rows, and which)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                home, flat = batch.column(0)[k].as_py(), batch.column(1)[k].values
                y = numbers(flat).reshape(-1, size)
                to, seats = (batch.column(c)[k].values for c in (2, 3))
                parts = [flat, *(pa.array(y[numbers(seats[j].values)].ravel()) for j in range(len(to or [])))]
                ends = np.cumsum([0, *(len(x) for x in parts)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([home, *(to.to_pylist() if to is not None else [])], pa.int64()),
                        pa.array([-1] + [home] * (len(parts) - 1), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.concat_arrays(parts)),
                    ],
                    ["party", "home", "y"],
                )

    return run


def seated(blocks: DataFrame, held: DataFrame) -> DataFrame:
    """party, block, id: whose places a party of blocks needs in a round, each once: its own rows (of blocks: id, block, party), and with block -1 rows of other parties that its edges (b of held) lead to."""
    met = held.select("party", F.explode("b").alias("id")).distinct().join(blocks.select("id", F.col("party").alias("home")), "id")
    return blocks.select("party", "block", "id").union(met.where("home <> party").select("party", F.lit(-1).cast("long"), "id"))


def projected(df: DataFrame, dimensions: int, neighbours: int = NEIGHBOURS, rounds: int = ROUNDS, seed: int = 42) -> DataFrame:
    """id, v with so many dimensions; the same for the same rows."""
    rows = checkpointed(df.select("id", F.col("v").cast("array<double>").alias("v")))
    n = rows.count()
    if n < 3:
        return rows.select("id", F.array_repeat(F.lit(0.0), dimensions).alias("v"))
    first = checkpointed(fewer_dimensions(rows, dimensions))
    largest = first.agg(F.max(F.array_max(F.transform("v", F.abs))).alias("m")).first()["m"] or 1.0  # sums of floats differ in their last digits by how rows are dealt, so places are rounded
    space = Space(unit(rows).select("id", F.col("u").alias("v")))
    dealt = checkpointed(space.dealt(space.rows.select("id", "cell", "block"), PARTY_ROWS, MOVERS, "number").select("id", "block", "number"))
    keys, parties = keyed(dealt, "number", "party", n)
    order = F.row_number().over(W.partitionBy("party").orderBy("block", "id")) - 1
    blocks = checkpointed(dealt.join(keys, "number").select("id", "block", "party").withColumn("seat", order))
    held = neighbour_graph(rows, min(neighbours, n)).join(blocks.select(F.col("id").alias("a"), "block", "party"), "a").groupBy("party", "block", "a").agg(F.array_sort(F.collect_list(F.struct("b", "w"))).alias("to"))  # neighbours - 1 at most
    held = checkpointed(held.select("party", "block", "a", "to.b", "to.w"))
    seats = checkpointed(seated(blocks, held).join(blocks.select("id", F.col("party").alias("home"), "seat"), "id"))
    schema = "party long, block long, ids array<long>, mine array<int>, other array<int>, w array<double>, still array<int>"
    packed = checkpointed(seats.groupBy("party").cogroup(held.groupBy("party")).applyInArrow(_packed, schema))
    wanted = seats.where("block = -1").groupBy("home", "party").agg(F.array_sort(F.collect_list("seat")).alias("seats"))  # a party's rows at most
    wanted = wanted.groupBy(F.col("home").alias("party")).agg(F.array_sort(F.collect_list(F.struct("party", "seats"))).alias("w")).select("party", F.col("w.party").alias("to"), "w.seats")
    wanted = checkpointed(blocks.select("party").distinct().join(wanted, "party", "left"))
    start = F.transform("v", lambda x: F.round(x * (10 / largest), 6))
    listed = F.array_sort(F.collect_list(F.struct("seat", "id", start.alias("y"))))  # a party's rows
    place = checkpointed(blocks.join(first, "id").groupBy("party").agg(listed.alias("l")).select("party", F.flatten("l.y").alias("y")))
    at = lambda seat: F.transform(F.sequence(F.lit(0), F.lit(dimensions - 1)), lambda i: F.get("y", seat * dimensions + i))
    total = rounds * STEPS
    for r in range(rounds):
        order = F.md5(F.concat(F.lit(f"{seed}:{r}:"), F.col("id").cast("string")))
        sample = blocks.select("party", F.struct(order.alias("o"), "id", "seat").alias("s")).orderBy("s").limit(SAMPLE).groupBy("party").agg(F.collect_list("s").alias("s"))  # SAMPLE rows
        sample = place.join(F.broadcast(sample), "party").select(F.explode(F.transform("s", lambda x: F.struct(x["o"].alias("o"), x["id"].alias("id"), at(x["seat"]).alias("y")))).alias("s"))
        sample = sorted(sample.select("s.o", "s.id", "s.y").collect())
        names, others = np.array([x["id"] for x in sample], np.int64), np.array([x["y"] for x in sample], np.float64)
        rates = 1 - np.arange(r * STEPS, (r + 1) * STEPS) / total
        posts = place.join(wanted, "party").select("party", "y", "to", "seats").mapInArrow(_posted(dimensions), "party long, home long, y array<double>")
        both = (x.repartition(parties, "party").groupBy("party") for x in (posts, packed))
        place = checkpointed(next(both).cogroup(next(both)).applyInArrow(_mover(names, others, seed + r, rates), "party long, y array<double>"))
    ids = blocks.groupBy("party").agg(F.array_sort(F.collect_list(F.struct("seat", "id"))).alias("l"))  # a party's rows
    return place.join(ids, "party").select(F.explode(F.transform("l", lambda x: F.struct(x["id"].alias("id"), at(x["seat"]).alias("v")))).alias("x")).select("x.id", "x.v")


def density_chain(df: DataFrame, size: int, dimensions: int = 50, neighbours: int = NEIGHBOURS) -> DataFrame:
    """id, label of a sample of `size` rows of id, v (all, with label null, if there are no more): rows in fewer dimensions, a tenth of them set apart as outliers (-2), density clusters of
    the rest (-1: noise), and of each its share, with three of a cluster and two of the others at least."""
    n = df.count()
    if size >= n:
        return df.select("id", F.lit(None).cast("long").alias("label"))
    return density_sample(labelled(checkpointed(projected(df, dimensions, neighbours))), size)


def labelled(reduced: DataFrame, near: int = 20, share: float = 0.1) -> DataFrame:
    """id, label: -2 outliers, -1 noise, clusters from 0."""
    marks = checkpointed(local_outliers(reduced, near, share).select("id", "outlier"))
    inner = checkpointed(reduced.join(marks.where("outlier = 0"), "id").select("id", "v"))
    found = density_clusters(inner, *sizes_for(inner.count()))
    return checkpointed(found.union(marks.where("outlier = 1").select("id", F.lit(-2).cast("long"))))
