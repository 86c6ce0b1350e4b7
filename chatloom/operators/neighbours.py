"""Exact nearest neighbours in a table of vectors, by cells around pivots.

Rows are dealt to the nearest of PIVOTS sampled pivots, and cells with more than BLOCK_ROWS rows are split into blocks. A row first meets its own block, which bounds how
far its neighbours can be; by the triangle inequality it then visits only blocks of cells that can hold something nearer. Rows travel in whole groups, not once for each
visit: about QUERY_ROWS visitors of neighbouring blocks (a party) meet about TARGET_ROWS rows of neighbouring blocks (a slab) in one task, which looks only at the blocks that
a row may need. Smaller tables have up to PARTIES and SLABS of them, so rows sent grow with the table until a party is full. Of equal vectors only k + 1 rows (the smallest ids) take part: the others' neighbours are those.
The driver holds the pivots and the least and largest distance of each cell, nothing that grows with the rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chatloom.operators.graph import checkpointed

#: Sampled pivots, and rows for each of them at least; rows of a block; rows that visit, and rows that are visited, in one task at most (but for one block).
PIVOTS, PIVOT_ROWS, BLOCK_ROWS, QUERY_ROWS, TARGET_ROWS = 256, 256, 2048, 32_768, 65_536
#: Parties and slabs of a table that isn't too large for them.
PARTIES, SLABS = 8, 8
#: Rows of a table for each task at least, but for PARTIES tasks.
TASK_ROWS = 2048
#: Rows that a step of a task compares with a block.
STEP = 512
#: Slack of a bound, for the rounding of distances to nine digits and of floats.
SLACK = 2e-9
_BLOCKS = 1 << 24


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of equally long lists of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def numbers(column) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else column.to_numpy()


def exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances of rows to rows, pair by pair, rounded to nine digits."""
    return np.round(np.sqrt(((x - y) ** 2).sum(1)), 9)


def about(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x to all of y, but for rounding."""
    return np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1) - 2 * (x @ y.T), 0)


def _places(hits: np.ndarray) -> np.ndarray:
    """Flat places of the true values, which are few mostly: eight at a time are looked at."""
    flat = hits.ravel()
    whole = len(flat) // 8 * 8
    words = np.flatnonzero(flat[:whole].view(np.uint64))
    if len(words) > whole // 64:
        return np.flatnonzero(flat)
    some = np.concatenate([(words[:, None] * 8 + np.arange(8)).ravel(), np.arange(whole, len(flat))])
    return some[flat[some]]


def within(x: np.ndarray, y: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of x, row of y, distance) of all pairs up to `most` apart, which has a value for each row of x. Products of short floats come first where their error is small against the distances;
    it is allowed for, so they leave out no pair."""
    sx, sy = (x * x).sum(1), (y * y).sum(1)
    top = sy.max(initial=0, where=np.isfinite(sy))
    room = (most + SLACK) ** 2 + 1e-12 * (sx + top)
    least = (sx - room) / 2
    error = (x.shape[1] + 9) * 2.0**-23 * (np.sqrt(sx * top) + top + sx)
    if np.isfinite(sy).all() and sx.max(initial=0) + top < 1e30 and (error <= room / 1024).all():
        short = np.empty((len(y), y.shape[1] + 1), np.float32)
        short[:, :-1], short[:, -1] = y, sy / -2
        near = np.concatenate([x.astype(np.float32), np.ones((len(x), 1), np.float32)], axis=1) @ short.T
        least = (least - error - 2.0**-23 * np.minimum(room, 1e30)).astype(np.float32)
    else:
        near = x @ y.T
        near -= sy / 2
    i, j = np.divmod(_places(near >= least[:, None]), max(1, len(y)))
    d = exact(x[i], y[j])
    keep = d <= most[i]
    return i[keep], j[keep], d[keep]


def keyed(rows: DataFrame, name: str, key: str, most: int) -> tuple[DataFrame, int]:
    """name, key of each of the groups that a column of rows names, and a number of tasks, `most` at most: a shuffle by the key to so many tasks deals the groups evenly, each to a task of its own if there are enough."""
    spark = rows.sparkSession
    groups = sorted(r[name] for r in rows.select(name).distinct().collect())  # one row a group
    n = max(1, min(len(groups), most))
    times = -(-len(groups) // n)
    tasks = spark.range(64 * (times + 1) * n).select("id", F.pmod(F.hash("id"), F.lit(n)).alias("task"))
    tasks = tasks.withColumn("nth", F.row_number().over(W.partitionBy("task").orderBy("id"))).where(F.col("nth") <= times)
    keys = [r["id"] for r in tasks.orderBy("nth", "task").limit(len(groups)).collect()] if groups else []
    keys += [-1 - i for i in range(len(groups) - len(keys))]  # too few numbers led to a task: unlikely
    return F.broadcast(spark.createDataFrame(list(zip(groups, keys, strict=True)), f"{name} long, {key} long")), n


class Space:
    """Vectors (id, v) in cells and blocks. rows: id, v, cell, block; edges of cells on the driver."""

    def __init__(self, df: DataFrame):
        pivots = min(PIVOTS, max(1, df.count() // PIVOT_ROWS))
        order = F.md5(F.concat(F.lit("pivot:"), F.col("id").cast("string")))
        sample = df.select("id", "v").orderBy(order, "id").limit(pivots).collect()  # PIVOTS rows
        self.pivots = p = np.array([r["v"] for r in sample], np.float64).reshape(len(sample), -1)

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if len(b):
                    x = matrix(b.column(1))
                    cell = np.concatenate([about(x[i : i + 1024], p).argmin(1) for i in range(0, len(x), 1024)])
                    yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(cell), pa.array(exact(x, p[cell]))], ["id", "v", "cell", "r"])

        dealt = checkpointed(df.select("id", F.col("v").cast("array<double>").alias("v")).mapInArrow(deal, "id long, v array<double>, cell long, r double"))
        cells = dealt.groupBy("cell").agg(F.min("r").alias("low"), F.max("r").alias("high"), F.count("*").alias("n"))
        cells = cells.select("*", F.ceil(F.col("n") / BLOCK_ROWS).cast("long").alias("blocks"))
        self.cells = cells.orderBy("cell").collect()  # one row a pivot
        self.count = sum(c["n"] for c in self.cells)
        nth = F.pmod(F.xxhash64("id"), F.col("blocks"))
        begins = np.cumsum([0, *(c["n"] for c in self.cells)]).tolist()
        shown = [(c["cell"], c["blocks"], begin, c["n"]) for c, begin in zip(self.cells, begins)]
        self.shown = F.broadcast(df.sparkSession.createDataFrame(shown, "cell long, blocks long, begin long, n long"))
        self.rows = dealt.join(self.shown, "cell").select("id", "v", "cell", (F.col("cell") * _BLOCKS + nth).alias("block"))

    def dealt(self, rows: DataFrame, most: int, parts: int, name: str) -> DataFrame:
        """rows (with cell and block) with the number of the group of blocks that theirs is in: about `most` rows each, or the table's `parts`-th part."""
        size = min(most, max(BLOCK_ROWS, -(-self.count // parts)))
        place = F.col("begin") + F.floor(F.col("block") % _BLOCKS * F.col("n") / F.col("blocks"))
        return rows.join(self.shown, "cell").withColumn(name, F.floor(place / size).cast("long")).drop("blocks", "begin", "n")

    def meet(self, queries: DataFrame, extra: list[str], targets: DataFrame, kernel: Callable, schema: str, own: bool, skips: dict[int, int] | None = None) -> DataFrame:
        """kernel(visitors, rows, tiles) for each party of queries (id, v, most, cell, block, and the extra columns) and slab of targets (id, v, cell, block and more) that has
        something for it; tiles are (places of visitors, slice of rows): all blocks that can hold a row up to a visitor's `most` away, but without `own` not its own one.
        skips: for a cell, the value of `extra[0]` whose rows needn't visit it."""
        p, cells = self.pivots, self.cells
        number = np.array([c["cell"] for c in cells], np.int64)
        low, high = (np.array([c[x] for c in cells]) for x in ("low", "high"))
        skip = np.array([(skips or {}).get(c["cell"], -(1 << 63)) for c in cells], np.int64)

        def reaches(x: np.ndarray, most: np.ndarray, kind: np.ndarray | None, which: np.ndarray) -> np.ndarray:
            d = np.sqrt(about(x, p[number[which]]))
            slack = SLACK + 1e-7 * (1 + d)  # `about` loses digits
            near = (d - high[which] - slack <= most[:, None]) & (low[which] - d - slack <= most[:, None])
            return near if kind is None else near & (skip[which] != kind[:, None])

        every = np.arange(len(cells))

        def asks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            asked: set[tuple[int, int]] = set()  # parties times pivots at most
            for whole in batches:
                for at in range(0, len(whole), STEP):
                    b = whole.slice(at, STEP)
                    row, cell = np.nonzero(reaches(matrix(b.column(1)), numbers(b.column(2)).astype(np.float64), numbers(b.column(3)) if skips else None, every))
                    asked |= set(np.unique(numbers(b.column(0))[row] * len(every) + cell).tolist())
            codes = np.array(sorted(asked), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(codes // len(every)), pa.array(number[codes % len(every)])], ["party", "cell"])

        def tiles(q: pa.Table, t: pa.Table) -> Iterator[tuple[np.ndarray, slice]]:
            x, most, blocks = matrix(q.column("v")), numbers(q.column("most")).astype(np.float64), numbers(t.column("block"))
            kind, mine = numbers(q.column(extra[0])) if skips else None, numbers(q.column("block"))
            edges = np.flatnonzero(np.diff(blocks, prepend=-1, append=-1))
            which = np.searchsorted(number, blocks[edges[:-1]] // _BLOCKS)
            for at in range(0, len(x), STEP):
                rows = np.arange(at, min(at + STEP, len(x)))
                near = reaches(x[rows], most[rows], kind[rows] if skips else None, which)
                if not own:
                    near &= mine[rows][:, None] != blocks[edges[:-1]]
                for k in np.flatnonzero(near.any(0)).tolist():
                    yield rows[near[:, k]], slice(int(edges[k]), int(edges[k + 1]))

        def run(q: pa.Table, t: pa.Table) -> pa.Table:
            q, t = q.sort_by("block"), t.sort_by("block")  # visitors that are near each other need the same blocks
            return kernel(q, t, tiles(q, t) if len(q) and len(t) else iter(()))

        queries = checkpointed(self.dealt(queries.select("id", "v", "most", "cell", "block", *extra), QUERY_ROWS, PARTIES, "party"))
        asked = queries.select("party", "v", "most", *extra[:1]).mapInArrow(asks, "party long, cell long").distinct()
        there = self.dealt(targets, TARGET_ROWS, SLABS, "slab")
        pairs = asked.join(F.broadcast(there.select("cell", "slab").distinct()), "cell")  # parties times pivots, and a few more, at most
        pairs = checkpointed(pairs.withColumn("pair", F.col("party") * _BLOCKS + F.col("slab")))
        keys, tasks = keyed(pairs, "pair", "key", max(PARTIES, self.count // TASK_ROWS))
        pairs = checkpointed(pairs.join(keys, "pair"))
        visits, slabs = pairs.select("party", "key").distinct(), pairs.select("cell", "slab", F.col("key").alias("to"))
        came = queries.join(F.broadcast(visits), "party").repartition(tasks, "key")
        there = there.join(F.broadcast(slabs), ["cell", "slab"]).drop("cell", "slab").repartition(tasks, "to")
        return came.groupBy("key").cogroup(there.groupBy("to")).applyInArrow(run, schema)


def _pairs(a: np.ndarray, b: np.ndarray, d: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each a the k nearest b (ties: the smaller id)."""
    order = np.lexsort((b, d, a))
    a, b, d = a[order], b[order], d[order]
    start = np.flatnonzero(np.diff(a, prepend=a[0] - 1)) if len(a) else np.zeros(0, int)
    keep = np.arange(len(a)) - np.repeat(start, np.diff(start, append=len(a))) < k
    return a[keep], b[keep], d[keep]


def _by_row(row: np.ndarray, d: np.ndarray) -> np.ndarray:
    """An order by row (of one step's) and distance, which has nine digits: by one whole number, if it has room for both."""
    row = row - row.min(initial=row[0] if len(row) else 0)
    if d.max(initial=0) >= 1 << 23:
        return np.lexsort((d, row))
    return np.argsort((row << 53) + np.rint(d * 1e9).astype(np.int64))


def _lists(row: np.ndarray, b: np.ndarray, d: np.ndarray, n: int) -> pa.ListArray:
    """d, b of each of n rows, out of pairs in the order of their rows."""
    ends = np.searchsorted(row, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(d, pa.float64()), pa.array(b, pa.int64())], ["d", "b"]))


def distinct_enough(df: DataFrame, k: int) -> DataFrame:
    """Of the rows with one vector, those with the k + 1 smallest ids."""
    nth = F.row_number().over(W.partitionBy("v").orderBy("id"))
    return df.select("id", F.col("v").cast("array<double>").alias("v")).withColumn("nth", nth).where(F.col("nth") <= k + 1).drop("nth")


def nearest_in(space: Space, k: int) -> DataFrame:
    """a, b, d: the k nearest others of each row of a space by distance (ties: the smaller id); fewer where there are fewer rows."""
    return nearest_lists(space, k).select("a", F.explode("near").alias("n")).select("a", "n.b", "n.d")


def nearest_lists(space: Space, k: int) -> DataFrame:
    """a, near: the same as lists of d, b, nearest first."""

    def own(t: pa.Table) -> pa.Table:
        x, ids = matrix(t.column("v")), numbers(t.column("id"))
        most, parts = np.full(len(x), np.inf), [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for at in range(0, len(x), STEP):
            d2 = about(x[at : at + STEP], x)
            some = np.arange(at, min(at + STEP, len(x)))
            d2[some - at, some] = np.inf
            kk = min(k, len(x) - 1)
            if kk < 1:
                break
            reach = np.sqrt(np.partition(d2, kk - 1, axis=1)[:, kk - 1]) * (1 + 1e-7) + 1e-6
            i, j, d = within(x[some], x, reach)
            i, j, d = i[i + at != j], j[i + at != j], d[i + at != j]
            row, b, d = _pairs(some[i], ids[j], d, k)
            parts.append((row, b, d))
            if kk == k:
                most[some] = d[np.searchsorted(row, some, "right") - 1]  # the k-th is the last
        row, b, d = (np.concatenate(c) for c in zip(*parts, strict=True))
        return pa.table({"id": pa.array(ids), "v": t.column("v"), "block": t.column("block"), "most": pa.array(most), "near": _lists(row, b, d, len(x))})

    def kernel(q: pa.Table, t: pa.Table, tiles: Iterator) -> pa.Table:
        x, y, most = matrix(q.column("v")), matrix(t.column("v")), numbers(q.column("most")).astype(np.float64)
        a, b = numbers(q.column("id")), numbers(t.column("id"))
        out, parts, first, found = [], [], -1, 0

        def nearest_yet(last: bool) -> tuple:
            """The k nearest that a step's rows have found (and rows as near as the k-th, but at last), which bound what else they need."""
            nonlocal parts, found
            i, j, d = (np.concatenate(c) for c in zip(*parts, strict=True))
            keep = d <= most[i]
            i, j, d = i[keep], j[keep], d[keep]
            order = np.lexsort((b[j], d, i)) if last else _by_row(i, d)
            i, j, d = i[order], j[order], d[order]
            start = np.flatnonzero(np.diff(i, prepend=-1))
            many = np.diff(start, append=len(i))
            kth = start[many >= k] + k - 1
            most[i[kth]] = np.minimum(most[i[kth]], d[kth])
            keep = np.arange(len(i)) - np.repeat(start, many) < k if last else d <= most[i]
            parts, found = [(i[keep], j[keep], d[keep])], 0
            return parts[0]

        for rows, block in tiles:
            if parts and rows[0] // STEP != first:
                out.append(nearest_yet(True))
                parts, found = [], 0
            first = rows[0] // STEP
            i, j, d = within(x[rows], y[block], most[rows])
            parts.append((rows[i], j + block.start, d))
            found += len(i)
            if found > 2 * k * STEP:
                nearest_yet(False)
        if parts:
            out.append(nearest_yet(True))
        i, j, d = (np.concatenate(c) for c in zip((np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)), *out, strict=True))
        rows, place = np.unique(i, return_inverse=True)  # steps come one after the other, so i rises
        return pa.table({"a": pa.array(a[rows], pa.int64()), "near": _lists(place, b[j], d, len(rows))})

    lists = "near array<struct<d:double,b:long>>"
    met = checkpointed(space.rows.groupBy("block").applyInArrow(own, f"id long, v array<double>, block long, most double, {lists}"))
    met = met.withColumn("cell", F.floor(F.col("block") / _BLOCKS).cast("long"))
    more = space.meet(met, [], space.rows, kernel, f"a long, {lists}", own=False)
    near = met.select(F.col("id").alias("a"), "near").union(more).groupBy("a").agg(F.flatten(F.collect_list("near")).alias("near"))  # k of each slab at most
    return near.select("a", F.slice(F.array_sort("near"), 1, k).alias("near"))


def nearest(df: DataFrame, k: int) -> DataFrame:
    """a, b, d: the k nearest others of each row (id, v) by Euclidean distance rounded to nine digits (ties: the smaller id)."""
    return listed(df, k).select("a", F.explode("near").alias("n")).select("a", "n.b", "n.d")


def listed(df: DataFrame, k: int) -> DataFrame:
    """a, near: the same as lists of d, b, nearest first."""
    rows = checkpointed(df.select("id", F.col("v").cast("array<double>").alias("v")))
    some = checkpointed(distinct_enough(rows, k))
    if some.isEmpty():
        return df.sparkSession.createDataFrame([], "a long, near array<struct<d:double,b:long>>")
    found = nearest_lists(Space(some), k)
    copies = rows.join(some.select("id"), "id", "left_anti")
    same = some.groupBy("v").agg(F.slice(F.array_sort(F.collect_list("id")), 1, k).alias("b"))  # k + 1 at most
    rest = copies.join(same, "v").select(F.col("id").alias("a"), F.transform("b", lambda x: F.struct(F.lit(0.0).alias("d"), x.alias("b"))).alias("near"))
    return found.union(rest)
