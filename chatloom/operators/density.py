"""Density clusters of vectors: spanning tree over mutual reachability, condensed tree, choice by excess of mass.

1. Core distance: distance to the `samples`-th nearest other. Two rows are as far apart as the largest of their core distances and their distance.
2. The minimum spanning tree grows in Boruvka rounds (ties: the smaller pair of ids, so the tree is unique): each component takes its lightest edge out, which neighbour lists bound and
   a visit of cells (see neighbours) finds; components that take each other's edges join by pointer doubling. The number of rounds is at most log2 of the rows.
3. The tree's edges in order of weight make clusters: components below `least` rows fall into the cluster that they join, two larger ones close and open a new cluster. The tree is cut
   at median weights into pieces of at most PIECE edges; a component below the cut is one node above it, known by its size alone, so all pieces are worked off side by side.
4. A cluster is chosen if it is more stable than the best of what is below it; the whole table is never one cluster. Clusters have `least` rows or more, so there are far fewer than rows: up to
   TREE of them (times `least` rows or more each) are weighed against each other in one task."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.operators.graph import checkpointed, components, ranked
from chatloom.operators.neighbours import Space, distinct_enough, matrix, nearest_in, numbers, within

#: Edges of a piece; clusters that one task weighs; components that are broadcast at most.
PIECE, TREE, BROADCAST = 500_000, 1 << 22, 100_000
#: The least distance that a density is taken of: distances have nine digits.
LEAST_DISTANCE = 1e-9
#: Neighbours that are kept besides those that make a core distance.
MORE = 8


def _small(df: DataFrame, n: int) -> DataFrame:
    return F.broadcast(df) if n <= BROADCAST else df


def _foreign(q: pa.Table, t: pa.Table, tiles: Iterator) -> pa.Table:
    """For each component of the visitors its lightest edge to a row of another one, up to the visitors' `most`."""
    x, y, most = matrix(q.column("v")), matrix(t.column("v")), numbers(q.column("most"))
    a, b, ca, cb = numbers(q.column("id")), numbers(t.column("id")), numbers(q.column("comp")), numbers(t.column("comp"))
    core_a, core_b = numbers(q.column("core")), numbers(t.column("core"))
    best: dict[int, tuple] = {}
    names, place = np.unique(ca, return_inverse=True)
    lightest = np.full(len(names), np.inf)  # of each component, so far
    for rows, block in tiles:
        rows = rows[core_a[rows] <= lightest[place[rows]]]
        i, j, d = within(x[rows], y[block], np.minimum(most[rows], lightest[place[rows]]))
        i, j = rows[i], j + block.start
        other = ca[i] != cb[j]
        i, j, d = i[other], j[other], d[other]
        w = np.maximum(np.maximum(core_a[i], core_b[j]), d)
        lo, hi = np.minimum(a[i], b[j]), np.maximum(a[i], b[j])
        order = np.lexsort((hi, lo, w, ca[i]))
        first = order[np.diff(ca[i][order], prepend=-(1 << 63)) != 0] if len(order) else order
        np.minimum.at(lightest, place[i[first]], w[first])
        for c, *edge in zip(ca[i][first].tolist(), w[first].tolist(), lo[first].tolist(), hi[first].tolist(), cb[j][first].tolist(), strict=True):
            if c not in best or tuple(edge) < best[c]:
                best[c] = tuple(edge)
    columns = list(zip(*((c, *e) for c, e in best.items()), strict=True)) or [[]] * 5
    return pa.table({n: pa.array(c, pa.float64() if n == "w" else pa.int64()) for n, c in zip(("comp", "w", "lo", "hi", "other"), columns, strict=True)})


def spanning_tree(df: DataFrame, samples: int) -> DataFrame:
    """w, lo, hi: the edges of the minimum spanning tree of id, v by mutual reachability; lo < hi are ids."""
    spark = df.sparkSession
    rows = checkpointed(df.select("id", F.col("v").cast("array<double>").alias("v")))
    some = checkpointed(distinct_enough(rows, samples))
    n = some.count()
    if n < 2:
        return spark.createDataFrame([], "w double, lo long, hi long")
    space = Space(some)
    near = checkpointed(nearest_in(space, min(samples + MORE, n - 1)))
    nth = F.element_at(F.array_sort(F.collect_list("d")), min(samples, n - 1))  # samples + MORE of a row
    reach = near.groupBy(F.col("a").alias("id")).agg(nth.alias("core"), F.max("d").alias("seen"), F.count("*").alias("lists"))
    core = checkpointed(space.rows.join(reach, "id"))
    cores = core.select("id", "core")
    known = near.join(cores.toDF("a", "core_a"), "a").join(cores.toDF("b", "core_b"), "b")
    known = checkpointed(known.select("a", "b", F.greatest("core_a", "core_b", "d").alias("w"), F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")))
    comps = checkpointed(core.select("id", F.col("id").alias("comp")))
    trees, left = [], n
    while left > 1:
        # the lightest edge out of a component that neighbour lists know
        listed = known.join(comps.toDF("a", "comp"), "a").join(comps.toDF("b", "other"), "b").where("comp <> other").groupBy("comp").agg(F.min(F.struct("w", "lo", "hi", "other")).alias("e"))
        listed = checkpointed(listed)
        rows_now = checkpointed(core.join(comps, "id"))
        cells = rows_now.groupBy("cell").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).collect()  # one row a pivot
        skips = {c["cell"]: c["low"] for c in cells if c["low"] == c["high"]}
        bound = rows_now.join(_small(listed.select("comp", F.col("e.w").alias("most")), left), "comp", "left")
        bound = bound.withColumn("most", F.coalesce("most", F.lit(float("inf"))))
        unseen = F.when(F.col("lists") < n - 1, F.greatest("core", "seen"))  # what isn't on a row's list is no nearer
        asks = bound.where((unseen <= F.col("most")) & (F.col("core") <= F.col("most")))
        met = space.meet(asks, ["comp", "core"], rows_now.select("id", "v", "cell", "block", "comp", "core"), _foreign, "comp long, w double, lo long, hi long, other long", own=True, skips=skips)
        best = met.select("comp", F.struct("w", "lo", "hi", "other").alias("e")).union(listed).groupBy("comp").agg(F.min("e").alias("e"))
        best = checkpointed(best.select("comp", "e.w", "e.lo", "e.hi", F.col("e.other").alias("up")))
        trees.append(best.select("w", "lo", "hi").distinct())
        # of two components that take one edge the smaller id is the root; all others point to where their edge leads
        back = best.select(F.col("comp").alias("up"), F.col("up").alias("back"))
        up = checkpointed(best.join(back, "up").select("comp", F.when((F.col("back") == F.col("comp")) & (F.col("comp") < F.col("up")), F.col("comp")).otherwise(F.col("up")).alias("up")))
        while True:  # four steps at a time
            for _ in range(2):
                before, up = up, up.join(up.toDF("up", "further"), "up").select("comp", F.col("further").alias("up"))
            step = checkpointed(up.join(before.toDF("comp", "nearer"), "comp"))
            up = step.select("comp", "up")
            if step.where("up <> nearer").isEmpty():
                break
        comps = checkpointed(comps.join(_small(up, left), "comp").select("id", F.col("up").alias("comp")))
        left = comps.select("comp").distinct().count()
    first = some.groupBy("v").agg(F.min("id").alias("lo"))
    copies = rows.join(some.select("id"), "id", "left_anti").join(first, "v").select(F.lit(0.0).alias("w"), "lo", F.col("id").alias("hi"))
    out = trees[0]
    for t in trees[1:]:
        out = out.union(t)
    return checkpointed(out.union(copies))


def _worked(piece: str, edges: pd.DataFrame, least: int) -> pd.DataFrame:
    """What happens as a piece's edges join its nodes by rising weight, as rows kind, x, y, value, n:
    member (node x falls into cluster y), child (cluster x of n rows closes at density `value` below y), sum (n rows leave x, `value` is the sum of their densities),
    open (the piece's component goes on as cluster y), inside (node x is in the piece's component, which is below `least`)."""
    parent: dict[str, str] = {}
    state: dict[str, list] = {}  # root -> size, cluster, nodes that fell into none yet
    out = []

    def find(x: str, size: int) -> str:
        if x not in parent:
            parent[x] = x
            state[x] = [size, x if size >= least else None, [] if size >= least else [x]]
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b, w, o, na, nb in edges.sort_values("o")[["a", "b", "w", "o", "na", "nb"]].itertuples(index=False):
        x, y = find(a, na), find(b, nb)
        density = 1 / max(w, LEAST_DISTANCE)
        if state[x][0] < state[y][0]:
            x, y = y, x
        (n, cluster, nodes), (m, other, more) = state[x], state.pop(y)
        parent[y] = x
        if cluster and other:
            new = f"k{o}"
            out += [("child", cluster, new, density, n), ("child", other, new, density, m), ("sum", new, None, (n + m) * density, n + m)]
            state[x] = [n + m, new, []]
        elif cluster:
            out += [("member", node, cluster, 0.0, 0) for node in more] + [("sum", cluster, None, m * density, m)]
            state[x] = [n + m, cluster, []]
        elif n + m >= least:
            new = f"k{o}"
            out += [("member", node, new, 0.0, 0) for node in nodes + more] + [("sum", new, None, (n + m) * density, n + m)]
            state[x] = [n + m, new, []]
        else:
            state[x] = [n + m, None, nodes + more]
    ((_, cluster, nodes),) = state.values()
    out += [("open", piece, cluster, 0.0, 0)] if cluster else [("inside", node, piece, 0.0, 0) for node in nodes]
    return pd.DataFrame(out, columns=["kind", "x", "y", "value", "n"])


def _followed(rows: DataFrame, steps: DataFrame) -> DataFrame:
    """x, y with y followed along steps (x, y) as far as they go."""
    steps = steps.toDF("y", "next")
    while True:
        step = checkpointed(rows.join(steps, "y", "left").select("x", "y", "next"))
        rows = step.select("x", F.coalesce("next", "y").alias("y"))
        if step.where("next is not null").isEmpty():
            return rows


def condensed(edges: DataFrame, least: int, piece: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Of a spanning tree w, lo, hi: id, cluster (the smallest cluster that a row is in; rows in none are missing), and cluster, parent (null: at the
    top, which is no choice), stability."""
    piece = piece or PIECE
    name = lambda c: F.concat(F.lit("p"), F.col(c).cast("string"))
    work = ranked(edges, [F.col("w"), F.col("lo"), F.col("hi")], "o").select(F.lit("top").alias("piece"), name("lo").alias("a"), name("hi").alias("b"), "w", "o")
    work = checkpointed(work.withColumns({"na": F.lit(1).cast("long"), "nb": F.lit(1).cast("long")}))
    level, inside = 0, []
    while True:
        large = checkpointed(work.groupBy("piece").agg(F.count("*").alias("edges"), F.percentile("o", F.lit(0.5)).alias("middle")).where(F.col("edges") > piece).drop("edges"))
        if large.isEmpty():
            break
        level += 1
        cut = checkpointed(work.join(large, "piece", "left"))
        light, heavy = cut.where("o <= middle"), cut.where("o > middle")
        named = components(light.select("a", "b")).select("node", F.concat(F.lit(f"c{level}:"), "label").alias("comp"))
        nodes = light.select(F.col("a").alias("node"), F.col("na").alias("size")).union(light.select("b", "nb")).distinct().join(named, "node")
        sizes = nodes.groupBy("comp").agg(F.sum("size").alias("size"))
        into = checkpointed(named.join(sizes, "comp"))
        inner = light.join(into.select(F.col("node").alias("a"), "comp"), "a").select(F.col("comp").alias("piece"), "a", "b", "w", "o", "na", "nb")
        outer = heavy.join(into.toDF("ca", "a", "sa"), "a", "left").join(into.toDF("cb", "b", "sb"), "b", "left")
        outer = outer.select("piece", F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"), "w", "o", F.coalesce("sa", "na").alias("na"), F.coalesce("sb", "nb").alias("nb"))
        work = checkpointed(cut.where("middle is null").select(outer.columns).union(inner.select(outer.columns)).union(outer))
    schema = "kind string, x string, y string, value double, n long"
    rows = checkpointed(work.groupBy("piece").applyInPandas(lambda key, pdf: _worked(key[0], pdf, least), schema))
    of = lambda kind: rows.where(F.col("kind") == kind)
    opened = of("open").where("x <> 'top'").select("x", "y")
    inside = of("inside").where("y <> 'top'").select("x", "y")
    member = of("member").select("x", "y")
    if level:
        member = _followed(member, opened)
        below = _followed(inside, inside)  # the piece that fell into a cluster as a whole
        member = member.union(below.join(member.toDF("y", "cluster"), "y").select("x", "cluster"))
    points = member.where("x like 'p%'").select(F.substring("x", 2, 20).cast("long").alias("id"), F.col("y").alias("cluster"))
    child, sums = of("child").select("x", "y", "value", "n"), of("sum").select(F.col("x").alias("y"), "value", "n")
    if level:
        real = checkpointed(_followed(opened, opened)).toDF("ref", "real")
        child = child.join(real, F.col("x") == F.col("ref"), "left").select(F.coalesce("real", "x").alias("x"), "y", "value", "n")
        sums = sums.join(real, F.col("y") == F.col("ref"), "left").select(F.coalesce("real", "y").alias("y"), "value", "n")
    total = sums.groupBy(F.col("y").alias("cluster")).agg(F.sum("value").alias("total"))
    up = child.select(F.col("x").alias("cluster"), F.col("y").alias("parent"), F.col("value").alias("birth"), F.col("n").alias("size"))
    clusters = total.join(up, "cluster", "left").select("cluster", "parent", F.when(F.col("parent").isNotNull(), F.col("total") - F.col("size") * F.col("birth")).alias("stability"))
    return checkpointed(points), checkpointed(clusters)


def chosen(clusters: DataFrame) -> DataFrame:
    """cluster, pick: for each cluster the chosen one that it is part of, if any; ties between a cluster and what is below it go to the cluster."""
    n = clusters.count()
    if n > TREE:
        raise ValueError(f"{n} clusters; raise `least` so that there are at most {TREE}")

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frames = [b for b in batches if len(b)]
        if not frames:
            return
        rows = pd.concat(frames)
        up = {c: (p if isinstance(p, str) else None) for c, p in zip(rows["cluster"], rows["parent"], strict=True)}
        stable = dict(zip(rows["cluster"], rows["stability"], strict=True))
        below = defaultdict(list)
        for c, p in up.items():
            if p:
                below[p].append(c)
        order, todo = [], [c for c, p in up.items() if not p]
        while todo:
            c = todo.pop()
            order.append(c)
            todo += below[c]
        best, good = {}, {}
        for c in reversed(order):
            lower = sum(best[x] for x in below[c])
            good[c] = up[c] is not None and round(stable[c], 6) >= round(lower, 6)
            best[c] = stable[c] if good[c] else lower
        pick = {}
        for c in order:
            pick[c] = (pick[up[c]] if up[c] else None) or (c if good[c] else None)
        yield pd.DataFrame({"cluster": order, "pick": [pick[c] for c in order]})

    return clusters.select("cluster", "parent", "stability").repartition(1).mapInPandas(weigh, "cluster string, pick string").where("pick is not null")


def density_clusters(df: DataFrame, least: int, samples: int, piece: int | None = None) -> DataFrame:
    """id, label of id, v: clusters count from 0 in the order of their smallest ids, -1 is noise."""
    ids = df.select("id")
    tree = spanning_tree(df, samples)
    if tree.isEmpty():
        return ids.withColumn("label", F.lit(-1).cast("long"))
    points, clusters = condensed(tree, least, piece)
    found = checkpointed(points.join(chosen(clusters), "cluster").select("id", "pick"))
    places = ranked(found.groupBy("pick").agg(F.min("id").alias("first")), [F.col("first")], "label").select("pick", "label")
    return ids.join(found.join(places, "pick"), "id", "left").select("id", F.coalesce("label", F.lit(-1)).cast("long").alias("label"))


def sizes_for(n: int) -> tuple[int, int]:
    """least and samples for n rows."""
    least = max(5, min(50, n // 100))
    return least, max(3, least - 2)
