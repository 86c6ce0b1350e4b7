"""Vector code compression by product codebooks (operator 12).

Components become integers, a vector is cut into PARTS parts, and each part is coded by the nearest entry of its codebook. Entries are filtered before any
distance is computed: with the sums S of a block of components, |x - c|^2 is at least the sum over blocks of (S_x - S_c)^2 / length plus the square of the
difference of the residual norms (what block means leave over). Bounds are taken over one block, then over finer ones, and an entry goes when its bound lies
above an exact distance that is known; bounds get a slack for the rounding of floats, so none goes wrongly. What survives gets exact integer distances, ties to
the lower index. A round is one scan: every task adds up its parts by entry, and the sums meet in an aggregate; only codebooks (PARTS x ENTRIES
entries) pass the driver.

Defined results: rows whose vector is null or holds null or non-finite components go. Vectors of different lengths count as padded with zeros to the longest
one's length, rounded up to a multiple of PARTS (an empty vector is all zeros). Components beyond +-B count as +-B, where B is the largest bound (2^30 at most) with which squared distances
fit a long. Rows that repeat count as often as they occur; of equal vec_ids the smaller vector comes first for the first codebooks, null ids come last. With
fewer than ENTRIES rows a codebook has as many entries. A sum beyond a long gives a null label_error. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import attach, materialize

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Vectors of one numpy step.
STEP = 2048
#: Share of the squared lengths by which a bound may be off.
SLACK = 1e-7


def prepared(vectors: DataFrame, parts: int = PARTS, scale: int = SCALE) -> DataFrame:
    """vec_id, label, v: the kept rows with integer components, written once."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding")).where(F.col("embedding").isNotNull() & finite)
    longest = kept.agg(F.max(F.size("embedding"))).first()[0] or 0
    width = max(1, -(-longest // parts)) * parts
    most = float(min(1 << 30, math.isqrt(((1 << 61) - 1) // width)))
    whole = F.transform("embedding", lambda x: F.floor(F.least(F.greatest(x * scale, F.lit(-most)), F.lit(most))).cast("int"))
    zeros = F.array_repeat(F.lit(0), F.lit(width) - F.size("embedding"))
    return materialize(kept.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.concat(whole, zeros).alias("v")), "vectors")


def _blocks(width: int) -> list[np.ndarray]:
    """Starts of blocks, from one block to finer ones of two components or more."""
    out, n = [], 1
    while n == 1 or n <= width // 2:
        out.append(np.arange(n) * width // n)
        n *= 2
    return out


class Nearest:
    """The nearest entry of each part's codebook; books: parts x entries x width, integers."""

    def __init__(self, books: np.ndarray):
        self.books = books
        self.square = (books.astype(np.float64) ** 2).sum(2)
        self.levels = [(starts, np.diff(starts, append=books.shape[2]), *self._shape(books, starts)) for starts in _blocks(books.shape[2])]
        self.counted = np.zeros(len(self.levels) + 1, np.int64)  # entries left before each level and at the end

    @staticmethod
    def _shape(x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Block sums, and the norm of what block means leave over."""
        sums = np.add.reduceat(x, starts, axis=-1).astype(np.float64)
        left = (x.astype(np.float64) ** 2).sum(-1) - (sums**2 / np.diff(starts, append=x.shape[-1])).sum(-1)
        return sums, np.sqrt(np.maximum(left, 0))

    def __call__(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """index and squared distance for each row and part of x (rows x parts x width)."""
        part = np.arange(x.shape[1])
        slack = SLACK * ((x.astype(np.float64) ** 2).sum(2)[:, :, None] + self.square)
        (_, length, sums, norms), *finer = self.levels
        own, rest = self._shape(x, self.levels[0][0])
        bound = (own - sums[..., 0]) ** 2 / length[0] + (rest[:, :, None] - norms) ** 2
        first = bound.argmin(2)
        known = ((x - self.books[part, first]) ** 2).sum(2)
        row, p, entry = np.nonzero(bound - slack <= known[:, :, None])
        self.counted[:2] += bound.size, len(row)
        for n, (starts, length, sums, norms) in enumerate(finer, 2):
            own, rest = self._shape(x, starts)
            bound = ((own[row, p] - sums[p, entry]) ** 2 / length).sum(1) + (rest[row, p] - norms[p, entry]) ** 2
            stays = bound - slack[row, p, entry] <= known[row, p]
            row, p, entry = row[stays], p[stays], entry[stays]
            self.counted[n] += len(row)
        exact = ((x[row, p] - self.books[p, entry]) ** 2).sum(1)
        group = row * x.shape[1] + p
        starts = np.flatnonzero(np.diff(group, prepend=-1))  # every row and part has an entry left
        least = np.minimum.reduceat(exact, starts)
        best = np.flatnonzero(exact == np.repeat(least, np.diff(starts, append=len(group))))
        best = best[np.diff(group[best], prepend=-1) != 0]  # the lowest index of equals
        return entry[best].reshape(x.shape[:2]), least.reshape(x.shape[:2])


def _steps(lists: pa.Array, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, rows x parts x width) of a column of equally long lists."""
    for low in range(0, len(lists), STEP):
        some = lists.slice(low, STEP)
        yield low, some.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(some), parts, -1)


def codebooks(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """parts x entries x width integers, learnt from all rows of vectors (as prepared)."""
    first = vectors.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).collect()
    if not first:
        return np.zeros((parts, 0, 1), np.int64)
    books = np.array([r["v"] for r in first], np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2)
    for _ in range(rounds):

        def run(batches: Iterator[pa.RecordBatch], books: np.ndarray = books) -> Iterator[pa.RecordBatch]:
            nearest = Nearest(books)
            sums = np.zeros((*books.shape[:2], books.shape[2] + 1), np.int64)  # and how many parts there are
            for batch in batches:
                for _, x in _steps(batch.column(0), len(books)):
                    index, _ = nearest(x)
                    for p in range(len(books)):
                        np.add.at(sums[p], index[:, p], np.concatenate([x[:, p], np.ones((len(x), 1), np.int64)], 1))
            flat = sums.ravel()
            used = np.flatnonzero(flat)
            yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(flat[used])], ["at", "total"])

        rows = vectors.select("v").mapInArrow(run, "at int, total long").groupBy("at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
        sums = [0] * (books.shape[0] * books.shape[1] * (books.shape[2] + 1))
        for r in rows:  # one for each component of each entry
            sums[r["at"]] = int(r["total"])
        table = np.array(sums, object).reshape(*books.shape[:2], -1)
        books = books.copy()
        for p, e in zip(*np.nonzero(table[:, :, -1]), strict=True):
            books[p, e] = [s // table[p, e, -1] for s in table[p, e, :-1]]
    return books


def coded(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code (binary: an index for each part), error (squared distance to what the code stands for)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = Nearest(books)
        for batch in batches:
            for low, x in _steps(batch.column(2), len(books)):
                index, far = nearest(x)
                some = batch.slice(low, len(x))
                codes = pa.array([c.tobytes() for c in index.astype(np.uint8)], pa.binary())
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), codes, pa.array(far.sum(1))], ["vec_id", "label", "code", "error"])

    kind = vectors.schema["label"].dataType.simpleString()
    return vectors.select("vec_id", "label", "v").mapInArrow(run, f"vec_id long, label {kind}, code binary, error long")


def decoded(codes: DataFrame, books: np.ndarray) -> DataFrame:
    """codes with v, the integers that each code stands for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(-1, len(books))
            v = books[np.arange(len(books)), index].reshape(len(index), -1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1, dtype=np.int32) * v.shape[1]), pa.array(v.ravel().astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "v"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in codes.schema)
    return codes.mapInArrow(run, f"{kinds}, v array<int>")


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """The coded rows with label_error (error summed over rows of equal label, nulls together), and the codebooks."""
    rows = prepared(vectors, parts)
    books = codebooks(rows, parts, entries, rounds)
    codes = materialize(coded(rows, books).select("*", F.col("label").isNull().alias("no_label"), F.coalesce(F.col("label").cast("string"), F.lit("")).alias("label_text")), "codes")
    sums = codes.groupBy("no_label", "label_text").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("total"), F.count("*").alias("size"))
    out = attach(codes, sums.select("no_label", "label_text", F.col("total").try_cast("long").alias("label_error"), "size"), ["no_label", "label_text"], "size", codes.count())
    return out.select("vec_id", "label", "code", "error", "label_error"), books


def digest(codes: DataFrame, books: np.ndarray) -> DataFrame:
    text = ",".join(map(str, books.ravel().tolist()))
    return codes.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(hashlib.sha256(text.encode()).hexdigest()).alias("codebooks_sha256"))


def oracle() -> str:
    """The same for DuckDB, round by round."""
    nearest = "list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i])))"
    out = f"""WITH k AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {SCALE}) AS BIGINT)) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        p AS (SELECT vec_id, pt, v[pt * (len(v) // {PARTS}) + 1 : (pt + 1) * (len(v) // {PARTS})] AS x FROM k, range({PARTS}) t(pt)),
        c0 AS (SELECT pt, row_number() OVER (PARTITION BY pt ORDER BY vec_id) - 1 AS e, x AS c FROM p WHERE vec_id IN (SELECT vec_id FROM k ORDER BY vec_id LIMIT {ENTRIES}))"""
    for r in range(ROUNDS + 1):
        out += f""", a{r} AS MATERIALIZED (SELECT vec_id, pt, arg_min(e, struct_pack(d := d, e := e)) AS e, min(d) AS d FROM (SELECT vec_id, pt, e, {nearest} AS d FROM p JOIN c{r} USING (pt)) GROUP BY 1, 2)"""
        if r < ROUNDS:
            out += f""", c{r + 1} AS MATERIALIZED (SELECT o.pt, o.e, coalesce(m.c, o.c) AS c FROM c{r} o LEFT JOIN (SELECT pt, e, list(q ORDER BY i) AS c FROM
            (SELECT pt, e, i, CAST((sum(y) - ((sum(y) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS q FROM (SELECT pt, e, unnest(x) AS y, unnest(range(len(x))) AS i FROM a{r} JOIN p USING (vec_id, pt)) GROUP BY 1, 2, 3) GROUP BY 1, 2) m ON m.pt = o.pt AND m.e = o.e)"""
    return f"""{out}, f AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY pt) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY 1)
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY pt, e)) FROM c{ROUNDS}) AS codebooks_sha256 FROM f JOIN k USING (vec_id)"""
