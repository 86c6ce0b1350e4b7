"""Quality classifier by regularised quadratic discriminant (operator 8).

Every text gives a vector of transformed statistics (FEATURES). Labelled rows of the learning folds give class counts,
means and covariances, summed over all of them on the executors; only (1 + d)^2 sums a class reach the driver. Each
class covariance is shrunk towards the pooled one and that towards its mean variance; the Cholesky factors are computed
once and broadcast. A score is the logistic of the difference of the two Mahalanobis log densities and log priors.

Defined results: null text counts as empty and is scored as such; rows with null doc_id or quality teach nothing; a null
doc_id counts as held out; a doc_id with several label rows teaches with each; if the labels have one class only, the
score is that class, and 0.5 without labels; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import code_points, documents, materialize, mix, slices

FEATURES = ("log_chars", "letters", "upper", "digits", "symbols", "marks", "spaces", "token_mean", "token_spread", "bare_tokens", "symbol_ends", "repeats", "variety", "lines")
#: Weight of the pooled covariance in a class covariance, and of its mean variance in the pooled one.
SHRINK, RIDGE = 0.1, 0.01
MARKS = ".,;:'\"?!-()"
SYMBOL, LETTER, UPPER, DIGIT, SPACE, LINE, MARK = range(7)


@lru_cache(1)
def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """For each code point its kind, and its 64-bit value (0 for white space)."""
    kind = np.zeros(0x110000, np.uint8)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            kind[i] = UPPER if c.isupper() else LETTER
        elif c.isdigit():
            kind[i] = DIGIT
        elif c == "\n":
            kind[i] = LINE
        elif c.isspace():
            kind[i] = SPACE
    kind[[ord(c) for c in MARKS]] = MARK
    value = mix(np.arange(1, 0x110001, dtype=np.uint64)) | np.uint64(1)
    value[(kind == SPACE) | (kind == LINE)] = 0
    return kind, value


def features(texts: list[str]) -> np.ndarray:
    """One row of FEATURES for each text, over the whole of it."""
    n = len(texts)
    kinds, values = _kinds()
    cps, sizes = code_points(texts)
    owner = np.repeat(np.arange(n), sizes)
    kind = kinds[cps]
    count = np.bincount(owner * 8 + kind, minlength=8 * n).reshape(n, 8).astype(float)
    chars = np.maximum(sizes, 1)
    share = lambda x, of=chars: np.log(x / np.maximum(of, 1) + 0.005)
    letters = count[:, LETTER] + count[:, UPPER]
    value = values[cps]
    inside = value > 0
    begins, ends = inside.copy(), inside.copy()
    if len(cps):
        begins[1:] &= ~inside[:-1] | (owner[1:] != owner[:-1])
        ends[:-1] &= ~inside[1:] | (owner[1:] != owner[:-1])
    starts, lasts = np.flatnonzero(begins), np.flatnonzero(ends)
    own = owner[starts]
    tokens = np.bincount(own, minlength=n).astype(float)
    some = np.maximum(tokens, 1)
    length = (lasts - starts + 1).astype(float)
    mean = np.bincount(own, length, n) / some
    spread = np.sqrt(np.maximum(np.bincount(own, length * length, n) / some - mean * mean, 0))
    if len(starts):
        since = (np.arange(len(cps)) - np.maximum.accumulate(np.where(begins, np.arange(len(cps)), 0))).astype(np.uint64)
        hashes = mix(np.add.reduceat(np.where(inside, value * (since * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)), np.uint64(0)), starts))
        has_letter = np.add.reduceat(((kind == LETTER) | (kind == UPPER)).astype(np.int64), starts) > 0
    else:
        hashes, has_letter = np.zeros(0, np.uint64), np.zeros(0, bool)
    again = np.zeros(len(starts), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (own[1:] == own[:-1])
    distinct = np.bincount(own[np.unique(hashes ^ mix(own.astype(np.uint64) + np.uint64(1)), return_index=True)[1]], minlength=n)
    tally = lambda mask: np.bincount(own[mask], minlength=n)
    out = [
        np.log1p(sizes), share(letters), share(count[:, UPPER], letters), share(count[:, DIGIT]), share(count[:, SYMBOL]), share(count[:, MARK]),
        share(count[:, SPACE] + count[:, LINE]), np.log(mean + 0.5), np.log(spread + 0.5), share(tally(~has_letter), some),
        share(tally(kind[lasts] == SYMBOL), some), share(tally(again), some), np.log(distinct + 1) / np.log(tokens + 2), share(count[:, LINE]),
    ]
    return np.stack(out, 1)


def add_features(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in slices(batches):
            x = features(texts)
            yield pa.RecordBatch.from_arrays([ids, pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))], ["doc_id", "x"])

    return documents(docs).mapInArrow(run, "doc_id long, x array<double>")


def held_out(id_column: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 3 == 1, F.lit(True))


def moments(taught: DataFrame) -> dict[int, np.ndarray]:
    """For each class the sums of (1, x) (1, x)^T over all rows of taught (x, quality). Spark adds them up: a second Python function after
    add_features would give each task two workers at once."""
    d = 1 + len(FEATURES)
    row = F.concat(F.array(F.lit(1.0)), "x")
    products = F.flatten(F.transform(row, lambda a: F.transform(row, lambda b: a * b)))
    each = taught.select(F.col("quality").cast("int").alias("k"), F.posexplode(products).alias("at", "v"))
    rows = each.groupBy("k", "at").agg(F.sum("v").alias("v")).collect()
    out = {k: np.zeros(d * d) for k in (0, 1)}
    for k, at, v in rows:  # (1 + d)^2 rows a class
        out[k][at] = v
    return {k: s.reshape(d, d) for k, s in out.items()}


def fit(sums: dict[int, np.ndarray], shrink: float = SHRINK, ridge: float = RIDGE) -> dict:
    """Means, inverse Cholesky factors and log constants of both classes; with fewer than two classes a constant."""
    n = {k: s[0, 0] for k, s in sums.items()}
    if min(n.values()) < 2:
        return {"constant": 0.5 if not sum(n.values()) else n[1] / sum(n.values())}
    mean = {k: s[0, 1:] / n[k] for k, s in sums.items()}
    cov = {k: s[1:, 1:] / n[k] - np.outer(mean[k], mean[k]) for k, s in sums.items()}
    pooled = sum(n[k] * cov[k] for k in cov) / sum(n.values())
    pooled = (1 - ridge) * pooled + ridge * np.diag(np.maximum(np.diag(pooled), 1e-6) + 1e-4)
    model: dict = {}
    for k in cov:
        low = np.linalg.cholesky((1 - shrink) * cov[k] + shrink * pooled)
        model[k] = (mean[k], np.linalg.inv(low), np.log(n[k] / sum(n.values())) - np.log(np.diag(low)).sum())
    return model


def score(model: dict, x: np.ndarray) -> np.ndarray:
    if "constant" in model:
        return np.full(len(x), model["constant"])
    logs = {k: const - 0.5 * (((x - mean) @ inv.T) ** 2).sum(1) for k, (mean, inv, const) in ((k, model[k]) for k in (0, 1))}
    return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def learn(table: DataFrame, labels: DataFrame) -> dict:
    """The model from all rows of table (doc_id, x) of the learning folds that have a label."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality").where(F.col("quality").isin(0, 1) & ~held_out())
    return fit(moments(table.join(known, "doc_id")))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for each of docs. See the module's text."""
    table = materialize(add_features(docs), "quality")
    model = docs.sparkSession.sparkContext.broadcast(learn(table, labels))  # d^2 numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                s = score(model.value, np.asarray(b.column(1).flatten()).reshape(len(b), -1))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s)], ["doc_id", "score"])

    scored = table.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_low_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs whose text the classifier accepts, with all their columns. Rows are scored where they are read, so texts aren't joined."""
    taught = docs.where(~held_out())
    model = docs.sparkSession.sparkContext.broadcast(learn(add_features(taught), labels))  # d^2 numbers
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = 0
            text = pa.RecordBatch.from_arrays([b.column(at), b.column(at).cast(pa.string()).fill_null("")], ["row", "text"])
            for _, texts in slices(iter([text])):
                keep = score(model.value, features(texts)) >= 0.5
                yield b.slice(done, len(texts)).filter(pa.array(keep))
                done += len(texts)

    return docs.mapInArrow(run, docs.schema)
