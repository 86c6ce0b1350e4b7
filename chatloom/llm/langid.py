"""Language identification by cross-parsing entropy (operator 6).

For each language a suffix automaton of a bounded sample of labelled text is built once and broadcast. A text is parsed
greedily into longest phrases that occur in a language's sample; the language with the fewest phrases, each weighted by
the log of its sample's length, wins. All texts of a slice are parsed in lock step, one numpy step a character, in blocks
of BLOCK characters, so a very long text costs no more a character than a short one. Blocks but a text's first one are parsed as if a phrase began
there; the phrases that reach over a block's edge are then parsed again until they meet a phrase of that block, so the count is exactly
that of parsing the text in one go. Every character is parsed.

Letters are lower-cased, and a run of anything else counts as one space. Every letter of the samples is a symbol of its own: a language's DENSE
commonest ones have a column in a dense table of transitions, the others are looked up in a sorted one, so scripts with thousands of
letters are told apart too. A letter that a language's sample lacks is a phrase of its own there.

The sample: SAMPLE_DOCS different documents a language on average (never more than twice as many), chosen by a hash among the
learning folds; of each a stretch of at most SAMPLE_CHARS characters at a place chosen by the hash; of these stretches equal shares, REFERENCE_CHARS
letters a language in all.

Defined results: `und` with score 0 if a text is null, has no letter, or no language could be learned; else the score is
the margin (second - best) / second of the two lowest weighted phrase counts, 1 if only one language is known; ties go
to the language first in alphabetical order; a null doc_id is held out; rows that repeat are returned as often; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chatloom.llm.common import code_points, documents, slices

SAMPLE_DOCS, SAMPLE_CHARS, REFERENCE_CHARS = 100, 2000, 24_000
BLOCK = 1024
#: Columns of the dense table: the space, what it doesn't hold, and a language's commonest letters.
DENSE = 46
SPACE, NONE = 0, 1
#: Characters times languages that are parsed at once.
AT_ONCE = 16_000_000


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True))


@lru_cache(1)
def _lower() -> np.ndarray:
    """Lower case of each letter, else 0."""
    out = np.zeros(0x110000, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            out[i] = ord(c.lower()[0])
    return out


def letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters of all texts in a row, each run of anything else as one 0, and how many each text has."""
    cps, sizes = code_points(texts)
    x = _lower()[cps]
    owner = np.repeat(np.arange(len(texts)), sizes)
    keep = x > 0
    if len(x):
        keep[1:] |= (x[:-1] > 0) & (owner[1:] == owner[:-1])
    return x[keep], np.bincount(owner[keep], minlength=len(texts))


def reference(texts: list[str], size: int) -> np.ndarray:
    """Letters of texts with a space after each, the same number of each as far as it has them, about `size` in all."""
    parts = [letters([t])[0] for t in texts]
    share, left = 0, size
    for n, k in zip(sorted(map(len, parts)), range(len(parts), 0, -1), strict=True):
        share = max(share, min(n, left // k))  # the shorter ones leave more to the others
        left -= min(n, left // k)
    return np.concatenate([np.zeros(0, np.uint32), *(np.r_[p[:share], np.uint32(0)] for p in parts)])


def automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of each state of the suffix automaton; 0 is no state, 1 the root."""
    trans: list[dict[int, int]] = [{}, {}]
    length, link = [0, 0], [0, 0]
    last = 1
    for c in symbols:
        cur = len(trans)
        trans.append({})
        length.append(length[last] + 1)
        link.append(1)
        p = last
        while p and c not in trans[p]:
            trans[p][c] = cur
            p = link[p]
        if p:
            q = trans[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                copy = len(trans)
                trans.append(dict(trans[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p and trans[p].get(c) == q:
                    trans[p][c] = copy
                    p = link[p]
                link[q] = link[cur] = copy
        last = cur
    return trans


class Model:
    """Languages in alphabetical order and the weight of a phrase in each; the transitions of all automata. States are numbered through, in
    steps of DENSE, so a state and a column add up to a place in the dense table."""

    def __init__(self, samples: dict[str, list[str]], size: int = REFERENCE_CHARS):
        self.langs = sorted(samples)
        parts = [reference(samples[k], size) for k in self.langs]
        self.weight = np.array([np.log2(max(len(p), 2)) for p in parts])
        #: Letters of all samples, and their numbers in a row: 0 the space, 1 any other letter.
        self.letters = np.unique(np.concatenate([*parts, np.zeros(1, np.uint32)]))[1:]
        n = len(self.letters) + 2
        self.column = np.full((len(self.langs), n), NONE, np.int32)
        self.root = np.zeros((len(self.langs), 1), np.int32)
        self.first = np.zeros((len(self.langs), n), np.int32)  # the state after a phrase's first letter: the root if it is a phrase of its own
        dense, keys, targets, base = [np.zeros(DENSE, np.int32)], [], [], 1
        for k, p in enumerate(parts):
            common = [c for c, _ in sorted(Counter(p[p > 0].tolist()).items(), key=lambda x: (-x[1], x[0]))]
            place = {int(np.searchsorted(self.letters, c)) + 2: i for i, c in enumerate(common)}
            self.column[k, SPACE] = SPACE
            for symbol, i in place.items():
                self.column[k, symbol] = min(i + 2, DENSE)
            trans = automaton(self.symbols(p).tolist())[1:]
            self.root[k] = self.first[k] = base * DENSE
            table = np.zeros((len(trans), DENSE), np.int32)
            for s, t in enumerate(trans):
                for symbol, to in t.items():
                    if (c := self.column[k, symbol]) < DENSE:
                        table[s, c] = (base + to - 1) * DENSE
                    else:
                        keys.append((base + s) * DENSE * n + symbol)
                        targets.append((base + to - 1) * DENSE)
            for symbol, to in trans[0].items():
                self.first[k, symbol] = (base + to - 1) * DENSE
            dense.append(table.ravel())
            base += len(trans)
        order = np.argsort(np.array(keys, np.int64))
        self.dense = np.concatenate(dense)
        self.keys, self.targets = np.r_[np.array(keys, np.int64)[order], 1 << 62], np.r_[np.array(targets, np.int32)[order], 0].astype(np.int32)

    def symbols(self, x: np.ndarray) -> np.ndarray:
        """0 for the space, 1 for a letter of no sample, else the letter's number."""
        if not len(self.letters):
            return np.where(x == 0, SPACE, NONE).astype(np.int32)
        at = np.minimum(np.searchsorted(self.letters, x), len(self.letters) - 1)
        return np.where(x == 0, SPACE, np.where(self.letters[at] == x, at + 2, NONE)).astype(np.int32)

    def step(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The next states (languages x texts), 0 where the sample has no such phrase."""
        column = self.column.take(symbol, 1)
        if len(self.keys) == 1:
            return self.dense.take(state + column)
        out = self.dense.take(state + np.minimum(column, DENSE - 1))
        sparse = column == DENSE
        if sparse.any():
            key = state[sparse].astype(np.int64) * self.column.shape[1] + np.broadcast_to(symbol, sparse.shape)[sparse]
            at = np.searchsorted(self.keys, key)
            out[sparse] = np.where(self.keys[at] == key, self.targets[at], 0)
        return out

    def phrases(self, x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Phrases of each text in each language."""
        s = self.symbols(x)
        blocks = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(sizes)), blocks)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        start = (np.cumsum(sizes) - sizes)[owner] + nth * BLOCK
        length = np.minimum(BLOCK, np.cumsum(sizes)[owner] - start)
        order = np.argsort(-length, kind="stable")
        owner, nth, start, length = owner[order], nth[order], start[order], length[order]
        state = np.repeat(self.root, len(owner), 1)
        begins = []  # at each step, where phrases begin (languages x blocks)
        lanes = np.searchsorted(-length, -np.arange(1, BLOCK + 1), side="right")
        first = self.first.ravel()
        for t in range(int(length[0]) if len(length) else 0):
            n = int(lanes[t])
            c = s[start[:n] + t]
            now = self.step(state[:, :n], c)
            miss = np.flatnonzero(now == 0)
            new = state[:, :n] == self.root
            new.ravel()[miss] = True
            begins.append(new)
            k, lane = np.divmod(miss, n)
            now.ravel()[miss] = first[k * self.first.shape[1] + c[lane]]
            state[:, :n] = now
        self._mend(s, begins, owner, nth, start, length, state)
        out, total = np.zeros((len(self.langs), len(sizes))), np.zeros(state.shape, np.int64)
        for new in begins:
            total[:, : new.shape[1]] += new
        for k in range(len(self.langs)):
            out[k] = np.bincount(owner, total[k], len(sizes))
        return out

    def _mend(self, s: np.ndarray, begins: list[np.ndarray], owner: np.ndarray, nth: np.ndarray, start: np.ndarray, length: np.ndarray, last: np.ndarray) -> None:
        """Let each text's phrases go on over the edges of blocks: from an edge on, parse again until a phrase begins where one did."""
        by_text = np.lexsort((nth, owner))
        inner = [(b, a) for b, a in zip(by_text[1:].tolist(), by_text[:-1].tolist(), strict=True) if nth[b]]  # a block and the one before it
        if not inner:
            return
        dense, letter, n = memoryview(self.dense), memoryview(s), self.column.shape[1]
        sparse = dict(zip(self.keys.tolist(), self.targets.tolist(), strict=True))
        for k, root in enumerate(self.root[:, 0].tolist()):
            column, first, going = memoryview(self.column[k]), memoryview(self.first[k]), {}
            for b, before in inner:
                state = going.pop(before, None) or int(last[k, before])
                for t, c in enumerate(letter[start[b] : start[b] + length[b]]):
                    to = dense[state + column[c]] if column[c] < DENSE else sparse.get(state * n + c, 0)
                    new, seen = not to or state == root, begins[t]
                    if new and seen[k, b]:
                        break
                    seen[k, b] = new
                    state = to or first[c]
                else:
                    going[b] = state  # no phrase of this block was met: the next one goes on from here

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        x, sizes = letters(texts)
        some = np.bincount(np.repeat(np.arange(len(texts)), sizes)[x > 0], minlength=len(texts)) > 0
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts))
        cost = self.phrases(x, sizes) * self.weight[:, None]
        best = cost.argmin(0)
        low = np.sort(cost, 0)
        margin = (low[1] - low[0]) / np.maximum(low[1], 1e-9) if len(low) > 1 else np.ones(len(texts))
        return [self.langs[b] if y else "und" for b, y in zip(best.tolist(), some.tolist(), strict=True)], np.where(some, margin, 0.0)


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()).withColumn("h", F.xxhash64("doc_id", "text"))
    counts = dict(rows.groupBy("lang").count().collect())  # one row a language
    chosen = F.lit(False)
    for lang, n in counts.items():
        chosen |= (F.col("lang") == lang) & (F.pmod("h", F.lit(1_000_003)) <= int(1_000_003 * sample_docs / n))
    at = F.lit(1) + F.pmod(F.xxhash64("h"), F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(1))).cast("int")
    some = rows.where(chosen).dropDuplicates(["lang", "h"]).select("lang", "h", F.substring("text", at, F.lit(SAMPLE_CHARS)).alias("part"))
    some = some.withColumn("nth", F.row_number().over(W.partitionBy("lang").orderBy("h"))).where(F.col("nth") <= 2 * sample_docs)
    samples: dict[str, list[str]] = {}
    for lang, _, text in sorted(some.select("lang", "h", "part").collect()):  # at most 2 x SAMPLE_DOCS x SAMPLE_CHARS characters a language
        samples.setdefault(lang, []).append(text)
    return Model(samples)


def detect_language(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each of docs. See the module's text."""
    shared = docs.sparkSession.sparkContext.broadcast(model or learn(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in slices(batches, AT_ONCE // max(4, len(shared.value.langs))):
            lang, score = shared.value.predict(texts)
            yield pa.RecordBatch.from_arrays([ids, pa.array(lang, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    found = documents(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
