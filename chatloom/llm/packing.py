"""Packing documents into token windows by Karmarkar-Karp differencing (operator 3).

Documents are tokenised, an end id is added, and what is longer than PIECE ids is cut into near-equal pieces. Pieces of
about BLOCK_WINDOWS windows at a time are split into k sets: every piece starts as a partition (size, 0, ..., 0), and the two
partial partitions with the largest imbalance are merged, the largest part of one with the smallest of the other, until
one is left. k starts at total / capacity, rounded up, and rises whenever a set exceeds the capacity. Each task packs what
it reads, block by block: there is no shuffle, and memory is bounded by a block.

Tokens: white space always ends a token of this vocabulary, so the distinct words of a slice are encoded once and a
document's ids are its words' ids in a row; so does the edge between letters and signs, so case and signs don't make a word
new. Tests compare that with the tokeniser's result for whole texts.

Defined results: a null text counts as empty and has the end id alone; rows that repeat are packed as often; sequence_id is
the task's number times 2^33 plus a count; padded_to is `capacity` but for sequences whose length is a power of two; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import documents, slices, trim

CAPACITY, PIECE, BLOCK_WINDOWS, END = 4096, 1024, 128, 2
#: Words (some 200 bytes each) that a worker remembers if not told otherwise, and the longest word that it does.
CACHE, CACHED_CHARS = 1_000_000, 64
#: Words that the tokeniser gets as one text.
TOGETHER = 1000
#: Letters that no normal form changes and signs after them, neither of which can be part of a special token's end: the rules below split such a word between both.
PARTS = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?;:&#$*]*)")
#: Normaliser, pre-tokeniser and end of a run in vocabularies for which that holds.
RULES = [
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "</w>",
]
SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, sequence_tokens long, ids binary"


class WordIds(dict):
    """Word -> its ids as little-endian 32-bit numbers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), CACHE
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        splits = [spec["normalizer"], spec["pre_tokenizer"], spec["model"].get("end_of_word_suffix")] == RULES
        #: For each id whether it ends a run of letters; None where the vocabulary follows other rules.
        self.ends = np.array([t.endswith("</w>") for t, _ in sorted(self.tokenizer.get_vocab().items(), key=lambda x: x[1])]) if splits else None
        del spec
        trim()  # reading takes more than the vocabulary keeps

    def encode(self, words: list[str]) -> list[bytes]:
        groups = [words[i : i + TOGETHER] for i in range(0, len(words), TOGETHER)]
        out: list[bytes] = []
        for group, e in zip(groups, self.tokenizer.encode_batch(groups, is_pretokenized=True, add_special_tokens=False), strict=True):
            blob = np.array(e.ids, "<u4").tobytes()
            sizes = np.bincount(np.array(e.word_ids, np.int64), minlength=len(group))
            out += [blob[a:b] for a, b in pairwise([0, *(4 * np.cumsum(sizes)).tolist()])]
        return out

    def encode_letters(self, words: list[str]) -> list[bytes]:
        """The same for words of letters alone: one text of them costs half of what as many pre-split words do."""
        groups = [words[i : i + TOGETHER] for i in range(0, len(words), TOGETHER)]
        out: list[bytes] = []
        for group, e in zip(groups, self.tokenizer.encode_batch_fast(list(map(" ".join, groups)), add_special_tokens=False), strict=True):
            ids = np.array(e.ids, "<u4")
            blob, ends = ids.tobytes(), (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
            out += [blob[a:b] for a, b in zip([0, *ends], ends, strict=False)] if len(ends) == len(group) else self.encode(group)
        return out

    def learn(self, words: list[str]) -> None:
        """Remember new words. Letters in either case, and letters with signs after them, get their ids from those of the lower-cased letters and of the signs."""
        found = [(w, m[1].lower(), m[2]) for w in words if (m := PARTS.fullmatch(w))] if self.ends is not None else []
        letters = [x for x in {x for _, x, _ in found} if x not in self]
        ids = dict(zip(letters, self.encode_letters(letters), strict=True))
        self.update(ids)
        rest = words if not found else [w for w in words if not PARTS.fullmatch(w)]
        signs = {x for _, _, x in found if x}
        other = [x for x in {*rest, *signs} if x not in self]
        self.update(zip(other, self.encode(other), strict=True))
        after = {x: self[x] for x in signs} | {"": b""}
        self.update([(w, (ids.get(a) or self[a]) + after[b]) for w, a, b in found])

    def __missing__(self, word: str) -> bytes:
        return self.encode([word])[0]

    def of(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, with the end id. Arrow finds the different words of all texts and lays their ids out in a row."""
        split = pc.split_pattern(pa.array([t.replace("\n", " ") for t in texts], pa.large_string()), " ")
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # to_pylist makes an Arrow object for each
        if len(self) > self.most:
            self.clear()
        found = list(map(self.get, words))
        new = [w for w, x in zip(words, found, strict=True) if x is None and len(w) <= CACHED_CHARS]  # set.difference would walk all of a subclass of dict
        for i in range(0, len(new), 10_000):
            self.learn(new[i : i + 10_000])
        ids = pa.array([self[w] if x is None else x for w, x in zip(words, found, strict=True)], pa.large_binary()).take(coded.indices)
        ends = np.concatenate([[0], np.cumsum(pc.binary_length(ids).to_numpy())])[split.offsets.to_numpy()].tolist()
        blob, end = memoryview(ids.buffers()[2] or b""), np.array([END], "<u4").tobytes()
        return [b"".join((blob[a:b], end)) for a, b in pairwise(ends)]


_loaded: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One for each Python worker and vocabulary."""
    if path not in _loaded:
        _loaded[path] = WordIds(path)
    return _loaded[path]


def forget(path: str) -> None:
    """The worker gives a vocabulary and its words back."""
    _loaded.pop(path, None)
    trim()


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """k sets of places in sizes, with near-equal sums."""
    empty = [None] * (k - 1)
    heap = []
    for i, s in enumerate(sizes):
        sums = np.zeros(k, np.int64)
        sums[0] = s
        heap.append((-s, i, sums, [(i,), *empty]))
    heapq.heapify(heap)
    n = len(heap)
    while len(heap) > 1:
        _, _, a, ga = heapq.heappop(heap)
        _, _, b, gb = heap[0]
        sums = a + b[::-1]
        groups = [x if y is None else y if x is None else (x, y) for x, y in zip(ga, reversed(gb), strict=True)]
        order = np.argsort(-sums, kind="stable")
        sums = sums[order] - sums[order[-1]]
        heapq.heapreplace(heap, (-int(sums[0]), n, sums, [groups[j] for j in order.tolist()]))
        n += 1
    out = []
    for tree in heap[0][3] if heap else []:
        places, todo = [], [tree]
        while todo:
            x = todo.pop()
            if x is None:
                continue
            if len(x) == 1:
                places.append(x[0])
            else:
                todo += x
        out.append(sorted(places))
    return out


def windows(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Sets with sums up to capacity; their number rises until none exceeds it."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        sets = differencing(sizes, k)
        if all(sum(sizes[i] for i in x) <= capacity for x in sets):
            return [x for x in sets if x]
        k += max(1, k // 128)


def cut(tokens: int, piece: int = PIECE) -> list[tuple[int, int]]:
    """(start, length) of near-equal pieces."""
    n = -(-tokens // piece)
    edges = [tokens * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def pack_documents(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, piece: int = PIECE, remembered: int | None = None) -> DataFrame:
    """A row for each piece: SCHEMA and padded_to. See the module's text. With `remembered`, a worker remembers about as many words, and those and the
    vocabulary only until its task ends: less memory for more encoding, with equal rows."""
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("word_bpe_49k.json")

    def flush(pieces: list, first: int) -> tuple[pa.RecordBatch, int]:
        sets = windows([p[2] for p in pieces], capacity)
        rows = []
        for n, places in enumerate(sets):
            offset, total = 0, sum(pieces[i][2] for i in places)
            for i in places:
                doc, start, length, tokens, blob = pieces[i]
                rows.append((doc, start, length, tokens, first + n, offset, total, blob))
                offset += length
        columns = list(zip(*rows, strict=True))
        arrays = [pa.array(c, pa.binary() if i == 7 else pa.int64()) for i, c in enumerate(columns)]
        return pa.RecordBatch.from_arrays(arrays, [x.split()[0] for x in SCHEMA.split(", ")]), first + len(sets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = word_ids(vocabulary)
        ids_of.most = CACHE if remembered is None else remembered
        pieces: list = []
        pending, first = 0, TaskContext.get().partitionId() << 33
        for ids, texts in slices(batches):
            for doc, blob in zip(ids.to_pylist(), ids_of.of(texts), strict=True):
                tokens = len(blob) // 4
                for start, length in cut(tokens, piece):
                    pieces.append((doc, start, length, tokens, blob[4 * start : 4 * (start + length)]))
                    pending += length
                    if pending >= BLOCK_WINDOWS * capacity:
                        batch, first = flush(pieces, first)
                        yield batch
                        pieces, pending = [], 0
        if pieces:
            yield flush(pieces, first)[0]
        if remembered is not None:
            del ids_of
            forget(vocabulary)

    packed = documents(docs).mapInArrow(run, SCHEMA)
    full = F.col("sequence_tokens")
    return packed.withColumn("padded_to", F.when(full.bitwiseAND(full - 1) == 0, full).otherwise(capacity).cast("long"))


def digest(packed: DataFrame) -> DataFrame:
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "sequence_tokens", "padded_to")
