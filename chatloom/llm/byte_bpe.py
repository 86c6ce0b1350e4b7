"""Byte-level BPE encoding and decoding by a file of ranks (operator 13).

A text is split by the vocabulary's pattern, and the pieces of a slice are looked up in two tiers. First a minimal perfect hash over the vocabulary's byte
strings: levels of bit tables, each twice as wide as the keys that are left; a key sits in the first level where it has a place of its own, and its number is
the count of set bits before that place. Any piece gets one number, and is that token if the bytes agree. Pieces that miss are split into single
bytes in a linked list, and a heap of (rank, place) merges the pair of the lowest rank, the leftmost of equals, until no pair has a rank. Each worker
remembers short pieces, at most REMEMBERED. There is no shuffle; memory is bounded by a slice, or by one text if that is longer.

Defined results: a null text counts as empty and has no ids; rows that repeat are encoded each; an empty table gives an empty result; other columns are
ignored. Decoding gives the bytes, whatever the ids: they needn't be valid UTF-8; null ids or a null list give no bytes, and an id that isn't in the
vocabulary raises an error.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import documents, mix, slices

#: Pieces that a worker remembers, and the longest one that it does, in characters.
REMEMBERED, REMEMBERED_CHARS = 1_000_000, 48
#: Bits of a level for each key that is left.
WIDTH = 2
#: Ids that are decoded at once.
DECODED = 1_000_000
#: Ranges of letters and numbers of newer Unicode versions, which the library that defines the results takes for other signs.
NEWER = [
    "558", "58b-58c", "88f", "c5c", "cdc", "208f", "209d-209f", "a7ce-a7cf", "a7d2", "a7d4", "a7dd", "a7e2", "a7f1", "ab6c-ab6d", "107bb-107bf", "10940-10959", "10ec5-10ec7", "10ed9-10eee", "11b0a", "11db0-11ddb", "11de0-11de9", "11df1", "1246f", "12475-1247f", "12550-12686", "16ea0-16eb8",
    "16ebb-16ed3", "16ff2-16ff6", "187f8-187ff", "18cd6-18cda", "18d09-18d20", "18d80-18df2", "18e00-19191", "191a0-191d2", "1b123-1b128", "1b168", "1d6a6", "1df1f-1df24", "1df2b-1df81", "1df90-1df96", "1dfcd-1dfff", "1e6c0-1e6de", "1e6e0-1e6e2", "1e6e4-1e6e5", "1e6e7-1e6ed", "1e6f0-1e6f4", "1e6fe-1e6ff", "2b73a-2b73f", "2b81e", "2cea2-2cead", "323b0-33479", "3d000-3fc3f",
]
_newer = "[" + "".join("-".join(f"\\U{int(x, 16):08x}" for x in r.split("-")) for r in NEWER) + "]"


def splitter(pattern: str):
    """A function that cuts a text into the pattern's matches."""
    plain, newer = regex.compile(pattern), regex.compile(_newer)
    careful = regex.compile(pattern.replace(r"\p{L}", rf"[\p{{L}}--{_newer}]").replace(r"\p{N}", rf"[\p{{N}}--{_newer}]"), regex.V1)
    narrow = pattern.replace(r"\s\p{L}\p{N}", r"\sA-Za-z0-9").replace(r"\p{L}", "[A-Za-z]").replace(r"\p{N}", "[0-9]")
    ascii_ = plain if r"\p" in narrow else re.compile(narrow, re.ASCII)  # what the pattern says of ASCII texts

    def split(text: str) -> list[str]:
        if text.isascii():
            return ascii_.findall(text)
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return (careful if newer.search(text) else plain).findall(text)
        return plain.findall(text)

    return split


_FACTORS = np.cumprod(np.full(512, 0x9E3779B97F4A7C15, np.uint64))


def hashes(keys: list[bytes]) -> np.ndarray:
    """64-bit polynomial hashes of the keys' bytes; 0 bytes: 0."""
    sizes = np.fromiter(map(len, keys), np.int64, len(keys))
    data = np.frombuffer(b"".join(keys), np.uint8).astype(np.uint64)
    starts = np.cumsum(sizes) - sizes
    at = np.arange(len(data)) - np.repeat(starts, sizes)
    out = np.zeros(len(keys), np.uint64)
    full = sizes > 0
    if full.any():
        out[full] = np.add.reduceat(mix(data + np.uint64(1)) * (_FACTORS[at & 511] + (at >> 9).astype(np.uint64)), starts[full])
    return mix(out + sizes.astype(np.uint64))


class PerfectHash:
    """Numbers 0 .. n-1 for n different hashes; a hash that isn't one of them gets any number or -1."""

    def __init__(self, h: np.ndarray):
        if len(np.unique(h)) < len(h):
            raise ValueError("two keys have one 64-bit hash")
        self.levels: list[tuple[int, int]] = []  # where a level starts, how wide it is
        bits, left, start = [], h, 0
        while len(left):
            width = max(8, WIDTH * len(left))
            place = self._place(left, len(bits), width)
            alone = np.bincount(place, minlength=width) == 1
            bits.append(alone)
            self.levels.append((start, width))
            start += width
            left = left[~alone[place]]
        self.bits = np.concatenate([*bits, np.zeros(1, bool)])
        self.before = np.cumsum(self.bits, dtype=np.int64) - self.bits

    @staticmethod
    def _place(h: np.ndarray, level: int, width: int) -> np.ndarray:
        return (mix(h ^ np.uint64((level * 0x9E3779B97F4A7C15 + 1) % 2**64)) % np.uint64(width)).astype(np.int64)

    def numbers(self, h: np.ndarray) -> np.ndarray:
        out = np.full(len(h), -1, np.int64)
        open_ = np.arange(len(h))
        for level, (start, width) in enumerate(self.levels):
            place = start + self._place(h[open_], level, width)
            found = self.bits[place]
            out[open_[found]] = self.before[place[found]]
            open_ = open_[~found]
        return out


def first_pairs(ranks: dict[bytes, int]) -> list[list[int]]:
    """Rank of each pair of bytes, -1 for none."""
    return [[ranks.get(bytes((a, b)), -1) for b in range(256)] for a in range(256)]


def merged(piece: bytes, ranks: dict[bytes, int], pairs: list[list[int]]) -> list[int]:
    """The ids of a piece that isn't a token, by a heap over linked bytes. A heap's entry is rank, start and end of a pair in one number; it holds as long as
    the pair's two parts are still there, that is, the part after the one at start ends where it did."""
    n = len(piece)
    after = [*range(1, n + 1), n]  # where the part that starts at a place ends and the next one starts; 0: no part starts here
    before = list(range(-1, n))
    get, push, pop = ranks.get, heapq.heappush, heapq.heappop
    bits = n.bit_length()
    high, mask, step = 2 * bits, (1 << bits) - 1, (1 << bits) + 1
    heap = []
    place, last = 2 - step, None
    for b in piece:
        if last is not None and (r := last[b]) >= 0:
            heap.append((r << high) + place)
        last = pairs[b]
        place += step
    heapq.heapify(heap)
    while heap:
        x = pop(heap)
        end = x & mask
        i = x >> bits & mask
        j = after[i]
        if not j or j >= n or after[j] != end:
            continue
        after[i], after[j] = end, 0
        if end < n:
            before[end] = i
            k = after[end]
            if (r := get(piece[i:k])) is not None:
                push(heap, r << high | i << bits | k)
        b = before[i]
        if b >= 0 and (r := get(piece[b:end])) is not None:
            push(heap, r << high | b << bits | end)
    out, i = [], 0
    while i < n:
        j = after[i]
        out.append(ranks[piece[i:j]])
        i = j
    return out


class Vocabulary(dict):
    """Piece -> its ids as little-endian 32-bit numbers, for the short pieces seen so far."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.tokens = list(self.ranks)
        self.index = PerfectHash(hashes(self.tokens))
        keys = self.index.numbers(hashes(self.tokens))
        self.tokens = [self.tokens[i] for i in np.argsort(keys).tolist()]  # in the perfect hash's order
        self.split, self.pairs = splitter(pattern), first_pairs(self.ranks)
        by_id = sorted(self.ranks.items(), key=lambda x: x[1])
        if [r for _, r in by_id] != list(range(len(by_id))):
            raise ValueError("ranks must be 0, 1, 2, ...")
        self.coded = [i.to_bytes(4, "little") for i in range(len(by_id))]
        self.blob = np.frombuffer(b"".join(t for t, _ in by_id), np.uint8)
        self.ends = np.cumsum([len(t) for t, _ in by_id])

    def resolve(self, pieces: list[str]) -> list[bytes]:
        """The ids of pieces: whole tokens by the perfect hash, the others by merging."""
        keys = [p.encode() for p in pieces]
        ranks, tokens, coded, pairs = self.ranks, self.tokens, self.coded, self.pairs
        numbers = self.index.numbers(hashes(keys)).tolist()
        return [coded[ranks[key]] if n >= 0 and tokens[n] == key else b"".join([coded[i] for i in merged(key, ranks, pairs)]) for key, n in zip(keys, numbers, strict=True)]

    def __missing__(self, piece: str) -> bytes:
        return self.resolve([piece])[0]

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self.split(t) for t in texts]
        if len(self) > REMEMBERED:
            self.clear()
        new = [p for p in set().union(*split).difference(self) if len(p) <= REMEMBERED_CHARS]
        self.update(zip(new, self.resolve(new), strict=True))
        return [b"".join(map(self.__getitem__, pieces)) for pieces in split]

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids in a row, and how many bytes each list of `sizes` ids has."""
        if len(ids) and not 0 <= int(ids.min()) <= int(ids.max()) < len(self.ends):
            raise ValueError("an id isn't in the vocabulary")
        lengths = np.diff(self.ends, prepend=0)[ids]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        at = np.arange(ends[-1]) - np.repeat(ends[:-1] - (self.ends[ids] - lengths), lengths)
        edges = np.concatenate([[0], np.cumsum(sizes)])
        return self.blob[at], np.diff(ends[edges])


_loaded: dict[tuple[str, str], Vocabulary] = {}


def vocabulary(path: str | None = None, pattern: str | None = None) -> Vocabulary:
    """One for each Python worker, file and pattern."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = Vocabulary(path, pattern)
    return _loaded[path, pattern]


def _named(path: str | None, pattern: str | None) -> tuple[str, str]:
    import public_tokenizers

    return path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), pattern or public_tokenizers.PATTERN


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, ids: the token ids of each text. path: a file of ranks that every machine has."""
    path, pattern = _named(path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path, pattern)
        for docs_, texts in slices(batches):
            blobs = known.encode(texts)
            offsets = np.cumsum([0, *map(len, blobs)]) // 4
            ids = pa.array(np.frombuffer(b"".join(blobs), "<i4"))
            yield pa.RecordBatch.from_arrays([docs_, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), ids)], ["doc_id", "ids"])

    return documents(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, ids, decoded: the bytes of each row's ids."""
    path, pattern = _named(path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path, pattern)
        for batch in batches:
            sizes = np.array(batch.column(1).value_lengths().fill_null(0))
            cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // DECODED, prepend=0)) if len(sizes) else []
            for a, b in zip([0, *cuts], [*cuts, len(sizes)], strict=True):
                part = batch.slice(int(a), int(b - a))
                if not len(part):
                    continue
                lists = part.column(1)
                ids = lists.flatten()
                n = sizes[a:b]
                if ids.null_count:
                    given = np.cumsum(np.concatenate([[0], np.array(ids.is_valid())]))
                    edges = np.concatenate([[0], np.cumsum(n)])
                    ids, n = ids.drop_null(), np.diff(given[edges])
                data, lengths = known.decode(ids.to_numpy(zero_copy_only=False).astype(np.int64), n)
                offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                blobs = pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
                yield pa.RecordBatch.from_arrays([part.column(0), lists, blobs], ["doc_id", "ids", "decoded"])

    return encoded.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")).mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def digest(decoded: DataFrame) -> DataFrame:
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids.cast("binary"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
