"""Substring deduplication by difference-cover suffix sorting (operator 1): every byte under a WIDTH-byte string that also
starts earlier goes.

1. Each WIDTH-byte window has an anchor: the K-byte string in it with the least hash. Equal windows have the same anchor at the
same place, so a run of windows with one anchor, a fragment, stands for all of them. A fragment is a row of two hashes, 64 bits
of its anchor and 64 bits of its bytes, whatever its length; equal fragments of a slice are merged before the shuffle.
2. Fragments are sorted by anchor, bytes and place. All but the first of equal ones repeat in whole. The first ones go on
if their anchor has fragments with other bytes.
3. Their bytes are fetched, and suffixes are sorted by blockwise difference-cover construction: places relative to the
anchor that are in the cover COVER modulo PERIOD are ranked from the right, each by the bytes up to the next one and its
rank; then one suffix bucket (anchor, distance to it) is sorted at a time by the bytes up to the next cover place, long ties
resolved by that place's rank. Equal windows are in the same bucket, so one cover place serves all. Neighbours are compared byte by byte.
A block holds at most BLOCK_FRAGMENTS fragments of whole anchors, which bounds memory. Anchors with more are counted beforehand; their
fragments are dealt as windows by (anchor, distance) bucket and two hashes of the window's bytes, left and right of the anchor alike, so
equal windows meet, and the earliest of each is an aggregate, which is partial before the shuffle: no task holds such a group.
4. Ranges are merged for each document and cut out.

Defined results: a null text counts as empty; a null doc_id is the smallest; windows of rows with the same doc_id and start are no
earlier than each other; texts under WIDTH bytes stay whole; an empty table gives an empty result; other columns are ignored. A false
merge in step 1, or of windows of an anchor with too many fragments, needs equal 128-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import attach, documents, materialize, mix, slices

WIDTH, K = 100, 32
PERIOD, COVER = 13, (0, 1, 3, 9)
BLOCK_FRAGMENTS = 30_000
SEGMENT = 1 << 21
NO_ID = -(1 << 63)
_rng = np.random.default_rng(1)
_T1, _T2 = (_rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))
_B1, _B2 = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03
_powers: dict = {}


def _pow(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of base and of its inverse modulo 2^64."""
    if base not in _powers or len(_powers[base][0]) < n:
        size = max(n, 1 << 20)
        up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _powers[base] = (np.cumprod(up), np.cumprod(down))
    return _powers[base][0][:n], _powers[base][1][:n]


def _sums(data: np.ndarray, table: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = _pow(base, len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * up[:-1], out=total[1:])
    return total, down


def fragments(data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of all windows of texts in a row: each fragment's first window's place, number of windows, distance from it to the anchor, hash of
    the anchor, hash of the bytes."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < WIDTH:
        return none, none, none, none, none
    total, down = _sums(data, _T1, _B1)
    grams = mix((total[K:] - total[:-K]) * down[: n - K + 1])
    key = grams & ~np.uint64(0xFFFFFF) | np.arange(len(grams), dtype=np.uint64)
    span = WIDTH - K + 1
    low, width = key, 1
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = np.minimum(low[: len(low) - (span - width)], low[span - width :])
    anchor = (low & np.uint64(0xFFFFFF)).astype(np.int64)  # of the window at each place
    ends = np.cumsum(sizes)
    fine = np.zeros(n + 1, np.int32)
    some = sizes >= WIDTH
    np.add.at(fine, (ends - sizes)[some], 1)
    np.add.at(fine, ends[some] - WIDTH + 1, -1)
    fine = np.cumsum(fine)[: len(anchor)] > 0
    begin = fine.copy()
    begin[1:] &= (anchor[1:] != anchor[:-1]) | ~fine[:-1]
    first = np.flatnonzero(begin)
    if not len(first):
        return none, none, none, none, none
    count = np.add.reduceat(fine.astype(np.int64), first)
    total, down = _sums(data, _T2, _B2)
    stop = first + count + WIDTH - 1
    bytes_hash = mix((total[stop] - total[first]) * down[first] + count.astype(np.uint64))
    return first, count, anchor[first] - first, grams[anchor[first]].view(np.int64), bytes_hash.view(np.int64)


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id (NO_ID for null), tag (of the text) and text; doc_id and tag name a document."""
    d = documents(docs)
    return d.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "text", F.xxhash64("text").alias("tag"))


def fragment_rows(named: DataFrame) -> DataFrame:
    """anchor, bytes, doc_id, tag, start, shape (windows * 128 + distance), again: whether the slice has an equal one earlier."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tags, done = batch.column(2), 0
            for ids, texts in slices(iter([batch])):
                ids = ids.to_numpy()
                tag = tags.slice(done, len(texts)).to_numpy()
                done += len(texts)
                parts, owner, base = [], [], []
                for i, t in enumerate(texts):  # a huge text in parts that share the windows' overlap
                    b = t.encode()
                    for a in range(0, max(len(b) - WIDTH + 1, 1), SEGMENT):
                        parts.append(b[a : a + SEGMENT + WIDTH - 1])
                        owner.append(i)
                        base.append(a)
                sizes = np.fromiter(map(len, parts), np.int64, len(parts))
                owner, base = np.array(owner), np.array(base, np.int64)
                step = np.searchsorted(np.cumsum(sizes), np.arange(0, sizes.sum() + 1, 2 * SEGMENT)[1:]) + 1
                for lo, hi in zip([0, *step.tolist()], [*step.tolist(), len(parts)], strict=True):
                    if hi <= lo:
                        continue
                    data = np.frombuffer(b"".join(parts[lo:hi]), np.uint8)
                    first, count, left, anchor, content = fragments(data, sizes[lo:hi])
                    if not len(first):
                        continue
                    edge = np.cumsum(sizes[lo:hi])
                    part = np.searchsorted(edge, first, side="right") + lo
                    doc, start = ids[owner[part]], first - (edge - sizes[lo:hi])[part - lo] + base[part]
                    order = np.lexsort((start, doc, content, anchor))
                    same = (anchor[order][1:] == anchor[order][:-1]) & (content[order][1:] == content[order][:-1])
                    later = np.zeros(len(first), bool)
                    run_first = np.r_[True, ~same]
                    head = order[np.maximum.accumulate(np.where(run_first, np.arange(len(order)), 0))]
                    later[order] = ~run_first & ((doc[order] != doc[head]) | (start[order] != start[head]))
                    key = np.where(later, mix(doc.view(np.uint64) + mix(start.view(np.uint64))).view(np.int64), anchor)
                    columns = [key, content, doc, tag[owner[part]], start, (count * 128 + left).astype(np.int32), later]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "bytes", "doc_id", "tag", "start", "shape", "again"])

    return named.mapInArrow(run, "anchor long, bytes long, doc_id long, tag long, start long, shape int, again boolean")


def compare_fragments(rows: DataFrame) -> DataFrame:
    """doc_id, tag, start, shape, anchor of fragments that repeat (mixed false), and of those to compare by bytes (mixed true)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # anchor, bytes, doc_id, start of the last class, and its first row if that isn't out yet
        names = ["anchor", "bytes", "doc_id", "tag", "start", "shape", "again"]
        for b in batches:
            if not len(b):
                continue
            c = {n: b.column(i).to_numpy(zero_copy_only=False) for i, n in enumerate(names)}
            prior = last or (None, None, None, None, None)
            pa_, pb = np.r_[0, c["anchor"][:-1]], np.r_[0, c["bytes"][:-1]]
            same_a, same_b = c["anchor"] == pa_, c["bytes"] == pb
            same_a[0] = last is not None and c["anchor"][0] == prior[0]
            same_b[0] = last is not None and c["bytes"][0] == prior[1]
            own = c["again"]  # merged before the shuffle: repeats in whole; alone under its key
            head = ~(same_a & same_b) & ~own
            at = np.maximum.accumulate(np.where(head, np.arange(len(b)), -1))
            hd, hs = (np.where(at >= 0, c[k][np.maximum(at, 0)], prior[i] if last else 0) for k, i in (("doc_id", 2), ("start", 3)))
            repeats = own | ~head & ((c["doc_id"] != hd) | (c["start"] != hs))
            # classes whose anchor has another class: the one before or after them in this order
            second = head & same_a
            heads = np.flatnonzero(head)
            mixed = second.copy()
            if len(heads):
                mixed[heads[:-1]] |= second[heads[1:]]
            out = np.flatnonzero(repeats | mixed)
            arrays = [pa.array(c[k][out]) for k in ("doc_id", "tag", "start", "shape", "anchor")] + [pa.array(mixed[out])]
            fields = ["doc_id", "tag", "start", "shape", "anchor", "mixed"]
            if len(heads) and second[heads[0]] and last is not None and prior[4] is not None:
                yield pa.RecordBatch.from_arrays([pa.array([v], a.type) for v, a in zip((*prior[4], True), arrays, strict=True)], fields)
            if len(out):
                yield pa.RecordBatch.from_arrays(arrays, fields)
            if len(heads):
                i = int(heads[-1])
                last = (c["anchor"][i], c["bytes"][i], c["doc_id"][i], c["start"][i], None if mixed[i] else tuple(c[k][i].item() for k in ("doc_id", "tag", "start", "shape", "anchor")))
            if len(heads) == 0 and last is not None:
                last = (*last[:4], last[4])

    dealt = rows.repartition("anchor").sortWithinPartitions("anchor", "bytes", "doc_id", "start")
    return dealt.mapInArrow(run, "doc_id long, tag long, start long, shape int, anchor long, mixed boolean")


def _offsets(low: int, high: int) -> list[int]:
    return [r for r in range(low, high) if r % PERIOD in COVER]


def repeated_windows(anchor: np.ndarray, doc: np.ndarray, start: np.ndarray, shape: np.ndarray, blobs: list[bytes]) -> np.ndarray:
    """fragments x distance (to the anchor): whether the window there is in an earlier fragment too. Step 3 of the module's text."""
    n = len(blobs)
    count, left = shape // 128, shape % 128
    sizes = np.fromiter(map(len, blobs), np.int64, n)
    data = np.frombuffer(b"".join(blobs) + bytes(16), np.uint8)
    middle = np.cumsum(sizes) - sizes + left  # the anchor's place
    word = np.zeros(len(data) - 8, np.uint64)  # eight bytes from each place, the first one highest
    for j in range(8):
        word = word << np.uint64(8) | data[j : j + len(word)].astype(np.uint64)
    right = sizes - left
    far = int(right.max())
    cover = _offsets(-int(left.max()), far)
    ranks: dict[int, np.ndarray] = {}
    following, then = None, far
    for r in reversed(cover):
        rank = np.full(n, -1, np.int64)
        has = np.flatnonzero((r >= -left) & (r < right))
        if len(has):
            gap = min(then - r, 8)
            w = word[middle[has] + r] >> np.uint64(64 - 8 * gap)
            t = following[has] if following is not None else np.zeros(len(has), np.int64)
            order = np.lexsort((t, w))
            new = np.r_[False, (w[order][1:] != w[order][:-1]) | (t[order][1:] != t[order][:-1])]
            rank[has[order]] = np.cumsum(new)
        ranks[r] = following = rank
        then = r
    out = np.zeros((n, WIDTH - K + 1), bool)
    for d in range(WIDTH - K + 1):  # one suffix bucket at a time
        has = np.flatnonzero((d <= left) & (d > left - count))
        if len(has) < 2:
            continue
        r = next(x for x in cover if x >= -d)
        place = middle[has] - d
        w = word[place] >> np.uint64(64 - 8 * (r + d)) if r + d else np.zeros(len(has), np.uint64)
        order = np.lexsort((ranks[r][has], w, anchor[has]))
        p, o = place[order], has[order]
        equal = (anchor[o][1:] == anchor[o][:-1]) & (w[order][1:] == w[order][:-1])
        for j in [*range(0, WIDTH - 8, 8), WIDTH - 8]:
            at = np.flatnonzero(equal)
            equal[at] = word[p[at] + j] == word[p[at + 1] + j]
        if not equal.any():
            continue
        group = np.cumsum(np.r_[True, ~equal])
        by_place = np.lexsort((start[o] + left[o] - d, doc[o], group))
        g, q = group[by_place], o[by_place]
        head = np.maximum.accumulate(np.where(np.r_[True, g[1:] != g[:-1]], np.arange(len(g)), 0))
        where = start + left - d
        out[q, d] = (doc[q] != doc[q[head]]) | (where[q] != where[q[head]])
    return out


def ranges_of(repeats: np.ndarray, start: np.ndarray, shape: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fragment, first window's place and number of windows of each run of repeated windows."""
    count, left = shape // 128, shape % 128
    at = left[:, None] - np.arange(repeats.shape[1])[None]  # the distance of the fragment's j-th window
    line = np.take_along_axis(repeats, np.clip(at, 0, repeats.shape[1] - 1), 1) & (np.arange(repeats.shape[1])[None] < count[:, None])
    edge = np.diff(np.pad(line, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    f, a = np.nonzero(edge == 1)
    _, b = np.nonzero(edge == -1)
    return f, start[f] + a, b - a


def fetched(named: DataFrame, mixed: DataFrame) -> DataFrame:
    """anchor, doc_id, tag, start, shape, bytes of mixed fragments."""
    places = mixed.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("anchor", "start", "shape")).alias("places"))  # up to a text's length

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(len(b)):
                doc, tag, text, places = (b.column(k)[i].as_py() for k in range(4))
                data = text.encode()
                rows = [(x["anchor"], doc, tag, x["start"], x["shape"], data[x["start"] : x["start"] + x["shape"] // 128 + WIDTH - 1]) for x in places]
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["anchor", "doc_id", "tag", "start", "shape", "bytes"])

    return named.join(places, ["doc_id", "tag"]).select("doc_id", "tag", "text", "places").mapInArrow(fetch, "anchor long, doc_id long, tag long, start long, shape int, bytes binary")


def mixed_ranges(named: DataFrame, mixed: DataFrame) -> DataFrame:
    """doc_id, tag, start, n of the repeated windows of mixed fragments."""
    big = materialize(mixed.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK_FRAGMENTS).select("anchor"), "big")
    if big.isEmpty():
        return block_ranges(fetched(named, mixed))
    hot = F.broadcast(big)  # fewer than fragments / BLOCK_FRAGMENTS
    return block_ranges(fetched(named, mixed.join(hot, "anchor", "left_anti"))).unionByName(window_ranges(fetched(named, mixed.join(hot, "anchor", "left_semi"))))


def block_ranges(rows: DataFrame) -> DataFrame:
    """mixed_ranges() of fragments whose anchors have at most BLOCK_FRAGMENTS each, a block of whole anchors at a time."""

    def solve(t: pa.Table) -> pa.RecordBatch:
        anchor, doc, tag, start, shape = (t.column(i).to_numpy() for i in range(5))
        shape = shape.astype(np.int64)
        f, at, n = ranges_of(repeated_windows(anchor, doc, start, shape, t.column(5).to_pylist()), start, shape)
        return pa.RecordBatch.from_arrays([pa.array(doc[f]), pa.array(tag[f]), pa.array(at), pa.array(n)], ["doc_id", "tag", "start", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def blocks(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held
            t = pa.Table.from_batches(held)
            a = t.column(0).to_numpy()
            edge = np.r_[np.flatnonzero(a[1:] != a[:-1]) + 1, len(a)] if last else np.flatnonzero(a[1:] != a[:-1]) + 1  # the last anchor may go on
            lo = 0
            while len(edge) and lo < edge[-1]:
                hi = int(edge[np.searchsorted(edge, lo + BLOCK_FRAGMENTS, side="right") - 1])
                if not lo < hi <= lo + BLOCK_FRAGMENTS:
                    raise ValueError("an anchor has more fragments than a block")
                if not last and hi == edge[-1] and hi - lo < BLOCK_FRAGMENTS and lo:
                    break  # a part of a block waits for more
                yield solve(t.slice(lo, hi - lo))
                lo = hi
            held = t.slice(lo).combine_chunks().to_batches()

        for b in batches:
            if len(b):
                held.append(b)
                if sum(map(len, held)) > BLOCK_FRAGMENTS:
                    yield from blocks(False)
        if held:
            yield from blocks(True)

    return rows.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, "doc_id long, tag long, start long, n long")


def window_rows(rows: DataFrame) -> DataFrame:
    """anchor, distance, h1, h2 (of the window's bytes), doc_id, tag, start of every window of fragments."""
    names = ["anchor", "distance", "h1", "h2", "doc_id", "tag", "start"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 1000):
                b = batch.slice(lo, 1000)
                anchor, doc, tag, start, shape = (b.column(i).to_numpy() for i in range(5))
                blobs = b.column(5).to_pylist()
                count, left = shape.astype(np.int64) // 128, shape.astype(np.int64) % 128
                sizes = np.fromiter(map(len, blobs), np.int64, len(blobs))
                data = np.frombuffer(b"".join(blobs), np.uint8)
                of = np.repeat(np.arange(len(blobs)), count)
                j = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)  # the fragment's j-th window
                place = (np.cumsum(sizes) - sizes)[of] + j
                h = []
                for table, base in ((_T1, _B1), (_T2, _B2)):
                    total, down = _sums(data, table, base)
                    h.append(mix((total[place + WIDTH] - total[place]) * down[place]).view(np.int64))
                columns = [anchor[of], (left[of] - j), *h, doc[of], tag[of], start[of] + j]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return rows.mapInArrow(run, "anchor long, distance long, h1 long, h2 long, doc_id long, tag long, start long")


def window_ranges(rows: DataFrame) -> DataFrame:
    """mixed_ranges() of fragments of any number, window by window."""
    windows = materialize(window_rows(rows), "windows")
    key = ["anchor", "distance", "h1", "h2"]
    groups = windows.groupBy(*key).agg(F.count("*").alias("copies"), F.min(F.struct("doc_id", "start")).alias("first")).where("copies > 1")
    found = attach(windows, materialize(groups, "windows"), key, "copies", windows.count())
    return found.where("copies > 1 and not (first.doc_id = doc_id and first.start = start)").select("doc_id", "tag", "start", F.lit(1).cast("long").alias("n"))


def repeated_ranges(named: DataFrame) -> DataFrame:
    """doc_id, tag, ranges (arrays of first window and number of windows) of documents with repeated windows."""
    compared = materialize(compare_fragments(fragment_rows(named)), "fragments")
    mixed = compared.where("mixed")
    whole = compared.where("not mixed").select("doc_id", "tag", "start", F.expr("shape div 128").cast("long").alias("n"))
    ranges = whole.unionByName(mixed_ranges(named, mixed))
    return ranges.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("start", "n")).alias("ranges"))  # up to a text's length


def removed_spans(ranges: list[dict]) -> list[tuple[int, int]]:
    """Merged byte ranges under the windows."""
    out: list[list[int]] = []
    for a, n in sorted((x["start"], x["n"]) for x in ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], a + n + WIDTH - 1)
        else:
            out.append([a, a + n + WIDTH - 1])
    return [tuple(x) for x in out]


def cut_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, spans (arrays of start, end in bytes), kept (bytes) for each of docs."""
    named = keyed(docs)
    ranges = materialize(repeated_ranges(named), "ranges")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            for lo in range(0, len(b), 256):
                part = b.slice(lo, 256)
                rows = []
                for doc, text, found in zip(*(part.column(k).to_pylist() for k in range(3)), strict=True):
                    data, spans = text.encode(), removed_spans(found or [])
                    kept, last = [], 0
                    for a, e in spans:
                        kept.append(data[last:a])
                        last = e
                    kept.append(data[last:])
                    rows.append((None if doc == NO_ID else doc, len(data), sum(e - a for a, e in spans), len(spans), [{"start": a, "end": e} for a, e in spans], b"".join(kept)))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), kind, pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"])

    return named.join(ranges, ["doc_id", "tag"], "left").select("doc_id", "text", "ranges").mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<struct<start long, end long>>, kept binary")


def digest(cut: DataFrame) -> DataFrame:
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(texts: dict[int, str]) -> dict[int, tuple]:
    """For small inputs: the result by definition."""
    seen: set[bytes] = set()
    out = {}
    for doc in sorted(texts):
        data = texts[doc].encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - WIDTH + 1):
            w = data[i : i + WIDTH]
            if w in seen:
                gone[i : i + WIDTH] = True
            seen.add(w)
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out[doc] = (len(data), int(gone.sum()), runs, hashlib.sha256(bytes(b for b, g in zip(data, gone, strict=True) if not g)).hexdigest())
    return out
