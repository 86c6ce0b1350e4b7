"""Work that is done once for what repeats: parts of words, texts of messages, objects of a batch."""

import tracemalloc
from zlib import crc32

import numpy as np
import pyarrow as pa

from chatloom import catalog
from chatloom.functions import scripts
from chatloom.operators import assign, embed


def _features(text):
    """Part by part."""
    words = "".join(c if c.isalnum() else " " for c in text.lower()).split()
    parts = [(w, embed.SHARES[0]) for w in words] + [(f"{a} {b}", embed.SHARES[1]) for a, b in zip(words, words[1:])] + [(f"^{w}$"[i : i + 3], embed.SHARES[2]) for w in words for i in range(len(w))]
    out = {}
    for p, share in dict.fromkeys(parts):
        h = crc32(f"{share}:{p}".encode()) * 0x9E3779B97F4A7C15 % 2**64
        weight = share * (1 + np.log(parts.count((p, share))))
        at = (h >> 20) % embed.BUCKETS
        out[at] = out.get(at, 0) + (weight if h >> 63 else -weight)
    return out


def test_known_words_are_not_hashed_again(monkeypatch):
    calls = []
    monkeypatch.setattr(embed, "crc32", lambda b: calls.append(b) or crc32(b))
    for text in ["", "...", "a", "one two, one TWO three-four 5", "Ünïcode straße 你好 İstanbul one", "a\x00b " + "long" * 20]:
        at, weight = embed.features(text)
        want = _features(text)
        assert at.tolist() == sorted(want) and np.allclose(weight, [want[x] for x in at.tolist()])
    calls.clear()
    embed.features("three one two one two")
    assert {c[:3] for c in calls} == {b"0.7"}  # runs of two words alone


def test_fused_queries_look_at_each_text_once(spark, tmp_path, monkeypatch):
    rows = [(i, ["red linen box", "blue tin", "green tin box"][i % 3], "Tin") for i in range(300)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_type string").write.parquet(f"{tmp_path}/part.parquet")
    seen = []
    for name in ("rescued", "decide"):
        real = getattr(assign, name)
        monkeypatch.setattr(assign, name, lambda scores, *a, real=real: seen.append(scores.count()) or real(scores, *a))
    queries = catalog.queries()
    assert queries["m9_rescued"](spark, str(tmp_path)).count() <= 300 and queries["m5_decide_fused"](spark, str(tmp_path)).count() == 300
    assert seen == [9, 9]  # three texts, three themes


def test_a_batch_of_texts_is_mended_piece_by_piece():
    texts = pa.array([f"{'word ' * 200}{i} CafÃ©" for i in range(20_000)] + [None, "", "plain"])
    tracemalloc.start()
    try:
        got = scripts.mended.func(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 5e6  # all texts as Python objects take 20 MB and more
    assert got[7].as_py() == f"{'word ' * 200}7 Café" and got[-3:].to_pylist() == [None, "", "plain"] and len(got) == len(texts)
