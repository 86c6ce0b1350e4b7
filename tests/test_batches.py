"""Themes found batch by batch, against a plain fold from the first batch to the last."""

from collections import Counter

from pyspark.sql import functions as F

from chatloom import catalog
from chatloom.functions.text import clean_english
from chatloom.operators import themes as H
from chatloom.plans.views import chat


def _batch(rows, least, most, least_phrases):
    """rows: (message, text, words)."""
    runs = {m: {" ".join(w[i : i + 2]) for i in range(len(w) - 1)} for m, _, w in rows}
    n = Counter(p for ps in runs.values() for p in ps)
    df = Counter(w for _, _, ws in rows for w in set(ws))
    owner = {p: min((-df[w], w) for w in set(p.split(" ")))[1] for p, c in n.items() if c >= least}
    out = []
    for name in set(owner.values()):
        mine = sorted((-n[p], p) for p in owner if owner[p] == name)
        texts = sorted((m, t) for m, t, _ in rows if any(owner.get(p) == name for p in runs[m]))
        if len(mine) >= least_phrases:
            out.append({"name": name, "phrases": [p for _, p in mine][:12], "examples": list(dict.fromkeys(t for _, t in texts[:4])), "messages": len(texts), "batches": 1})
    return sorted(out, key=lambda t: (-t["messages"], t["name"]))[:most]


def _fold(batches, seeds):
    out = []
    for batch in batches:
        known = {t["name"].lower(): t for t in out if t["name"].lower() not in seeds}
        for t in batch:
            into = known.get(t["name"].lower())
            if into is None:
                out.append(t)
                continue
            seen, phrases = set(), []
            for p in into["phrases"] + t["phrases"]:
                if p.lower().strip() not in seen:
                    seen.add(p.lower().strip())
                    phrases.append(p)
            into |= {"phrases": phrases[:12], "examples": list(dict.fromkeys(into["examples"] + t["examples"]))[:4], "messages": into["messages"] + t["messages"], "batches": into["batches"] + 1}
    return sorted((t["name"], ",".join(t["phrases"]), ",".join(t["examples"]), t["messages"], t["batches"]) for t in out)


def test_query_equals_a_fold_from_left_to_right(spark, monkeypatch):
    sf = "/root/testdata/sf0.01"
    asked = chat(spark, sf).where("actor = 'customer' and text is not null").select((F.col("session") * 100_000 + F.col("pos")).alias("message"), "text", F.split(clean_english(F.col("text")), " ").alias("w"))
    rows = sorted((r.message, r.text, [w for w in r.w if w]) for r in asked.collect())
    batches = [_batch(rows[i : i + 200], 2, 30, 3) for i in range(0, len(rows), 200)]
    want = _fold(batches, {"the"})
    assert len(batches) > 1 and any(t[4] > 1 for t in want)
    assert sorted(tuple(r) for r in catalog.queries()["m11_u2_themes_in_batches"](spark, sf).collect()) == want


def test_many_batches_fold_level_by_level(spark, monkeypatch):
    monkeypatch.setattr(H, "FAN", 3)
    rows = [(b, n, [f"{n} {b % 5}", f"{n.upper()} {b % 7}", "same"], [f"e{b % 6}"], 1) for b in range(40) for n in ("alpha", "Beta" if b % 2 else "beta", "seed")]
    df = spark.createDataFrame(rows, "batch long, name string, phrases array<string>, examples array<string>, messages long")
    got = H.fold_batches(df, ["SEED"])
    plain = [[{"name": n, "phrases": p, "examples": e, "messages": m, "batches": 1} for b, n, p, e, m in rows if b == i] for i in range(40)]
    assert sorted((r.name, ",".join(r.phrases), ",".join(r.examples), r.messages, r.batches) for r in got.collect()) == _fold(plain, {"seed"})
    assert H.fold_batches(df.limit(0)).collect() == []
