import itertools
import random
import re

import regex

from chatloom.llm.chat import reply_ordered


def test_quotes_are_linked_and_removed(spark):
    a, b = "The first question?\nWith a second line.", "An answer, given here."
    rows = [
        (1, 0, "user", a, "x"),
        (1, 1, "assistant", "> The first question?\n> With a second line.\nAn answer, given here.", "x"),
        (1, 2, "user", "Anna wrote:\n> > the FIRST question\n> An answer, given here.\nThanks", "x"),
        (1, 3, "user", "> with a second line\nAlso this", "x"),
        (1, 4, "user", "> nobody said this\nAlone", "x"),
        (2, 0, "user", "> An answer, given here.\nOther conversation", "x"),
        (2, 1, None, None, "x"), (None, 1, "user", "> q\nrest", "x"), (3, None, "user", "", "x"), (1, 0, "user", a, "x"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, level string")
    got = {(r.conv_id, r.turn): r for r in reply_ordered(df).collect()}
    assert reply_ordered(df).count() == len(rows)
    assert [got[1, t].parent for t in range(5)] == [None, 0, 1, 0, None]
    assert [got[1, t].thread for t in range(5)] == [0, 0, 0, 0, 4]
    assert [got[1, t].depth for t in range(5)] == [0, 1, 2, 1, 0]
    assert got[1, 1].text == b and got[1, 2].text == "Thanks" and got[1, 0].text == a
    assert got[1, 2].max_level == 2 and got[1, 2].n_quoted_lines == 2
    assert got[2, 0].parent is None and got[2, 1].role == "unknown" and got[2, 1].text == ""
    assert got[None, 1].text == "rest" and got[1, 1].formatted == f"<|assistant|>\n{b}\n"
    assert reply_ordered(df.limit(0)).collect() == []


def _norm(t):
    return regex.sub(r"[^\p{L}\p{N}]+", " ", t.lower()).strip(" ")


def _brute(rows):
    mark = re.compile(r"^[ \t]*>[ \t>]*")
    parsed = []
    for conv, turn, _, text in rows:
        raw = re.split(r"\r?\n", text or "")
        quoted = [bool(mark.match(x)) for x in raw]
        own = [x for i, x in enumerate(raw) if not quoted[i] and not (re.search(r"wrote:[ \t]*$", x) and i + 1 < len(raw) and quoted[i + 1])]
        lines = [(mark.match(x)[0].count(">") if q else 0, mark.sub("", x)) for x, q in zip(raw, quoted, strict=True)]
        parsed.append((conv, turn, "\n".join(own).strip(" "), own, lines))
    written = {}
    for conv, turn, own, own_lines, _ in parsed:
        for t in {_norm(own), *map(_norm, own_lines)} - {""}:
            if conv is not None and turn is not None:
                written[conv, t] = min(turn, written.get((conv, t), turn))
    chars = {}
    for conv, turn, _, _, lines in parsed:
        if conv is None or turn is None:
            continue
        asked = [(n, b) for n, b in lines if n]
        asked += [(n, " ".join(b for _, b in g)) for n, g in itertools.groupby(lines, key=lambda x: x[0]) if n]
        for n, b in asked:
            source = written.get((conv, _norm(b)))
            if _norm(b) and source is not None and source < turn:
                chars[conv, turn, n, source] = chars.get((conv, turn, n, source), 0) + len(_norm(b))
    parent = {}
    for (conv, turn, n, source), size in chars.items():
        parent[conv, turn] = min(parent.get((conv, turn), (99, 0, 0)), (n, -size, -source))
    out = []
    for conv, turn, own, _, lines in parsed:
        at, depth = turn, 0
        while (conv, at) in parent:
            at, depth = -parent[conv, at][2], depth + 1
        mine = parent.get((conv, turn))
        levels = [n for n, _ in lines]
        out.append((conv, turn, own, -mine[2] if mine else None, at, depth, sum(n > 0 for n in levels), max(levels)))
    return sorted(out, key=repr)


def test_conversations_match_brute_force(spark):
    rng = random.Random(7)
    said = ["Yes, do it.", "no", "What about Ünïts?", "the same line", "A longer line that says more than others do", "?!", "wrote:", "x wrote: "]
    rows = []
    for conv in range(25):
        texts = []
        for turn in range(rng.randint(1, 40)):
            lines = []
            for _ in range(rng.randint(0, 5)):
                k = rng.random()
                if k < 0.5 and texts:
                    old = rng.choice(texts).split("\n")
                    lines += [f"{'> ' * rng.randint(1, 3)}{x.upper() if rng.random() < 0.3 else x}" for x in old[: rng.randint(1, 3)]]
                else:
                    lines.append(rng.choice(said))
            texts.append("\n".join(lines))
            rows.append((conv, turn, "user", texts[-1] if rng.random() < 0.97 else None))
    rows += [(50, t, "user", f"> {'deep ' + str(t - 1)}\ndeep {t}" if t else "deep 0") for t in range(70)]  # a thread as deep as long
    rows += [(51, 0, "user", "hot line"), *((51, t, "user", f"> hot line\nanswer {t}") for t in range(1, 1500)), (51, 5, "user", "> hot line\nagain")]
    rows += [(52, 0, "user", "word " * 60_000), (52, 1, "user", "> " + "word " * 60_000 + "\nshort"), (None, 0, "user", "> q"), (53, None, "user", "> q\nz"), (rows[0][0], rows[0][1], "ai", rows[0][3])]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    got = reply_ordered(df).collect()
    assert sorted(((r.conv_id, r.turn, r.text, r.parent, r.thread, r.depth, r.n_quoted_lines, r.max_level) for r in got), key=repr) == _brute(rows)
    assert max(r.depth for r in got) == 69 and sum(r.parent is not None for r in got) > 1700
