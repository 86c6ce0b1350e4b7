"""Repair of text that was decoded twice, and transliteration, over planted damage and whole tables."""

import hashlib

import pytest

from chatloom import catalog
from chatloom.functions import scripts as S

PLAIN = ["", "plain ascii", "Größe, été déjà — “quoted”…", "naïve œuvre Ÿ", "привет мир", "καλημέρα κόσμε", "नमस्ते दुनिया", "日本語のテキスト", "5 € or £3 ½ ™", "emoji 🙂👍", "Spaß“ und „Ä“ à « mot »", "Ærø, Łódź", "a b"]


def wrongly(text, windows):
    """UTF-8 read as Latin-1, or as its Windows extension where that has a sign."""
    out = text.encode().decode("latin-1")
    if not windows:
        return out
    known = {b: c for c, b in S.BYTES.items() if ord(c) > 0xFF}
    return "".join(known.get(ord(c), c) for c in out)


@pytest.mark.parametrize("windows", [False, True])
@pytest.mark.parametrize("times", [1, 2, 3])
def test_damage_is_undone_and_clean_text_stays(windows, times):
    for text in PLAIN:
        assert S.mend(text) == text
        damaged = text
        for _ in range(times):
            damaged = wrongly(damaged, windows)
        if not set(text) & set("Ł“"):  # a single sequence that may as well be a letter before a quote is left alone
            assert S.mend(damaged) == text, (text, damaged)


def test_documents_are_mended_and_else_untouched(spark, sf):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert all(S.mend(t) == t for t in rows.values() if t)
    got = {r.id: (r.mended, r.untouched) for r in catalog.queries()["f8_mended"](spark, sf).collect()}
    md5 = lambda t: None if t is None else hashlib.md5(t.encode()).hexdigest()
    assert got == {i: (md5(t), md5(t)) for i, t in rows.items()}


def test_scripts_in_latin_letters():
    assert S.to_latin("Привет, щука ёж") == "Privet, shchuka iozh"
    assert S.to_latin("Καλημέρα Ψυχή") == "Kalemera Psukhe"
    assert S.to_latin("नमस्ते १२") == "nmste 12"
    assert S.to_latin("Größe Ærø Łódź naïve œuvre") == "Grosse Aero Lodz naive oeuvre"
    assert S.to_latin("plain") == "plain"
