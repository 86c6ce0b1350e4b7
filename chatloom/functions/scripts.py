"""Text that was decoded twice, and other scripts in Latin letters: Arrow functions over whole columns."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Times that a text may have been decoded wrongly; texts of an Arrow batch that are Python objects at a time.
ROUNDS, PIECE = 3, 128


def _bytes_of_signs() -> dict[str, int]:
    """The byte that each sign stands for when UTF-8 was read as Latin-1 or as its Windows extension."""
    out = {chr(b): b for b in range(0x80, 0x100)}
    for b in range(0x80, 0xA0):
        try:
            out[bytes([b]).decode("cp1252")] = b
        except UnicodeDecodeError:
            continue  # bytes that the extension leaves open stay control signs
    return out


BYTES = _bytes_of_signs()
_next = "[" + "".join(re.escape(c) for c, b in BYTES.items() if b < 0xC0) + "]"
_lead = lambda low, high: "[" + "".join(chr(b) for b in range(low, high + 1)) + "]"
SEQUENCE = f"(?:{_lead(0xC2, 0xDF)}{_next}|{_lead(0xE0, 0xEF)}{_next}{{2}}|{_lead(0xF0, 0xF4)}{_next}{{3}})"
_damage = re.compile(f"{SEQUENCE}+")
#: What a single wrong sequence of two signs may stand for besides U+0080 to U+00FF. Others are more often a letter before a closing quote.
SINGLES = "ŒœŠšŸŽž"
#: Blocks that wrong sequences may stand for.
BLOCKS = [(0x80, 0x24F), (0x2C6, 0x2DD), (0x370, 0x52F), (0x590, 0x6FF), (0x900, 0xDFF), (0xE00, 0xEFF), (0x1E00, 0x1FFF), (0x2000, 0x2BFF), (0x3000, 0xD7FF), (0xF900, 0xFFFD), (0x1F000, 0x1FAFF)]


def _mended(m: re.Match) -> str:
    run = m.group()
    try:
        text = bytes(BYTES[c] for c in run).decode("utf-8")
    except UnicodeDecodeError:
        return run
    if not all(any(a <= ord(c) <= b for a, b in BLOCKS) for c in text):
        return run
    if len(run) == 2 and ord(text) > 0xFF and text not in SINGLES:
        return run
    return text


def mend(text: str) -> str:
    """text with what was decoded twice or more put right; every accepted step shortens it."""
    for _ in range(ROUNDS):
        new = _damage.sub(_mended, text)
        if new == text:
            break
        text = new
    return text


def _piecewise(texts: pa.Array, change: Callable[[str], str]) -> pa.Array:
    """change of each text that isn't ASCII alone; PIECE of them are Python objects at a time. Null stays null."""
    one = lambda t: t if t is None or t.isascii() else change(t)
    pieces = [pa.array([one(t) for t in texts.slice(i, PIECE).to_pylist()], pa.large_string()) for i in range(0, len(texts), PIECE)]
    return pa.concat_arrays(pieces).cast(pa.string()) if pieces else pa.array([], pa.string())


@F.arrow_udf(StringType())
def mended(texts: pa.Array) -> pa.Array:
    """See mend; null stays null."""
    return _piecewise(texts, mend)


#: Letters of Cyrillic, Greek and Devanagari and special Latin ones in plain Latin letters.
CYRILLIC = dict(zip("абвгдежзийклмнопрстуфхцчшщъыьэюяёђєіїјљњћќўџґ", "a b v g d e zh z i i k l m n o p r s t u f kh ts ch sh shch ' y ' e iu ia io dj ie i yi j lj nj tsh kj u dzh g".split(" "), strict=True))
GREEK = dict(zip("αβγδεζηθικλμνξοπρςστυφχψω", "a b g d e z e th i k l m n x o p r s s t u ph kh ps o".split(" "), strict=True))
DEVANAGARI = dict(zip("कखगघङचछजझञटठडढणतथदधनपफबभमयरलळवशषसह", "k kh g gh ng c ch j jh ny tt tth dd ddh nn t th d dh n p ph b bh m y r l ll v sh ss s h".split(" "), strict=True))
DEVANAGARI |= dict(zip("अआइईउऊऋएऐओऔािीुूृेैोौंःँ्", "a aa i ii u uu R e ai o au aa i ii u uu R e ai o au N H N ".split(" "), strict=True))
DEVANAGARI |= {chr(0x966 + i): str(i) for i in range(10)}
LATIN = {"ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "đ": "d", "ð": "d", "þ": "th", "ł": "l", "ı": "i"}
TABLE = CYRILLIC | GREEK | DEVANAGARI | LATIN
TABLE |= {k.upper(): v.capitalize() for k, v in TABLE.items() if len(k.upper()) == 1 and k.upper() not in TABLE}
_table = str.maketrans(TABLE)


def to_latin(text: str) -> str:
    """Letters of TABLE spelt in Latin ones, of all others the marks taken away."""
    text = unicodedata.normalize("NFC", text).translate(_table)
    bare = "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c))
    return unicodedata.normalize("NFC", bare).translate(_table)  # letters that had a mark


@F.arrow_udf(StringType())
def transliterated(texts: pa.Array) -> pa.Array:
    """See to_latin; null stays null."""
    return _piecewise(texts, to_latin)
