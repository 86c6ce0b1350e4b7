"""Personal data by a semi-Markov conditional random field (operator 7).

Base spans of the four kinds come from fixed patterns, leftmost and non-overlapping for each kind, and always stay. The
field adds spans of kind `secret` (keys, tokens, passwords) and further ip and phone spans written in other ways. Zones, the stretches of
characters such data is written with around digits, @ signs and values that follow a cue such as "password =", are cut into tokens
(runs of letters and digits, else single characters). Each run of up to MAX_TOKENS tokens of a zone that is plausible() is a candidate segment with
whole-span features; a dynamic program over boundaries and types picks the best labelling. A segment is bounded in tokens and blanks (MAX_GAPS) only: it may
have any number of characters. A zone is decoded as one, however long: its candidates are scored BLOCK tokens at a time.

Weights are learned here, by the exact gradient of the log-likelihood over forward-backward sums, from two bounded sets of lessons: at most
REAL_LESSONS zones of a sample of TRAIN_DOCS documents chosen by a hash (at most TRAIN_CHARS characters of each), whose base spans are
the labels, and synthetic lines made from a seed, which teach secrets, other spellings and harmless numbers. Neither set shortens the other.

Patterns are matched in linear time: digits are taken as whole runs, and e-mail matching starts at @ signs.

Defined results: a null text counts as empty; offsets are code points, end exclusive; n_email, n_ip, n_card and n_phone
count base spans, n_secret the secrets and n_found all spans; an empty text has the digest of the empty string and an empty spans string; an added
span never overlaps a base span or another added one; rows that repeat are returned as often; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import random
import re
from array import array
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import documents, slices

KINDS = ("email", "ip", "card", "phone")
ALL_KINDS = (*KINDS, "secret")
MAX_TOKENS, MAX_GAPS, BLOCK = 24, 6, 2048
TRAIN_DOCS, TRAIN_CHARS, REAL_LESSONS, SYNTHETIC_LINES = 400, 4000, 1600, 900
EPOCHS, RATE, DECAY = 6, 0.2, 1e-4

RUN = re.compile(r"[A-Za-z0-9._%+@-]*")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: As [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+): a match that starts within a run of digits can't succeed where the run's start fails.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
RUN_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+@-")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of EMAIL. Each lies within one run of its characters, and only runs with @ can have one."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in RUN_CHARS:
            start -= 1
        end = RUN.match(text, at).end()
        # within a run without @ before it, the leftmost match starts at the run's start or after an earlier @
        pos = start
        while 0 <= at < end:
            m = EMAIL.match(text, pos)
            if m:
                out.append(m.span())
                pos = m.end()
            else:
                pos = at + 1
            at = text.find("@", pos, end)
            if at == pos:
                pos += 1
                at = text.find("@", pos, end)
        at = text.find("@", end)
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the four kinds, by kind and then start."""
    out = [("email", s, e) for s, e in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or "0") < 256 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append(("phone", *m.span()))
    return out


# Zones and tokens -----------------------------------------------------------------------------------------------------

PIECE = r"[A-Za-z0-9._%+@\-()/=:\"'~]"
PIECE_CHARS = RUN_CHARS | frozenset("()/=:\"'~")
#: A zone goes on over single blanks as long as what follows has a digit or @ too.
STRETCH = re.compile(rf"{PIECE}+(?: {PIECE}*[0-9@]{PIECE}*)*")
TOKEN = re.compile(r"[A-Za-z0-9]+|[^A-Za-z0-9]")
SIGNAL = re.compile(r"[0-9@]")
#: A value of letters alone may be a secret if it is this long and a cue stands before it.
LETTERS = 8
VALUE = re.compile(r"[:=][ \t]{0,2}[\"'(]?(?=[A-Za-z]{%d})" % LETTERS)
CUE_WORDS = r"(?:token|key|secret|password|passwd|pwd|passphrase|auth|bearer)"
CUED = re.compile(CUE_WORDS + r"[\"']?[ \t]{0,2}[:=][ \t]{0,2}[\"'(]?$")
CUES = {"secret": ("token", "key", "secret", "pass", "pwd", "api", "auth", "bearer"), "phone": ("tel", "phone", "call", "fax", "mobile"), "card": ("card", "visa", "iban", "account"), "email": ("mail", "email", "contact"), "ip": ("ip", "host", "server", "addr")}
REACH = 24


def signals(text: str) -> Iterator[int]:
    """Places where a zone may start, in order, after each zone's end is sent: digits, @ signs, and values after a cue."""
    values = [m.end() for m in VALUE.finditer(text) if CUED.search(text[max(0, m.end() - REACH) : m.end()].lower())] if ":" in text or "=" in text else []
    pos = k = 0
    m = SIGNAL.search(text)
    while m or k < len(values):
        pos = yield (min(m.start(), values[k]) if m and k < len(values) else m.start() if m else values[k])
        while k < len(values) and values[k] < pos:
            k += 1
        if m and m.start() < pos:
            m = SIGNAL.search(text, pos)


def zones(text: str) -> Iterator[tuple[int, int]]:
    """Starts and ends; between zones nothing can be personal data."""
    pos, found = 0, signals(text)
    at = next(found, None)
    while at is not None:
        start = at
        while start > pos and text[start - 1] in PIECE_CHARS:
            start -= 1
        pos = STRETCH.match(text, start).end()
        yield start, pos
        try:
            at = found.send(pos)
        except StopIteration:
            return


def promising(text: str, start: int, end: int) -> bool:
    """Whether a zone may have a plausible segment: most zones are a number of a few digits."""
    return text.find("@", start, end) >= 0 or sum(map(str.isdigit, text[start:end])) >= 4 or bool(VALUE.search(text, max(0, start - 4), end + LETTERS))


def tokens_of(text: str, stretches: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of the tokens of zones, and for each the first token after its zone."""
    starts = np.fromiter((t.start() for a, b in stretches for t in TOKEN.finditer(text, a, b)), np.int64)
    far = np.array([b for _, b in stretches], np.int64)
    after = np.searchsorted(starts, far)
    ends = np.r_[starts[1:], 0]
    ends[after - 1] = far
    return starts, ends, np.repeat(after, np.diff(np.r_[0, after]))


# Candidate segments and their features ----------------------------------------------------------------------------------

#: What a segment's features are, and how many values each has.
SLOTS = {
    "bias": 1, "digits": 25, "alphas": 11, "length": 16, "first": 131, "last": 131, "dots": 5, "ats": 3, "gaps": 6, "hyphens": 6, "colons": 6, "other": 5, "alone": 8, "hex": 8,
    "luhn": 3, "quad": 3, "address": 2, "left": 131, "right": 131, "cases": 8, "longest": 9, "tokens": 25, "cued": 2, **{f"cue_{k}": 2 for k in CUES},
}
OFFSETS = dict(zip(SLOTS, np.cumsum([0, *SLOTS.values()]).tolist(), strict=False))
N_FEATURES = sum(SLOTS.values())
LETTER, DIGIT, NONE = 128, 129, 130


def _shape(c: str) -> int:
    return DIGIT if c.isdigit() else LETTER if c.isalpha() else 32 if c.isspace() else min(ord(c), 127)


class Candidates:
    """The plausible segments of the zones of a text: first token, end token and the numbers of their features."""

    def __init__(self, text: str, starts: np.ndarray, ends: np.ndarray, stop: np.ndarray):
        self.text, self.starts, self.ends, self.stop = text, starts, ends, stop
        n, spans = len(starts), list(zip(starts.tolist(), ends.tolist(), strict=True))
        word = [text[a:b] for a, b in spans]
        has = np.zeros((n, 10), np.int64)  # digits, letters, dots, ats, gaps, hyphens, colons, others, upper, lower
        place = {".": 2, "@": 3, " ": 4, "-": 5, ":": 6}
        self.hex = np.zeros(n, bool)
        for i, w in enumerate(word):
            if not w.isalnum():
                has[i, place.get(w, 7)] = 1
            else:
                letters = 0 if w.isdecimal() else len(w) if w.isalpha() else sum(map(str.isalpha, w))
                has[i, :2] = len(w) - letters, letters
                has[i, 8:] = letters and not w.islower(), letters and not w.isupper()
                self.hex[i] = bool(re.fullmatch(r"[0-9a-f]+", w))
        self.total = np.concatenate([np.zeros((1, 10), np.int64), np.cumsum(has, 0)])
        self.first = np.array([_shape(text[a]) for a, _ in spans], np.int64)
        self.last = np.array([_shape(text[b - 1]) for _, b in spans], np.int64)
        self.left = np.array([_shape(text[a - 1]) if a else NONE for a, _ in spans], np.int64)
        self.right = np.array([_shape(text[b]) if b < len(text) else NONE for _, b in spans], np.int64)
        self.cue = np.zeros((n, len(CUES)), np.int64)
        self.cued = np.zeros(n, np.int64)
        for i, (a, _) in enumerate(spans):
            before = text[max(0, a - REACH) : a].lower()
            self.cue[i] = [any(c in before for c in cues) for cues in CUES.values()]
            if self.cue[i, 0]:
                self.cued[i] = bool(CUED.search(before))

    def of(self, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """first, end, features of the candidates that start before token high."""
        n = len(self.starts)
        i = np.arange(min(high, n))[:, None]
        j = i + np.arange(1, MAX_TOKENS + 1)[None]
        inside = j <= np.minimum(self.stop[i], n)
        j = np.minimum(j, n)
        longest = np.maximum.accumulate(np.where(inside, (self.ends - self.starts)[j - 1], 0), 1)
        i = np.broadcast_to(i, j.shape)
        ok = self.plausible(i, j) & inside
        i, j, longest = i[ok], j[ok], longest[ok]
        digits, letters, dots, ats, gaps, hyphens, colons, other, upper, lower = (self.total[j] - self.total[i]).T
        size = self.ends[j - 1] - self.starts[i]
        alone = j - i == 1
        x = {
            "bias": 0 * i, "digits": np.minimum(digits, 24), "alphas": np.minimum(letters, 10), "length": np.minimum(size, 60) // 4, "first": self.first[i], "last": self.last[j - 1],
            "dots": np.minimum(dots, 4), "ats": np.minimum(ats, 2), "gaps": np.minimum(gaps, 5), "hyphens": np.minimum(hyphens, 5), "colons": np.minimum(colons, 5), "other": np.minimum(other, 4),
            "alone": np.where(alone & (digits > 0) & (letters > 0), 1 + np.minimum(size, 48) // 8, 0), "hex": np.where(alone & self.hex[i] & (letters > 0), 1 + np.minimum(size, 48) // 8, 0),
            "luhn": 0 * i, "quad": 0 * i, "address": ((ats == 1) & self.dot_after_at(i, j)).astype(int), "left": self.left[i], "right": self.right[j - 1],
            "cases": 4 * (upper > 0) + 2 * (lower > 0) + (digits > 0), "longest": np.minimum(longest, 64) // 8, "tokens": np.minimum(j - i, 24), "cued": self.cued[i], **{f"cue_{k}": self.cue[i, n] for n, k in enumerate(CUES)},
        }
        for k in np.flatnonzero((letters == 0) & (digits > 12) & (digits < 20)).tolist():
            x["luhn"][k] = 1 + luhn("".join(filter(str.isdigit, self.text[self.starts[i[k]] : self.ends[j[k] - 1]])))
        for k in np.flatnonzero((letters == 0) & (dots == 3) & (digits < 13)).tolist():
            x["quad"][k] = 1 + all(p.isdigit() and len(p) < 4 and int(p) < 256 for p in self.text[self.starts[i[k]] : self.ends[j[k] - 1]].split("."))
        return i, j, np.stack([OFFSETS[name] + v for name, v in x.items()], 1).astype(np.int64)

    @cached_property
    def all(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """first, end, features of all candidates."""
        return self.of(len(self.starts))

    def plausible(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Starts with a letter, digit, + or (, ends with a letter, digit or (a long one) =, and has four digits, an @, or a cue before one word of
        at least LETTERS characters; at most MAX_GAPS blanks."""
        begins = (self.first[i] >= LETTER) | np.isin(self.first[i], (43, 40))
        size = self.ends[j - 1] - self.starts[i]
        finishes = (self.last[j - 1] >= LETTER) | ((self.last[j - 1] == 61) & (size >= 16))
        has = self.total[j] - self.total[i]
        return begins & finishes & (has[..., 4] <= MAX_GAPS) & ((has[..., 3] > 0) | (has[..., 0] >= 4) | ((self.cued[i] > 0) & (size >= LETTERS) & (has[..., 4] == 0)))

    def dot_after_at(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether a dot follows the last @ before token j."""
        at = self.total[1:, 3] - self.total[:-1, 3] > 0
        dots = np.concatenate([[0], np.maximum.accumulate(np.where(at, self.total[1:, 2], 0))])  # dots up to the last @ (none within if there is no @)
        return self.total[j, 2] > dots[j]


class Field:
    """The model: a weight for each feature and kind; label 0 is no entity, over a single token, with score 0."""

    def __init__(self, weights: np.ndarray | None = None):
        self.weights = np.zeros((N_FEATURES, len(ALL_KINDS))) if weights is None else weights

    def decode(self, text: str, stretches: list[tuple[int, int]]) -> list[tuple[str, int, int]]:
        """The best labelling's entities in zones, in order. Candidates of BLOCK tokens are held at a time."""
        starts, ends, stop = tokens_of(text, stretches)
        n = len(starts)
        best, back, kinds = array("d", [-np.inf]) * (n + 1), array("q", [-1]) * (n + 1), array("b", [0]) * (n + 1)
        best[0] = 0.0
        for low in range(0, n, BLOCK):
            high, seen = min(low + BLOCK, n), slice(low, low + BLOCK + MAX_TOKENS)
            first, end, x = Candidates(text, starts[seen], ends[seen], stop[seen] - low).of(high - low)
            v = self.weights[x].sum(1)
            value, kind, end = v.max(1).tolist(), v.argmax(1).tolist(), (end + low).tolist()
            bounds = np.searchsorted(first, np.arange(high - low + 1)).tolist()
            for i in range(low, high):
                for k in range(bounds[i - low], bounds[i - low + 1]):
                    if value[k] > 0 and best[i] + value[k] > best[end[k]]:
                        best[end[k]], back[end[k]], kinds[end[k]] = best[i] + value[k], i, kind[k]
                if best[i] >= best[i + 1]:
                    best[i + 1], back[i + 1] = best[i], -1
        out, j = [], n
        while j:
            if back[j] >= 0:
                out.append((ALL_KINDS[kinds[j]], int(starts[back[j]]), int(ends[j - 1])))
                j = back[j]
            else:
                j -= 1
        return out[::-1]

    def gradient(self, c: Candidates, gold: set[tuple[str, int, int]]) -> tuple[float, np.ndarray, np.ndarray]:
        """Log-likelihood of the gold segments, the candidates' features, and its derivative by each candidate's score for each kind."""
        n = len(c.starts)
        first, end, x = c.all
        v = self.weights[x].sum(1)
        total = np.logaddexp.reduce(v, axis=1) if len(v) else np.zeros(0)
        ahead, behind = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
        ahead[0] = behind[n] = 0
        starts = np.searchsorted(first, np.arange(n + 1))
        for i in range(n):
            ahead[i + 1] = np.logaddexp(ahead[i + 1], ahead[i])
            s = slice(starts[i], starts[i + 1])
            ahead[end[s]] = np.logaddexp(ahead[end[s]], ahead[i] + total[s])  # one candidate an end
        for i in range(n - 1, -1, -1):
            s = slice(starts[i], starts[i + 1])
            behind[i] = np.logaddexp.reduce([behind[i + 1], *(behind[end[s]] + total[s])])
        d = -np.exp(np.minimum(ahead[first][:, None] + v + behind[end][:, None] - ahead[n], 0)) if len(v) else np.zeros((0, len(ALL_KINDS)))
        reached = 0.0
        where = {(int(c.starts[i]), int(c.ends[j - 1])): k for k, (i, j) in enumerate(zip(first.tolist(), end.tolist(), strict=True))}
        for kind, s, e in gold:
            k = where[s, e]
            d[k, ALL_KINDS.index(kind)] += 1
            reached += v[k, ALL_KINDS.index(kind)]
        return float(reached - ahead[n]), x, d

    def learn(self, c: Candidates, gold: set[tuple[str, int, int]], rate: float) -> None:
        """One step along the gradient of the log-likelihood of the gold segments."""
        _, x, d = self.gradient(c, gold)
        some = np.flatnonzero(np.abs(d).max(1) > 1e-4) if len(d) else ()
        if len(some):
            used = np.unique(x[some])
            self.weights[used] *= 1 - rate * DECAY
            np.add.at(self.weights, x[some].ravel(), rate * np.repeat(d[some], x.shape[1], 0))


# Learning -------------------------------------------------------------------------------------------------------------


def synthetic(seed: int = 7, lines: int = SYNTHETIC_LINES) -> list[tuple[str, set[tuple[str, int, int]]]]:
    """Lines with one entity each in spellings that the base patterns miss, and lines with harmless numbers and words."""
    rng = random.Random(seed)
    some = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    digit = lambda n: some("0123456789", n)
    word = lambda: some("aeinorst", rng.randint(2, 8))
    lower, hexa = "abcdefghijklmnopqrstuvwxyz", "0123456789abcdef"
    mixed = lower + lower.upper() + "0123456789"

    def failed_card() -> str:
        while luhn(d := digit(16)):
            pass
        return rng.choice((d, " ".join(d[i : i + 4] for i in range(0, 16, 4)), "-".join(d[i : i + 4] for i in range(0, 16, 4))))

    def secret() -> tuple[str, str]:
        cue = rng.choice(("token", "key", "api_key", "secret", "password", "Auth", "access token", "passwd"))
        left = cue + rng.choice((' = "', ': "', '="', ": ", "=", " = "))
        made = rng.randrange(6)
        if made == 0:
            return left, some(hexa, rng.choice((32, 40, 64, 128, 200)))
        if made == 1:
            return left, some(mixed, rng.randint(20, 90))
        if made == 2:
            return left, some(lower + lower.upper() if rng.random() < 0.3 else lower, rng.randint(16, 44))
        if made == 3:
            return left, rng.choice(("sk-", "pk_live_", "ghx_")) + some(mixed, rng.randint(20, 40))
        if made == 4:
            return left, ".".join(some(mixed, rng.randint(16, 60)) for _ in range(3))
        return rng.choice((left, "secret ", "commit ", "")), some(hexa, rng.choice((40, 64)))

    def phone() -> tuple[str, str]:
        s = rng.choice(("00" + digit(2) + " " + digit(3) + " " + digit(6), "(" + digit(3) + ") " + digit(3) + "-" + digit(4)))
        return rng.choice(("tel ", "call ", "phone: ", "", "fax ")), s

    def address() -> tuple[str, str]:
        return rng.choice(("host ", "from ", "ip ", "")), ":".join(some(hexa, 4) for _ in range(8))

    def harmless() -> tuple[str, str]:
        s = rng.choice((
            digit(4), "v" + digit(1) + "." + digit(2), digit(2) + "." + digit(2) + "." + digit(4), digit(3) + " " + word(), digit(6), digit(rng.randint(7, 12)), failed_card(), failed_card(),
            f"{rng.randint(1900, 2099)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}", f"{rng.randint(10, 23)}:{rng.randint(10, 59)}:{rng.randint(10, 59)}", ".".join(word()[:1] + digit(1) for _ in range(rng.randint(3, 14))) + rng.choice(("", ".")),
            ".".join(digit(1) for _ in range(rng.randint(2, 6))), f"{digit(3)}-{digit(1)}-{digit(2)}-{digit(6)}-{digit(1)}", f"http://{word()}.org/{word()}{digit(2)}/{digit(4)}", " ".join(digit(rng.randint(1, 4)) for _ in range(rng.randint(3, 12))),
            word() + digit(4), "-".join(digit(rng.randint(1, 3)) for _ in range(4)),
        ))
        return rng.choice(("in ", "page ", "see ", "", "no. ", "(")), s

    def label() -> tuple[str, str]:
        return rng.choice(("key: ", "key = ", "token: ", "Auth: ")), some(lower, rng.randint(LETTERS, 12))

    out = []
    for k in range(lines):
        kind, made = (("secret", secret), ("phone", phone), (None, harmless), ("secret", secret), (None, harmless), (None, harmless), (None, label) if k % 20 < 10 else ("ip", address), (None, harmless))[k % 8]
        left, s = made()
        left = f"{word()} {word()} {left}" if rng.random() < 0.9 else left
        text = f"{left}{s}{rng.choice((' ', chr(34) + ' ', '. ', ', ', ' '))}{word()}"
        out.append((text, {(kind, len(left), len(left) + len(s))} if kind else set()))
    return out


def lesson(text: str, zone: tuple[int, int], spans: set[tuple[str, int, int]], labelled: bool) -> tuple[Candidates, set[tuple[str, int, int]]] | None:
    """A zone's candidates and gold segments, cut out of the text with what stands around it; None if the zone can't teach: a span isn't a
    candidate, or, where secrets aren't labelled, it may hold one."""
    inside: list[tuple[str, int, int]] = []
    for kind, s, e in sorted(spans, key=lambda x: (x[1] - x[2], x)):
        if s < zone[1] and e > zone[0] and all(e <= a or s >= b for _, a, b in inside):  # of overlapping spans the longest
            inside.append((kind, s, e))
    o = max(0, zone[0] - REACH - 8)
    text = text[o : zone[1] + 2]
    c = Candidates(text, *tokens_of(text, [(zone[0] - o, zone[1] - o)]))
    for a, b in zip(c.starts.tolist(), c.ends.tolist(), strict=True):
        if not labelled and b - a >= 16 and not text[a:b].isdigit() and not any(s - o <= a and b <= e - o for _, s, e in inside):
            return None
    first, end, _ = c.all
    known = set(zip(c.starts[first].tolist(), c.ends[end - 1].tolist(), strict=True))
    gold = {(k, s - o, e - o) for k, s, e in inside}
    return (c, gold) if all((s, e) in known for _, s, e in gold) else None


def lessons(texts: list[str], real: int = REAL_LESSONS) -> list[tuple[Candidates, set[tuple[str, int, int]]]]:
    """At most `real` zones of texts, spread over all of them, and all zones of the synthetic lines."""
    rng, seen = random.Random(1), []
    for text in texts:
        spans = set(base_spans(text))
        seen += [(text, z, spans) for z in zones(text)]
    rng.shuffle(seen)
    found = [x for text, z, spans in seen[: 2 * real] if (x := lesson(text, z, spans, False))][:real]
    return found + [x for text, gold in synthetic() for z in zones(text) if (x := lesson(text, z, gold, True))]


def train(texts: list[str], epochs: int = EPOCHS) -> Field:
    """Learn from base spans of texts, and from synthetic lines."""
    all_lessons = lessons(texts)
    rng, field = random.Random(1), Field()
    for epoch in range(epochs):
        rng.shuffle(all_lessons)
        for c, gold in all_lessons:
            field.learn(c, gold, RATE / (1 + 0.3 * epoch))
    return field


# Finding --------------------------------------------------------------------------------------------------------------


def find(text: str, field: Field) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and all spans by kind and start."""
    base = base_spans(text)
    taken = sorted((s, e) for _, s, e in base)
    stretches = [z for z in zones(text) if promising(text, *z)]
    added, k, covered = [], 0, 0
    for kind, s, e in field.decode(text, stretches) if stretches else ():
        while k < len(taken) and taken[k][0] < e:
            covered = max(covered, taken[k][1])  # the furthest end of base spans that start before e
            k += 1
        if covered <= s:
            added.append((kind, s, e))
    order = {k: i for i, k in enumerate(ALL_KINDS)}
    return base, sorted({*base, *added}, key=lambda x: (order[x[0]], x[1], x[2]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def learn(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> Field:
    """From a sample of about train_docs different documents that have digits or @, never more than twice as many; of each at most
    TRAIN_CHARS characters from its first digit or @ on."""
    rows = documents(docs).where(F.col("text").rlike("[0-9@]")).withColumn("h", F.xxhash64("doc_id", "text"))
    n = rows.count()
    if not n:
        return train([])
    chosen = rows.where(F.pmod("h", F.lit(1_000_003)) <= int(1_000_003 * train_docs / n))
    cut = chosen.select("h", F.substring(F.regexp_extract("text", r"(?s).{0,60}[0-9@].*", 0), 1, TRAIN_CHARS).alias("t"))
    texts = cut.dropDuplicates(["h"]).orderBy("h").limit(2 * train_docs).collect()
    return train([t for _, t in sorted(texts)])


def find_personal_data(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base and all spans (arrays of kind, start, end) for each of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(field or learn(docs))  # N_FEATURES x 5 numbers
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in slices(batches, 4_000_000):
            found = [find(t, shared.value) for t in texts]
            counts = [pa.array([sum(x[0] == k for x in base) for base, _ in found], pa.int64()) for k in KINDS]
            columns = [pa.array([[dict(zip(("kind", "start", "end"), x, strict=True)) for x in f[i]] for f in found], span) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([ids, *counts, *columns], ["doc_id", *(f"n_{k}" for k in KINDS), "base", "found"])

    kind = "array<struct<kind string, start long, end long>>"
    return documents(docs).mapInArrow(run, f"doc_id long, n_email long, n_ip long, n_card long, n_phone long, base {kind}, found {kind}")


def digest(found: DataFrame) -> DataFrame:
    """The spans as one string, and the digest of the base spans' string."""
    text = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    secrets = F.size(F.filter("found", lambda x: x["kind"] == "secret")).cast("long")
    return found.select("doc_id", *(f"n_{k}" for k in KINDS), F.sha2(text(F.col("base")), 256).alias("base_sha256"), text(F.col("found")).alias("spans"), secrets.alias("n_secret"), F.size("found").cast("long").alias("n_found"))


def base_sha256(text: str) -> str:
    return hashlib.sha256(joined(base_spans(text)).encode()).hexdigest()
