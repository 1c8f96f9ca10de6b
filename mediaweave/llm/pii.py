"""Personal data: base patterns, and further spans from a semi-Markov conditional random field.

The field scores whole candidate segments (a segment's shape, length, checksum and the words around it), and dynamic
programming over segments of at most MAX_TOKENS tokens jointly chooses boundaries and types. Types of the base patterns take part, so that a
card number's digits compete with a social security number's, but spans of theirs come from the base patterns alone.

The programme runs over all tokens of every text. Segments never cross a line's end, so lines are independent; and a segment
of score 0 or less is in no best segmentation, so a line without a positive segment of an added type has no span to report
and needs no posterior. Both are exact. Tokens and their classes come from tables over code points, many texts at once. Scores of all segments of a length are computed at once; a start is left out as soon as the largest
weights that its line allows cannot raise any of its longer segments above 0.
"""

from __future__ import annotations

import math
import random
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._common import blocks, id_text
from ._spans import PERSONAL, base_spans, digest, joined, luhn, merged
from ._words import _BASE, _BASE_INVERSE, U, mix, powers

#: Most tokens of an entity: an account number has 34 characters, and each may be a token of its own.
MAX_TOKENS = 34
#: Most tokens of a segment whose sequence of shapes is a feature.
SHAPED = 12
#: Segment starts that are scored at once, and characters that are cut into tokens at once (or one text); they bound memory.
STARTS = 1 << 16
CHARACTERS = 1 << 18
#: Least posterior probability of a segment that is reported: more likely than all else together.
CERTAIN = 0.5
ADDED = ("ssn", "iban", "person", "street", "local_phone", "masked_email")
TYPES = (*PERSONAL, *ADDED)
KINDS = [*PERSONAL, *ADDED]
_ADDED = slice(len(PERSONAL), None)

_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|[^\s]")
#: Forms that are features of a segment; they score and do not decide.
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_MASK = re.compile(r"[\w.+-]+ ?[(\[]at[)\]] ?[\w-]+(?: ?[(\[]dot[)\]] ?[\w-]+|\.[\w-]+)*(?!\w)", re.IGNORECASE)
_ROADS = {"street", "road", "avenue", "lane", "drive", "boulevard"}
_CUE_WORDS = {"name", "is", "mr", "mrs", "ms", "dr", "signed", "by", "contact", "ssn", "social", "security", "iban", "account", "call", "phone", "tel", "card", "email", "mail", "address", "lives", "at", "version", "order", "price", "invoice", "page", "year"}


def tokens(text: str, start: int, end: int) -> list[tuple[int, int, str]]:
    return [(m.start(), m.end(), m.group()) for m in _TOKEN.finditer(text, start, end)]


def _shape(t: str) -> str:
    if t.isdigit():
        return f"9{min(len(t), 5)}"
    if t.isalpha():
        return "Aa" if t[0].isupper() and t[1:].islower() else "AA" if t.isupper() else "aa" if t.islower() else "aA"
    return t


def _ends(form: re.Pattern, text: str, start: int, end: int) -> bool:
    m = form.match(text, start)
    return bool(m) and m.end() == end


def features(toks: list[tuple[int, int, str]], i: int, j: int, text: str) -> list[str]:
    """Of the whole segment toks[i:j], without its type."""
    part = toks[i:j]
    shapes = [_shape(t) for _, _, t in part]
    surface = text[part[0][0] : part[-1][1]]
    tight = surface.count(" ")
    digits = sum(c.isdigit() for c in surface)
    before = toks[i - 1][2].lower() if i else "^"
    before2 = toks[i - 2][2].lower() if i > 1 else "^"
    after = _shape(toks[j][2]) if j < len(toks) else "$"
    out = ["1", f"n{j - i}", f"d{min(digits, 24)}", f"sp{min(tight, 6)}", f"f{shapes[0]}", f"l{shapes[-1]}", f"a{after}"]
    out.append("b" + (before if before in _CUE_WORDS or not before.isalnum() else _shape(before)))
    out.append("bb" + (before2 if before2 in _CUE_WORDS or not before2.isalnum() else "w"))
    if j - i <= SHAPED:
        out.append("s" + " ".join(shapes))
    words = [t.lower() for _, _, t in part]
    if any(w in _ROADS for w in words):
        out.append("road" + str(words[-1] in _ROADS))
    if "at" in words and ("(" in words or "[" in words):
        out.append("masked" + str(words.count("at")))
        if m := _MASK.match(text, part[0][0]):
            out.append(f"mask{m.end() == part[-1][1]}")
    if digits >= 12:
        out.append(f"luhn{luhn(re.sub('[^0-9]', '', surface))}")
    if all(s == "Aa" for s in shapes):
        out.append(f"names{len(shapes)}")
    if _IBAN.fullmatch(surface):
        out.append(f"iban{_ends(_IBAN, text, part[0][0], part[-1][1])}")
    if "@" in words:
        out.append("@")
    return out


class SemiMarkov:
    """weights: type -> feature -> weight. Label "" is a single token outside of spans, with score 0."""

    def __init__(self, weights: dict[str, dict[str, float]] | None = None):
        self.weights = weights or {t: {} for t in TYPES}

    def segments(self, toks, text):
        """(i, j, features) of every segment of at most MAX_TOKENS tokens that does not cross a line's end."""
        for i in range(len(toks)):
            for j in range(i + 1, min(len(toks), i + MAX_TOKENS) + 1):
                if j > i + 1 and "\n" in text[toks[j - 2][1] : toks[j - 1][0]]:
                    break
                yield i, j, features(toks, i, j, text)

    def scores(self, toks, text):
        out = []
        for i, j, fs in self.segments(toks, text):
            for t in TYPES:
                w = self.weights[t]
                out.append((i, j, t, sum(w.get(f, 0.0) for f in fs), fs))
        return out

    def marginals(self, toks, text):
        """Log partition, and each candidate segment with its posterior probability."""
        n, scored = len(toks), self.scores(toks, text)
        ends, starts = defaultdict(list), defaultdict(list)
        for s in scored:
            ends[s[1]].append(s)
            starts[s[0]].append(s)
        ahead, back = [0.0] * (n + 1), [0.0] * (n + 1)
        for j in range(1, n + 1):
            ahead[j] = _sum([ahead[j - 1], *(ahead[i] + x for i, _, _, x, _ in ends[j])])
        for i in range(n - 1, -1, -1):
            back[i] = _sum([back[i + 1], *(back[j] + x for _, j, _, x, _ in starts[i])])
        return ahead[n], [(i, j, t, math.exp(min(0.0, ahead[i] + x + back[j] - ahead[n])), fs) for i, j, t, x, fs in scored]

    def best(self, toks, text):
        """The best segmentation: its spans as (i, j, type)."""
        n, ends = len(toks), defaultdict(list)
        for s in self.scores(toks, text):
            ends[s[1]].append(s)
        top, back = [0.0] * (n + 1), [None] * (n + 1)
        for j in range(1, n + 1):
            top[j] = top[j - 1]
            for i, _, t, x, _ in ends[j]:
                if top[i] + x > top[j]:
                    top[j], back[j] = top[i] + x, (i, t)
        out, j = [], n
        while j:
            if back[j]:
                i, t = back[j]
                out.append((i, j, t))
                j = i
            else:
                j -= 1
        return out[::-1]

    def _case(self, text, gold, ids):
        """A case as arrays: its segments, the wanted ones, and its features with the segments that have each."""
        toks = tokens(text, 0, len(text))
        spans = {(b, e): TYPES.index(t) for b, e, t in gold}
        segs = list(self.segments(toks, text))
        want = np.zeros((len(segs), len(TYPES)))
        pairs = []
        for k, (i, j, fs) in enumerate(segs):
            if (t := spans.get((toks[i][0], toks[j - 1][1]))) is not None:
                want[k, t] = 1.0
            pairs += [(ids.setdefault(f, len(ids)), k) for f in fs]
        pairs = np.array(sorted(pairs))
        used, first = np.unique(pairs[:, 0], return_index=True)
        return len(toks), np.array([i for i, _, _ in segs]), np.array([j for _, j, _ in segs]), want, used, pairs[:, 1], first

    def fit(self, cases, epochs: int = 6, rate: float = 0.3, decay: float = 1e-3):
        """Maximises the conditional likelihood of the cases' segmentations, by adaptive gradient steps."""
        ids: dict[str, int] = {}
        made = [self._case(text, gold, ids) for text, gold in cases]
        w = np.zeros((len(ids), len(TYPES)))
        square = np.full(w.shape, 1e-6)
        order = random.Random(7)
        for _ in range(epochs):
            order.shuffle(made)
            for n, at, ends, want, used, segment, first in made:
                own = w[used]
                x = np.zeros(want.shape)
                np.add.at(x, segment, np.repeat(own, np.diff(np.append(first, len(segment))), axis=0))
                ahead, back = _passes(n, at, ends, np.logaddexp.reduce(x, axis=1))
                g = want - np.exp(np.minimum(0.0, (ahead[at] + back[ends] - ahead[n])[:, None] + x))
                slope = np.add.reduceat(g[segment], first, axis=0) - decay * own
                square[used] += slope * slope
                w[used] += rate * slope / np.sqrt(square[used])
        self.weights = {t: {f: float(w[i, k]) for f, i in ids.items() if w[i, k]} for k, t in enumerate(TYPES)}
        return self


def _sum(xs: list[float]) -> float:
    top = max(xs)
    return top + math.log(sum(math.exp(x - top) for x in xs))


def training_cases(n: int = 1000, seed: int = 3) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """Invented sentences with marked spans, and sentences with numbers and names that are none."""
    r = random.Random(seed)
    d = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    syllables = "ba de li mo nu ra se ti vo ka len mar tin son ber gel".split()
    low = lambda: "".join(r.choice(syllables) for _ in range(r.randint(1, 3)))
    cap = lambda: low().capitalize()
    some = lambda a, b, f: " ".join(f() for _ in range(r.randint(a, b)))

    def card():
        body = d(15)
        return next(body + c for c in "0123456789" if luhn(body + c))

    def iban():
        head = r.choice(["DE", "FR", "GB", "ES", "NL", "MT", "IT"]) + d(2)
        body = r.choice([d(18), d(16), "".join(r.choice("ABCDEFGHKLMT") for _ in range(4)) + d(r.randint(14, 20)), "".join(r.choice("ABCDKLMT") if r.random() < 0.3 else d(1) for _ in range(r.randint(16, 27)))])
        return head + (body if r.random() < 0.5 else "".join(" " + body[k : k + 4] for k in range(0, len(body), 4)))

    def masked():
        at, dot = r.choice([("(at)", "(dot)"), ("[at]", "[dot]"), ("(AT)", "(DOT)")])
        gap = r.choice(["", " "])
        stop = r.choice([f" {dot} ", f"{dot}", "."])
        return low() + r.choice(["", "", "." + low(), "_" + low(), d(2)]) + gap + at + gap + low() + r.choice(["", "", stop + low()]) + stop + r.choice(["com", "org", "net"])

    make = {
        "ssn": lambda: r.choice([f"{d(3)}-{d(2)}-{d(4)}", f"{d(3)} {d(2)} {d(4)}"]),
        "iban": iban,
        "person": lambda: some(2, 3, cap),
        "street": lambda: f"{d(r.randint(1, 4))} {some(1, 3, cap)} {r.choice(['Street', 'Road', 'Avenue', 'Lane', 'Drive', 'Boulevard'])}",
        "local_phone": lambda: r.choice([f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}"]),
        "masked_email": masked,
        "email": lambda: f"{low()}.{low()}@{low()}.com",
        "ip": lambda: ".".join(str(r.randint(1, 255)) for _ in range(4)),
        "card": card,
        "phone": lambda: f"+{r.randint(1, 99)} ({d(3)}) {d(3)}-{d(4)}",
    }
    lead = {
        "ssn": ["ssn", "SSN", "social security"], "iban": ["iban", "IBAN", "account", ""], "person": ["my name is", "name:", "Mr.", "Dr.", "Mrs.", "signed by"], "street": ["lives at", "address:", "at", ""],
        "local_phone": ["call", "phone", "tel"], "masked_email": ["mail", "contact", ""], "email": ["email", "", ""], "ip": ["", low()], "card": ["card", "", ""], "phone": ["call", "", "phone"],
    }
    prose = lambda: r.choice([lambda: f"{some(2, 9, low)}{r.choice(['.', ',', ';', ':'])} {cap()} {some(1, 8, low)}. {cap()} {low()}", lambda: some(6, 24, low), lambda: some(1, 6, cap) + ".", lambda: some(1, 8, lambda: d(r.randint(1, 6))), lambda: f"({low()} {low()}) {cap()}, {cap()} {low()}", lambda: f"{cap()}. {cap()} {low()}. {cap()}."])()
    none = [prose, prose, lambda: f"version {d(1)}.{d(2)}.{d(1)}", lambda: f"order {d(6)}", lambda: f"{cap()} {cap()}", lambda: f"year {d(4)}", lambda: f"{d(4)}-{d(2)}-{d(2)}", lambda: f"price {d(3)}.{d(2)}", lambda: f"{d(3)}-{d(3)}", lambda: d(r.randint(12, 19)), lambda: f"{d(2)} {low()}", lambda: f"({d(2)})", lambda: f"{cap()}: {cap()}", lambda: "contact " + low(), lambda: f"{d(8)}-{d(4)}-{d(4)}", lambda: low() + " (at) " + low() + " " + low(), lambda: f"{cap()} {d(2)}", lambda: f"{d(2)} {cap()} {cap()}"]
    cases = []
    for k in range(n):
        text = some(1, 4, low)
        gold = []
        if k % 2:
            text += " " + r.choice(none)()
        else:
            kind = list(make)[k // 2 % len(make)]
            text += " " + r.choice(lead[kind])
            text = text.rstrip() + " "
            start = len(text)
            text += make[kind]()
            gold = [(start, len(text), kind)]
        text += r.choice([".", ",", "", ""]) + " " + some(1, 3, low)
        cases.append((text, gold))
    return cases


@lru_cache(maxsize=1)
def trained() -> SemiMarkov:
    return SemiMarkov().fit(training_cases())


def _passes(n: int, at: np.ndarray, ends: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log sums over the segmentations before and after each of n + 1 places; x: a segment's log sum over types, in order of starts."""
    ahead, back = np.zeros(n + 1), np.zeros(n + 1)
    by_end = np.argsort(ends, kind="stable")
    to = np.searchsorted(ends[by_end], np.arange(n + 2))
    of = np.searchsorted(at, np.arange(n + 1))
    for j in range(1, n + 1):
        k = by_end[to[j] : to[j + 1]]
        ahead[j] = _log_sum(ahead[j - 1], ahead[at[k]] + x[k])
    for i in range(n - 1, -1, -1):
        k = slice(of[i], of[i + 1])
        back[i] = _log_sum(back[i + 1], back[ends[k]] + x[k])
    return ahead, back


def _log_sum(one: float, more: np.ndarray) -> float:
    top = max(one, more.max()) if len(more) else one
    return top + math.log(math.exp(one - top) + np.exp(more - top).sum())


class Field:
    """A trained field as tables: the scores of all segments of a length at once, the same as SemiMarkov.scores gives."""

    def __init__(self, weights: dict[str, dict[str, float]]):
        self.rows: dict[str, np.ndarray] = {}
        for k, t in enumerate(TYPES):
            for f, x in weights.get(t, {}).items():
                self.rows.setdefault(f, np.zeros(len(TYPES), np.float32))[k] = x
        row = self.row
        digits, spaces = np.stack([row(f"d{k}") for k in range(25)]), np.stack([row(f"sp{k}") for k in range(7)])
        both = (digits[:, None] + spaces[None]).reshape(-1, len(TYPES))
        self.sized = [both + row(f"n{n}") for n in range(MAX_TOKENS + 1)]
        # shape sequences as a tree; node 0 leads nowhere, node 1 is the root, shape 0 is in no sequence
        self.shapes: dict[str, int] = {}
        steps, self_rows = {}, [np.zeros(len(TYPES), np.float32)] * 2
        for f, x in self.rows.items():
            if f[0] == "s" and not re.fullmatch("sp[0-6]", f):
                node = 1
                for shape in f[1:].split(" "):
                    key = (node, self.shapes.setdefault(shape, len(self.shapes) + 1))
                    if key not in steps:
                        steps[key] = len(self_rows)
                        self_rows.append(self_rows[0])
                    node = steps[key]
                self_rows[node] = x
        self.node_rows = np.stack(self_rows)
        self.tree = np.zeros((len(self_rows), len(self.shapes) + 1), np.int32)
        for (node, shape), to in steps.items():
            self.tree[node, shape] = to
        # the largest weights of what a start's segments may still meet
        self.below = self.node_rows.copy()
        for (node, _), to in sorted(steps.items(), key=lambda x: -x[1]):
            self.below[node] = np.maximum(self.below[node], self.below[to])
        self.below = np.ascontiguousarray(np.maximum(self.below, 0)[:, _ADDED])
        most = np.stack([np.maximum.accumulate((digits[:, None] + spaces[None]).max(axis=1) + row(f"n{n}")) for n in range(1, MAX_TOKENS + 1)])
        self.longer = np.ascontiguousarray(np.concatenate([np.zeros((1, *most.shape[1:]), np.float32), np.maximum.accumulate(most[::-1])[::-1]])[:, :, _ADDED])
        largest = lambda name: np.max([np.zeros(len(TYPES), np.float32), *(x for f, x in self.rows.items() if re.fullmatch(name, f))], axis=0)
        self.largest = np.stack([largest(x) for x in ("names[0-9]+", "road(True|False)", "masked[0-9]+", "@", "luhn(True|False)", "iban(True|False)", "mask(True|False)")])
        # classes of tokens that all features treat alike; the first two stand for what is before and after a text
        self.classes: dict[tuple, int] = {("^",): 0, ("$",): 1}
        zero = np.zeros(len(TYPES), np.float32)
        self.facts = [[0] * 7, [0] * 7]
        self.weighed = [[zero, zero, zero, row("b^"), row("bb^")], [zero, zero, row("a$"), zero, zero]]
        self.known: dict[str, int] = {}
        self.by_key = np.full(_KEYS, -1, np.int32)
        self.tables: tuple = (0,)

    def row(self, feature: str) -> np.ndarray:
        return self.rows.get(feature, np.zeros(len(TYPES), np.float32))

    def _class(self, t: str) -> int:
        low, shape = t.lower(), _shape(t)
        named = low in _CUE_WORDS or not low.isalnum()
        b, bb = "b" + (low if named else _shape(low)), "bb" + (low if named else "w")
        fact = (self.shapes.get(shape, 0), sum(c.isdigit() for c in t), int(shape == "Aa"), int(low in _ROADS), int(low == "at"), int(low in "(["), int(low == "@"))
        key = (shape if "f" + shape in self.rows or "l" + shape in self.rows or "a" + shape in self.rows else "", b if b in self.rows else "", bb if bb in self.rows else "", fact)
        if key not in self.classes:
            self.classes[key] = len(self.classes)
            self.facts.append(list(fact))
            self.weighed.append([self.row(x) for x in ("f" + shape, "l" + shape, "a" + shape, b, bb)])
        if len(self.known) > 200_000:
            self.known.clear()
        self.known[t] = self.classes[key]
        return self.known[t]

    def class_tables(self) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """By class: facts, weights (first, last, after, before, before that), and those weights of the added types alone."""
        if self.tables[0] != len(self.classes):
            weighed = np.array(self.weighed)
            self.tables = (len(self.classes), np.array(self.facts), *([np.ascontiguousarray(weighed[:, k, part]) for k in range(5)] for part in (slice(None), _ADDED)))
        return self.tables[1:]

    def kinds(self, text: str, start: np.ndarray, end: np.ndarray, key: np.ndarray) -> np.ndarray:
        """The class of each token; tokens of one key have one class, and those of key -1 are looked up by themselves."""
        kind = self.by_key[key]
        kind[key < 0] = -1
        for k in np.flatnonzero(kind < 0).tolist():
            own = int(key[k])
            if own >= 0 and self.by_key[own] >= 0:
                kind[k] = self.by_key[own]
                continue
            token = text[start[k] : end[k]]
            kind[k] = self.known[token] if token in self.known else self._class(token)
            if own >= 0:
                self.by_key[own] = kind[k]
        return kind

    def spans(self, texts: list[str], certain: float = CERTAIN) -> list[list[tuple[str, int, int]]]:
        """Per text: spans of the added types, which are segments of the best segmentation that are certain enough."""
        out: list[list[tuple[str, int, int]]] = []
        group: list[str] = []
        size = 0
        for text in texts:
            if group and size + len(text) > CHARACTERS:
                out += _Tokens(self, group).spans(certain)
                group, size = [], 0
            group.append(text)
            size += len(text)
        return out + (_Tokens(self, group).spans(certain) if group else [])


#: What a code point is: _TOKEN's kinds of characters, and bits of case, of digits and of what tables cannot treat.
_SPACE, _ALPHA, _DIGIT, _OTHER, _UPPER, _LOWER, _ODD = 0, 1, 2, 3, 4, 8, 16
_kinds_of = np.zeros(0x110000, np.uint8)
_page_made = np.zeros(0x1100, bool)
#: Keys of tokens: shape and word of letters, length of digits, and the code point of a single character.
_WORD_LIST = sorted(_CUE_WORDS | _ROADS)
_DIGIT_KEYS, _CHAR_KEYS, _KEYS = 1 << 9, 1 << 10, (1 << 10) + (1 << 14)


def _character(c: str) -> int:
    if c.isspace():
        return _SPACE
    if c in "0123456789":
        return _DIGIT
    if not c.isalnum() or c.isdecimal():
        return _OTHER
    return _ALPHA | _UPPER * c.isupper() | _LOWER * c.islower() | _ODD * (not c.isalpha() or c.lower() != c and not c.isupper())


def _characters(codes: np.ndarray) -> np.ndarray:
    pages = codes >> 8
    if not _page_made[pages].all():
        for page in np.unique(pages[~_page_made[pages]]).tolist():
            _kinds_of[page << 8 : (page + 1) << 8] = [_character(chr(c)) for c in range(page << 8, (page + 1) << 8)]
            _page_made[page] = True
    return _kinds_of[codes]


def _word_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((sums[end] - sums[start]) * powers(_BASE_INVERSE, len(sums))[start] + (end - start).astype(U))


def _letter_sums(codes: np.ndarray) -> np.ndarray:
    low = codes.astype(U) + U(1)
    low[(codes >= 65) & (codes <= 90)] += U(32)
    sums = np.zeros(len(codes) + 1, U)
    np.cumsum(low * powers(_BASE, len(codes)), out=sums[1:])
    return sums


def _known_words() -> tuple[np.ndarray, np.ndarray]:
    codes = [np.frombuffer(w.encode("utf-32-le"), "<u4") for w in _WORD_LIST]
    hashes = np.concatenate([_word_hash(_letter_sums(c), np.array([0]), np.array([len(c)])) for c in codes])
    order = np.argsort(hashes)
    return hashes[order], order + 1


def cut_tokens(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and key of the tokens of _TOKEN in a text's code points. Tokens of one key are of one class; -1 is no key."""
    what = _characters(codes)
    kind = what & 3
    new = np.append(True, kind[1:] != kind[:-1]) | (kind == _OTHER)
    heads = np.flatnonzero(new)
    ends = np.append(heads[1:], len(codes))
    real = kind[heads] != _SPACE
    start, end = heads[real], ends[real]
    of, size = kind[start], end - start
    key = np.full(len(start), -1, np.int64)
    k = np.flatnonzero(of == _DIGIT)
    key[k] = np.where(size[k] < _CHAR_KEYS - _DIGIT_KEYS, _DIGIT_KEYS + size[k], -1)
    k = np.flatnonzero(of == _OTHER)
    point = codes[start[k]]
    key[k] = np.where(point < _KEYS - _CHAR_KEYS, _CHAR_KEYS + point, -1)
    k = np.flatnonzero(of == _ALPHA)
    if len(k):
        # bits of case: 21 bits each of the upper, lower and odd characters so far
        sums = np.zeros(len(codes) + 1, np.int64)
        np.cumsum((what >> 2 & 1).astype(np.int64) | (what >> 3 & 1).astype(np.int64) << 21 | (what >> 4).astype(np.int64) << 42, out=sums[1:])
        held = sums[end[k]] - sums[start[k]]
        upper, lower, odd = held & 0x1FFFFF, held >> 21 & 0x1FFFFF, held >> 42
        first = what[start[k]]
        starts_up = (first & _UPPER) > 0
        rest_lower = lower - ((first & _LOWER) > 0)
        shape = np.where(starts_up & (upper == 1) & (rest_lower > 0), 0, np.where((lower == 0) & (upper > 0), 1, np.where((upper == 0) & (lower > 0), 2, np.where(upper + lower > 0, 3, 4))))
        word = np.zeros(len(k), np.int64)
        short = np.flatnonzero(size[k] <= _LONGEST_WORD)
        hashes = _word_hash(_letter_sums(codes), start[k[short]], end[k[short]])
        at = np.minimum(np.searchsorted(_KNOWN[0], hashes), len(_WORD_LIST) - 1)
        word[short] = np.where(_KNOWN[0][at] == hashes, _KNOWN[1][at], 0)
        key[k] = np.where(odd > 0, -1, shape * 64 + word)
    return start, end, key


_LONGEST_WORD = max(map(len, _WORD_LIST))
_KNOWN = _known_words()


class _Tokens:
    """The tokens of several texts on end, a line's end between any two."""

    def __init__(self, field: Field, texts: list[str]):
        self.field = field
        self.text = "\n".join(texts)
        codes = np.frombuffer(self.text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        self.starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
        self.n = 0
        if not len(codes):
            return
        self.start, self.end, key = cut_tokens(codes)
        self.n = len(key)
        if not self.n:
            return
        self.kind = field.kinds(self.text, self.start, self.end, key)
        self.line = np.cumsum(codes == 10)[self.start]
        self.space = np.cumsum(codes == 32)[self.start]
        self.of = np.searchsorted(self.starts, self.start, side="right") - 1
        new = np.append(True, self.of[1:] != self.of[:-1])
        new2 = new | np.append(True, new[:-1])
        self.before = np.where(new, 0, np.roll(self.kind, 1))
        self.before2 = np.where(new2, 0, np.roll(self.kind, 2))
        self.after = np.where(np.append(new[1:], True), 1, np.roll(self.kind, -1))
        every, self.weighed, self.weighed_added = field.class_tables()
        facts = every[self.kind]
        self.shape, self.road = facts[:, 0], facts[:, 3]
        self.sums = np.concatenate([np.zeros((1, 6), np.int64), np.cumsum(facts[:, 1:], axis=0)])

    def surface(self, i: int, j: int) -> str:
        return self.text[self.start[i] : self.end[j - 1]]

    def _first(self, i: np.ndarray, added: bool = False) -> np.ndarray:
        w = self.weighed_added if added else self.weighed
        if added:
            return w[0][self.kind[i]] + w[3][self.before[i]] + w[4][self.before2[i]] + self.field.row("1")[_ADDED]
        return w[0][self.kind[i]] + w[3][self.before[i]] + w[4][self.before2[i]] + self.field.row("1")

    def _last(self, j: np.ndarray) -> np.ndarray:
        return self.weighed[1][self.kind[j]] + self.weighed[2][self.after[j]]

    def _bounds(self) -> tuple[np.ndarray, np.ndarray]:
        """Per line: the largest weights of segment ends; and each token's line, from 0."""
        new = np.append(True, self.line[1:] != self.line[:-1])
        heads, of = np.flatnonzero(new), np.cumsum(new) - 1
        w = self.weighed_added
        last = lambda a, b: w[1][self.kind[a:b]] + w[2][self.after[a:b]]
        return np.concatenate([np.maximum.reduceat(last(a, b), h - a) for a, b, h in self._pieces(heads)]), of

    def _pieces(self, heads: np.ndarray):
        """Ranges of whole lines, of about STARTS tokens."""
        k = 0
        while k < len(heads):
            to = max(k + 1, int(np.searchsorted(heads, heads[k] + STARTS)))
            yield int(heads[k]), int(heads[to]) if to < len(heads) else self.n, heads[k:to]
            k = to

    def scored(self, i: np.ndarray, bounds=None):
        """(length, starts, scores) of the segments that start at i, by length. With bounds, starts without a further positive
        segment of an added type are left out."""
        field, row = self.field, self.field.row
        if bounds:
            top, of = bounds
            rest = self._first(i, True) + top[of[i]]
            # what the longest segment from here holds, over the line's end or not
            held = self.sums[np.minimum(i + MAX_TOKENS, self.n)] - self.sums[i]
            most = np.minimum(held[:, 0], 24)
            names, road, masked, mail, checked, account, form = field.largest[:, _ADDED]
            two = (self.end[i] - self.start[i] == 2) & (most > 1)
            for there, weight in ((self.sums[i + 1, 1] > self.sums[i, 1], names), (held[:, 2] > 0, road), ((held[:, 3] > 0) & (held[:, 4] > 0), masked + form), (held[:, 5] > 0, mail), (held[:, 0] >= 12, checked), (two, account)):
                rest[there] += weight
            may = rest + field.longer[1][most] + field.below[field.tree[1, self.shape[i]]]
            good = np.flatnonzero(may.max(axis=1) > -1e-3)
            i, rest, most = i[good], rest[good], most[good]
        first, node = self._first(i), np.ones(len(i), np.int32)
        for size in range(1, MAX_TOKENS + 1):
            good = i + size <= self.n
            good &= self.line[np.minimum(i + size, self.n) - 1] == self.line[i]
            if bounds and size > 1 and (size <= SHAPED + 1 or size % 4 == 0):
                may = rest + field.longer[size][most]
                if size <= SHAPED:
                    may += field.below[field.tree[node, self.shape[np.minimum(i + size, self.n) - 1]]]
                good &= may.max(axis=1) > -1e-3
            if not good.all():
                i, first, node = i[good], first[good], node[good]
                if bounds:
                    rest, most = rest[good], most[good]
            if not len(i):
                break
            held = self.sums[i + size] - self.sums[i]
            x = first + self._last(i + size - 1)
            x += field.sized[size][np.minimum(held[:, 0], 24) * 7 + np.minimum(self.space[i + size - 1] - self.space[i], 6)]
            if size <= SHAPED:
                node = field.tree[node, self.shape[i + size - 1]]
                x += field.node_rows[node]
            x[held[:, 1] == size] += row(f"names{size}")
            k = np.flatnonzero(held[:, 2])
            x[k] += np.where(self.road[i[k] + size - 1, None] > 0, row("roadTrue"), row("roadFalse"))
            for k in np.flatnonzero((held[:, 3] > 0) & (held[:, 4] > 0)):
                x[k] += row(f"masked{held[k, 3]}")
                if m := _MASK.match(self.text, self.start[i[k]]):
                    x[k] += row(f"mask{m.end() == self.end[i[k] + size - 1]}")
            x[held[:, 5] > 0] += row("@")
            for k in np.flatnonzero(held[:, 0] >= 12):
                x[k] += row(f"luhn{luhn(re.sub('[^0-9]', '', self.surface(i[k], i[k] + size)))}")
            if size > 1:  # an account number begins with two letters, which are a token, and has two digits at least
                for k in np.flatnonzero((held[:, 0] >= 2) & (self.end[i] - self.start[i] == 2)):
                    if _IBAN.fullmatch(self.surface(i[k], i[k] + size)):
                        x[k] += row(f"iban{_ends(_IBAN, self.text, self.start[i[k]], self.end[i[k] + size - 1])}")
            yield size, i, x

    def spans(self, certain: float) -> list[list[tuple[str, int, int]]]:
        out: list[list[tuple[str, int, int]]] = [[] for _ in self.starts[1:]]
        if not self.n:
            return out
        bounds = self._bounds()
        lines: set[int] = set()
        for lo in range(0, self.n, STARTS):
            for _, i, x in self.scored(np.arange(lo, min(self.n, lo + STARTS)), bounds):
                lines.update(self.line[i[(x[:, _ADDED] > 0).any(axis=1)]].tolist())
        for line in sorted(lines):
            lo, hi = np.searchsorted(self.line, [line, line + 1])
            found, at, ends, every = [], [], [], []
            for a in range(lo, hi, STARTS):
                for size, i, x in self.scored(np.arange(a, min(hi, a + STARTS))):
                    k, t = np.nonzero(x > 0)
                    found += zip(i[k].tolist(), (i[k] + size).tolist(), t.tolist(), x[k, t].tolist(), strict=True)
                    at.append(i - lo)
                    ends.append(i + size - lo)
                    every.append(np.logaddexp.reduce(x, axis=1))
            chosen = [s for s in _best(found) if TYPES[s[2]] in ADDED]
            if not chosen:
                continue
            at, ends, every = map(np.concatenate, (at, ends, every))
            order = np.argsort(at, kind="stable")
            ahead, back = _passes(hi - lo, at[order], ends[order], every[order].astype(float))
            for i, j, t, x in chosen:
                if ahead[i - lo] + x + back[j - lo] - ahead[-1] >= math.log(certain):
                    base = self.starts[self.of[i]]
                    out[self.of[i]].append((TYPES[t], int(self.start[i] - base), int(self.end[j - 1] - base)))
        return [sorted(x, key=lambda s: (s[1], s[2])) for x in out]


def _best(found: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int, float]]:
    """The segments of the best segmentation, out of those with a positive score."""
    found = sorted(found, key=lambda s: (s[1], s[0]))
    tops, places, chosen = [0.0], [-1], [None]
    for s in found:
        base = bisect_right(places, s[0]) - 1
        if tops[base] + s[3] > tops[-1]:
            tops.append(tops[base] + s[3])
            places.append(s[1])
            chosen.append((s, base))
    out, at = [], len(tops) - 1
    while at:
        s, at = chosen[at]
        out.append(s)
    return out[::-1]


def field_spans(text: str, model: SemiMarkov, certain: float = CERTAIN) -> list[tuple[str, int, int]]:
    """Spans of the added types in one text."""
    return Field(model.weights).spans([text], certain)[0]


_SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_more long"


def find_pii(docs: DataFrame, model: SemiMarkov | None = None) -> DataFrame:
    """Per input row: doc_id, counts of base spans, base_sha256, spans (kind:start:end, code points) and n_more (added spans).

    A null text counts as empty and has no spans; rows are read one by one, so repeated rows give repeated results; an empty
    table gives an empty result. Columns other than doc_id and text are not read. Added spans that overlap a base span are left out.
    """
    field = Field((model or trained()).weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            rows = []
            texts = block.column(1).to_pylist()
            for text, more in zip(texts, field.spans(texts), strict=True):
                base = base_spans(text, PERSONAL)
                every = merged(base, more, KINDS)
                count = [sum(k == kind for k, _, _ in base) for kind in PERSONAL]
                rows.append([*count, digest(base), joined(every), len(every) - len(base)])
            columns = list(zip(*rows, strict=True))
            kinds = [*[pa.int64()] * 4, *[pa.string()] * 2, pa.int64()]
            yield pa.RecordBatch.from_arrays([block.column(0), *map(pa.array, columns, kinds)], [x.split()[0] for x in _SCHEMA.split(", ")])

    return id_text(docs).mapInArrow(run, _SCHEMA)
