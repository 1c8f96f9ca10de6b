"""Secrets: base patterns, and further spans from a battery of randomness tests.

Long runs of key characters are candidates, and so are the parts of a run between the marks + / - _, so that a random
part of a path or a URL stands for itself. Of each, the encoding is inferred from its characters, and in the encoding's
order the battery tests uniformity of the alphabet (chi-squared), runs above and below the middle, and serial
correlation; Fisher's sum joins them. A candidate is a discovery when it looks random where an ordinary identifier of its
length would not: its p-value is the share of ordinary strings of the same length class and encoding that look at least as
random, taken from a large sample of them and, beyond its least twentieth, from an exponential tail fitted there, which falls
off more slowly than the sample. The Benjamini-Hochberg step over all candidates of the corpus that no base
pattern has, with a weight for each length class, holds the share of false discoveries under RATE. Only a histogram of the p-values, of fixed size, reaches the driver.
"""

from __future__ import annotations

import math
import random
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import Scratch, blocks, id_text
from ._spans import SECRET, apart, base_spans, digest, joined, merged

RATE = 0.01
SHORTEST = 16
#: Least joint p-value of the battery; below it a candidate does not look random at all.
RANDOM = 1e-4
#: Length classes by least length, and the weight of each in the false-discovery step (mean 1 for an even mix).
CLASSES = ((16, 0.1), (20, 0.3), (24, 0.6), (32, 1.2), (48, 1.8), (64, 2.0))
_BIN = 20  # bins of a decade of p-values
#: Ordinary strings drawn for each encoding and length class, and the share of them that the fitted tail starts from.
DRAWS, TAIL = 1500, 0.05

_CANDIDATE = re.compile(rf"[A-Za-z0-9+/_-]{{{SHORTEST},}}={{0,2}}")
_PART = {marks: re.compile(rf"[^{marks}]{{{SHORTEST},}}") for marks in ("+/", "_-", "+/_-")}
_DIGITS, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: By size of the alphabet: a string's encoding is the first that holds it.
ENCODINGS = {
    "hex": _DIGITS + "ABCDEF",
    "hex_lower": _DIGITS + "abcdef",
    "upper": _UPPER,
    "lower": _LOWER,
    "base32": _UPPER + "234567",
    "base36": _DIGITS + _LOWER,
    "base36_upper": _DIGITS + _UPPER,
    "base62": _DIGITS + _UPPER + _LOWER,
    "base64": _UPPER + _LOWER + _DIGITS + "+/",
    "base64url": _UPPER + _LOWER + _DIGITS + "-_",
}
_SETS = {name: frozenset(a) for name, a in ENCODINGS.items()}
_PLACE = {name: {c: i for i, c in enumerate(a)} for name, a in ENCODINGS.items()}
KINDS = [*SECRET, "random"]


def encoding(s: str) -> str | None:
    """The smallest alphabet that holds all characters; digits alone are no encoding."""
    chars = set(s)
    if chars <= set(_DIGITS):
        return None
    return next((name for name, have in _SETS.items() if chars <= have), None)


def parts(run: str) -> list[tuple[int, int, str]]:
    """Start, end and encoding of the candidates in a run of key characters: the run itself and its parts between marks.

    A run that no alphabet holds, because it has marks of both base64 alphabets, is cut at the marks foreign to the one in
    which its longest part is longer.
    """
    body = run.rstrip("=")
    found = []
    if name := encoding(body):
        found.append((0, len(run), name))
    elif not body.isdigit():
        cuts = {name: [m.span() for m in _PART[marks].finditer(body)] for name, marks in (("base64url", "+/"), ("base64", "_-"))}
        best = max(cuts, key=lambda k: max((e - s for s, e in cuts[k]), default=0))
        found += [(s, e, name) for s, e in cuts[best] if (name := encoding(body[s:e]))]
    if not body.isalnum():
        have = {(s, e) for s, e, _ in found}
        found += [(*m.span(), name) for m in _PART["+/_-"].finditer(body) if m.span() not in have and (name := encoding(m.group()))]
    return found


def _normal(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def _chi_squared(x: float, df: int) -> float:
    """Upper tail, by the Wilson-Hilferty cube root."""
    z = ((x / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    return 0.5 * math.erfc(z / math.sqrt(2))


def _runs(high: list[bool]) -> float:
    """p-value of the number of runs (Wald and Wolfowitz)."""
    n, a = len(high), sum(high)
    b = n - a
    if not a or not b:
        return 2.0 ** (1 - n)
    mean = 2 * a * b / n + 1
    spread = (mean - 1) * (mean - 2) / (n - 1)
    runs = 1 + sum(p != q for p, q in zip(high, high[1:], strict=False))
    return _normal((runs - mean) / math.sqrt(spread)) if spread > 0 else 1e-9


def battery(s: str, name: str) -> tuple[float, ...]:
    """p-values of uniformity, runs of the high and of the low bit of the places, and serial correlation next door and next but
    one, each under the hypothesis that s is random in its encoding."""
    place, size, n = _PLACE[name], len(ENCODINGS[name]), len(s)
    at = [place[c] for c in s]
    cells = max(2, min(size, n // 4))
    counts = [0] * cells
    width = [0] * cells
    for i in range(size):
        width[i * cells // size] += 1
    for i in at:
        counts[i * cells // size] += 1
    x = sum((c - n * w / size) ** 2 / (n * w / size) for c, w in zip(counts, width, strict=True))
    uniform = _chi_squared(max(x, 1e-9), cells - 1)
    middle = sum(at) / n
    off = [i - middle for i in at]
    total = sum(i * i for i in off)
    serial = [_normal((sum(p * q for p, q in zip(off, off[lag:], strict=False)) / total * n + 1) / math.sqrt(n)) if total else 1e-9 for lag in (1, 2)]
    return uniform, _runs([2 * i >= size for i in at]), _runs([i % 2 == 1 for i in at]), *serial


def strength(s: str, name: str) -> tuple[float, float]:
    """Fisher's sum of the battery, and its p-value (chi-squared with two degrees of freedom for each test)."""
    p = battery(s, name)
    half = -sum(math.log(max(x, 1e-300)) for x in p)
    return 2 * half, math.exp(-half) * sum(half**k / math.factorial(k) for k in range(len(p)))


def strengths(at: np.ndarray, size: int) -> np.ndarray:
    """Fisher's sums of many strings of one length, given as places in an alphabet of `size`; the same as strength gives."""
    many, n = at.shape
    cells = max(2, min(size, n // 4))
    width = np.bincount(np.arange(size) * cells // size, minlength=cells) * (n / size)
    counts = np.zeros((many, cells))
    np.add.at(counts, (np.arange(many)[:, None], at * cells // size), 1)
    x = np.maximum(((counts - width) ** 2 / width).sum(axis=1), 1e-9)
    df = cells - 1
    normal = np.vectorize(lambda z: math.erfc(abs(z) / math.sqrt(2)), otypes=[float])
    uniform = np.vectorize(lambda x: _chi_squared(x, df), otypes=[float])(x)
    found = [uniform]
    for high in (2 * at >= size, at % 2 == 1):
        a = high.sum(axis=1)
        b = n - a
        runs = 1 + (high[:, 1:] != high[:, :-1]).sum(axis=1)
        mean = 2 * a * b / n + 1
        spread = (mean - 1) * (mean - 2) / (n - 1)
        found.append(np.where(a * b == 0, 2.0 ** (1 - n), np.where(spread > 0, normal((runs - mean) / np.sqrt(np.where(spread > 0, spread, 1))), 1e-9)))
    off = at - at.mean(axis=1, keepdims=True)
    total = (off**2).sum(axis=1)
    for lag in (1, 2):
        found.append(np.where(total > 0, normal(((off[:, lag:] * off[:, :-lag]).sum(axis=1) / np.where(total > 0, total, 1) * n + 1) / math.sqrt(n)), 1e-9))
    return -2 * sum(np.log(np.maximum(p, 1e-300)) for p in found)


def _ordinary(r: random.Random, name: str, n: int) -> str:
    """An ordinary identifier: words of alternating consonants and vowels in an encoding's usual style, with some numbers,
    or a filler of repeated or counted characters."""

    def word() -> str:
        k = r.randint(1, 4)
        return "".join(r.choice("ttnnsshhrrddllccmmffppggwbvkjyxzq") + r.choice("eeeeaaaooiiu") + (r.choice("nrsltdm") if r.random() < 0.35 else "") for _ in range(k))

    letters = ENCODINGS[name]
    if name.startswith("hex"):
        out = r.choice(letters)
        while len(out) < n:
            out += out[-1] if r.random() < 0.5 else r.choice("000012345689") if r.random() < 0.7 else r.choice(letters)
        return out[:n]
    if r.random() < 0.03:
        step, at = r.randint(0, 2), r.randrange(len(letters))
        return "".join(letters[(at + step * i) % len(letters)] for i in range(n))
    marks = {"base64": "/+", "base64url": "-_"}.get(name)
    join = r.choice(marks) if marks else ""
    digits = {"base32": "234567", "upper": "", "lower": ""}.get(name, _DIGITS)
    style = r.choice(("plain", "capital", "upper")) if name in ("base62", "base64", "base64url") else "upper" if name in ("base32", "upper", "base36_upper") else "plain"
    out = ""
    while len(out) < n:
        w = word()
        w = w.upper() if style == "upper" else w.capitalize() if style == "capital" and r.random() < 0.8 else w
        number = "".join(r.choice(digits) for _ in range(r.choice((1, 1, 2, 2, 4)))) if digits and r.random() < 0.25 else ""
        out += w + number + join
    return out[:n]


def length_class(n: int) -> int:
    return max(k for k, (least, _) in enumerate(CLASSES) if n >= least)


@lru_cache(maxsize=64)
def null_model(name: str, k: int) -> tuple[np.ndarray, float, float]:
    """Of the log strength of ordinary strings of an encoding and a length class: its sorted sample, and start and mean of its lower tail."""
    r = random.Random(f"{name}{k}")
    place = _PLACE[name]
    drawn: list[str] = []
    while len(drawn) < DRAWS:  # the encoding is inferred from the string, so only strings of this one belong
        if encoding(x := _ordinary(r, name, CLASSES[k][0])) == name:
            drawn.append(x)
    at = np.array([[place[c] for c in x] for x in drawn])
    logs = np.sort(np.log(strengths(at, len(place)) + 1e-9))
    start = logs[int(TAIL * DRAWS)]
    return logs, float(start), float(max(0.02, 1.25 * (start - logs[: int(TAIL * DRAWS)]).mean()))


def looks_ordinary(t: float, name: str, n: int) -> float:
    """The share of ordinary strings of the encoding and length class that look at least as random as strength t does."""
    logs, start, mean = null_model(name, length_class(n))
    x = math.log(t + 1e-9)
    if x < start:
        return TAIL * math.exp((x - start) / mean)
    return min(1.0, (int(np.searchsorted(logs, x, side="right")) + 1) / (len(logs) + 1))


def candidates(text: str) -> list[tuple[str, int, int, float]]:
    """kind, start, end and the weighted p-value of every candidate; 1 for one that does not look random."""
    out = []
    for m in _CANDIDATE.finditer(text):
        run = m.group()
        for s, e, name in parts(run):
            body = run[s:e].rstrip("=")
            t, p = strength(body, name)
            q = looks_ordinary(t, name, len(body)) / CLASSES[length_class(len(body))][1]
            out.append(("random", m.start() + s, m.start() + e, min(1.0, q) if p >= RANDOM else 1.0))
    return out


def discoveries(found: list[tuple[str, int, int, int]], least: int) -> list[tuple[str, int, int]]:
    """The candidates (kind, start, end, bin) of a bin of `least` or more; of overlapping ones the clearest, then the longest and the first."""
    out: list[tuple[int, int, str]] = []  # by start, without overlaps
    for kind, s, e, _ in sorted((x for x in found if x[3] >= least), key=lambda x: (-x[3], x[1] - x[2], x[1])):
        k = bisect_left(out, (s,))
        if (not k or out[k - 1][1] <= s) and (k == len(out) or e <= out[k][0]):
            out.insert(k, (s, e, kind))
    return [(kind, s, e) for s, e, kind in out]


def _bin(p: float) -> int:
    """Bins rise as p falls; a bin's largest p is 10 ** (-bin / _BIN)."""
    return min(60 * _BIN, int(-math.log10(max(p, 1e-300)) * _BIN))


def cut(counts: dict[int, int], rate: float = RATE) -> int:
    """The Benjamini-Hochberg step on a histogram: the least bin whose candidates are discoveries."""
    total, below, best = sum(counts.values()), 0, 1 << 30
    for b in sorted(counts, reverse=True):
        below += counts[b]
        if total * 10 ** (-b / _BIN) <= rate * below:
            best = b
    return best


def _tested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches):
        base, bins, starts, ends = [], [], [], []
        for text in block.column(1).to_pylist():
            fixed = base_spans(text, SECRET)
            base.append(joined(fixed))
            found = apart(fixed, candidates(text))
            starts.append([x[1] for x in found])
            ends.append([x[2] for x in found])
            bins.append([_bin(x[3]) for x in found])
        yield pa.RecordBatch.from_arrays([block.column(0), pa.array(base, pa.string()), *(pa.array(x, pa.list_(pa.int32())) for x in (starts, ends, bins))], ["doc_id", "base", "starts", "ends", "bins"])


_TESTED = "doc_id long, base string, starts array<int>, ends array<int>, bins array<int>"
_FOUND = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long"


def _least_bin(tested: DataFrame, rate: float) -> int:
    rows = tested.select(F.explode("bins").alias("bin")).groupBy("bin").count().collect()  # 60 * _BIN + 1 rows at most
    return cut({r["bin"]: r["count"] for r in rows}, rate)


def find_secrets(spark: SparkSession, docs: DataFrame, rate: float = RATE, scratch: Scratch | None = None) -> DataFrame:
    """Per input row: doc_id, counts of base spans, base_sha256, spans (kind:start:end, code points) and n_random (added spans).

    A null text counts as empty and has no spans; repeated rows give repeated results; an empty table gives an empty
    result. Columns other than doc_id and text are not read. Added spans that overlap a base span are left out.
    """
    tested = (scratch or Scratch(spark)).table(id_text(docs).mapInArrow(_tested, _TESTED))
    least = _least_bin(tested, rate)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for base, starts, ends, bins in zip(*(b.column(i).to_pylist() for i in range(1, 5)), strict=True):
                fixed = [(k, int(s), int(e)) for k, s, e in (x.split(":") for x in base.split(",") if x)]
                more = discoveries([("random", *x) for x in zip(starts, ends, bins, strict=True)], least)
                every = merged(fixed, more, KINDS)
                rows.append([*(sum(k == kind for k, _, _ in fixed) for kind in SECRET), digest(fixed), joined(every), len(more)])
            if rows:
                kinds = [*[pa.int64()] * 3, *[pa.string()] * 2, pa.int64()]
                yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, zip(*rows, strict=True), kinds)], [x.split()[0] for x in _FOUND.split(", ")])

    return tested.mapInArrow(run, _FOUND)


def redact(spark: SparkSession, docs: DataFrame, mask: str = "[SECRET]", rate: float = RATE, scratch: Scratch | None = None) -> DataFrame:
    """All rows and columns of docs, with every secret in `text` replaced by `mask`; overlapping spans are replaced together.

    A null text stays null and an empty one empty; rows are read one by one, so repeated rows give repeated results; an empty table
    stays empty. `n_chars`, where there is one, follows the new text; other columns are passed on unread.
    """
    tested = (scratch or Scratch(spark)).table(id_text(docs).select("doc_id", "text").mapInArrow(_tested, _TESTED).select("bins"))
    least = _least_bin(tested, rate)
    at = docs.columns.index("text")

    def clean(text: str) -> str:
        fixed = base_spans(text, SECRET)
        spans = merged(fixed, discoveries([(*x[:3], _bin(x[3])) for x in apart(fixed, candidates(text))], least), KINDS)
        out, end = [], 0
        for _, s, e in sorted(spans, key=lambda x: x[1:]):
            if s >= end:
                out += [text[end:s], mask]
            end = max(end, e)
        return "".join([*out, text[end:]]) if spans else text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            text = pa.array([t if t is None else clean(t) for t in b.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([text if i == at else c for i, c in enumerate(b.columns)], b.schema.names)

    plain = docs.withColumn("text", F.col("text").cast("string"))
    out = plain.mapInArrow(run, plain.schema)
    return out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
