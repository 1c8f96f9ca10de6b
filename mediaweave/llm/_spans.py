"""Base patterns of personal data and secrets, found in time linear in the text.

Each finder yields (start, end) of the leftmost non-overlapping matches that pass their test; a match that fails is
dropped without another try inside it. Runs are entered at their first character only, which gives the same matches as
trying every position and does not grow with the square of a long run.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from itertools import accumulate

# The patterns that the results must follow.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?+[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ASSIGN = re.compile(r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")

_DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += _DOUBLED[d] if k % 2 else d
    return total % 10 == 0


def emails(text: str):
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and _LOCAL.match(text[start - 1]):
            start -= 1
        if start < at and (m := _EMAIL.match(text, start)):
            end = m.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def ips(text: str):
    if "." in text:
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
                yield m.span()


def cards(text: str):
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str):
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                yield m.span()


def assignments(text: str):
    if "=" in text or ":" in text:
        for m in _ASSIGN.finditer(text):
            if len(m.group(1)) >= 12:
                yield m.span()


def access_keys(text: str):
    if "AKIA" in text:
        for m in _ACCESS.finditer(text):
            if m.end() - m.start() >= 18:
                yield m.span()


def hex_runs(text: str):
    return (m.span() for m in _HEX.finditer(text))


PERSONAL = {"email": emails, "ip": ips, "card": cards, "phone": phones}
SECRET = {"assign": assignments, "access": access_keys, "hex": hex_runs}


def base_spans(text: str, kinds: dict) -> list[tuple[str, int, int]]:
    """Spans by start, then kind as listed."""
    found = [(start, k, kind, end) for k, (kind, find) in enumerate(kinds.items()) for start, end in find(text)]
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def digest(spans: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()


def apart(base: list[tuple[str, int, int]], more: list[tuple]) -> list[tuple]:
    """Those of `more`, whose second and third fields are start and end, that overlap no base span; base spans are sorted by start.

    Of the base spans that start before an end, the farthest end decides, so the work is linear but for a search.
    """
    if not base or not more:
        return list(more)
    starts = [s for _, s, _ in base]
    ends = list(accumulate((e for _, _, e in base), max))
    return [x for x in more if not (k := bisect_left(starts, x[2])) or ends[k - 1] <= x[1]]


def merged(base: list[tuple[str, int, int]], more: list[tuple[str, int, int]], kinds: list[str]) -> list[tuple[str, int, int]]:
    """All base spans, and those of `more` that overlap none of them; by start, then kind as listed."""
    return sorted([*base, *apart(base, more)], key=lambda x: (x[1], kinds.index(x[0]), x[2]))
