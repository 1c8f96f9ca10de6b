"""Plain versions of the operators, for small inputs."""

import bisect
import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def quality(text):
    text = text or ""
    words = WORD.findall(text)
    windows = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    seen, copies = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            copies += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), copies, len(covered)


def near(docs, n, percent):
    """doc_id -> (size of its set, its component)."""
    sets = {}
    for i, t in docs:
        w = WORD.findall(lower(t or ""))
        sets[i] = frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i in ids:
        for j in ids:
            if i < j and sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    a, b = find(i), find(j)
                    root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def cut(docs, depth):
    """doc_id -> (bytes, removed, spans, digest of the rest)."""
    first = {}
    for i, t in sorted(docs):
        b = (t or "").encode()
        for p in range(len(b) - depth + 1):
            first.setdefault(b[p : p + depth], i)
    out = {}
    for i, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - depth + 1):
            if first[b[p : p + depth]] < i:
                gone[p : p + depth] = b"\1" * depth
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[i] = (len(b), sum(gone), sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone)), hashlib.sha256(kept).hexdigest())
    return out


def best_fit_decreasing(lengths, capacity):
    """How many sequences best-fit decreasing opens."""
    gaps, opened = [], 0
    for n in sorted(lengths, reverse=True):
        k = bisect.bisect_left(gaps, n)
        if k == len(gaps):
            opened += 1
            bisect.insort(gaps, capacity - n)
        else:
            bisect.insort(gaps, gaps.pop(k) - n)
    return opened


def luhn(s):
    d = [int(c) for c in s][::-1]
    return sum(x if k % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for k, x in enumerate(d)) % 10 == 0


PERSONAL = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.group().split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(re.sub("[ -]", "", m.group())) <= 19 and luhn(re.sub("[ -]", "", m.group()))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15),
}
SECRET = {
    "assign": (r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", lambda m: len(m.group(2)) >= 12),
    "access": (r"AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 18),
    "hex": (r"[0-9a-f]+", lambda m: len(m.group()) >= 16),
}


def spans(text, kinds):
    found = [(m.start(), k, kind, m.end()) for k, (kind, (p, good)) in enumerate(kinds.items()) for m in re.finditer(p, text or "") if good(m)]
    return [(kind, s, e) for s, _, kind, e in sorted(found)]
