"""Removal of byte strings that an earlier document holds, by a depth-limited radix sort of suffixes.

Suffixes need ordering only through `depth` bytes, the threshold: groups that are equal after the last digit are exactly
the repeated windows. The most significant digit comes first and drops what it shows to be alone, so a later digit
sees only what is still undecided:

1. Suffixes are entered at the grams of GRAM bytes that are least, by a hash, in some window of `depth` bytes. Equal
   windows have equal least grams at equal places, so no repeated window is missed, and one place in about
   (depth - GRAM + 2) / 2 is sorted. The first digit is the gram, the second the widest stretch around it that a window
   can reach. A place whose stretch also occurs in a smaller document is decided at once: all windows through it are repeated.
   Grams that occur once are dropped. Only grams that occur with several stretches, at the edges of a repeated passage, go on.
2. Of those, one place for each stretch goes on with its bytes, and its windows are sorted by most-significant-digit
   passes of 8 bytes; each pass orders the groups left by the one before and drops single windows.
3. Covered places and windows meet their document's bytes, which are then cut.

Places travel in blocks of arrays, one for each range of digits, and each task first decides among its own places, so
that a passage that a third of all documents share reaches a range of digits once for each task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import Scratch, id_text, text_bytes
from ._words import _BASE, _BASE_INVERSE, U, mix, powers

DEPTH = 50
GRAM = 24
#: Bytes of stored input for each range of digits and each group of documents, about, and the most ranges.
SHARE_BYTES = 4 << 20
MOST_SHARES = 1 << 17
#: Bytes and texts that a task takes before it sends places off; a text's number there has 16 bits.
TASK_BYTES = 6 << 20
TASK_ROWS = 60_000


def _sliding(x: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Least or greatest of each `width` values on end."""
    f = np.minimum if least else np.maximum
    have, size = x, 1
    while size * 2 <= width:
        have = f(have[:-size], have[size:])
        size *= 2
    rest = width - size
    return f(have[: len(x) - width + 1], have[rest : rest + len(x) - width + 1]) if rest else have


class Places:
    """Places of a block of texts: the text's number, position, gram key and stretch key."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, depth: int, gram: int):
        n, reach = len(raw), depth - gram
        empty = np.zeros(0, np.int64)
        self.text, self.position, self.gram, self.stretch = empty, empty, empty.astype(U), empty.astype(U)
        if n < depth:
            return
        sums = np.zeros(n + 1, U)
        np.cumsum((raw.astype(U) + U(1)) * powers(_BASE, n), out=sums[1:])
        inverse = powers(_BASE_INVERSE, n + 1)
        exact = (sums[gram:] - sums[:-gram]) * inverse[: n - gram + 1]
        order = ((exact * U(0xD1B54A32D192ED03)) >> U(32)).astype(np.uint32) | np.uint32(1)
        low = _sliding(order, reach + 1, True)  # by the window's start
        ends = np.repeat(offsets[1:], np.diff(offsets))[: len(low)]
        low[np.arange(len(low)) + depth > ends] = 0
        padded = np.concatenate([np.zeros(reach, np.uint32), low, np.zeros(reach, np.uint32)])
        at = np.flatnonzero(_sliding(padded, reach + 1, False) == order)
        self.text = np.searchsorted(offsets, at, side="right") - 1
        start, end = offsets[self.text], offsets[self.text + 1]
        self.position = at - start
        self.gram = mix(exact[at] ^ U(0x5851F42D4C957F2D))
        a, b = np.maximum(at - reach, start), np.minimum(at + depth, end)
        self.stretch = mix((sums[b] - sums[a]) * inverse[a] + ((at - a) * 1009 + (b - at)).astype(U) * U(0x9FB21C651E98DF25))


def _pack(x: np.ndarray, kind: str) -> bytes:
    return x.astype(kind).tobytes()


def _pack48(x: np.ndarray) -> bytes:
    """The low 48 bits of each number."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _unpack48(parts: list[bytes]) -> np.ndarray:
    raw = np.frombuffer(b"".join(parts), np.uint8).reshape(-1, 6)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :6] = raw
    return out.reshape(-1).view("<u8").astype(U)


_PLACES = "share int, docs binary, of binary, position binary, gram binary, stretch binary, decided boolean"


def _enter(depth: int, gram: int, shares: int, groups: int):
    def send(docs, of, position, key, stretch):
        """Decides among the task's own places, then one row for each range of digits."""
        order = np.lexsort((docs[of], stretch, key))
        of, position, key, stretch = of[order], position[order], key[order], stretch[order]
        head = np.ones(len(of), bool)
        head[1:] = (key[1:] != key[:-1]) | (stretch[1:] != stretch[:-1])
        first = np.flatnonzero(head)[np.cumsum(head) - 1]
        again = docs[of] > docs[of[first]]
        names = [x.split()[0] for x in _PLACES.split(", ")]
        rows = []
        share = ((key >> U(32)) % U(shares)).astype(np.int64)
        for decided in (False, True):
            pick = again == decided
            where = docs[of] % groups % shares if decided else share
            for s, i in _split(where, np.flatnonzero(pick)):
                have, local = np.unique(of[i], return_inverse=True)
                rows.append((int(s), _pack(docs[have], "<i8"), _pack(local, "<u2"), _pack(position[i], "<u4"), None if decided else _pack(key[i] & U(0xFFFFFFFF), "<u4"), None if decided else _pack48(stretch[i]), decided))
        for at in range(0, len(rows), 4096):
            columns = list(zip(*rows[at : at + 4096], strict=True))
            kinds = [pa.int32(), *[pa.binary()] * 5, pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from ._common import blocks

        kept, size, rows = [], 0, 0
        for block in blocks(batches, "text", 1 << 20):
            docs = np.asarray(block.column(0).to_pylist(), np.int64)
            raw, offsets = text_bytes(block.column(1))
            p = Places(raw, offsets, depth, gram)
            kept.append((docs, p.text, p.position, p.gram, p.stretch))
            size += len(raw)
            rows += len(docs)
            if size >= TASK_BYTES or rows > TASK_ROWS:
                yield from send(*_joined(kept))
                kept, size, rows = [], 0, 0
        if kept:
            yield from send(*_joined(kept))

    return run


def _joined(parts):
    base = np.cumsum([0, *(len(p[0]) for p in parts)])
    return (np.concatenate([p[0] for p in parts]), np.concatenate([p[1] + b for p, b in zip(parts, base, strict=False)]), *(np.concatenate([p[k] for p in parts]) for k in (2, 3, 4)))


def _split(keys: np.ndarray, pick: np.ndarray):
    """(key, indices) for each key among the picked."""
    order = pick[np.argsort(keys[pick], kind="stable")]
    if not len(order):
        return
    cuts = np.flatnonzero(np.diff(keys[order])) + 1
    for i in np.split(order, cuts):
        yield keys[i[0]], i


def _arrays(table: pa.Table, name: str, kind: str) -> list[np.ndarray]:
    return [np.frombuffer(x, kind) for x in table[name].to_pylist()]


def _gather(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Document and position of all places of rows that hold docs, of and position."""
    docs = [d[o] for d, o in zip(_arrays(table, "docs", "<i8"), _arrays(table, "of", "<u2"), strict=True)]
    return np.concatenate([np.zeros(0, np.int64), *docs]), np.concatenate([np.zeros(0, np.int64), *_arrays(table, "position", "<u4")]).astype(np.int64)


_DECIDED = "bucket long, whole boolean, doc binary, position binary, key binary"


def _decided_rows(groups: int, doc, position, whole: bool | None, key=None):
    for b, i in _split(doc % groups, np.arange(len(doc))):
        yield int(b), whole, _pack(doc[i], "<i8"), _pack(position[i], "<u4"), None if key is None else _pack(key[i], "<u8")


def _table(rows, schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string()}
    fields = [x.split() for x in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.table({n: pa.array(c, kinds[k]) for (n, k), c in zip(fields, columns, strict=True)})


def _first_digits(groups: int):
    """Of a range of digits: places decided (whole), and places that go on (whole is null), with their gram's key."""

    def run(table: pa.Table) -> pa.Table:
        done = table.filter(table["decided"])
        rows = list(_decided_rows(groups, *_gather(done), True))
        table = table.filter(pa.compute.invert(table["decided"]))
        if table.num_rows:
            doc, position = _gather(table)
            gram = np.concatenate(_arrays(table, "gram", "<u4"))
            stretch = _unpack48(table["stretch"].to_pylist())
            order = np.lexsort((doc, stretch, gram))
            doc, position, gram, stretch = doc[order], position[order], gram[order], stretch[order]
            new_gram = np.ones(len(doc), bool)
            new_gram[1:] = gram[1:] != gram[:-1]
            new_class = new_gram.copy()
            new_class[1:] |= stretch[1:] != stretch[:-1]
            first = np.flatnonzero(new_class)[np.cumsum(new_class) - 1]
            again = doc > doc[first]
            rows += _decided_rows(groups, doc[again], position[again], True)
            of = np.cumsum(new_gram) - 1
            classes = np.bincount(of, weights=new_class)
            starts = np.flatnonzero(new_gram)
            several = (np.maximum.reduceat(doc, starts) > np.minimum.reduceat(doc, starts)) & (classes > 1)
            on = several[of] & ~again
            key = (gram.astype(U) << U(32)) | table["share"][0].as_py()
            rows += _decided_rows(groups, doc[on], position[on], None, key[on])
        return _table(rows, _DECIDED)

    return run


_WINDOWS = "share int, docs binary, position binary, left binary, right binary, key binary, bytes binary"


def _with_bytes(depth: int, gram: int, shares: int):
    """The bytes around the places that go on."""
    reach = depth - gram

    def run(key, texts: pa.Table, places: pa.Table) -> pa.Table:
        rows = []
        if places.num_rows and texts.num_rows:
            doc = np.concatenate(_arrays(places, "doc", "<i8"))
            position = np.concatenate(_arrays(places, "position", "<u4")).astype(np.int64)
            key = np.concatenate(_arrays(places, "key", "<u8"))
            ids = np.asarray(texts["doc_id"].combine_chunks().fill_null(-(1 << 62)), np.int64)
            column = texts["text"].combine_chunks()
            raw, offsets = text_bytes(column.chunk(0) if isinstance(column, pa.ChunkedArray) else column)
            by = np.argsort(ids, kind="stable")
            at = np.minimum(np.searchsorted(ids[by], doc), len(ids) - 1)
            row = by[at]
            here = (ids[row] == doc) & (position + gram <= offsets[row + 1] - offsets[row])
            doc, position, key, row = doc[here], position[here], key[here], row[here]
            left = np.minimum(position, reach)
            right = np.minimum(offsets[row + 1] - offsets[row] - position, depth)
            padded = np.concatenate([np.zeros(reach, np.uint8), raw, np.zeros(depth, np.uint8)])
            start = offsets[row] + position
            for s, i in _split(((key ^ (key >> U(32))) % U(shares)).astype(np.int64), np.arange(len(doc))):
                window = padded[start[i][:, None] + np.arange(reach + depth)]
                rows.append((int(s), _pack(doc[i], "<i8"), _pack(position[i], "<u4"), _pack(left[i], "u1"), _pack(right[i], "u1"), _pack(key[i], "<u8"), window.tobytes()))
        return _table(rows, _WINDOWS)

    return run


def radix_groups(group: np.ndarray, digits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the rows that are equal to another one of their group in all digits, and the group of equals each is in.

    digits: one row of unsigned 64-bit digits for each suffix, most significant first. A pass orders what is left by group
    and digit, splits groups, and drops rows that are alone.
    """
    at = np.arange(len(group))
    for k in range(-1, digits.shape[1]):
        if not len(at):
            break
        digit = digits[at, k] if k >= 0 else group
        order = np.lexsort((digit, group))
        at, group, digit = at[order], group[order], digit[order]
        new = np.ones(len(at), bool)
        new[1:] = (group[1:] != group[:-1]) | (digit[1:] != digit[:-1])
        group = np.cumsum(new) - 1
        more = np.bincount(group)[group] > 1
        at, group = at[more], group[more]
    return at, group


def _last_digits(depth: int, gram: int, groups: int):
    reach = depth - gram
    width = -(-depth // 8) * 8

    def run(table: pa.Table) -> pa.Table:
        doc = np.concatenate(_arrays(table, "docs", "<i8"))
        position = np.concatenate(_arrays(table, "position", "<u4")).astype(np.int64)
        left = np.concatenate(_arrays(table, "left", "u1")).astype(np.int64)
        right = np.concatenate(_arrays(table, "right", "u1")).astype(np.int64)
        key = np.concatenate(_arrays(table, "key", "<u8"))
        data = np.concatenate([x.reshape(-1, reach + depth) for x in _arrays(table, "bytes", "u1")])
        rows = []
        for skip in range(reach + 1):  # windows that start `skip` bytes after the widest one's start
            fits = np.flatnonzero((skip >= reach - left) & (skip + depth - reach <= right))
            if len(fits) < 2:
                continue
            window = np.zeros((len(fits), width), np.uint8)
            window[:, :depth] = data[fits, skip : skip + depth]
            at, group = radix_groups(key[fits], window.view(">u8").astype(U))
            if len(at):
                d = doc[fits[at]]
                least = np.full(group.max() + 1, np.iinfo(np.int64).max)
                np.minimum.at(least, group, d)
                hit = fits[at[d > least[group]]]
                rows.append((doc[hit], position[hit] - reach + skip))
        if rows:
            return _table(list(_decided_rows(groups, np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows]), False)), _DECIDED)
        return _table([], _DECIDED)

    return run


def covered(spans: np.ndarray) -> np.ndarray:
    """Maximal runs of sorted (start, end)."""
    if not len(spans):
        return spans
    ends = np.maximum.accumulate(spans[:, 1])
    new = np.ones(len(spans), bool)
    new[1:] = spans[1:, 0] > ends[:-1]
    starts = np.flatnonzero(new)
    return np.stack([spans[starts, 0], ends[np.append(starts[1:], len(spans)) - 1]], axis=1)


_CUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _cut(depth: int, gram: int, keep_text: bool):
    reach = depth - gram

    def run(key, texts: pa.Table, places: pa.Table) -> pa.Table:
        doc = np.concatenate([np.zeros(0, np.int64), *_arrays(places, "doc", "<i8")])
        position = np.concatenate([np.zeros(0, np.int64), *_arrays(places, "position", "<u4")]).astype(np.int64)
        whole = np.repeat(np.asarray(places["whole"].to_pylist(), bool), [len(x) // 8 for x in places["doc"].to_pylist()])
        start = np.where(whole, np.maximum(position - reach, 0), position)
        end = position + depth
        order = np.lexsort((start, doc))
        doc, spans = doc[order], np.stack([start[order], end[order]], axis=1)
        rows = []
        for doc_id, text in zip(texts["doc_id"].to_pylist(), texts["text"].to_pylist(), strict=True):
            data = text.encode()
            i, j = (np.searchsorted(doc, doc_id), np.searchsorted(doc, doc_id, side="right")) if doc_id is not None else (0, 0)
            runs = covered(np.minimum(spans[i:j], len(data)))
            kept, at = [], 0
            for s, e in runs:
                kept.append(data[at:s])
                at = e
            kept = b"".join([*kept, data[at:]])
            row = (doc_id, len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest())
            rows.append((*row, kept) if keep_text else row)
        return _table(rows, _CUT + ", kept binary" if keep_text else _CUT)

    return run


def suffix_dedup(spark: SparkSession, docs: DataFrame, depth: int = DEPTH, gram: int = GRAM, keep_text: bool = False, scratch: Scratch | None = None) -> DataFrame:
    """Per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and, if asked, the bytes kept).

    A byte goes when a string of `depth` bytes that covers it also starts in a document with a smaller doc_id; strings are
    judged on the input. A null text counts as empty; texts shorter than `depth` lose nothing. A row with a null doc_id
    loses nothing and takes nothing from others. Rows that repeat a doc_id count as one document, which never takes from itself; if their
    texts differ, each loses what any of them would at the same place. An empty table gives an empty result. Columns
    other than doc_id and text are not read.
    """
    scratch = scratch or Scratch(spark)
    texts = id_text(docs)
    stored = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    shares = min(MOST_SHARES, max(16, stored // SHARE_BYTES))
    groups = shares | 1
    places = texts.where("doc_id is not null").mapInArrow(_enter(depth, gram, shares, groups), _PLACES)
    first = scratch.table(places.groupBy("share").applyInArrow(_first_digits(groups), _DECIDED))
    scratch.drop()
    bucketed = texts.withColumn("bucket", F.coalesce(F.pmod("doc_id", F.lit(groups)), F.lit(0)).cast("long"))
    on = first.where("whole is null")
    windows = bucketed.groupBy("bucket").cogroup(on.groupBy("bucket")).applyInArrow(_with_bytes(depth, gram, shares), _WINDOWS)
    last = scratch.table(windows.groupBy("share").applyInArrow(_last_digits(depth, gram, groups), _DECIDED))
    scratch.drop()
    every = first.where("whole").unionByName(last)
    return bucketed.groupBy("bucket").cogroup(every.groupBy("bucket")).applyInArrow(_cut(depth, gram, keep_text), _CUT + ", kept binary" if keep_text else _CUT)
