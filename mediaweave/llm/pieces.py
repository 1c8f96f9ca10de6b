"""SentencePiece encoding and decoding by suffix-array matching.

A batch's text is cut where no piece of the model can join: before a space that follows something else, around line feeds, and, in
what is still long, between two characters that stand side by side in no piece. Its
distinct units that are not remembered are laid on end and indexed by a suffix array, ordered as deep as the longest piece. Every
piece of the vocabulary is looked up by binary search; its range of the array holds all its occurrences. The occurrences
are edges from a position over some characters; sorted by position, they are relaxed into each unit's segmentation.

The order of relaxation is the model's: in a BPE model an edge may only join two neighbours that stand already, the edge of best
score first and the leftmost of equals, until none applies. Characters without a piece become their bytes' pieces.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._common import blocks, id_text

SPACE = "▁"
#: Characters that one suffix array indexes, units remembered by a worker, and the longest unit that is remembered or relaxed with others.
INDEXED = 400_000
REMEMBERED = 250_000
LONGEST = 48


def _vector_bisect(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, want: np.ndarray, right: bool) -> np.ndarray:
    lo, hi = lo.copy(), hi.copy()
    while (open_ := lo < hi).any():
        mid = (lo + hi) // 2
        have = values[np.minimum(mid, len(values) - 1)]
        up = (have <= want if right else have < want) & open_
        lo = np.where(up, mid + 1, lo)
        hi = np.where(open_ & ~up, mid, hi)
    return lo


class Pieces:
    """A BPE model with byte fallback, read from its file."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        if model.trainer_spec.model_type != proto.TrainerSpec.BPE or spec.precompiled_charsmap or spec.remove_extra_whitespaces or not model.trainer_spec.byte_fallback:
            raise ValueError("a BPE model with byte fallback and without text normalisation is needed")
        self.prefix = spec.add_dummy_prefix
        kinds = proto.ModelProto.SentencePiece
        self.text = [p.piece for p in model.pieces]
        self.byte_id = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE}
        self.raw = [b"" if p.type in (kinds.CONTROL, kinds.UNKNOWN) else bytes([int(p.piece[3:5], 16)]) if p.type == kinds.BYTE else p.piece.replace(SPACE, " ").encode() for p in model.pieces]
        normal = [(p.piece, p.score, i) for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL]
        self.char_id = {t: i for t, _, i in normal if len(t) == 1}
        joined = sorted((-score, i, t) for t, score, i in normal if len(t) > 1)
        if any(SPACE in t.lstrip(SPACE) for _, _, t in joined):
            raise ValueError("a piece holds a space after other characters")
        #: Joined pieces in the order in which edges are relaxed; an edge's number is its place here, from 1.
        self.joined = [t for _, _, t in joined]
        self.joined_id = np.array([0, *(i for _, i, _ in joined)], np.int64)
        self.deepest = max(map(len, self.joined))
        letters = sorted({c for t in self.joined for c in t})
        self.code = {c: k for k, c in enumerate(letters, 1)}
        self.bits = len(letters).bit_length()
        self.per = 63 // self.bits
        self.words = -(-self.deepest // self.per)
        self.lookup = np.zeros(0x110000 + 1, np.int64)
        for c, k in self.code.items():
            self.lookup[ord(c)] = k
        self.feed_cuts = "\n" not in self.code
        self.unit = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n" if self.feed_cuts else f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        #: Neighbours that some piece holds; a long unit is cut between any others.
        self.pairs = np.unique(np.array([ord(a) << 21 | ord(b) for t in self.joined for a, b in zip(t, t[1:], strict=False)], np.int64))
        codes = np.zeros((len(self.joined), self.words * self.per), np.int64)
        for k, t in enumerate(self.joined):
            codes[k, : len(t)] = [self.code[c] for c in t]
        self.lengths = np.array([len(t) for t in self.joined])
        filled = np.where(np.arange(codes.shape[1]) < self.lengths[:, None], codes, (1 << self.bits) - 1)
        self.low, self.high = (self._keys_of(x) for x in (codes, filled))
        self.known: dict[str, bytes] = {}

    def _keys_of(self, codes: np.ndarray) -> list[np.ndarray]:
        out = []
        for w in range(self.words):
            key = np.zeros(len(codes), np.int64)
            for j in range(self.per):
                key = (key << self.bits) | codes[:, w * self.per + j]
            out.append(key)
        return out

    def edges(self, points: np.ndarray) -> np.ndarray:
        """table[position, length]: the number of the joined piece that starts there with that length, 0 for none."""
        n = len(points)
        code = np.concatenate([self.lookup[points], np.zeros(self.words * self.per, np.int64)])
        first = np.zeros(n + self.words * self.per, np.int64)
        for j in range(self.per):
            first[: len(code) - j] |= code[j:] << (self.bits * (self.per - 1 - j))
        keys = [first[w * self.per : w * self.per + n] for w in range(self.words)]
        suffixes = np.lexsort(keys[::-1])
        ordered = [k[suffixes] for k in keys]
        lo, hi = np.zeros(len(self.joined), np.int64), np.full(len(self.joined), n)
        for w in range(self.words):
            go = np.flatnonzero((self.lengths > w * self.per) & (lo < hi))
            if w == 0:
                a, b = np.searchsorted(ordered[0], self.low[0][go]), np.searchsorted(ordered[0], self.high[0][go], side="right")
            else:
                a = _vector_bisect(ordered[w], lo[go], hi[go], self.low[w][go], False)
                b = _vector_bisect(ordered[w], lo[go], hi[go], self.high[w][go], True)
            lo[go], hi[go] = a, b
        count = np.maximum(hi - lo, 0)
        piece = np.repeat(np.arange(len(self.joined)), count)
        where = suffixes[np.repeat(lo - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(len(piece))]
        table = np.zeros((n, self.deepest + 1), np.int32)
        # edges by position: a row of the table is a position, a column a length
        by = np.argsort(where, kind="stable")
        table[where[by], self.lengths[piece[by]]] = piece[by] + 1
        return table

    def _relax_long(self, table: np.ndarray, start: int, n: int) -> list[tuple[int, int]]:
        """(position, length) of a long unit's symbols, by a queue of edges."""
        size, after, before = [1] * n, list(range(1, n + 1)), list(range(-1, n - 1))
        queue: list[tuple[int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and size[i] + size[j] <= self.deepest and (k := int(table[start + i, size[i] + size[j]])):
                heapq.heappush(queue, (k, i, size[i] + size[j]))

        for i in range(n):
            offer(i)
        while queue:
            _, i, both = heapq.heappop(queue)
            j = after[i] if size[i] else n
            if j >= n or size[i] + size[j] != both:
                continue
            size[i], size[j] = both, 0
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [(start + i, s) for i, s in enumerate(size) if s]

    def _relax(self, table: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Unit, position and length of the symbols of many short units, one join of each unit in a round."""
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        unit = np.repeat(np.arange(len(starts)), sizes)
        at = np.arange(len(unit)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts, sizes)
        size = np.ones(len(unit), np.int64)
        while len(unit):
            both = size.copy()
            both[:-1] += size[1:]
            pair = np.zeros(len(unit), bool)
            pair[:-1] = (unit[1:] == unit[:-1]) & (both[:-1] <= self.deepest)
            number = np.where(pair, table[at, np.where(pair, both, 0)], 0).astype(np.int64)
            rank = np.where(number > 0, (number << 32) | np.arange(len(unit)), np.int64(1) << 62)
            head = np.flatnonzero(np.diff(unit, prepend=-1))
            best = np.minimum.reduceat(rank, head)
            joins = best < (np.int64(1) << 62)
            counts = np.diff(np.append(head, len(unit)))
            if not joins.all():
                over = ~np.repeat(joins, counts)
                done.append((unit[over], at[over], size[over]))
            i = best[joins] & 0xFFFFFFFF
            keep = np.repeat(joins, counts)
            size[i] = both[i]
            keep[i + 1] = False
            unit, at, size = unit[keep], at[keep], size[keep]
        out = [np.concatenate(x) for x in zip(*done, strict=True)] if done else [np.zeros(0, np.int64)] * 3
        order = np.lexsort((out[1], out[0]))
        return out[0][order], out[1][order], out[2][order]

    def _learn(self, units: list[str], into: dict[str, bytes]) -> None:
        """Ids of distinct units, as unsigned 16- or 32-bit little-endian bytes."""
        sizes = np.array([len(u) for u in units], np.int64)
        text = "\0".join(units)
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        starts = np.cumsum(sizes + 1) - sizes - 1
        points[starts[1:] - 1] = 0x110000  # a separator that no piece holds
        table = self.edges(points)
        short = np.flatnonzero(sizes <= LONGEST)
        unit, at, size = self._relax(table, starts[short], sizes[short])
        unit = short[unit]
        for k in np.flatnonzero(sizes > LONGEST):
            found = np.array(self._relax_long(table, int(starts[k]), int(sizes[k])), np.int64)
            unit, at, size = np.append(unit, np.full(len(found), k)), np.append(at, found[:, 0]), np.append(size, found[:, 1])
        order = np.argsort(unit, kind="stable")
        unit, at, size = unit[order], at[order], size[order]
        ids = self.joined_id[table[at, size]]
        single = size == 1
        chars, back = np.unique(points[at[single]], return_inverse=True)
        own = [self.char_id.get(chr(c), -1) for c in chars]
        ids[single] = np.array(own, np.int64)[back] if len(own) else 0
        bounds = np.searchsorted(unit, np.arange(len(units) + 1))
        flat = ids.astype("<u4")
        raw = flat.tobytes()
        lost = set(unit[ids < 0].tolist())
        for k, u in enumerate(units):
            if k in lost:
                out = []
                for i in range(bounds[k], bounds[k + 1]):
                    out += [ids[i]] if ids[i] >= 0 else [self.byte_id[b] for b in chr(points[at[i]]).encode("utf-8", "surrogatepass")]
                into[u] = np.array(out, "<u4").tobytes()
            else:
                into[u] = raw[4 * bounds[k] : 4 * bounds[k + 1]]

    def _parts(self, unit: str) -> list[str]:
        """A long unit, cut where no piece spans; joins on one side cannot reach the other."""
        points = np.frombuffer(unit.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        ends = np.flatnonzero(~np.isin(points[:-1] << 21 | points[1:], self.pairs)) + 1
        return [unit[a:b] for a, b in zip([0, *ends.tolist()], [*ends.tolist(), len(unit)], strict=True)]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        cut = [self.unit.findall((SPACE if self.prefix else "") + t.replace(" ", SPACE)) if t else [] for t in texts]
        cut = [[p for u in units for p in (self._parts(u) if len(u) > LONGEST else (u,))] if units and max(map(len, units)) > LONGEST else units for units in cut]
        known = self.known
        missing = {u for units in cut for u in units if u not in known}
        once: dict[str, bytes] = {}
        group: list[str] = []
        total = 0
        for u in sorted(missing):
            group.append(u)
            total += len(u) + 1
            if total >= INDEXED:
                self._learn(group, once)
                group, total = [], 0
        if group:
            self._learn(group, once)
        if len(known) + len(once) > REMEMBERED:
            # forget all but what this batch brings
            for units in cut:
                for u in units:
                    if u not in once:
                        once[u] = known[u]
            known.clear()
        out = [b"".join([once[u] if u in once else known[u] for u in units]) for units in cut]
        known.update((u, x) for u, x in once.items() if len(u) <= LONGEST)
        return out

    def decode(self, ids: np.ndarray) -> str:
        raw = b"".join([self.raw[i] for i in ids.tolist()])
        text = raw.decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    """One per worker process, so that units stay remembered between tasks."""
    return Pieces(path)


_ENCODED = "doc_id long, n_ids long, ids binary"
_CHECKED = "doc_id long, n_ids long, ids_sha256 string, round_trip boolean"


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_ids and ids (little-endian unsigned 32-bit) of every whole text.

    A null or empty text has no ids; repeated rows give repeated results; an empty table gives an empty result. Columns
    other than doc_id and text are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for block in blocks(batches):
            ids = model.encode_batch(block.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([block.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())], ["doc_id", "n_ids", "ids"])

    return id_text(docs).mapInArrow(run, _ENCODED)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of rows of ids. A character that is the model's own space sign comes back as a space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for b in batches:
            texts = [model.decode(np.frombuffer(x or b"", "<u4")) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def encode_and_check(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_ids, ids_sha256 (of the little-endian unsigned 32-bit ids) and whether decoding gives the text again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for block in blocks(batches):
            texts = block.column(1).to_pylist()
            ids = model.encode_batch(texts)
            same = [model.decode(np.frombuffer(x, "<u4")) == t for x, t in zip(ids, texts, strict=True)]
            yield pa.RecordBatch.from_arrays([block.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in ids]), pa.array(same)], ["doc_id", "n_ids", "ids_sha256", "round_trip"])

    return id_text(docs).mapInArrow(run, _CHECKED)
