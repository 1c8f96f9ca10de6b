"""Near-duplicate detection by fast similarity sketching, banding and exact verification.

A text's set holds the hashes of its distinct word shingles. Its sketch has BINS coordinates, filled by rounds of hashed
bin placement: in round i < BINS each element falls into one hashed bin with a value that orders first by round, and in
round BINS + j each element falls into bin j, so after 2 * BINS rounds every coordinate is full, and the number of equal
coordinates of two sketches is concentrated around their Jaccard similarity.

Sketches are cut into bands. Texts that share a band meet in a bucket. Each bucket first compares its members with a leader,
drawn by a hash so that a text meets many leaders over its bands; texts that are verified to be alike join one component.
Buckets that still hold several components are worked through in blocks of bounded size: members outside of the largest
component are compared with the others, by sketches and then by their whole sets, closest first, and a pair that is already
connected is passed over, so a block gives fewer links than it has rows. So every pair that shares a bucket is ruled
out by its sketches, verified, or known to be connected, without a bucket's pairs being listed. Texts with one and the same set
meet no buckets: one stands for all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import BLOCK_ROWS, Scratch, blocks, id_text, text_bytes
from ._words import LOWER, U, Words, grams, mix

BINS, BANDS, ROWS = 128, 25, 5
#: The low bits of a shingle's hash make room for the text's number in a block, so that one sort serves a block.
_SPARE = U(BLOCK_ROWS.bit_length() - 1)
#: Largest chance that a pair exactly at the asked similarity is passed over for its sketches, in the binomial model.
MISSED = 1e-6
#: Members of a bucket on each side of a block.
SIDE = 1024
_FULL = U(0xFFFFFFFFFFFFFFFF)


def least_equal(percent: int) -> int:
    """The most equal coordinates that may be asked of two sketches so that a pair at the threshold is missed with MISSED at most."""
    t, below, k = percent / 100, 0.0, 0
    while k < BINS and (below := below + math.comb(BINS, k) * t**k * (1 - t) ** (BINS - k)) <= MISSED:
        k += 1
    return k


def shingle_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of a block of texts: the text's number and the hash of each distinct shingle, sorted by both.

    A text with fewer words than n, but some, has one shingle, of all its words.
    """
    raw, offsets = text_bytes(texts)
    words = Words(LOWER[raw], offsets)
    hashes = words.hashes()
    of, values = [], []
    for k in range(1, n + 1):
        have = grams(hashes, k) + U(k * 0x9E3779B9)
        at = words.text[: len(have)]
        whole = words.counts[at] >= k if k == n else words.counts[at] == k
        good = whole & (at == words.text[k - 1 :][: len(have)]) if len(have) else np.zeros(0, bool)
        of.append(at[good])
        values.append(have[good])
    keys = np.unique((np.concatenate(of).astype(U) << (U(64) - _SPARE)) | (np.concatenate(values) >> _SPARE))
    return (keys >> (U(64) - _SPARE)).astype(np.int64), keys & (_FULL >> _SPARE)


def sketches(of: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """n rows of BINS coordinates; a text without elements has full ones."""
    out = np.full(n * BINS, _FULL, U)
    for i in range(2 * BINS):
        if i < BINS:
            x = mix(values + U((i + 1) * 0xA24BAED4963EE407 % (1 << 64)))
            where = of * BINS + (x & U(BINS - 1)).astype(np.int64)
        else:
            x = mix(values + U((i + 1) * 0xA24BAED4963EE407 % (1 << 64)))
            where = of * BINS + (i - BINS)
        np.minimum.at(out, where, (U(i) << U(56)) | (x >> U(8)))
        open_ = (out.reshape(n, BINS) == _FULL).any(axis=1)
        still = open_[of]
        if not still.any():
            break
        if not still.all():
            of, values = of[still], values[still]
    return out.reshape(n, BINS)


def _signs(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            n = block.num_rows
            of, values = shingle_sets(block.column(1), words)
            counts = np.bincount(of, minlength=n)
            sketch = sketches(of, values, n)
            ends = np.concatenate([[0], np.cumsum(counts)])
            sums = [np.concatenate([np.zeros(1, U), np.cumsum(mix(values * U(k) + U(k)))]) for k in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
            a, b = (s[ends[1:]] - s[ends[:-1]] for s in sums)
            keys = np.empty((n, BANDS), U)
            for k in range(BANDS):
                part = sketch[:, k * ROWS : (k + 1) * ROWS]
                h = np.full(n, U(k + 1))
                for j in range(ROWS):
                    h = mix(h * U(0x9E3779B97F4A7C15) + part[:, j])
                keys[:, k] = h
            yield pa.RecordBatch.from_arrays(
                [
                    block.column(0),
                    pa.array(counts.astype(np.int64)),
                    pa.array(a.view(np.int64)),
                    pa.array(b.view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, n * BANDS + 1, BANDS, dtype=np.int32)), pa.array(keys.reshape(-1).view(np.int64))),
                    pa.array([r.tobytes() for r in keys], pa.binary()),
                    pa.array([r.tobytes() for r in (mix(sketch) >> U(56)).astype(np.uint8)], pa.binary()),
                ],
                ["doc_id", "n_shingles", "set_a", "set_b", "bands", "keys", "sketch"],
            )

    return run


_SIGNS = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, keys binary, sketch binary"


def _alike(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                left, right = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint8).reshape(-1, BINS) for i in (2, 3))
                yield b.select([0, 1]).filter(pa.array((left == right).sum(axis=1) >= least))

    return run


def _set_bytes(values: np.ndarray) -> bytes:
    """48 bits of each hash; sets keep their order and, but for one chance in many millions, their size."""
    return np.ascontiguousarray((values >> U(4)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _set_values(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view("<u8").astype(np.int64)


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            of, values = shingle_sets(block.column(1), words)
            ends = np.searchsorted(of, np.arange(block.num_rows + 1))
            yield pa.RecordBatch.from_arrays([block.column(0), pa.array([_set_bytes(values[ends[i] : ends[i + 1]]) for i in range(block.num_rows)], pa.binary())], ["rep", "members"])

    return run


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, of two whole sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def _verified(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = [linked(_set_values(x), _set_values(y), percent) for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
            yield b.select([0, 1]).filter(pa.array(good, pa.bool_()))

    return run


def _block_links(rows: list[tuple], least: int, percent: int) -> list[tuple[int, int]]:
    """Links between components of a block's rows (bucket, i, j, side, component, outer, lead, band, sketch, keys, members).

    Rows of side 0, or the outer ones where there are none, are compared with those of side 1. A pair is left to the first bucket that it shares.
    """
    side, part = np.array([r[3] for r in rows]), np.array([r[4] for r in rows])
    outer, lead, band = np.array([r[5] for r in rows]), np.array([r[6] for r in rows]), rows[0][7]
    sketch = np.frombuffer(b"".join(r[8] for r in rows), np.uint8).reshape(-1, BINS)
    keys = np.frombuffer(b"".join(r[9] for r in rows), "<i8").reshape(-1, BANDS)
    right = np.flatnonzero((side == 1) & ~lead)
    left = np.flatnonzero((side == 0) & ~lead)
    if not len(left):
        left = right[outer[right]]
    same_as, found = [], []
    for y in left:
        same = (sketch[right] == sketch[y]).sum(axis=1)
        fits = (same >= least) & (part[right] != part[y])
        z = right[fits]
        own = ~(keys[z, :band] == keys[y, :band]).any(axis=1)
        same_as.append(same[fits][own])
        found.append(np.stack([np.full(own.sum(), y), z[own]], axis=1))
    if not found:
        return []
    pairs = np.concatenate(found)[np.argsort(-np.concatenate(same_as), kind="stable")]
    root = {c: c for c in part.tolist()}

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    sets: dict[int, np.ndarray] = {}
    out = []
    for y, z in pairs.tolist():
        a, b = find(int(part[y])), find(int(part[z]))
        if a != b:
            for x in (y, z):
                if x not in sets:
                    sets[x] = _set_values(rows[x][10])
            if linked(sets[y], sets[z], percent):
                out.append((int(part[y]), int(part[z])))
                root[max(a, b)] = min(a, b)
    return out


def _blocks_links(least: int, percent: int):
    """Of rows sorted by block: the links of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows = None, []

        def flush():
            links = _block_links(rows, least, percent) if len(rows) > 1 else []
            if links:
                a, b = zip(*links, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:3] != at:
                    yield from flush()
                    at, rows = row[:3], []
                rows.append(row)
        yield from flush()

    return run


def components(scratch: Scratch, edges: DataFrame, start: DataFrame | None = None) -> DataFrame:
    """node, component: the smallest node reachable over edges (a, b); nodes without an edge are left out.

    Labels fall to the least among neighbours, then along labels (pointer jumping), until none changes.
    """
    both = scratch.table(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct())
    labels = scratch.table(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("component")))
    while True:
        heard = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("component").alias("least"))
        lower = labels.join(heard, labels.node == heard.a).select("node", F.col("component").alias("was"), F.least("component", "least").alias("component"))
        far = labels.select(F.col("node").alias("at"), F.col("component").alias("beyond"))
        new = scratch.table(lower.join(far, F.col("component") == F.col("at"), "left").select("node", "was", F.least("component", "beyond").alias("component")))
        labels = new.select("node", "component")
        if new.where("was <> component").isEmpty():
            return labels


def near_duplicates(spark: SparkSession, docs: DataFrame, words: int = 5, percent: int = 80, scratch: Scratch | None = None) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Texts are linked when 100 * intersection >= percent * union of their sets of shingles of `words` words, in lower case
    for A-Z; component_id is the smallest doc_id reachable over links, kept says that it is the row's own. Texts that are
    null, empty or without words have an empty set and are linked with nothing. A null doc_id is linked with nothing and
    kept with a null component. Rows that repeat a doc_id count as one document. Columns other than doc_id and text are not read.
    """
    scratch = scratch or Scratch(spark)
    texts = id_text(docs)
    signs = scratch.table(texts.mapInArrow(_signs(words), _SIGNS))
    same = ["set_a", "set_b", "n_shingles"]
    sets = scratch.table(signs.where("n_shingles > 0 and doc_id is not null").groupBy(*same).agg(F.min("doc_id").alias("rep")))
    # a document id may come twice with other texts: its first row by set speaks for the band keys
    reps = signs.select(*same, "doc_id", "bands", "keys", "sketch").join(sets, same).where("doc_id = rep").dropDuplicates([*same])
    reps = scratch.table(reps.select("rep", "bands", "keys", "sketch"))
    keyed = reps.select("rep", F.posexplode("bands").alias("band", "bucket"))
    draw = F.min(F.struct(F.xxhash64("rep", "bucket").alias("draw"), "rep"))
    shared = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), draw["rep"].alias("first")).where("n > 1")
    members = scratch.table(keyed.join(shared, "bucket").select("bucket", "band", "rep", "first", "n", (F.col("rep") == F.col("first")).alias("lead")))
    wanted = members.select("rep").distinct()
    bodies = scratch.table(texts.join(wanted.hint("shuffle_hash"), texts.doc_id == wanted.rep).select("rep", "text").dropDuplicates(["rep"]).mapInArrow(_sets(words), "rep long, members binary"))
    least = least_equal(percent)
    side = lambda df, value, name: df.select(F.col("rep").alias(name), F.col(value).alias(f"{value}_{name}"))
    first = members.where("not lead").select(F.least("first", "rep").alias("a"), F.greatest("first", "rep").alias("b")).distinct()
    near = first.join(side(reps, "sketch", "a"), "a").join(side(reps, "sketch", "b"), "b").select("a", "b", "sketch_a", "sketch_b").mapInArrow(_alike(least), "a long, b long")
    near = scratch.table(near)
    links = near.join(side(bodies, "members", "a"), "a").join(side(bodies, "members", "b"), "b").select("a", "b", "members_a", "members_b").mapInArrow(_verified(percent), "a long, b long")
    parts = components(scratch, links)

    now = members.where("n > 2").join(parts.withColumnRenamed("node", "rep"), "rep", "left").select("bucket", "band", "rep", "lead", F.coalesce("component", "rep").alias("component"))
    size = now.groupBy("bucket", "component").count().groupBy("bucket").agg(F.max(F.struct("count", "component")).alias("main"), F.sum("count").alias("n"), F.count(F.lit(1)).alias("parts"))
    split = size.where("parts > 1").select("bucket", F.col("main.component").alias("main"), F.ceil(F.col("n") / SIDE).alias("across"), F.ceil((F.col("n") - F.col("main.count")) / SIDE).alias("down"))
    rows = now.join(split, "bucket").withColumn("outer", F.col("component") != F.col("main"))
    rows = scratch.table(rows)
    cell = lambda value, i, j: ["rep", "bucket", i, j, F.lit(value).alias("side"), "component", "outer", "lead", "band"]
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    rows_of = F.pmod(F.xxhash64("rep", F.lit(1)), F.col("down"))
    columns_of = F.pmod(F.xxhash64("rep", F.lit(2)), F.col("across"))
    left = rows.where("outer and across * down > 1").select(*cell(0, rows_of.alias("i"), every("across").alias("j")))
    right = rows.select(*cell(1, every("down").alias("i"), columns_of.alias("j")))
    tiles = left.unionByName(right).join(reps.select("rep", "sketch", "keys"), "rep").join(bodies, "rep").drop("rep")
    tiled = tiles.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    more = components(scratch, tiled.select("bucket", "i", "j", "side", "component", "outer", "lead", "band", "sketch", "keys", "members").mapInArrow(_blocks_links(least, percent), "a long, b long"))
    # components of components: what the blocks linked
    joined = parts.select("node", F.col("component").alias("part")).join(more.select(F.col("node").alias("part"), "component"), "part", "left").select("node", F.coalesce("component", "part").alias("component"))
    parts = joined.unionByName(more.join(parts.select("node"), "node", "left_anti"))
    named = sets.join(parts.withColumnRenamed("node", "rep"), "rep", "left").select(*same, F.coalesce("component", "rep").alias("component"))
    out = signs.select("doc_id", *same).join(named, same, "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id")).withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs that stay, one document of each component, with all their columns.

    The smallest doc_id of a component stays. Documents without words (null, empty or blank text) and rows with a null doc_id all stay.
    Rows that repeat a doc_id are one document, so they stay or go together; an empty table stays empty.
    """
    gone = near_duplicates(spark, docs, words, percent).where("not kept").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
