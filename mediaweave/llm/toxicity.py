"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

N-grams of the lower-cased bytes are hashed to BUCKETS. A text's feature is the bucket's log-count ratio where the text has
the n-gram at all, so a long text is judged by what it holds and not by how often. Logistic regression over these
features gives the weights. Fitting uses at most `per_class` labelled rows of each class, picked by a hash of the id, and each
row stands for as many labelled rows of its class as were passed over, so the classes weigh by their true share at every size;
the sample is written to a small table by one scan of the corpus, and fitting reads that table alone. Scoring reads every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import Scratch, blocks, id_text, text_bytes
from ._words import LOWER, U, mix

BUCKETS = 1 << 18
SIZES = (3, 4, 5)
#: Buckets that a model keeps: those whose class difference is clearest.
KEPT = 5_000
#: Least standard deviations of a kept difference.
CLEAR = 6.0
PER_CLASS = 4000
#: Bytes of text whose n-grams are held at once, whatever the length of a text; they bound a worker's memory.
SPAN = 1 << 17
#: Files of the written sample, which are the tasks that fit.
FILES = 8


def _span_keys(raw: np.ndarray, offsets: np.ndarray, lo: int, keep: np.ndarray | None) -> np.ndarray:
    """Sorted distinct text * BUCKETS + bucket of the n-grams that start in a span of SPAN bytes from lo."""
    hi = min(lo + SPAN, len(raw))
    data = LOWER[raw[lo : hi + max(SIZES) - 1]].astype(U) + U(1)
    first, last = np.searchsorted(offsets, [lo, hi], side="right") - 1
    of = np.repeat(np.arange(first, last + 1), np.diff(np.concatenate([[lo], offsets[first + 1 : last + 1], [hi]])))
    left = offsets[np.minimum(of + 1, len(offsets) - 1)] - np.arange(lo, hi)  # bytes to the text's end
    found = []
    for n in SIZES:
        k = min(hi - lo, len(data) - n + 1)
        if k <= 0:
            continue
        h = np.full(k, U(n))
        for j in range(n):
            h *= U(0x100000001B3)
            h += data[j : j + k] * U(0x9E3779B97F4A7C15)
        bucket = (mix(h) >> U(64 - BUCKETS.bit_length() + 1)).astype(np.int64)
        good = left[:k] >= n
        if keep is not None:
            good &= keep[bucket]
        found.append(of[:k][good] * BUCKETS + bucket[good])
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def gram_buckets(raw: np.ndarray, offsets: np.ndarray, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, bucket) of all n-grams of a block, of those buckets that `keep` marks; n-grams stay inside a text.

    The block is read span by span, so a long text needs no more room than the distinct buckets it has, which are BUCKETS at most.
    """
    parts = [_span_keys(raw, offsets, lo, keep) for lo in range(0, len(raw), SPAN)]
    held, done = [], []
    for k, keys in enumerate(parts):  # only a text that goes on into the next span can give a key again
        held.append(keys)
        open_ = int(np.searchsorted(offsets, min((k + 1) * SPAN, len(raw)), side="left")) - 1
        merged = np.unique(np.concatenate(held)) if len(held) > 1 else keys
        at = np.searchsorted(merged, open_ * BUCKETS)
        done.append(merged[:at])
        held = [merged[at:]]
    keys = np.concatenate([np.zeros(0, np.int64), *done, *held])
    return keys // BUCKETS, keys % BUCKETS


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # BUCKETS floats, 0 for buckets left out
    bias: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        raw, offsets = text_bytes(texts)
        of, bucket = gram_buckets(raw, offsets, self.weights != 0)
        total = np.bincount(of, weights=self.weights[bucket], minlength=len(texts)) + self.bias
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def bucket_of(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; 0 marks held-out rows."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5


def sample(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, text, toxic and weight (labelled rows of the class for each row taken) of at most per_class training rows of each class.

    The corpus is scanned once, by as many tasks as it has splits; what they find, 2 * per_class rows, is written to FILES files.
    """
    clean = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (bucket_of(F.col("doc_id")) != 0)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("doc_id", F.lit(17)), "doc_id"]
    few = clean.where("toxic = 1").orderBy(*order).limit(per_class).union(clean.where("toxic = 0").orderBy(*order).limit(per_class))
    share = clean.groupBy("toxic").agg(F.greatest(F.count(F.lit(1)) / per_class, F.lit(1.0)).alias("weight"))  # two rows
    few = few.join(F.broadcast(share), "toxic")
    found = id_text(docs).join(F.broadcast(few), "doc_id").select("doc_id", "text", "toxic", "weight")
    return (scratch or Scratch(docs.sparkSession)).table(found.repartition(FILES, "doc_id"))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((2, BUCKETS), np.int64)
    rows = np.zeros(2, np.int64)
    for block in blocks(batches, size=SPAN):
        toxic = np.asarray(block.column(2).to_pylist(), np.int64)
        of, bucket = gram_buckets(*text_bytes(block.column(1)))
        for c in (0, 1):
            total[c] += np.bincount(bucket[toxic[of] == c], minlength=BUCKETS)
            rows[c] += (toxic == c).sum()
    if rows.sum():
        yield pa.RecordBatch.from_arrays([pa.array([x.astype("<i4").tobytes() for x in total], pa.binary()), pa.array([0, 1]), pa.array(rows)], ["counts", "toxic", "n"])


def fit(train: DataFrame, rounds: int = 300, ridge: float = 1.0) -> Model:
    """Fits on rows (doc_id, text, toxic, and a weight unless all weigh the same), which are a bounded sample. With one class or none, scores are that class's share."""
    few = train.select("doc_id", "text", "toxic", "weight" if "weight" in train.columns else F.lit(1.0).alias("weight"))
    parts = few.mapInArrow(_counts, "counts binary, toxic long, n long").collect()  # two rows of fixed size for each task
    df, n = np.zeros((2, BUCKETS)), np.zeros(2)
    for p in parts:
        df[p["toxic"]] += np.frombuffer(p["counts"], "<i4")
        n[p["toxic"]] += p["n"]
    if not n.all():
        return Model(np.zeros(BUCKETS), 0.0 if not n.sum() else 3.0 if n[1] else -3.0)
    rate = (df + 1) / (n[:, None] + 2)
    ratio = np.log(rate[1] / rate[0])
    pooled = df.sum(axis=0) / n.sum()
    clear = np.abs(df[1] / n[1] - df[0] / n[0]) / np.sqrt(pooled * (1 - pooled) * (1 / n[0] + 1 / n[1]) + 1e-9)
    keep = np.zeros(BUCKETS, bool)
    keep[np.argsort(-clear, kind="stable")[:KEPT]] = True
    keep &= clear > CLEAR

    kept = np.flatnonzero(keep)  # KEPT at most, so a place among them has 16 bits
    place = np.zeros(BUCKETS, "<u2")
    place[kept] = np.arange(len(kept))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, size=SPAN):
            of, bucket = gram_buckets(*text_bytes(block.column(1)), keep)
            ends = np.searchsorted(of, np.arange(block.num_rows + 1))
            at = place[bucket]
            yield pa.RecordBatch.from_arrays([block.column(0), pa.array(block.column(2).to_pylist(), pa.int64()), block.column(3), pa.array([at[ends[i] : ends[i + 1]].tobytes() for i in range(block.num_rows)], pa.binary())], ["doc_id", "toxic", "weight", "places"])

    rows = sorted(few.mapInArrow(features, "doc_id long, toxic long, weight double, places binary").collect(), key=lambda r: r["doc_id"])  # 2 * per_class rows of KEPT places at most
    y = np.array([r["toxic"] for r in rows], float)
    # both classes weigh by their true share among labelled rows, whatever the sample took of each
    weight = np.array([r["weight"] for r in rows])
    weight /= weight.mean()
    parts = []  # (first row, rows, row of each place, places), a thousand rows each
    for first in range(0, len(rows), 1000):
        columns = [np.frombuffer(r["places"], "<u2") for r in rows[first : first + 1000]]
        parts.append((first, len(columns), np.repeat(np.arange(len(columns), dtype=np.uint16), [len(c) for c in columns]), np.concatenate(columns)))
    del rows, columns
    ratio = ratio[kept]
    w, b = np.zeros(len(kept)), float(np.log(weight[y == 1].sum() / weight[y == 0].sum()))
    m1, m2, mb, vb = np.zeros(len(kept)), np.zeros(len(kept)), 0.0, 0.0
    for t in range(1, rounds + 1):
        scaled = w * ratio
        total = np.concatenate([np.bincount(of, weights=scaled[at], minlength=n) for _, n, of, at in parts])
        p = 1 / (1 + np.exp(-np.clip(total + b, -30, 30)))
        g = weight * (p - y) / len(y)
        grad = sum(np.bincount(at, weights=g[first : first + n][of], minlength=len(kept)) for first, n, of, at in parts) * ratio + ridge / len(y) * w
        gb = g.sum()
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.99 * m2 + 0.01 * grad * grad
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        step = 0.02
        w -= step * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.99**t)) + 1e-8)
        b -= step * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.99**t)) + 1e-8)
    weights = np.zeros(BUCKETS)
    weights[kept] = w * ratio
    return Model(weights, b)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted, per input row; a null or empty text gets the score of no n-grams at all."""
    used = np.flatnonzero(model.weights)
    pairs, bias = (used, model.weights[used]), model.bias

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.zeros(BUCKETS)
        weights[pairs[0]] = pairs[1]
        m = Model(weights, bias)
        for block in blocks(batches, size=2 * SPAN):
            yield pa.RecordBatch.from_arrays([block.column(0), pa.array(m.scores(block.column(1)))], ["doc_id", "score"])

    out = id_text(docs).mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", (bucket_of(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """Fits on the labelled rows outside of the held-out fold and scores every row of docs.

    Null labels and labels other than 0 and 1 are left out; a document with both counts as toxic. Repeated rows get equal
    scores; an empty table gives an empty result. Columns other than doc_id and text are not read.
    """
    return score(docs, fit(sample(docs, labels, per_class, Scratch(spark))))


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs that the model does not call toxic (score under 0.5), with all their columns.

    A null or empty text has the score of no n-grams at all; its row comes out as it went in. Rows are judged one by one, so repeated rows
    and repeated ids are all kept or all dropped by their texts; an empty table stays empty. Columns other than text are passed on unread.
    """
    at = docs.columns.index("text")
    used = np.flatnonzero(model.weights)
    pairs, bias = (used, model.weights[used]), model.bias

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.zeros(BUCKETS)
        weights[pairs[0]] = pairs[1]
        m = Model(weights, bias)
        for block in blocks(batches, "text", 2 * SPAN):
            yield block.filter(pa.array(m.scores(block.column(at).fill_null("")) < 0.5))

    plain = docs.withColumn("text", F.col("text").cast("string"))
    return plain.mapInArrow(run, plain.schema)
