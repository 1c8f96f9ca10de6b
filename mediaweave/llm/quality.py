"""Quality rules combined by weak supervision.

Each rule votes good, bad or abstains. Votes are counted per pattern of votes (at most 3**rules patterns, whatever the
number of documents), expectation-maximisation over all documents' patterns estimates how often each rule is right and
the share of good documents, and the posterior of a pattern replaces the requirement that all rules pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import Scratch, blocks, id_text, text_bytes
from ._words import Words, grams

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_BLANK = " \t\n\x0b\x0c\r"

_MEASURES = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_letters long, n_chars long, n_symbol_runs long"


def duplicate_lines(text: str) -> tuple[int, int]:
    """Lines with a word that equal an earlier line; lines with a word."""
    if "\n" not in text:
        return 0, int(bool(text.strip(_BLANK)))
    lines = [x for x in text.split("\n") if x.strip(_BLANK)]
    return len(lines) - len(set(lines)), len(lines)


def repeated_words(words: Words) -> np.ndarray:
    """Per text: words inside windows of WINDOW words that the text has twice or more, its first occurrence included."""
    out = np.zeros(len(words.offsets) - 1, np.int64)
    hashes = grams(words.hashes(), WINDOW)
    if not len(hashes):
        return out
    at = words.text[: len(hashes)]
    whole = np.flatnonzero(at == words.text[WINDOW - 1 :])
    bits = np.uint64(max(1, (len(out) - 1).bit_length()))
    keys = (at[whole].astype(np.uint64) << (np.uint64(64) - bits)) | (hashes[whole] >> bits)
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return out
    near = np.searchsorted(twice, keys)
    near[near == len(twice)] = 0
    heads = whole[twice[near] == keys]
    edge = np.zeros(len(words.text) + 1, np.int64)
    np.add.at(edge, heads, 1)
    np.add.at(edge, heads + WINDOW, -1)
    covered = np.cumsum(edge[:-1]) > 0
    return np.bincount(words.text[covered], minlength=len(out))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches):
        texts = block.column(1)
        raw, offsets = text_bytes(texts)
        words = Words(raw, offsets)

        def per_text(marks: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
            return sums[offsets[1:]] - sums[offsets[:-1]]

        points = (raw & 0xC0) != 0x80
        runs = _SYMBOL[raw]
        runs[1:] &= raw[1:] == raw[:-1]
        runs[:1] = False
        lines = [duplicate_lines(t) for t in texts.to_pylist()]
        letters = ((raw | 0x20) >= 97) & ((raw | 0x20) <= 122) | (raw >= 0xC0)
        columns = [words.counts, per_text(points & words.inside), per_text(_SYMBOL[raw]), [x[0] for x in lines], repeated_words(words), [x[1] for x in lines], per_text(letters), per_text(points), per_text(runs)]
        yield pa.RecordBatch.from_arrays([block.column(0), *(pa.array(np.asarray(c, np.int64)) for c in columns)], ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_chars", "n_symbol_runs"])


def measures(docs: DataFrame) -> DataFrame:
    """The counts that the rules look at, per row; a null text has none."""
    return id_text(docs).mapInArrow(_measure, _MEASURES)


@dataclass(frozen=True)
class Rule:
    """Votes bad where `bad` holds, else good where `good` holds, else abstains."""

    name: str
    bad: Column
    good: Column

    def vote(self) -> Column:
        return F.when(self.bad, F.lit(-1)).when(self.good, F.lit(1)).otherwise(F.lit(0))


def rules() -> list[Rule]:
    c = F.col
    words, chars, lines = c("n_words"), c("n_chars"), c("n_lines")
    return [
        Rule("length", words < 20, words >= 50),
        Rule("word_length", (c("word_chars") < 2 * words) | (c("word_chars") > 14 * words), (c("word_chars") >= 3 * words) & (c("word_chars") <= 10 * words)),
        Rule("symbols", 10 * c("n_symbols") > words, 50 * c("n_symbols") <= words),
        Rule("symbol_runs", 20 * c("n_symbol_runs") > words, 200 * c("n_symbol_runs") <= words),
        Rule("letters", 100 * c("n_letters") < 65 * chars, 100 * c("n_letters") >= 70 * chars),
        Rule("lines", 2 * c("n_dup_lines") > lines, 10 * c("n_dup_lines") <= lines),
        Rule("repeats", 100 * c("n_repeat_words") > 25 * words, 10 * c("n_repeat_words") <= words),
    ]


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[float, np.ndarray]:
    """Expectation-maximisation over distinct vote patterns: the share of good documents, and hit[c, rule], how often a rule that
    votes is right about a bad (c = 0) and a good (c = 1) document. That a rule abstains says nothing about a document.

    One right and one wrong pseudo-vote smooth each rate, and a rule is never taken to be worse than chance. Classes keep their meaning: a document starts
    as good by the mean of its votes.
    """
    against, for_ = patterns == -1, patterns == 1
    good = 1 / (1 + np.exp(-2.0 * patterns.sum(axis=1)))
    share, hit = 0.5, np.full((2, patterns.shape[1]), 0.7)
    for _ in range(rounds):
        was = good
        weight = np.stack([(1 - good) * counts, good * counts])
        share = (weight[1].sum() + 1) / (counts.sum() + 2)
        right = np.stack([weight[0] @ against, weight[1] @ for_])
        hit = np.clip((right + 1) / (weight @ (against | for_) + 2), 0.5, 1 - 1e-6)
        good = posterior(patterns, share, hit)
        if np.abs(good - was).max() < 1e-9:
            break
    return share, hit


def posterior(patterns: np.ndarray, share: float, hit: np.ndarray) -> np.ndarray:
    """Probability that a document with a pattern is good."""
    yes = np.log(hit[1]) - np.log1p(-hit[0])
    no = np.log1p(-hit[1]) - np.log(hit[0])
    logit = np.log(share / (1 - share)) + (patterns == 1) @ yes + (patterns == -1) @ no
    return 1 / (1 + np.exp(-np.clip(logit, -700, 700)))


def weak_quality(spark: SparkSession, docs: DataFrame, floor: float = 0.5, scratch: Scratch | None = None) -> DataFrame:
    """Per input row: doc_id, the base counts, base_failed, good (posterior probability of quality) and kept.

    A null or empty text has no words: it fails the base rules. Rows are judged one by one, so repeated ids and
    texts are judged alike; an empty table gives an empty result. Columns other than doc_id and text are not read.
    """
    scratch = scratch or Scratch(spark)
    votes = rules()
    pattern = F.concat_ws(",", *(r.vote().cast("string") for r in votes))
    rows = scratch.table(measures(docs).withColumn("pattern", pattern))
    found = rows.groupBy("pattern").count().collect()  # at most 3 ** len(votes) rows
    table = "pattern string, good double"
    if found:
        patterns = np.array([[int(v) for v in r["pattern"].split(",")] for r in found])
        share, hit = fit(patterns, np.array([r["count"] for r in found], float))
        by = spark.createDataFrame([(r["pattern"], float(p)) for r, p in zip(found, posterior(patterns, share, hit), strict=True)], table)
    else:
        by = spark.createDataFrame([], table)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    out = rows.join(F.broadcast(by), "pattern", "left").withColumn("base_failed", failed)
    kept = ~F.col("base_failed") & (F.col("good") >= floor)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "good")
