import math
import random

from tests.llm import brute
import pytest
from pyspark.sql import functions as F

from mediaweave.llm import exact_dedup, minhash, suffix_dedup


def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


def exact(docs):
    groups = {}
    for i, t in docs:
        groups.setdefault(brute.lower(t or ""), []).append(i)
    return {i: (max(g), len(g)) for g in groups.values() for i in g}


def test_exact(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.exact_dedup(spark, docs).collect()}
    assert got == exact(texts(docs).items())


def test_exact_odd(spark, odd, empty):
    out = exact_dedup.exact_dedup(spark, odd).collect()
    by = {r.doc_id: r for r in out}
    assert len(out) == 17 and by[0].keep_id == 1 and by[3].keep_id == 4 and by[5].keep_id == 9 and by[9].kept and not by[6].kept
    assert exact_dedup.exact_dedup(spark, empty).count() == 0
    assert exact_dedup.drop_copies(spark, odd).columns == odd.columns
    none = spark.createDataFrame([(None, "x"), (None, "x")], "doc_id long, text string")
    assert [r.kept for r in exact_dedup.exact_dedup(spark, none).collect()] == [False, False]


def test_exact_is_native(spark, odd):
    plan = exact_dedup.exact_dedup(spark, odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_heavy_digests_are_found(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"))
    heavy = exact_dedup.heavy_winners(spark, exact_dedup.digests(docs)).collect()
    assert [(r.keep_id, r.group_size) for r in heavy] == [(5997, 2000)]


@pytest.mark.parametrize("words,percent", [(3, 85), (5, 80)])
def test_near(spark, data, words, percent):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(spark, docs, words, percent).collect()}
    assert got == brute.near(texts(docs).items(), words, percent)


def test_a_group_of_near_copies(spark):
    """Many copies of one text with a few words changed: buckets with several components, blocks and chains."""
    r = random.Random(5)
    base = [f"w{r.randrange(400)}" for _ in range(120)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(r.randrange(9)):
            w[r.randrange(len(w))] = f"x{r.randrange(5)}"
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(spark, docs, 3, 85).collect()}
    assert got == brute.near(rows, 3, 85)


def test_near_odd(spark, odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(spark, odd, 3, 85).collect()}
    assert got == brute.near(rows, 3, 85)
    assert minhash.near_duplicates(spark, empty).count() == 0
    kept = minhash.drop_near_duplicates(spark, odd)
    assert kept.columns == odd.columns and kept.where("text = 'a'").count() == 1
    none = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f")], "doc_id long, text string")
    assert {(r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(spark, none).collect()} == {(None, None, True), (1, 1, True)}


def test_sketch_coordinates_fill_and_estimate():
    import numpy as np

    r = np.random.default_rng(1)
    a = r.integers(0, 1 << 52, 900).astype(np.uint64)
    b = np.concatenate([a[:800], r.integers(0, 1 << 52, 100).astype(np.uint64)])
    s = minhash.sketches(np.concatenate([np.zeros(900, int), np.ones(900, int), [2]]), np.concatenate([a, b, a[:1]]), 4)
    assert (s[:3] != np.uint64(0xFFFFFFFFFFFFFFFF)).all() and (s[3] == np.uint64(0xFFFFFFFFFFFFFFFF)).all()
    assert abs((s[0] == s[1]).mean() - 0.8) < 0.12


@pytest.mark.parametrize("depth,gram", [(50, 24), (12, 5)])
def test_suffixes(spark, depth, gram):
    r = random.Random(depth)
    parts = ["".join(r.choice("abcdé ") for _ in range(r.randrange(5, 90))) for _ in range(14)]
    rows = [(i, "".join(r.choice(parts) for _ in range(r.randrange(6)))) for i in range(120)] + [(120, "a" * 500), (121, "a" * 70), (122, None), (123, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in suffix_dedup.suffix_dedup(spark, docs, depth, gram).collect()}
    assert got == brute.cut(rows, depth)


def test_suffixes_odd(spark, odd, empty):
    distinct = odd.dropDuplicates(["doc_id"])
    rows = [(r.doc_id, r.text) for r in distinct.collect()]
    got = {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in suffix_dedup.suffix_dedup(spark, distinct).collect()}
    assert got == brute.cut(rows, 50)
    assert suffix_dedup.suffix_dedup(spark, odd).count() == 17 and suffix_dedup.suffix_dedup(spark, empty).count() == 0


def test_radix_groups():
    import numpy as np

    digits = np.array([[1, 2], [1, 2], [1, 3], [1, 2]], np.uint64)
    at, group = suffix_dedup.radix_groups(np.array([0, 0, 0, 1]), digits)
    assert sorted(at) == [0, 1] and len(set(group)) == 1


@pytest.mark.parametrize("percent", [80, 85])
def test_sketches_miss_a_pair_at_the_threshold_once_in_a_million(percent):
    t, n = percent / 100, minhash.BINS
    below = lambda c: sum(math.comb(n, k) * t**k * (1 - t) ** (n - k) for k in range(c))
    assert below(minhash.least_equal(percent)) <= 1e-6 < below(minhash.least_equal(percent) + 1)


def test_a_repeated_id_keeps_its_other_text(spark):
    docs = spark.createDataFrame([(1, "a", "x"), (1, "b", "y"), (2, "A", "z"), (None, "a", "w"), (3, None, "v"), (4, "", "u")], "doc_id long, text string, text_sha256 string")
    kept = exact_dedup.drop_copies(spark, docs)
    assert kept.columns == docs.columns
    assert {tuple(r) for r in kept.collect()} == {(1, "b", "y"), (2, "A", "z"), (None, "a", "w"), (4, "", "u")}
