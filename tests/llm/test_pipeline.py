import duckdb
import pyarrow as pa

import corpus_pipeline
from mediaweave.llm import queries, toxicity
from mediaweave.llm._common import Scratch
from tests.llm import brute


def redacted(text):
    """The text with every run of overlapping base secrets replaced."""
    out, end = [], 0
    for _, a, b in sorted(brute.spans(text, brute.SECRET), key=lambda x: x[1:]):
        if a >= end:
            out += [text[end:a], "[SECRET]"]
        end = max(end, b)
    return "".join([*out, text[end:]])


def test_stages_against_plain_versions(spark, data):
    """Each stage on all that its predecessor kept: what the classifier calls clean, the last of equal texts, the first of each
    component of brute-force links, texts without base secrets, and every token in a sequence."""
    docs = spark.read.parquet(f"{data}/documents.parquet")
    labels = spark.read.parquet(f"{data}/labels.parquet")
    scratch, columns = Scratch(spark), docs.columns
    before = {r.doc_id: r.text for r in docs.collect()}
    model = toxicity.fit(toxicity.sample(docs, labels))
    ids = sorted(before)
    clean = {i for i, p in zip(ids, model.scores(pa.array([before[i] or "" for i in ids])), strict=True) if p < 0.5}
    want = {"toxicity": lambda x: {i: t for i, t in x.items() if i in clean}}
    want["exact_dedup"] = lambda x: {i: x[i] for i in {brute.lower(t or ""): i for i, t in sorted(x.items())}.values()}
    want["minhash_near_dedup"] = lambda x: {i: x[i] for i, (_, part) in brute.near(sorted(x.items()), 5, 80).items() if i == part}
    want["secret_scans"] = lambda x: {i: t and redacted(t) for i, t in x.items()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, data))
        assert docs.columns == columns, name
        now = {r.doc_id: r.text for r in docs.collect()}
        assert now == want[name](before) and len(now) > 0.8 * len(before), name
        before = now
    out = corpus_pipeline.STAGES[-1][1](spark, docs, data)
    assert {r.doc_id for r in out.select("doc_id").distinct().collect()} == set(before)


def test_stages_of_odd_and_empty_tables(spark, data, odd, empty):
    for docs in (odd, empty):
        scratch, n = Scratch(spark), docs.count()
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = scratch.table(stage(spark, docs, data))
            assert out.columns == docs.columns and out.count() <= docs.count(), name
            docs = out
        kept = {r.doc_id for r in docs.collect()}
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, data).collect()
        assert {r.doc_id for r in packed} == kept and (n == 0 or 14 in kept and 0 < len(kept) < 16)


def test_sql_gives_the_rows(spark, data):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{data}/documents.parquet'")
    for name, sql in queries.ORACLE_SQL.items():
        want = con.execute(sql).df()
        got = queries.QUERIES[name](spark, data).toPandas()[list(want.columns)]
        key = list(want.columns)
        assert got.sort_values(key).values.tolist() == want.sort_values(key).values.tolist()
