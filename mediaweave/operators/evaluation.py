"""Retrieval metrics over evaluation cases."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

#: Bytes of an evaluation set's passages.
PASSAGE_BYTES = 64 << 20


def passage_matches(spark: SparkSession, docs: DataFrame, passages: DataFrame) -> DataFrame:
    """case_id, doc_key: the documents (doc_key, text) that hold a passage (case_id, text) word for word.

    One pass over the documents by an automaton of all passages, in time linear in the texts whatever the number of passages. The passages are
    gathered on the driver: an evaluation set of at most PASSAGE_BYTES; a larger one is an error. Empty and null passages are held by none.
    """
    size = passages.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    if size > PASSAGE_BYTES:
        raise ValueError(f"passages of {size} bytes; an evaluation set has {PASSAGE_BYTES} at most")
    by_text: dict[str, list] = {}
    for r in passages.where("text <> ''").select("case_id", "text").collect():
        by_text.setdefault(r["text"], []).append(r["case_id"])
    items = list(by_text.items())
    names = spark.createDataFrame([(k, c) for k, (_, cases) in enumerate(items) for c in cases], StructType([StructField("passage", LongType()), StructField("case_id", passages.schema["case_id"].dataType)]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for k, (text, _) in enumerate(items):
            automaton.add_word(text, k)
        automaton.make_automaton()
        for batch in batches:
            found = [sorted({k for _, k in automaton.iter(t)}) if t else [] for t in batch.column(1).to_pylist()]
            at = [i for i, x in enumerate(found) for _ in x]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array([k for x in found for k in x], pa.int64())], ["doc_key", "passage"])

    if not items:
        return docs.select("doc_key").join(passages.select("case_id"), F.lit(False)).select("case_id", "doc_key")
    hits = docs.select("doc_key", "text").mapInArrow(run, f"doc_key {docs.schema['doc_key'].dataType.simpleString()}, passage long")
    return hits.join(F.broadcast(names), "passage").select("case_id", "doc_key")


def case_results(cases: DataFrame, relevant: DataFrame, matches: DataFrame) -> DataFrame:
    """Per case: recall, reciprocal rank of the first relevant match, and whether nothing was returned.

    cases: case_id. relevant: case_id, doc_key, none for a no-answer case. matches: case_id, doc_key, rank.
    """
    wanted = relevant.select("case_id", "doc_key").distinct()
    count = wanted.groupBy("case_id").agg(F.count(F.lit(1)).alias("wanted"))
    hit = matches.join(wanted, ["case_id", "doc_key"]).groupBy("case_id").agg(F.countDistinct("doc_key").alias("hits"), F.min("rank").alias("first"))
    some = matches.select("case_id").distinct().withColumn("answered", F.lit(True))
    out = cases.select("case_id").join(count, "case_id", "left").join(hit, "case_id", "left").join(some, "case_id", "left")
    n = F.coalesce("wanted", F.lit(0))
    return out.select(
        "case_id",
        (n == 0).alias("expected_no_answer"),
        F.col("answered").isNull().alias("predicted_no_answer"),
        F.when(n == 0, 0.0).otherwise(F.coalesce("hits", F.lit(0)) / F.nullif(n, F.lit(0))).alias("recall_at_k"),
        F.coalesce(1.0 / F.col("first"), F.lit(0.0)).alias("reciprocal_rank"),
    )


def report(results: DataFrame) -> DataFrame:
    """One row of means; the mean of nothing is 0."""
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    answer, none, guess = ~F.col("expected_no_answer"), F.col("expected_no_answer"), F.col("predicted_no_answer")
    return results.agg(
        F.count(F.lit(1)).alias("case_count"),
        F.count_if(answer).alias("answer_case_count"),
        F.count_if(none).alias("no_answer_case_count"),
        F.coalesce(F.avg(F.when(answer, F.col("recall_at_k"))), F.lit(0.0)).alias("recall_at_k"),
        F.coalesce(F.avg(F.when(answer, F.col("reciprocal_rank"))), F.lit(0.0)).alias("mean_reciprocal_rank"),
        ratio(F.count_if(guess & none), F.count_if(guess)).alias("no_answer_precision"),
        ratio(F.count_if(guess & none), F.count_if(none)).alias("no_answer_recall"),
    )
