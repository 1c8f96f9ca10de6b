"""A corpus pipeline: documents go through stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from mediaweave.llm import exact_dedup, minhash, packing, secrets, toxicity
from mediaweave.llm._common import Scratch, documents

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go. It learns from the labels of the documents at hand."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.fit(toxicity.sample(docs, labels)))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return exact_dedup.drop_copies(spark, docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by near-duplicate links (five words, 0.8) the document with the smallest id stays."""
    return minhash.drop_near_duplicates(spark, docs, words=5, percent=80)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are replaced; no document goes."""
    return secrets.redact(spark, docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(spark, docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("minhash_near_dedup", drop_near_copies),
    ("secret_scans", redact_secrets),
    ("best_fit_packing", pack),
]

#: Learned scores, components and packing are beyond SQL; tests hold each stage against a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir))
    return docs
