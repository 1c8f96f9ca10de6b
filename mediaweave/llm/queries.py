"""The queries of this subpackage, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup as _exact
from . import minhash as _minhash
from . import packing as _packing
from . import pieces as _pieces
from . import pii as _pii
from . import quality as _quality
from . import secrets as _secrets
from . import suffix_dedup as _suffix
from . import token_counts as _counts
from . import toxicity as _toxicity
from ._common import Scratch, documents

Query = Callable[[SparkSession, str], DataFrame]


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pii.find_pii(documents(spark, sf_dir))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exact.exact_dedup(spark, documents(spark, sf_dir))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _secrets.find_secrets(spark, documents(spark, sf_dir))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pieces.encode_and_check(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _toxicity.toxicity(spark, documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _packing.pack(spark, documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat token files of all documents are written first: identifiers of 16 bits, each document ended by </s> (2)."""
    path = f"{Scratch(spark).base}/tokens"
    _counts.write_token_files(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"), 2, path)
    file = F.regexp_extract("file", "part-([0-9]+)", 1).cast("long").alias("file_no")
    return _counts.count_tokens(spark, path, 2).select(file, "doc_no", "start", "n_tokens", "closed")


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _minhash.near_duplicates(spark, documents(spark, sf_dir), words=3, percent=85)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _suffix.suffix_dedup(spark, documents(spark, sf_dir))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quality.weak_quality(spark, documents(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "op1_pii": op1_pii,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_secrets": op3_secrets,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_toxicity": op5_toxicity,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_token_counts": op7_token_counts,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_quality_rules": op10_quality_rules,
}

ORACLE_SQL: dict[str, str] = {
    "op2_exact_dedup": _exact.SQL,
}
