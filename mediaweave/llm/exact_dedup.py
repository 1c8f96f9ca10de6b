"""Exact deduplication with a heavy-hitter split, in DataFrame operations only.

A Misra-Gries summary (Spark's frequent-items sketch: bounded counters, mergeable, no frequent item missed)
names the digests that may be frequent. Their exact sizes and winners are counted with map-side combining, and
at most HEAVY verified winners are broadcast, so rows of frequent digests are decided where they are read.
The digests that remain are rare by the summary's bound, and go through an ordinary shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._common import Scratch

#: Most winners broadcast, and counters of the summary. A digest with over rows * 2 / COUNTERS copies is in the summary; of those the
#: HEAVY most frequent are winners, so a digest left to the shuffle has rows / HEAVY copies at most.
HEAVY = 256
COUNTERS = 2048

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """Lower case for A-Z alone; null counts as empty."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def digests(docs: DataFrame, *more: str) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2(normalised(F.col("text")), 256).alias("text_sha256"), *more)


def heavy_winners(spark: SparkSession, keyed: DataFrame) -> DataFrame:
    """text_sha256, keep_id, group_size of the frequent digests: HEAVY rows at most, counted exactly."""
    item = F.expr(f"approx_top_k(text_sha256, {HEAVY}, {COUNTERS})")
    frequent = keyed.agg(item.alias("top")).select(F.explode("top").alias("top")).select(F.col("top.item").alias("text_sha256"), F.col("top.count").alias("about")).where("about > 1").select("text_sha256")
    return (
        keyed.join(F.broadcast(frequent), "text_sha256", "left_semi")
        .groupBy("text_sha256")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1")
    )


def exact_dedup(spark: SparkSession, docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest doc_id stays. Null text counts as empty; a null doc_id never wins unless all
    of a group are null, and then none of the group is marked kept; rows that repeat the kept doc_id are all kept, so
    callers give distinct ids. An empty table gives an empty result. Columns other than doc_id and text are not read.
    """
    scratch = scratch or Scratch(spark)
    keyed = scratch.table(digests(docs))
    winners = scratch.table(heavy_winners(spark, keyed))
    heavy = keyed.join(F.broadcast(winners), "text_sha256")
    group = Window.partitionBy("text_sha256")
    rest = keyed.join(F.broadcast(winners.select("text_sha256")), "text_sha256", "left_anti").withColumns({"keep_id": F.max("doc_id").over(group), "group_size": F.count(F.lit(1)).over(group)})
    return heavy.unionByName(rest).select("doc_id", "keep_id", "group_size", F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"), "text_sha256")


def drop_copies(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with all their columns.

    A row goes when its own text has a copy with a larger doc_id, so of an id that repeats with several texts each text is judged by
    itself; rows that repeat the staying id and text all stay, and so do rows with a null doc_id. Null text counts as empty; an empty table stays
    empty. Only ids and digests of rows that go are joined, so that texts are not shuffled unless Spark must.
    """
    gone = exact_dedup(spark, docs).where("not kept and doc_id is not null")
    gone = gone.groupBy(F.col("doc_id").alias("_id")).agg(F.collect_set("text_sha256").alias("_shas"))  # an id's texts; digests are made of rows with such an id alone
    own = (F.col("doc_id").cast("long") == F.col("_id")) & F.array_contains("_shas", F.sha2(normalised(F.col("text")), 256))
    return docs.join(gone, own, "left_anti").select(*docs.columns)


SQL = f"""
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT d.doc_id, g.keep_id, g.group_size, coalesce(d.doc_id = g.keep_id, false) AS kept, d.text_sha256
FROM d JOIN g USING (text_sha256)
"""
