"""Speech segments, transcripts, speaker turns and audio events: what surrounds the models' answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .intervals import gap_merge, overlap_merge

MEDIA = ["media_id"]

# Canonical labels by ranges (first, last) of the model's 527 classes. A class in several takes the first label listed.
LABELS = (
    ("laughter", ((16, 21),)),
    ("applause", ((63, 63), (67, 67))),
    ("music", ((27, 37), (137, 282))),
    ("animal", ((72, 136),)),
    ("alarm", ((310, 310), (388, 388), (395, 395), (398, 400))),
    ("siren", ((323, 325), (396, 397))),
    ("vehicle", ((300, 342),)),
    ("door", ((354, 363),)),
    ("impact", ((419, 419), (426, 443), (460, 461), (465, 470))),
    ("noise", ((513, 523),)),
)
CLASSES = 527
# Names that certain classes must have, which show that a model uses the known class order.
ANCHORS = {0: "Speech", 16: "Laughter", 63: "Clapping", 67: "Applause", 72: "Animal", 137: "Music", 282: "Scary music", 300: "Vehicle", 354: "Door", 388: "Alarm", 396: "Siren", 426: "Explosion", 513: "Noise", 526: "Field recording"}


def canonical_label(index: Column) -> Column:
    return F.coalesce(*(F.when(_within(index, ranges), F.lit(label)) for label, ranges in LABELS))


def _within(index: Column, ranges) -> Column:
    out = F.lit(False)
    for first, last in ranges:
        out = out | index.between(first, last)
    return out


def label_mapping(spark: SparkSession, names: dict[int, str]) -> DataFrame:
    """class_index and label of the classes that have a canonical one; an error unless the model has the known class order."""
    if set(names) != set(range(CLASSES)) or any(names[i] != want for i, want in ANCHORS.items()):
        raise ValueError("the model's classes are not the known 527 in their order")
    classes = spark.range(CLASSES).select(F.col("id").cast("int").alias("class_index"))
    return classes.withColumn("label", canonical_label(F.col("class_index"))).where("label is not null")


def pooled_labels(scores: DataFrame, mapping: DataFrame, least: float) -> DataFrame:
    """The greatest class score of each window and canonical label, to 6 places, where it is at least `least`.

    scores: media_id, window_id, start_sec, end_sec, scores (array by class). mapping has at most 527 rows.
    """
    each = scores.select(*MEDIA, "window_id", "start_sec", "end_sec", F.posexplode("scores").alias("class_index", "score"))
    pooled = each.join(F.broadcast(mapping), "class_index").groupBy(*MEDIA, "window_id", "start_sec", "end_sec", "label").agg(F.round(F.max("score"), 6).alias("confidence"))
    return pooled.where(F.col("confidence") >= least)


def audio_events(labels: DataFrame, least: float) -> DataFrame:
    """Events of windows' labels at or above the threshold."""
    return overlap_merge(labels.where(F.col("confidence") >= least), MEDIA)


def invalid_results(results: DataFrame, allowed: list[str]) -> DataFrame:
    """Windows whose labels are not allowed or repeat, or whose confidence is outside 0..1. results: window_id, labels (array of label, confidence)."""
    names = F.transform("labels", lambda x: x["label"])
    bad = (F.size(F.array_except(names, F.array(*map(F.lit, allowed)))) > 0) | (F.size(F.array_distinct(names)) < F.size(names))
    bad = bad | F.exists("labels", lambda x: x["confidence"].isNull() | F.isnan(x["confidence"]) | ~x["confidence"].between(0, 1))
    return results.where(bad)


def vad_totals(segments: DataFrame, media: DataFrame) -> DataFrame:
    """speech_sec and its share of total_sec (0 where that is 0), to 3 places. media: media_id, total_sec."""
    sums = segments.groupBy(*MEDIA).agg(F.sum("duration_sec").alias("_speech"), F.count(F.lit(1)).alias("segment_count"))
    out = media.join(sums, MEDIA, "left")
    speech = F.coalesce("_speech", F.lit(0.0))
    ratio = F.when(F.col("total_sec") == 0, 0.0).otherwise(speech / F.nullif(F.col("total_sec"), F.lit(0.0)))
    return out.select(*MEDIA, "total_sec", F.coalesce("segment_count", F.lit(0)).alias("segment_count"), F.round(speech, 3).alias("speech_sec"), F.round(ratio, 3).alias("speech_ratio"))


def vad_consistency(segments: DataFrame, totals: DataFrame, slack: float = 0.002) -> DataFrame:
    """Whether the reported sum, ratio and last end agree with the segments, within the slack."""
    own = segments.groupBy(*MEDIA).agg(F.sum("duration_sec").alias("_sum"), F.max("end_sec").alias("_last"), F.count(F.lit(1)).alias("_n"))
    x = totals.join(own, MEDIA, "left").withColumns({"_sum": F.coalesce("_sum", F.lit(0.0)), "_n": F.coalesce("_n", F.lit(0)), "_last": F.coalesce("_last", F.lit(0.0))})
    share = F.when(F.col("total_sec") > 0, F.col("speech_sec") / F.nullif(F.col("total_sec"), F.lit(0.0))).otherwise(0.0)
    return x.select(
        *MEDIA,
        (F.abs(F.col("_sum") - F.col("speech_sec")) <= F.greatest(slack * F.col("_n"), F.lit(slack))).alias("sum_ok"),
        (F.abs(share - F.col("speech_ratio")) <= slack).alias("ratio_ok"),
        (F.col("_last") <= F.col("total_sec") + slack).alias("end_ok"),
    )


def speech_chunks(segments: DataFrame, max_gap: float = 0.5) -> DataFrame:
    return gap_merge(segments, MEDIA, max_gap)


def absolute_transcript(raw: DataFrame, chunks: DataFrame) -> DataFrame:
    """Transcript segments on the medium's axis: chunk-relative times shifted (3 places), probabilities to 4, empty texts dropped, ids from 1.

    raw: media_id, chunk_id, start_sec, end_sec, text, avg_logprob, no_speech_prob.
    """
    at = chunks.select(*MEDIA, "chunk_id", F.col("start_sec").alias("_from"), F.col("source_ids").alias("vad_source_ids"))
    x = raw.join(at, [*MEDIA, "chunk_id"]).withColumn("text", F.trim("text")).where("text <> ''")
    x = x.withColumns({"start_sec": F.round(F.col("_from") + F.col("start_sec"), 3), "end_sec": F.round(F.col("_from") + F.col("end_sec"), 3), "avg_logprob": F.round("avg_logprob", 4), "no_speech_prob": F.round("no_speech_prob", 4)})
    place = F.row_number().over(Window.partitionBy(*MEDIA).orderBy("start_sec", "chunk_id", "end_sec"))
    return x.withColumn("segment_id", place).drop("_from")


def speakers(turns: DataFrame) -> DataFrame:
    return turns.groupBy(*MEDIA).agg(F.sort_array(F.collect_set("speaker")).alias("speakers"))


def batches(rows: DataFrame, by: list[str], order: list[str], provider_most: int, configured: int) -> DataFrame:
    """Ordered batches of at most the smaller of the two sizes: batch (from 0)."""
    size = max(1, min(provider_most, configured))
    return rows.withColumn("batch", F.floor((F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1) / size))


def usage(batch_log: DataFrame) -> DataFrame:
    """Summed units and times over batches, and the batches' sizes in order."""
    sizes = F.transform(F.array_sort(F.collect_list(F.struct("batch", "n"))), lambda x: x["n"])
    return batch_log.groupBy(*MEDIA).agg(F.sum("n").alias("input_count"), F.sum("total_sec").alias("total_sec"), F.sum("inference_sec").alias("inference_sec"), sizes.alias("batch_sizes"))
