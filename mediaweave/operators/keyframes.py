"""Keyframes of scenes: how many, where, and without near-duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.numeric import hamming, hash_halves, let
from ..functions.text import frame_name

#: Scene lengths in seconds from which there are two and three frames; most differing bits of a duplicate.
THRESHOLDS = (8.0, 20.0)
MAX_DISTANCE = 6


def frame_count(duration: Column, cap: int = 3) -> Column:
    return F.least(F.when(duration < THRESHOLDS[0], 1).when(duration < THRESHOLDS[1], 2).otherwise(3), F.lit(cap))


def candidates(scenes: DataFrame, cap: int = 3) -> DataFrame:
    """Frames at evenly spaced interior points of each scene: candidate_index, candidate_count, timestamp_sec, path."""
    n = frame_count(F.col("end_sec") - F.col("start_sec"), cap)
    out = scenes.withColumn("candidate_count", n).withColumn("candidate_index", F.explode(F.sequence(F.lit(1), F.col("candidate_count"))))
    step = (F.col("end_sec") - F.col("start_sec")) / (F.col("candidate_count") + 1)
    at = F.round(F.col("start_sec") + step * F.col("candidate_index"), 3)
    return out.withColumn("timestamp_sec", at).withColumn("path", frame_name(F.col("scene_id"), F.col("candidate_index"), F.col("candidate_count")))


def greedy_dedup(frames: DataFrame, by: list[str], distance: int = MAX_DISTANCE, order: str = "candidate_index") -> DataFrame:
    """Each frame with `retained`, and for a removed one its nearest retained frame (distance, then index) and the distance.

    Frames are taken in order; one within `distance` bits of a retained frame goes. The choice depends on all before, so it is a
    fold over a group's sorted frames; groups are scenes, and hold a handful of frames.
    """
    row = F.struct(F.col(order).cast("long").alias("at"), hash_halves(F.col("perceptual_hash")).alias("bits"))
    folded = frames.groupBy(*by).agg(F.array_sort(F.collect_list(row)).alias("rows"))
    item = "struct<at:bigint,bits:struct<high:bigint,low:bigint>>"
    kept = F.array().cast(f"array<{item}>")
    gone = F.array().cast("array<struct<at:bigint,distance:int,of:bigint>>")
    start = F.struct(kept.alias("kept"), gone.alias("gone"))

    def nearest(state: Column, x: Column) -> Column:
        return F.array_min(F.transform(state["kept"], lambda k: F.struct(hamming(x["bits"], k["bits"]).cast("int").alias("distance"), k["at"].alias("of"))))

    def step(state: Column, x: Column) -> Column:
        return let(nearest(state, x), lambda near: decide(state, x, near, F.coalesce(near["distance"] <= distance, F.lit(False))))

    def decide(state: Column, x: Column, near: Column, dup: Column) -> Column:
        return F.struct(
            F.when(dup, state["kept"]).otherwise(F.array_append(state["kept"], F.struct(x["at"].alias("at"), x["bits"].alias("bits")))).alias("kept"),
            F.when(dup, F.array_append(state["gone"], F.struct(x["at"].alias("at"), near["distance"].alias("distance"), near["of"].alias("of")))).otherwise(state["gone"]).alias("gone"),
        )

    state = folded.select(*by, F.aggregate("rows", start, step).alias("state"))
    none = F.lit(None)
    stays = state.select(*by, F.explode("state.kept").alias("k")).select(*by, F.col("k.at").alias(order), F.lit(True).alias("retained"), none.cast("int").alias("hamming_distance"), none.cast("long").alias("duplicate_of"))
    goes = state.select(*by, F.explode("state.gone").alias("g")).select(*by, F.col("g.at").alias(order), F.lit(False).alias("retained"), F.col("g.distance").alias("hamming_distance"), F.col("g.of").alias("duplicate_of"))
    return frames.join(stays.unionByName(goes), [*by, order])


def retained_frames(decided: DataFrame, by: list[str], order: str = "candidate_index") -> DataFrame:
    """Retained frames, numbered again from 1, with their new count and name."""
    w = Window.partitionBy(*by)
    out = decided.where("retained").withColumn("keyframe_index", F.row_number().over(w.orderBy(order))).withColumn("keyframe_count", F.count(F.lit(1)).over(w).cast("int"))
    return out.withColumn("path", frame_name(F.col("scene_id"), F.col("keyframe_index"), F.col("keyframe_count"))) if "scene_id" in out.columns else out


def removed_frames(decided: DataFrame, by: list[str], order: str = "candidate_index") -> DataFrame:
    """Removed frames beside the retained frame that each repeats."""
    keep = decided.where("retained").select(*by, F.col(order).alias("duplicate_of"), F.col("timestamp_sec").alias("duplicate_timestamp_sec"))
    return decided.where("not retained").join(keep, [*by, "duplicate_of"])


def dedup_stats(decided: DataFrame, by: list[str]) -> DataFrame:
    return decided.groupBy(*by).agg(F.count(F.lit(1)).alias("candidate_count"), F.count_if("retained").alias("retained_count"), F.count_if(~F.col("retained")).alias("removed_count"))


def nearest_frame(scenes: DataFrame, frames: DataFrame, by: list[str], order: str = "keyframe_index") -> DataFrame:
    """The frame nearest to each scene's middle, the first of equals; scenes without frames are left out."""
    joined = scenes.select(*by, ((F.col("start_sec") + F.col("end_sec")) / 2.0).alias("_mid")).join(frames, by)
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.abs(F.col("timestamp_sec") - F.col("_mid")), order))
    return joined.withColumn("_rank", rank).where("_rank = 1").drop("_rank", "_mid")
