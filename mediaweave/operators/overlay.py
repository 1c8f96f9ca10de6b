"""Overlays: results made again for selected scenes, laid over those of an earlier run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SCENE = ["media_id", "scene_id"]


def selected_scenes(wanted: DataFrame, available: DataFrame) -> DataFrame:
    """Selected scenes that exist; an error if one repeats or is unknown."""
    twice = wanted.groupBy(*SCENE).count().where("count > 1").select(*SCENE)
    unknown = wanted.join(available, SCENE, "left_anti").select(*SCENE)
    if not twice.unionByName(unknown).isEmpty():
        raise ValueError("selected scenes must be distinct and known")
    return wanted.select(*SCENE)


def overlay(source: DataFrame, selected: DataFrame, scenes: DataFrame) -> DataFrame:
    """Rows of selected scenes from `selected`, all others from `source`, with their provenance."""
    kept = source.join(scenes.select(*SCENE), SCENE, "left_anti").withColumn("provenance", F.lit("source"))
    return selected.join(scenes.select(*SCENE), SCENE, "left_semi").withColumn("provenance", F.lit("selected")).unionByName(kept, allowMissingColumns=True)


def overlay_captions(frames: DataFrame, source: DataFrame, selected: DataFrame, scenes: DataFrame) -> DataFrame:
    """Captions of the overlaid frames: an unselected frame without a source caption, or with one of another file, is an error."""
    key = [*SCENE, "keyframe_index"]
    old = frames.join(scenes.select(*SCENE), SCENE, "left_anti").join(source.select(*key, "caption", "keyframe"), key, "left")
    fault = F.col("caption").isNull() | (F.col("keyframe") != F.col("path"))
    old = old.withColumn("caption", F.when(F.coalesce(fault, F.lit(True)), F.raise_error(F.lit("a source caption is missing or belongs to another frame")).cast("string")).otherwise(F.col("caption")))
    new = frames.join(scenes.select(*SCENE), SCENE, "left_semi").join(selected.select(*key, "caption", "keyframe"), key)
    return new.withColumn("provenance", F.lit("selected")).unionByName(old.withColumn("provenance", F.lit("source")))


def overlay_ocr(frames: DataFrame, source: DataFrame, selected: DataFrame, scenes: DataFrame) -> DataFrame:
    """OCR results of the overlaid frames; an unselected frame without a source result, or with one of another file, has none."""
    key = [*SCENE, "keyframe_index"]
    old = source.join(scenes.select(*SCENE), SCENE, "left_anti").join(frames.select(*key, F.col("path").alias("keyframe")), [*key, "keyframe"], "left_semi")
    return selected.join(scenes.select(*SCENE), SCENE, "left_semi").withColumn("provenance", F.lit("selected")).unionByName(old.withColumn("provenance", F.lit("source")))


def differences(have: DataFrame, want: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Values missing and values unexpected."""
    return want.select(column).subtract(have.select(column)), have.select(column).subtract(want.select(column))


def latest(rows: DataFrame, by: list[str], newest: list[str], n: int = 1) -> DataFrame:
    """The newest n rows of each group."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*(F.col(c).desc() for c in newest)))
    return rows.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")
