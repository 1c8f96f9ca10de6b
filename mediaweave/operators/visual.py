"""Captions and on-screen text: grouping, triggers, validation and word tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SCENE = ["media_id", "scene_id"]
FRAME = [*SCENE, "keyframe_index"]

#: Words in a caption that speak for on-screen text, in order of preference.
HINTS = ("subtitle", "presentation", "document", "writing", "words", "title", "text", "sign", "screen", "slide", "menu", "label")


def caption_hint(caption: Column) -> Column:
    """The first hint that stands in the caption as a word of its own, or with an s."""
    low = F.lower(caption)
    return F.coalesce(*(F.when(low.rlike(f"(?<![a-z0-9]){h}s?(?![a-z0-9])"), F.lit(h)) for h in HINTS))


def ocr_candidates(keyframes: DataFrame, captions: DataFrame) -> DataFrame:
    """Keyframes whose caption has a hint, with it."""
    hints = captions.withColumn("trigger_hint", caption_hint(F.col("caption"))).where("trigger_hint is not null").select(*FRAME, "trigger_hint").dropDuplicates(FRAME)
    return keyframes.join(hints, FRAME)


def caption_groups(captions: DataFrame) -> DataFrame:
    """Per scene: captions in order, and how many."""
    rows = F.array_sort(F.collect_list(F.struct("keyframe_index", "timestamp_sec", "keyframe", "caption")))
    return captions.groupBy(*SCENE).agg(F.count(F.lit(1)).alias("caption_count"), rows.alias("captions"))


def numbered_frames(frames: DataFrame) -> DataFrame:
    """Frames with an index and a count in their scene where they have none, and whether given indices run from 1."""
    w = Window.partitionBy(*SCENE)
    place = F.row_number().over(w.orderBy("timestamp_sec"))
    given = F.col("keyframe_index") if "keyframe_index" in frames.columns else F.lit(None)
    return frames.withColumns({"contiguous": F.coalesce(given == place, F.lit(True)), "keyframe_index": F.coalesce(given, place), "keyframe_count": F.count(F.lit(1)).over(w).cast("int")})


def valid_captions(answers: DataFrame) -> DataFrame:
    """Trimmed captions; rows without text are invalid answers and are marked."""
    text = F.trim("caption")
    return answers.withColumn("caption", text).withColumn("valid", F.coalesce(text != "", F.lit(False)))


def zip_answers(inputs: DataFrame, answers: DataFrame, key: list[str]) -> DataFrame:
    """Inputs beside the answer of the same key. The row `complete` is false for an input without an answer, which a
    caller must not accept; answers travel with their key, so order never matters."""
    return inputs.join(answers.withColumn("complete", F.lit(True)), key, "left").withColumn("complete", F.coalesce("complete", F.lit(False)))


def ocr_words(tsv: DataFrame, least: float = 0.0) -> DataFrame:
    """Words of an OCR engine's table: level 5, with text, confidence (0..1) at least `least`; region_id in order of rows.

    tsv: image_id, row (order), level, block_num, par_num, line_num, left, top, width, height, conf, text. A box outside of
    the plane is an error.
    """
    word, conf = F.trim("text"), F.col("conf").cast("double") / 100.0
    x = tsv.where((F.col("level") == 5) & (word != "") & ~F.isnan(F.col("conf").cast("double")) & (F.col("conf") >= 0) & (conf >= least))
    bad = (F.least("left", "top") < 0) | (F.col("width") < 1) | (F.col("height") < 1)
    x = x.withColumn("left", F.when(bad, F.raise_error(F.lit("a word's box is not valid")).cast("int")).otherwise(F.col("left")))
    place = F.row_number().over(Window.partitionBy("image_id").orderBy("row"))
    box = F.struct(F.col("left").alias("x"), F.col("top").alias("y"), "width", "height")
    return x.select("image_id", "row", "block_num", "par_num", "line_num", place.alias("region_id"), word.alias("text"), F.round(conf, 6).alias("confidence"), box.alias("bbox"))


def ocr_text(words: DataFrame) -> DataFrame:
    """Per image: the words of a line joined by spaces, lines in order of their first word, and the regions."""
    texts = lambda rows: F.transform(F.array_sort(rows), lambda x: x["text"])
    line = words.groupBy("image_id", "block_num", "par_num", "line_num").agg(F.min("row").alias("row"), F.array_join(texts(F.collect_list(F.struct("row", "text"))), " ").alias("text"))
    text = line.groupBy("image_id").agg(F.array_join(texts(F.collect_list(F.struct("row", "text"))), "\n").alias("text"))
    regions = words.groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct("region_id", "text", "confidence", "bbox"))).alias("regions"))
    return text.join(regions, "image_id")


def confident(results: DataFrame, least: float) -> DataFrame:
    """Results without the regions under a confidence, numbered again; the text of a result that lost some is that of the others, in order."""
    kept = F.filter("regions", lambda r: r["confidence"] >= least)
    text = F.when(F.size(kept) < F.size("regions"), F.array_join(F.transform(kept, lambda r: r["text"]), " ")).otherwise(F.col("text"))
    return results.withColumns({"text": text, "regions": F.transform(kept, lambda r, i: r.withField("region_id", (i + 1).cast("int")))})


def region_faults(results: DataFrame) -> DataFrame:
    """Images with a region that breaks the contract: ids from 1 in order, text, confidence 0..1, a box inside the image.

    results: image_id, image_width, image_height, regions.
    """
    def bad(r: Column, i: Column) -> Column:
        b = r["bbox"]
        out = (r["region_id"] != i + 1) | (F.trim(r["text"]) == "") | ~r["confidence"].between(0, 1)
        return out | (b["x"] < 0) | (b["y"] < 0) | (b["width"] < 1) | (b["height"] < 1) | (b["x"] + b["width"] > F.col("image_width")) | (b["y"] + b["height"] > F.col("image_height"))

    marks = F.transform("regions", lambda r, i: F.coalesce(bad(r, i), F.lit(True)))
    return results.where(F.exists(marks, lambda m: m))


def ocr_counts(results: DataFrame) -> DataFrame:
    return results.groupBy("media_id").agg(F.count(F.lit(1)).alias("image_count"), F.count_if(F.trim("text") != "").alias("text_frame_count"), F.sum(F.size("regions").cast("long")).alias("region_count"))
