"""Readers of what media tools write: probe results, scene scores, subtitles, chapters, word tables and audio."""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf
from pyspark.sql.window import Window

from ..functions.numeric import frame_rate, wav_duration
from ..functions.text import optional_text, plain_text_udf, vtt_seconds

MEDIA = ["media_id"]

PROBE = "struct<format:struct<duration:string,size:string,format_name:string>,streams:array<struct<index:int,codec_type:string,codec_name:string,width:int,height:int,avg_frame_rate:string,r_frame_rate:string,sample_rate:string,channels:int,tags:map<string,string>,disposition:map<string,int>>>,chapters:array<struct<id:string,start_time:string,end_time:string,tags:map<string,string>>>>"

#: Subtitle codecs that hold text.
TEXT_CODECS = ("ass", "mov_text", "ssa", "srt", "subrip", "text", "ttml", "webvtt")


def probed(raw: DataFrame) -> DataFrame:
    """media_id and the parsed probe result. raw: media_id, json."""
    return raw.select(*MEDIA, "json", F.from_json("json", PROBE, {"mode": "FAILFAST"}).alias("p"))


def streams_of(kind: str) -> Column:
    return F.filter("p.streams", lambda s: s["codec_type"] == kind)


def metadata(raw: DataFrame) -> DataFrame:
    """The summary of each medium: the first video and audio stream, length, size, numbers of subtitle tracks and chapters, and the raw result."""
    x = probed(raw)
    video, audio = F.try_element_at(streams_of("video"), F.lit(1)), F.try_element_at(streams_of("audio"), F.lit(1))
    v = F.when(video.isNotNull(), F.struct(video["codec_name"].alias("codec"), video["width"].alias("width"), video["height"].alias("height"), frame_rate(F.coalesce(video["avg_frame_rate"], video["r_frame_rate"], F.lit("0/0"))).alias("fps")))
    a = F.when(audio.isNotNull(), F.struct(audio["codec_name"].alias("codec"), audio["sample_rate"].try_cast("int").alias("sample_rate"), audio["channels"].alias("channels")))
    return x.select(
        *MEDIA,
        F.round(F.col("p.format.duration").try_cast("double"), 3).alias("duration_sec"),
        F.col("p.format.size").try_cast("long").alias("size_bytes"),
        F.col("p.format.format_name").alias("container"),
        v.alias("video"),
        a.alias("audio"),
        F.greatest(F.size(streams_of("subtitle")), F.lit(0)).alias("subtitle_tracks"),
        F.greatest(F.size("p.chapters"), F.lit(0)).alias("chapters"),
        F.col("json").alias("raw"),
    )


def subtitle_streams(raw: DataFrame) -> DataFrame:
    """Subtitle streams with their status: those of text codecs are extracted, others are not supported."""
    each = probed(raw).select(*MEDIA, F.posexplode(streams_of("subtitle")).alias("subtitle_index", "s"))
    good = F.lower("s.codec_name").isin(*TEXT_CODECS)
    flag = lambda name: F.coalesce(F.try_element_at("s.disposition", F.lit(name)) == 1, F.lit(False)).alias(name)
    tag = lambda name: optional_text(F.try_element_at("s.tags", F.lit(name))).alias(name)
    return each.select(
        *MEDIA,
        F.concat(F.lit("subtitle:"), F.col("s.index").cast("string")).alias("source_id"),
        F.col("s.index").alias("stream_index"),
        "subtitle_index",
        F.col("s.codec_name").alias("codec_name"),
        tag("language"),
        tag("title"),
        F.struct(flag("default"), flag("forced"), flag("hearing_impaired")).alias("disposition"),
        F.when(good, "extractable").otherwise("skipped").alias("status"),
        F.when(~F.coalesce(good, F.lit(False)), F.lit("UNSUPPORTED_SUBTITLE_CODEC")).alias("reason_code"),
    )


def chapters(raw: DataFrame) -> DataFrame:
    """Chapters by place, with a default title; an error where times are not finite or a chapter has no length."""
    each = probed(raw).select(*MEDIA, F.posexplode("p.chapters").alias("chapter_index", "c"))
    start, end = F.col("c.start_time").try_cast("double"), F.col("c.end_time").try_cast("double")
    bad = F.coalesce(F.isnan(start) | F.isnan(end) | (F.abs(start) == float("inf")) | (F.abs(end) == float("inf")) | (end <= start), F.lit(True))
    tag = lambda name: optional_text(F.try_element_at("c.tags", F.lit(name)))
    return each.select(
        *MEDIA,
        F.concat(F.lit("chapter:"), F.col("chapter_index").cast("string")).alias("source_id"),
        "chapter_index",
        F.coalesce(F.col("c.id"), F.col("chapter_index").cast("string")).alias("source_chapter_id"),
        F.when(bad, F.raise_error(F.lit("a chapter's times are not valid")).cast("double")).otherwise(F.round(start, 3)).alias("start_sec"),
        F.round(end, 3).alias("end_sec"),
        F.coalesce(tag("title"), F.format_string("Chapter %d", F.col("chapter_index") + 1)).alias("title"),
        tag("language").alias("language"),
    )


def scene_boundaries(frames: DataFrame, media: DataFrame, threshold: float = 27.0, least_frames: int = 15) -> DataFrame:
    """Scenes from content scores: a cut where a frame's score is above the threshold and the last cut lies at least
    `least_frames` back; a medium without a cut is one scene. frames: media_id, frame, score; media: media_id, fps, frame_count, duration_sec.

    Which cuts count depends on the last one that counted, so cuts (few, and not frames) are folded per medium.
    """
    cuts = frames.where(F.col("score") > threshold).groupBy(*MEDIA).agg(F.array_sort(F.collect_list(F.col("frame").cast("long"))).alias("cuts"))
    x = media.join(cuts, MEDIA, "left").withColumn("cuts", F.coalesce("cuts", F.array().cast("array<bigint>")))
    zero = F.array(F.lit(0).cast("bigint"))
    starts = F.aggregate("cuts", zero, lambda have, c: F.when(c - F.element_at(have, -1) >= least_frames, F.array_append(have, c)).otherwise(have))
    x = x.withColumn("starts", starts).select(*media.columns, "starts", F.posexplode("starts").alias("k", "start_frame"))
    end = F.coalesce(F.try_element_at("starts", F.col("k") + 2), F.col("frame_count").cast("long"))
    last = F.col("k") + 1 == F.size("starts")
    at = lambda f: F.round(f / F.col("fps"), 3)
    x = x.withColumn("end_frame", end).withColumn("start_sec", at(F.col("start_frame"))).withColumn("end_sec", F.when(last, F.round("duration_sec", 3)).otherwise(at(F.col("end_frame"))))
    return x.select(*MEDIA, (F.col("k") + 1).alias("scene_id"), "start_sec", "end_sec", F.round(F.col("end_sec") - F.col("start_sec"), 3).alias("duration_sec"), F.col("start_frame").cast("int").alias("start_frame"), F.col("end_frame").cast("int").alias("end_frame"))


def scene_summary(scenes: DataFrame) -> DataFrame:
    return scenes.groupBy(*MEDIA).agg(F.count(F.lit(1)).alias("scene_count"), F.avg("duration_sec").alias("avg_sec"), F.min("duration_sec").alias("min_sec"), F.max("duration_sec").alias("max_sec"))


def webvtt(files: DataFrame) -> DataFrame:
    """Cues of WebVTT texts: media_id, source_stream_id, cue_index (from 1), start_sec, end_sec, text.

    files: media_id, source_stream_id, value (a whole file). Comments, styles, regions and cues without text are left out; a missing
    header, a bad time or a cue without length is an error.
    """
    key = [*MEDIA, "source_stream_id"]
    body = F.regexp_replace(F.regexp_replace("value", "^﻿", ""), "\r\n", "\n")
    headed = F.regexp_replace(body, r"^\s+", "").startswith("WEBVTT")
    body = F.when(headed, body).otherwise(F.raise_error(F.lit("the WebVTT header is missing")).cast("string"))
    blocks = F.filter(F.split(body, r"\n[ \t\r\f\v]*\n"), lambda b: F.trim(F.replace(b, F.lit("\n"), F.lit(" "))) != "")
    each = files.select(*key, F.posexplode(blocks).alias("block", "b")).where("block > 0")
    lines = F.filter(F.split("b", "\n"), lambda x: F.trim(x) != "")
    each = each.withColumn("lines", lines).where(~F.trim(F.col("lines")[0]).rlike("^(NOTE|STYLE|REGION)"))
    at = F.when(F.col("lines")[0].contains("-->"), 1).when(F.coalesce(F.try_element_at("lines", F.lit(2)).contains("-->"), F.lit(False)), 2)
    each = each.withColumn("at", at).where("at is not null").withColumn("timing", F.trim(F.element_at("lines", F.col("at"))))
    part = lambda k: vtt_seconds(F.regexp_extract("timing", r"^(\S+)\s+-->\s+(\S+)(?:\s+.*)?$", k))
    each = each.withColumns({"start_sec": part(1), "end_sec": part(2)})
    bad = F.coalesce(F.col("end_sec") <= F.col("start_sec"), F.lit(True))
    each = each.withColumn("start_sec", F.when(bad, F.raise_error(F.lit("a WebVTT cue's time is not valid")).cast("double")).otherwise(F.col("start_sec")))
    rest = F.array_join(F.slice("lines", F.col("at") + 1, F.greatest(F.size("lines") - F.col("at"), F.lit(0))), "\n")
    cues = each.withColumn("text", plain_text_udf(rest)).where("text <> ''")
    return cues.select(*key, F.row_number().over(Window.partitionBy(*key).orderBy("block")).alias("cue_index"), "start_sec", "end_sec", "text")


def ordered_subtitles(cues: DataFrame) -> DataFrame:
    """Cues with `pos`: their place by start, end, stream and cue."""
    order = Window.partitionBy(*MEDIA).orderBy("start_sec", "end_sec", "stream_index", "cue_index")
    return cues.withColumn("pos", F.row_number().over(order))


def audio_files(spark: SparkSession, path: str) -> DataFrame:
    """WAV files with their length in seconds, by size; the content is not read for it."""
    return spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("size_bytes"), F.round(wav_duration(F.col("length")), 3).alias("duration_sec"), "content")


@pandas_udf(T.ArrayType(T.FloatType()))
def wav_samples(files: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Samples of 16-bit mono PCM, divided by 32,768."""

    def one(data: bytes) -> list[float]:
        with wave.open(io.BytesIO(data)) as w:
            if w.getnchannels() != 1 or w.getsampwidth() != 2:
                raise ValueError("16-bit mono audio is needed")
            return (np.frombuffer(w.readframes(w.getnframes()), "<i2").astype(np.float32) / 32768).tolist()

    for s in files:
        yield s.map(lambda d: None if d is None else one(bytes(d)))


def word_table(spark: SparkSession, path: str) -> DataFrame:
    """An OCR engine's TSV files, with the image's name and the order of rows."""
    kinds = "level int, page_num int, block_num int, par_num int, line_num int, word_num int, left int, top int, width int, height int, conf double, text string"
    rows = spark.read.csv(path, sep="\t", header=True, schema=kinds, quote="", mode="FAILFAST")
    return rows.withColumns({"image_id": F.regexp_extract(F.input_file_name(), r"([^/]+?)(\.[^./]*)?$", 1), "row": F.monotonically_increasing_id(), "text": F.coalesce("text", F.lit(""))})
