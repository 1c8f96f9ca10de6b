"""Scene cards: everything that a time axis says about each scene, and counts over them.

Inputs are tables keyed by media_id, so many media are one plan:
scenes(scene_id, start_sec, end_sec, duration_sec), transcript(pos, segment_id?, start_sec, end_sec, text, ...),
turns(pos, start_sec, end_sec, speaker), subtitles(pos, source_id?, start_sec, end_sec, text, language),
chapters(chapter_index, start_sec, end_sec, title), events(pos, event_id?, label, confidence, start_sec, end_sec),
keyframes(scene_id, keyframe_index, keyframe_count, timestamp_sec, path), captions(keyframe columns, keyframe, caption)
and ocr(keyframe columns, keyframe, text, image_width, image_height, regions). `pos` is the order of input.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import two_places
from ..functions.text import fmt_ts
from .intervals import assign, best_overlap, unassigned
from .keyframes import nearest_frame

MEDIA = ["media_id"]


def ordered_unique(texts: Column, strip: bool = True, drop_empty: bool = True) -> Column:
    """First occurrences of an array's texts, joined by a bar; null where nothing is left."""
    out = F.transform(texts, lambda t: F.trim(t)) if strip else texts
    out = F.array_distinct(out)
    if drop_empty:
        out = F.filter(out, lambda t: t != "")
    return F.nullif(F.array_join(out, " | "), F.lit(""))


def in_order(*columns: str, by: str = "pos") -> Column:
    """An aggregate: structs of the columns in input order."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(by).alias("_at"), F.struct(*columns).alias("row"))))
    return F.transform(rows, lambda x: x["row"])


@dataclass(frozen=True)
class Sources:
    scenes: DataFrame
    transcript: DataFrame
    turns: DataFrame
    subtitles: DataFrame
    chapters: DataFrame
    events: DataFrame
    keyframes: DataFrame
    captions: DataFrame
    ocr: DataFrame


def transcript_lines(transcript: DataFrame, turns: DataFrame, width: float = 60.0) -> DataFrame:
    """Transcript segments with the speaker of their best turn, and source_segment_id: the segment's own id or its place."""
    spoken = assign(transcript, turns, MEDIA, "pos", "pos", ["speaker"], width)
    own = F.col("segment_id").cast("string") if "segment_id" in transcript.columns else F.lit(None).cast("string")
    return spoken.withColumn("source_segment_id", F.coalesce(own, F.col("pos").cast("string")))


def to_scenes(rows: DataFrame, scenes: DataFrame, width: float = 60.0) -> DataFrame:
    """Rows with the scene_id of their best scene, null for none."""
    return assign(rows, scenes, MEDIA, "pos", "scene_id", ["scene_id"], width)


def chapter_of_scene(scenes: DataFrame, chapters: DataFrame, width: float = 60.0) -> DataFrame:
    best = best_overlap(scenes, chapters, MEDIA, "scene_id", "chapter_index", width)
    names = [c for c in chapters.columns if c not in MEDIA]
    return best.select(*MEDIA, F.col("s_scene_id").alias("scene_id"), F.struct(*(F.col(f"i_{c}").alias(c) for c in names)).alias("chapter"))


def scene_cards(x: Sources, width: float = 60.0) -> tuple[DataFrame, dict[str, DataFrame]]:
    """One card for each scene, and the source rows that met no scene, by kind."""
    key = [*MEDIA, "scene_id"]
    lines = to_scenes(transcript_lines(x.transcript, x.turns, width), x.scenes, width)
    cues = to_scenes(x.subtitles, x.scenes, width).withColumn("source_id", F.coalesce("source_id", F.concat(F.lit("subtitle:cue:"), F.col("pos").cast("string"))))
    events = to_scenes(x.events, x.scenes, width).withColumn("event_id", F.coalesce(F.col("event_id").cast("string"), F.col("pos").cast("string")))
    optional = [c for c in ("vad_source_ids", "avg_logprob", "no_speech_prob") if c in lines.columns]
    spoken = lines.where("scene_id is not null").groupBy(*key).agg(in_order("start_sec", "end_sec", "speaker", "text", "source_segment_id", *optional).alias("transcript"))
    subtitles = cues.where("scene_id is not null").groupBy(*key).agg(in_order("source_id", "start_sec", "end_sec", "text", "language").alias("subtitles"))
    audio = events.where("scene_id is not null").groupBy(*key).agg(in_order("event_id", "label", "confidence", "start_sec", "end_sec").alias("audio_events"))
    frames = x.keyframes.groupBy(*key).agg(F.transform(in_order("path", by="keyframe_index"), lambda r: r["path"]).alias("keyframes"))
    nearest = nearest_frame(x.scenes, x.keyframes, key).select(*key, F.col("path").alias("keyframe"))
    seen = x.captions.groupBy(*key).agg(in_order("keyframe_index", "keyframe_count", "timestamp_sec", "keyframe", "caption", by="keyframe_index").alias("visual_captions"))
    read = x.ocr.groupBy(*key).agg(in_order("keyframe_index", "keyframe_count", "timestamp_sec", "keyframe", "text", "image_width", "image_height", "regions", by="keyframe_index").alias("visual_ocr"))
    cards = x.scenes
    for part in (frames, nearest, seen, read, chapter_of_scene(x.scenes, x.chapters, width), subtitles, audio, spoken):
        cards = cards.join(part, key, "left")
    texts = lambda column, field: F.transform(column, lambda r: r[field])
    empty = {c: F.coalesce(c, F.array().cast(cards.schema[c].dataType)) for c in ("keyframes", "visual_captions", "visual_ocr", "subtitles", "audio_events", "transcript")}
    cards = cards.withColumns(empty).withColumns(
        {
            "caption": ordered_unique(texts("visual_captions", "caption"), drop_empty=False),
            "ocr_text": ordered_unique(texts("visual_ocr", "text")),
            "subtitle_text": ordered_unique(texts("subtitles", "text")),
            "audio_event_text": ordered_unique(texts("audio_events", "label"), strip=False, drop_empty=False),
        }
    )
    left = {"transcript": unassigned(lines, "scene_id").select(*MEDIA, F.col("source_segment_id").alias("source_id")), "subtitles": unassigned(cues, "scene_id").select(*MEDIA, "source_id"), "events": unassigned(events, "scene_id").select(*MEDIA, F.col("event_id").alias("source_id"))}
    return cards, left


def timeline_counts(cards: DataFrame) -> DataFrame:
    """Per medium: cards, and cards with speech, OCR text, subtitles, a chapter and audio events, and lines assigned."""
    return cards.groupBy(*MEDIA).agg(
        F.count(F.lit(1)).alias("scene_card_count"),
        F.count_if(F.size("transcript") > 0).alias("scenes_with_speech"),
        F.count_if(F.col("ocr_text").isNotNull()).alias("scenes_with_ocr"),
        F.count_if(F.col("subtitle_text").isNotNull()).alias("scenes_with_subtitles"),
        F.count_if(F.col("chapter").isNotNull()).alias("scenes_with_chapter"),
        F.count_if(F.size("audio_events") > 0).alias("scenes_with_audio_events"),
        F.sum(F.size("transcript").cast("long")).alias("assigned_transcript_count"),
        F.sum(F.size("subtitles").cast("long")).alias("assigned_subtitle_count"),
        F.sum(F.size("audio_events").cast("long")).alias("assigned_audio_event_count"),
    )


def envelope(cards: DataFrame, left: dict[str, DataFrame]) -> DataFrame:
    """Counts with the ids of rows that met no scene, sorted, by kind."""
    out = timeline_counts(cards)
    for kind, rows in left.items():
        ids = rows.groupBy(*MEDIA).agg(F.sort_array(F.collect_list("source_id")).alias(f"unassigned_{kind}_ids"))
        out = out.join(ids, MEDIA, "left").withColumn(f"unassigned_{kind}_ids", F.coalesce(f"unassigned_{kind}_ids", F.array().cast("array<string>")))
    return out


def markdown(cards: DataFrame, names: DataFrame) -> DataFrame:
    """media_id and the timeline as Markdown: a section for each scene in order. names: media_id, name."""
    one = lambda text: F.replace(text, F.lit("\n"), F.lit(" / "))
    head = F.format_string("## 씬 %02d [%s ~ %s]", F.col("scene_id"), fmt_ts(F.col("start_sec")), fmt_ts(F.col("end_sec")))
    chapter = F.array_compact(F.array(F.when(F.col("chapter").isNotNull(), F.concat(F.lit("- 챕터: "), F.coalesce("chapter.title", F.lit(""))))))
    cues = F.transform("subtitles", lambda s: F.concat(F.lit("- 내장 자막 ["), fmt_ts(s["start_sec"]), F.lit("]"), F.coalesce(F.concat(F.lit(" ("), F.nullif(s["language"], F.lit("")), F.lit(")")), F.lit("")), F.lit(": "), one(s["text"])))
    events = F.transform("audio_events", lambda e: F.concat(F.lit("- 오디오 이벤트 ["), fmt_ts(e["start_sec"]), F.lit("]: "), e["label"], F.lit(" ("), two_places(e["confidence"]), F.lit(")")))
    many = lambda column, single, several: F.when(F.size(column) == 1, F.transform(column, single)).otherwise(F.transform(column, several))
    visuals = many(F.col("visual_captions"), lambda v: F.concat(F.lit("- 시각: "), v["caption"]), lambda v: F.concat(F.format_string("- 시각 %d/%d [", v["keyframe_index"], v["keyframe_count"]), fmt_ts(v["timestamp_sec"]), F.lit("]: "), v["caption"]))
    paths = F.when(F.size("keyframes") == 1, F.transform("keyframes", lambda p: F.concat(F.lit("- 키프레임: `"), p, F.lit("`")))).otherwise(
        F.transform("keyframes", lambda p, i: F.concat(F.format_string("- 키프레임 %d/%d: `", i + 1, F.size("keyframes")), p, F.lit("`")))
    )
    shown = F.filter("visual_ocr", lambda v: v["text"] != "")
    read = many(shown, lambda v: F.concat(F.lit("- 화면 텍스트: "), one(v["text"])), lambda v: F.concat(F.format_string("- 화면 텍스트 %d/%d: ", v["keyframe_index"], v["keyframe_count"]), one(v["text"])))
    said = F.when(F.size("transcript") > 0, F.transform("transcript", lambda t: F.concat(F.lit("- ["), fmt_ts(t["start_sec"]), F.lit("]"), F.coalesce(F.concat(F.lit(" ("), F.nullif(t["speaker"], F.lit("")), F.lit(")")), F.lit("")), F.lit(" "), t["text"]))).otherwise(F.array(F.lit("- (발화 없음)")))
    section = F.array_join(F.concat(F.array(head), chapter, cues, events, visuals, paths, read, said, F.array(F.lit(""))), "\n")
    body = cards.select(*MEDIA, "scene_id", section.alias("section")).groupBy(*MEDIA).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("scene_id", "section"))), lambda s: s["section"]), "\n").alias("body"))
    return names.join(body, MEDIA, "left").select(*MEDIA, F.concat(F.lit("# 타임라인: "), F.col("name"), F.lit("\n"), F.coalesce(F.concat(F.lit("\n"), F.col("body")), F.lit(""))).alias("value"))
