"""The stages of a run as functions from tables to tables, with injected models.

Each function takes (tables, config) and gives its output tables; `functions(models)` binds them for the engine. Decoding media is
outside: `video` is a table of probe results and frame scores (media_id, name, json, fps, frame_count, scores), and models
are callables on batches. A stage that has nothing to do gives empty tables; `skips` says why, with a stable reason for each medium.

03_keyframes, 08_captions and 08_ocr run for some scenes alone where the tables hold `selected_scenes` (media_id, scene_id): they work on
those and lay their results over `source_keyframes`, `source_captions` and `source_ocr` of an earlier run.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions.gateway import hashed_embedding, model_column
from .functions.text import TokenCounter
from .operators import audio, context, intervals, keyframes, overlay, search, timeline, visual
from .sources import media

Tables = dict[str, DataFrame]
MEDIA = ["media_id"]

#: Reasons for which a stage has nothing to do.
SKIPS = ("OCR_DISABLED", "NO_KEYFRAMES", "NO_OCR_CANDIDATES", "AUDIO_EVENTS_DISABLED", "NO_AUDIO", "NO_EMBEDDED_TEXT", "NO_EXTRACTABLE_EMBEDDED_TEXT", "NO_SPEECH")


@dataclass(frozen=True)
class Models:
    """Batched callables. Each takes a list and gives a list of the same length.

    hash: frame rows -> 16 hex digits; caption: paths -> texts; ocr: paths -> dicts of text, image_width, image_height, regions;
    vad: media ids -> lists of (start, end); stt: chunk rows -> lists of dicts; diarize: media ids -> lists of (start, end, speaker);
    audio_event: window rows -> lists of (label, confidence); embed: texts -> vectors.
    """

    hash: Callable[[list], list] = lambda rows: ["0" * 16 for _ in rows]
    caption: Callable[[list], list] = lambda paths: [f"frame {p}" for p in paths]
    ocr: Callable[[list], list] = lambda paths: [{"text": "", "image_width": 1, "image_height": 1, "regions": []} for _ in paths]
    vad: Callable[[list], list] = lambda ids: [[] for _ in ids]
    stt: Callable[[list], list] = lambda chunks: [[] for _ in chunks]
    diarize: Callable[[list], list] = lambda ids: [[] for _ in ids]
    audio_event: Callable[[list], list] = lambda windows: [[] for _ in windows]
    embed: Callable[[list], list] = field(default=hashed_embedding)


def status(rows: DataFrame, media_rows: DataFrame, reason: str) -> DataFrame:
    """media_id, executed and reason: why a medium has no rows."""
    if reason not in SKIPS:
        raise ValueError(f"{reason} is no reason for skipping")
    have = rows.select(*MEDIA).distinct().withColumn("executed", F.lit(True))
    out = media_rows.select(*MEDIA).join(have, MEDIA, "left").withColumn("executed", F.coalesce("executed", F.lit(False)))
    return out.withColumn("reason", F.when(~F.col("executed"), F.lit(reason)))


def probe(t: Tables, config: Mapping) -> Tables:
    return {"metadata": media.metadata(t["video"].select("media_id", "json")).join(t["video"].select("media_id", "name"), MEDIA)}


def scenes(t: Tables, config: Mapping) -> Tables:
    v = t["video"]
    frames = v.select("media_id", F.posexplode("scores").alias("frame", "score"))
    about = v.select("media_id", "fps", "frame_count").join(t["metadata"].select("media_id", "duration_sec"), MEDIA)
    return {"scenes": media.scene_boundaries(frames, about, config.get("threshold", 27.0), config.get("min_frames", 15)), "scene_stats": frames}


SCENE = [*MEDIA, "scene_id"]


def chosen(t: Tables, known: DataFrame) -> DataFrame | None:
    """The scenes that are made again, or none where all are; an error if one repeats or is unknown."""
    return overlay.selected_scenes(t["selected_scenes"], known.select(*SCENE).distinct()) if "selected_scenes" in t else None


def decided_frames(models: Models, scenes_: DataFrame, config: Mapping) -> DataFrame:
    """Candidate frames of scenes with their hashes, and which stay."""
    found = keyframes.candidates(scenes_, config.get("max_keyframes_per_scene", 3))
    hashed = model_column(found.withColumn("frame", F.struct("media_id", "scene_id", "timestamp_sec")), "frame", "perceptual_hash", "string", lambda: models.hash).drop("frame")
    return keyframes.greedy_dedup(hashed, SCENE, config.get("distance", keyframes.MAX_DISTANCE))


def keyframe_report(models: Models, t: Tables, config: Mapping) -> Tables:
    """Counts of candidates, kept and removed frames of each scene, and the removed frames beside those they repeat."""
    decided = decided_frames(models, t["scenes"], config)
    return {"stats": keyframes.dedup_stats(decided, SCENE), "removed": keyframes.removed_frames(decided, SCENE)}


def keyframe_stage(models: Models):
    columns = [*SCENE, "keyframe_index", "keyframe_count", "timestamp_sec", "path", "perceptual_hash"]

    def run(t: Tables, config: Mapping) -> Tables:
        again = chosen(t, t["scenes"])
        mine = t["scenes"] if again is None else t["scenes"].join(again, SCENE, "left_semi")
        kept = keyframes.retained_frames(decided_frames(models, mine, config), SCENE).select(*columns)
        if again is not None:
            kept = overlay.overlay(t["source_keyframes"].select(*columns), kept, again)
        return {"keyframes": kept, "keyframe_images": kept.select(*SCENE, "path")}

    return run


def audio_stage(t: Tables, config: Mapping) -> Tables:
    have = t["metadata"].where("audio is not null").select("media_id", F.col("duration_sec").alias("total_sec"))
    return {"audio": have, "audio_metadata": status(have, t["metadata"], "NO_AUDIO")}


def embedded_text(t: Tables, config: Mapping) -> Tables:
    """Cues and chapters as one table: kind, then the columns of either. `video` may carry WebVTT texts (webvtt: array of source_stream_id, value)."""
    raw = t["video"].select("media_id", "json")
    chapters = media.chapters(raw).select("media_id", F.lit("chapter").alias("kind"), "source_id", F.col("chapter_index").alias("place"), F.lit(None).cast("int").alias("stream_index"), "start_sec", "end_sec", F.col("title").alias("text"), "language")
    streams = media.subtitle_streams(raw).where("status = 'extractable'").select("media_id", F.col("source_id").alias("source_stream_id"), "stream_index", "language")
    if "webvtt" in t["video"].columns:
        files = t["video"].select("media_id", F.inline("webvtt"))
        cues = media.webvtt(files).join(streams, ["media_id", "source_stream_id"])
        cue = cues.select("media_id", F.lit("cue").alias("kind"), F.concat_ws(":", "source_stream_id", F.lit("cue"), F.col("cue_index").cast("string")).alias("source_id"), F.col("cue_index").alias("place"), "stream_index", "start_sec", "end_sec", "text", "language")
        chapters = chapters.unionByName(cue)
    return {"embedded_text": chapters}


def vad(models: Models):
    def run(t: Tables, config: Mapping) -> Tables:
        raw = model_column(t["audio"], "media_id", "found", "array<struct<start:double,end:double>>", lambda: lambda ids: [[{"start": a, "end": b} for a, b in x] for x in models.vad(ids)])
        each = raw.select("media_id", "total_sec", F.posexplode("found").alias("k", "s"))
        out = each.select("media_id", (F.col("k") + 1).alias("segment_id"), F.round("s.start", 3).alias("start_sec"), F.round("s.end", 3).alias("end_sec"))
        return {"speech_segments": out.withColumn("duration_sec", F.round(F.col("end_sec") - F.col("start_sec"), 3))}

    return run


def stt(models: Models):
    answer = "array<struct<start_sec:double,end_sec:double,text:string,avg_logprob:double,no_speech_prob:double>>"

    def run(t: Tables, config: Mapping) -> Tables:
        chunks = audio.speech_chunks(t["speech_segments"], config.get("max_gap_sec", 0.5))
        asked = chunks.withColumn("chunk", F.struct("media_id", "start_sec", "end_sec"))
        told = model_column(asked, "chunk", "found", answer, lambda: models.stt).select("media_id", "chunk_id", F.inline("found"))
        return {"transcript": audio.absolute_transcript(told, chunks)}

    return run


def diarize(models: Models):
    def run(t: Tables, config: Mapping) -> Tables:
        raw = model_column(t["audio"], "media_id", "found", "array<struct<start:double,end:double,speaker:string>>", lambda: lambda ids: [[{"start": a, "end": b, "speaker": s} for a, b, s in x] for x in models.diarize(ids)])
        each = raw.select("media_id", F.posexplode(F.array_sort("found")).alias("k", "s"))
        return {"speaker_turns": each.select("media_id", (F.col("k") + 1).alias("turn_id"), F.round("s.start", 3).alias("start_sec"), F.round("s.end", 3).alias("end_sec"), "s.speaker")}

    return run


def audio_event_stage(models: Models):
    def run(t: Tables, config: Mapping) -> Tables:
        have = t["audio"] if config.get("enabled", True) else t["audio"].limit(0)
        w = intervals.sliding_windows(have, "total_sec", config.get("window_sec", 5.0), config.get("hop_sec", 2.5))
        asked = w.withColumn("window", F.struct("media_id", "window_id", "start_sec", "end_sec"))
        told = model_column(asked, "window", "labels", "array<struct<label:string,confidence:double>>", lambda: lambda x: [[{"label": n, "confidence": c} for n, c in y] for y in models.audio_event(x)])
        return {"audio_events": audio.audio_events(told.select("media_id", "window_id", "start_sec", "end_sec", F.inline("labels")), config.get("min_confidence", 0.5))}

    return run


def captions(models: Models):
    columns = [*SCENE, "keyframe_index", "keyframe_count", "timestamp_sec"]

    def run(t: Tables, config: Mapping) -> Tables:
        frames = t["keyframes"].select(*columns, "path")
        again = chosen(t, frames)
        told = visual.valid_captions(model_column(frames if again is None else frames.join(again, SCENE, "left_semi"), "path", "caption", "string", lambda: models.caption))
        good = F.when(F.col("valid"), F.col("caption")).otherwise(F.raise_error(F.lit("a caption must have text")).cast("string"))
        made = told.select(*columns, F.col("path").alias("keyframe"), good.alias("caption"))
        if again is not None:
            made = overlay.overlay_captions(frames, t["source_captions"], made, again).drop("path")
        return {"captions": made}

    return run


def ocr(models: Models):
    region = "struct<region_id:int,text:string,confidence:double,bbox:struct<x:int,y:int,width:int,height:int>>"
    answer = f"struct<text:string,image_width:int,image_height:int,regions:array<{region}>>"
    columns = [*SCENE, "keyframe_index", "keyframe_count", "timestamp_sec"]

    def run(t: Tables, config: Mapping) -> Tables:
        mode = config.get("mode", "caption-hints")
        frames = t["keyframes"].select(*columns, "path")
        again = chosen(t, frames)
        if again is not None and mode != "all":
            raise ValueError("selected scenes need the mode all")
        if mode == "caption-hints":
            wanted = visual.ocr_candidates(frames, t["captions"])
        else:
            wanted = (frames if again is None else frames.join(again, SCENE, "left_semi")).withColumn("trigger_hint", F.lit(None).cast("string"))
        if mode == "disabled":
            wanted = wanted.limit(0)
        told = visual.confident(model_column(wanted, "path", "read", answer, lambda: models.ocr).select(*columns, "path", "trigger_hint", "read.*"), config.get("min_confidence", 0.0))
        made = told.select(*columns, F.col("path").alias("keyframe"), "text", "image_width", "image_height", "regions", "trigger_hint")
        if again is not None:
            made = overlay.overlay_ocr(frames, t["source_ocr"].select(*made.columns), made, again)
        return {"ocr": made}

    return run


def timeline_stage(t: Tables, config: Mapping) -> Tables:
    text = t["embedded_text"]
    cues = media.ordered_subtitles(text.where("kind = 'cue'").withColumn("cue_index", F.col("place")))
    chapter = text.where("kind = 'chapter'").select("media_id", F.col("place").alias("chapter_index"), "start_sec", "end_sec", F.col("text").alias("title"))
    sources = timeline.Sources(
        t["scenes"].select("media_id", "scene_id", "start_sec", "end_sec", "duration_sec"),
        t["transcript"].withColumn("pos", F.col("segment_id")).select("media_id", "pos", "segment_id", "start_sec", "end_sec", "text", "avg_logprob", "no_speech_prob", "vad_source_ids"),
        t["speaker_turns"].withColumn("pos", F.col("turn_id")),
        cues.select("media_id", "pos", "source_id", "start_sec", "end_sec", "text", "language"),
        chapter,
        t["audio_events"].withColumn("pos", F.col("event_id")).select("media_id", "pos", "event_id", "label", "confidence", "start_sec", "end_sec"),
        t["keyframes"],
        t["captions"],
        t["ocr"],
    )
    cards, _ = timeline.scene_cards(sources)
    return {"timeline": cards}


def index_stage(models: Models):
    def run(t: Tables, config: Mapping) -> Tables:
        """Cards with search texts and vectors. A card without any text gets no vector."""
        cards = t["timeline"].withColumn("doc_key", F.concat_ws("/", F.col("media_id").cast("string"), F.col("scene_id").cast("string")))
        index = search.index_cards(cards, "doc_key", search.card_text())
        some = index.where("normalized_text <> ''")
        vectors = model_column(some.select("doc_key", "normalized_text"), "normalized_text", "vector", "array<float>", lambda: models.embed).select("doc_key", "vector")
        return {"index": index.join(cards.select("doc_key", "media_id", "scene_id", "start_sec", "end_sec"), "doc_key").join(vectors, "doc_key", "left")}

    return run


def context_stage(t: Tables, config: Mapping) -> Tables:
    cards = t["timeline"]
    who = audio.speakers(t["speaker_turns"])
    count = cards.groupBy(*MEDIA).agg(F.count(F.lit(1)).alias("scene_count"))
    about = t["metadata"].select("media_id", "name", "duration_sec").join(count, MEDIA, "left").join(who, MEDIA, "left").withColumns({"scene_count": F.coalesce("scene_count", F.lit(0)), "speakers": F.coalesce("speakers", F.array().cast("array<string>"))})
    most = config.get("max_context_tokens")
    return {"context": context.budget_context(cards, about, most, TokenCounter()) if most else context.static_context(cards, about)}


def skips(name: str, t: Tables, config: Mapping | None = None) -> DataFrame:
    """media_id, executed and reason: for which media a stage had nothing to do. t: the run's tables, the stage's own among them."""
    every, config = t["metadata"], config or {}
    if name == "04_audio":
        return t["audio_metadata"]
    if name == "04_embedded_text":
        out = status(t["embedded_text"], every, "NO_EMBEDDED_TEXT")
        other = media.subtitle_streams(t["video"].select("media_id", "json")).select(*MEDIA).distinct().withColumn("_other", F.lit(True))
        reason = F.when(F.col("_other") & ~F.col("executed"), F.lit("NO_EXTRACTABLE_EMBEDDED_TEXT")).otherwise(F.col("reason"))
        return out.join(other, MEDIA, "left").withColumn("reason", reason).drop("_other")
    if name in ("05_audio_events", "05_vad", "06_stt", "07_diarize"):
        if name == "05_audio_events" and config.get("enabled", True) is False:
            return status(every.limit(0), every, "AUDIO_EVENTS_DISABLED")
        out = status(t["audio"], every, "NO_AUDIO")
        if name != "06_stt":
            return out
        spoken = t["speech_segments"].select(*MEDIA).distinct().withColumn("_spoken", F.lit(True))
        silent = F.col("executed") & F.col("_spoken").isNull()
        return out.join(spoken, MEDIA, "left").withColumns({"reason": F.when(silent, F.lit("NO_SPEECH")).otherwise(F.col("reason")), "executed": F.col("executed") & ~silent}).drop("_spoken")
    if name == "08_ocr":
        if config.get("mode") == "disabled":
            return status(every.limit(0), every, "OCR_DISABLED")
        out = status(t["keyframes"], every, "NO_KEYFRAMES")
        read = t["ocr"].select(*MEDIA).distinct().withColumn("_read", F.lit(True))
        none = F.col("executed") & F.col("_read").isNull()
        return out.join(read, MEDIA, "left").withColumns({"reason": F.when(none, F.lit("NO_OCR_CANDIDATES")).otherwise(F.col("reason")), "executed": F.col("executed") & ~none}).drop("_read")
    return every.select(*MEDIA).withColumns({"executed": F.lit(True), "reason": F.lit(None).cast("string")})


def functions(models: Models | None = None) -> dict[str, Callable[[Tables, Mapping], Tables]]:
    m = models or Models()
    return {
        "01_probe": probe,
        "02_scenes": scenes,
        "03_keyframes": keyframe_stage(m),
        "04_audio": audio_stage,
        "04_embedded_text": embedded_text,
        "05_audio_events": audio_event_stage(m),
        "05_vad": vad(m),
        "06_stt": stt(m),
        "07_diarize": diarize(m),
        "08_captions": captions(m),
        "08_ocr": ocr(m),
        "09_timeline": timeline_stage,
        "10_index": index_stage(m),
        "11_context": context_stage,
    }
