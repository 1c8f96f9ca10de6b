"""A whole run of the stages over injected models, and a run for selected scenes laid over it."""

import json

import pytest
from pyspark.sql import functions as F

from mediaweave import stages
from mediaweave.plans.engine import Engine
from mediaweave.plans.settings import PipelineSettings
from mediaweave.plans.stages import DEFAULT_STAGES, DERIVED_STAGES, StageRegistry
from mediaweave.sources.stores import RunStore, TableStore

WEBVTT = "WEBVTT\n\n00:01.000 --> 00:03.000\nHello cue\n"


def probe(audio=True, subtitle=None, chapters=()):
    streams = [{"index": 0, "codec_type": "video", "codec_name": "h264", "width": 64, "height": 36, "avg_frame_rate": "25/1"}]
    streams += [{"index": 1, "codec_type": "audio", "codec_name": "aac", "sample_rate": "48000", "channels": 2}] * audio
    streams += [{"index": 2, "codec_type": "subtitle", "codec_name": subtitle, "tags": {"language": "en"}}] if subtitle else []
    return json.dumps({"format": {"duration": "20.0", "size": "10", "format_name": "mov"}, "streams": streams, "chapters": list(chapters)})


def models(mark=""):
    return stages.Models(
        hash=lambda rows: [f"{(hash_of(r) * 0x9E3779B97F4A7C15) % (1 << 64):016x}" for r in rows],
        caption=lambda paths: [f"{mark}a slide of {p}" if "01" in p else f"{mark}nothing of {p}" for p in paths],
        ocr=lambda paths: [{"text": f"{mark}read faint", "image_width": 64, "image_height": 36, "regions": [{"region_id": 1, "text": f"{mark}read", "confidence": 0.9, "bbox": {"x": 0, "y": 0, "width": 5, "height": 5}}, {"region_id": 2, "text": "faint", "confidence": 0.1, "bbox": {"x": 6, "y": 0, "width": 5, "height": 5}}]} for _ in paths],
        vad=lambda ids: [[(0.0, 2.0), (2.2, 4.0), (9.0, 11.0)] if i == 1 else [] for i in ids],
        stt=lambda chunks: [[{"start_sec": 0.5, "end_sec": 1.5, "text": " hello there ", "avg_logprob": -0.1, "no_speech_prob": 0.01}] for _ in chunks],
        diarize=lambda ids: [[(0.0, 5.0, "SPEAKER_00"), (8.0, 12.0, "SPEAKER_01")] if i == 1 else [] for i in ids],
        audio_event=lambda windows: [[("music", 0.9)] if w["start_sec"] < 4 else [] for w in windows],
    )


def hash_of(row):
    return int(row["scene_id"] * 1000 + row["timestamp_sec"] * 10 + 1)


@pytest.fixture(scope="module")
def first(spark, tmp_path_factory):
    scores = [0.0] * 500
    scores[250] = 40.0  # a cut at 10 seconds
    rows = [
        (1, "one", probe(subtitle="mov_text", chapters=[{"id": "1", "start_time": "0", "end_time": "20", "tags": {"title": "Whole"}}]), 25.0, 500, scores, [("subtitle:2", WEBVTT)]),
        (2, "two", probe(audio=False, subtitle="dvd_subtitle"), 25.0, 500, [0.0] * 500, []),
        (3, "three", probe(), 25.0, 500, [0.0] * 500, []),
    ]
    video = spark.createDataFrame(rows, "media_id int, name string, json string, fps double, frame_count int, scores array<double>, webvtt array<struct<source_stream_id:string,value:string>>")
    store = TableStore(spark, str(tmp_path_factory.mktemp("tables")))
    engine = Engine(spark, StageRegistry(DEFAULT_STAGES), stages.functions(models()), store, RunStore(), workers=2)
    config = PipelineSettings(max_context_tokens=200).stage_configs()
    inputs = {"video": store.write(video)}
    result = engine.run(engine.planner.plan(), inputs, "run", config)
    notes = engine.runs.notes
    assert result.status == "succeeded", notes
    made = inputs | {k: a for s in result.stages.values() for k, a in s.outputs.items()}
    return store, made, engine, inputs, config


def test_a_run_makes_every_table(first):
    store, made, engine, inputs, config = first
    read = {k: store.read(a) for k, a in made.items()}
    assert {r.media_id: r.n for r in read["scenes"].groupBy("media_id").agg(F.count("*").alias("n")).collect()} == {1: 2, 2: 1, 3: 1}
    cards = {(r.media_id, r.scene_id): r for r in read["timeline"].collect()}
    assert [t.text for t in cards[1, 1].transcript] == ["hello there"] and cards[1, 1].transcript[0].speaker == "SPEAKER_00"
    assert cards[1, 1].subtitle_text == "Hello cue" and cards[1, 1].chapter.title == "Whole" and cards[1, 1].audio_event_text == "music"
    assert cards[1, 2].transcript[0].speaker == "SPEAKER_01" and cards[2, 1].transcript == []
    seen = [r.text for r in read["ocr"].collect()]
    assert seen and set(seen) == {"read"}  # the faint word is under the threshold
    assert read["index"].where("vector is not null").count() == 4 and all(r.token_count <= 200 for r in read["context"].collect())
    again = engine.run(engine.planner.plan(), inputs, "again", config)
    assert {s.status for s in again.stages.values()} == {"cached"}


def test_reasons_for_nothing_to_do(first):
    store, made, *_ = first
    read = {k: store.read(a) for k, a in made.items()}
    why = lambda name, config=None: {r.media_id: (r.executed, r.reason) for r in stages.skips(name, read, config).collect()}
    assert why("04_embedded_text") == {1: (True, None), 2: (False, "NO_EXTRACTABLE_EMBEDDED_TEXT"), 3: (False, "NO_EMBEDDED_TEXT")}
    assert why("07_diarize") == {1: (True, None), 2: (False, "NO_AUDIO"), 3: (True, None)}
    assert why("06_stt") == {1: (True, None), 2: (False, "NO_AUDIO"), 3: (False, "NO_SPEECH")}
    assert why("05_audio_events", {"enabled": False})[1] == (False, "AUDIO_EVENTS_DISABLED")
    assert why("08_ocr", {"mode": "disabled"})[3] == (False, "OCR_DISABLED")
    empty = read | {"keyframes": read["keyframes"].where("media_id <> 2"), "ocr": read["ocr"].where("media_id <> 3")}
    assert {r.media_id: r.reason for r in stages.skips("08_ocr", empty).collect()} == {1: None, 2: "NO_KEYFRAMES", 3: "NO_OCR_CANDIDATES"}


def test_frames_of_scenes_are_counted(first):
    store, made, *_ = first
    out = stages.keyframe_report(models(), {"scenes": store.read(made["scenes"])}, {})
    assert all(r.candidate_count == r.retained_count + r.removed_count for r in out["stats"].collect())


def test_selected_scenes_are_laid_over_the_run(spark, first):
    store, made, *_ = first
    wanted = store.write(spark.createDataFrame([(1, 2)], "media_id int, scene_id int"))
    engine = Engine(spark, StageRegistry(DERIVED_STAGES), stages.functions(models("new ")), store, RunStore())
    names = {"source_keyframes": "keyframes", "source_captions": "captions", "source_ocr": "ocr"}
    inputs = {k: a for k, a in made.items() if k not in ("keyframes", "keyframe_images", "captions", "ocr", "timeline", "index", "context")} | {k: made[v] for k, v in names.items()} | {"selected_scenes": wanted}
    config = {"08_ocr": {"mode": "all"}}
    result = engine.run(engine.planner.plan(), inputs, "derived", config)
    assert result.status == "succeeded", engine.runs.notes
    read = lambda name: store.read(next(s.outputs[name] for s in result.stages.values() if name in s.outputs))
    for r in read("captions").collect():
        assert r.caption.startswith("new ") == ((r.media_id, r.scene_id) == (1, 2)) and r.provenance == ("selected" if (r.media_id, r.scene_id) == (1, 2) else "source")
    old = {(r.media_id, r.scene_id) for r in store.read(made["ocr"]).collect()}
    assert {(r.media_id, r.scene_id) for r in read("ocr").collect()} == old | {(1, 2)}
    assert {r.scene_id for r in read("timeline").where("media_id = 1 and caption like 'new%'").collect()} == {2}
    bad = inputs | {"selected_scenes": store.write(spark.createDataFrame([(1, 9)], "media_id int, scene_id int"))}
    assert engine.run(engine.planner.plan(), bad, "unknown", config).status == "failed"
