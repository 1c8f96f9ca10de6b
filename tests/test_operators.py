import pytest
from pyspark.sql import functions as F

from mediaweave.functions import gateway, numeric, text
from mediaweave.operators import audio, context, evaluation, intervals, keyframes, overlay, search, timeline, visual
from mediaweave.sources import media


def one(df):
    return df.collect()[0]


def test_tie_goes_to_the_scene_of_the_middle(spark):
    scenes = spark.createDataFrame([(1, 1, 0.0, 5.0), (1, 2, 5.0, 10.0)], "media_id int, scene_id int, start_sec double, end_sec double")
    segs = spark.createDataFrame([(1, 1, 4.0, 6.0), (1, 2, 10.0, 11.0), (1, 3, 2.0, 2.0)], "media_id int, pos int, start_sec double, end_sec double")
    out = intervals.assign(segs, scenes, ["media_id"], "pos", "scene_id", ["scene_id"], 3.0)
    assert {r.pos: r.scene_id for r in out.collect()} == {1: 2, 2: None, 3: None}


@pytest.mark.parametrize("width", [0.5, 2.0, 60.0, 10_000.0])
def test_bucket_width_does_not_matter(spark, width):
    rows = [(1, i, i * 0.7, i * 0.7 + (i % 5)) for i in range(40)]
    segs = spark.createDataFrame(rows, "media_id int, pos int, start_sec double, end_sec double")
    got = {(r.s_pos, r.i_pos) for r in intervals.overlap_pairs(segs, segs, ["media_id"], width).collect()}
    assert got == {(a[1], b[1]) for a in rows for b in rows if min(a[3], b[3]) > max(a[2], b[2])}


def test_gap_merge(spark):
    segs = spark.createDataFrame([(1, 1, 0.0, 1.0), (1, 2, 1.5, 2.0), (1, 3, 2.6, 3.0)], "media_id int, segment_id int, start_sec double, end_sec double")
    out = intervals.gap_merge(segs.repartition(3), ["media_id"], 0.5).orderBy("chunk_id").collect()
    assert [(r.start_sec, r.end_sec, r.source_ids) for r in out] == [(0.0, 2.0, [1, 2]), (2.6, 3.0, [3])]


def test_windows_and_merge(spark):
    m = spark.createDataFrame([(1, 6.0)], "media_id int, total double")
    w = intervals.sliding_windows(m, "total", 3.0, 2.0)
    assert [(r.window_id, r.start_sec, r.end_sec) for r in w.orderBy("window_id").collect()] == [(1, 0.0, 3.0), (2, 2.0, 5.0), (3, 4.0, 6.0)]
    labels = spark.createDataFrame([(1, 1, 0.0, 3.0, "music", 0.8), (1, 2, 2.0, 5.0, "music", 0.9), (1, 2, 2.0, 5.0, "applause", 0.95), (1, 3, 4.0, 6.0, "music", 0.1)], "media_id int, window_id int, start_sec double, end_sec double, label string, confidence double")
    out = audio.audio_events(labels, 0.5).orderBy("event_id").collect()
    assert [(r.event_id, r.label, r.start_sec, r.end_sec, r.confidence, r.source_window_ids) for r in out] == [(1, "music", 0.0, 5.0, 0.9, [1, 2]), (2, "applause", 2.0, 5.0, 0.95, [2])]


def test_distance_six_goes_and_seven_stays(spark):
    rows = [(1, 1, 1.0, "0" * 16), (1, 2, 2.0, "0" * 14 + "3f"), (1, 3, 3.0, "0" * 14 + "7f"), (2, 1, 4.0, "0" * 16)]
    frames = spark.createDataFrame(rows, "scene_id int, candidate_index int, timestamp_sec double, perceptual_hash string")
    out = keyframes.greedy_dedup(frames, ["scene_id"])
    assert sorted((r.scene_id, r.candidate_index) for r in out.where("retained").collect()) == [(1, 1), (1, 3), (2, 1)]
    gone = one(keyframes.removed_frames(out, ["scene_id"]))
    assert (gone.candidate_index, gone.duplicate_of, gone.hamming_distance) == (2, 1, 6)
    assert [r.path for r in keyframes.retained_frames(out, ["scene_id"]).orderBy("scene_id", "keyframe_index").collect()] == ["scene_001_01.jpg", "scene_001_02.jpg", "scene_002.jpg"]


def test_search_text(spark):
    df = spark.createDataFrame([("  ＡI·음성\n검출!!!  ",)], "t string").select(text.normalize_udf("t").alias("n"))
    assert one(df).n == "ai 음성 검출"
    assert one(df.select(text.character_ngrams(F.lit("음성 검출")).alias("g"))).g == ["음성", "검출"]
    assert one(df.select(text.character_ngrams(F.lit("a ab")).alias("g"))).g == ["ab"]
    assert one(df.select(text.character_ngrams(F.lit("")).alias("g"))).g == []


def test_bm25_by_hand(spark):
    import math

    docs = spark.createDataFrame([(1, "red fox"), (2, "red red dog"), (3, "blue sky")], "k int, t string")
    index = search.index_cards(docs, "k", F.col("t"))
    q = search.query_terms(spark.createDataFrame([(0, "fox")], "query_id int, query string"))
    got = one(search.bm25(search.postings(index), search.lengths(index), q))
    n = {1: 2 + 6, 2: 3 + 6, 3: 2 + 8}  # words and distinct grams
    lens = {r.doc_key: r.length for r in search.lengths(index).collect()}
    avg = sum(lens.values()) / 3
    assert n[1] == lens[1]
    part = lambda w: math.log(2.5 / 1.5) * w * 2.2 / (w + 1.2 * (0.25 + 0.75 * lens[1] / avg))
    assert got.doc_key == 1 and math.isclose(got.score, part(5) + 3 * part(1))
    assert search.bm25(search.postings(index), search.lengths(index), q, one_field=True).count() == 1


def test_diacritics_match(spark):
    index = search.index_cards(spark.createDataFrame([(1, "Café")], "k int, t string"), "k", F.col("t"))
    q = search.query_terms(spark.createDataFrame([(0, "cafe")], "query_id int, query string"))
    assert search.bm25(search.postings(index), search.lengths(index), q).count() == 1


def test_one_normaliser_serves_cards_and_queries(spark):
    """Full-width letters and ligatures in a card and in a query meet."""
    cards = spark.createDataFrame([(1, "  \uff21I\u00b7\uc74c\uc131\n\uac80\ucd9c!!!  \ufb01re"), (2, "other words"), (3, "sunny days")], "k int, t string")
    q = search.query_terms(spark.createDataFrame([(0, "\uff21\uff29 \ufb01re"), (1, "ai fire")], "query_id int, query string"))
    index = search.index_cards(cards, "k", F.col("t"))
    found = {(r.query_id, r.doc_key): r.score for r in search.bm25(search.postings(index), search.lengths(index), q).collect()}
    assert set(found) == {(0, 1), (1, 1)} and found[0, 1] == found[1, 1] > 1


def test_forward_table_gives_the_postings_of_the_cards(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame([(-1, None), (-2, ""), (-3, "Caf\u00e9 CAFE caf\u00e9 \ufb01\u00df")], "doc_id long, text string"))
    index, ahead = search.index_cards(docs, "doc_id", F.col("text")), search.forward(docs, "doc_id", F.col("text"))
    key = lambda df: sorted(tuple(r) for r in df.select("field", "term", "doc_key", "tf").collect())
    assert key(search.postings(index)) == key(search.forward_postings(ahead))
    assert {(r.doc_key, max(0, r.length)) for r in search.lengths(index).collect() if r.doc_key != -1} == {(r.doc_key, r.length) for r in ahead.collect() if r.doc_key != -1}


def test_scores_and_places_of_blocks(spark, monkeypatch):
    """Blocks of any size give the sums of the plain ranking, the best of it, and the places of any candidates."""
    import random

    monkeypatch.setattr(search, "CARDS", 3)
    monkeypatch.setattr(search, "QUERIES", 2)
    r = random.Random(2)
    texts = [" ".join(r.choice(["red", "fox", "dog", "blue", "sky", "caf\u00e9", "of"]) for _ in range(r.randrange(9))) for _ in range(25)]
    docs = spark.createDataFrame(list(enumerate([*texts, texts[3], texts[3]])), "k int, t string")
    asked = spark.createDataFrame([(k, t) for k, t in enumerate(["red fox", "cafe", "sky of blue", "nothing", ""])], "query_id int, query string")
    index, terms = search.forward(docs, "k", F.col("t")), search.query_terms(asked)
    scorer = search.WordScorer(index, search.term_counts(search.forward_postings(index)), terms)
    plain = search.ranked(search.bm25(search.forward_postings(index), index.select("doc_key", "length"), terms), "score", "rank", 6)
    want = {(x.query_id, x.doc_key): (round(x.score, 6), x["rank"]) for x in plain.collect()}
    read = lambda df: {(x.query_id, x.doc_key): (round(x.score, 6), x["rank"]) for x in df.collect()}
    assert read(search.best_of(scorer, 4, 6)) == {k: v for k, v in want.items() if v[1] <= 4}
    some = [(q, d) for q in range(5) for d in range(27) if (q + d) % 3 == 0]
    assert read(search.ranks_of(scorer, spark.createDataFrame(some, "query_id int, doc_key int"), 6)) == {k: v for k, v in want.items() if k in set(some)}


def test_hybrid_is_the_fusion_of_whole_rankings(spark, monkeypatch):
    import random

    monkeypatch.setattr(search, "RRF", 3)  # so that the cut at RRF + 2 * top_k leaves something out
    monkeypatch.setattr(search, "CARDS", 4)
    r = random.Random(4)
    docs = spark.createDataFrame([(k, " ".join(r.choice(["red", "fox", "dog", "blue", "sky"]) for _ in range(r.randrange(1, 7)))) for k in range(60)], "k int, t string")
    e = spark.createDataFrame([(k, [r.choice([-1.0, 0.1, 0.5, 1.0]) for _ in range(3)]) for k in range(60)], "doc_key long, vector array<double>")
    asked = spark.createDataFrame([(k, t) for k, t in enumerate(["red fox", "sky", "zebra"])], "query_id int, query string")
    index, terms = search.forward(docs, "k", F.col("t")), search.query_terms(asked)
    words = search.WordScorer(index, search.term_counts(search.forward_postings(index)), terms)
    vectors = search.VectorScorer(e, e.where("doc_key < 3").withColumnRenamed("doc_key", "query_id"))
    got = {(x.query_id, x["rank"]): (x.doc_key, round(x.score, 9), x.keyword_rank, x.semantic_rank, tuple(x.reasons)) for x in search.hybrid(words, vectors, 2).collect()}
    kw = {(x.query_id, x.doc_key): x["rank"] for x in search.best_of(words, 1000, 6).collect()}
    sem = {(x.query_id, x.doc_key): (x["rank"], round(x.score, 6)) for x in search.best_of(vectors, 1000, 6).collect()}
    for q in range(3):
        rows = []
        for d in range(60):
            near = (q, d) in sem and sem[q, d][1] >= 0.35
            score = (1 / (3 + kw[q, d]) if (q, d) in kw else 0) + (1 / (3 + sem[q, d][0]) if near else 0)
            if score:
                rows.append((-round(score, 12), d, round(score, 9), kw.get((q, d)), sem[q, d][0], (*(["keyword"] if (q, d) in kw else []), *(["semantic"] if near else []))))
        for n, x in enumerate(sorted(rows)[:2], 1):
            assert got[q, n] == x[1:]


def test_numbering_over_spans(spark):
    rows = [(m, k * 3) for m in "ab" for k in range(40 if m == "a" else 7)]
    out = intervals.numbered(spark.createDataFrame(rows, "m string, k long"), "m", "k", "place", span=10).collect()
    assert {(x.m, x.k): x.place for x in out} == {(m, k): k // 3 + 1 for m, k in rows}


def test_passages_word_for_word(spark):
    docs = spark.createDataFrame([(1, "x abc y"), (2, "abcd bc"), (3, None), (4, "")], "doc_key int, text string")
    cases = spark.createDataFrame([("a", "abc"), ("b", "bc"), ("c", "abc"), ("d", ""), ("e", None), ("f", "zz")], "case_id string, text string")
    got = {(x.case_id, x.doc_key) for x in evaluation.passage_matches(spark, docs, cases).collect()}
    assert got == {("a", 1), ("c", 1), ("b", 1), ("a", 2), ("c", 2), ("b", 2)}
    assert evaluation.passage_matches(spark, docs, cases.limit(0)).count() == 0


def test_neighbours(spark):
    hits = spark.createDataFrame([(0, 1, 3, 1), (0, 1, 5, 2)], "query_id int, media_id int, scene_id int, rank int")
    line = spark.createDataFrame([(1, i, i - 1) for i in range(1, 6)], "media_id int, scene_id int, position int")
    out = search.expand_neighbours(hits, line, 1).orderBy("place").collect()
    assert [r.scene_id for r in out] == [3, 2, 4, 5]


def test_metrics(spark):
    cases = spark.createDataFrame([(c,) for c in "abcd"], "case_id string")
    relevant = spark.createDataFrame([("a", 1), ("b", 2), ("b", 2)], "case_id string, doc_key int")
    hits = spark.createDataFrame([("a", 1, 1), ("b", 9, 1), ("b", 2, 2), ("c", 4, 1)], "case_id string, doc_key int, rank int")
    r = one(evaluation.report(evaluation.case_results(cases, relevant, hits)))
    assert (r.recall_at_k, r.mean_reciprocal_rank, r.no_answer_precision, r.no_answer_recall) == (1.0, 0.75, 1.0, 0.5)


def test_fold_budget_goes_on_after_a_card_that_does_not_fit():
    counter = text.TokenCounter(split=list)
    items = [(1, "a" * 10, "a"), (2, "b" * 40, ""), (3, "c" * 5, "c")]
    taken, out, short = context.fold_budget(items, lambda rows: "".join(b for _, b in rows), counter, 20)
    assert ([k for k, _ in taken], out, short) == ([1, 3], [2], [])
    assert context.render_matches([(1, "best"), (2, "next")]).endswith("next\n\nbest")


def test_webvtt_faults(spark):
    f = lambda v: media.webvtt(spark.createDataFrame([(1, "s", v)], "media_id int, source_stream_id string, value string")).collect()
    assert f("WEBVTT\r\n\r\n00:01.000 --> 00:02.000\r\nhi\r\n")[0].text == "hi"
    assert f("﻿WEBVTT\n\n") == []
    for bad in ("no header", "WEBVTT\n\n00:02.000 --> 00:01.000\nx", "WEBVTT\n\n00:61.000 --> 00:62.000\nx"):
        with pytest.raises(Exception, match="WebVTT"):
            f(bad)


def test_scene_fallback(spark):
    frames = spark.createDataFrame([(1, 10, 50.0), (1, 20, 50.0), (1, 30, 50.0)], "media_id int, frame int, score double")
    about = spark.createDataFrame([(1, 10.0, 100, 10.0), (2, 10.0, 50, 5.0)], "media_id int, fps double, frame_count int, duration_sec double")
    out = media.scene_boundaries(frames, about).orderBy("media_id", "scene_id").collect()
    assert [(r.media_id, r.start_frame, r.end_frame) for r in out] == [(1, 0, 20), (1, 20, 100), (2, 0, 50)]


def test_overlay_faults(spark):
    known = spark.createDataFrame([(1, 1), (1, 2)], "media_id int, scene_id int")
    with pytest.raises(ValueError):
        overlay.selected_scenes(known.union(known), known)
    with pytest.raises(ValueError):
        overlay.selected_scenes(spark.createDataFrame([(1, 9)], "media_id int, scene_id int"), known)
    frames = spark.createDataFrame([(1, 1, 1, "a"), (1, 2, 1, "b")], "media_id int, scene_id int, keyframe_index int, path string")
    caps = lambda rows: spark.createDataFrame(rows, "media_id int, scene_id int, keyframe_index int, caption string, keyframe string")
    new = caps([(1, 1, 1, "new", "a")])
    picked = known.where("scene_id = 1")
    got = overlay.overlay_captions(frames, caps([(1, 2, 1, "old", "b")]), new, picked).collect()
    assert sorted((r.scene_id, r.caption, r.provenance) for r in got) == [(1, "new", "selected"), (2, "old", "source")]
    with pytest.raises(Exception, match="source caption"):
        overlay.overlay_captions(frames, caps([]), new, picked).collect()
    assert overlay.overlay_ocr(frames, caps([]), new, picked).count() == 1


def test_region_faults(spark):
    kind = "image_id string, image_width int, image_height int, regions array<struct<region_id:int,text:string,confidence:double,bbox:struct<x:int,y:int,width:int,height:int>>>"
    good, bad = [(1, "a", 0.5, (0, 0, 5, 5))], [(1, "a", 0.5, (8, 0, 5, 5))]
    df = spark.createDataFrame([("ok", 10, 10, good), ("bad", 10, 10, bad), ("id", 10, 10, [(2, "a", 0.5, (0, 0, 5, 5))])], kind)
    assert sorted(r.image_id for r in visual.region_faults(df).collect()) == ["bad", "id"]


def test_gateway():
    class Echo:
        def capabilities(self):
            return gateway.Capabilities(("embedding",), ("e",), 2)

        def infer(self, task, inputs, params):
            if params.get("fail"):
                raise RuntimeError
            return list(inputs)[: params.get("n", 9)]

    g = gateway.Gateway({"e": Echo()}, {"e": gateway.CircuitBreaker(2, 30)})
    assert g.infer("e", "embedding", ["x"]).outputs == ["x"]
    reasons = [g.infer(*a).reason for a in (("z", "embedding", ["x"]), ("e", "ocr", ["x"]), ("e", "embedding", []), ("e", "embedding", ["x"] * 3))]
    assert reasons == ["UNKNOWN_MODEL_ALIAS", "UNSUPPORTED_TASK", "EMPTY_BATCH", "BATCH_TOO_LARGE"]
    assert g.infer("e", "embedding", ["x", "y"], {"n": 1}).reason == "OUTPUT_COUNT_MISMATCH"
    for _ in range(2):
        assert g.infer("e", "embedding", ["x"], {"fail": 1}).reason.startswith("PROVIDER_ERROR")
    assert g.infer("e", "embedding", ["x"]).reason == "PROVIDER_UNAVAILABLE"


def test_vad(spark):
    segs = spark.createDataFrame([(1, 0.0, 1.0, 1.0), (1, 2.0, 4.0, 2.0)], "media_id int, start_sec double, end_sec double, duration_sec double")
    about = spark.createDataFrame([(1, 6.0), (2, 0.0)], "media_id int, total_sec double")
    out = {r.media_id: r for r in audio.vad_totals(segs, about).collect()}
    assert (out[1].speech_sec, out[1].speech_ratio, out[2].speech_ratio) == (3.0, 0.5, 0.0)
    ok = {r.media_id: (r.sum_ok, r.ratio_ok, r.end_ok) for r in audio.vad_consistency(segs, audio.vad_totals(segs, about)).collect()}
    assert ok == {1: (True, True, True), 2: (True, True, True)}


def test_label_order_is_checked(spark):
    with pytest.raises(ValueError):
        audio.label_mapping(spark, {i: "x" for i in range(527)})
    by = {r.class_index: r.label for r in audio.label_mapping(spark, {i: audio.ANCHORS.get(i, "x") for i in range(527)}).collect()}
    assert (by[310], by[323], by[301]) == ("alarm", "siren", "vehicle")


def test_markdown(spark):
    card = "media_id int, scene_id int, start_sec double, end_sec double, chapter struct<title:string>, subtitles array<struct<start_sec:double,text:string,language:string>>, audio_events array<struct<label:string,confidence:double,start_sec:double>>, visual_captions array<struct<keyframe_index:int,keyframe_count:int,timestamp_sec:double,caption:string>>, keyframes array<string>, visual_ocr array<struct<keyframe_index:int,keyframe_count:int,text:string>>, transcript array<struct<start_sec:double,speaker:string,text:string>>"
    cards = spark.createDataFrame([(1, 1, 0.0, 65.0, ("T",), [(1.0, "a\nb", "en")], [("music", 0.9, 2.0)], [(1, 1, 3.0, "cap")], ["k.jpg"], [(1, 1, "txt")], [(4.0, "S", "hi"), (5.0, None, "yo")])], card)
    out = one(timeline.markdown(cards, spark.createDataFrame([(1, "v")], "media_id int, name string"))).value
    assert out == "# 타임라인: v\n\n## 씬 01 [00:00 ~ 01:05]\n- 챕터: T\n- 내장 자막 [00:01] (en): a / b\n- 오디오 이벤트 [00:02]: music (0.90)\n- 시각: cap\n- 키프레임: `k.jpg`\n- 화면 텍스트: txt\n- [00:04] (S) hi\n- [00:05] yo\n"


def test_numbers(spark):
    df = spark.range(1)
    assert one(df.select(numeric.frame_rate(F.lit("0/0")).alias("x"))).x == 0.0
    assert one(df.select(text.fmt_ts(F.lit(3725.9)).alias("x"))).x == "62:05"
    with pytest.raises(Exception, match="finite"):
        df.select(numeric.l2_normalized(F.array(F.lit(0.0)))).collect()
    vec = one(df.select(numeric.l2_normalized(F.array(F.lit(3.0), F.lit(4.0))).alias("x"))).x
    assert vec == [0.6, 0.8]


def test_every_fiftieth_vector_is_a_query_against_all(spark, data):
    import numpy as np

    from mediaweave.queries import QUERIES

    rows = spark.read.parquet(f"{data}/embeddings.parquet").collect()
    ids, v = [r.vec_id for r in rows], np.array([r.embedding for r in rows], float)
    want = set()
    for q in range(len(ids)):
        if ids[q] % 50 == 0:
            best = sorted(zip(-np.round(v @ v[q], 6), ids, strict=True))[:10]
            want |= {(ids[q], key, rank + 1) for rank, (_, key) in enumerate(best)}
    got = QUERIES["semantic_topk"](spark, data).collect()
    assert {(r.query_id, r.vec_id, r["rank"]) for r in got} == want and len(got) == len(want)


def test_nearest_over_many_blocks_is_the_same(spark, monkeypatch):
    import random

    monkeypatch.setattr(search, "CARDS", 1)

    r = random.Random(5)
    rows = [(k, [r.choice([-1.0, 0.5, 1.0]) for _ in range(4)]) for k in range(60)]
    e = spark.createDataFrame(rows, "doc_key long, vector array<double>")
    q = e.where("doc_key % 5 = 0").withColumnRenamed("doc_key", "query_id")
    want = {(a, key, rank + 1) for a, v in rows if a % 5 == 0 for rank, (_, key) in enumerate(sorted((-sum(x * y for x, y in zip(v, w, strict=True)), key) for key, w in rows)[:3])}
    assert {(x.query_id, x.doc_key, x["rank"]) for x in search.nearest(e, q, 3).collect()} == want


def test_two_places_round_the_exact_value(spark):
    """As C and the SQL do: 0.285 is stored as less than itself, 0.125 is a true half."""
    import random

    r = random.Random(5)
    xs = [0.285, 0.125, 0.375, 0.005, 0.015, 1.005, 2.675, 0.0, -0.0, -0.001, 1e-300, 0.995, 0.994999999999, 1.115, 35.855, 1e12 + 0.125, *(k / 1000 for k in range(2000)), *(k / 100 / 500 for k in range(0, 60000, 5)), *(r.uniform(-3, 1e4) for _ in range(3000))]
    got = spark.createDataFrame([(k, x) for k, x in enumerate(xs)], "k int, x double").select("k", numeric.two_places(F.col("x")).alias("t")).collect()
    assert {xs[g.k]: g.t for g in got} == {x: f"{x:.2f}" for x in xs}
    odd = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (None,)], "x double").select(numeric.two_places(F.col("x"))).collect()
    assert [o[0] for o in odd] == ["nan", "inf", "-inf", None]


def test_static_context_rounds_confidences_by_their_exact_value(spark):
    card = "media_id int, scene_id int, start_sec double, end_sec double, caption string, ocr_text string, chapter struct<title:string>, subtitle_text string, audio_event_text string, audio_events array<struct<label:string,confidence:double>>, transcript array<struct<start_sec:double,end_sec:double,speaker:string,text:string>>"
    cards = spark.createDataFrame([(1, 1, 0.0, 5.0, None, None, None, None, "L", [("L", 0.285), ("L", 0.125), ("L", 0.375)], [])], card)
    media = spark.createDataFrame([(1, "m", 5.0, 1, [])], "media_id int, name string, duration_sec double, scene_count long, speakers array<string>")
    assert "L (0.28), L (0.12), L (0.38)" in one(context.static_context(cards, media)).context


@pytest.mark.parametrize("dense", [0.0, 0.1, 9.0])
def test_scores_of_blocks_by_matrix_and_by_pair(spark, monkeypatch, dense):
    """Terms may be multiplied as matrices, added up by pair, or both; blocks are bytes, and a task gives a query's best once, not once a block."""
    import random

    monkeypatch.setattr(search, "CARDS", 4)
    monkeypatch.setattr(search, "QUERIES", 3)
    monkeypatch.setattr(search, "DENSE", dense)
    monkeypatch.setattr(search, "PAIRS", 5)
    r = random.Random(6)
    docs = spark.createDataFrame([(k, " ".join(r.choice(["red", "fox", "dog", "blue", "sky", "é", "strasse"]) for _ in range(r.randrange(9)))) for k in range(70)], "k long, t string").coalesce(1)
    asked = docs.where("k % 10 = 0").select(F.col("k").alias("query_id"), F.col("t").alias("query"))
    index, terms = search.forward(docs, "k", F.col("t")), search.query_terms(asked)
    scorer = search.WordScorer(index, search.term_counts(search.forward_postings(index)), terms)
    given = []
    monkeypatch.setattr(search, "ranked", lambda df, *a, real=search.ranked: (given.append(df.count()), real(df, *a))[1])
    got = {(x.query_id, x.doc_key): (round(x.score, 6), x["rank"]) for x in search.best_of(scorer, 2, 6).collect()}
    plain = search.ranked(search.bm25(search.forward_postings(index), index.select("doc_key", "length"), terms), "score", "rank", 6)
    assert got == {(x.query_id, x.doc_key): (round(x.score, 6), x["rank"]) for x in plain.where("rank <= 2").collect()}
    assert {t for _, t in scorer.cards.dtypes} == {"bigint", "binary"} and scorer.cards.count() == 18
    tasks = scorer.cards.rdd.getNumPartitions()
    assert given[0] <= 7 * 2 * tasks * 4


def test_places_of_candidates_of_many_blocks(spark, monkeypatch):
    """Wanted rows of any number, rows that tie, and scores too large to be packed into one number."""
    import random

    monkeypatch.setattr(search, "CARDS", 1)
    monkeypatch.setattr(search, "QUERIES", 2)
    monkeypatch.setattr(search, "WANTED", 7)
    monkeypatch.setattr(search, "HELD", 20)
    r = random.Random(8)
    for large in (1.0, 1e7):
        rows = [(k, [r.choice([-1.0, 0.5, 1.0]) * large for _ in range(3)]) for k in range(50)]
        e = spark.createDataFrame(rows, "doc_key long, vector array<double>")
        scorer = search.VectorScorer(e, e.where("doc_key % 10 = 0").withColumnRenamed("doc_key", "query_id"))
        some = [(q, d) for q in range(0, 50, 10) for d in range(60) if (q + d) % 3]
        got = {(x.query_id, x.doc_key): x["rank"] for x in search.ranks_of(scorer, spark.createDataFrame(some, "query_id long, doc_key long"), 6).collect()}
        of = dict(rows)
        score = lambda q, d: sum(a * b for a, b in zip(of[q], of[d], strict=True))  # noqa: E731, B023
        places = {q: {d: n for n, d in enumerate(sorted(of, key=lambda d: (-round(score(q, d), 6), d)), 1)} for q in range(0, 50, 10)}  # noqa: B023
        assert got == {(q, d): places[q][d] for q, d in some if d in of}


def test_hybrid_counts_no_place_that_is_known(spark, monkeypatch):
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(["red fox", "red dog", "blue sky"])], "k int, t string")
    e = spark.createDataFrame([(k, [1.0, float(k)]) for k in range(3)], "doc_key long, vector array<double>")
    index, terms = search.forward(docs, "k", F.col("t")), search.query_terms(spark.createDataFrame([(0, "red")], "query_id int, query string"))
    words = search.WordScorer(index, search.term_counts(search.forward_postings(index)), terms)
    asked = []
    monkeypatch.setattr(search, "ranks_of", lambda s, c, p, real=search.ranks_of: (asked.append({tuple(r) for r in c.collect()}), real(s, c, p))[1])
    out = search.hybrid(words, search.VectorScorer(e, e.where("doc_key = 0").withColumnRenamed("doc_key", "query_id")), 2).collect()
    assert asked == [{(0, 2)}, set()] and len(out) == 2


def test_static_contexts_of_events_without_a_user(spark, data, tmp_path):
    """Their medium has no id, so the SQL gives it a row without a context."""
    import duckdb

    from mediaweave.queries import ORACLE_SQL, QUERIES

    e = spark.read.parquet(f"{data}/events.parquet").where("event_id < 200")
    e.withColumn("user_id", F.when(F.col("event_id") % 7 != 0, F.col("user_id"))).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    want = con.execute(ORACLE_SQL["static_contexts"]).fetchall()
    got = [tuple(r) for r in QUERIES["static_contexts"](spark, str(tmp_path)).collect()]
    assert (None, None, None, None) in want and sorted(got, key=repr) == sorted(want, key=repr)


def test_ranks_within_are_places_among_all_vectors(spark, monkeypatch):
    """Over many blocks, with ties, vectors without a class, and queries whose class has no other vector or which have none."""
    import random

    monkeypatch.setattr(search, "CARDS", 2)
    monkeypatch.setattr(search, "QUERIES", 3)
    r = random.Random(3)
    v = {i: ([r.choice([-1.0, 0.0, 0.5]) for _ in range(3)], r.choice([0, 1, None]) if i else 7) for i in range(120)}
    table = "{} long, vector array<double>, class int"
    e = spark.createDataFrame([(i, *x) for i, x in v.items()], table.format("doc_key")).repartition(4)
    q = spark.createDataFrame([(i, *x) for i, x in v.items() if i % 9 == 0], table.format("query_id"))
    got = {(x.query_id, x.doc_key): x["rank"] for x in search.ranks_within(search.ClassScorer(e, q), 6).collect()}
    want = {}
    for i in range(0, 120, 9):
        order = sorted(v, key=lambda j: (-sum(a * b for a, b in zip(v[i][0], v[j][0], strict=True)), j))
        want |= {(i, j): n for n, j in enumerate(order, 1) if v[i][1] is not None and v[i][1] == v[j][1]}
    assert got == want


def test_semantic_rank_reads_the_vectors_alone(spark, data, tmp_path):
    """As its SQL: no index of documents is made first."""
    import duckdb

    from mediaweave.queries import ORACLE_SQL, QUERIES

    spark.read.parquet(f"{data}/embeddings.parquet").coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    assert sorted(map(tuple, QUERIES["semantic_rank"](spark, str(tmp_path)).collect())) == sorted(con.execute(ORACLE_SQL["semantic_rank"]).fetchall())
