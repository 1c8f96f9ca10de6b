"""More registered queries: operators that the searches and scene cards of `queries` do not call, over whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .functions import numeric, text
from .operators import audio, context, evaluation, keyframes, overlay, search, timeline, visual
from .plans import reprocessing
from .queries import _CARD_SPAN, _CARDS, _TIMED, ORACLE_SQL, _bm25_sql, _hashed, _sources, registered, search_index, table, timed
from .session import shared_dir
from .sources import media, stores
from .streaming import streams

_GREEDY = f"g AS ({ORACLE_SQL['greedy_dedup']})"


def _greedy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyframes.greedy_dedup(_hashed(spark, sf_dir), ["scene_id"], 24)


@registered(f"WITH {_GREEDY} SELECT label, count(*) AS candidate_count, CAST(count_if(retained) AS BIGINT) AS retained_count, CAST(count_if(NOT retained) AS BIGINT) AS removed_count FROM g GROUP BY label")
def dedup_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG4: frames kept and removed, of each scene."""
    return keyframes.dedup_stats(_greedy(spark, sf_dir), ["scene_id"]).withColumnRenamed("scene_id", "label")


@registered(f"""WITH {_GREEDY} SELECT label, vec_id, row_number() OVER w AS keyframe_index, CAST(count(*) OVER (PARTITION BY label) AS INTEGER) AS keyframe_count,
    CASE WHEN count(*) OVER (PARTITION BY label) = 1 THEN printf('scene_%03d.jpg', label) ELSE printf('scene_%03d_%02d.jpg', label, row_number() OVER w) END AS path FROM g WHERE retained WINDOW w AS (PARTITION BY label ORDER BY vec_id)""")
def retained_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN11, STR8: frames that stay, numbered and named again."""
    out = keyframes.retained_frames(_greedy(spark, sf_dir), ["scene_id"])
    return out.select(F.col("scene_id").alias("label"), F.col("candidate_index").alias("vec_id"), F.col("keyframe_index").cast("long").alias("keyframe_index"), "keyframe_count", "path")


@registered(f"WITH {_GREEDY} SELECT label, vec_id, dup AS duplicate_of, CAST(dup AS DOUBLE) AS duplicate_timestamp_sec FROM (SELECT *, duplicate_of AS dup FROM g) WHERE NOT retained")
def removed_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOI16: removed frames beside the frame that each repeats."""
    out = keyframes.removed_frames(_greedy(spark, sf_dir), ["scene_id"])
    return out.select(F.col("scene_id").alias("label"), F.col("candidate_index").alias("vec_id"), "duplicate_of", "duplicate_timestamp_sec")


@registered("WITH l AS (SELECT doc_id, max(toxic) AS toxic FROM labels GROUP BY doc_id) SELECT d.doc_id, l.toxic, l.doc_id IS NOT NULL AS complete FROM documents d LEFT JOIN l USING (doc_id)")
def zipped_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOI9: inputs beside the answers of their keys, and which have none."""
    answers = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return visual.zip_answers(table(spark, sf_dir, "documents").select("doc_id"), answers, ["doc_id"])


def _frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source is a medium, a document a scene of one frame, whose file is named by it."""
    return table(spark, sf_dir, "documents").select(F.col("source").alias("media_id"), F.col("doc_id").alias("scene_id"), F.lit(1).alias("keyframe_index"), F.concat(F.lit("f"), F.col("doc_id").cast("string")).alias("path"), "lang")


@registered("SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN upper(lang) ELSE lang END AS caption, CASE WHEN doc_id % 7 = 0 THEN 'selected' ELSE 'source' END AS provenance FROM documents")
def caption_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOI10, JOI15, FIL8: captions made again for selected scenes; the others keep those of their frames."""
    f = _frames(spark, sf_dir)
    chosen = overlay.selected_scenes(f.where("scene_id % 7 = 0").select("media_id", "scene_id"), f)
    captions = lambda text: f.select("media_id", "scene_id", "keyframe_index", F.col("path").alias("keyframe"), text.alias("caption"))
    out = overlay.overlay_captions(f.drop("lang"), captions(F.col("lang")), captions(F.upper("lang")), chosen)
    return out.select(F.col("scene_id").alias("doc_id"), "caption", "provenance")


@registered("""SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN upper(lang) ELSE lang END AS text, CASE WHEN doc_id % 7 = 0 THEN 'selected' ELSE 'source' END AS provenance
    FROM documents WHERE doc_id % 7 = 0 AND doc_id % 2 = 0 OR doc_id % 7 <> 0 AND doc_id % 11 <> 0""")
def ocr_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOI10: results of selected scenes as they came; of the others those whose frame is still the same file."""
    f = _frames(spark, sf_dir)
    made = f.where("scene_id % 2 = 0").select("media_id", "scene_id", "keyframe_index", F.col("path").alias("keyframe"), F.upper("lang").alias("text"))
    before = f.select("media_id", "scene_id", "keyframe_index", F.when(F.col("scene_id") % 11 == 0, F.lit("another")).otherwise(F.col("path")).alias("keyframe"), F.col("lang").alias("text"))
    out = overlay.overlay_ocr(f, before, made, f.where("scene_id % 7 = 0").select("media_id", "scene_id"))
    return out.select(F.col("scene_id").alias("doc_id"), "text", "provenance")


@registered("SELECT doc_id, NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) AS missing FROM documents d WHERE missing UNION ALL SELECT DISTINCT doc_id, false FROM labels l WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = l.doc_id)")
def set_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SET3: keys missing and keys unexpected."""
    missing, more = overlay.differences(table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents"), "doc_id")
    return missing.withColumn("missing", F.lit(True)).unionByName(more.withColumn("missing", F.lit(False)))


@registered("SELECT vec_id FROM embeddings WHERE label > 6 OR vec_id % 5 = 0 OR abs(embedding[1]::DOUBLE) > 0.2")
def label_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIL17: windows with labels that are not allowed or repeat, or a confidence out of bounds."""
    one = F.struct(F.concat(F.lit("L"), F.col("label").cast("string")).alias("label"), (F.abs(F.col("embedding")[0].cast("double")) * 5).alias("confidence"))
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("window_id"), F.when(F.col("vec_id") % 5 == 0, F.array(one, one)).otherwise(F.array(one)).alias("labels"))
    return audio.invalid_results(e, [f"L{k}" for k in range(7)]).select(F.col("window_id").alias("vec_id"))


@registered("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS place FROM lineitem)
    SELECT l_orderkey AS image_id FROM r GROUP BY l_orderkey HAVING bool_or(place <> l_linenumber OR l_quantity + l_linenumber > 50 OR l_discount * 10 > 0.95)""")
def region_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIL14: images with a region that breaks the contract; an order is an image, its lines are regions."""
    box = F.struct(F.col("l_quantity").cast("int").alias("x"), F.lit(0).alias("y"), F.col("l_linenumber").alias("width"), F.lit(1).alias("height"))
    region = F.struct("l_linenumber", "l_partkey", F.struct(F.col("l_linenumber").alias("region_id"), F.col("l_returnflag").alias("text"), (F.col("l_discount") * 10 / 0.95).alias("confidence"), box.alias("bbox")).alias("r"))
    x = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("image_id")).agg(F.transform(F.array_sort(F.collect_list(region)), lambda r: r["r"]).alias("regions"))
    return visual.region_faults(x.withColumns({"image_width": F.lit(50), "image_height": F.lit(1)})).select("image_id")


@registered("SELECT doc_id, trim(CASE WHEN doc_id % 9 = 0 THEN '  ' ELSE text END) <> '' AS valid, md5(trim(CASE WHEN doc_id % 9 = 0 THEN '  ' ELSE text END)) AS caption_md5 FROM documents")
def caption_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIL15: trimmed captions, and answers that hold none."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 9 == 0, F.lit("  ")).otherwise(F.col("text")).alias("caption"))
    return visual.valid_captions(d).select("doc_id", "valid", F.md5(F.col("caption").cast("binary")).alias("caption_md5"))


@registered("""WITH s AS (SELECT user_id, sum(value) AS speech, max(value) AS last, count(*) AS n FROM events WHERE event_type = 'view' GROUP BY user_id),
    t AS (SELECT u.user_id, coalesce(speech, 0) AS speech, coalesce(last, 0) AS last, coalesce(n, 0) AS n, round(coalesce(speech, 0), 3) + CASE WHEN u.user_id % 3 = 0 THEN 1 ELSE 0 END AS said, CASE WHEN u.user_id % 5 = 0 THEN 300.0 ELSE 1000.0 END AS total FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN s USING (user_id))
    SELECT user_id AS media_id, abs(speech - said) <= greatest(0.002 * n, 0.002) AS sum_ok, abs(said - round(speech, 3)) / total <= 0.002 AS ratio_ok, last <= total + 0.002 AS end_ok FROM t""")
def speech_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG8: whether reported speech totals agree with the segments; a third of them are reported a second too long."""
    e = table(spark, sf_dir, "events")
    speech = e.where("event_type = 'view'").select(F.col("user_id").alias("media_id"), F.col("value").alias("duration_sec"), F.col("value").alias("end_sec"))
    own = audio.vad_totals(speech, e.select(F.col("user_id").alias("media_id")).distinct().withColumn("total_sec", F.when(F.col("media_id") % 5 == 0, 300.0).otherwise(1000.0)))
    off = F.when(F.col("media_id") % 3 == 0, 1.0).otherwise(0.0)
    said = own.withColumns({"speech_ratio": F.col("speech_sec") / F.col("total_sec"), "speech_sec": F.col("speech_sec") + off})
    return audio.vad_consistency(speech, said).select("media_id", "sum_ok", "ratio_ok", "end_ok")


@registered("SELECT user_id AS media_id, CAST(sum(event_id % 7) AS BIGINT) AS input_count, round(sum(value), 3) AS total_sec, round(sum(value / 2), 3) AS inference_sec, string_agg((event_id % 7)::VARCHAR, ',' ORDER BY event_id) AS batch_sizes FROM events GROUP BY user_id")
def batch_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG16: units and times summed over batches, and the sizes in order."""
    log = table(spark, sf_dir, "events").select(F.col("user_id").alias("media_id"), F.col("event_id").alias("batch"), (F.col("event_id") % 7).alias("n"), F.col("value").alias("total_sec"), (F.col("value") / 2).alias("inference_sec"))
    out = audio.usage(log)
    return out.select("media_id", "input_count", F.round("total_sec", 3).alias("total_sec"), F.round("inference_sec", 3).alias("inference_sec"), F.array_join(F.transform("batch_sizes", lambda x: x.cast("string")), ",").alias("batch_sizes"))


@registered("SELECT source AS media_id, count(*) AS image_count, CAST(count_if(doc_id % 5 <> 0 AND trim(text) <> '') AS BIGINT) AS text_frame_count, CAST(sum(doc_id % 4) AS BIGINT) AS region_count FROM documents GROUP BY source")
def ocr_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG17: frames, frames with text, and regions of each medium."""
    region = F.struct(F.lit(1).alias("region_id"))
    d = table(spark, sf_dir, "documents").select(F.col("source").alias("media_id"), F.when(F.col("doc_id") % 5 == 0, F.lit(" ")).otherwise(F.col("text")).alias("text"), F.array_repeat(region, (F.col("doc_id") % 4).cast("int")).alias("regions"))
    return visual.ocr_counts(d)


@registered(f"WITH {_TIMED} SELECT event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY s, event_id) AS keyframe_index, CAST(count(*) OVER (PARTITION BY user_id, event_type) AS INTEGER) AS keyframe_count FROM timed")
def numbered_keyframes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG18: frames numbered in their scene; a user's events of a type are a scene's frames."""
    x = timed(spark, sf_dir).select(F.col("user_id").alias("media_id"), F.col("event_type").alias("scene_id"), "event_id", F.struct("start_sec", "event_id").alias("timestamp_sec"))
    return visual.numbered_frames(x).select("event_id", F.col("keyframe_index").cast("long").alias("keyframe_index"), "keyframe_count")


@registered(f"WITH {_TIMED} SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY s, e, event_type, event_id) AS pos FROM timed")
def ordered_cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRT1: cues by start, end, stream and cue."""
    x = timed(spark, sf_dir).select(F.col("user_id").alias("media_id"), "event_id", "start_sec", "end_sec", F.col("event_type").alias("stream_index"), F.col("event_id").alias("cue_index"))
    return media.ordered_subtitles(x).select("event_id", F.col("pos").cast("long").alias("pos"))


@registered("""WITH m AS (SELECT o_orderstatus AS query_id, o_custkey % 50 AS media_id, o_orderkey % 20 AS scene_id, min(o_orderkey) AS rank FROM orders GROUP BY ALL)
    SELECT query_id, media_id, scene_id, row_number() OVER (PARTITION BY query_id ORDER BY rank, media_id, scene_id) AS place FROM m QUALIFY place <= 30""")
def reprocessing_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRT3: the first distinct scenes that a query's matches point at (a report of a fixed size)."""
    m = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("query_id"), (F.col("o_custkey") % 50).alias("media_id"), (F.col("o_orderkey") % 20).alias("scene_id"), F.col("o_orderkey").alias("rank"))
    return reprocessing.candidates(m, 30).select("query_id", "media_id", "scene_id", F.col("place").cast("long").alias("place"))


@registered(f"""WITH {_bm25_sql("SELECT item_id AS query_id, text FROM benchmark").replace("CASE WHEN field = 'w' THEN 5.0 ELSE 1.0 END * tf", "tf").replace("FROM terms JOIN post USING", "FROM (SELECT * FROM terms WHERE field = 'w') JOIN post USING")}
    SELECT query_id, doc_id, rank, round(score, 4) AS score FROM kw WHERE rank <= 10""")
def one_field_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN4b: ranking of an index without grams, by words alone; benchmark items are queries, which read the postings of their terms."""
    index = search_index(spark, sf_dir, postings=True)
    terms = search.query_terms(table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query")))
    top = search.ranked(search.bm25(index["postings"], index["lengths"], terms, one_field=True), "score", "rank", 6).where("rank <= 10")
    return top.select("query_id", F.col("doc_key").alias("doc_id"), "rank", F.round("score", 4).alias("score"))


@registered("SELECT doc_id, lang, '2' AS schema_version FROM documents WHERE doc_id IN (SELECT vec_id FROM embeddings WHERE vec_id % 50 = 0)")
def indexed_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC12: rows and facts of the stored index."""
    index = search_index(spark, sf_dir)
    keys = [r["doc_key"] for r in index["embeddings"].where("doc_key % 50 = 0 and doc_key < 5000").select("doc_key").collect()]  # a list of a hundred at most
    rows = stores.scene_rows(index, keys) if index["embeddings"].where("doc_key >= 5000").isEmpty() else index["scene_cards"].join(index["embeddings"].where("doc_key % 50 = 0").select("doc_key"), "doc_key", "left_semi")
    return rows.select(F.col("doc_key").alias("doc_id"), "lang", F.lit(stores.meta_value(index["meta"], "schema_version")).alias("schema_version"))


@registered("SELECT doc_id::VARCHAR AS path, strlen(text) AS size_bytes, sha256(text) AS sha256 FROM documents")
def content_checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HSH1, HSH2: size and checksum of contents; texts stand for files."""
    d = table(spark, sf_dir, "documents")
    files = d.select(F.col("doc_id").cast("string").alias("path"), F.octet_length("text").cast("long").alias("length"), F.col("text").cast("binary").alias("content"))
    return stores.checksums(files)


@registered(f"""WITH {_TIMED}, c AS (SELECT *, CAST(floor(s / 86400) AS BIGINT) AS chunk FROM timed), x AS (SELECT user_id, chunk, event_id, round(chunk * 86400.0::DOUBLE + round(s - chunk * 86400.0::DOUBLE, 2), 3) AS a, round(chunk * 86400.0::DOUBLE + round(s - chunk * 86400.0::DOUBLE, 2) + 1, 3) AS b, round(-value / 300, 4) AS p FROM c WHERE event_id % 6 <> 0)
    SELECT user_id AS media_id, row_number() OVER (PARTITION BY user_id ORDER BY a, chunk, b, event_id) AS segment_id, a AS start_sec, b AS end_sec, p AS avg_logprob, 't' || event_id::VARCHAR AS text FROM x""")
def absolute_transcript(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MTH10, MTH11: lines of chunks on the medium's axis; empty texts go. A user's day is a chunk."""
    x = timed(spark, sf_dir).withColumn("chunk_id", F.floor(F.col("start_sec") / 86400))
    at = F.round(F.col("start_sec") - F.col("chunk_id") * 86400.0, 2)
    raw = x.select(F.col("user_id").alias("media_id"), "chunk_id", at.alias("start_sec"), (at + 1).alias("end_sec"), F.when(F.col("event_id") % 6 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" t"), F.col("event_id").cast("string"))).alias("text"), (-F.col("value") / 300).alias("avg_logprob"), F.lit(0.5).alias("no_speech_prob"))
    chunks = x.select(F.col("user_id").alias("media_id"), "chunk_id").distinct().select("media_id", "chunk_id", (F.col("chunk_id") * 86400.0).alias("start_sec"), F.array(F.lit(1)).alias("source_ids"))
    return audio.absolute_transcript(raw, chunks).select("media_id", F.col("segment_id").cast("long").alias("segment_id"), "start_sec", "end_sec", "avg_logprob", "text")


@registered(f"""WITH {_TIMED}, w AS (SELECT event_id, CAST(round_even(s * 16000, 0) AS BIGINT) AS a, CAST(round_even((s + value / 5000) * 16000, 0) AS BIGINT) AS b FROM timed), t AS (SELECT *, a + 200 AS total FROM w), c AS (SELECT *, CASE WHEN b > total AND b - total <= 160 THEN total ELSE b END AS z FROM t)
    SELECT event_id, a AS first_sample, z AS end_sample, greatest(0, 400 - (z - a)) AS padding, round((a - a % 16) / 16000.0::DOUBLE, 3) AS seconds FROM c""")
def window_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MTH10: samples of windows, with ends clamped to the audio and the silence that fills short ones."""
    x = timed(spark, sf_dir)
    total = F.rint(F.col("start_sec") * 16_000).cast("long") + 200
    a, b, more = numeric.event_samples(F.col("start_sec"), F.col("start_sec") + F.col("value") / 5000, total)
    return x.select("event_id", a.alias("first_sample"), b.alias("end_sample"), more.alias("padding"), numeric.seconds_of(a - a % 16).alias("seconds"))


@registered("SELECT user_id AS media_id, count(*) AS scene_count, round(avg(value), 6) AS avg_sec, min(value) AS min_sec, max(value) AS max_sec FROM events GROUP BY user_id")
def scene_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG6: how many scenes, and their mean, least and greatest length."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("media_id"), F.col("value").alias("duration_sec"))
    return media.scene_summary(e).withColumn("avg_sec", F.round("avg_sec", 6))


_STAMP = "printf('%02d:%02d', CAST(floor({0} / 60) AS BIGINT), CAST(floor({0}) AS BIGINT) % 60)".format
_SPAN = f"((scene_id - 1) * {_CARD_SPAN}::DOUBLE)", f"(scene_id * {_CARD_SPAN}::DOUBLE)"
#: Cards as text: what each line shows, an empty line's place taken by null.
_RENDERED = f"""{_CARDS}, spoken AS (SELECT t.user_id AS media_id, t.scene_id, string_agg('[' || {_STAMP('m.s')} || ']' || CASE WHEN tp.speaker IS NULL THEN '' ELSE ' (' || tp.speaker || ')' END || ' ' || t.t, chr(10) ORDER BY t.ev) AS said, string_agg(t.t, chr(10) ORDER BY t.ev) AS words, min_by(t.t, t.ev) AS first
      FROM tr t JOIN timed m ON m.event_id = t.ev LEFT JOIN tp ON tp.ev = t.ev GROUP BY ALL),
  heard AS (SELECT a.user_id AS media_id, a.scene_id, string_agg(a.t || printf(' (%.2f)', m.value / 500), ', ' ORDER BY a.ev) AS events FROM au a JOIN timed m ON m.event_id = a.ev GROUP BY ALL),
  shown AS (SELECT c.*, s.said, s.words, s.first, h.events, printf('%02d', c.scene_id) AS no, {_STAMP(_SPAN[0].replace('scene_id', 'c.scene_id'))} AS a, {_STAMP(_SPAN[1].replace('scene_id', 'c.scene_id'))} AS b FROM cards c LEFT JOIN spoken s ON s.media_id = c.media_id AND s.scene_id = c.scene_id LEFT JOIN heard h ON h.media_id = c.media_id AND h.scene_id = c.scene_id),
  rendered AS MATERIALIZED (SELECT media_id, scene_id, words,
    concat_ws(chr(10), '### 씬 ' || no || ' [' || a || ' ~ ' || b || ']', '챕터: ' || nullif(chapter, ''), '내장 자막: ' || nullif(subtitle_text, ''), '시각: ' || nullif(caption, ''), '화면 텍스트: ' || nullif(ocr_text, ''), '오디오 이벤트: ' || events, coalesce(said, '(발화 없음)')) AS block,
    '### 씬 ' || no || ' [' || a || ' ~ ' || b || ']' || chr(10) || coalesce(nullif(caption, ''), nullif(ocr_text, ''), nullif(chapter, ''), nullif(subtitle_text, ''), nullif(audio_event_text, ''), first, '(내용 없음)') AS compact,
    '- 씬 ' || no || ' [' || a || '~' || b || '] ' || coalesce(nullif(caption, ''), nullif(ocr_text, ''), nullif(chapter, ''), nullif(subtitle_text, ''), nullif(audio_event_text, ''), first[1:40], '(내용 없음)') AS toc,
    concat_ws(chr(10), nullif(trim(caption), ''), nullif(trim(ocr_text), ''), nullif(trim(chapter), ''), nullif(trim(subtitle_text), ''), nullif(trim(audio_event_text), ''), nullif(words, '')) AS card_text FROM shown)"""


@registered(f"WITH {_RENDERED} SELECT media_id, scene_id, md5(block) AS block_md5, md5(compact) AS compact_md5, toc, md5(card_text) AS text_md5 FROM rendered")
def rendered_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ2, PRJ3, PRJ4, PRJ5, STR4: cards as blocks, compact blocks, overview lines and search texts."""
    cards, _ = timeline.scene_cards(_sources(spark, sf_dir), _CARD_SPAN)
    text = cards.select("media_id", "scene_id", F.md5(search.card_text().cast("binary")).alias("text_md5"))
    out = context.rendered(cards)
    md5 = lambda c: F.md5(F.col(c).cast("binary")).alias(f"{c}_md5")
    return out.select("media_id", "scene_id", md5("block"), md5("compact"), "toc").join(text, ["media_id", "scene_id"])


_PREAMBLE = context.PREAMBLE.replace("'", "''")
_META = "'- 파일명: user ' || media_id::VARCHAR || chr(10) || '- 길이: ' || {0} || printf(' (%.0f초)', length) || chr(10) || '- 씬 수: ' || n::VARCHAR || chr(10) || '- 감지된 화자: 3명 (S0, S1, S2)'".format(_STAMP("length"))
_ABOUT = f"{_RENDERED}, about AS (SELECT media_id, max(scene_id) * {_CARD_SPAN}::DOUBLE AS length, count(*) AS n, string_agg(toc, chr(10) ORDER BY scene_id) AS tocs, string_agg(block || chr(10), chr(10) ORDER BY scene_id) AS blocks FROM rendered GROUP BY media_id), meta AS MATERIALIZED (SELECT *, {_META} AS meta FROM about)"


def _about(cards: DataFrame) -> DataFrame:
    return cards.groupBy("media_id").agg(F.max("end_sec").alias("duration_sec"), F.count(F.lit(1)).alias("scene_count")).withColumns({"name": F.concat(F.lit("user "), F.col("media_id").cast("string")), "speakers": F.array(F.lit("S0"), F.lit("S1"), F.lit("S2"))})


@registered(f"""WITH {_ABOUT}, c AS (SELECT media_id, regexp_replace('# 영상 분석 컨텍스트: user ' || media_id::VARCHAR || chr(10) || chr(10) || '{_PREAMBLE}' || chr(10) || chr(10) || '## 영상 메타데이터' || chr(10) || meta || chr(10) || chr(10) || '## 씬 목차' || chr(10) || tocs || chr(10) || chr(10) || '## 씬 상세 (씬 카드)' || chr(10) || blocks, '\\s+$', '') || chr(10) AS t FROM meta)
    SELECT media_id, md5(t) AS context_md5, CAST(length(t) AS INTEGER) AS chars, CAST(floor(length(t) / 2.5) AS BIGINT) AS est_tokens FROM c""")
def static_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ6, PRJ8, AGG21: the whole context of each medium, and its size."""
    cards, _ = timeline.scene_cards(_sources(spark, sf_dir), _CARD_SPAN)
    out = context.static_context(cards, _about(cards))
    return out.select("media_id", F.md5(F.col("context").cast("binary")).alias("context_md5"), F.col("chars").cast("int").alias("chars"), "est_tokens")


_COUNT = "len(regexp_extract_all({0}, '\\S+'))".format


@registered(f"""WITH RECURSIVE {_ABOUT}, fixed AS (SELECT media_id, {_COUNT(f"'# 영상 분석 컨텍스트: user ' || media_id::VARCHAR || chr(10) || '{_PREAMBLE}' || chr(10) || '## 영상 메타데이터' || chr(10) || meta || chr(10) || '## 씬 목차' || chr(10) || '## 씬 상세 (씬 카드)'")} AS base FROM meta),
  items AS MATERIALIZED (SELECT media_id, row_number() OVER (PARTITION BY media_id ORDER BY scene_id) AS k, {_COUNT('toc')} AS t, {_COUNT('block')} AS b, {_COUNT('compact')} AS c FROM rendered),
  f AS (SELECT media_id, 0::BIGINT AS k, base AS used, 0 AS taken, 0 AS short, 0 AS gone FROM fixed UNION ALL
    SELECT media_id, k, CASE WHEN whole THEN used + t + b WHEN room > 0 THEN used + t + room ELSE used END, taken + CASE WHEN whole OR room > 0 THEN 1 ELSE 0 END, short + CASE WHEN NOT whole AND room > 0 THEN 1 ELSE 0 END, gone + CASE WHEN NOT whole AND room <= 0 THEN 1 ELSE 0 END
    FROM (SELECT f.media_id, i.k, f.used, f.taken, f.short, f.gone, i.t, i.b, f.used + i.t + i.b <= 512 AS whole, least(512 - f.used - 2, i.c, 512 - f.used - i.t) AS room FROM f JOIN items i ON i.media_id = f.media_id AND i.k = f.k + 1))
  SELECT media_id, CAST(used AS BIGINT) AS token_count, CAST(taken AS INTEGER) AS included, CAST(gone AS INTEGER) AS excluded, CAST(short AS INTEGER) AS truncated FROM f QUALIFY row_number() OVER (PARTITION BY media_id ORDER BY k DESC) = 1""")
def context_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN10, WIN10b, STR10, PRJ3 to PRJ6, SRC16: contexts of all media under a token budget, by a fold over each medium's cards."""
    cards, _ = timeline.scene_cards(_sources(spark, sf_dir), _CARD_SPAN)
    out = context.budget_context(cards, _about(cards), 512)
    return out.select("media_id", "token_count", F.size("included").alias("included"), F.size("excluded").alias("excluded"), F.size("truncated").alias("truncated"))


@registered(f"""WITH {_CARDS}, lost AS (SELECT user_id AS media_id, event_type, string_agg(event_id::VARCHAR, ',' ORDER BY event_id::VARCHAR) AS ids FROM timed t WHERE event_type IN ('purchase', 'error') AND NOT EXISTS (SELECT 1 FROM sc WHERE sc.user_id = t.user_id AND sc.s < t.e AND t.s < sc.e AND t.s < t.e) GROUP BY ALL)
    SELECT c.media_id, count(*) AS scene_card_count, coalesce(any_value(p.ids), '') AS unassigned_transcript_ids, coalesce(any_value(e.ids), '') AS unassigned_events_ids FROM cards c LEFT JOIN lost p ON p.media_id = c.media_id AND p.event_type = 'purchase' LEFT JOIN lost e ON e.media_id = c.media_id AND e.event_type = 'error' GROUP BY c.media_id""")
def timeline_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG5, JOI2, D15: counts of cards with the ids of lines and events that met no scene."""
    out = timeline.envelope(*timeline.scene_cards(_sources(spark, sf_dir), _CARD_SPAN))
    ids = lambda c: F.array_join(c, ",").alias(c)
    return out.select("media_id", "scene_card_count", ids("unassigned_transcript_ids"), ids("unassigned_events_ids"))


@registered("SELECT b.item_id, count(*) AS n, min(d.doc_id) AS first FROM benchmark b JOIN documents d ON contains(d.text, b.text) GROUP BY b.item_id")
def passage_holders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG14, SRC20: documents that hold a benchmark passage word for word, by one automaton of all passages."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc_key"), "text")
    cases = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("case_id"), "text")
    return evaluation.passage_matches(spark, docs, cases).groupBy(F.col("case_id").alias("item_id")).agg(F.count(F.lit(1)).alias("n"), F.min("doc_key").alias("first"))


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream of its files."""
    schema = table(spark, sf_dir, "events").schema
    e = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")  # a pattern, as a stream's path may not be a single file
    at = F.convert_timezone(F.lit("UTC"), F.current_timezone(), "ts") if schema["ts"].dataType.typeName() == "timestamp_ntz" else F.col("ts")
    return e.select(F.col("user_id").alias("media_id"), F.col("event_type").alias("label"), at.cast("timestamp").alias("ts"), (F.col("value") / 500).alias("confidence"), "event_id", "value")


def _drained(spark: SparkSession, df: DataFrame, mode: str = "complete") -> DataFrame:
    return streams.settled(df, f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}", mode)


@registered("SELECT user_id AS media_id, event_type AS label, CAST(epoch_us(ts) // 3600000000 - k AS BIGINT) AS slot, count(*) AS n, round(max(value / 500), 6) AS confidence FROM events, range(2) t(k) GROUP BY ALL")
def stream_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STM1: windows of two hours, each hour, over a stream."""
    out = _drained(spark, streams.sliding_counts(_stream(spark, sf_dir), "2 hours", "1 hour", "1 day"))
    return out.select("media_id", "label", (F.unix_micros("window.start") / 3_600_000_000).cast("long").alias("slot"), "n", F.round("confidence", 6).alias("confidence"))


@registered("""WITH m AS (SELECT user_id, event_id, epoch_us(ts) AS a, epoch_us(ts) + 30000000 AS b FROM events), f AS (SELECT *, CASE WHEN a < max(b + 3600000000) OVER (PARTITION BY user_id ORDER BY a, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM m),
    r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY a, event_id) AS run FROM f) SELECT user_id AS media_id, CAST(min(a) AS BIGINT) AS start_us, CAST(max(b) AS BIGINT) AS end_us, count(*) AS n FROM r GROUP BY user_id, run""")
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STM2: runs of segments with small gaps, over a stream."""
    x = _stream(spark, sf_dir).withColumn("end_ts", F.col("ts") + F.expr("INTERVAL 30 SECONDS"))
    out = _drained(spark, streams.speech_sessions(x, 3600.0, "1 day"))
    return out.select("media_id", F.unix_micros("start_ts").alias("start_us"), F.unix_micros("end_ts").alias("end_us"), "n")


@registered("SELECT user_id AS media_id, CAST(epoch_us(ts) // 900000000 AS BIGINT) AS slot, count(*) AS n FROM events GROUP BY ALL")
def stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STM3: windows of a quarter of an hour, over a stream."""
    out = _drained(spark, streams.tumbling(_stream(spark, sf_dir), "15 minutes", "1 day"))
    return out.select("media_id", (F.unix_micros("window.start") / 900_000_000).cast("long").alias("slot"), "n")


@registered(f"WITH {_TIMED} SELECT event_id, CAST(floor((s + value / 2) / {_CARD_SPAN}) + 1 AS BIGINT) AS scene_id FROM timed")
def stream_assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STM4, JOI1: a stream's segments beside the scenes that hold their middles, without state."""
    s = table(spark, sf_dir, "events").select(F.col("user_id").alias("media_id")).distinct().withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(400))))
    scenes = s.select("media_id", (F.col("k") + 1).cast("long").alias("scene_id"), (F.col("k") * _CARD_SPAN).alias("start_sec"), ((F.col("k") + 1) * _CARD_SPAN).alias("end_sec"))
    at = F.expr("(unix_micros(ts) - 1704067200000000) / 1000000.0D")
    x = _stream(spark, sf_dir).select("media_id", "event_id", at.alias("start_sec"), (at + F.col("value")).alias("end_sec"))
    return _drained(spark, streams.assigned(x, scenes, _CARD_SPAN), "append").select("event_id", "scene_id")


@registered("SELECT o_orderpriority AS run_id, o_orderstatus AS stage, max_by(CASE WHEN o_totalprice > 100000 THEN 'succeeded' ELSE 'failed' END, (o_orderkey, o_orderkey::VARCHAR)) AS status, max(o_orderkey) AS attempt FROM orders GROUP BY ALL")
def stage_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG19, SRC19: the last attempt of each run's stages."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("run_id"), F.col("o_orderstatus").alias("stage"), F.when(F.col("o_totalprice") > 100000, "succeeded").otherwise("failed").alias("status"), F.col("o_orderkey").alias("attempt"), F.col("o_orderkey").cast("string").alias("recorded_at"))
    return stores.stage_state(o)


@registered("""WITH m AS (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS place FROM embeddings) SELECT label, string_agg(vec_id::VARCHAR, ',' ORDER BY vec_id) AS newest FROM (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY label ORDER BY vec_id DESC) <= 3) GROUP BY label""")
def newest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN12b: the newest rows of each group (a report of a fixed size)."""
    e = overlay.latest(table(spark, sf_dir, "embeddings").select("vec_id", "label"), ["label"], ["vec_id"], 3)
    return e.groupBy("label").agg(F.array_join(F.transform(F.sort_array(F.collect_list("vec_id")), lambda x: x.cast("string")), ",").alias("newest"))


@registered("SELECT event_id, CAST(epoch_us(ts) AS BIGINT) AS us, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS place FROM events")
def iso_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DAT1: ISO 8601 times of several offsets as instants, and their order."""
    e = timed(spark, sf_dir)
    us = F.round(F.col("start_sec") * 1_000_000).cast("long") + 1_704_067_200_000_000
    hours = F.col("event_id") % 5 - 2
    local = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.timestamp_micros(us + hours * 3_600_000_000).cast("timestamp_ntz"))
    offset = F.when(hours == 0, F.lit("Z")).otherwise(F.concat(F.when(hours < 0, F.lit("-")).otherwise(F.lit("+")), F.format_string("%02d:00", F.abs(hours))))
    at = text.instant(F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), offset))
    x = e.select("event_id", "user_id", at.alias("at"))
    place = F.row_number().over(Window.partitionBy("user_id").orderBy("at", "event_id")).cast("long")
    return x.select("event_id", F.unix_micros("at").alias("us"), place.alias("place"))
