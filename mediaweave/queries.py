"""Registered queries: each operator over the driver's tables, which stand in for media, and DuckDB SQL for the same rows.

Stand-ins: `events` are segments on a time axis (seconds since the start of 2024, `value` seconds long), `embeddings` are vectors and
coefficients of frames, `documents` are card texts, `benchmark` items are search queries.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .functions import numeric, text
from .operators import audio, context, evaluation, intervals, keyframes, overlay, search, timeline, visual
from .plans.runs import newest_terminal
from .plans.stages import DEFAULT_STAGES
from .session import shared_dir, spread
from .sources import media, stores

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def registered(sql: str | None = None):
    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df, "doc_id") if name == "documents" else df


#: Windows of 15 minutes in January 2024.
WINDOWS, SPAN = 2976, 900.0


def seconds(column: str = "ts") -> F.Column:
    return F.expr(f"(unix_micros(cast({column} as timestamp)) - unix_micros(cast(timestamp_ntz'2024-01-01 00:00:00' as timestamp))) / 1000000.0D")


def timed(spark: SparkSession, sf_dir: str, *kinds: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    e = e.where(F.col("event_type").isin(*kinds)) if kinds else e
    return e.withColumn("start_sec", seconds()).withColumn("end_sec", F.col("start_sec") + F.col("value"))


def windows(spark: SparkSession, n: int = WINDOWS, span: float = SPAN) -> DataFrame:
    return spark.range(n).select(F.lit(0).alias("media_id"), (F.col("id") + 1).alias("scene_id"), (F.col("id") * span).alias("start_sec"), ((F.col("id") + 1) * span).alias("end_sec"))


def segments(spark: SparkSession, sf_dir: str, *kinds: str) -> DataFrame:
    return timed(spark, sf_dir, *kinds).select(F.lit(0).alias("media_id"), F.col("event_id").alias("seg_id"), "start_sec", "end_sec", "user_id")


_TIMED = "timed AS (SELECT *, (epoch_us(ts) - 1704067200000000) / 1000000.0::DOUBLE AS s, (epoch_us(ts) - 1704067200000000) / 1000000.0::DOUBLE + value AS e FROM events)"
_WINDOWS = f"scenes AS (SELECT i + 1 AS scene_id, i * {SPAN}::DOUBLE AS s, (i + 1) * {SPAN}::DOUBLE AS e FROM range({WINDOWS}) t(i))"


def _best(seg: str, interval: str, key: str, order: str, extra: str = "", on: str = "true") -> str:
    """SQL of the interval that each segment belongs to. Both sides have s and e."""
    return f"""pairs AS (SELECT g.{key} AS seg, i.*, least(g.e, i.e) - greatest(g.s, i.s) AS ov, (g.s + g.e) / 2.0 AS mid {extra}
        FROM {seg} g JOIN {interval} i ON {on} AND g.s < i.e AND i.s < g.e AND g.s < g.e AND i.s < i.e),
      tied AS (SELECT *, max(ov) OVER (PARTITION BY seg) AS most FROM pairs),
      best AS (SELECT * FROM tied WHERE abs(ov - most) <= greatest(1e-9 * greatest(abs(ov), abs(most)), 1e-9)
        QUALIFY row_number() OVER (PARTITION BY seg ORDER BY CASE WHEN mid >= s AND mid < e THEN 0 ELSE 1 END, {order}) = 1)"""


@registered(f"""WITH {_TIMED}, {_WINDOWS}, {_best('timed', 'scenes', 'event_id', 'scene_id')}
    SELECT seg AS seg_id, scene_id, round(ov, 6) AS overlap FROM best""")
def interval_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOI1, JOI2, FIL1, FIL2, MTH1, MTH2: segments to their scenes."""
    best = intervals.best_overlap(segments(spark, sf_dir), windows(spark), ["media_id"], "seg_id", "scene_id", SPAN)
    return best.select(F.col("s_seg_id").alias("seg_id"), F.col("i_scene_id").alias("scene_id"), F.round("overlap", 6).alias("overlap"))


@registered(f"""WITH {_TIMED}, seg AS (SELECT * FROM timed WHERE event_type <> 'click'), turns AS (SELECT * FROM timed WHERE event_type = 'click'),
    {_best('seg', 'turns', 'event_id', 'event_id')}
    SELECT g.event_id AS seg_id, CASE WHEN b.seg IS NULL THEN NULL ELSE 'SPEAKER_0' || CAST(b.user_id % 4 AS VARCHAR) END AS speaker FROM seg g LEFT JOIN best b ON b.seg = g.event_id""")
def speaker_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOI3: each segment's speaker; turns may overlap. Clicks are turns, all other events segments."""
    turns = segments(spark, sf_dir, "click").withColumn("speaker", F.concat(F.lit("SPEAKER_0"), (F.col("user_id") % 4).cast("string")))
    out = intervals.assign(segments(spark, sf_dir).join(turns.select("seg_id"), "seg_id", "left_anti").drop("user_id"), turns, ["media_id"], "seg_id", "seg_id", ["speaker"], 300.0)
    return out.select("seg_id", "speaker")


@registered(f"""WITH {_TIMED}, {_WINDOWS} SELECT event_id AS seg_id FROM timed t WHERE NOT EXISTS (
    SELECT 1 FROM scenes i WHERE i.scene_id % 4 <> 0 AND least(t.e, i.e) > greatest(t.s, i.s))""")
def unassigned_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOI2, STM4: segments that meet no scene are reported."""
    out = intervals.assign(segments(spark, sf_dir), windows(spark).where("scene_id % 4 <> 0"), ["media_id"], "seg_id", "scene_id", ["scene_id"], SPAN)
    return intervals.unassigned(out, "scene_id").select("seg_id")


@registered(f"""WITH {_TIMED}, m AS (SELECT user_id, event_id, s, s + 30 AS e FROM timed), f AS (
    SELECT *, CASE WHEN s - lag(e) OVER w <= 3600 THEN 0 ELSE 1 END AS n FROM m WINDOW w AS (PARTITION BY user_id ORDER BY s, event_id)),
    r AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY s, event_id) AS run FROM f)
    SELECT user_id, CAST(run AS BIGINT) AS chunk_id, round(min(s), 6) AS start_sec, round(max_by(e, s), 6) AS end_sec, string_agg(event_id::VARCHAR, ',' ORDER BY s, event_id) AS ids FROM r GROUP BY user_id, run""")
def gap_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN1: runs of segments with small gaps."""
    x = timed(spark, sf_dir).select("user_id", "event_id", "start_sec", (F.col("start_sec") + 30).alias("end_sec"))
    out = intervals.gap_merge(x, ["user_id"], 3600.0, "event_id")
    return out.select("user_id", "chunk_id", F.round("start_sec", 6).alias("start_sec"), F.round("end_sec", 6).alias("end_sec"), F.array_join(F.transform("source_ids", lambda i: i.cast("string")), ",").alias("ids"))


@registered(f"""WITH {_TIMED}, f AS (SELECT event_type AS label, event_id, s, e, value / 500 AS c, CASE WHEN s <= max(e) OVER (PARTITION BY event_type ORDER BY s, e, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS n FROM timed),
    r AS (SELECT *, sum(n) OVER (PARTITION BY label ORDER BY s, e, event_id) AS run FROM f),
    g AS (SELECT label, round(max(c), 6) AS confidence, min(s) AS a, max(e) AS b, count(*) AS n_windows FROM r GROUP BY label, run)
    SELECT row_number() OVER (ORDER BY a, b, label) AS event_id, label, confidence, round(a, 6) AS start_sec, round(b, 6) AS end_sec, n_windows FROM g""")
def overlap_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN2, AGG10, UDF7: islands of overlapping windows of a label."""
    x = timed(spark, sf_dir).select(F.lit(0).alias("media_id"), F.col("event_type").alias("label"), F.col("event_id").alias("window_id"), "start_sec", "end_sec", (F.col("value") / 500).alias("confidence"))
    out = intervals.overlap_merge(x, ["media_id"])
    return out.select(F.col("event_id").cast("long").alias("event_id"), "label", "confidence", F.round("start_sec", 6).alias("start_sec"), F.round("end_sec", 6).alias("end_sec"), F.size("source_window_ids").cast("long").alias("n_windows"))


@registered(f"""WITH {_TIMED}, d AS (SELECT user_id, max(s) AS duration FROM timed GROUP BY user_id)
    SELECT user_id, k + 1 AS window_id, round(k * 3600.0::DOUBLE, 6) AS start_sec, round(least(k * 3600.0::DOUBLE + 7200, duration), 6) AS end_sec FROM d, range(1000) t(k) WHERE k * 3600.0 < duration""")
def sliding_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN3, STM1: windows from 0, clipped at the end."""
    d = timed(spark, sf_dir).groupBy("user_id").agg(F.max("start_sec").alias("duration"))
    return intervals.sliding_windows(d, "duration", 7200.0, 3600.0)


@registered(f"""WITH {_TIMED}, sc AS (SELECT event_id AS scene_id, s, lead(s) OVER (PARTITION BY user_id ORDER BY s, event_id) AS e FROM timed),
    c AS (SELECT *, CASE WHEN e - s < 3600 THEN 1 WHEN e - s < 7200 THEN 2 ELSE 3 END AS n FROM (SELECT scene_id, s / 450 AS s0, s, e FROM sc WHERE e IS NOT NULL)),
    k AS (SELECT scene_id, s, e, CASE WHEN (e - s) / 450 < 8 THEN 1 WHEN (e - s) / 450 < 20 THEN 2 ELSE 3 END AS n FROM c)
    SELECT scene_id, CAST(n AS INTEGER) AS candidate_count, CAST(i AS INTEGER) AS candidate_index, round(s / 450 + (e / 450 - s / 450) / (n + 1) * i, 3) AS timestamp_sec FROM k, range(1, 4) t(i) WHERE i <= n""")
def adaptive_keyframes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN7: how many frames a scene has, and where. Scenes run from one event of a user to the next, 450 times as fast."""
    w = Window.partitionBy("user_id").orderBy("start_sec", "event_id")
    x = timed(spark, sf_dir).withColumn("e", F.lead("start_sec").over(w)).where("e is not null")
    x = x.select(F.col("event_id").alias("scene_id"), (F.col("start_sec") / 450).alias("start_sec"), (F.col("e") / 450).alias("end_sec"))
    return keyframes.candidates(x).select("scene_id", "candidate_count", "candidate_index", "timestamp_sec")


_HASH = """h AS (SELECT vec_id, label, list_sum(list_transform(range(1, 65), lambda i: CASE WHEN embedding[i] > list_sort(embedding[2:64])[32] THEN (1::HUGEINT << (64 - i)) ELSE 0 END))::UBIGINT AS hash FROM embeddings)"""


def _hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("label").alias("scene_id"), F.col("vec_id").alias("candidate_index"), F.col("vec_id").cast("double").alias("timestamp_sec"), numeric.hash_bits(F.col("embedding")).alias("perceptual_hash"))


@registered(f"WITH {_HASH} SELECT vec_id, lower(lpad(to_hex(hash), 16, '0')) AS perceptual_hash FROM h")
def phash_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MTH3, AGG15: 64 bits of 64 coefficients."""
    return _hashed(spark, sf_dir).select(F.col("candidate_index").alias("vec_id"), "perceptual_hash")


@registered(f"WITH {_HASH} SELECT vec_id, CAST(bit_count(xor(hash, lead(hash) OVER (PARTITION BY label ORDER BY vec_id))) AS INTEGER) AS distance FROM h")
def hamming_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MTH4: distance of each hash to the next of its label."""
    w = Window.partitionBy("scene_id").orderBy("candidate_index")
    x = _hashed(spark, sf_dir).withColumn("h", numeric.hash_halves(F.col("perceptual_hash")))
    return x.select(F.col("candidate_index").alias("vec_id"), numeric.hamming(F.col("h"), F.lead("h").over(w)).cast("int").alias("distance"))


@registered(f"""WITH RECURSIVE {_HASH}, o AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS pos FROM h),
    r AS (SELECT label, pos, vec_id, [{{'h': hash, 'id': vec_id}}] AS kept, true AS retained, NULL::INTEGER AS d, NULL::BIGINT AS dup FROM o WHERE pos = 1
      UNION ALL
      SELECT label, pos, vec_id, CASE WHEN m.d <= 24 THEN kept ELSE list_append(kept, {{'h': hash, 'id': vec_id}}) END, m.d > 24, CASE WHEN m.d <= 24 THEN m.d::INTEGER END, CASE WHEN m.d <= 24 THEN m.id END
      FROM (SELECT o.label, o.pos, o.vec_id, o.hash, r.kept, list_sort(list_transform(r.kept, lambda k: {{'d': bit_count(xor(o.hash, k.h)), 'id': k.id}}))[1] AS m FROM r JOIN o ON o.label = r.label AND o.pos = r.pos + 1))
    SELECT label, vec_id, retained, d AS hamming_distance, dup AS duplicate_of FROM r""")
def greedy_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN8: frames without near-duplicates, at a distance at which some go."""
    out = keyframes.greedy_dedup(_hashed(spark, sf_dir), ["scene_id"], 24)
    return out.select(F.col("scene_id").alias("label"), F.col("candidate_index").alias("vec_id"), "retained", "hamming_distance", "duplicate_of")


@registered(f"""WITH {_TIMED}, {_WINDOWS}, f AS (SELECT event_id, s AS tm, CAST(floor(s / {SPAN}) + 1 AS BIGINT) AS scene_id FROM timed)
    SELECT scene_id, event_id FROM f JOIN scenes USING (scene_id) QUALIFY row_number() OVER (PARTITION BY scene_id ORDER BY abs(tm - (s + e) / 2.0), event_id) = 1""")
def nearest_keyframe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOI7: the frame nearest to a scene's middle."""
    f = timed(spark, sf_dir).select((F.floor(F.col("start_sec") / SPAN) + 1).alias("scene_id"), F.col("event_id").alias("keyframe_index"), F.col("start_sec").alias("timestamp_sec"))
    return keyframes.nearest_frame(windows(spark), f, ["scene_id"]).select("scene_id", F.col("keyframe_index").alias("event_id"))


@registered("""WITH p AS (SELECT source, trim(lang) AS lang, min(doc_id) AS first FROM documents GROUP BY source, trim(lang))
    SELECT source, string_agg(lang, ' | ' ORDER BY first) AS langs FROM p GROUP BY source""")
def ordered_unique_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG1, AGG2, SET4: texts in order of first appearance."""
    d = table(spark, sf_dir, "documents")
    # only the first place of each text matters, so groups shrink before they are gathered
    first = d.groupBy("source", "lang").agg(F.min("doc_id").alias("pos"))
    langs = F.transform(timeline.in_order("lang"), lambda r: r["lang"])
    return first.groupBy("source").agg(timeline.ordered_unique(langs).alias("langs"))


_NORMAL = "trim(regexp_replace(replace(lower(text), 'ß', 'ss'), '[^\\p{L}\\p{N}]+', ' ', 'g'))"


@registered(f"SELECT doc_id, {_NORMAL} AS normalized FROM documents")
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR1 as built-in functions."""
    return table(spark, sf_dir, "documents").select("doc_id", text.normalized(F.col("text")).alias("normalized"))


@registered(f"SELECT doc_id, {_NORMAL} AS normalized FROM documents")
def normalize_text_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR1 with every rule of NFKC and case folding."""
    return table(spark, sf_dir, "documents").select("doc_id", text.normalize_udf("text").alias("normalized"))


_GRAMS = "list_distinct(flatten(list_transform(list_filter(string_split(t, ' '), lambda w: w <> ''), lambda w: list_concat(CASE WHEN length(w) >= 2 THEN list_transform(range(1, length(w)), lambda i: substring(w, i, 2)) ELSE [] END, CASE WHEN length(w) >= 3 THEN list_transform(range(1, length(w) - 1), lambda i: substring(w, i, 3)) ELSE [] END))))"


@registered(f"WITH n AS (SELECT doc_id, {_NORMAL} AS t FROM documents) SELECT doc_id, CAST(len({_GRAMS}) AS INTEGER) AS n_grams, md5(array_to_string(list_sort({_GRAMS}), ' ')) AS grams_md5 FROM n")
def char_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR2, STR3: distinct grams inside words."""
    g = text.character_ngrams(text.normalized(F.col("text")))
    return table(spark, sf_dir, "documents").select("doc_id", g.alias("g")).select("doc_id", F.size("g").alias("n_grams"), F.md5(F.array_join(F.sort_array("g"), " ").cast("binary")).alias("grams_md5"))


#: Grams of a query: the first ones, by word, size and place.
_QUERY_GRAMS = """qg AS (SELECT query_id, g FROM (SELECT query_id, g, min(p) AS p FROM (SELECT query_id, unnest(l) AS g, generate_subscripts(l, 1) AS p FROM (SELECT query_id, %s AS l FROM qn)) GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY p) <= 128)""" % _GRAMS.replace("list_distinct(", "(", 1)
_FOLD = f"translate(%s, '{search.FOLD_FROM}', '{search.FOLD_TO}')"


def _bm25_sql(asked: str) -> str:
    """Common tables up to kw (query_id, doc_id, score, rank) for the queries (query_id, text) that `asked` selects."""
    return f"""qs AS ({asked}), dn AS MATERIALIZED (SELECT doc_id, {_NORMAL} AS t FROM documents), qn AS MATERIALIZED (SELECT query_id, {_NORMAL} AS t FROM qs), {_QUERY_GRAMS},
  toks AS MATERIALIZED (SELECT doc_id, 'w' AS field, {_FOLD % 'w'} AS term FROM (SELECT doc_id, unnest(string_split(t, ' ')) AS w FROM dn) WHERE w <> ''
    UNION ALL SELECT doc_id, 'g', {_FOLD % 'g'} FROM (SELECT doc_id, unnest({_GRAMS}) AS g FROM dn)),
  post AS MATERIALIZED (SELECT field, term, doc_id, count(*) AS tf FROM toks GROUP BY ALL), lens AS (SELECT d.doc_id, count(t.term) AS len FROM dn d LEFT JOIN toks t USING (doc_id) GROUP BY d.doc_id),
  st AS (SELECT count(*) AS n, avg(len) AS average FROM lens),
  terms AS (SELECT query_id, 'w' AS field, {_FOLD % 'w'} AS term FROM (SELECT DISTINCT query_id, unnest(string_split(t, ' ')) AS w FROM qn) WHERE w <> '' UNION ALL SELECT query_id, 'g', {_FOLD % 'g'} FROM qg),
  df AS (SELECT field, term, count(*) AS df FROM post GROUP BY field, term),
  parts AS (SELECT query_id, doc_id, greatest(ln((n - df + 0.5) / (df + 0.5)), 0) AS i0, CASE WHEN field = 'w' THEN 5.0 ELSE 1.0 END * tf AS f, len, average FROM terms JOIN post USING (field, term) JOIN df USING (field, term) JOIN lens USING (doc_id), st),
  bm AS (SELECT query_id, doc_id, sum((CASE WHEN i0 > 0 THEN i0 ELSE 1e-6 END) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * len / average))) AS score FROM parts GROUP BY query_id, doc_id),
  kw AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, doc_id) AS rank FROM bm)"""


#: The searches' queries: every text whose id is divisible by fifty, and the vectors of the same ids.
_EVERY_FIFTIETH = "SELECT doc_id AS query_id, text FROM documents WHERE doc_id % 50 = 0"
_SIMILAR = "sem AS (SELECT q.vec_id AS query_id, e.vec_id AS doc_id, list_sum(list_transform(range(1, 65), lambda i: e.embedding[i]::DOUBLE * q.embedding[i]::DOUBLE)) AS sim FROM embeddings e, (SELECT * FROM embeddings WHERE vec_id % 50 = 0) q), sr AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(sim, 6) DESC, doc_id) AS rank FROM sem)"


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_key"), F.col("embedding").alias("vector"))


_indexes: dict[tuple[str, str], str] = {}


def search_index(spark: SparkSession, sf_dir: str, postings: bool = False) -> dict[str, DataFrame]:
    """The stored index of all documents and vectors, written once for each application and folder of tables; postings when first asked for."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _indexes:
        path = f"{shared_dir(spark)}/index-{uuid.uuid4().hex}"
        stores.build_index(spark, path, table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), "doc_id", F.col("text"), _vectors(spark, sf_dir), {"schema_version": "2"}, with_postings=False)
        _indexes[key] = path
    index = stores.read_index(spark, _indexes[key])
    if postings and "postings" not in index:
        stores.add_postings(spark, _indexes[key])
        index = stores.read_index(spark, _indexes[key])
    return index


def _word_scorer(spark: SparkSession, sf_dir: str, queries: DataFrame) -> search.WordScorer:
    index = search_index(spark, sf_dir)
    return search.WordScorer(index["forward"], index["terms"], search.query_terms(queries))


def _fiftieth(spark: SparkSession, sf_dir: str) -> tuple[search.WordScorer, search.VectorScorer]:
    index = search_index(spark, sf_dir)
    asked = index["scene_cards"].where("doc_key % 50 = 0").select(F.col("doc_key").alias("query_id"), F.col("text").alias("query"))
    e = index["embeddings"]
    return _word_scorer(spark, sf_dir, asked), search.VectorScorer(e, e.where("doc_key % 50 = 0").withColumnRenamed("doc_key", "query_id"))


@registered(f"WITH {_bm25_sql(_EVERY_FIFTIETH)} SELECT query_id, doc_id, rank, round(score, 4) AS score FROM kw WHERE rank <= 20")
def bm25_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG12, MTH7, WIN4, STR3, SRT5, SRC12, SRC13: keyword search over the stored index; every fiftieth text is a query."""
    top = search.best_of(_fiftieth(spark, sf_dir)[0], 20, 6)
    return top.select("query_id", F.col("doc_key").alias("doc_id"), "rank", F.round("score", 4).alias("score"))


@registered(f"""WITH {_bm25_sql(_EVERY_FIFTIETH).replace("'g', ", "'g' AS field, ").replace("CASE WHEN field = 'w' THEN 5.0 ELSE 1.0 END", "CASE WHEN field = 'w' THEN 1.0 ELSE 0.0 END")},
    asked AS (SELECT DISTINCT field, term FROM terms) SELECT field, count(*) AS n_terms, CAST(sum(df) AS BIGINT) AS n_postings FROM df JOIN asked USING (field, term) GROUP BY field""")
def stored_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC13, STR2, STR3: postings of the queries' terms, read from the stored index by term."""
    index = search_index(spark, sf_dir, postings=True)
    asked = index["scene_cards"].where("doc_key % 50 = 0").select(F.col("doc_key").alias("query_id"), F.col("text").alias("query"))
    terms = search.query_terms(asked).select("field", "term").distinct()
    found = search.term_counts(index["postings"].join(terms, ["field", "term"], "left_semi"))
    return found.groupBy(F.when(F.col("field") == "normalized_text", "w").otherwise("g").alias("field")).agg(F.count(F.lit(1)).alias("n_terms"), F.sum("df").alias("n_postings"))


@registered(f"WITH {_SIMILAR} SELECT query_id, r.doc_id AS vec_id, round(sim, 6) AS similarity, rank FROM sr r JOIN embeddings a ON a.vec_id = r.query_id JOIN embeddings b ON b.vec_id = r.doc_id WHERE a.label = b.label")
def semantic_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MTH5, MTH6, WIN5: every fiftieth vector as a query; the places, among all vectors, of those that share its label."""
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_key"), F.col("embedding").alias("vector"), F.col("label").alias("class"))
    out = search.ranks_within(search.ClassScorer(e, e.where("doc_key % 50 = 0").withColumnRenamed("doc_key", "query_id")), 6)
    return out.select("query_id", F.col("doc_key").alias("vec_id"), F.round("score", 6).alias("similarity"), "rank")


@registered(f"WITH {_SIMILAR} SELECT query_id, doc_id AS vec_id, round(sim, 6) AS similarity, rank FROM sr WHERE rank <= 10")
def semantic_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MTH5, MTH6, WIN5: every fiftieth vector as a query against all vectors, the ten best of each."""
    e = _vectors(spark, sf_dir)
    out = search.nearest(e, e.where("doc_key % 50 = 0").withColumnRenamed("doc_key", "query_id"), 10)
    return out.select("query_id", F.col("doc_key").alias("vec_id"), F.round("similarity", 6).alias("similarity"), "rank")


_HYBRID = f"""{_bm25_sql(_EVERY_FIFTIETH)}, {_SIMILAR},
  fused AS (SELECT query_id, doc_id, sum(1.0::DOUBLE / (60 + rank)) AS score FROM (SELECT query_id, doc_id, rank FROM kw UNION ALL SELECT query_id, doc_id, rank FROM sr WHERE round(sim, 6) >= 0.35) GROUP BY query_id, doc_id),
  top AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, doc_id) AS rank FROM fused QUALIFY rank <= 10)"""


def _hybrid(spark: SparkSession, sf_dir: str, top_k: int = 10) -> DataFrame:
    return search.hybrid(*_fiftieth(spark, sf_dir), top_k)


@registered(f"""WITH {_bm25_sql(_EVERY_FIFTIETH)}, {_SIMILAR}, a AS (SELECT query_id, doc_id, rank FROM kw WHERE rank <= 50 UNION ALL SELECT query_id, doc_id, rank FROM sr WHERE rank <= 50)
    SELECT query_id, doc_id, round(sum(1.0::DOUBLE / (60 + rank)), 9) AS score FROM a GROUP BY query_id, doc_id""")
def rrf_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOI11, AGG13: two rankings of fifty fused."""
    words, vectors = _fiftieth(spark, sf_dir)
    out = search.fuse(search.best_of(words, 50, 6), search.best_of(vectors, 50, 6))
    return out.select("query_id", F.col("doc_key").alias("doc_id"), F.round("score", 9).alias("score"))


@registered(f"""WITH {_HYBRID} SELECT t.query_id, t.rank, t.doc_id, round(t.score, 9) AS score, kw.rank AS keyword_rank, sr.rank AS semantic_rank, round(sr.sim, 6) AS semantic_similarity,
    concat_ws(',', CASE WHEN kw.rank IS NOT NULL THEN 'keyword' END, CASE WHEN round(sr.sim, 6) >= 0.35 THEN 'semantic' END) AS reasons
    FROM top t LEFT JOIN kw USING (query_id, doc_id) LEFT JOIN sr USING (query_id, doc_id)""")
def hybrid_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIL3, FIL10, JOI12, SRT2, PRJ10: hybrid search with reasons; every fiftieth text, and the vector of its id, is a query."""
    return _hybrid(spark, sf_dir).select("query_id", "rank", F.col("doc_key").alias("doc_id"), F.round("score", 9).alias("score"), "keyword_rank", "semantic_rank", F.round("semantic_similarity", 6).alias("semantic_similarity"), F.array_join("reasons", ",").alias("reasons"))


@registered(f"""WITH {_HYBRID}, t AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS position FROM documents),
  o AS (SELECT query_id, rank, source, position + d AS position, step FROM top JOIN t USING (doc_id), (VALUES (0, 0), (1, -1), (2, 1), (3, -2), (4, 2)) v(step, d)),
  f AS (SELECT query_id, doc_id, min(rank * 10 + step) AS first_at FROM o JOIN t USING (source, position) GROUP BY query_id, doc_id)
  SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY first_at) AS place FROM f""")
def neighbor_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOI13: hits and what is beside them, each once. A source is a medium, its documents the scenes in order of their ids."""
    d = table(spark, sf_dir, "documents").select(F.col("source").alias("media_id"), F.col("doc_id").alias("scene_id"))
    hits = _hybrid(spark, sf_dir).select("query_id", F.col("doc_key").alias("scene_id"), "rank").join(d, "scene_id")
    out = search.expand_neighbours(hits, intervals.numbered(d, "media_id", "scene_id", "position"), 2)
    return out.select("query_id", F.col("scene_id").alias("doc_id"), F.col("place").cast("long").alias("place"))


@registered(f"""WITH {_bm25_sql("SELECT item_id AS query_id, text FROM benchmark")},
  rel AS (SELECT b.item_id AS query_id, d.doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text)),
  m AS (SELECT query_id, doc_id, rank FROM kw WHERE rank <= 5),
  c AS (SELECT b.item_id AS query_id, count(DISTINCT r.doc_id) AS n, count(DISTINCT CASE WHEN m.rank IS NOT NULL THEN r.doc_id END) AS hits, min(m.rank) AS first FROM benchmark b LEFT JOIN rel r ON r.query_id = b.item_id LEFT JOIN m ON m.query_id = r.query_id AND m.doc_id = r.doc_id GROUP BY b.item_id),
  p AS (SELECT c.*, NOT EXISTS (SELECT 1 FROM m WHERE m.query_id = c.query_id) AS none FROM c)
  SELECT count(*) AS case_count, CAST(count_if(n > 0) AS BIGINT) AS answer_case_count, CAST(count_if(n = 0) AS BIGINT) AS no_answer_case_count, round(coalesce(avg(CASE WHEN n > 0 THEN hits / n END), 0), 9) AS recall_at_k,
    round(coalesce(avg(CASE WHEN n > 0 THEN coalesce(1.0 / first, 0) END), 0), 9) AS mean_reciprocal_rank, round(CASE WHEN count_if(none) = 0 THEN 0 ELSE count_if(none AND n = 0) / count_if(none) END, 9)::DOUBLE AS no_answer_precision, round(CASE WHEN count_if(n = 0) = 0 THEN 0 ELSE count_if(none AND n = 0) / count_if(n = 0) END, 9)::DOUBLE AS no_answer_recall FROM p""")
def retrieval_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG14, WIN6: every benchmark item is a query; documents that hold its text are relevant."""
    items = table(spark, sf_dir, "benchmark")
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc_key"), "text")
    cases = items.select(F.col("item_id").alias("case_id"), "text")
    scorer = _word_scorer(spark, sf_dir, items.select(F.col("item_id").alias("query_id"), F.col("text").alias("query")))
    hits = search.best_of(scorer, 5, 6).select(F.col("query_id").alias("case_id"), "doc_key", "rank")
    out = evaluation.report(evaluation.case_results(cases, evaluation.passage_matches(spark, docs, cases), hits))
    return out.select(*(F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in out.dtypes))


_VTT = "WEBVTT\n\nNOTE a comment\n\nintro\n00:00:00.500 --> 00:00:04.000 align:start\n<v Ann>Hello &amp; welcome</v>\n\n00:04.000 --> 00:07.500\n{\\an8}Second line\nof  two\n\nSTYLE\n::cue {}\n\n01:00:00.000 --> 01:00:01.250\n<i></i>\n"


@registered("SELECT * FROM (VALUES (1::INTEGER, 0.5::DOUBLE, 4.0::DOUBLE, 'Hello & welcome'), (2, 4.0, 7.5, 'Second line' || chr(10) || 'of two')) v(cue_index, start_sec, end_sec, text)")
def vtt_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC7, SRC8, STR5, STR6, FIL9: cues of a WebVTT text."""
    files = spark.createDataFrame([(0, "subtitle:2", _VTT)], "media_id int, source_stream_id string, value string")
    return media.webvtt(files).select("cue_index", "start_sec", "end_sec", "text")


_STRIP = "regexp_replace(regexp_replace(html, '\\{\\\\[^}]*\\}', '', 'g'), '<[^>]*>', '', 'g')"
for _e, _c in text._NAMED:
    _STRIP = f"replace({_STRIP}, '{_e}', '{_c.replace(chr(39), chr(39) * 2)}')"


@registered(f"SELECT page_id, trim(regexp_replace({_STRIP}, '[\\s ]+', ' ', 'g')) AS text FROM pages")
def html_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR5: markup off, the commonest entities replaced."""
    return table(spark, sf_dir, "pages").select("page_id", text.strip_markup(F.col("html")).alias("text"))


_HINT = "CASE " + " ".join(f"WHEN regexp_matches(lower(caption), '(^|[^a-z0-9]){h}s?([^a-z0-9]|$)') THEN '{h}'" for h in visual.HINTS) + " END"


@registered(f"WITH c AS (SELECT doc_id, text AS caption FROM documents) SELECT doc_id, {_HINT} AS hint FROM c WHERE {_HINT} IS NOT NULL")
def caption_hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIL5, JOI14: captions that speak of something to read."""
    d = table(spark, sf_dir, "documents").select(F.lit(0).alias("media_id"), F.lit(0).alias("scene_id"), F.col("doc_id").alias("keyframe_index"), F.col("text").alias("caption"))
    return visual.ocr_candidates(d.drop("caption"), d).select(F.col("keyframe_index").alias("doc_id"), F.col("trigger_hint").alias("hint"))


@registered("SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN upper(lang) ELSE lang END AS lang, CASE WHEN doc_id % 7 = 0 THEN 'selected' ELSE 'source' END AS provenance FROM documents")
def overlay_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SET1, JOI15: selected scenes made again, the others kept."""
    source = table(spark, sf_dir, "documents").select(F.lit(0).alias("media_id"), F.col("doc_id").alias("scene_id"), "lang")
    chosen = source.where("scene_id % 7 = 0")
    made = chosen.withColumn("lang", F.upper("lang"))
    return overlay.overlay(source, made, chosen).select(F.col("scene_id").alias("doc_id"), "lang", "provenance")


@registered("SELECT o_orderstatus, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate DESC, o_orderkey DESC) <= 50")
def latest_retained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN12, WIN12b: the newest of each group (a report of a fixed size)."""
    return overlay.latest(table(spark, sf_dir, "orders"), ["o_orderstatus"], ["o_orderdate", "o_orderkey"], 50).select("o_orderstatus", "o_orderkey")


@registered("""WITH r AS (SELECT o_orderkey::VARCHAR AS run_id, CASE WHEN o_orderstatus = 'O' THEN 'running' ELSE 'succeeded' END AS status, o_orderdate FROM orders)
    SELECT run_id, status FROM r QUALIFY status = 'running' OR row_number() OVER (PARTITION BY status <> 'running' ORDER BY o_orderdate DESC, run_id DESC) <= 100""")
def run_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN12, CTL10: ended runs beyond the newest hundred go."""
    r = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("run_id"), F.when(F.col("o_orderstatus") == "O", "running").otherwise("succeeded").alias("status"), F.col("o_orderdate").alias("updated_at"), F.lit(None).cast("timestamp_ntz").alias("completed_at"))
    return newest_terminal(r, 100).select("run_id", "status")


@registered("SELECT doc_id, sha256(concat_ws('|', doc_id::VARCHAR, lang, source, text)) AS fingerprint, strlen(text) AS size_bytes FROM documents")
def fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HSH1: fingerprints of rows."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.sha2(F.concat_ws("|", F.col("doc_id").cast("string"), "lang", "source", "text"), 256).alias("fingerprint"), F.octet_length("text").cast("long").alias("size_bytes"))


@registered("""WITH g AS (SELECT user_id AS media_id, count(*) AS segment_count, sum(value) AS speech FROM events WHERE event_type = 'view' GROUP BY user_id), m AS (SELECT user_id AS media_id, sum(value) AS total FROM events GROUP BY user_id)
    SELECT media_id, coalesce(segment_count, 0) AS segment_count, round(coalesce(speech, 0), 3) AS speech_sec, round(CASE WHEN total = 0 THEN 0 ELSE coalesce(speech, 0) / total END, 3) AS speech_ratio FROM m LEFT JOIN g USING (media_id)""")
def vad_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG7: speech time and its share."""
    e = table(spark, sf_dir, "events")
    speech = e.where("event_type = 'view'").select(F.col("user_id").alias("media_id"), F.col("value").alias("duration_sec"))
    total = e.groupBy(F.col("user_id").alias("media_id")).agg(F.sum("value").alias("total_sec"))
    return audio.vad_totals(speech, total).select("media_id", "segment_count", "speech_sec", "speech_ratio")


#: Scenes of the card stand-in: six hours each, for each user.
_CARD_SPAN, _CARD_SCENES = 21600.0, 124


def _sources(spark: SparkSession, sf_dir: str) -> timeline.Sources:
    e = timed(spark, sf_dir).withColumnRenamed("user_id", "media_id").withColumn("pos", F.col("event_id"))
    of = lambda kind: e.where(F.col("event_type") == kind)
    users = e.select("media_id").distinct()
    span = lambda n, size: users.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).withColumns({"start_sec": F.col("k") * size, "end_sec": (F.col("k") + 1) * size})
    scenes = span(_CARD_SCENES, _CARD_SPAN).select("media_id", (F.col("k") + 1).alias("scene_id"), "start_sec", "end_sec", F.lit(_CARD_SPAN).alias("duration_sec"))
    chapters = span(31, 86400.0).select("media_id", F.col("k").alias("chapter_index"), "start_sec", "end_sec", F.format_string("Day %d", F.col("k") + 1).alias("title"))
    frame = of("signup").select("media_id", (F.floor(F.col("start_sec") / _CARD_SPAN) + 1).cast("int").alias("scene_id"), F.col("event_id").alias("keyframe_index"), F.lit(1).alias("keyframe_count"), F.col("start_sec").alias("timestamp_sec"), F.concat(F.lit("f"), F.col("event_id").cast("string")).alias("path"), "props")
    captions = frame.select("media_id", "scene_id", "keyframe_index", "keyframe_count", "timestamp_sec", F.col("path").alias("keyframe"), F.get_json_object("props", "$.k").alias("caption"))
    ocr = captions.select(*captions.columns[:-1], F.col("caption").alias("text"), F.lit(1).alias("image_width"), F.lit(1).alias("image_height"), F.array().cast("array<struct<region_id:int>>").alias("regions"))
    return timeline.Sources(
        scenes,
        of("purchase").select("media_id", "pos", F.col("event_id").alias("segment_id"), "start_sec", "end_sec", F.concat(F.lit("t"), F.col("event_id").cast("string")).alias("text")),
        of("click").select("media_id", "pos", "start_sec", "end_sec", F.concat(F.lit("S"), (F.col("event_id") % 3).cast("string")).alias("speaker")),
        of("view").select("media_id", "pos", F.col("event_id").cast("string").alias("source_id"), "start_sec", "end_sec", F.get_json_object("props", "$.k").alias("text"), F.lit("en").alias("language")),
        chapters,
        of("error").select("media_id", "pos", "event_id", F.concat(F.lit("L"), (F.col("event_id") % 3).cast("string")).alias("label"), (F.col("value") / 500).alias("confidence"), "start_sec", "end_sec"),
        frame.drop("props"),
        captions,
        ocr,
    )


def _part(kind: str, text_sql: str) -> str:
    seg = f"(SELECT * FROM timed WHERE event_type = '{kind}')"
    return f"""(WITH {_best(seg, 'sc', 'event_id', 'scene_id', ', g.user_id AS u, g.event_id AS ev, g.props AS pr', 'i.user_id = g.user_id')} SELECT u AS user_id, scene_id, ev, {text_sql} AS t FROM best)"""


_CARDS = f"""{_TIMED}, us AS (SELECT DISTINCT user_id FROM events), sc AS MATERIALIZED (SELECT user_id, CAST(k + 1 AS INTEGER) AS scene_id, k * {_CARD_SPAN}::DOUBLE AS s, (k + 1) * {_CARD_SPAN}::DOUBLE AS e FROM us, range({_CARD_SCENES}) t(k)),
  tr AS MATERIALIZED {_part('purchase', "'t' || ev::VARCHAR")}, su AS MATERIALIZED {_part('view', "json_extract_string(pr, '$.k')")}, au AS MATERIALIZED {_part('error', "'L' || (ev % 3)::VARCHAR")},
  tp AS MATERIALIZED (WITH {_best("(SELECT * FROM timed WHERE event_type = 'purchase')", "(SELECT * FROM timed WHERE event_type = 'click')", 'event_id', 'event_id', '', 'i.user_id = g.user_id')} SELECT seg AS ev, 'S' || (event_id % 3)::VARCHAR AS speaker FROM best),
  fr AS MATERIALIZED (SELECT user_id, CAST(floor(s / {_CARD_SPAN}) + 1 AS INTEGER) AS scene_id, event_id AS ev, s AS tm, json_extract_string(props, '$.k') AS t FROM timed WHERE event_type = 'signup'),
  uniq AS MATERIALIZED (SELECT kind, user_id, scene_id, string_agg(t, ' | ' ORDER BY ev) AS txt FROM (
    SELECT kind, user_id, scene_id, t, min(ev) AS ev FROM (SELECT 'su' AS kind, user_id, scene_id, ev, t FROM su UNION ALL SELECT 'au', user_id, scene_id, ev, t FROM au UNION ALL SELECT 'fr', user_id, scene_id, ev, t FROM fr) GROUP BY ALL) GROUP BY ALL),
  sp AS (SELECT user_id, scene_id, count(*) AS n, string_agg(t || '/' || coalesce(speaker, '-'), ',' ORDER BY ev) AS lines FROM tr LEFT JOIN tp USING (ev) GROUP BY ALL),
  nk AS (SELECT user_id, scene_id, 'f' || ev::VARCHAR AS keyframe FROM fr JOIN sc USING (user_id, scene_id) QUALIFY row_number() OVER (PARTITION BY user_id, scene_id ORDER BY abs(tm - (s + e) / 2.0), ev) = 1),
  cards AS MATERIALIZED (SELECT sc.user_id AS media_id, sc.scene_id, f.txt AS caption, f.txt AS ocr_text, u.txt AS subtitle_text, a.txt AS audio_event_text, 'Day ' || ((sc.scene_id - 1) // 4 + 1)::VARCHAR AS chapter, nk.keyframe, sp.lines, coalesce(sp.n, 0) AS n_lines
    FROM sc LEFT JOIN uniq f ON f.kind = 'fr' AND f.user_id = sc.user_id AND f.scene_id = sc.scene_id LEFT JOIN uniq u ON u.kind = 'su' AND u.user_id = sc.user_id AND u.scene_id = sc.scene_id
    LEFT JOIN uniq a ON a.kind = 'au' AND a.user_id = sc.user_id AND a.scene_id = sc.scene_id LEFT JOIN nk ON nk.user_id = sc.user_id AND nk.scene_id = sc.scene_id LEFT JOIN sp ON sp.user_id = sc.user_id AND sp.scene_id = sc.scene_id)"""


@registered(f"WITH {_CARDS} SELECT media_id, scene_id, caption, ocr_text, subtitle_text, audio_event_text, chapter, keyframe, coalesce(lines, '') AS lines FROM cards")
def scene_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STG09, D15, JOI1 to JOI8, AGG1, AGG2, PRJ1: everything about each scene."""
    cards, _ = timeline.scene_cards(_sources(spark, sf_dir), _CARD_SPAN)
    lines = F.array_join(F.transform("transcript", lambda t: F.concat(t["text"], F.lit("/"), F.coalesce(t["speaker"], F.lit("-")))), ",")
    return cards.select("media_id", "scene_id", "caption", "ocr_text", "subtitle_text", "audio_event_text", F.col("chapter.title").alias("chapter"), "keyframe", lines.alias("lines"))


@registered(f"""WITH {_CARDS} SELECT media_id, count(*) AS scene_card_count, CAST(count_if(n_lines > 0) AS BIGINT) AS scenes_with_speech, CAST(count_if(ocr_text IS NOT NULL) AS BIGINT) AS scenes_with_ocr, CAST(count_if(subtitle_text IS NOT NULL) AS BIGINT) AS scenes_with_subtitles,
    count(*) AS scenes_with_chapter, CAST(count_if(audio_event_text IS NOT NULL) AS BIGINT) AS scenes_with_audio_events, CAST(sum(n_lines) AS BIGINT) AS assigned_transcript_count FROM cards GROUP BY media_id""")
def timeline_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG5: counts over scene cards."""
    cards, _ = timeline.scene_cards(_sources(spark, sf_dir), _CARD_SPAN)
    return timeline.timeline_counts(cards).drop("assigned_subtitle_count", "assigned_audio_event_count")


@registered("""WITH c AS (SELECT conv_id, turn, role || ': ' || text AS line FROM conversations)
    SELECT conv_id, md5(string_agg(line, chr(10) ORDER BY turn, line)) AS card_md5, CAST(sum(length(line)) + count(*) - 1 AS BIGINT) AS chars FROM c GROUP BY conv_id""")
def conversation_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG1: lines of a conversation in order."""
    c = table(spark, sf_dir, "conversations").withColumn("line", F.concat_ws(": ", "role", "text"))
    out = c.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "line"))), lambda x: x["line"]), "\n").alias("card"))
    return out.select("conv_id", F.md5(F.col("card").cast("binary")).alias("card_md5"), F.length("card").cast("long").alias("chars"))


@registered("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC11: fields of JSON by a fixed schema."""
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k long", {"mode": "FAILFAST"})["k"].alias("k"))


_EDGES = ", ".join(f"('{s.name}', '{a}')" for s in DEFAULT_STAGES for a in s.after)


@registered(f"WITH RECURSIVE edges(stage, after) AS (VALUES {_EDGES}), r AS (SELECT stage, after AS ancestor FROM edges UNION SELECT r.stage, e.after FROM r JOIN edges e ON e.stage = r.ancestor) SELECT stage, ancestor FROM r")
def stage_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SET5, SRT6, CTL1, CTL2: what each stage follows, at any distance."""
    from .plans.stages import Planner, StageRegistry

    p = Planner(StageRegistry(DEFAULT_STAGES))
    return spark.createDataFrame([(s, a) for s in p.order for a in p.ancestors(s)], "stage string, ancestor string")


@registered("SELECT event_id, printf('%02d:%02d', CAST(floor((epoch_us(ts) - 1704067200000000) / 60000000.0) AS BIGINT), CAST(floor((epoch_us(ts) - 1704067200000000) / 1000000.0) AS BIGINT) % 60) AS stamp FROM events")
def time_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR4: minutes without bound, and seconds."""
    return timed(spark, sf_dir).select("event_id", text.fmt_ts(F.col("start_sec")).alias("stamp"))


@registered("SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 6) AS norm, true AS valid FROM embeddings")
def vector_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MTH5, FIL16: valid vectors and their length."""
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.round(numeric.norm(F.col("embedding")), 6).alias("norm"), numeric.vector_valid(F.col("embedding"), 64).alias("valid"))


@registered("""WITH s AS (SELECT vec_id, label, list_transform(embedding, lambda x: exp(x::DOUBLE - list_max(embedding)::DOUBLE)) AS ex FROM embeddings) SELECT vec_id, round(list_max(ex) / list_sum(ex), 6) AS top FROM s""")
def softmax_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MTH12: probabilities of logits."""
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(F.array_max(numeric.softmax(F.transform("embedding", lambda x: x.cast("double")))), 6).alias("top"))


_LABEL = "CASE " + " ".join(f"WHEN {' OR '.join(f'i BETWEEN {a} AND {b}' for a, b in r)} THEN '{n}'" for n, r in audio.LABELS) + " END"


@registered(f"SELECT CAST(i AS INTEGER) AS class_index, {_LABEL} AS label FROM range({audio.CLASSES}) t(i) WHERE {_LABEL} IS NOT NULL")
def audio_label_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MAP1: classes with a canonical label."""
    return audio.label_mapping(spark, {i: audio.ANCHORS.get(i, f"class {i}") for i in range(audio.CLASSES)})


@registered("""WITH e AS (SELECT vec_id, unnest(range(0, 64)) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings), l AS (SELECT vec_id, CASE WHEN i BETWEEN 16 AND 21 THEN 'laughter' WHEN i = 63 THEN 'applause' WHEN i BETWEEN 27 AND 37 THEN 'music' END AS label, x FROM e)
    SELECT vec_id, label, round(max(x), 6) AS confidence FROM l WHERE label IS NOT NULL GROUP BY vec_id, label HAVING round(max(x), 6) >= 0.1""")
def pooled_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG9, FIL4: the greatest class score of each label and window."""
    e = table(spark, sf_dir, "embeddings").select(F.lit(0).alias("media_id"), F.col("vec_id").alias("window_id"), F.lit(0.0).alias("start_sec"), F.lit(1.0).alias("end_sec"), F.transform("embedding", lambda x: x.cast("double")).alias("scores"))
    return audio.pooled_labels(e, audio_label_map(spark, sf_dir), 0.1).select(F.col("window_id").alias("vec_id"), "label", "confidence")


@registered("SELECT CAST(i AS INTEGER) AS attempt, least(0.5 * pow(2.0, i - 1), 30.0)::DOUBLE AS delay FROM range(1, 13) t(i)")
def retry_delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MTH8, CTL8: delays between attempts."""
    return spark.range(1, 13).select(F.col("id").cast("int").alias("attempt"), numeric.backoff(F.col("id"), 0.5, 2.0, 30.0).alias("delay"))


@registered(f"""WITH {_TIMED} SELECT event_id, CAST(trunc(s * 16000) AS BIGINT) AS stt_start, CAST(round_even(s * 16000, 0) AS BIGINT) AS event_start FROM timed""")
def sample_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MTH9: seconds to samples, cut and rounded."""
    x = timed(spark, sf_dir)
    a, _ = numeric.stt_samples(F.col("start_sec"), F.col("end_sec"))
    b, _, _ = numeric.event_samples(F.col("start_sec"), F.col("end_sec"), F.lit(1 << 40).cast("long"))
    return x.select("event_id", a.alias("stt_start"), b.alias("event_start"))


@registered("SELECT user_id AS media_id, event_id, CAST((row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) // 8 AS BIGINT) AS batch FROM events")
def batch_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN13: ordered batches of bounded size."""
    e = table(spark, sf_dir, "events").withColumnRenamed("user_id", "media_id")
    return audio.batches(e, ["media_id"], ["ts", "event_id"], 32, 8).select("media_id", "event_id", "batch")


@registered("SELECT c_nationkey AS media_id, string_agg(DISTINCT c_mktsegment, ',' ORDER BY c_mktsegment) AS speakers FROM customer GROUP BY c_nationkey")
def distinct_speakers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG11: who speaks, sorted."""
    x = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("media_id"), F.col("c_mktsegment").alias("speaker"))
    return audio.speakers(x).select("media_id", F.array_join("speakers", ",").alias("speakers"))


@registered("SELECT source, count(*) AS caption_count, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS ids FROM documents GROUP BY source")
def caption_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG3, D14: captions of a scene in order."""
    d = table(spark, sf_dir, "documents").select(F.lit(0).alias("media_id"), F.col("source").alias("scene_id"), F.col("doc_id").alias("keyframe_index"), F.lit(0.0).alias("timestamp_sec"), F.lit("").alias("keyframe"), "lang").withColumnRenamed("lang", "caption")
    out = visual.caption_groups(d)
    return out.select(F.col("scene_id").alias("source"), "caption_count", F.array_join(F.transform("captions", lambda c: c["keyframe_index"].cast("string")), ",").alias("ids"))


@registered("""WITH p(stage, planned) AS (SELECT o_orderstatus, count(*) FROM orders GROUP BY 1) SELECT o_orderpriority AS run_id, count_if(o_orderstatus = 'F') / count(*) AS progress_ratio FROM orders GROUP BY 1""")
def progress_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG19, AGG20: the share of planned stages that are done."""
    from .sources.stores import progress

    o = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("run_id"), F.col("o_orderkey").alias("stage"), F.when(F.col("o_orderstatus") == "F", "succeeded").otherwise("failed").alias("status"), F.lit(1).alias("attempt"), F.col("o_orderdate").cast("string").alias("recorded_at"))
    return progress(o.select("run_id", "stage"), o)


_PROBE = '{"format":{"duration":"30.04","size":"1024","format_name":"mov"},"streams":[{"index":0,"codec_type":"video","codec_name":"h264","width":640,"height":360,"avg_frame_rate":"30000/1001"},{"index":1,"codec_type":"audio","codec_name":"aac","sample_rate":"48000","channels":2},{"index":2,"codec_type":"subtitle","codec_name":"mov_text","tags":{"language":"en"},"disposition":{"default":1}},{"index":3,"codec_type":"subtitle","codec_name":"dvd_subtitle"}],"chapters":[{"id":7,"start_time":"0.0","end_time":"10.0","tags":{"title":" One "}},{"id":8,"start_time":"10.0","end_time":"20.5"}]}'


def _probe(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(0, _PROBE)], "media_id int, json string")


@registered("SELECT 30.04::DOUBLE AS duration_sec, 1024::BIGINT AS size_bytes, 'mov' AS container, 'h264' AS video_codec, 29.97::DOUBLE AS fps, 48000::INTEGER AS sample_rate, 2::INTEGER AS subtitle_tracks, 2::INTEGER AS chapters")
def probe_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC1, FIL7, STG01: the summary of a probe result."""
    return media.metadata(_probe(spark)).select("duration_sec", "size_bytes", "container", F.col("video.codec").alias("video_codec"), "video.fps", "audio.sample_rate", "subtitle_tracks", "chapters")


@registered("SELECT * FROM (VALUES (0::INTEGER, '7', 0.0::DOUBLE, 10.0::DOUBLE, 'One'), (1, '8', 10.0, 20.5, 'Chapter 2')) v(chapter_index, source_chapter_id, start_sec, end_sec, title)")
def probe_chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC9: chapters with a default title."""
    return media.chapters(_probe(spark)).select("chapter_index", "source_chapter_id", "start_sec", "end_sec", "title")


@registered("SELECT * FROM (VALUES ('subtitle:2', 'en', true, 'extractable', NULL), ('subtitle:3', NULL, false, 'skipped', 'UNSUPPORTED_SUBTITLE_CODEC')) v(source_id, language, is_default, status, reason_code)")
def subtitle_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIL6, D6: which subtitle streams hold text."""
    return media.subtitle_streams(_probe(spark)).select("source_id", "language", F.col("disposition.default").alias("is_default"), "status", "reason_code")


@registered(f"""WITH RECURSIVE c AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY frame) AS n, frame FROM (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS frame, value FROM events) WHERE value > 27),
    r AS (SELECT user_id, 0::BIGINT AS n, 0::BIGINT AS last, [0::BIGINT] AS cuts FROM (SELECT DISTINCT user_id FROM events)
      UNION ALL SELECT r.user_id, c.n, CASE WHEN c.frame - r.last >= 15 THEN c.frame ELSE r.last END, CASE WHEN c.frame - r.last >= 15 THEN list_append(r.cuts, c.frame) ELSE r.cuts END FROM r JOIN c ON c.user_id = r.user_id AND c.n = r.n + 1)
    SELECT user_id AS media_id, CAST(unnest(range(1, len(cuts) + 1)) AS INTEGER) AS scene_id, CAST(unnest(cuts) AS INTEGER) AS start_frame FROM r QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC) = 1""")
def scene_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC2, STG02, STM3: cuts where a score is high and the last cut far enough back; a user's events are frames."""
    e = table(spark, sf_dir, "events")
    place = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    frames = e.select(F.col("user_id").alias("media_id"), place.alias("frame"), F.col("value").alias("score"))
    about = frames.groupBy("media_id").agg((F.max("frame") + 1).alias("frame_count")).withColumns({"fps": F.lit(25.0), "duration_sec": (F.col("frame_count") / 25.0)})
    return media.scene_boundaries(frames, about).select("media_id", "scene_id", "start_frame")


_TSV = [(1, 0, 0, 0, 0, 0, 640, 360, -1.0, ""), (5, 1, 1, 1, 10, 10, 40, 12, 95.5, "Hello"), (5, 1, 1, 1, 60, 10, 40, 12, 80.0, " world "), (5, 1, 1, 2, 10, 30, 40, 12, 20.0, "faint"), (5, 1, 2, 1, 10, 50, 40, 12, 60.0, "again"), (5, 1, 2, 1, 60, 50, 40, 12, -1.0, "none")]


def _words(spark: SparkSession) -> DataFrame:
    kinds = "row int, level int, block_num int, par_num int, line_num int, left int, top int, width int, height int, conf double, text string"
    return spark.createDataFrame([(i, *r) for i, r in enumerate(_TSV)], kinds).withColumn("image_id", F.lit("a"))


@registered("SELECT 'a' AS image_id, 'Hello world' || chr(10) || 'again' AS text, 3::INTEGER AS n_regions, 0.955::DOUBLE AS best")
def ocr_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC10, FIL4, UDF3: words and text of an OCR table."""
    out = visual.ocr_text(visual.ocr_words(_words(spark), 0.5))
    return out.select("image_id", "text", F.size("regions").alias("n_regions"), F.array_max(F.transform("regions", lambda r: r["confidence"])).alias("best"))


@registered("SELECT s_name AS path, CASE WHEN s_suppkey % 2 = 0 THEN 'image/png' ELSE 'image/jpeg' END AS media_type, true AS safe FROM supplier")
def path_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR9, FIL18: media types and safe paths."""
    p = table(spark, sf_dir, "supplier").withColumn("path", F.concat("s_name", F.when(F.col("s_suppkey") % 2 == 0, ".PNG").otherwise(".jpg")))
    return p.select(F.col("s_name").alias("path"), text.image_media_type(F.col("path")).alias("media_type"), text.safe_relative_path(F.col("path")).alias("safe"))


@registered(f"WITH {_TIMED}, o AS (SELECT user_id, event_id, s, e, lag(e) OVER (PARTITION BY user_id ORDER BY s, event_id) AS before FROM timed) SELECT user_id AS media_id, count(*) AS n FROM o WHERE s < before GROUP BY user_id")
def order_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN9, D8, D11: segments that overlap the one before."""
    place = F.row_number().over(Window.partitionBy("user_id").orderBy("start_sec", "event_id"))
    x = timed(spark, sf_dir).withColumn("segment_id", place).withColumnRenamed("user_id", "media_id")
    return intervals.order_violations(x, ["media_id"], "segment_id").groupBy("media_id").agg(F.count(F.lit(1)).alias("n"))


from . import operator_queries  # noqa: E402, F401  registers the others
