import datetime as dt

from pyspark.sql import functions as F

from mediaweave.streaming import streams


def source(spark, tmp_path, rows, schema):
    path = str(tmp_path / "in")
    spark.createDataFrame(rows, schema).write.parquet(path)
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)


T0 = dt.datetime(2024, 1, 1)


def at(s):
    return T0 + dt.timedelta(seconds=s)


def test_sessions_touch(spark, tmp_path):
    rows = [(1, at(0), at(1)), (1, at(1.5), at(2)), (1, at(2.6), at(3)), (1, at(500), at(501))]
    src = source(spark, tmp_path, rows, "media_id int, ts timestamp, end_ts timestamp")
    q = streams.drain(streams.speech_sessions(src), "sessions", "append")
    q.awaitTermination(60)
    got = spark.table("sessions").orderBy("start_ts").collect()
    assert [(r.n, r.end_ts) for r in got][:2] == [(2, at(2)), (1, at(3))]


def test_assigned_and_counts(spark, tmp_path):
    scenes = spark.createDataFrame([(1, 1, 0.0, 5.0), (1, 2, 5.0, 10.0)], "media_id int, scene_id int, start_sec double, end_sec double")
    src = source(spark, tmp_path, [(1, 4.0, 6.0), (1, 20.0, 21.0)], "media_id int, start_sec double, end_sec double")
    q = streams.drain(streams.assigned(src, scenes, 3.0), "assigned", "append")
    q.awaitTermination(60)
    assert {r.start_sec: r.scene_id for r in spark.table("assigned").collect()} == {4.0: 2, 20.0: None}


def test_upsert_keeps_the_newest(spark, tmp_path):
    src = source(spark, tmp_path, [("a", 1, 1), ("a", 2, 2), ("b", 1, 3)], "k string, v int, n int")
    q = streams.upsert(src, str(tmp_path / "t"), ["k"], "n", str(tmp_path / "c"))
    q.awaitTermination(60)
    assert sorted((r.k, r.v) for r in streams.current(spark, str(tmp_path / "t")).collect()) == [("a", 2), ("b", 1)]


def test_windows(spark, tmp_path):
    src = source(spark, tmp_path, [(1, at(0), "x", 0.5), (1, at(3), "x", 0.9)], "media_id int, ts timestamp, label string, confidence double")
    q = streams.drain(streams.sliding_counts(src), "sliding", "complete")
    q.awaitTermination(60)
    assert spark.table("sliding").agg(F.max("n")).first()[0] == 2
