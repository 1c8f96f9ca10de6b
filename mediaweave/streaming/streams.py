"""Streaming forms of the batch operators, for sources without an end. Event time `ts` is a timestamp; rows are keyed by media_id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

MEDIA = "media_id"


def sliding_counts(rows: DataFrame, size: str = "5 seconds", hop: str = "2.5 seconds", late: str = "1 minute") -> DataFrame:
    """Rows and greatest confidence per sliding window and label. Windows are aligned to the epoch, unlike those of a finite medium."""
    return rows.withWatermark("ts", late).groupBy(MEDIA, "label", F.window("ts", size, hop)).agg(F.count(F.lit(1)).alias("n"), F.max("confidence").alias("confidence"))


def speech_sessions(segments: DataFrame, max_gap_sec: float = 0.5, late: str = "1 minute") -> DataFrame:
    """Runs of speech segments (ts, end_ts) whose gaps are at most max_gap_sec: a session ends a gap after its last segment."""
    length = F.unix_micros("end_ts") - F.unix_micros("ts") + int(max_gap_sec * 1e6)
    gap = F.concat(length.cast("string"), F.lit(" microseconds"))
    out = segments.withWatermark("ts", late).groupBy(MEDIA, F.session_window("ts", gap).alias("s")).agg(F.count(F.lit(1)).alias("n"), F.max("end_ts").alias("end_ts"))
    return out.select(MEDIA, F.col("s.start").alias("start_ts"), "end_ts", "n")


def tumbling(rows: DataFrame, size: str = "15 minutes", late: str = "1 minute") -> DataFrame:
    return rows.withWatermark("ts", late).groupBy(MEDIA, F.window("ts", size)).agg(F.count(F.lit(1)).alias("n"))


def assigned(segments: DataFrame, scenes: DataFrame, width: float = 60.0) -> DataFrame:
    """A stream of segments beside a fixed table of scenes: each with the scene that holds its middle, null for none. Stateless."""
    s = scenes.select(MEDIA, "scene_id", F.col("start_sec").alias("_a"), F.col("end_sec").alias("_b"), F.explode(F.sequence(F.floor(F.col("start_sec") / width), F.floor(F.col("end_sec") / width))).alias("_k"))
    middle: Column = (F.col("start_sec") + F.col("end_sec")) / 2.0
    x = segments.withColumns({"_mid": middle, "_k": F.floor(middle / width)})
    held = (x[MEDIA] == s[MEDIA]) & (x["_k"] == s["_k"]) & (x["_mid"] >= s["_a"]) & (x["_mid"] < s["_b"])
    return x.join(s, held, "left").select(*(x[c] for c in segments.columns), s["scene_id"])


def upsert(rows: DataFrame, path: str, key: list[str], newest: str, checkpoint: str) -> StreamingQuery:
    """Keeps the newest row of each key in a Parquet table, batch by batch; a key that comes again replaces its row.

    A batch writes a table of its own number and then moves the pointer, so a batch that is run again after a fault changes nothing twice.
    """
    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        pointer = f"{path}/current"
        try:
            have = spark.read.text(pointer).orderBy(F.col("value").cast("long").desc()).first()["value"]
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e):
                raise
            have = None
        if have is not None and int(have) >= number:
            return
        every = batch if have is None else batch.unionByName(spark.read.parquet(f"{path}/v{have}"))
        rank = F.row_number().over(Window.partitionBy(*key).orderBy(F.col(newest).desc()))
        every.withColumn("_r", rank).where("_r = 1").drop("_r").write.mode("overwrite").parquet(f"{path}/v{number}")
        spark.range(1).select(F.lit(str(number)).alias("value")).coalesce(1).write.mode("append").text(pointer)

    return rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, path: str) -> DataFrame:
    """The table that `upsert` keeps."""
    have = spark.read.text(f"{path}/current").orderBy(F.col("value").cast("long").desc()).first()["value"]
    return spark.read.parquet(f"{path}/v{have}")


def progress(log: DataFrame, planned: int) -> DataFrame:
    """Share of planned stages done, per run, over a stream of journal rows (run_id, stage, status)."""
    done = F.when(F.col("status").isin("succeeded", "skipped", "cached"), F.col("stage"))
    return log.groupBy("run_id").agg((F.approx_count_distinct(done, 0.01) / planned).alias("progress_ratio"))


def drain(df: DataFrame, name: str, mode: str = "complete") -> StreamingQuery:
    """Runs a stream over what is there into an in-memory table; for tests and small looks."""
    return df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()


def settled(df: DataFrame, path: str, mode: str = "complete") -> DataFrame:
    """Runs a stream over what is there into a Parquet table and reads it back. In complete mode each batch replaces the table."""
    spark = df.sparkSession

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/rows/{'all' if mode == 'complete' else f'batch={number}'}")

    df.writeStream.foreachBatch(put).outputMode(mode).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{path}/rows/*")
