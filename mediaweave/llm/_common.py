"""What the operators of this subpackage share: reading, scratch tables, Arrow batches."""

from __future__ import annotations

import atexit
import gc
import time
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir, spread

#: Bytes and rows of text that the vectorised kernels take at once; they bound a Python worker's memory.
BLOCK_BYTES = 2 << 20
BLOCK_ROWS = 4096


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id")


class Scratch:
    """Tables written to the shared folder: they cut lineage and survive the loss of an executor."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.base = f"{shared_dir(spark)}/mw-{uuid.uuid4().hex}"
        self.count = 0
        atexit.register(self.clear)

    def table(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.base}/{self.count}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch = path  # type: ignore[attr-defined]
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Deletes tables that no later plan reads, and lets Spark remove shuffle files that are no longer referenced."""
        for t in tables:
            self._delete(t._scratch)  # type: ignore[attr-defined]
        for _ in range(2):  # what the first pass finds unreachable, Spark's cleaner queues; the second frees what that held
            gc.collect()
            self.spark.sparkContext._jvm.System.gc()
            time.sleep(0.3)

    def clear(self) -> None:
        try:
            self._delete(self.base)
        except Exception:  # noqa: BLE001  the session may have ended
            pass

    def _delete(self, path: str) -> None:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def id_text(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id and text (null text: empty), and nothing else but the named columns."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more)


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches with about `size` bytes of text each; a longer single text makes a slice of its own."""
    import numpy as np

    for batch in batches:
        if not batch.num_rows:
            continue
        text = batch.column(batch.schema.get_field_index(column))
        ends = np.frombuffer(text.buffers()[1], dtype=np.int32 if pa.types.is_string(text.type) else np.int64, count=text.offset + len(text) + 1)[text.offset :]
        at = 0
        while at < len(text):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + size, side="right")) - 1)
            to = min(to, len(text), at + BLOCK_ROWS)
            yield batch.slice(at, to - at)
            at = to


def text_bytes(text: pa.Array):
    """The bytes of all texts of an Arrow string array on end, and the n+1 offsets of their starts."""
    import numpy as np

    kind = np.int32 if pa.types.is_string(text.type) else np.int64
    ends = np.frombuffer(text.buffers()[1], dtype=kind, count=text.offset + len(text) + 1)[text.offset :].astype(np.int64)
    data = text.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and len(data) else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]
