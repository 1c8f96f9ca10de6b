"""Token counts of flat token files without an index, by a scan for separators.

A file is token identifiers on end, little-endian and of one width, with an end-of-document identifier after each
document. Files are read as blocks of whole identifiers, each block is searched for the separator in one vectorised
comparison, and a prefix scan over a file's blocks carries the number of documents and the place of the last separator
across block boundaries, so a document may span any number of blocks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._common import blocks, id_text

#: Identifiers of a block.
BLOCK = 1 << 17


def write_token_files(docs: DataFrame, model: str, end: int, path: str, width: int = 2) -> None:
    """Encodes every whole text by a SentencePiece model and writes flat token files, one for each task; the end identifier
    follows each document, an empty one too.

    Spark's text writer puts a row's bytes and the separator's bytes on end, which is the format; the end identifier's bytes must
    therefore be ASCII, as those of small identifiers are.
    """
    mark = end.to_bytes(width, "little").decode("ascii")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .pieces import pieces

        enc = pieces(model)
        for block in blocks(batches):
            ids = enc.encode_batch(block.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([np.frombuffer(x, "<u4").astype(f"<u{width}").tobytes() for x in ids], pa.binary())], ["ids"])

    id_text(docs).mapInArrow(run, "ids binary").select(F.col("ids").cast("string").alias("value")).write.option("lineSep", mark).text(path)


def _search(end: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for at, total, data in zip(*(b.column(k).to_pylist() for k in (2, 3, 4)), strict=True):
                ids = np.frombuffer(data, f"<u{width}")
                marks = np.flatnonzero(ids == end) + at
                if at + len(ids) == total and len(ids) and ids[-1] != end:
                    marks = np.append(marks, total)  # a last document without its end identifier
                found.append(marks)
            if found:
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(3), pa.array(found, pa.list_(pa.int64()))], ["file", "block", "total", "marks"])

    return run


def _ranges(width: int):
    """Blocks' bytes, read from the file at the block's place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for b in batches:
            for path, file, block, at, total, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                system, name = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
                with system.open_input_file(name) as f:
                    data = f.read_at(n * width, at * width)
                if len(data) != n * width:
                    raise OSError(f"{path}: {len(data)} bytes at {at * width} where {n * width} should be")
                yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([block], pa.int64()), pa.array([at], pa.int64()), pa.array([total], pa.int64()), pa.array([data], pa.binary())], ["file", "block", "at", "total", "data"])

    return run


#: Schemes that executors read by place, and blocks of a task.
SEEKABLE = ("file", "hdfs", "s3", "gs")
TASK_BLOCKS = 64


def _blocks_of(files: DataFrame, width: int, block: int) -> DataFrame:
    """file, block, at, total and data of all blocks: executors read byte ranges, so a file of any size is read by many tasks.

    Files of a scheme that only Spark reads are read whole by Spark's reader, whose bound is 2 GB a file.
    """
    scheme = F.regexp_extract("path", "^([a-z0-9]+):", 1)
    listed = files.select("path", F.regexp_extract("path", "([^/]+)$", 1).alias("file"), F.floor(F.col("length") / width).alias("total"), scheme.isin(*SEEKABLE).alias("seek")).where("total > 0")
    step = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("total") - 1) / block)))
    place = [(F.col("block") * block).alias("at"), "total", F.least(F.lit(block).cast("long"), F.col("total") - F.col("block") * block).alias("n")]
    sums = listed.agg(F.coalesce(F.sum(F.when(F.col("seek"), F.floor((F.col("total") - 1) / block) + 1)), F.lit(0)), F.count_if(~F.col("seek"))).first()
    cut = listed.where("seek").select("path", "file", "total", step.alias("block")).select("path", "file", "block", *place)
    out = cut.repartition(max(1, -(-sums[0] // TASK_BLOCKS)), "file", "block").mapInArrow(_ranges(width), "file string, block long, at long, total long, data binary")
    if sums[1]:
        content = files.select("path", "content").join(listed.where("not seek"), "path").select("file", "total", "content", step.alias("block")).select("file", "block", *place, "content")
        bytes_ = F.substring("content", (F.col("at") * width + 1).cast("int"), (F.col("n") * width).cast("int"))
        out = out.unionByName(content.select("file", "block", "at", "total", bytes_.alias("data")))
    return out


def count_tokens(spark: SparkSession, path: str, end: int, width: int = 2, block: int = BLOCK) -> DataFrame:
    """Per document: file (name), doc_no (from 0 in its file), start, n_tokens (without the end identifier), closed.

    `closed` is false for a last document without an end identifier. Two end identifiers on end enclose a document of no tokens. An
    empty file or folder gives no rows. Bytes after the last whole identifier are left out. Files that executors can read by place may
    have any size; see _blocks_of for others.
    """
    files = spark.read.format("binaryFile").load(path)
    searched = _blocks_of(files, width, block).mapInArrow(_search(end, width), "file string, block long, total long, marks array<long>")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = F.when(F.size("marks") > 0, F.element_at("marks", -1))
    scanned = searched.withColumns({"base": F.coalesce(F.sum(F.size("marks").cast("long")).over(before), F.lit(0)), "prior": F.coalesce(F.last(last, ignorenulls=True).over(before), F.lit(-1))})
    each = scanned.where(F.size("marks") > 0).select("file", "total", "base", F.concat(F.array("prior"), "marks").alias("marks"), F.posexplode("marks").alias("k", "mark"))
    start = F.element_at("marks", F.col("k") + 1) + 1
    return each.select("file", (F.col("base") + F.col("k")).alias("doc_no"), start.alias("start"), (F.col("mark") - start).alias("n_tokens"), (F.col("mark") < F.col("total")).alias("closed"))
