"""Best-fit packing of documents into sequences of a fixed number of tokens, in bulk-synchronous supersteps.

Documents are cut into pieces. Pieces over half the capacity open a sequence each; the others are placed by classes of length, longest
first. A superstep takes all pieces of a class that are not yet placed and the gaps of all sequences. Gaps offer slots: as many of the class's
largest length as they hold, and one of what is left over. Pieces and slots are range-sorted together by size, and each range is
swept on its own from large to small, a piece taking its successor, the smallest free slot that holds it; pieces that ask for one slot are told
apart by rank. A scan over the counts that ranges have left, two numbers for each, gives the pieces of a range the slots of ranges before it.
Then gaps shrink by what they took, and the superstep is repeated with what is left; where no gap is of use, new sequences open.

Every step is a distributed sort, sweep or join over rows; the driver holds a histogram of lengths and two numbers for each range. A
length that a third of all pieces have is spread over ranges, as rows of one size are ordered by their number.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._common import Scratch, blocks, id_text

CAPACITY = 2048
END = 0
#: Pieces and slots of a range, about.
RANGE = 1 << 16

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: all full but the first."""
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, path: str, ranks: str | None, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    tail = np.asarray([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from ._bpe import encoder

        enc = encoder(path, ranks)
        for block in blocks(batches):
            rows = []
            for doc, text in zip(block.column(0).to_pylist(), block.column(1).to_pylist(), strict=True):
                ids = enc.encode(text) + tail
                rows += ((doc, k, s, n, zlib.crc32(memoryview(ids)[4 * s : 4 * (s + n)])) for k, (s, n) in enumerate(cut(len(ids) // 4, capacity)))
            doc, piece, start, length, crc = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))], [x.split()[0] for x in _PIECES.split(", ")])

    return id_text(docs).mapInArrow(run, _PIECES)


def classes(capacity: int) -> list[tuple[int, int]]:
    """(over, up to) lengths of the classes below half the capacity, longest first; of the first ones a sequence holds 2, 3, 4, 5 and 6 to 8."""
    bounds = [capacity // k for k in (2, 3, 4, 5, 8, 16, 64) if capacity // k]
    bounds = sorted({*bounds, 0}, reverse=True)
    return list(zip(bounds[1:], bounds, strict=False))


_SWEPT = "pid int, uid long, seq long, length int, rank long, many long"


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Matches pieces with slots along one range of sizes, from the largest to the smallest.

    A piece takes the slot met last, which is its successor: the smallest free one that holds it. Pieces that ask for the same slot are
    told apart by their rank in the order; the later one goes to the next larger slot. What the range cannot match is counted, for the scan over ranges.
    """
    names = [x.split()[0] for x in _SWEPT.split(", ")]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
    stack: list[list[int]] = []  # sequence, slots
    left, pid = 0, 0
    for b in batches:
        if not b.num_rows:
            continue
        pid = b.column(0)[0].as_py()
        rows = []
        for key, id_, many, size in zip(*(b.column(k).to_pylist() for k in range(1, 5)), strict=True):
            if not key & 1:
                stack.append([id_, many])
            elif stack:
                top = stack[-1]
                rows.append((pid, id_, top[0], size, None, None))
                top[1] -= 1
                if not top[1]:
                    stack.pop()
            else:
                rows.append((pid, id_, None, size, left, None))
                left += 1
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
    for at in range(0, len(stack), 65536):
        rows, start = [], sum(x[1] for x in stack[:at]) if at else 0
        for seq, many in stack[at : at + 65536]:
            rows.append((pid, None, seq, None, start, many))
            start += many
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def across(left: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Of (range, pieces left, slots left) in the order of ranges: runs (range, first piece, range of slots, first slot, how many).

    Pieces of a range go to the slots left last before it; piece k of a run takes the run's slot k from its end.
    """
    runs, stack = [], []
    for p, pieces_, slots in left:
        at = 0
        while at < pieces_ and stack:
            q, free = stack[-1]
            take = min(pieces_ - at, free)
            runs.append((p, at, q, free - take, take))
            at += take
            stack[-1][1] -= take
            if not stack[-1][1]:
                stack.pop()
        if slots:
            stack.append([p, slots])
    return runs


def _superstep(spark: SparkSession, scratch: Scratch, todo: DataFrame, gaps: DataFrame, top: int, low: int, rows: int, capacity: int) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """One superstep: placements (uid, seq, length), the gaps after it, and the pieces that no slot was left for (none: None)."""
    many = F.floor(F.col("size") / top)
    slots = gaps.where(F.col("size") >= low).select("seq", F.explode(F.array(F.struct(F.lit(top).alias("size"), many.alias("many")), F.struct((F.col("size") - many * top).cast("int").alias("size"), F.lit(1).cast("long").alias("many")))).alias("slot"))
    slots = slots.where((F.col("slot.many") > 0) & (F.col("slot.size") >= low))
    # largest first; of one size slots come before pieces
    key = lambda size, piece: ((F.lit(capacity) - size) * 2 + piece).cast("int").alias("key")
    events = slots.select(key(F.col("slot.size"), 0), F.col("seq").alias("id"), "slot.many", F.col("slot.size").alias("size")).unionByName(todo.select(key(F.col("length"), 1), F.col("uid").alias("id"), F.lit(1).cast("long").alias("many"), F.col("length").alias("size")))
    ranges = -(-rows // RANGE)
    ranged = (events.repartitionByRange(ranges, "key", "id") if ranges > 1 else events.repartition(1)).sortWithinPartitions("key", "id")
    swept = scratch.table(ranged.select(F.spark_partition_id().alias("pid"), "key", "id", "many", "size").mapInArrow(_sweep, _SWEPT))
    piece = F.col("uid").isNotNull()
    counts = swept.where("seq is null or uid is null").groupBy("pid").agg(F.count("uid").alias("pieces"), F.coalesce(F.sum("many"), F.lit(0)).alias("slots"))
    left = sorted((r["pid"], r["pieces"], r["slots"]) for r in counts.collect())  # one row for each range
    runs = across(left)
    placed, waiting = swept.where(piece & F.col("seq").isNotNull()).select("uid", "seq", "length"), swept.where("seq is null")
    rest = sum(x[1] for x in left) - sum(x[4] for x in runs)
    if runs:  # two for each range at most
        table = F.broadcast(spark.createDataFrame(runs, "pid int, at int, slot_pid int, slot_at long, n long"))
        waiting = waiting.join(table, (waiting.pid == table.pid) & (F.col("rank") >= F.col("at")) & (F.col("rank") < F.col("at") + F.col("n")), "left").drop("pid")
        met = waiting.where("n is not null").select("uid", "length", "slot_pid", (F.col("slot_at") + F.col("n") - 1 - (F.col("rank") - F.col("at"))).alias("slot"))
        free = swept.where("uid is null").select("pid", F.col("seq").alias("gap"), F.col("rank").alias("from"), "many")
        own = free.join(table.select(F.col("slot_pid").alias("pid"), "slot_at", "n"), "pid").where(F.expr("from < slot_at + n and slot_at < from + many"))
        own = own.select(F.col("pid").alias("slot_pid"), "gap", F.explode(F.expr("sequence(greatest(from, slot_at), least(from + many, slot_at + n) - 1)")).alias("slot"))
        placed = scratch.table(placed.unionByName(met.join(own, ["slot_pid", "slot"]).select("uid", F.col("gap").alias("seq"), "length")))
        waiting = waiting.where("n is null")
    used = placed.groupBy("seq").agg(F.sum("length").alias("used"))
    gaps = scratch.table(gaps.join(used, "seq", "left").select("seq", (F.col("size") - F.coalesce("used", F.lit(0))).cast("int").alias("size")).where("size > 0"))
    return placed, gaps, scratch.table(waiting.select("uid", "length")) if rest else None


def place(spark: SparkSession, scratch: Scratch, each: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """uid, seq and offset of rows (uid from 0, length from 1 to capacity): sequences of lengths that sum to capacity at most."""
    each = each.select("uid", F.col("length").cast("int").alias("length"))
    histogram = {r["length"]: r["count"] for r in each.groupBy("length").count().collect()}  # one row for each length
    alone = each.where(F.col("length") > capacity // 2).select("uid", F.col("uid").alias("seq"), "length")
    placed = [alone.withColumn("step", F.lit(0))]
    gaps = alone.where(F.col("length") < capacity).select("seq", (F.lit(capacity) - F.col("length")).cast("int").alias("size"))
    opened, step = 0, 0
    for over, up in classes(capacity):
        have = {n: k for n, k in histogram.items() if over < n <= up}
        todo = each.where((F.col("length") > over) & (F.col("length") <= up))
        top, low, n, total = max(have, default=0), min(have, default=0), sum(have.values()), sum(n * k for n, k in have.items())
        moved = 1
        while n:
            fits, room = gaps.where(F.col("size") >= low).agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
            small = top <= capacity // 16
            if fits and moved:  # small pieces fill their gaps well: what they need beyond them opens at once
                new = max(0, -(-(total - room) // capacity)) if small else 0
            else:
                new = -(-total // capacity) if small else -(-n // (capacity // top))
            if new:
                gaps = gaps.unionByName(spark.range(opened, opened + new).select((-1 - F.col("id")).alias("seq"), F.lit(capacity).alias("size")))
                opened += new
            step += 1
            done, gaps, todo = _superstep(spark, scratch, todo, gaps, top, low, n + 2 * (fits + new), capacity)
            placed.append(done.withColumn("step", F.lit(step)))
            was, n = n, 0
            if todo is not None:
                low, top, n, total = todo.agg(F.min("length"), F.max("length"), F.count(F.lit(1)), F.sum("length")).first()
            moved = was - n
    every = reduce(DataFrame.unionByName, placed)
    before = Window.partitionBy("seq").orderBy("step", F.desc("length"), "uid").rowsBetween(Window.unboundedPreceding, -1)
    return every.select("uid", "seq", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long").alias("offset"))


def pack(spark: SparkSession, docs: DataFrame, path: str, ranks: str | None = None, capacity: int = CAPACITY, end: int = END, scratch: Scratch | None = None) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset.

    A null or empty text is a document of its end id alone. Rows are packed one by one, so a repeated doc_id or text is
    packed again; an empty table gives an empty result. Columns other than doc_id and text are not read.
    """
    scratch = scratch or Scratch(spark)
    cuts = scratch.table(pieces(docs, path, ranks, capacity, end).withColumn("uid", F.monotonically_increasing_id()))
    every = place(spark, scratch, cuts.select("uid", "length"), capacity)
    return cuts.join(every, "uid").select("doc_id", "piece", "start", "length", "ids_crc32", F.col("seq").alias("sequence_id"), "offset")
