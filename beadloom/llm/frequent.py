"""Most frequent items of a huge column in bounded memory, by lossy counting.

Every task reads its rows in buckets of ``width = ceil(1 / epsilon)`` rows. An entry holds an item, its count
since it was entered and the most it may have been undercounted before (the number of closed buckets when it
was entered). At a bucket's end entries with ``count + undercount <= buckets closed`` are dropped, which leaves at
most ``1/epsilon * log(epsilon * N)`` entries. Summaries of tasks are merged by adding counts; an item absent from a task's
summary may have occurred there as often as that task closed buckets. So the true count of every item lies in
``[count_low, count_high]``, and an item in no summary occurs at most ``unseen`` times.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beadloom.runtime import cut


def _task(width: int):
    schema = "item string, count long, undercount long, missed long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = pa.table({"item": pa.array([], pa.string()), "count": pa.array([], pa.int64()), "undercount": pa.array([], pa.int64())})
        entries, bucket, rows, closed = empty, [], 0, 0

        def close(full: bool) -> pa.Table:
            """Fold the open bucket into the entries; drop the small ones if it is full."""
            items = pa.chunked_array(bucket).combine_chunks()
            got = pc.value_counts(items)
            new = pa.table({"item": got.field("values"), "count": got.field("counts"), "undercount": pa.array(np.full(len(got), closed, dtype=np.int64))})
            # an item entered before keeps its smaller undercount
            both = pa.concat_tables([entries, new]).group_by("item", use_threads=False).aggregate([("count", "sum"), ("undercount", "min")])
            both = pa.table({"item": both["item"], "count": both["count_sum"], "undercount": both["undercount_min"]})
            return both.filter(pc.greater(pc.add(both["count"], both["undercount"]), closed + 1)) if full else both

        for b in batches:
            col, at = b.column(0), 0
            while at < len(col):
                took = min(width - rows, len(col) - at)
                bucket.append(col.slice(at, took))
                rows, at = rows + took, at + took
                if rows == width:
                    entries = close(True)
                    bucket, rows, closed = [], 0, closed + 1
        if rows:
            entries = close(False)
        if entries.num_rows or closed:
            # one row without an item carries what this task may have missed
            entries = pa.concat_tables([entries, pa.table({"item": pa.array([None], pa.string()), "count": pa.array([0], pa.int64()), "undercount": pa.array([0], pa.int64())})])
            yield from entries.append_column("missed", pa.array(np.full(entries.num_rows, closed, dtype=np.int64))).to_batches()

    return run, schema


def lossy_summary(items: DataFrame, epsilon: float) -> DataFrame:
    """``item, count_low, count_high, unseen`` of every item some task still holds, from a column ``item`` of strings.

    Null items are not counted; an empty column gives no rows. Equal strings are one item; case and blanks matter.
    """
    run, schema = _task(max(1, math.ceil(1 / epsilon)))
    held = items.filter("item IS NOT NULL").mapInArrow(run, schema)
    sums = cut(held.groupBy("item").agg(F.sum("count").alias("low"), F.sum(F.col("missed") - F.col("undercount")).alias("known"), F.sum("missed").alias("missed")))
    unseen = F.coalesce(sums.filter("item IS NULL").select("missed").scalar(), F.lit(0))
    return sums.filter("item IS NOT NULL").select("item", F.col("low").alias("count_low"), (F.col("low") + unseen - F.col("known")).alias("count_high"), unseen.alias("unseen"))


#: Smallest epsilon: a task holds a bucket of a million items and its entries, and no more.
FLOOR = 1e-6


def frequent_items(items: DataFrame, k: int, epsilon: float = 2e-4, floor: float = FLOOR) -> DataFrame:
    """The ``k`` most frequent items: ``item, place, n, count_low, count_high, sure``.

    Items whose upper bound reaches the ``k``-th largest lower bound are candidates; they are at most a few
    times ``1/epsilon``, and a second pass counts them exactly (``n``). Should an item outside all summaries
    possibly belong to the ``k`` (``unseen`` at least that lower bound), the pass is repeated with a quarter
    of ``epsilon``, but never with less than ``floor``, which bounds the memory of a task. On a column so flat that this does not decide
    it, ``sure`` is false: counts and intervals hold, but an item outside of the summaries may occur up to ``unseen`` times.
    Ties are broken by the item's text. Fewer than ``k`` distinct items give fewer rows; an empty column gives none.
    """
    while True:
        summary = lossy_summary(items, epsilon)
        top = summary.orderBy(F.desc("count_low")).limit(k).agg(F.count("*").alias("n"), F.min("count_low").alias("least"), F.max("unseen").alias("unseen")).first()
        exact = not top["unseen"]
        sure = exact or (top["n"] == k and top["least"] > top["unseen"])
        if sure or epsilon <= floor:
            break
        epsilon = max(epsilon / 4, floor)
    least = top["least"] if top["n"] == k else 0
    likely = cut(summary.filter(F.col("count_high") >= F.lit(least)))
    if exact:
        counted = likely.withColumn("n", F.col("count_low"))
    else:
        small = likely.count() <= 100_000
        side = likely.select("item")
        n = items.join(F.broadcast(side) if small else side, "item", "left_semi").groupBy("item").agg(F.count("*").alias("n"))
        counted = likely.join(n, "item")
    best = counted.orderBy(F.desc("n"), "item").limit(k)
    place = F.expr("row_number() OVER (ORDER BY n DESC, item)")
    return best.select("item", place.alias("place"), "n", "count_low", "count_high", F.lit(bool(sure)).alias("sure"))


def normal_barcode(c: str | Column) -> Column:
    return F.upper(F.trim(c))


def frequent_barcodes(puck: DataFrame, molecules: DataFrame, k_sb: int = 10, k_index: int = 12) -> DataFrame:
    """Both columns of the problem: ``item_field, item, place, n, count_low, count_high, sure``."""
    sb = frequent_items(puck.select(normal_barcode("sb").alias("item")), k_sb)
    index = frequent_items(molecules.select(F.col("sb_index").cast("string").alias("item")), k_index)
    return sb.withColumn("item_field", F.lit("puck.sb")).unionByName(index.withColumn("item_field", F.lit("molecules.sb_index")))
