"""Per-key results over keys of very uneven size.

Rows are first folded into partial states inside every input task, so a key leaves a task at most
once. The partial states are range-partitioned on the composite of the key and a secondary order
(the task that made the state), with Spark's sampled quantiles as bounds, so the states of one heavy
key may spread over several partitions. Each partition is sorted and folded again. Only its first and
its last key can go on in a neighbouring partition; these boundary states alone are stitched together
by a last, tiny aggregation.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beadloom.runtime import cut, parts

_FOLD_ROWS = 1 << 20


def _arrow_fold(keys: list[str], sums: list[str], table: pa.Table) -> pa.Table:
    """One state per key, in Spark's ascending order (nulls first)."""
    made = table.group_by(keys, use_threads=False).aggregate([(s, "sum") for s in sums])
    made = made.rename_columns([c[:-4] if c.endswith("_sum") and c[:-4] in sums else c for c in made.column_names])
    return made.take(pc.sort_indices(made, sort_keys=[(k, "ascending") for k in keys], null_placement="at_start"))


def balanced_totals(df: DataFrame, keys: list[str], sums: list[str], n: int | None = None) -> DataFrame:
    """Rows and sums of every key, without a task per heavy key.

    ``keys`` are long or string columns, ``sums`` long columns (a null counts as 0). The result has
    the keys, ``n_rows`` and the sums, one row per distinct key. Nulls in a key form a key of
    their own, as in GROUP BY; an empty input gives an empty result; other columns of ``df`` are ignored.
    Repeated rows count each time.
    """
    n = n or parts(df.sparkSession)
    held = [*(f"s{i}" for i in range(len(sums))), "n_rows"]
    named = [f"k{i}" for i in range(len(keys))]
    narrow = df.select(
        *(F.col(k).alias(a) for k, a in zip(keys, named)),
        *(F.coalesce(F.col(s).cast("long"), F.lit(0)).alias(a) for s, a in zip(sums, held)),
    )
    kinds = [narrow.schema[a].dataType for a in named]
    state = T.StructType(
        [*(T.StructField(a, k) for a, k in zip(named, kinds)), *(T.StructField(h, T.LongType()) for h in held), T.StructField("turn", T.IntegerType())]
    )
    merged = T.StructType([*state.fields[:-1], T.StructField("open", T.BooleanType())])

    def fold_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        turn, waiting, rows, kept = TaskContext.get().partitionId(), [], 0, None

        def fold() -> pa.Table:
            tables = [*([kept] if kept is not None else [])]
            if waiting:
                raw = pa.Table.from_batches(waiting)
                tables.append(raw.append_column("n_rows", pa.repeat(pa.scalar(1, pa.int64()), raw.num_rows)))
            # columns only, as fields that may and may not be null do not go together
            return _arrow_fold(named, held, pa.concat_tables([pa.table({c: t[c] for c in (*named, *held)}) for t in tables]))

        for b in batches:
            waiting.append(b)
            rows += b.num_rows
            if rows >= _FOLD_ROWS:
                kept, waiting, rows = fold(), [], 0
                if kept.num_rows > _FOLD_ROWS:  # mostly distinct keys: hand them on, a later state of the key is stitched
                    yield from kept.append_column("turn", pa.repeat(pa.scalar(turn, pa.int32()), kept.num_rows)).select(state.names).to_batches()
                    kept = None
        if waiting or kept is not None:
            out = fold()
            yield from out.append_column("turn", pa.repeat(pa.scalar(turn, pa.int32()), out.num_rows)).select(state.names).to_batches()

    def fold_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Batches come sorted by key; the last key of a batch waits for the next batch."""
        tail, first = None, True

        def give(t: pa.Table, opens: list[int]) -> Iterator[pa.RecordBatch]:
            flags = np.zeros(t.num_rows, dtype=bool)
            flags[opens] = True
            yield from t.append_column("open", pa.array(flags)).select(merged.names).to_batches()

        for b in batches:
            if not b.num_rows:
                continue
            t = pa.table({c: b[c] for c in (*named, *held)})
            t = _arrow_fold(named, held, pa.concat_tables([tail, t]) if tail is not None else t)
            body, tail = t.slice(0, t.num_rows - 1), t.slice(t.num_rows - 1)
            if body.num_rows:
                yield from give(body, [0] if first else [])
                first = False
        if tail is not None:
            yield from give(tail, [0])

    # written once: sampling the bounds reads them a second time
    states = cut(narrow.mapInArrow(fold_task, state))
    ranged = states.repartitionByRange(n, *named, "turn").sortWithinPartitions(*named)
    # read twice below: sampled bounds may differ from run to run, so the states are written once
    local = cut(ranged.mapInArrow(fold_range, merged))
    # closed keys end here; open ones, at most two per partition, are put together
    closed = local.filter(~F.col("open")).select(*named, *held)
    stitched = local.filter("open").groupBy(*named).agg(*(F.sum(h).alias(h) for h in held))
    out = closed.unionByName(stitched)
    return out.select(*(F.col(a).alias(k) for a, k in zip(named, keys)), "n_rows", *(F.col(h).alias(s) for h, s in zip(held, sums)))


def key_fields(molecules: DataFrame) -> DataFrame:
    """One row per molecule and key field, with a non-null key: ``key_field, key_id, reads``."""
    both = F.expr("stack(2, 'cb_index', cb_index, 'sb_index', sb_index) AS (key_field, key_id)")
    return molecules.select(both, "reads").filter(F.col("key_id").isNotNull())


def key_totals(molecules: DataFrame, n: int | None = None) -> DataFrame:
    """``key_field, key_id, n_rows, reads`` of every non-null key of both fields."""
    return balanced_totals(key_fields(molecules), ["key_field", "key_id"], ["reads"], n)


def dominant_keys(molecules: DataFrame, percent: int = 4, n: int | None = None) -> DataFrame:
    """Keys whose rows hold at least ``percent`` % of all reads, rows with a null key included in the whole.

    With no reads at all every share is undefined and nothing is returned.
    """
    whole = molecules.agg(F.coalesce(F.sum("reads"), F.lit(0)).alias("whole")).scalar()
    return (
        key_totals(molecules, n)
        .filter((F.col("reads") * 100 >= whole * percent) & (F.col("reads") > 0))
        .select("key_field", F.col("key_id").cast("long").alias("key_id"))
    )
