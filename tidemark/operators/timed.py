"""Batches that close by size or by time (B1), in parallel.

A batch takes rows in order until it has ``size`` of them or a row comes ``limit_ms`` or more
after the batch's first one; that row begins the next batch.  Where a batch begins depends on
where the one before began, back to the first row, so the rule as it stands is one walk over
everything.  What does not depend on it is the *link* of a row: where the next batch would begin
if one began here.  Batches are the chain of links from row 0.

1. Rows are numbered; ``size`` neighbours are a chunk.  A link ends in its own chunk or the next,
   so a chunk's links need its rows and those of the next.
2. Each chunk finds, for each of its rows, where the chain from there enters the next chunk.
3. Pointer doubling over chunks: level k tells, for the rows of every 2^k-th chunk, where the
   chain enters 2^k chunks later.  Each level has half the rows of the one below, all together
   twice the rows of the table.  Going down again from row 0 gives the entry of every chunk.
4. Each chunk walks from its entry, all of them at once, and batches are numbered.

A chunk is never larger than a batch may be, so no task holds more, whatever the group's size.

Defined results: the order column is an integer, unique within the group, and neither it nor the
group is null; times that fall behind an earlier row's count as that row's; rows without a time
count as if they came with the row before them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.batches import BATCH_ROWS
from tidemark.operators.numbering import running_total
from tidemark.session import scratch_path

# Fixed value: milliseconds after which a batch of the live path closes.
BATCH_MS = 5_000
_NONE = -1  # a chain that ends


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _links(size: int, limit_ms: int, keys: int) -> Callable[[pa.Table], pa.Table]:
    """Per own row of a chunk: ``next``, its link, and ``exit``, where the chain leaves the chunk."""
    def run(table: pa.Table) -> pa.Table:
        place, ms, own = (np.asarray(table[c]) for c in ("_p", "_ms", "_own"))
        order = np.argsort(place)
        place, ms, own = place[order], ms[order], own[order]
        n = int(own.sum())  # own rows come first
        reach = np.searchsorted(ms, ms[:n] + limit_ms, side="left")
        step = np.minimum(reach, np.arange(n) + size)
        step[step >= len(place)] = _NONE
        leave = step.copy()
        for i in range(n - 1, -1, -1):
            if 0 <= leave[i] < n:
                leave[i] = leave[leave[i]]
        first = int(place[0])
        kept = [table.column(k).combine_chunks().take(pa.array(order[:n])) for k in range(keys + 1)]
        return pa.table([*kept, pa.array(place[:n]), *(pa.array(np.where(x == _NONE, _NONE, x + first)) for x in (step, leave))],
                        names=[*table.column_names[:keys + 1], "_p", "_next", "_exit"])

    return run


def _walked(keys: int) -> Callable[[pa.Table], pa.Table]:
    """Per row of a chunk the beginning of its batch, or none if that lies in the chunk before."""
    def run(table: pa.Table) -> pa.Table:
        place, step, entry = (np.asarray(table[c]) for c in ("_p", "_next", "_entry"))
        order = np.argsort(place)
        place, step, begin = place[order], step[order], np.full(len(order), _NONE)
        at = int(entry[0])
        while at != _NONE and at <= place[-1]:
            begin[at - place[0]] = at
            at = int(step[at - place[0]])
        begin = np.maximum.accumulate(begin)
        kept = [table.column(k).combine_chunks().take(pa.array(order)) for k in range(keys + 1)]
        return pa.table([*kept, pa.array(place), pa.array(begin)], names=[*table.column_names[:keys + 1], "_p", "_begin"])

    return run


def assign_timed_batches(df: DataFrame, size: int = BATCH_ROWS, limit_ms: int = BATCH_MS, *, order: str = "seq",
                         ts: str = "ts", group: Sequence[str] = ("source_table", "dest_table")) -> DataFrame:
    """``batch_id`` per group, from 0: at most ``size`` rows, all less than ``limit_ms`` after the first."""
    group = list(group)
    numbered = running_total(df, order, group=group, name="_p")
    millis = F.unix_millis(F.col(ts).cast("timestamp"))
    narrow = _stored(numbered.select(*group, F.call_function("div", F.col("_p"), F.lit(size)).alias("_chunk"), "_p",
                                     millis.alias("_ms"), F.col(order).alias("_order")), "timed")
    # Times never fall: the greatest of the chunks before, then of the rows before in the chunk.
    before = Window.partitionBy(*group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    tops = narrow.groupBy(*group, "_chunk").agg(F.max("_ms").alias("_top")) \
        .withColumn("_floor", F.max("_top").over(before)).drop("_top")
    within = Window.partitionBy(*group, "_chunk").orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)
    rising = F.coalesce(F.greatest(F.max("_ms").over(within), F.col("_floor")), F.lit(0).cast("long"))
    rows = narrow.join(tops, [*group, "_chunk"]).select(*group, "_chunk", "_p", rising.alias("_ms"))
    # A chunk sees its own rows and, behind them, those of the next.
    seen = rows.withColumn("_own", F.explode(F.array(F.lit(True), F.lit(False)))) \
        .filter("_own OR _chunk > 0").withColumn("_chunk", F.col("_chunk") - F.when(F.col("_own"), 0).otherwise(1))
    keys = [narrow.schema[c] for c in group] + [T.StructField("_chunk", T.LongType())]
    longs = [T.StructField(c, T.LongType()) for c in ("_p", "_next", "_exit")]
    links = _stored(seen.select(*group, "_chunk", "_p", "_ms", "_own").groupBy(*group, "_chunk")
                    .applyInArrow(_links(size, limit_ms, len(group)), T.StructType(keys + longs)), "links")

    last = links.agg(F.max("_chunk")).first()[0] or 0
    levels = [links.select(*group, "_chunk", "_p", "_exit")]
    while 1 << len(levels) <= last:
        below, width = levels[-1], 1 << len(levels)
        on = below.select(*group, F.col("_p").alias("_exit"), F.col("_exit").alias("_further"))
        levels.append(_stored(
            below.filter(F.col("_chunk") % width == 0).join(on, [*group, "_exit"], "left")
            .select(*group, "_chunk", "_p", F.coalesce("_further", F.lit(_NONE).cast("long")).alias("_exit")), "doubled"))
    entries = narrow.filter("_p = 0").select(*group, F.col("_chunk"), F.col("_p").alias("_entry"))
    for k in range(len(levels), 0, -1):
        step = 1 << (k - 1)
        reached = entries.filter(F.col("_chunk") % (2 * step) == 0) \
            .join(levels[k - 1].select(*group, F.col("_p").alias("_entry"), "_exit"), [*group, "_entry"]) \
            .filter(F.col("_exit") != _NONE).select(*group, (F.col("_chunk") + step).alias("_chunk"), F.col("_exit").alias("_entry"))
        entries = _stored(entries.unionByName(reached), "entries")

    walked = _stored(
        links.join(entries, [*group, "_chunk"], "left").withColumn("_entry", F.coalesce("_entry", F.lit(_NONE).cast("long")))
        .select(*group, "_chunk", "_p", "_next", "_entry").groupBy(*group, "_chunk")
        .applyInArrow(_walked(len(group)), T.StructType([*keys, longs[0], T.StructField("_begin", T.LongType())])), "walked")
    begins = walked.filter(F.col("_begin") == F.col("_p")).select(*group, F.col("_begin").alias("_from"), "_chunk")
    carried = begins.groupBy(*group, (F.col("_chunk") + 1).alias("_chunk")).agg(F.max("_from").alias("_carried"))
    batches = running_total(begins.drop("_chunk"), "_from", group=group, name="batch_id")
    placed = walked.join(carried, [*group, "_chunk"], "left") \
        .withColumn("_from", F.when(F.col("_begin") == _NONE, F.col("_carried")).otherwise(F.col("_begin"))) \
        .join(batches, [*group, "_from"]).select(*group, "_p", "batch_id")
    known = narrow.select(*group, "_p", F.col("_order").alias(order)).join(placed, [*group, "_p"]).drop("_p")
    return df.join(known, [*group, order]).select(*df.columns, "batch_id")
