"""Batches of a feed and their reports (B1, B2, K4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.numbering import running_total

# Fixed value: rows of a batch of the live path.
BATCH_ROWS = 10_000


def assign_batches(df: DataFrame, size: int = BATCH_ROWS, order: str = "seq",
                   group: tuple[str, ...] = ("source_table", "dest_table"),
                   span: int | None = None, bits: int | None = None) -> DataFrame:
    """``batch_id`` per group: the first ``size`` rows in feed order are batch 0, and so on.

    A stream gets the time limit from its trigger interval; each micro-batch is then cut
    by size here.
    """
    numbered = running_total(df, order, group=group, name="_position", span=span, bits=bits)
    return numbered.withColumn("batch_id", F.floor(F.col("_position") / size).cast("long")) \
        .drop("_position")


def partition_by_table(df: DataFrame, order: str = "seq", table: str = "source_table",
                       key: str | None = None, partitions: int | None = None) -> DataFrame:
    """Tables side by side, each in feed order.

    Ranges of (table, order) keep the whole order and split a table with most of the rows over
    many tasks.  With ``key`` rows are dealt by key instead, and each key's own order is kept,
    which is all that versions need.
    """
    if key is None:
        columns = [F.col(table), F.col(order)]
        spread = df.repartitionByRange(*columns) if partitions is None else df.repartitionByRange(partitions, *columns)
        return spread.sortWithinPartitions(table, order)
    columns = [F.col(table), F.col(key)]
    spread = df.repartition(*columns) if partitions is None else df.repartition(partitions, *columns)
    return spread.sortWithinPartitions(order)


def load_report(batches: DataFrame, key: str | None = "id", order: str = "seq",
                loaded_at: str | None = None, with_ids: bool = False,
                by: tuple[str, ...] = ("dest_table", "batch_id")) -> DataFrame:
    """First id and row count per batch; ``with_ids`` adds the ids, comma-joined in order.

    The id list is the report of a failed load.  It gathers one batch, so it may only be
    asked for batches of bounded size, as ``assign_batches`` makes them.
    Where several sources share a destination, name ``source_table`` in ``by`` too.
    Rows without the key column report ``-`` and no first id.
    """
    has_key = key is not None and key in batches.columns
    first = F.min_by(key, order) if has_key else F.lit(None).cast("string")
    measures = [first.alias("first_id"), F.count(F.lit(1)).alias("rows")]
    if loaded_at is not None:
        measures.append(F.max(loaded_at).alias("loaded_at"))
    if with_ids:
        if has_key:
            pairs = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(key).alias("k"))))
            ids = F.array_join(F.transform(pairs, lambda p: p["k"].cast("string")), ",")
        else:
            ids = F.lit("-")
        measures.append(ids.alias("ids"))
    return batches.groupBy(*by).agg(*measures)
