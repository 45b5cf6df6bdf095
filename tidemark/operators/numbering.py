"""Dense numbering of ordered rows without putting a group into one task.

A plain ``row_number`` over (group, order) sorts a whole group in one task.  Here the
order column, an integer, is cut into slots of ``2**bits`` values.  Slot totals come
from a pre-aggregated count; their running sums give each slot its first number; rows
are numbered inside their slot only.  A slot has at most ``2**bits`` distinct values, so
no task gets an unbounded share, whatever the group sizes are.

The running sums over slots recurse the same way (slots of slots) until the span of the
order column leaves at most ``2**FAN_BITS`` slots per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_path, use_checkpoints

MAX_BITS = 20  # values per slot, at most
MIN_BITS = 10
FAN_BITS = 17  # slots summed by one task, at most
HOT_ROWS = 2**22  # rows of a group one task may sort


def order_span(df: DataFrame, order: str) -> int:
    """Greatest minus least value: two scalars from one pre-aggregated pass."""
    low, high = df.agg(F.min(order), F.max(order)).first()
    return 0 if low is None else high - low


def slot_bits(df: DataFrame, span: int) -> int:
    """Slot width giving several slots per core on small inputs, and never over the maximum."""
    cores = max(df.sparkSession.sparkContext.defaultParallelism, 1)
    return min(MAX_BITS, max(MIN_BITS, (span // (4 * cores)).bit_length()))


def _slot(order: str | Column, bits: int) -> Column:
    return F.shiftright(F.col(order) if isinstance(order, str) else order, bits)


def _ahead(amount: Column, partition: Sequence[str], order: str, descending: bool) -> Column:
    """Running sum of everything before the row."""
    by = F.col(order).desc() if descending else F.col(order).asc()
    window = Window.partitionBy(*partition).orderBy(by)
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(amount).over(before), F.lit(0).cast("long"))


def slot_starts(totals: DataFrame, group: Sequence[str], slots: int, descending: bool) -> DataFrame:
    """``_start`` per (group, _slot): the sum of ``_total`` over the slots ahead of it."""
    if slots <= 2 ** FAN_BITS:
        # A handful of sums; the constant key stands in for "no group".
        frame = totals if group else totals.withColumn("_all", F.lit(0))
        start = _ahead(F.col("_total"), list(group) or ["_all"], "_slot", descending)
        return frame.withColumn("_start", start).select(*group, "_slot", "_start")
    upper = totals.withColumn("_upper", _slot("_slot", FAN_BITS))
    sums = upper.groupBy(*group, F.col("_upper").alias("_slot")).agg(F.sum("_total").alias("_total"))
    above = slot_starts(sums, group, slots >> FAN_BITS, descending) \
        .withColumnsRenamed({"_slot": "_upper", "_start": "_above"})
    inner = _ahead(F.col("_total"), [*group, "_upper"], "_slot", descending)
    return (
        upper.withColumn("_inner", inner)
        .join(above, [*group, "_upper"])
        .select(*group, "_slot", (F.col("_above") + F.col("_inner")).alias("_start"))
    )


def _number_slots(rows: DataFrame, order: str, amount: Column, group: Sequence[str], slots: int,
                  descending: bool, name: str, totals: DataFrame | None = None) -> DataFrame:
    """Rows carrying ``_slot`` → the same rows with the running sum ``name``."""
    columns = [c for c in rows.columns if c != "_slot"]
    if totals is None:
        totals = rows.groupBy(*group, "_slot").agg(F.sum(amount).alias("_total"))
    starts = slot_starts(totals, group, slots, descending)
    inner = _ahead(amount, [*group, "_slot"], order, descending)
    return (
        rows.withColumn("_inner", inner)
        .join(starts, [*group, "_slot"])
        .withColumn(name, F.col("_start") + F.col("_inner"))
        .select(*columns, name)
    )


def _amount(weight: str | None) -> Column:
    return (F.lit(1) if weight is None else F.col(weight)).cast("long")


def running_total(df: DataFrame, order: str, weight: str | None = None, group: Sequence[str] = (),
                  *, descending: bool = False, name: str = "position", span: int | None = None,
                  bits: int | None = None, counted: DataFrame | None = None) -> DataFrame:
    """Sum of ``weight`` over the rows ahead in the group's order; exact and 0-based.

    ``weight=None`` counts rows, which numbers them.  ``order`` must be an integer
    column, unique within the group; neither it nor the group may hold nulls.

    When ``weight`` is a count of rows per ``order`` value, ``counted`` gives those rows:
    span and slot totals are then taken from them and need no count per value.
    """
    base = df if counted is None else counted
    span = order_span(base, order) if span is None else span
    bits = slot_bits(df, span) if bits is None else bits
    rows = df.withColumn("_slot", _slot(order, bits))
    totals = None
    if counted is not None:
        totals = counted.groupBy(*group, _slot(order, bits).alias("_slot")) \
            .agg(F.count(F.lit(1)).alias("_total"))
    # One slot more than the span needs: its ends may not fall on slot borders.
    return _number_slots(rows, order, _amount(weight), group, (span >> bits) + 2, descending, name,
                         totals)


def positions_by_range(df: DataFrame, order: Sequence[str], *, descending: bool = False,
                       name: str = "position") -> DataFrame:
    """0-based row numbers for order columns of any sortable type, together unique.

    One range shuffle; rows are numbered where they are sorted, with no second shuffle.
    The borders of a range partitioning are sampled anew whenever a plan runs, so the
    numbered rows are written once, to the shared folder, and both passes read that:
    the totals only its slot column.
    """
    by = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    path = scratch_path(df.sparkSession, "ranged")
    row_in_task = F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1))
    (
        df.repartitionByRange(*by).sortWithinPartitions(*by)
        .withColumns({"_slot": F.spark_partition_id().cast("long"), "_inner": row_in_task})
        .write.parquet(path)
    )
    stored = df.sparkSession.read.parquet(path)
    totals = stored.groupBy("_slot").agg(F.count(F.lit(1)).alias("_total"))
    return (
        stored.join(slot_starts(totals, (), 0, False), "_slot")
        .withColumn(name, F.col("_start") + F.col("_inner"))
        .select(*df.columns, name)
    )


def running_total_by_range(df: DataFrame, order: str, weight: str | None = None, *,
                           descending: bool = False, name: str = "position") -> DataFrame:
    """``running_total`` for order columns of any sortable type, unique over ``df``.

    Slots are the ranges of a range partitioning.  Its borders are sampled anew whenever
    the plan runs, so the ranged rows are checkpointed once and both passes read that.
    """
    use_checkpoints(df.sparkSession)
    ranged = (
        df.repartitionByRange(F.col(order).asc())
        .withColumn("_slot", F.spark_partition_id().cast("long"))
        .checkpoint()
    )
    return _number_slots(ranged, order, _amount(weight), (), 0, descending, name)


def previous_value(df: DataFrame, value: str, order: str, group: Sequence[str],
                   *, name: str = "previous", bits: int = MAX_BITS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``lag(value)`` within the group's order, without a task for a whole hot group.

    Groups of at most ``hot_rows`` rows are sorted as they are.  Larger ones are cut
    into slots; the first row of a slot takes the last value of the slot before it.
    ``order`` is an integer, unique within the group; neither it nor the group is null.

    The list of hot groups has at most one row per ``hot_rows`` rows of input; how it is joined
    is left to adaptive execution.
    """
    hot = (
        df.groupBy(*group).agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > hot_rows)
        .select(*group, F.lit(True).alias("_hot"))
    )
    rows = df.join(hot, list(group), "left") \
        .withColumn("_slot", F.when(F.col("_hot"), _slot(order, bits)))
    last = F.max_by(F.struct(F.col(value).alias("v")), F.col(order))
    by_slot = Window.partitionBy(*group).orderBy("_slot")
    carried = (
        rows.filter(F.col("_hot"))
        .groupBy(*group, "_slot").agg(last.alias("_last"))
        .withColumn("_carried", F.lag("_last").over(by_slot))
        .select(*group, "_slot", "_carried")
    )
    in_slot = Window.partitionBy(*group, "_slot").orderBy(order)
    inner = F.lag(F.struct(F.col(value).alias("v"))).over(in_slot)
    return (
        rows.withColumn("_inner", inner)
        .join(carried, [*group, "_slot"], "left")
        .withColumn(name, F.coalesce("_inner", "_carried")["v"])
        .select(*df.columns, name)
    )
