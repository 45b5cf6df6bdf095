"""Copying a table in pages or id windows."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.numbering import (positions_by_range, running_total,
                                          running_total_by_range)
from tidemark.operators.replica import exclude_live

# Default sizes of a keyset page and of an id window.
PAGE_ROWS = 5_000
WINDOW_IDS = 10_000

# A page list longer than this is unfolded in two steps.
PAGE_CHUNK = 4_096

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def max_value(df: DataFrame, col: str) -> DataFrame:
    """One row with ``max_value``; null on empty input."""
    return df.agg(F.max(col).alias("max_value"))


def row_count(df: DataFrame, estimate: int | None = None) -> int:
    """The catalogue's estimate if it is above 0, else an exact count."""
    return estimate if estimate is not None and estimate > 0 else df.count()


def catalogue_estimate(spark: SparkSession, table: str) -> int | None:
    """Row count kept by ``ANALYZE TABLE … COMPUTE STATISTICS``, if there is one."""
    stats = spark.sql(f"DESCRIBE EXTENDED {table}").filter("col_name = 'Statistics'").first()
    words = stats["data_type"].replace(",", "").split() if stats else []
    return int(words[words.index("rows") - 1]) if "rows" in words else None


def fetch_page(df: DataFrame, col: str, last: Any = None, n: int = PAGE_ROWS) -> DataFrame:
    """The ``n`` greatest rows below the cursor, or of the whole table without one."""
    rest = df if last is None else df.filter(F.col(col) < F.lit(last))
    return rest.orderBy(F.col(col).desc()).limit(n)


def start_cursor(max_value: Any) -> Any:
    """First cursor of a job: just above the maximum for integers, else none.

    Without a cursor the first page has no lower-than condition, so the greatest value
    of a date or text column is not skipped.
    """
    if isinstance(max_value, int) and not isinstance(max_value, bool):
        return max_value + 1
    return None


def unordered_rows(df: DataFrame, col: str) -> DataFrame:
    """How many rows no page will hold, as their ordering value is null."""
    return df.agg(F.count_if(F.col(col).isNull()).alias("rows"))


def _as_integer(col: str, dtype: T.DataType) -> Column | None:
    """An integer with the column's order, where there is one without loss."""
    if isinstance(dtype, _INTEGERS):
        return F.col(col).cast("long")
    if isinstance(dtype, T.DateType):
        return F.unix_date(col).cast("long")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(col)
    if isinstance(dtype, T.TimestampNTZType):  # of the clock itself, in no zone
        seconds = F.extract(F.lit("SECOND"), F.col(col))
        return (F.unix_date(F.col(col).cast("date")).cast("long") * 86_400_000_000
                + F.hour(col).cast("long") * 3_600_000_000 + F.minute(col).cast("long") * 60_000_000
                + (seconds * 1_000_000).cast("long"))
    if isinstance(dtype, T.DecimalType) and dtype.precision <= 18:
        return (F.col(col) * F.lit(10 ** dtype.scale).cast("decimal(19,0)")).cast("long")
    return None


def _page_summary(parts: DataFrame, n: int) -> DataFrame:
    return (
        parts.groupBy("page")
        .agg(F.sum("part").alias("rows"), F.min("v").alias("last_id"))
        .withColumn("processed", F.col("page") * n + F.col("rows"))
    )


def plan_pages(df: DataFrame, col: str, n: int = PAGE_ROWS, *, unique: bool = False,
               key: str | None = None, bits: int | None = None) -> DataFrame:
    """All pages of a descending keyset copy at once: ``page, rows, last_id, processed``.

    Equal values are first counted together (pre-aggregated, so a value on a third of
    the rows is one row per task), then laid out by running totals and cut into pages.
    ``unique=True`` skips that count for an integer column known to have no repeats.
    For a column that is no integer, date or timestamp, ``key``, a unique column, lets
    rows be laid out by (column, key) instead, which saves a shuffle.
    Ties never get lost at page borders; rows with a null value are on no page.
    """
    present = df.filter(F.col(col).isNotNull())
    values = present.select(F.col(col).alias("v"))
    number = _as_integer("v", values.schema["v"].dataType)
    page_of = F.call_function("div", F.col("ahead"), F.lit(n)).alias("page")
    one = F.lit(1).cast("long")
    if number is None and key is not None:
        keyed = present.select(F.col(col).alias("v"), F.col(key).alias("k"))
        laid = positions_by_range(keyed, ["v", "k"], descending=True, name="ahead")
        return _page_summary(laid.select("v", page_of, one.alias("part")), n)
    if number is not None and unique:
        laid = running_total(values.withColumn("number", number), "number",
                             descending=True, name="ahead", bits=bits)
        return _page_summary(laid.select("v", page_of, one.alias("part")), n)
    runs = values.groupBy("v").agg(F.count(F.lit(1)).alias("rows"))
    if number is None:
        laid = running_total_by_range(runs, "v", "rows", descending=True, name="ahead")
    else:
        laid = running_total(runs.withColumn("number", number), "number", "rows", descending=True,
                             name="ahead", bits=bits, counted=values.select(number.alias("number")))
    # One value may cover many pages: unfold the page list in bounded chunks.
    last = F.call_function("div", F.col("ahead") + F.col("rows") - 1, F.lit(n))
    chunks = laid.select("v", "ahead", "rows", last.alias("last"), F.explode(F.sequence(
        F.call_function("div", F.col("ahead"), F.lit(n)), last, F.lit(PAGE_CHUNK).cast("long"))).alias("c"))
    pages = chunks.select(
        "v", "ahead", "rows",
        F.explode(F.sequence("c", F.least(F.col("c") + PAGE_CHUNK - 1, "last"))).alias("page"))
    begin = F.greatest(F.col("ahead"), F.col("page") * n)
    end = F.least(F.col("ahead") + F.col("rows"), (F.col("page") + 1) * n)
    return _page_summary(pages.select("v", "page", (end - begin).alias("part")), n)


def _windowed(df: DataFrame, key: str, batch: int) -> DataFrame:
    """Rows with ``window`` and its ``high_id``; window 0 holds the ``batch + 1`` greatest ids."""
    high = df.agg(F.max(key).cast("long")).scalar()
    below = high - F.col(key).cast("long")
    return df.filter(F.col(key) >= 0).withColumns({
        "window": F.call_function("div", below, F.lit(batch + 1)),
        "high_id": F.col(key).cast("long") + below % (batch + 1),
    })


def plan_windows(df: DataFrame, key: str, batch: int = WINDOW_IDS) -> DataFrame:
    """Inclusive id windows from the greatest id down: ``window, low_id, high_id, rows``.

    One hash aggregate, no sort.  Negative ids are not copied; id 0 is.  Windows without
    rows are left out, and an empty table has none.
    """
    return (
        _windowed(df.select(key), key, batch)
        .groupBy("window", "high_id").agg(F.count(F.lit(1)).alias("rows"))
        .select("window", F.greatest(F.col("high_id") - batch, F.lit(0)).alias("low_id"),
                "high_id", "rows")
    )


def copy_windows(df: DataFrame, key: str, batch: int = WINDOW_IDS,
                 changes: DataFrame | None = None, change_key: str | None = None) -> DataFrame:
    """The rows to copy, each with its window, minus keys the feed has touched."""
    rows = _windowed(df, key, batch).drop("high_id")
    return rows if changes is None else exclude_live(rows, changes, key, change_key)
