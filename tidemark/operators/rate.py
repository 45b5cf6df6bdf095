"""Transactions per minute."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def transaction_times(changes: DataFrame, xid: str = "xid", ts: str = "ts") -> DataFrame:
    """One row per transaction with its commit time, the time of its last change."""
    return changes.groupBy(xid).agg(F.max(ts).alias("commit_ts"))


def with_commit_time(changes: DataFrame, xid: str = "xid", ts: str = "ts") -> DataFrame:
    """Give every change of a transaction the same ``commit_ts``.

    Needed before a feed is landed for streaming, where a transaction may be seen in parts.
    """
    return changes.join(transaction_times(changes, xid, ts), xid)


def event_rate(changes: DataFrame, every: str = "minute", xid: str = "xid",
               ts: str = "ts") -> DataFrame:
    """``(total, created_at)`` per time unit; units without transactions have no row.

    Counted per transaction, not per row and not per (row, minute): a transaction that
    spans two minutes counts once, where it commits.  Both steps aggregate before they
    shuffle, so a huge transaction is one row per task.
    """
    times = transaction_times(changes, xid, ts)
    kind = times.schema["commit_ts"].dataType  # date_trunc alone would add a zone to zone-less times
    return (
        times.groupBy(F.date_trunc(every, "commit_ts").cast(kind).alias("created_at"))
        .agg(F.count(F.lit(1)).alias("total"))
        .select("total", "created_at")
    )
