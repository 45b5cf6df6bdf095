"""Filtering and stamping change rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.mapping import Mapping


def filter_mapped(changes: DataFrame, mapping: Mapping, table: str = "source_table") -> DataFrame:
    """Changes of tables that some rule names.  The list is literal, so the scan can use it."""
    return changes.filter(F.col(table).isin(mapping.distinct_tables()))


def live_changes(changes: DataFrame, op: str = "op") -> DataFrame:
    """Inserts and updates; deletes and anything else do not flow on."""
    return changes.filter(F.col(op).isin("insert", "update"))


def version_of(seq: str = "seq") -> Column:
    """A version from the feed position: above 0, so above any snapshot row."""
    return (F.col(seq) + 1).cast("long")


def stamp_version(changes: DataFrame, by: str = "seq", seq: str = "seq",
                  commit_ts: str = "commit_ts") -> DataFrame:
    """``ver`` from the feed position, or from the commit time in nanoseconds.

    Both are functions of the feed, so a replay stamps the same versions.
    """
    if by == "seq":
        return changes.withColumn("ver", version_of(seq))
    if by == "commit_ts":
        nanos = F.unix_micros(F.col(commit_ts).cast("timestamp")) * 1000
        return changes.withColumn("ver", nanos)
    raise ValueError(f"unknown version source {by!r}")


def tombstones(changes: DataFrame, dest: str, mapping: Mapping | None = None, *,
               op: str = "op", deleted_at: str = "commit_ts", seq: str = "seq",
               table: str | None = None) -> DataFrame:
    """Deletes as versioned rows for ``dest``, stamped with the time of the delete.

    They skip the remap.  With ``mapping`` given, only deletes of mapped tables count:
    pass the table's name, or rely on the ``source_table`` column.
    """
    deletes = changes.filter(F.col(op) == "delete")
    if mapping is not None:
        if table is not None:
            deletes = deletes if mapping.by_source(table) else deletes.filter(F.lit(False))
        else:
            deletes = filter_mapped(deletes, mapping)
    return deletes.withColumns({
        "dest_table": F.lit(dest),
        "deleted_at": F.col(deleted_at),
        "ver": version_of(seq),
    })
