"""Coverage and reconciliation reports."""

from __future__ import annotations

from collections.abc import Mapping as Dict
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.progress import percent_done
from tidemark.sources.mapping import Mapping


def unmapped_report(changes: DataFrame, mapping: Mapping, table: str = "source_table",
                    seq: str = "seq") -> DataFrame:
    """Rows and last position of every table no rule names."""
    unmapped = F.col(table).isNull() | ~F.col(table).isin(mapping.distinct_tables())
    return changes.filter(unmapped).groupBy(table).agg(
        F.count(F.lit(1)).alias("rows"), F.max(seq).alias("last_seq"))


def _table_progress(name: str, snapshot: DataFrame, replica: DataFrame) -> DataFrame:
    (key,), (replica_key,) = snapshot.columns, replica.columns
    # Many versions of a key count once; the distinct reduces before it shuffles.
    seen = replica.distinct().select(F.col(replica_key).alias(key), F.lit(True).alias("_seen"))
    return snapshot.join(seen, key, "left").agg(
        F.count(F.lit(1)).alias("total_rows"), F.count("_seen").alias("processed_rows"),
    ).select(F.lit(name).alias("source_table"), "*")


def progress(snapshots: Dict[str, DataFrame], replicas: Dict[str, DataFrame]) -> DataFrame:
    """Per table, how many snapshot keys the replica holds.

    Both sides map a table to a one-column frame of keys.  A table without a replica has
    nothing processed.
    """
    frames = []
    for name, snapshot in snapshots.items():
        replica = replicas.get(name)
        if replica is None:
            replica = snapshot.filter(F.lit(False))
        frames.append(_table_progress(name, snapshot, replica))
    return reduce(DataFrame.unionByName, frames).withColumn(
        "progress_percent", percent_done(F.col("processed_rows"), F.col("total_rows")))
