"""Resolving versions: latest rows, snapshot merges, live-key exclusion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _order(ver: str, tie: str | None) -> list[str]:
    return [ver] if tie is None else [ver, tie]


def latest_state(df: DataFrame, keys: Sequence[str], ver: str = "ver", tie: str | None = "seq",
                 deleted: str | None = None) -> DataFrame:
    """The row with the greatest ``ver`` per key; equal versions go to the greatest ``tie``.

    ``rank = 1`` over a window plans a group limit before the shuffle: each task sends at
    most one row per key, so a key with a third of all rows costs one row per task.
    ``deleted`` names the tombstone column; keys whose latest row has it set are left
    out (after the merge: filtering earlier would revive the row before the delete).
    """
    ranks = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in _order(ver, tie)])
    latest = df.withColumn("_rank", F.row_number().over(ranks)).filter("_rank = 1").drop("_rank")
    return latest if deleted is None else latest.filter(F.col(deleted).isNull())


def latest_state_stream(df: DataFrame, keys: Sequence[str], ver: str = "ver",
                        tie: str | None = "seq") -> DataFrame:
    """``latest_state`` as an aggregate, the form streaming queries support (update mode).

    State holds one row per key: use it for bounded key sets; otherwise append versions
    and resolve when reading.
    """
    row = F.max_by(F.struct(*df.columns), F.struct(*_order(ver, tie)))
    return df.groupBy(*keys).agg(row.alias("_row")).select("_row.*")


def with_snapshot_version(snapshot: DataFrame, ver: str = "ver", tie: str | None = "seq") -> DataFrame:
    """Snapshot rows lose to every change: version 0, position -1."""
    columns = {ver: F.lit(0).cast("long")}
    if tie is not None:
        columns[tie] = F.lit(-1).cast("long")
    return snapshot.withColumns(columns)


def merge_snapshot(snapshot: DataFrame, changes: DataFrame, keys: Sequence[str],
                   ver: str = "ver", tie: str | None = "seq",
                   deleted: str | None = None) -> DataFrame:
    """Snapshot and changes in any order of arrival → the current rows."""
    both = with_snapshot_version(snapshot, ver, tie).unionByName(changes, allowMissingColumns=True)
    return latest_state(both, keys, ver, tie, deleted)


def live_keys(changes: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys touched by the feed, each once: reduced before any shuffle."""
    keys = [key] if isinstance(key, str) else list(key)
    return changes.select(*keys).distinct()


def exclude_live(snapshot: DataFrame, changes: DataFrame, key: str,
                 change_key: str | None = None) -> DataFrame:
    """Snapshot rows whose key the feed has not touched.

    The join strategy is left to adaptive execution, which broadcasts the key set only
    when its measured size is below the threshold.
    """
    live = live_keys(changes, change_key or key)
    if change_key is not None and change_key != key:
        live = live.withColumnRenamed(change_key, key)
    return snapshot.join(live, key, "left_anti")


def refresh_keys(source: DataFrame, ids: Sequence | DataFrame, key: str,
                 changes: DataFrame | None = None, change_key: str | None = None) -> DataFrame:
    """Rows with the given ids, minus keys the feed has touched.

    Ids are a list or a one-column DataFrame; either way a semi-join, whatever its length.
    """
    if isinstance(ids, DataFrame):
        wanted = ids.toDF(key).distinct()
    else:
        kind = source.schema[key].dataType.simpleString()
        wanted = source.sparkSession.createDataFrame([(i,) for i in set(ids)], f"`{key}` {kind}")
    rows = source.join(wanted, key, "left_semi")
    return rows if changes is None else exclude_live(rows, changes, key, change_key)
