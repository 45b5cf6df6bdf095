"""Transactions per minute over a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def store_commit_times(changes: DataFrame, path: str, checkpoint_dir: str, *, xid: str = "xid",
                       commit_ts: str = "commit_ts", available_now: bool = False,
                       interval: str = "5 seconds") -> StreamingQuery:
    """Keep per micro-batch the latest commit time of each transaction in it.

    However late a change comes, it is counted: nothing is dropped and no window is kept back.
    A replayed micro-batch replaces its own folder.
    """
    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.groupBy(F.col(xid).alias("xid")).agg(F.max(F.col(commit_ts).cast("timestamp")).alias("commit_ts")) \
            .write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = changes.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def stored_event_rate(spark: SparkSession, path: str, every: str = "1 minute") -> DataFrame:
    """``(total, created_at)`` per window: each transaction once, at its latest commit time.

    Transactions split over micro-batches are put together first; both steps aggregate before
    they shuffle.
    """
    times = spark.read.schema("xid BIGINT, commit_ts TIMESTAMP, batch_id BIGINT").parquet(path)
    return times.groupBy("xid").agg(F.max("commit_ts").alias("commit_ts")) \
        .groupBy(F.window("commit_ts", every)).agg(F.count(F.lit(1)).alias("total")) \
        .select("total", F.col("window.start").alias("created_at"))
