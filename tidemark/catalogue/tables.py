"""The given tables as a change feed, a message log, a job log and snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.mapping import Mapping

EVENTS_SCHEMA = ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
                 "value DOUBLE, props STRING")

# Three changes make a transaction; the position in the feed is the event id.
FEED_SQL = """
    SELECT event_id // 3 AS xid, event_id AS seq, ts, event_type AS source_table,
           CASE event_type WHEN 'signup' THEN 'insert' WHEN 'error' THEN 'delete'
                ELSE 'update' END AS op,
           user_id AS id, event_type, value, props
    FROM events"""

# Every event type is its own source table.  'error' has no rule.
RULES = Mapping.from_dicts([
    {"source_table": "signup", "dest_table": "accounts", "topic": "accounts",
     "remap": {"id": "{id}", "origin": "feed", "label": "kind:{event_type}", "score": "{value}"}},
    {"source_table": "click", "dest_table": "activity", "topic": "activity",
     "remap": {"id": "{id}", "action": "{event_type}", "amount": "{value}", "weight": 1}},
    {"source_table": "view", "dest_table": "activity", "topic": "activity",
     "remap": {"id": "{id}", "action": "page {event_type}", "amount": "{value}"}},
    {"source_table": "purchase", "dest_table": "purchases"},
    {"source_table": "purchase", "dest_table": "activity",
     "remap": {"id": "{id}", "action": "{event_type}", "amount": "{value}", "weight": 5}},
])

# The destination rows of the rules above, as SQL over the feed.
ACTIVITY_SQL = f"""
    SELECT id,
           CASE source_table WHEN 'view' THEN 'page view' ELSE event_type END AS action,
           value AS amount,
           CASE source_table WHEN 'click' THEN 1 WHEN 'purchase' THEN 5 END AS weight,
           seq + 1 AS ver
    FROM ({FEED_SQL}) WHERE source_table IN ('click', 'view', 'purchase')"""


# Type names that need no running session to be understood.
_TYPES = {"BIGINT": "long", "INT": "integer", "DOUBLE": "double", "STRING": "string",
          "TIMESTAMP_NTZ": "timestamp_ntz"}


def row_type(text: str) -> T.StructType:
    """``name TYPE [NOT NULL], …`` → schema, usable before a session exists."""
    schema = T.StructType()
    for column in text.split(","):
        name, kind, *rest = column.split()
        schema.add(name, _TYPES[kind], not rest)
    return schema


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def as_feed(events: DataFrame) -> DataFrame:
    """Event rows → change rows with the payload flattened."""
    op = (F.when(F.col("event_type") == "signup", "insert")
          .when(F.col("event_type") == "error", "delete").otherwise("update"))
    return events.select(
        F.call_function("div", F.col("event_id"), F.lit(3)).alias("xid"),
        F.col("event_id").alias("seq"), "ts",
        F.col("event_type").alias("source_table"), op.alias("op"),
        F.col("user_id").alias("id"), "event_type", "value", "props",
    )


def feed(spark: SparkSession, sf: str) -> DataFrame:
    return as_feed(table(spark, sf, "events"))


def feed_tables(changes: DataFrame) -> dict[str, DataFrame]:
    """Versioned live rows per mapped source table."""
    from tidemark.operators.changes import live_changes, stamp_version
    live = stamp_version(live_changes(changes)).drop("xid", "ts", "op")
    return {t: live.filter(F.col("source_table") == t).drop("source_table", "seq")
            for t in RULES.distinct_tables()}


# Begin and commit messages frame the operations of each transaction; one in ten
# transactions never commits, one in ten commits at another position, and views are
# messages of an unknown kind.
MESSAGES_SQL = f"""
    SELECT xid, seq * 3 + 1 AS seq, CASE event_type WHEN 'view' THEN 'origin' ELSE op END AS kind,
           xid * 100 AS lsn, CAST(NULL AS BIGINT) AS end_lsn
    FROM ({FEED_SQL})
    UNION ALL
    SELECT xid, min(seq) * 3, 'begin', xid * 100, NULL FROM ({FEED_SQL}) GROUP BY xid
    UNION ALL
    SELECT xid, max(seq) * 3 + 2, 'commit', xid * 100 + CASE xid % 10 WHEN 3 THEN 1 ELSE 0 END,
           xid * 100 + 50
    FROM ({FEED_SQL}) WHERE xid % 10 <> 7 GROUP BY xid"""


def messages(spark: SparkSession, sf: str) -> DataFrame:
    changes = feed(spark, sf)
    lsn, none = F.col("xid") * 100, F.lit(None).cast("long")
    kind = F.when(F.col("event_type") == "view", "origin").otherwise(F.col("op"))
    ops = changes.select("xid", (F.col("seq") * 3 + 1).alias("seq"), kind.alias("kind"),
                         lsn.alias("lsn"), none.alias("end_lsn"))
    ends = changes.groupBy("xid").agg(F.min("seq").alias("first"), F.max("seq").alias("last"))
    begins = ends.select("xid", (F.col("first") * 3).alias("seq"), F.lit("begin").alias("kind"),
                         lsn.alias("lsn"), none.alias("end_lsn"))
    moved = F.when(F.col("xid") % 10 == 3, 1).otherwise(0)
    commits = ends.filter(F.col("xid") % 10 != 7).select(
        "xid", (F.col("last") * 3 + 2).alias("seq"), F.lit("commit").alias("kind"),
        (lsn + moved).alias("lsn"), (lsn + 50).alias("end_lsn"))
    return ops.unionByName(begins).unionByName(commits)


# A log of backfill jobs: one job per user, its events the steps of the job.
JOB_LOG_SQL = """
    SELECT user_id AS job_id, event_id AS event_no, 't' || (user_id % 10) AS source_table,
           CASE WHEN event_id % 97 <> 0 THEN 'd' || (user_id % 10) END AS dest_table,
           CASE event_type WHEN 'signup' THEN 'pending' WHEN 'view' THEN 'running'
                WHEN 'click' THEN 'paused' WHEN 'purchase' THEN 'completed'
                ELSE CASE WHEN event_id % 101 = 0 THEN 'unknown' ELSE 'failed' END END AS status,
           CAST(CASE user_id % 6 WHEN 0 THEN 0 WHEN 1 THEN 1000 WHEN 2 THEN 2000 WHEN 3 THEN 3000
                WHEN 4 THEN 5000 END AS BIGINT) AS total_rows,
           event_id % 5000 AS processed_rows, ts AS inserted_at
    FROM events"""


def job_log(spark: SparkSession, sf: str) -> DataFrame:
    user, event, kind = F.col("user_id"), F.col("event_id"), F.col("event_type")
    failed = F.when(event % 101 == 0, "unknown").otherwise("failed")
    status = (F.when(kind == "signup", "pending").when(kind == "view", "running")
              .when(kind == "click", "paused").when(kind == "purchase", "completed")
              .otherwise(failed))
    total = F.lit(None).cast("long")
    for rest, rows in ((0, 0), (1, 1000), (2, 2000), (3, 3000), (4, 5000)):
        total = F.when(user % 6 == rest, F.lit(rows).cast("long")).otherwise(total)
    number = (user % 10).cast("string")
    return table(spark, sf, "events").select(
        user.alias("job_id"), event.alias("event_no"),
        F.concat(F.lit("t"), number).alias("source_table"),
        F.when(event % 97 != 0, F.concat(F.lit("d"), number)).alias("dest_table"),
        status.alias("status"), total.alias("total_rows"),
        (event % 5000).alias("processed_rows"), F.col("ts").alias("inserted_at"),
    )
