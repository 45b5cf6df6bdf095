"""The append-only log of backfill jobs and its views."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.progress import percent_done
from tidemark.operators.numbering import HOT_ROWS, previous_value
from tidemark.operators.replica import latest_state
from tidemark.sinks import folders

# The field names of a job.
JOB_SCHEMA = T.StructType([
    T.StructField("job_id", T.LongType()),
    T.StructField("event_no", T.LongType()),
    T.StructField("source_table", T.StringType()),
    T.StructField("dest_table", T.StringType()),
    T.StructField("primary_key", T.StringType()),
    T.StructField("ordering_column", T.StringType()),
    T.StructField("total_rows", T.LongType()),
    T.StructField("processed_rows", T.LongType()),
    T.StructField("last_processed_id", T.LongType()),
    T.StructField("cursor", T.StringType()),  # the same position, for columns of any type
    T.StructField("batch_size", T.IntegerType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("inserted_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
])

# Job statuses, those of an unfinished job, and field defaults.
STATUSES = ("pending", "running", "completed", "failed", "paused")
ACTIVE = ("pending", "running", "paused")
JOB_DEFAULTS: dict[str, Any] = {
    "primary_key": "id", "ordering_column": "id", "processed_rows": 0,
    "batch_size": 5000, "status": "pending",
}

# Which statuses may follow which.  Any job may be paused; a paused one runs again only
# after a resume or a new start; a page keeps a running job running.
NEXT = {
    "pending": ("running", "paused"),
    "running": ("running", "completed", "failed", "paused"),
    "paused": ("running", "pending", "paused"),
    "completed": ("paused",),
    "failed": ("paused",),
}


def _event_file(job_id: int | str, event_no: int | str) -> str:
    return f"{job_id}-{event_no}.json"


def append_job_event(spark: SparkSession, log_dir: str, *events: dict[str, Any]) -> None:
    """Add one event, or consecutive ones of a job, as a file of their own; fields not given are null.

    The file is named by job and number of the first event and appears whole, so two writers
    cannot both add an event: who has not read the last one collides with the first.
    """
    rows = ({f.name: event[f.name] for f in JOB_SCHEMA.fields if event.get(f.name) is not None} for event in events)
    lines = [json.dumps(row, default=lambda moment: moment.astimezone(timezone.utc).isoformat()) for row in rows]
    folders.write_new(spark, log_dir, _event_file(events[0]["job_id"], events[0]["event_no"]), "\n".join(lines))


def read_job_log(spark: SparkSession, log_dir: str, job_id: int | None = None) -> DataFrame:
    """The events of all jobs, or of one: then only its files are read."""
    reader = spark.read.schema(JOB_SCHEMA)
    if job_id is not None:
        reader = reader.option("pathGlobFilter", _event_file(job_id, "*"))
    return reader.json(log_dir)


def job_states(log: DataFrame) -> DataFrame:
    """The current row of every job: its last event."""
    return latest_state(log, ["job_id"], ver="event_no", tie=None)


def list_jobs(log: DataFrame, status: str | Sequence[str] | None = None,
              resolved: bool = False) -> DataFrame:
    """Current jobs with one of the statuses, newest first.

    ``resolved`` says that the input has one row per job already.
    """
    jobs = log if resolved else job_states(log)
    if status is not None:
        jobs = jobs.filter(F.col("status").isin([status] if isinstance(status, str) else list(status)))
    return jobs.orderBy(F.col("inserted_at").desc(), F.col("job_id").desc())


def active_jobs(log: DataFrame) -> DataFrame:
    """Per source table its newest unfinished job."""
    unfinished = job_states(log).filter(F.col("status").isin(*ACTIVE))
    return latest_state(unfinished, ["source_table"], ver="inserted_at", tie="job_id")


def audit_transitions(log: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Log events that break a rule: ``job_id, event_no, previous, status, problem``.

    Problems: ``unknown_status``, ``missing_table`` (no source or destination),
    ``bad_start`` (a job must begin as pending) and ``bad_transition``.
    """
    events = log.select("job_id", "event_no", "status", "source_table", "dest_table")
    steps = previous_value(events, "status", "event_no", ["job_id"], hot_rows=hot_rows)
    status, previous = F.col("status"), F.col("previous")
    unknown = status.isNull() | ~status.isin(*STATUSES)
    allowed = F.lit(False)
    for before, after in NEXT.items():
        allowed = allowed | ((previous == before) & status.isin(*after))
    missing = F.col("source_table").isNull() | F.col("dest_table").isNull()
    problem = (
        F.when(unknown, "unknown_status")
        .when(missing, "missing_table")
        .when(previous.isNull() & (status != "pending"), "bad_start")
        .when(previous.isin(*STATUSES) & ~allowed, "bad_transition")
    )
    return steps.withColumn("problem", problem).filter(F.col("problem").isNotNull()) \
        .select("job_id", "event_no", "previous", "status", "problem")


def job_progress(log: DataFrame) -> DataFrame:
    """Current jobs with their progress in percent."""
    return job_states(log).withColumn(
        "progress_percent", percent_done(F.col("processed_rows"), F.col("total_rows")))
