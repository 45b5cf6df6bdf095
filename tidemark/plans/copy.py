"""Resumable backfill of one table, driven by the job log."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Sequence
from collections.abc import Mapping as Dict
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.route import has_script, wire_of, wire_table
from tidemark.plans.backfill import WINDOW_IDS, copy_windows, plan_pages, row_count, start_cursor
from tidemark.plans.joblog import (JOB_DEFAULTS, JOB_SCHEMA, active_jobs, append_job_event,
                                   job_progress, job_states, list_jobs, read_job_log)
from tidemark.plans.keys import find_key_columns
from tidemark.sinks import folders
from tidemark.sinks.staging import Defaults, Keys, LoadedRows, Schemas, clear_stage, drain, stage_wire
from tidemark.sources.mapping import Mapping

# Pages copied between two log entries: a hundred million rows at the default page size.
PAGES_PER_STEP = 20_000
# Steps copied together at most: their borders are constants of one plan.
ROUND_STEPS = 1_024
ROUND_GROWTH = 4
# Reserved name: a row's step within its round.
STEP = "_copy_step"


class BackfillJobs:
    """Starting, pausing, resuming and running backfill jobs over a log folder.

    One driver runs a job at a time; the log is the only state.
    """

    def __init__(self, spark: SparkSession, log_dir: str, mapping: Mapping):
        self.spark, self.log_dir, self.mapping = spark, log_dir, mapping

    def log(self) -> DataFrame:
        return read_job_log(self.spark, self.log_dir)

    def get(self, job_id: int) -> Row | None:
        if not folders.exists(self.spark, self.log_dir):
            return None
        return job_states(read_job_log(self.spark, self.log_dir, job_id)).first()

    def _append(self, event: dict[str, Any]) -> Row:
        """Log one event; it is the job's new state, so nothing is read back."""
        now = datetime.now(timezone.utc)
        event = {"inserted_at": now, **event, "updated_at": now}
        append_job_event(self.spark, self.log_dir, event)
        return Row(**{field.name: event.get(field.name) for field in JOB_SCHEMA.fields})

    def _update(self, job: Row, **changes: Any) -> Row:
        return self._update_all(job, [changes])

    def _update_all(self, job: Row, changes: Iterable[dict[str, Any]]) -> Row:
        """Log one event after another, all at once: the job's state after the last one."""
        now, event, events = datetime.now(timezone.utc), job.asDict(), []
        for change in changes:
            event = {**event, **change, "event_no": event["event_no"] + 1, "updated_at": now}
            events.append(event)
        append_job_event(self.spark, self.log_dir, *events)
        return Row(**{field.name: event.get(field.name) for field in JOB_SCHEMA.fields})

    def _active(self, table: str) -> Row | None:
        if not folders.exists(self.spark, self.log_dir):
            return None
        return active_jobs(self.log()).filter(F.col("source_table") == table).first()

    def _next_id(self) -> int:
        if not folders.exists(self.spark, self.log_dir):
            return 1
        last = self.log().agg(F.max("job_id")).first()[0]
        return (last or 0) + 1

    def start(self, table: str, source: DataFrame, key: str | Sequence[str], *, ordering_column: str | None = None,
              batch_size: int | None = None, estimate: int | None = None) -> Row:
        """A pending job for the table: its paused one, its unfinished one, or a new one.

        Of a key of several columns the first orders the copy; equal values stay together.
        """
        key = [key] if isinstance(key, str) else list(key)
        job = self._active(table)
        if job is not None:
            return self._update(job, status="pending") if job["status"] == "paused" else job
        entries = self.mapping.by_source(table)
        if not entries:
            raise LookupError(
                f"no rule for {table!r}; tables with rules: {self.mapping.distinct_tables()}")
        order = ordering_column or key[0]
        job_id = self._next_id()
        event = {
            **JOB_DEFAULTS, "event_no": 0, "source_table": table,
            "dest_table": entries[0].dest_table, "primary_key": ",".join(key), "ordering_column": order,
            "total_rows": row_count(source, estimate),
            **_position(start_cursor(source.agg(F.max(order)).first()[0])),
            "batch_size": batch_size or JOB_DEFAULTS["batch_size"],
        }
        while True:  # another driver may take the number first
            try:
                return self._append({**event, "job_id": job_id})
            except FileExistsError:
                job_id += 1

    def start_tables(self, sources: Dict[str, tuple[DataFrame, str | Sequence[str]]], **options: Any) -> list[Row]:
        """Jobs for several tables, table → (rows, key); none starts if any table has no rule."""
        known = self.mapping.distinct_tables()
        unknown = [t for t in sources if t not in known]
        if unknown:
            raise LookupError(f"no rule for {unknown}; tables with rules: {known}")
        return [self.start(table, rows, key, **options) for table, (rows, key) in sources.items()]

    def start_all(self, sources: Dict[str, DataFrame], **options: Any) -> list[Row]:
        """Jobs for all mapped tables among the sources; each table's key, of one or more columns, is
        found in its data."""
        wanted = {t: sources[t] for t in self.mapping.distinct_tables() if t in sources}
        found = {t: (rows, find_key_columns(rows)) for t, rows in wanted.items()}
        missing = [t for t, (_, key) in found.items() if key is None]
        if missing:
            raise LookupError(f"no columns are a key of {missing}")
        return self.start_tables(found, **options)

    def jobs(self, status: str | Sequence[str] | None = None) -> DataFrame:
        """Current jobs, newest first, with their progress in percent."""
        return list_jobs(job_progress(self.log()), status, resolved=True)

    def pause(self, job_id: int) -> Row:
        job = self.get(job_id)
        if job is None:
            raise LookupError(f"no job {job_id}")
        return self._update(job, status="paused")

    def resume(self, job_id: int, from_failed: bool = False) -> Row:
        """A paused job runs again; a failed one only when asked for."""
        job = self.get(job_id)
        if job is None:
            raise LookupError(f"no job {job_id}")
        if job["status"] != "paused" and not (from_failed and job["status"] == "failed"):
            raise ValueError(f"job {job_id} is {job['status']}, not paused")
        if job["status"] == "failed":
            job = self._update(job, status="paused", error_message=None)
        return self._update(job, status="running")

    def copy_pages(self, job_id: int, source: DataFrame, replica_dir: str, schemas: Schemas,
                   defaults: Defaults | None = None, max_pages: int | None = None,
                   reject_dir: str | None = None, *, pages_per_step: int = PAGES_PER_STEP,
                   keys: Keys | None = None, views: Iterable[LoadedRows] = ()) -> Row:
        """Copy the next pages of a job, all of them by default, step by step.

        A step copies some pages, is a batch of its own, and has an entry in the log with the new
        cursor and count.  Pages are consecutive value ranges, so that consecutive steps are one
        filtered scan: ``low <= column < cursor`` reaches the source as a pushed filter, and the
        rows of all destinations are staged in that one job, which also counts them by step.  A run
        begins with a round of one step, and each round has ``ROUND_GROWTH`` times the steps of the
        one before, within ``PAGES_PER_STEP`` pages; what stops the run loses a round at most.  A
        round that fails is taken up again from a single step, so that only a step that fails
        alone fails the job, with all steps before it copied and logged.

        Page borders are planned once per job, from the ordering column alone, and kept beside the
        log; the last step has no lower border.  Values equal to ``low`` are copied with it.  A
        retry of a step is the same batch, in whichever round.  A paused, failed or completed job
        reads nothing; a pause meanwhile takes effect after the round.  Rows a rule cannot express,
        or that do not fit, count as processed, and go to ``reject_dir`` with their reason if it is
        given.  A script gets the rows of one step at a time.
        """
        job = self.get(job_id)
        if job is None:
            raise LookupError(f"no job {job_id}")
        single = has_script(self.mapping.by_source(job["source_table"]))
        left, size = max_pages, 1
        while job["status"] in ("pending", "running") and left != 0:
            done = self._copy_round(job, source, 1 if single else size, left, pages_per_step, replica_dir, schemas,
                                    defaults, reject_dir, keys, views)
            if done is None:
                job, size = self.get(job_id), 1
                continue
            job, steps = done
            size = min(ROUND_GROWTH * size, ROUND_STEPS)
            left = None if left is None else max(0, left - steps * pages_per_step)
        return job

    def origin(self, job_id: int) -> str:
        """The name of a job's batches: job ids are unique within a log folder."""
        return f"backfill-{hashlib.sha1(self.log_dir.encode()).hexdigest()[:12]}-{job_id}"

    def _copy_round(self, job: Row, source: DataFrame, size: int, left: int | None, pages_per_step: int,
                    replica_dir: str, schemas: Schemas, defaults: Defaults | None, reject_dir: str | None,
                    keys: Keys | None, views: Iterable[LoadedRows]) -> tuple[Row, int] | None:
        """Up to ``size`` steps: the job's new state and how many there were; none if several failed together."""
        if job["status"] != "running":
            job = self._update(job, status="running")
        col, origin, table = job["ordering_column"], self.origin(job["job_id"]), job["source_table"]
        rest = source.filter(F.col(col).isNotNull())
        if job["cursor"] is not None:
            rest = rest.filter(F.col(col) < _literal(job["cursor"], source, col))
        stage = f"{self.log_dir}/_stage/{job['job_id']}"
        lows: list[Row | None] = [None]
        try:
            lows = self._borders(job, rest, size, left, pages_per_step)
            texts = [low["text"] for low in lows if low is not None]
            if lows[-1] is not None:
                rest = rest.filter(F.col(col) >= _literal(texts[-1], source, col))
            batches = [_step_batch(cursor, low["text"] if low is not None else None)
                       for cursor, low in zip([job["cursor"], *texts], lows)]
            seen = Observation(f"{origin}-{job['processed_rows']}-{job['event_no']}")
            found = [F.count(F.lit(1)).alias("rows"), F.min(col).alias("low"), F.min(col).cast("string").alias("text")]
            clear_stage(self.spark, stage)
            if len(lows) == 1:
                stage_wire(wire_table(rest.observe(seen, *found), table, self.mapping), stage, origin, batches[0])
            else:
                # Room for more values than there are steps: all are tracked, so the counts are exact.
                by_step = F.call_function("approx_top_k", F.col(STEP), F.lit(2 * ROUND_STEPS), F.lit(4 * ROUND_STEPS)).alias("steps")
                staged = _with_step(rest, col, texts).observe(seen, *found, by_step)
                sent = F.inline(wire_of(table, self.mapping.by_source(table), {f.name: f.dataType for f in rest.schema.fields}))
                batch = F.get(_constant(batches, T.LongType()), F.col(STEP))
                stage_wire(staged.select(batch.alias("batch_id"), sent), stage, origin)
            drain(self.spark, stage, replica_dir, schemas, defaults, keys=keys, reject_dir=reject_dir, views=views,
                  report_failure=len(lows) == 1)
        except Exception as error:
            if len(lows) > 1:
                return None
            self._update(job, status="failed", error_message=str(error))
            raise
        done = {"rows": 0, "low": None, "text": None, **seen.get}
        counts = {0: done["rows"]} if len(lows) == 1 else {r["item"]: r["count"] for r in done.get("steps") or ()}
        if sum(counts.values()) != done["rows"]:
            raise RuntimeError(f"rows by step do not make up the {done['rows']} of the round")
        now = self.get(job["job_id"])  # paused meanwhile: keep that, and the progress made
        changes, processed = [], job["processed_rows"]
        for step, low in enumerate(lows):
            processed += counts.get(step, 0)
            status = "paused" if now["status"] == "paused" else "completed" if low is None else "running"
            # The border counts even if its rows are gone: otherwise the job would not move.
            reached = low if low is not None else done if counts.get(step) else {"low": None}
            moved = _position(reached["low"], reached["text"]) if reached["low"] is not None else {}
            changes.append({"status": status, "processed_rows": processed, **moved})
        return self._update_all(now, changes), len(lows)

    def _planned(self, job: Row, rest: DataFrame) -> DataFrame:
        """The job's pages with their least values, planned the first time."""
        path = f"{self.log_dir}/_pages/{job['job_id']}"
        if not folders.exists(self.spark, f"{path}/_SUCCESS"):
            col, key = job["ordering_column"], job["primary_key"]
            pages = plan_pages(rest, col, job["batch_size"], unique=col == key, key=key if key in rest.columns else None)
            pages.select("page", "last_id").write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def _borders(self, job: Row, rest: DataFrame, size: int, left: int | None, pages_per_step: int) -> list[Row | None]:
        """Least values of the next steps, ``size`` at most; none for the step of the last pages."""
        pages = self._planned(job, rest)
        ahead = pages
        if job["cursor"] is not None:
            ahead = pages.filter(F.col("last_id") < _literal(job["cursor"], pages, "last_id"))
        ends = ahead.agg(F.min("page").alias("first"), F.max("page").alias("last")).first()
        first, last, lows = ends["first"], ends["last"], []
        least = pages_per_step if left is None else min(left, pages_per_step)
        if first is None or first + least > last:
            return [None]
        # The last pages of the steps, one by one only where pages end at equal values.
        reach = max(least, min(size * pages_per_step, PAGES_PER_STEP, left or PAGES_PER_STEP))
        one = F.col("page") == first + least - 1
        wanted = one if reach == least else F.col("page").between(first, first + reach)
        found = pages.filter(wanted).select("page", F.col("last_id").alias("low"), F.col("last_id").cast("string").alias("text"))
        by_page = {r["page"]: r for r in found.toLocalIterator()}
        at = first
        while len(lows) < size and left != 0:
            count = pages_per_step if left is None else min(left, pages_per_step)
            if at + count > last:
                return [*lows, None]
            low = by_page.get(at + count - 1)
            if low is None:
                break
            lows.append(low)
            left = None if left is None else left - count
            at += count
            while at in by_page and by_page[at]["text"] == low["text"]:
                at += 1
        return lows


def _with_step(rows: DataFrame, col: str, lows: Sequence[str]) -> DataFrame:
    """The rows with the number of their step: how many of the falling borders lie above the value.

    A search by halves in the rising borders, each half a column of compiled code.
    """
    dtype, n = rows.schema[col].dataType, len(lows)
    borders = _constant(lows[::-1], dtype)
    rows = rows.withColumn(STEP, F.lit(0))
    for bit in reversed(range(n.bit_length())):
        here = F.get(borders, F.col(STEP) + (2 ** bit - 1))
        rows = rows.withColumn(STEP, F.col(STEP) + F.when(here <= F.col(col), 2 ** bit).otherwise(0))
    return rows.withColumn(STEP, F.lit(n) - F.col(STEP))


def _constant(values: Sequence[Any], dtype: T.DataType) -> Column:
    """A list as one constant, its elements read from text as ``_literal`` does."""
    return F.from_json(F.lit(json.dumps([str(v) for v in values])), "array<string>").cast(T.ArrayType(dtype))


def _position(value: Any, text: str | None = None) -> dict[str, Any]:
    is_integer = isinstance(value, int) and not isinstance(value, bool)
    return {
        "last_processed_id": value if is_integer else None,
        "cursor": text if text is not None or value is None else str(value),
    }


def _literal(text: str, source: DataFrame, col: str) -> Column:
    return F.lit(text).cast(source.schema[col].dataType)


def _step_batch(cursor: str | None, low: str | None) -> int:
    """Batch id of a step: the same for the same range of values, so a repeated step is a known
    batch, and another for any other range."""
    return int.from_bytes(hashlib.sha1(repr((cursor, low)).encode()).digest()[:7])


def copy_by_windows(source: DataFrame, table: str, key: str, mapping: Mapping, *, origin: str, stage_dir: str,
                    replica_dir: str, schemas: Schemas, batch: int = WINDOW_IDS, changes: DataFrame | None = None,
                    change_key: str | None = None, defaults: Defaults | None = None, keys: Keys | None = None,
                    reject_dir: str | None = None, views: Iterable[LoadedRows] = ()) -> dict[str, int]:
    """Copy a table through all its rules by id windows, each window a batch of ``origin``.

    Keys that ``changes`` has touched are left to the live path.  Returns the batches loaded
    per destination.
    """
    rows = copy_windows(source, key, batch, changes, change_key)
    types = {f.name: f.dataType for f in source.schema.fields}
    sent = F.inline(wire_of(table, mapping.by_source(table), types))
    stage_wire(rows.select(F.col("window").alias("batch_id"), sent), stage_dir, origin)
    return drain(source.sparkSession, stage_dir, replica_dir, schemas, defaults, keys=keys, reject_dir=reject_dir,
                 views=views)
