"""Staged loads, holds, views and streams: S8, K1, K2, M and stream queries.

These write below the shared folder first and read back what the operators stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalogue.registry import query
from tidemark.catalogue.tables import (ACTIVITY_SQL, EVENTS_SCHEMA, FEED_SQL, RULES, as_feed, feed,
                                       feed_tables, row_type)
from tidemark.operators.batches import assign_batches
from tidemark.operators.changes import live_changes, stamp_version
from tidemark.operators.rate import with_commit_time
from tidemark.operators.replica import latest_state
from tidemark.operators.route import route, wire_table
from tidemark.plans.copy import BackfillJobs
from tidemark.session import scratch_path
from tidemark.sinks import loads
from tidemark.sinks.staging import (HoldGate, compact, current_rows, drain, load_batch, loaded_report, read_replica,
                                    read_staged, read_staged_files, stage_batch, stage_wire, staged_batches,
                                    write_replica)
from tidemark.sinks.views import IncrementalView, build_view, materialize
from tidemark.sources.feed import decode_envelope, read_changes
from tidemark.sources.mapping import Mapping
from tidemark.streaming.rate import store_commit_times, stored_event_rate
from tidemark.streaming.replicate import append_versions, replicate

NUMBERS = ("load_origin", "load_batch", "load_no")
SCHEMAS = {
    "accounts": row_type(
        "id BIGINT NOT NULL, origin STRING, label STRING, score DOUBLE, ver BIGINT NOT NULL"),
    "activity": row_type(
        "id BIGINT NOT NULL, action STRING, amount DOUBLE, weight INT, ver BIGINT NOT NULL"),
    "purchases": row_type(
        "id BIGINT NOT NULL, event_type STRING, value DOUBLE, props STRING, ver BIGINT NOT NULL"),
}
DEFAULTS = {"activity": {"weight": 0}}

LOADED_SQL = f"""
    SELECT id, action, amount, coalesce(weight, 0) AS weight, ver FROM ({ACTIVITY_SQL})"""


def _routed(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return route(feed_tables(feed(spark, sf)), RULES)


def _batched(rows: DataFrame) -> DataFrame:
    return assign_batches(rows, size=1000, order="ver", group=())


@query("k1_staged", f"""
    SELECT CAST(id AS VARCHAR) AS id, action, CAST(amount AS VARCHAR) AS amount,
           CAST(weight AS VARCHAR) AS weight, CAST(ver AS VARCHAR) AS ver,
           (row_number() OVER (ORDER BY ver) - 1) // 1000 AS batch_id
    FROM ({ACTIVITY_SQL})""")
def k1_staged(spark: SparkSession, sf: str) -> DataFrame:
    stage = scratch_path(spark, "stage")
    stage_batch({"activity": _batched(_routed(spark, sf)["activity"])}, stage, "feed")
    return read_staged(spark, stage, "activity", SCHEMAS["activity"]) \
        .withColumnRenamed("load_batch", "batch_id").drop("load_origin")


@query("s8_staged_batches", f"""
    SELECT dest_table, batch_id, count(*) AS rows FROM (
        SELECT 'activity' AS dest_table, (row_number() OVER (ORDER BY ver) - 1) // 1000 AS batch_id
        FROM ({ACTIVITY_SQL})
        UNION ALL
        SELECT 'accounts', (row_number() OVER (ORDER BY seq) - 1) // 1000
        FROM ({FEED_SQL}) WHERE source_table = 'signup') GROUP BY ALL""")
def s8_staged_batches(spark: SparkSession, sf: str) -> DataFrame:
    stage = scratch_path(spark, "stage")
    routed = _routed(spark, sf)
    stage_batch({d: _batched(routed[d]) for d in ("activity", "accounts")}, stage, "feed")
    parts = [read_staged(spark, stage, dest, SCHEMAS[dest], ids).groupBy(F.col("load_batch").alias("batch_id"))
             .agg(F.count(F.lit(1)).alias("rows")).select(F.lit(dest).alias("dest_table"), "*")
             for dest, ids in staged_batches(spark, stage).items()]
    return parts[0].unionByName(parts[1])


@query("s8_flat_files", f"""
    SELECT printf('%04d', (row_number() OVER (PARTITION BY source_table ORDER BY seq) - 1) // 1000) AS staged_at,
           'shop_' || source_table AS dest_table, CAST(id AS VARCHAR) AS id, event_type FROM ({FEED_SQL})""")
def s8_flat_files(spark: SparkSession, sf: str) -> DataFrame:
    """Files named by time and table, each a JSON list of at most 1,000 rows."""
    folder = scratch_path(spark, "flat")
    rows = assign_batches(feed(spark, sf), size=1000, group=("source_table",)).select(
        F.format_string("%04d_shop_%s", "batch_id", "source_table").alias("file"),
        F.struct(F.col("id").cast("string").alias("id"), "event_type").alias("row"))
    lists = rows.groupBy("file").agg(F.to_json(F.collect_list("row")).alias("value"))
    lists.repartition("file").write.partitionBy("file").text(f"{folder}/lists")
    from tidemark.sinks import folders
    for name in folders.partitions(spark, f"{folder}/lists", "file"):
        part = next(n for n in folders.names(spark, f"{folder}/lists/file={name}") if n.startswith("part-"))
        folders.rename(spark, f"{folder}/lists/file={name}/{part}", f"{folder}/{name}.json")
    return read_staged_files(spark, f"{folder}/*.json", "id STRING, event_type STRING")


@query("k2_load", LOADED_SQL)
def k2_load(spark: SparkSession, sf: str) -> DataFrame:
    """Batches loaded, then two of them staged and loaded again: the same rows."""
    folder = scratch_path(spark, "load")
    stage, replica = f"{folder}/stage", f"{folder}/replica"
    rows = _batched(_routed(spark, sf)["activity"])
    stage_batch({"activity": rows}, stage, "feed")
    load_batch(spark, stage, replica, "activity", SCHEMAS["activity"],
               staged_batches(spark, stage)["activity"], DEFAULTS["activity"])
    stage_batch({"activity": rows.filter("batch_id < 2")}, stage, "feed")
    drain(spark, stage, replica, SCHEMAS, DEFAULTS)
    return read_replica(spark, replica, "activity", SCHEMAS["activity"]).drop(*NUMBERS)


@query("k2_second_slice", LOADED_SQL)
def k2_second_slice(spark: SparkSession, sf: str) -> DataFrame:
    """Two slices of a feed staged with the same batch ids under their own origins: no row is lost."""
    folder = scratch_path(spark, "slices")
    stage, replica = f"{folder}/stage", f"{folder}/replica"
    rows = _routed(spark, sf)["activity"]
    for name, part in (("first", F.col("ver") % 2 == 0), ("second", F.col("ver") % 2 == 1)):
        stage_batch({"activity": _batched(rows.filter(part))}, stage, name)
        drain(spark, stage, replica, SCHEMAS, DEFAULTS)
    return read_replica(spark, replica, "activity", SCHEMAS["activity"]).drop(*NUMBERS)


_BATCHES_SQL = f"""
    SELECT 'activity' AS dest_table, 'feed' AS origin, id, ver,
           (row_number() OVER (ORDER BY ver) - 1) // 1000 AS batch_id FROM ({ACTIVITY_SQL})"""


@query("k4_written_report", f"""
    SELECT dest_table, origin AS load_origin, batch_id AS load_batch, CAST(0 AS BIGINT) AS load_no, count(*) AS rows, arg_min(id, ver) AS first_id,
           (SELECT count(*) FROM ({ACTIVITY_SQL})) AS load_rows
    FROM ({_BATCHES_SQL}) GROUP BY dest_table, origin, batch_id""")
def k4_written_report(spark: SparkSession, sf: str) -> DataFrame:
    """What a load wrote about itself: rows and first id per batch, and the load's entry."""
    folder = scratch_path(spark, "report")
    stage_batch({"activity": _batched(_routed(spark, sf)["activity"])}, f"{folder}/stage", "feed")
    drain(spark, f"{folder}/stage", f"{folder}/replica", SCHEMAS, DEFAULTS)
    entry = loads.entries(spark, f"{folder}/replica", "activity").select("load_no", F.col("rows").alias("load_rows"))
    return loaded_report(spark, f"{folder}/replica", "activity", SCHEMAS["activity"]).join(entry, "load_no")


# Rows with a value that does not parse, rows without a key, and a rule that fits no null text.
BAD_RULES = Mapping.from_dicts([
    {"source_table": "click", "dest_table": "activity",
     "remap": {"id": "{id}", "action": "{event_type}", "amount": "{amount}"}},
    {"source_table": "view", "dest_table": "activity",
     "remap": {"id": "{id}", "action": "page {props}", "amount": "{amount}"}}])
KEYS = {"activity": ("id",)}
BAD_SQL = f"""
    SELECT source_table, seq, CASE WHEN seq % 11 <> 0 THEN id END AS id, event_type,
           CASE WHEN seq % 13 = 0 THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS amount,
           CASE WHEN seq % 7 <> 0 THEN props END AS props, op
    FROM ({FEED_SQL}) WHERE source_table IN ('click', 'view')"""
REJECTS_SQL = f"""
    SELECT reject_reason, count(*) AS rows FROM (
        SELECT CASE WHEN source_table = 'view' AND props IS NULL THEN 'action: props is null'
                    WHEN id IS NULL AND amount = 'n/a' THEN 'does not fit: id, amount'
                    WHEN id IS NULL THEN 'does not fit: id'
                    WHEN amount = 'n/a' THEN 'does not fit: amount' END AS reject_reason
        FROM ({BAD_SQL}) WHERE op <> 'delete') WHERE reject_reason IS NOT NULL GROUP BY 1
    UNION ALL
    SELECT 'loaded', count(*) FROM ({BAD_SQL})
    WHERE op <> 'delete' AND id IS NOT NULL AND amount <> 'n/a' AND (source_table = 'click' OR props IS NOT NULL)"""


def _bad_rows(changes: DataFrame) -> DataFrame:
    """The rows of ``BAD_SQL`` with their feed columns."""
    return changes.filter(F.col("source_table").isin("click", "view")).select(
        "xid", "seq", "op", "source_table", F.when(F.col("seq") % 11 != 0, F.col("id")).alias("id"), "event_type",
        F.when(F.col("seq") % 13 == 0, "n/a").otherwise(F.col("value").cast("string")).alias("amount"),
        F.when(F.col("seq") % 7 != 0, F.col("props")).alias("props"))


def _outcome(spark: SparkSession, folder: str) -> DataFrame:
    """Rejected rows by reason, and how many were loaded."""
    loaded = read_replica(spark, f"{folder}/replica", "activity", SCHEMAS["activity"])
    return spark.read.json(f"{folder}/rejects").groupBy("reject_reason").agg(F.count(F.lit(1)).alias("rows")) \
        .unionByName(loaded.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("loaded").alias("reject_reason"), "rows"))


@query("drain_rejects", REJECTS_SQL)
def drain_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Staged rows that do not fit go aside with their reason; the rest of the batch loads."""
    folder = scratch_path(spark, "rejects")
    rows = stamp_version(live_changes(_bad_rows(feed(spark, sf))))
    wire = [wire_table(rows.filter(F.col("source_table") == t).select("id", "event_type", "amount", "props", "ver"),
                       t, BAD_RULES) for t in BAD_RULES.distinct_tables()]
    stage_wire(wire[0].unionByName(wire[1]), f"{folder}/stage", "feed", 0)
    drain(spark, f"{folder}/stage", f"{folder}/replica", SCHEMAS, DEFAULTS, keys=KEYS, reject_dir=f"{folder}/rejects")
    return _outcome(spark, folder)


@query("stream_rejects", REJECTS_SQL + f"""
    UNION ALL SELECT 'change cannot be read', count(*) FROM ({BAD_SQL}) WHERE seq % 17 = 0
    UNION ALL SELECT 'payload does not have the table''s types', count(*) FROM ({BAD_SQL}) WHERE seq % 19 = 0""")
def stream_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """The same through the stream, with lines that are no change and payloads of wrong types among them."""
    folder = scratch_path(spark, "rejects")
    rows = _bad_rows(feed(spark, sf))
    code = F.when(F.col("op") == "insert", "c").when(F.col("op") == "delete", "d").otherwise("u")

    def envelope(record, operation):
        source = F.struct(F.col("source_table").alias("table"), F.col("xid").alias("txId"), F.col("seq").alias("lsn"))
        return F.to_json(F.struct(record.alias("after"), source.alias("source"), operation.alias("op")))

    wrong = F.struct(F.lit("abc").alias("id"), "event_type")
    lines = rows.select(envelope(F.struct("id", "event_type", "amount", "props"), code).alias("value")) \
        .unionByName(rows.filter("seq % 17 = 0").select(F.concat(F.lit("not json "), "seq").alias("value"))) \
        .unionByName(rows.filter("seq % 19 = 0").select(envelope(wrong, F.lit("u")).alias("value")))
    lines.write.text(f"{folder}/feed")
    stream = decode_envelope(read_changes(spark, f"{folder}/feed", "value STRING", fmt="text", streaming=True))
    record = row_type("id BIGINT, event_type STRING, amount STRING, props STRING")
    replicate(stream, BAD_RULES, SCHEMAS, origin="feed", checkpoint_dir=f"{folder}/checkpoint", replica_dir=f"{folder}/replica",
              stage_dir=f"{folder}/stage", reject_dir=f"{folder}/rejects", keys=KEYS, defaults=DEFAULTS,
              record_schemas={t: record for t in BAD_RULES.distinct_tables()}, available_now=True).awaitTermination()
    return _outcome(spark, folder)


@query("backfill_rejects", f"""
    SELECT * FROM ({REJECTS_SQL.replace("WHERE op <> 'delete') WHERE", "WHERE source_table = 'view') WHERE")
                               .replace("WHERE op <> 'delete' AND", "WHERE source_table = 'view' AND")})""")
def backfill_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """A backfill whose rows do not all fit: the job completes, the misfits are kept."""
    folder = scratch_path(spark, "rejects")
    rows = _bad_rows(feed(spark, sf)).filter("source_table = 'view'").drop("source_table", "op", "xid")
    jobs = BackfillJobs(spark, f"{folder}/log", BAD_RULES)
    job = jobs.start("view", rows, "seq", batch_size=500)
    jobs.copy_pages(job["job_id"], rows, f"{folder}/replica", SCHEMAS, DEFAULTS, reject_dir=f"{folder}/rejects",
                    pages_per_step=2, keys=KEYS)
    return _outcome(spark, folder)


@query("m1_view", f"""
    SELECT event_type, count(*) AS events, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
    FROM ({FEED_SQL}) GROUP BY 1""")
def m1_view(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_path(spark, "view")
    return materialize(
        spark, "event_totals",
        "SELECT event_type, count(*) AS events, sum(CAST(round(value * 100) AS BIGINT)) AS cents "
        "FROM {changes} GROUP BY event_type",
        [f"{folder}/main", f"{folder}/copy"], changes=feed(spark, sf))


@query("m1_incremental_view", f"""
    SELECT event_type, count(*) AS events, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents,
           min(seq) AS first_seq, max(seq) AS last_seq FROM ({FEED_SQL}) GROUP BY 1""")
def m1_incremental_view(spark: SparkSession, sf: str) -> DataFrame:
    """A view fed by the loads of a table, merged once between them."""
    folder = scratch_path(spark, "partials")
    changes = feed(spark, sf).select("event_type", "seq", F.round(F.col("value") * 100).cast("long").alias("cents"), "op")
    view = IncrementalView("changes", ("event_type",), {
        "events": ("count", F.lit(1)), "cents": ("sum", "cents"), "first_seq": ("min", "seq"), "last_seq": ("max", "seq")},
        f"{folder}/view", f"{folder}/replica")
    for batch, part in enumerate((F.col("op") == "update", F.col("op") == "insert", F.col("op") == "delete")):
        write_replica(changes.filter(part), f"{folder}/replica", "changes", "feed", batch, [view])
        if batch == 1:
            view.merge(spark)
    return view.read(spark)


@query("m2_held", f"""
    SELECT 'loaded' AS state, 'accounts' AS dest_table, count(*) AS rows FROM ({FEED_SQL})
    WHERE source_table = 'signup' AND op <> 'delete'
    UNION ALL SELECT 'staged', 'activity', count(*) FROM ({ACTIVITY_SQL})
    UNION ALL SELECT 'loaded later', 'activity', count(*) FROM ({ACTIVITY_SQL})
    UNION ALL SELECT 'loaded', 'purchases', count(*) FROM ({FEED_SQL}) WHERE source_table = 'purchase' AND op <> 'delete'""")
def m2_held(spark: SparkSession, sf: str) -> DataFrame:
    """Three destinations staged, one of them held by two: it waits until both have let go."""
    folder = scratch_path(spark, "held")
    stage, replica = f"{folder}/stage", f"{folder}/replica"
    gate = HoldGate(spark, f"{folder}/holds")
    stage_batch({d: _batched(rows) for d, rows in _routed(spark, sf).items()}, stage, "feed")
    for holder in ("one", "two"):
        gate.hold("activity", holder)
    gate.release("activity", "one")
    drain(spark, stage, replica, SCHEMAS, DEFAULTS, held=gate.held())

    def counted(rows: DataFrame, state: str, dest: str) -> DataFrame:
        return rows.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(state).alias("state"), F.lit(dest).alias("dest_table"), "rows")

    kept = read_staged(spark, stage, "activity", SCHEMAS["activity"]).select("id").persist()
    waiting = kept.count()
    kept.unpersist()
    found = [counted(read_replica(spark, replica, d, SCHEMAS[d]), "loaded", d) for d in ("accounts", "purchases")]
    gate.release("activity", "two")
    drain(spark, stage, replica, SCHEMAS, DEFAULTS, held=gate.held())
    found.append(counted(read_replica(spark, replica, "activity", SCHEMAS["activity"]), "loaded later", "activity"))
    found.append(spark.createDataFrame([("staged", "activity", waiting)], "state STRING, dest_table STRING, rows LONG"))
    return found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3])


@query("m3_drain", f"""
    SELECT id, action, amount, weight, ver FROM ({LOADED_SQL})
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY ver DESC) = 1""")
def m3_drain(spark: SparkSession, sf: str) -> DataFrame:
    """Batches wait in the stage while a view is built, and are loaded when it is there."""
    folder = scratch_path(spark, "drain")
    stage, replica = f"{folder}/stage", f"{folder}/replica"
    stage_batch({"activity": _batched(_routed(spark, sf)["activity"])}, stage, "feed")
    build_view(spark, "daily", "SELECT event_type, count(*) AS n FROM {changes} GROUP BY event_type",
               [f"{folder}/view"], table="activity", gate=HoldGate(spark, f"{folder}/holds"),
               stage_dir=stage, replica_dir=replica, schemas=SCHEMAS, defaults=DEFAULTS,
               changes=feed(spark, sf))
    return current_rows(spark, replica, "activity", SCHEMAS["activity"], ["id"])


_FOLLOWING_SQL = f"""
    SELECT action, count(*) AS n, max(ver) AS last_ver, CAST(sum(CAST(round(amount * 100) AS BIGINT)) AS BIGINT) AS cents
    FROM ({LOADED_SQL}) GROUP BY 1"""


def _action_view(folder: str) -> IncrementalView:
    return IncrementalView("activity", ("action",), {
        "n": ("count", F.lit(1)), "last_ver": ("max", "ver"),
        "cents": ("sum", F.round(F.col("amount") * 100).cast("long"))}, f"{folder}/view", f"{folder}/replica")


@query("m1_view_after_drain", _FOLLOWING_SQL)
def m1_view_after_drain(spark: SparkSession, sf: str) -> DataFrame:
    """A view over the loads: built from what was loaded, fed by what waited and by a later stream."""
    folder = scratch_path(spark, "following")
    stage, replica = f"{folder}/stage", f"{folder}/replica"
    rows = _batched(_routed(spark, sf)["activity"])
    gate = HoldGate(spark, f"{folder}/holds")
    view = _action_view(folder)
    stage_batch({"activity": rows.filter("batch_id % 3 = 0")}, stage, "feed")
    drain(spark, stage, replica, SCHEMAS, DEFAULTS)
    gate.hold("activity", "query")
    stage_batch({"activity": rows.filter("batch_id % 3 = 1")}, stage, "feed")
    drain(spark, stage, replica, SCHEMAS, DEFAULTS, held=gate.held(), views=[view])
    view.build(spark, SCHEMAS["activity"], gate)
    gate.release("activity", "query")
    drain(spark, stage, replica, SCHEMAS, DEFAULTS, held=gate.held(), views=[view])
    compact(spark, replica, "activity", SCHEMAS["activity"], ["id"])
    stage_batch({"activity": rows.filter("batch_id % 3 = 2")}, stage, "feed")
    drain(spark, stage, replica, SCHEMAS, DEFAULTS, views=[view])
    return view.read(spark)


@query("m1_view_compacted", _FOLLOWING_SQL)
def m1_view_compacted(spark: SparkSession, sf: str) -> DataFrame:
    """A view that follows loads through three compactions, two merges and replayed batches."""
    folder = scratch_path(spark, "following")
    stage, replica, view = f"{folder}/stage", f"{folder}/replica", _action_view(folder)
    rows = _batched(_routed(spark, sf)["activity"])
    for part in range(4):
        # Each time an earlier part comes again with the next one.
        stage_batch({"activity": rows.filter(F.col("batch_id") % 4 <= part)}, stage, "feed")
        drain(spark, stage, replica, SCHEMAS, DEFAULTS, views=[view])
        if part < 3:
            compact(spark, replica, "activity", SCHEMAS["activity"], ["id"])
        if part > 0:
            view.merge(spark)
    return view.read(spark)


@query("m3_two_drains", f"""
    SELECT 'replica' AS place, action, count(*) AS n, max(ver) AS last_ver FROM ({LOADED_SQL}) GROUP BY action
    UNION ALL SELECT 'view', action, count(*), max(ver) FROM ({LOADED_SQL}) GROUP BY action""")
def m3_two_drains(spark: SparkSession, sf: str) -> DataFrame:
    """A stage drained while another drain of it has read the entries but not yet committed."""
    folder = scratch_path(spark, "drains")
    stage, replica, view = f"{folder}/stage", f"{folder}/replica", _action_view(folder)
    rows = _batched(_routed(spark, sf)["activity"])

    class Meanwhile:
        """Stands for the other drain: it runs between this one's rows and its commit."""
        table = "activity"

        def add(self, loaded: DataFrame, load: str) -> None:
            if not done:
                done.append(load)
                drain(spark, stage, replica, SCHEMAS, DEFAULTS, views=[view])

        def drop(self, session: SparkSession, load: str) -> None:
            pass

    done: list[str] = []
    stage_batch({"activity": rows.filter("batch_id % 3 = 0")}, stage, "feed")
    stage_batch({"activity": rows.filter("batch_id % 3 = 1")}, stage, "other")
    staged = staged_batches(spark, stage)["activity"]
    drain(spark, stage, replica, SCHEMAS, DEFAULTS, views=[view, Meanwhile()])
    # And one that holds a batch more than the other: that one is loaded, the rest is not loaded twice.
    done.clear()
    stage_batch({"activity": rows.filter("batch_id % 3 <> 1")}, stage, "feed")
    drain(spark, stage, replica, SCHEMAS, DEFAULTS, views=[view, Meanwhile()])
    assert staged and not staged_batches(spark, stage)
    seen = read_replica(spark, replica, "activity", SCHEMAS["activity"]).groupBy("action") \
        .agg(F.count(F.lit(1)).alias("n"), F.max("ver").alias("last_ver")).select(F.lit("replica").alias("place"), "*")
    return seen.unionByName(view.read(spark).drop("cents").select(F.lit("view").alias("place"), "*"))


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events table as a stream of change rows with the payload as a struct."""
    events = read_changes(spark, sf, EVENTS_SCHEMA, streaming=True, glob="events.parquet")
    return as_feed(events).select("xid", "seq", "op", "source_table", F.col("ts").alias("commit_ts"),
                                  F.struct("id", "event_type", "value", "props").alias("record"))


# What the rules send to each of the three destinations, in common columns.
ALL_SQL = f"""
    SELECT 'accounts' AS dest_table, id, 'kind:' || event_type AS label, value, seq + 1 AS ver
    FROM ({FEED_SQL}) WHERE source_table = 'signup' AND op <> 'delete'
    UNION ALL SELECT 'activity', id, action, amount, ver FROM ({LOADED_SQL})
    UNION ALL SELECT 'purchases', id, event_type, value, seq + 1 FROM ({FEED_SQL})
    WHERE source_table = 'purchase' AND op <> 'delete'"""
COMMON = {"accounts": ("label", "score"), "activity": ("action", "amount"), "purchases": ("event_type", "value")}


def _all_loaded(spark: SparkSession, replica: str) -> DataFrame:
    parts = [read_replica(spark, replica, dest, SCHEMAS[dest]).select(
        F.lit(dest).alias("dest_table"), "id", F.col(label).alias("label"), F.col(value).alias("value"), "ver")
        for dest, (label, value) in COMMON.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("stream_replicate", ALL_SQL)
def stream_replicate(spark: SparkSession, sf: str) -> DataFrame:
    """The live path to three destinations, one of them held and drained at the end."""
    folder = scratch_path(spark, "live")
    dirs = {"replica_dir": f"{folder}/replica", "stage_dir": f"{folder}/stage"}
    replicate(event_stream(spark, sf), RULES, SCHEMAS, origin="events", checkpoint_dir=f"{folder}/checkpoint",
              held=lambda: {"activity"}, defaults=DEFAULTS, available_now=True, **dirs).awaitTermination()
    drain(spark, schemas=SCHEMAS, defaults=DEFAULTS, **dirs)
    return _all_loaded(spark, dirs["replica_dir"])


@query("stream_two_origins", ALL_SQL)
def stream_two_origins(spark: SparkSession, sf: str) -> DataFrame:
    """Two streams with checkpoints of their own into the same destinations: no batch hides another."""
    folder = scratch_path(spark, "live")
    for name, part in (("even", F.col("seq") % 2 == 0), ("odd", F.col("seq") % 2 == 1)):
        replicate(event_stream(spark, sf).filter(part), RULES, SCHEMAS, origin=name, defaults=DEFAULTS,
                  checkpoint_dir=f"{folder}/checkpoint-{name}", replica_dir=f"{folder}/replica",
                  stage_dir=f"{folder}/stage", available_now=True).awaitTermination()
    return _all_loaded(spark, f"{folder}/replica")


@query("stream_replay_after_compact", f"""
    SELECT * FROM ({ALL_SQL}) QUALIFY row_number() OVER (PARTITION BY dest_table, id ORDER BY ver DESC) = 1""")
def stream_replay_after_compact(spark: SparkSession, sf: str) -> DataFrame:
    """A stream is compacted, replayed from its start under its own name, and goes on: the state is whole."""
    folder = scratch_path(spark, "live")
    dirs = {"replica_dir": f"{folder}/replica", "stage_dir": f"{folder}/stage"}
    changes = as_feed(spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf}/events.parquet")).select(
        "xid", "seq", "op", "source_table", F.col("ts").alias("commit_ts"), F.struct("id", "event_type", "value", "props").alias("record"))

    def run(checkpoint: str) -> None:
        stream = read_changes(spark, f"{folder}/feed", changes.schema, streaming=True)
        replicate(stream, RULES, SCHEMAS, origin="events", checkpoint_dir=f"{folder}/{checkpoint}", defaults=DEFAULTS,
                  available_now=True, **dirs).awaitTermination()

    changes.filter("seq % 4 <> 0").write.parquet(f"{folder}/feed")
    run("checkpoint")
    for dest in SCHEMAS:
        compact(spark, dirs["replica_dir"], dest, SCHEMAS[dest], ["id"])
    run("checkpoint-lost")
    changes.filter("seq % 4 = 0").write.mode("append").parquet(f"{folder}/feed")
    run("checkpoint")
    parts = [current_rows(spark, dirs["replica_dir"], dest, SCHEMAS[dest], ["id"]).select(
        F.lit(dest).alias("dest_table"), "id", F.col(label).alias("label"), F.col(value).alias("value"), "ver")
        for dest, (label, value) in COMMON.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("stream_latest_state", f"""
    SELECT id, event_type, value, props, ver FROM (SELECT *, seq + 1 AS ver FROM ({FEED_SQL}))
    WHERE event_type = 'purchase'
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY ver DESC) = 1""")
def stream_latest_state(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_path(spark, "live")
    replicate(event_stream(spark, sf), RULES, SCHEMAS, origin="events", checkpoint_dir=f"{folder}/checkpoint",
              replica_dir=f"{folder}/replica", stage_dir=f"{folder}/stage", available_now=True) \
        .awaitTermination()
    return current_rows(spark, f"{folder}/replica", "purchases", SCHEMAS["purchases"], ["id"])


# Purchases, and deletes ('error' rows) of the same ids as tombstones.
TOMB_RULES = Mapping.from_dicts([{"source_table": "purchase", "dest_table": "orders"},
                                 {"source_table": "error", "dest_table": "orders"}])
TOMB_SCHEMA = {"orders": row_type("id BIGINT NOT NULL, value DOUBLE, deleted_at TIMESTAMP_NTZ, ver BIGINT NOT NULL")}


@query("stream_current", f"""
    SELECT id, value, ver FROM (
        SELECT id, value, seq + 1 AS ver, op FROM ({FEED_SQL}) WHERE source_table IN ('purchase', 'error')
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1) WHERE op <> 'delete'""")
def stream_current(spark: SparkSession, sf: str) -> DataFrame:
    """Deletes travel through the stream as tombstones; the current rows leave deleted keys out."""
    folder = scratch_path(spark, "live")
    replicate(event_stream(spark, sf), TOMB_RULES, TOMB_SCHEMA, origin="events", checkpoint_dir=f"{folder}/checkpoint",
              replica_dir=f"{folder}/replica", stage_dir=f"{folder}/stage", tombstones={"error": "orders"},
              available_now=True).awaitTermination()
    return current_rows(spark, f"{folder}/replica", "orders", TOMB_SCHEMA["orders"], ["id"], deleted="deleted_at") \
        .drop("deleted_at")


@query("stream_versions", f"SELECT id, value, seq + 1 AS ver FROM ({FEED_SQL}) WHERE op <> 'delete'")
def stream_versions(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_path(spark, "versions")
    events = read_changes(spark, sf, EVENTS_SCHEMA, streaming=True, glob="events.parquet")
    rows = stamp_version(live_changes(as_feed(events))).select("id", "value", "ver")
    append_versions(rows, f"{folder}/rows", f"{folder}/checkpoint", available_now=True).awaitTermination()
    return spark.read.schema("id BIGINT, value DOUBLE, ver BIGINT").parquet(f"{folder}/rows")


@query("stream_envelopes", ALL_SQL)
def stream_envelopes(spark: SparkSession, sf: str) -> DataFrame:
    """Change envelopes as landed JSON lines: decoded, parsed per table and replicated."""
    folder = scratch_path(spark, "envelopes")
    code = F.when(F.col("op") == "insert", "c").when(F.col("op") == "delete", "d").otherwise("u")
    row = F.struct("id", "event_type", "value", "props")
    source = F.struct(F.col("source_table").alias("table"), F.col("xid").alias("txId"), F.col("seq").alias("lsn"))
    gone = F.col("op") == "delete"
    feed(spark, sf).select(F.to_json(F.struct(
        F.when(gone, row).alias("before"), F.when(~gone, row).alias("after"),
        source.alias("source"), code.alias("op"))).alias("value")).write.text(f"{folder}/feed")
    stream = decode_envelope(read_changes(spark, f"{folder}/feed", "value STRING", fmt="text", streaming=True))
    record = row_type("id BIGINT, event_type STRING, value DOUBLE, props STRING")
    replicate(stream, RULES, SCHEMAS, origin="envelopes", checkpoint_dir=f"{folder}/checkpoint", defaults=DEFAULTS,
              replica_dir=f"{folder}/replica", stage_dir=f"{folder}/stage", available_now=True,
              record_schemas={t: record for t in RULES.distinct_tables()}).awaitTermination()
    return _all_loaded(spark, f"{folder}/replica")


@query("r1_compacted", f"""
    SELECT id, action, amount, weight, ver FROM ({LOADED_SQL})
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY ver DESC) = 1""")
def r1_compacted(spark: SparkSession, sf: str) -> DataFrame:
    """A replica of many loads replaced by its latest rows."""
    folder = scratch_path(spark, "compact")
    rows = _batched(_routed(spark, sf)["activity"])
    for part in range(3):
        stage_batch({"activity": rows.filter(F.col("batch_id") % 3 == part)}, f"{folder}/stage", "feed")
        drain(spark, f"{folder}/stage", f"{folder}/replica", SCHEMAS, DEFAULTS)
    compact(spark, f"{folder}/replica", "activity", SCHEMAS["activity"], ["id"])
    return read_replica(spark, f"{folder}/replica", "activity", SCHEMAS["activity"]).drop(*NUMBERS)


@query("stream_event_rate", f"""
    WITH t AS (SELECT xid, max(ts) AS cts FROM ({FEED_SQL}) GROUP BY xid)
    SELECT date_trunc('minute', cts) AS created_at, count(*) AS total FROM t GROUP BY 1""")
def stream_event_rate(spark: SparkSession, sf: str) -> DataFrame:
    """Transactions per minute of a stream, every minute whole."""
    folder = scratch_path(spark, "rate")
    landed = with_commit_time(feed(spark, sf).select("xid", "seq", "ts"))
    landed.withColumn("commit_ts", F.col("commit_ts").cast("timestamp")).write.parquet(f"{folder}/feed")
    schema = "xid BIGINT, seq BIGINT, ts TIMESTAMP_NTZ, commit_ts TIMESTAMP"
    store_commit_times(read_changes(spark, f"{folder}/feed", schema, streaming=True), f"{folder}/times",
                       f"{folder}/checkpoint", available_now=True).awaitTermination()
    return stored_event_rate(spark, f"{folder}/times").withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))
