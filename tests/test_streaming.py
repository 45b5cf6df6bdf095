"""The same functions over a stream give what they give over a table."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.catalogue.load_queries import DEFAULTS, SCHEMAS
from tidemark.catalogue.tables import RULES, feed
from tidemark.functions.convert import convert_record, to_json_rows
from tidemark.operators.conform import conform
from tidemark.operators.rate import event_rate, with_commit_time
from tidemark.operators.replica import latest_state, latest_state_stream
from tidemark.sinks.staging import current_rows, drain, read_replica, staged_batches
from tidemark.sources.feed import read_changes
from tidemark.sources.mapping import Entry, Mapping
from tidemark.streaming.rate import store_commit_times, stored_event_rate
from tidemark.streaming.replicate import replicate, route_changes, wire_changes

FEED = ("seq BIGINT, xid BIGINT, op STRING, source_table STRING, commit_ts TIMESTAMP, "
        "record STRUCT<id: BIGINT, event_type: STRING, value: DOUBLE, props: STRING>")
PARTS = 4
NUMBERS = ("load_origin", "load_batch", "load_no")


@pytest.fixture(scope="module")
def changes(spark, sf):
    return with_commit_time(feed(spark, sf)).select(
        "seq", "xid", "op", "source_table", F.col("commit_ts").cast("timestamp").alias("commit_ts"),
        F.struct("id", "event_type", "value", "props").alias("record"))


def land(changes, path, part):
    """One file per part, in feed order."""
    changes.filter(F.col("seq").between(part * 250, part * 250 + 249)).coalesce(1) \
        .write.mode("append").parquet(path)


@pytest.fixture
def landed(changes, tmp_path):
    path = str(tmp_path / "feed")
    for part in range(PARTS):
        land(changes, path, part)
    return path


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def batch_result(changes, dest):
    return conform(convert_record(route_changes(changes, RULES)[dest]), SCHEMAS[dest], DEFAULTS.get(dest))


def test_stream_equals_batch_over_several_files(spark, changes, landed, tmp_path):
    dirs = {"replica_dir": f"{tmp_path}/replica", "stage_dir": f"{tmp_path}/stage"}
    stream = read_changes(spark, landed, FEED, streaming=True, max_files=1)
    replicate(stream, RULES, SCHEMAS, origin="feed", checkpoint_dir=f"{tmp_path}/cp", defaults=DEFAULTS, available_now=True,
              held=lambda: {"purchases"}, **dirs).awaitTermination()
    assert staged_batches(spark, dirs["stage_dir"])["purchases"]["feed"] == [[0, PARTS - 1]]
    drain(spark, schemas=SCHEMAS, defaults=DEFAULTS, **dirs)
    for dest in SCHEMAS:
        got = read_replica(spark, dirs["replica_dir"], dest, SCHEMAS[dest]).drop(*NUMBERS)
        assert rows(got) == rows(batch_result(changes, dest))


def test_restart_goes_on_where_it_stopped(spark, changes, tmp_path):
    path = f"{tmp_path}/feed"
    dirs = {"replica_dir": f"{tmp_path}/replica", "stage_dir": f"{tmp_path}/stage"}
    for part in range(PARTS):
        land(changes, path, part)
        stream = read_changes(spark, path, FEED, streaming=True)
        replicate(stream, RULES, SCHEMAS, origin="feed", checkpoint_dir=f"{tmp_path}/cp", defaults=DEFAULTS,
                  available_now=True, **dirs).awaitTermination()
    got = read_replica(spark, dirs["replica_dir"], "activity", SCHEMAS["activity"])
    assert got.select("load_batch").distinct().count() == PARTS
    assert rows(got.drop(*NUMBERS)) == rows(batch_result(changes, "activity"))
    # A stream with a new checkpoint is another origin: rows come twice, the state is the same.
    stream = read_changes(spark, path, FEED, streaming=True, max_files=1)
    replicate(stream, RULES, SCHEMAS, origin="feed-2", checkpoint_dir=f"{tmp_path}/cp2", defaults=DEFAULTS,
              available_now=True, **dirs).awaitTermination()
    state = current_rows(spark, dirs["replica_dir"], "activity", SCHEMAS["activity"], ["id"])
    want = latest_state(batch_result(changes, "activity"), ["id"], tie=None)
    assert rows(state) == rows(want)


def test_released_destinations_are_loaded_by_the_next_micro_batch(spark, changes, tmp_path):
    path, held = f"{tmp_path}/feed", {"activity"}
    dirs = {"replica_dir": f"{tmp_path}/replica", "stage_dir": f"{tmp_path}/stage"}
    for part in range(2):
        land(changes, path, part)
        stream = read_changes(spark, path, FEED, streaming=True)
        replicate(stream, RULES, SCHEMAS, origin="feed", checkpoint_dir=f"{tmp_path}/cp", defaults=DEFAULTS,
                  held=lambda: held, available_now=True, **dirs).awaitTermination()
        held = set()
    got = read_replica(spark, dirs["replica_dir"], "activity", SCHEMAS["activity"]).drop(*NUMBERS)
    assert rows(got) == rows(batch_result(changes.filter("seq < 500"), "activity"))


@pytest.mark.parametrize("n", [1, 50])
def test_one_scan_of_the_feed_for_any_number_of_rules(spark, changes, landed, n):
    rules = Mapping([Entry("click", f"d{k}", remap={"id": "{id}", "v": f"x {{event_type}} {k}"}) for k in range(n)]
                    + [Entry("purchase", "purchases")])
    wire = wire_changes(spark.read.parquet(landed), rules, tombstones={"purchase": "gone"})
    assert wire._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    clicks = changes.filter("source_table = 'click' AND op <> 'delete' AND seq < 1000").count()
    assert wire.filter("dest_table LIKE 'd%'").count() == n * clicks


def test_one_pass_sends_what_routing_by_table_sends(spark, changes):
    wire = wire_changes(changes, RULES)
    for dest, frame in route_changes(changes, RULES).items():
        want = to_json_rows(convert_record(frame))
        got = wire.filter(wire.dest_table == dest)
        assert sorted(sorted(json.loads(r["value"]).items()) for r in got.collect()) == \
            sorted(sorted(json.loads(r["value"]).items()) for r in want.collect())


def test_latest_state_as_a_streaming_aggregate(spark, changes, landed, tmp_path):
    stream = read_changes(spark, landed, FEED, streaming=True, max_files=2)
    flat = stream.select("seq", "op", "record.id", (F.col("seq") + 1).alias("ver"))
    out = f"{tmp_path}/updates"

    def keep(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    latest_state_stream(flat, ["id"]).writeStream.outputMode("update").foreachBatch(keep) \
        .option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()
    updates = spark.read.parquet(out)
    want = latest_state(changes.select("seq", "op", "record.id", (F.col("seq") + 1).alias("ver")), ["id"])
    assert rows(latest_state(updates, ["id"]).select("seq", "op", "id", "ver")) == rows(want)


def test_event_rate_of_a_stream_misses_nothing(spark, changes, landed, tmp_path):
    stream = read_changes(spark, landed, FEED, streaming=True, max_files=1)
    store_commit_times(stream, f"{tmp_path}/times", f"{tmp_path}/cp", available_now=True).awaitTermination()
    got = stored_event_rate(spark, f"{tmp_path}/times")
    want = rows(event_rate(changes.filter("seq < 1000"), ts="commit_ts").select("created_at", "total"))
    assert rows(got.select("created_at", "total")) == want and len(want) > 300


def test_rejects_of_a_stream_are_kept(spark, changes, landed, tmp_path):
    rules = Mapping([Entry("click", "notes", remap={"id": "{id}", "text": "note {missing}"}),
                     Entry("purchase", "purchases")])
    stream = read_changes(spark, landed, FEED, streaming=True, max_files=2)
    replicate(stream, rules, SCHEMAS, origin="feed", checkpoint_dir=f"{tmp_path}/cp", available_now=True,
              replica_dir=f"{tmp_path}/replica", stage_dir=f"{tmp_path}/stage", held=lambda: {"notes"},
              reject_dir=f"{tmp_path}/rejects").awaitTermination()
    clicks = changes.filter("source_table = 'click'").count()
    rejected = spark.read.json(f"{tmp_path}/rejects")
    assert rejected.filter("source_table = 'click' AND reject_reason = 'text: no column missing'").count() == clicks
    assert read_replica(spark, f"{tmp_path}/replica", "purchases", SCHEMAS["purchases"]).count() > 0
