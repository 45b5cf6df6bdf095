import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators.rate import event_rate, with_commit_time
from tidemark.operators.replica import (exclude_live, latest_state, latest_state_stream,
                                        merge_snapshot, refresh_keys)

FEW = settings(max_examples=8, deadline=None, derandomize=True,
               suppress_health_check=[HealthCheck.function_scoped_fixture])
VERSIONS = st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3), st.integers(0, 99)), max_size=25)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def frame(spark, versions):
    return spark.createDataFrame([(k, v, i, x) for i, (k, v, x) in enumerate(versions)],
                                 "id BIGINT, ver BIGINT, seq BIGINT, x BIGINT")


def expected(versions):
    best = {}
    for seq, (key, ver, x) in enumerate(versions):
        if key not in best or (ver, seq) > best[key][1:3]:
            best[key] = (key, ver, seq, x)
    return sorted(best.values())


@FEW
@given(VERSIONS)
def test_latest_state_in_any_order(spark, versions):
    df = frame(spark, versions)
    assert rows(latest_state(df, ["id"])) == expected(versions)
    shuffled = list(df.collect())
    random.Random(1).shuffle(shuffled)
    again = spark.createDataFrame(shuffled, df.schema)
    assert rows(latest_state(again, ["id"])) == expected(versions)
    assert rows(latest_state_stream(again, ["id"])) == expected(versions)


@FEW
@given(VERSIONS, st.sets(st.integers(0, 6), max_size=5))
def test_a_snapshot_row_never_beats_a_live_one(spark, versions, keys):
    live = [(k, v + 1, x) for k, v, x in versions]
    snapshot = spark.createDataFrame([(k, -1) for k in keys], "id BIGINT, x BIGINT")
    got = {r["id"]: r["ver"] for r in merge_snapshot(snapshot, frame(spark, live), ["id"]).collect()}
    want = {k: 0 for k in keys} | {k: v for k, v, _, _ in expected(live)}
    assert got == want


def test_merging_in_parts_changes_nothing(spark):
    versions = [(i % 7, i % 5, i) for i in range(60)]
    df = frame(spark, versions)
    parts = latest_state(df.filter("seq < 30"), ["id"]).unionByName(latest_state(df.filter("seq >= 30"), ["id"]))
    assert rows(latest_state(parts, ["id"])) == rows(latest_state(df, ["id"]))
    assert rows(latest_state(df.unionByName(df), ["id"])) == rows(latest_state(df, ["id"]))


def test_a_deleted_row_does_not_revive(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, "gone"), (2, 1, "gone"), (2, 2, None)],
                               "id BIGINT, ver BIGINT, deleted_at STRING")
    assert rows(latest_state(df, ["id"], tie=None, deleted="deleted_at").select("id", "ver")) == [(2, 2)]


def test_composite_keys_and_null_versions(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "a", 0), (1, "b", None)], "id INT, k STRING, ver BIGINT")
    assert rows(latest_state(df, ["id", "k"], tie=None).select("id", "k", F.coalesce("ver", F.lit(-1)))) == [
        (1, "a", 0), (1, "b", -1)]


def test_exclude_and_refresh(spark):
    source = spark.range(10).withColumn("x", F.col("id") * 2)
    live = spark.createDataFrame([(2,), (2,), (3,)], "user BIGINT")
    assert [r["id"] for r in exclude_live(source, live, "id", "user").orderBy("id").collect()] == [0, 1, 4, 5, 6, 7, 8, 9]
    assert rows(refresh_keys(source, [1, 2, 99], "id", live, "user")) == [(1, 2)]
    assert rows(refresh_keys(source, list(range(2000)), "id")) == rows(source)
    assert rows(refresh_keys(source, live, "id")) == [(2, 4), (3, 6)]
    assert rows(refresh_keys(source, [], "id")) == []


def test_a_transaction_over_two_minutes_counts_once(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-01 00:00:59"), (1, "2024-01-01 00:01:01"), (2, "2024-01-01 00:01:30"),
         (3, "2024-01-01 00:05:00")], "xid BIGINT, ts STRING").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    assert [(str(r["created_at"]), r["total"]) for r in event_rate(df).orderBy("created_at").collect()] == [
        ("2024-01-01 00:01:00", 2), ("2024-01-01 00:05:00", 1)]
    assert with_commit_time(df).filter("xid = 1").select("commit_ts").distinct().count() == 1
