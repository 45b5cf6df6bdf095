"""Batches by size and time against the walk over all rows."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tidemark.operators.timed import assign_timed_batches

SCHEMA = "g STRING, seq LONG, ts TIMESTAMP, dest STRING"
ZERO = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def walk(rows, size, limit):
    """Row by row, as the rule says."""
    out, state = {}, {}
    for g, seq, ts, _ in sorted(rows, key=lambda r: r[1]):
        number, first, n, now = state.get(g, (-1, None, 0, 0))
        now = max(now, int((ts - ZERO).total_seconds() * 1000) if ts else 0)
        if first is None or n == size or now >= first + limit:
            number, first, n = number + 1, now, 0
        state[g] = (number, first, n + 1, now)
        out[g, seq] = number
    return out


def made(seed, n, gap):
    rnd, rows, at = random.Random(seed), [], 0
    for seq in range(n):
        at += rnd.choice([0, 0, 1, rnd.randrange(gap), rnd.randrange(20 * gap) if rnd.random() < 0.02 else 0])
        ts = None if rnd.random() < 0.02 else ZERO + dt.timedelta(milliseconds=max(0, at - rnd.choice([0, 0, 0, gap])))
        rows.append((rnd.choice("aaaab"), seq * 3, ts, "d"))
    return rows


def check(spark, rows, size, limit):
    df = spark.createDataFrame(rows, SCHEMA)
    got = assign_timed_batches(df, size, limit, group=("g",))
    assert got.columns == [*df.columns, "batch_id"]
    assert {(r["g"], r["seq"]): r["batch_id"] for r in got.collect()} == walk(rows, size, limit)


def test_batches_are_those_of_the_walk(spark):
    check(spark, made(1, 900, 40), 7, 100)
    check(spark, made(2, 700, 10), 50, 200)


def test_only_size_or_only_time(spark):
    check(spark, made(3, 300, 5), 16, 10**9)
    check(spark, made(4, 120, 50), 1000, 60)


def test_ties_one_row_and_no_rows(spark):
    same = [("a", k, ZERO, "d") for k in range(20)]
    check(spark, same, 6, 1)
    check(spark, [("a", 5, ZERO, "d")], 6, 1)
    assert assign_timed_batches(spark.createDataFrame([], SCHEMA), 5, 5, group=("g",)).count() == 0


def test_two_group_columns(spark):
    df = spark.createDataFrame(made(5, 200, 30), SCHEMA).withColumn("batch_no", F.lit(1))
    got = assign_timed_batches(df, 9, 150, group=("g", "dest"))
    assert {(r["g"], r["seq"]): r["batch_id"] for r in got.collect()} == walk(made(5, 200, 30), 9, 150)
