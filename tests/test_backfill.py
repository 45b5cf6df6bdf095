import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions.progress import percent_done
from tidemark.operators.batches import assign_batches, load_report, partition_by_table
from tidemark.operators.numbering import (positions_by_range, previous_value, running_total,
                                          running_total_by_range)
from tidemark.plans.backfill import (catalogue_estimate, copy_windows, fetch_page, max_value, plan_pages,
                                     plan_windows, row_count, start_cursor, unordered_rows)

FEW = settings(max_examples=8, deadline=None, derandomize=True,
               suppress_health_check=[HealthCheck.function_scoped_fixture])


def pages_of(values, n):
    ordered = sorted(values, reverse=True)
    out = []
    for start in range(0, len(ordered), n):
        part = ordered[start:start + n]
        out.append((start // n, len(part), part[-1], start + len(part)))
    return out


def collected(df):
    return sorted(tuple(r) for r in df.collect())


@FEW
@given(st.sets(st.integers(-(2**62), 2**62), max_size=30), st.integers(1, 7))
def test_pages_of_a_sparse_key(spark, values, n):
    df = spark.createDataFrame([(v,) for v in values], "id BIGINT")
    assert collected(plan_pages(df, "id", n, unique=True)) == pages_of(values, n)


@FEW
@given(st.lists(st.integers(-20, 20), max_size=40), st.integers(1, 7))
def test_pages_with_ties(spark, values, n):
    df = spark.createDataFrame([(v,) for v in [*values, None, None]], "id INT")
    assert collected(plan_pages(df, "id", n, bits=2)) == pages_of(values, n)
    assert unordered_rows(df, "id").first()["rows"] == 2


@pytest.mark.parametrize("count", [0, 1, 5, 10, 11])
def test_pages_at_edges(spark, count):
    df = spark.range(count)
    assert collected(plan_pages(df, "id", 5, unique=True, bits=1)) == pages_of(range(count), 5)


def test_one_value_over_many_pages(spark):
    df = spark.range(30_000).select(F.lit(7).alias("v"))
    assert collected(plan_pages(df, "v", 2)) == pages_of([7] * 30_000, 2)


def test_pages_of_other_types(spark):
    words = [f"w{i % 13:02}" for i in range(50)]
    df = spark.createDataFrame([(w,) for w in words], "v STRING")
    assert collected(plan_pages(df, "v", 6)) == pages_of(words, 6)
    keyed = df.withColumn("k", F.monotonically_increasing_id())
    assert collected(plan_pages(keyed, "v", 6, key="k")) == pages_of(words, 6)
    assert plan_pages(keyed.limit(0), "v", 6, key="k").count() == 0
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i * i) for i in range(20)]
    df = spark.createDataFrame([(d,) for d in days], "v DATE")
    assert collected(plan_pages(df, "v", 6)) == pages_of(days, 6)


def test_pages_agree_with_fetching_one_after_another(spark):
    df = spark.range(23).withColumn("id", F.col("id") * 3)
    cursor, seen = start_cursor(max_value(df, "id").first()[0]), []
    while True:
        page = [r["id"] for r in fetch_page(df, "id", cursor, 5).collect()]
        if not page:
            break
        cursor = min(page)
        seen.append((len(seen), len(page), cursor, sum(p[1] for p in seen) + len(page)))
    assert seen == collected(plan_pages(df, "id", 5, unique=True))


def test_fetch_page_without_a_cursor_and_of_nulls(spark):
    df = spark.createDataFrame([(1,), (None,), (3,), (2,)], "id INT")
    assert [r["id"] for r in fetch_page(df, "id", n=2).collect()] == [3, 2]
    assert [r["id"] for r in fetch_page(df, "id", 3, n=5).collect()] == [2, 1]


def test_start_cursor():
    assert start_cursor(9) == 10
    assert start_cursor(None) is None and start_cursor("z") is None


def windows_of(ids, batch):
    """The windows as a descending loop visits them, but down to and including id 0."""
    out, high, no = [], max(ids, default=-1), 0
    while high >= 0:
        low = max(high - batch, 0)
        inside = sum(low <= i <= high for i in ids)
        if inside:
            out.append((no, low, high, inside))
        high, no = low - 1, no + 1
    return out


@FEW
@given(st.sets(st.integers(-5, 60), max_size=30), st.integers(1, 9))
def test_windows(spark, ids, batch):
    df = spark.createDataFrame([(i,) for i in ids], "id BIGINT")
    assert collected(plan_windows(df, "id", batch)) == windows_of(ids, batch)
    copied = copy_windows(df, "id", batch).collect()
    assert sorted(r["id"] for r in copied) == sorted(i for i in ids if i >= 0)


def test_copy_windows_leaves_out_live_keys(spark):
    live = spark.createDataFrame([(3,), (3,)], "key BIGINT")
    got = copy_windows(spark.range(6), "id", 2, live, "key")
    assert collected(got) == [(0, 1), (1, 1), (2, 1), (4, 0), (5, 0)]


def test_counts_and_maximum(spark):
    assert max_value(spark.range(0), "id").first()[0] is None
    assert row_count(spark.range(7)) == 7
    assert row_count(spark.range(7), estimate=0) == 7
    assert row_count(spark.range(7), estimate=100) == 100


def test_catalogue_estimate(spark):
    spark.sql("DROP TABLE IF EXISTS counted")
    spark.range(12).write.saveAsTable("counted")
    spark.sql("ANALYZE TABLE counted COMPUTE STATISTICS")
    assert catalogue_estimate(spark, "counted") == 12
    spark.sql("DROP TABLE counted")


@FEW
@given(st.sets(st.tuples(st.sampled_from("ab"), st.integers(-50, 2**40)), max_size=30), st.integers(0, 12))
def test_running_total_by_group(spark, keys, bits):
    df = spark.createDataFrame([(g, o, abs(o) % 9) for g, o in keys], "g STRING, o BIGINT, w BIGINT")
    for descending in (False, True):
        got = running_total(df, "o", "w", ["g"], descending=descending, bits=bits)
        want = [(g, o, abs(o) % 9, sum(abs(p) % 9 for h, p in keys
                 if h == g and (p > o if descending else p < o))) for g, o in keys]
        assert collected(got) == sorted(want)


def test_running_total_recurses_over_slots_of_slots(spark, monkeypatch):
    from tidemark.operators import numbering
    monkeypatch.setattr(numbering, "FAN_BITS", 2)
    values = [i * i * 37 for i in range(60)]
    df = spark.createDataFrame([(v,) for v in values], "o BIGINT")
    assert collected(running_total(df, "o", bits=3)) == [(v, i) for i, v in enumerate(sorted(values))]


def test_positions_by_range(spark):
    rows = [(f"k{i % 3}", i) for i in range(200)]
    df = spark.createDataFrame(rows, "o STRING, k INT").repartition(7)
    want = sorted((*row, i) for i, row in enumerate(sorted(rows)))
    assert collected(positions_by_range(df, ["o", "k"])) == want
    want = sorted((*row, i) for i, row in enumerate(sorted(rows, reverse=True)))
    assert collected(positions_by_range(df, ["o", "k"], descending=True)) == want


def test_running_total_by_range(spark):
    words = [f"k{i * 7919 % 1000:03}" for i in range(200)]
    df = spark.createDataFrame([(w, 2) for w in words], "o STRING, w INT")
    want = [(w, 2, 2 * i) for i, w in enumerate(sorted(words))]
    assert collected(running_total_by_range(df, "o", "w")) == want


@FEW
@given(st.lists(st.sampled_from(["a", "b", None]), max_size=25), st.integers(0, 4), st.sampled_from([0, 6, 99]))
def test_previous_value_over_slots(spark, values, bits, hot_rows):
    df = spark.createDataFrame([(i % 2, i, v) for i, v in enumerate(values)], "g INT, o BIGINT, v STRING")
    got = {r["o"]: r["previous"] for r in previous_value(
        df, "v", "o", ["g"], bits=bits, hot_rows=hot_rows).collect()}
    assert got == {i: values[i - 2] if i >= 2 else None for i in range(len(values))}


def test_batches_and_reports(spark):
    df = spark.createDataFrame([("s", "d", i, 100 - i) for i in range(0, 14, 2)] + [("t", "d", 1, 5)],
                               "source_table STRING, dest_table STRING, seq BIGINT, id BIGINT")
    batches = assign_batches(df, size=3, bits=1)
    assert sorted((r["source_table"], r["seq"], r["batch_id"]) for r in batches.collect()) == [
        ("s", 0, 0), ("s", 2, 0), ("s", 4, 0), ("s", 6, 1), ("s", 8, 1), ("s", 10, 1), ("s", 12, 2), ("t", 1, 0)]
    report = load_report(batches.filter("source_table = 's'"), with_ids=True).orderBy("batch_id").collect()
    assert [(r["first_id"], r["rows"], r["ids"]) for r in report] == [
        (100, 3, "100,98,96"), (94, 3, "94,92,90"), (88, 1, "88")]
    assert load_report(batches.drop("id"), with_ids=True).first()["ids"] == "-"
    assert "ids" not in load_report(batches, loaded_at="seq").columns


def test_partition_by_table(spark):
    df = spark.range(100).select((F.col("id") % 3).cast("string").alias("source_table"),
                                 (F.col("id") % 5).alias("key"), F.col("id").alias("seq"))
    where = partition_by_table(df).select("source_table", F.spark_partition_id().alias("p")).distinct()
    assert where.groupBy("source_table").count().filter("count > 1").count() == 0
    spread = partition_by_table(df, key="key", partitions=4).select(
        "source_table", "key", "seq", F.spark_partition_id().alias("p")).collect()
    seen = {}
    for r in spread:
        seen.setdefault((r["source_table"], r["key"]), []).append((r["p"], r["seq"]))
    assert all(v == sorted(v) and len({p for p, _ in v}) == 1 for v in seen.values())


def test_percent(spark):
    df = spark.createDataFrame([(45000, 150000), (5, 0), (5, None), (300, 200), (1, 3)], "p BIGINT, t BIGINT")
    got = [r[0] for r in df.select(percent_done(F.col("p"), F.col("t"))).collect()]
    assert got == [30.0, 100.0, None, 150.0, 33.33]
