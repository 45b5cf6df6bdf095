"""Differences by range checksums, and keys of several columns."""

import random

from pyspark.sql import functions as F

from tidemark.plans import differences as diff
from tidemark.plans.copy import BackfillJobs
from tidemark.plans.keys import find_key_columns
from tidemark.sources.mapping import Mapping

SCHEMA = "id LONG, v DOUBLE, t STRING"


def brute(one, two):
    a, b = ({r[0]: r[1:] for r in rows if r[0] is not None} for rows in (one, two))
    found = [(k, "missing", None) for k in a.keys() - b.keys()] + [(k, "extra", None) for k in b.keys() - a.keys()]
    for k in a.keys() & b.keys():
        names = ",".join(c for c, x, y in zip(("v", "t"), a[k], b[k]) if x != y)
        found += [(k, "unequal", names)] * bool(names)
    return sorted(found)


def test_differences_are_those_of_a_full_comparison(spark):
    rnd = random.Random(1)
    one = [(k * rnd.choice([1, 1, 50]) - 300, rnd.choice([None, 0.0, 1.5, rnd.random()]), rnd.choice([None, "", "x"])) for k in range(400)]
    one = list({r[0]: r for r in one}.values())
    two = [r for r in one if rnd.random() > 0.02]
    two = [(k, 9.0 if rnd.random() < 0.02 else v, "y" if rnd.random() < 0.02 else t) for k, v, t in two] + [(10**6, 1.0, "x"), (None, 1.0, "x")]
    two = [(k, -0.0 if v == 0.0 else v, t) for k, v, t in two]
    left, right = spark.createDataFrame(one, SCHEMA), spark.createDataFrame(two, SCHEMA)
    got = diff.differences(left, right, "id", ["v", "t"], leaf_bits=3, fan_bits=6)
    assert sorted(tuple(r) for r in got.collect()) == brute(one, two)
    assert diff.differences(left, left.repartition(3), "id", ["v", "t"]).count() == 0
    assert diff.differences(left, left.limit(0), "id", ["v", "t"]).filter("difference = 'missing'").count() == len(one)


def test_only_ranges_that_differ_are_opened(spark):
    rows = spark.range(100_000).select("id", (F.col("id") / 2).alias("v"), F.lit("x").alias("t"))
    other = rows.withColumn("t", F.when(F.col("id") == 77_777, "y").otherwise(F.col("t")))
    leaves = [diff.checksums(x, "id", ["v", "t"], leaf_bits=6) for x in (rows, other)]
    assert [r["range"] for r in diff.differing_ranges(*leaves, fan_bits=4).collect()] == [77_777 >> 6]
    assert diff._opened(rows, "id", spark.createDataFrame([(77_777 >> 6,)], "range LONG"), 6).count() == 64


def test_least_sets_of_columns(spark):
    rows = spark.range(600).select((F.col("id") / 20).cast("int").alias("a"), (F.col("id") % 20).alias("b"), F.lit(1).alias("one"),
                                   (F.col("id") % 7).alias("c"), F.when(F.col("id") != 3, F.col("id")).alias("gap"))
    assert find_key_columns(rows) == ("a", "b")
    assert find_key_columns(rows, 1) is None
    three = spark.range(512).select((F.col("id") % 8).alias("x"), (F.col("id") / 8 % 8).cast("int").alias("y"), (F.col("id") / 64).cast("int").alias("z"))
    assert find_key_columns(three) == ("x", "y", "z")
    assert find_key_columns(three.withColumn("k", F.expr("x + 8 * y + 64 * z"))) == ("k",)
    assert find_key_columns(three.union(three)) is None


def test_a_job_with_a_key_of_two_columns(spark, tmp_path):
    schema = "a INT, b INT, v STRING"
    rows = spark.createDataFrame([(k // 4, k % 4, "x") for k in range(40)], schema)
    jobs = BackfillJobs(spark, f"{tmp_path}/log", Mapping.from_dicts([{"source_table": "s", "dest_table": "d"}]))
    (job,) = jobs.start_all({"s": rows}, batch_size=7)
    assert (job["primary_key"], job["ordering_column"]) == ("a,b", "a")
    from tidemark.catalogue.tables import row_type
    from tidemark.sinks.staging import read_replica
    schemas = {"d": row_type("a INT NOT NULL, b INT NOT NULL, v STRING, ver BIGINT")}
    done = jobs.copy_pages(job["job_id"], rows, f"{tmp_path}/replica", schemas, pages_per_step=2)
    assert done["status"] == "completed" and done["processed_rows"] == 40
    assert read_replica(spark, f"{tmp_path}/replica", "d", schemas["d"]).select("a", "b").distinct().count() == 40
