"""Backfill planning, keys, job log and reconciliation: F queries."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.catalogue.registry import query
from tidemark.catalogue.tables import FEED_SQL, JOB_LOG_SQL, RULES, feed, job_log, row_type, table
from tidemark.operators.changes import live_changes
from tidemark.plans.backfill import (catalogue_estimate, copy_windows, fetch_page, max_value, plan_pages,
                                     plan_windows, row_count, unordered_rows)
from tidemark.plans.copy import BackfillJobs, copy_by_windows
from tidemark.plans.joblog import active_jobs, audit_transitions, job_progress, job_states, list_jobs
from tidemark.plans.differences import differences
from tidemark.plans.keys import profile_keys, screen_keys
from tidemark.plans.reports import progress, unmapped_report
from tidemark.session import scratch_path
from tidemark.sinks.staging import compact, current_rows, read_replica
from tidemark.sources.mapping import Mapping


@query("f1_max", "SELECT max(o_orderkey) AS max_value FROM orders")
def f1_max(spark: SparkSession, sf: str) -> DataFrame:
    return max_value(table(spark, sf, "orders"), "o_orderkey")


@query("f2_counts", """
    SELECT 'orders' AS source_table, count(*) AS rows FROM orders
    UNION ALL SELECT 'lineitem', count(*) FROM lineitem""")
def f2_counts(spark: SparkSession, sf: str) -> DataFrame:
    """One table by exact count, one by the estimate its catalogue keeps."""
    orders = table(spark, sf, "orders")
    name = f"f2_{uuid.uuid4().hex}"
    table(spark, sf, "lineitem").select("l_orderkey").write.saveAsTable(name)
    try:
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS")
        rows = [("orders", row_count(orders, None)),
                ("lineitem", row_count(spark.table(name), catalogue_estimate(spark, name)))]
    finally:
        spark.sql(f"DROP TABLE {name}")
    return spark.createDataFrame(rows, "source_table STRING, rows BIGINT")


def _profile_sql(source: str, candidates: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS candidate, count(*) AS total_rows, "
        f"CAST(0 AS BIGINT) AS null_rows, count(DISTINCT {expr}) AS distinct_values, "
        f"count(*) = count(DISTINCT {expr}) AS is_key FROM {source}" for name, expr in candidates)


@query("f3_key_profile", _profile_sql("lineitem", [
    ("l_orderkey", "l_orderkey"), ("l_partkey", "l_partkey"), ("l_shipdate", "l_shipdate")]))
def f3_key_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_partkey", "l_shipdate"])


@query("f3_composite_key", _profile_sql("conversations", [
    ("conv_id", "conv_id"), ("turn", "turn"), ("conv_id,turn", "(conv_id, turn)")]))
def f3_composite_key(spark: SparkSession, sf: str) -> DataFrame:
    return profile_keys(table(spark, sf, "conversations"), ["conv_id", "turn", ("conv_id", "turn")])


ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


@query("f3_screened_keys", _profile_sql("orders", [(c, c) for c in ORDER_COLUMNS]))
def f3_screened_keys(spark: SparkSession, sf: str) -> DataFrame:
    """All columns screened in one pass, those without nulls counted exactly, the likeliest first."""
    orders = table(spark, sf, "orders")
    return profile_keys(orders, screen_keys(orders, orders.columns))


@query("f3_found_key", "SELECT 'orders' AS source_table, 'o_orderkey' AS key UNION ALL SELECT 'customer', 'c_custkey'")
def f3_found_key(spark: SparkSession, sf: str) -> DataFrame:
    """Jobs for all mapped tables, each key found in the data."""
    rules = Mapping.from_dicts([{"source_table": t, "dest_table": t} for t in ("orders", "customer")])
    jobs = BackfillJobs(spark, scratch_path(spark, "all"), rules)
    jobs.start_all({t: table(spark, sf, t) for t in ("orders", "customer", "part")})
    return job_states(jobs.log()).select("source_table", F.col("primary_key").alias("key"))


@query("f3_composite_found", """
    WITH sets(key, place, n) AS (
        SELECT 'conv_id,turn', 1, count(DISTINCT (conv_id, turn)) FROM conversations
        UNION ALL SELECT 'conv_id,role', 2, count(DISTINCT (conv_id, role)) FROM conversations
        UNION ALL SELECT 'turn,role', 3, count(DISTINCT (turn, role)) FROM conversations)
    SELECT 'conversations' AS source_table, arg_min(key, place) AS key, 'conv_id' AS ordering_column
    FROM sets WHERE n = (SELECT count(*) FROM conversations)
    UNION ALL SELECT 'customer', 'c_custkey', 'c_custkey'""")
def f3_composite_found(spark: SparkSession, sf: str) -> DataFrame:
    """Jobs for tables with a key of one column and of several."""
    rules = Mapping.from_dicts([{"source_table": t, "dest_table": t} for t in ("conversations", "customer")])
    jobs = BackfillJobs(spark, scratch_path(spark, "composite"), rules)
    jobs.start_all({"conversations": table(spark, sf, "conversations").select("conv_id", "turn", "role"),
                    "customer": table(spark, sf, "customer")})
    return job_states(jobs.log()).select("source_table", F.col("primary_key").alias("key"), "ordering_column")


@query("f4_page", """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey < 1000
    ORDER BY o_orderkey DESC LIMIT 50""")
def f4_page(spark: SparkSession, sf: str) -> DataFrame:
    return fetch_page(table(spark, sf, "orders"), "o_orderkey", 1000, 50) \
        .select("o_orderkey", "o_custkey", "o_totalprice")


def _pages_sql(source: str, col: str, n: int) -> str:
    return f"""
    SELECT page, count(*) AS rows, min(v) AS last_id, page * {n} + count(*) AS processed
    FROM (SELECT {col} AS v, (row_number() OVER (ORDER BY {col} DESC) - 1) // {n} AS page FROM {source})
    GROUP BY page"""


@query("f5_pages", _pages_sql("orders", "o_orderkey", 700))
def f5_pages(spark: SparkSession, sf: str) -> DataFrame:
    return plan_pages(table(spark, sf, "orders"), "o_orderkey", 700, unique=True)


@query("f5_pages_ties", _pages_sql("lineitem", "l_suppkey", 700))
def f5_pages_ties(spark: SparkSession, sf: str) -> DataFrame:
    """Every supplier has many lines: values span pages and pages split values."""
    return plan_pages(table(spark, sf, "lineitem"), "l_suppkey", 700)


@query("f5_pages_time", _pages_sql("orders", "o_orderdate", 700))
def f5_pages_time(spark: SparkSession, sf: str) -> DataFrame:
    """By time, with ties broken by the key."""
    return plan_pages(table(spark, sf, "orders"), "o_orderdate", 700, key="o_orderkey")


@query("f5_pages_decimal", _pages_sql("lineitem", "CAST(l_extendedprice AS DECIMAL(12, 2))", 5000))
def f5_pages_decimal(spark: SparkSession, sf: str) -> DataFrame:
    """By a decimal: its unscaled value lays it out."""
    lines = table(spark, sf, "lineitem").select(F.col("l_extendedprice").cast("decimal(12,2)").alias("price"))
    return plan_pages(lines, "price", 5000)


@query("f5_pages_text", _pages_sql("customer", "c_name", 100))
def f5_pages_text(spark: SparkSession, sf: str) -> DataFrame:
    return plan_pages(table(spark, sf, "customer"), "c_name", 100)


@query("f5_pages_price", _pages_sql("lineitem", "l_extendedprice", 5000))
def f5_pages_price(spark: SparkSession, sf: str) -> DataFrame:
    """By a double without a key: equal prices are counted together first."""
    return plan_pages(table(spark, sf, "lineitem"), "l_extendedprice", 5000)


@query("f5_unordered", "SELECT count(*) FILTER (WHERE event_type = 'error') AS rows FROM events")
def f5_unordered(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    return unordered_rows(events.withColumn("v", F.when(F.col("event_type") != "error", F.col("value"))), "v")


_WINDOWS_SQL = """
    SELECT o.*, (m - o_orderkey) // 1001 AS "window", m
    FROM orders o, (SELECT max(o_orderkey) AS m FROM orders)"""


@query("f6_windows", f"""
    SELECT "window", greatest(m - "window" * 1001 - 1000, 0) AS low_id, m - "window" * 1001 AS high_id,
           count(*) AS rows FROM ({_WINDOWS_SQL}) GROUP BY ALL""")
def f6_windows(spark: SparkSession, sf: str) -> DataFrame:
    return plan_windows(table(spark, sf, "orders"), "o_orderkey", 1000)


@query("f6_lineitem_windows", """
    SELECT "window", greatest(m - "window" * 10001 - 10000, 0) AS low_id, m - "window" * 10001 AS high_id,
           count(*) AS rows
    FROM (SELECT (m - l_orderkey) // 10001 AS "window", m
          FROM lineitem, (SELECT max(l_orderkey) AS m FROM lineitem)) GROUP BY ALL""")
def f6_lineitem_windows(spark: SparkSession, sf: str) -> DataFrame:
    return plan_windows(table(spark, sf, "lineitem"), "l_orderkey")


@query("f6_copy", f"""
    SELECT o_orderkey, o_totalprice, "window" FROM ({_WINDOWS_SQL})
    WHERE o_orderkey NOT IN (SELECT id FROM ({FEED_SQL}) WHERE op <> 'delete')""")
def f6_copy(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return copy_windows(orders, "o_orderkey", 1000, live_changes(feed(spark, sf)), "id")


@query("f7_unmapped", f"""
    SELECT source_table, count(*) AS rows, max(seq) AS last_seq FROM ({FEED_SQL})
    WHERE source_table NOT IN ('signup', 'click', 'view', 'purchase') GROUP BY 1""")
def f7_unmapped(spark: SparkSession, sf: str) -> DataFrame:
    return unmapped_report(feed(spark, sf), RULES)


_STATES_SQL = f"""
    SELECT * FROM ({JOB_LOG_SQL})
    QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY event_no DESC) = 1"""


@query("f8_job_states", _STATES_SQL)
def f8_job_states(spark: SparkSession, sf: str) -> DataFrame:
    return job_states(job_log(spark, sf))


@query("f8_list_jobs", f"""
    SELECT job_id, status, inserted_at FROM ({_STATES_SQL}) WHERE status IN ('failed', 'paused')""")
def f8_list_jobs(spark: SparkSession, sf: str) -> DataFrame:
    return list_jobs(job_log(spark, sf), ["failed", "paused"]).select("job_id", "status", "inserted_at")


@query("f8_active_jobs", f"""
    SELECT job_id, source_table, status FROM ({_STATES_SQL})
    WHERE status IN ('pending', 'running', 'paused')
    QUALIFY row_number() OVER (PARTITION BY source_table ORDER BY inserted_at DESC, job_id DESC) = 1""")
def f8_active_jobs(spark: SparkSession, sf: str) -> DataFrame:
    return active_jobs(job_log(spark, sf)).select("job_id", "source_table", "status")


@query("f9_audit", f"""
    WITH s AS (SELECT *, lag(status) OVER (PARTITION BY job_id ORDER BY event_no) AS previous
               FROM ({JOB_LOG_SQL})),
    p AS (SELECT job_id, event_no, previous, status, CASE
        WHEN status = 'unknown' THEN 'unknown_status'
        WHEN source_table IS NULL OR dest_table IS NULL THEN 'missing_table'
        WHEN previous IS NULL AND status <> 'pending' THEN 'bad_start'
        WHEN previous IS NULL OR previous = 'unknown' OR status = 'paused' THEN NULL
        WHEN previous = 'pending' AND status = 'running' THEN NULL
        WHEN previous = 'running' AND status IN ('running', 'completed', 'failed') THEN NULL
        WHEN previous = 'paused' AND status IN ('running', 'pending') THEN NULL
        ELSE 'bad_transition' END AS problem FROM s)
    SELECT * FROM p WHERE problem IS NOT NULL""")
def f9_audit(spark: SparkSession, sf: str) -> DataFrame:
    return audit_transitions(job_log(spark, sf))


_PERCENT_SQL = """CASE WHEN total_rows IS NULL THEN NULL WHEN total_rows = 0 THEN 100.0
    ELSE round(CAST(processed_rows AS DOUBLE) / total_rows * 100, 2) END AS progress_percent"""


@query("f10_job_progress", f"""
    SELECT job_id, total_rows, processed_rows, {_PERCENT_SQL} FROM ({_STATES_SQL})""")
def f10_job_progress(spark: SparkSession, sf: str) -> DataFrame:
    return job_progress(job_log(spark, sf)).select("job_id", "total_rows", "processed_rows", "progress_percent")


@query("f10_progress", f"""
    SELECT *, {_PERCENT_SQL} FROM (
        SELECT 'customer' AS source_table, count(*) AS total_rows,
               count(*) FILTER (WHERE c_custkey IN (SELECT id FROM ({FEED_SQL}))) AS processed_rows FROM customer
        UNION ALL SELECT 'orders', count(*),
               count(*) FILTER (WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)) FROM orders
        UNION ALL SELECT 'supplier', count(*), 0 FROM supplier)""")
def f10_progress(spark: SparkSession, sf: str) -> DataFrame:
    snapshots = {"customer": table(spark, sf, "customer").select("c_custkey"),
                 "orders": table(spark, sf, "orders").select("o_orderkey"),
                 "supplier": table(spark, sf, "supplier").select("s_suppkey")}
    replicas = {"customer": feed(spark, sf).select("id"),
                "orders": table(spark, sf, "lineitem").select("l_orderkey")}
    return progress(snapshots, replicas)


@query("f10_differences", """
    WITH replica AS (
        SELECT o_orderkey, CASE WHEN o_orderkey % 1013 = 5 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
               CASE WHEN o_orderkey % 1777 = 9 THEN NULL ELSE o_orderstatus END AS o_orderstatus
        FROM orders WHERE o_orderkey % 997 <> 3
        UNION ALL SELECT o_orderkey + 100000000, o_totalprice, o_orderstatus FROM orders WHERE o_orderkey % 1501 = 1)
    SELECT coalesce(s.o_orderkey, r.o_orderkey) AS key,
           CASE WHEN r.o_orderkey IS NULL THEN 'missing' WHEN s.o_orderkey IS NULL THEN 'extra' ELSE 'unequal' END AS difference,
           CASE WHEN r.o_orderkey IS NOT NULL AND s.o_orderkey IS NOT NULL THEN concat_ws(',',
               CASE WHEN s.o_totalprice IS DISTINCT FROM r.o_totalprice THEN 'o_totalprice' END,
               CASE WHEN s.o_orderstatus IS DISTINCT FROM r.o_orderstatus THEN 'o_orderstatus' END) END AS columns
    FROM orders s FULL JOIN replica r ON s.o_orderkey = r.o_orderkey
    WHERE r.o_orderkey IS NULL OR s.o_orderkey IS NULL
       OR s.o_totalprice IS DISTINCT FROM r.o_totalprice OR s.o_orderstatus IS DISTINCT FROM r.o_orderstatus""")
def f10_differences(spark: SparkSession, sf: str) -> DataFrame:
    """A replica with rows missing, too many and changed."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    key = F.col("o_orderkey")
    changed = orders.filter(key % 997 != 3).select(
        key, F.when(key % 1013 == 5, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        F.when(key % 1777 != 9, F.col("o_orderstatus")).alias("o_orderstatus"))
    extra = orders.filter(key % 1501 == 1).withColumn("o_orderkey", key + 100_000_000)
    return differences(orders, changed.unionByName(extra), "o_orderkey", ["o_totalprice", "o_orderstatus"], leaf_bits=5, fan_bits=3)


ORDER_RULES = Mapping.from_dicts([
    {"source_table": "orders", "dest_table": "order_facts",
     "remap": {"id": "{o_orderkey}", "customer": "{o_custkey}", "price": "{o_totalprice}",
               "placed": "{o_orderdate}", "origin": "backfill"}}])
ORDER_FACTS = row_type(
    "id BIGINT NOT NULL, customer BIGINT, price DOUBLE NOT NULL, placed TIMESTAMP_NTZ, "
    "origin STRING, ver BIGINT NOT NULL")


@query("f11_copy_pages", """
    SELECT o_orderkey AS id, o_custkey AS customer, o_totalprice AS price,
           date_trunc('second', o_orderdate) AS placed, 'backfill' AS origin,
           CAST(0 AS BIGINT) AS ver FROM orders""")
def f11_copy_pages(spark: SparkSession, sf: str) -> DataFrame:
    """A backfill in three runs: two pages, a pause that copies nothing, then the rest."""
    folder = scratch_path(spark, "copy")
    jobs = BackfillJobs(spark, f"{folder}/log", ORDER_RULES)
    orders = table(spark, sf, "orders")
    job = jobs.start("orders", orders, "o_orderkey", batch_size=400)
    run = {"source": orders, "replica_dir": f"{folder}/replica", "schemas": {"order_facts": ORDER_FACTS}}
    jobs.copy_pages(job["job_id"], max_pages=2, **run)
    jobs.pause(job["job_id"])
    jobs.copy_pages(job["job_id"], **run)
    jobs.resume(job["job_id"])
    jobs.copy_pages(job["job_id"], **run)
    return read_replica(spark, f"{folder}/replica", "order_facts", ORDER_FACTS).drop("load_origin", "load_batch", "load_no")


@query("f11_job_log", """
    WITH p AS (SELECT page, count(*) AS n, min(v) AS last_id FROM (
                   SELECT o_orderkey AS v, (row_number() OVER (ORDER BY o_orderkey DESC) - 1) // 700 AS page FROM orders)
               GROUP BY page),
    s AS (SELECT page // 2 AS step, min(last_id) AS last_processed_id, sum(n) AS n FROM p GROUP BY 1)
    SELECT step, last_processed_id, CAST(sum(n) OVER (ORDER BY step) AS BIGINT) AS processed_rows,
           CASE WHEN step = (SELECT max(step) FROM s) THEN 'completed' ELSE 'running' END AS status FROM s""")
def f11_job_log(spark: SparkSession, sf: str) -> DataFrame:
    """Cursor and count after each step of two pages, with a failure in between that is resumed."""
    folder = scratch_path(spark, "copy")
    jobs = BackfillJobs(spark, f"{folder}/log", ORDER_RULES)
    orders = table(spark, sf, "orders")
    job = jobs.start("orders", orders, "o_orderkey", batch_size=700)
    run = {"replica_dir": f"{folder}/replica", "schemas": {"order_facts": ORDER_FACTS}, "pages_per_step": 2}
    jobs.copy_pages(job["job_id"], orders, max_pages=2, **run)
    broken = orders.withColumn("o_totalprice", F.raise_error(F.lit("lost the source")).cast("double"))
    try:
        jobs.copy_pages(job["job_id"], broken, **run)
    except Exception as error:  # noqa: BLE001
        if "lost the source" not in str(error):
            raise
    jobs.resume(job["job_id"], from_failed=True)
    jobs.copy_pages(job["job_id"], orders, **run)
    steps = jobs.log().filter("processed_rows > 0 AND status IN ('running', 'completed')") \
        .groupBy("last_processed_id", "processed_rows").agg(F.max("status").alias("a"), F.min("status").alias("status"))
    order = Window.orderBy("processed_rows")
    return steps.select((F.row_number().over(order) - 1).cast("long").alias("step"), "last_processed_id",
                        "processed_rows", "status")


@query("f11_second_backfill", """
    SELECT o_orderkey AS id, o_custkey AS customer, o_totalprice + 1 AS price,
           date_trunc('second', o_orderdate) AS placed, 'backfill' AS origin, CAST(0 AS BIGINT) AS ver FROM orders""")
def f11_second_backfill(spark: SparkSession, sf: str) -> DataFrame:
    """A table copied again after it changed, then compacted: of rows of one version the last copied counts."""
    folder = scratch_path(spark, "copy")
    jobs = BackfillJobs(spark, f"{folder}/log", ORDER_RULES)
    orders = table(spark, sf, "orders")
    for source in (orders, orders.withColumn("o_totalprice", F.col("o_totalprice") + 1)):
        job = jobs.start("orders", source, "o_orderkey")
        jobs.copy_pages(job["job_id"], source, f"{folder}/replica", {"order_facts": ORDER_FACTS})
    compact(spark, f"{folder}/replica", "order_facts", ORDER_FACTS, ["id"])
    return current_rows(spark, f"{folder}/replica", "order_facts", ORDER_FACTS, ["id"])


@query("f6_copied", f"""
    SELECT o_orderkey AS id, o_totalprice AS price FROM orders
    WHERE o_orderkey NOT IN (SELECT id FROM ({FEED_SQL}) WHERE op <> 'delete')""")
def f6_copied(spark: SparkSession, sf: str) -> DataFrame:
    """A copy by id windows through the rules, without the ids the feed has touched."""
    folder = scratch_path(spark, "windows")
    copy_by_windows(table(spark, sf, "orders"), "orders", "o_orderkey", ORDER_RULES, origin="windows", batch=5000,
                    stage_dir=f"{folder}/stage", replica_dir=f"{folder}/replica", schemas={"order_facts": ORDER_FACTS},
                    changes=live_changes(feed(spark, sf)), change_key="id")
    return read_replica(spark, f"{folder}/replica", "order_facts", ORDER_FACTS).select("id", "price")
