"""Sources, filters, routing, versions: S, T and R queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.catalogue.registry import query
from tidemark.catalogue.tables import (ACTIVITY_SQL, EVENTS_SCHEMA, FEED_SQL, MESSAGES_SQL, RULES,
                                       feed, feed_tables, messages, table)
from tidemark.operators.changes import filter_mapped, live_changes, stamp_version, tombstones
from tidemark.operators.rate import event_rate, with_commit_time
from tidemark.operators.replica import exclude_live, latest_state, merge_snapshot, refresh_keys
from tidemark.operators.route import (register_script, reject_counts, rejects, remap, route,
                                      route_rejects, split_rejects)
from tidemark.session import scratch_path
from tidemark.sources.feed import decode_envelope, read_changes
from tidemark.sources.mapping import Entry, Mapping
from tidemark.sources.snapshot import scan_source
from tidemark.sources.transactions import (assemble_transactions, committed_changes, numbered_operations,
                                           project_operation)
from tidemark.streaming.replicate import wire_changes
from tidemark.streaming.transactions import assemble_stream, emitted_operations, open_messages


@query("s1_rules", f"""
    SELECT r.source_table, r.dest_table, r.topic, f.n AS rows
    FROM (VALUES ('signup', 'accounts', 'accounts'), ('click', 'activity', 'activity'),
                 ('view', 'activity', 'activity'), ('purchase', 'purchases', NULL),
                 ('purchase', 'activity', NULL)) r(source_table, dest_table, topic)
    JOIN (SELECT source_table, count(*) AS n FROM ({FEED_SQL}) GROUP BY 1) f
      ON f.source_table = r.source_table""")
def s1_rules(spark: SparkSession, sf: str) -> DataFrame:
    counts = feed(spark, sf).groupBy("source_table").agg(F.count(F.lit(1)).alias("rows"))
    return RULES.frame(spark).select("source_table", "dest_table", "topic").join(counts, "source_table")


@query("s2_tables", f"""
    SELECT source_table, count(*) AS rows FROM ({FEED_SQL})
    WHERE source_table IN ('signup', 'click', 'view', 'purchase') GROUP BY 1""")
def s2_tables(spark: SparkSession, sf: str) -> DataFrame:
    wanted = RULES.frame(spark).select("source_table").distinct()
    counts = feed(spark, sf).groupBy("source_table").agg(F.count(F.lit(1)).alias("rows"))
    return counts.join(wanted, "source_table", "left_semi")


@query("s2_by_topic", f"SELECT seq, id, value FROM ({FEED_SQL}) WHERE source_table = 'click'")
def s2_by_topic(spark: SparkSession, sf: str) -> DataFrame:
    rule = RULES.by_topic("activity")
    return feed(spark, sf).filter(F.col("source_table") == rule.source_table).select("seq", "id", "value")


@query("s3_changes", """
    SELECT event_id, event_type, user_id, value FROM events
    WHERE event_id > 99 AND event_type IN ('signup', 'purchase')""")
def s3_changes(spark: SparkSession, sf: str) -> DataFrame:
    return read_changes(spark, f"{sf}/events.parquet", EVENTS_SCHEMA, start_after=99,
                        tables=["signup", "purchase"], seq="event_id", table="event_type") \
        .select("event_id", "event_type", "user_id", "value")


@query("s4_envelope", f"""
    SELECT xid, seq, date_trunc('millisecond', ts) AS commit_ts,
           CASE event_type WHEN 'view' THEN 'insert' ELSE op END AS op,
           source_table, id AS key, event_type, value
    FROM ({FEED_SQL})""")
def s4_envelope(spark: SparkSession, sf: str) -> DataFrame:
    row = F.struct("id", "event_type", "value")
    gone = F.col("op") == "delete"
    code = (F.when(F.col("event_type") == "view", "r").when(F.col("op") == "insert", "c")
            .when(gone, "d").otherwise("u"))
    source = F.struct(F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"),
                      F.col("source_table").alias("table"),
                      F.col("xid").alias("txId"), F.col("seq").alias("lsn"))
    envelopes = feed(spark, sf).select(F.to_json(F.struct(
        F.when(gone, row).alias("before"), F.when(~gone, row).alias("after"),
        source.alias("source"), code.alias("op"))).alias("value"))
    record = T.StructType.fromDDL("id BIGINT, event_type STRING, value DOUBLE")
    return decode_envelope(envelopes, record, key="id") \
        .withColumn("commit_ts", F.col("commit_ts").cast("timestamp_ntz")) \
        .select("xid", "seq", "commit_ts", "op", "source_table", "key",
                "record.event_type", "record.value")


_HEADS_SQL = f"""
    SELECT b.xid, b.lsn, c.end_lsn, b.seq AS b, c.seq AS c
    FROM (SELECT * FROM ({MESSAGES_SQL}) WHERE kind = 'begin') b
    JOIN (SELECT * FROM ({MESSAGES_SQL}) WHERE kind = 'commit') c ON b.xid = c.xid AND b.lsn = c.lsn"""


@query("s5_committed", f"""
    SELECT m.xid, m.seq, m.kind, h.lsn, h.end_lsn FROM ({MESSAGES_SQL}) m
    JOIN ({_HEADS_SQL}) h ON m.xid = h.xid
    WHERE m.kind IN ('insert', 'update', 'delete') AND m.seq > h.b AND m.seq < h.c""")
def s5_committed(spark: SparkSession, sf: str) -> DataFrame:
    return committed_changes(messages(spark, sf)).select("xid", "seq", "kind", "lsn", "end_lsn")


@query("s5_transactions", f"""
    SELECT m.xid, h.lsn, h.end_lsn, m.kind, row_number() OVER (PARTITION BY m.xid ORDER BY m.seq) - 1 AS op_no,
           count(*) OVER (PARTITION BY m.xid) AS operations
    FROM ({MESSAGES_SQL}) m JOIN ({_HEADS_SQL}) h ON m.xid = h.xid
    WHERE m.kind IN ('insert', 'update', 'delete') AND m.seq > h.b AND m.seq < h.c""")
def s5_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return numbered_operations(messages(spark, sf)).select("xid", "lsn", "end_lsn", "kind", "op_no", "operations")


@query("s5_transaction_lists", f"""
    SELECT xid, any_value(lsn) AS lsn, any_value(end_lsn) AS end_lsn, op_no // 2 AS part, any_value(operations) AS operations,
           string_agg(kind, ',' ORDER BY op_no) AS ops
    FROM (SELECT m.xid, h.lsn, h.end_lsn, m.kind, row_number() OVER (PARTITION BY m.xid ORDER BY m.seq) - 1 AS op_no,
                 count(*) OVER (PARTITION BY m.xid) AS operations
          FROM ({MESSAGES_SQL}) m JOIN ({_HEADS_SQL}) h ON m.xid = h.xid
          WHERE m.kind IN ('insert', 'update', 'delete') AND m.seq > h.b AND m.seq < h.c)
    GROUP BY xid, op_no // 2""")
def s5_transaction_lists(spark: SparkSession, sf: str) -> DataFrame:
    return assemble_transactions(messages(spark, sf), 2).withColumn("ops", F.array_join("ops", ","))


# The numbered operations of all committed transactions, as s5_transactions has them.
_NUMBERED_SQL = f"""
    SELECT m.xid, h.lsn, h.end_lsn, m.kind, row_number() OVER (PARTITION BY m.xid ORDER BY m.seq) - 1 AS op_no,
           count(*) OVER (PARTITION BY m.xid) AS operations
    FROM ({MESSAGES_SQL}) m JOIN ({_HEADS_SQL}) h ON m.xid = h.xid
    WHERE m.kind IN ('insert', 'update', 'delete') AND m.seq > h.b AND m.seq < h.c"""


@query("stream_transactions", _NUMBERED_SQL + f"""
    UNION ALL SELECT -1, NULL, NULL, 'open', NULL, count(*) FROM ({MESSAGES_SQL}) m
    WHERE NOT EXISTS (SELECT 1 FROM ({_HEADS_SQL}) h WHERE h.xid = m.xid)""")
def stream_transactions(spark: SparkSession, sf: str) -> DataFrame:
    """The log landed in files that cut transactions, each file a micro-batch, with a restart between;
    one row more tells how many messages are still open."""
    folder = scratch_path(spark, "log")
    log = messages(spark, sf)
    parts, last = 4, log.agg(F.max("seq")).first()[0] or 0
    schema = log.schema
    for k in range(parts):
        here = F.col("seq").between(k * last // parts + (k > 0), (k + 1) * last // parts)
        log.filter(here).coalesce(1).write.mode("append").parquet(f"{folder}/log")
        if k in (1, parts - 1):
            stream = read_changes(spark, f"{folder}/log", schema, streaming=True, max_files=1)
            assemble_stream(stream, f"{folder}/out", f"{folder}/store", f"{folder}/checkpoint", compact_every=2,
                            available_now=True).awaitTermination()
    waiting = open_messages(spark, f"{folder}/store", schema).agg(F.count(F.lit(1)).alias("operations")).select(
        F.lit(-1).cast("long").alias("xid"), F.lit(None).cast("long").alias("lsn"), F.lit(None).cast("long").alias("end_lsn"),
        F.lit("open").alias("kind"), F.lit(None).cast("long").alias("op_no"), "operations")
    return emitted_operations(spark, f"{folder}/out").select(
        "xid", "lsn", "end_lsn", "kind", "op_no", "operations").unionByName(waiting)


@query("s6_casts", f"""
    WITH f AS (SELECT seq, op, CAST(id AS VARCHAR) AS id,
                      CASE WHEN seq % 7 = 0 THEN event_type ELSE CAST(value AS VARCHAR) END AS v, value
               FROM ({FEED_SQL}))
    SELECT seq, op,
           CASE WHEN op <> 'delete' THEN CAST(id AS BIGINT) END AS new_id,
           CASE WHEN op <> 'delete' THEN TRY_CAST(v AS DOUBLE) END AS new_value,
           CASE WHEN op <> 'insert' THEN CAST(id AS BIGINT) - 1 END AS old_id,
           CASE WHEN op <> 'insert' AND seq % 5 <> 0 THEN value * 2 END AS old_value,
           CASE WHEN op <> 'delete' AND TRY_CAST(v AS DOUBLE) IS NULL THEN v END AS raw_value
    FROM f""")
def s6_casts(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(F.col("seq") % 7 == 0, F.col("event_type")).otherwise(F.col("value").cast("string"))
    data = F.array(F.col("id").cast("string"), text)
    # The old row had another id and value, and one in five a text where the value was.
    before = F.when(F.col("seq") % 5 == 0, "none").otherwise((F.col("value") * 2).cast("string"))
    old = F.array((F.col("id") - 1).cast("string"), before)
    ops = feed(spark, sf).select("seq", "op", data.alias("data"), old.alias("old_data"))
    typed = project_operation(ops, {"id": "bigint", "value": "double"})
    return typed.select("seq", "op", F.col("record.id").alias("new_id"),
                        F.col("record.value").alias("new_value"),
                        F.col("old_record.id").alias("old_id"),
                        F.col("old_record.value").alias("old_value"),
                        F.col("_rescued")["value"].alias("raw_value"))


@query("s7_scan", """
    SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem WHERE l_quantity > 45""")
def s7_scan(spark: SparkSession, sf: str) -> DataFrame:
    return scan_source(spark, f"{sf}/lineitem.parquet", "SELECT l_orderkey, l_linenumber, l_shipdate",
                       "WHERE l_quantity > 45")


@query("t1_mapped", f"""
    SELECT seq, source_table, op FROM ({FEED_SQL}) WHERE source_table <> 'error'""")
def t1_mapped(spark: SparkSession, sf: str) -> DataFrame:
    return filter_mapped(feed(spark, sf), RULES).select("seq", "source_table", "op")


@query("t2_live", f"SELECT seq, op, id FROM ({FEED_SQL}) WHERE op IN ('insert', 'update')")
def t2_live(spark: SparkSession, sf: str) -> DataFrame:
    return live_changes(feed(spark, sf)).select("seq", "op", "id")


@query("t3_versions", f"SELECT seq, id, seq + 1 AS ver FROM ({FEED_SQL}) WHERE op <> 'delete'")
def t3_versions(spark: SparkSession, sf: str) -> DataFrame:
    return stamp_version(live_changes(feed(spark, sf))).select("seq", "id", "ver")


PART_RULE = Entry("part", "products", remap={
    "id": "{p_partkey}", "name": "part {p_name}", "brand": "{p_brand}", "price": "{p_retailprice}",
    "origin": "warehouse", "code": "{p_brand}-{p_type}", "rank": 7, "missing": "{no_such_column}",
})


@query("t4_remap", """
    SELECT p_partkey AS id, 'part ' || p_name AS name, p_brand AS brand, p_retailprice AS price,
           'warehouse' AS origin, '{p_brand}-{p_type}' AS code, 7 AS rank,
           CAST(NULL AS VARCHAR) AS missing, CAST(0 AS BIGINT) AS ver FROM part""")
def t4_remap(spark: SparkSession, sf: str) -> DataFrame:
    return remap(table(spark, sf, "part"), PART_RULE)


@query("t5_identity", "SELECT * FROM supplier")
def t5_identity(spark: SparkSession, sf: str) -> DataFrame:
    return remap(table(spark, sf, "supplier"), Entry("supplier", "supplier"))


@query("t5_empty_remap", "SELECT CAST(0 AS BIGINT) AS ver FROM supplier")
def t5_empty_remap(spark: SparkSession, sf: str) -> DataFrame:
    return remap(table(spark, sf, "supplier"), Entry("supplier", "supplier", remap={}))


@query("t6_fanout", f"""
    SELECT 'purchases' AS dest, id, seq + 1 AS ver, CAST(NULL AS INTEGER) AS weight
    FROM ({FEED_SQL}) WHERE source_table = 'purchase'
    UNION ALL
    SELECT 'activity', id, seq + 1, 5 FROM ({FEED_SQL}) WHERE source_table = 'purchase'""")
def t6_fanout(spark: SparkSession, sf: str) -> DataFrame:
    rows = feed_tables(feed(spark, sf))
    routed = route({"purchase": rows["purchase"]}, RULES)
    return (
        routed["purchases"].select(F.lit("purchases").alias("dest"), "id", "ver",
                                   F.lit(None).cast("int").alias("weight"))
        .unionByName(routed["activity"].select(F.lit("activity").alias("dest"), "id", "ver", "weight"))
    )


PARTY_RULES = Mapping.from_dicts([
    {"source_table": "customer", "dest_table": "parties",
     "remap": {"id": "{c_custkey}", "source": "customer", "name": "{c_name}",
               "nation": "{c_nationkey}", "segment": "{c_mktsegment}"}},
    {"source_table": "supplier", "dest_table": "parties",
     "remap": {"id": "{s_suppkey}", "source": "supplier", "name": "{s_name}",
               "nation": "{s_nationkey}"}},
])


@query("t6_fanin", """
    SELECT c_custkey AS id, 'customer' AS source, c_name AS name, c_nationkey AS nation,
           c_mktsegment AS segment, CAST(0 AS BIGINT) AS ver FROM customer
    UNION ALL
    SELECT s_suppkey, 'supplier', s_name, s_nationkey, NULL, 0 FROM supplier""")
def t6_fanin(spark: SparkSession, sf: str) -> DataFrame:
    return route({t: table(spark, sf, t) for t in PARTY_RULES.distinct_tables()}, PARTY_RULES)["parties"]


@query("t6_route", ACTIVITY_SQL)
def t6_route(spark: SparkSession, sf: str) -> DataFrame:
    return route(feed_tables(feed(spark, sf)), RULES)["activity"]


def big_spenders(rows: DataFrame) -> DataFrame:
    return rows.groupBy("id").agg(F.sum(F.round(F.col("value") * 100).cast("long")).alias("cents"))


@query("t7_script", f"""
    SELECT id, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
    FROM ({FEED_SQL}) WHERE source_table = 'purchase' GROUP BY id""")
def t7_script(spark: SparkSession, sf: str) -> DataFrame:
    register_script("Shop.spenders", big_spenders)
    rules = Mapping.from_dicts([{"source_table": "purchase", "dest_table": "spenders",
                                 "script": {"module": "Shop", "function": "spenders"}}])
    return route({"purchase": feed_tables(feed(spark, sf))["purchase"]}, rules)["spenders"]


@query("t8_tombstones", f"""
    SELECT id, 'accounts' AS dest_table, ts AS deleted_at, seq + 1 AS ver
    FROM ({FEED_SQL}) WHERE op = 'delete'""")
def t8_tombstones(spark: SparkSession, sf: str) -> DataFrame:
    rules = Mapping.from_dicts([{"source_table": "error", "dest_table": "accounts"}])
    return tombstones(feed(spark, sf), "accounts", rules, deleted_at="ts") \
        .select("id", "dest_table", "deleted_at", "ver")


# Events without a large value have no note to put into the text.
NOTE_RULE = Entry("events", "notes", remap={"id": "{id}", "text": "note {note}"})


def _noted(spark: SparkSession, sf: str) -> DataFrame:
    return feed(spark, sf).withColumn("note", F.when(F.col("value") > 100, F.col("event_type")))


@query("t9_good", f"""
    SELECT id, 'note ' || event_type AS text, CAST(0 AS BIGINT) AS ver
    FROM ({FEED_SQL}) WHERE value > 100""")
def t9_good(spark: SparkSession, sf: str) -> DataFrame:
    return split_rejects(_noted(spark, sf), NOTE_RULE)[0]


@query("t9_rejects", f"""
    SELECT seq, 'text: note is null' AS reject_reason FROM ({FEED_SQL})
    WHERE value IS NULL OR value <= 100""")
def t9_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return split_rejects(_noted(spark, sf), NOTE_RULE)[1].select("seq", "reject_reason")


@query("t9_reject_counts", f"""
    SELECT CASE WHEN value IS NULL OR value <= 100 THEN 'text: note is null'
                ELSE 'amount: value is not text' END AS reject_reason, count(*) AS rows
    FROM ({FEED_SQL}) GROUP BY 1""")
def t9_reject_counts(spark: SparkSession, sf: str) -> DataFrame:
    unfit = Entry("events", "amounts", remap={"amount": "USD {value}"})
    return reject_counts(rejects(_noted(spark, sf), [NOTE_RULE, unfit]))


@query("t9_route_rejects", f"""
    SELECT source_table, 'text: note is null' AS reject_reason, CAST(id AS VARCHAR) AS id,
           CAST(value AS VARCHAR) AS value
    FROM ({FEED_SQL}) WHERE source_table <> 'error' AND op <> 'delete' AND (value IS NULL OR value <= 100)""")
def t9_route_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Rejected rows of all mapped tables, which share a destination."""
    rows = feed_tables(_noted(spark, sf))
    rules = Mapping([Entry(t, "notes", remap=NOTE_RULE.remap) for t in rows])
    rejected = route_rejects(rows, rules)
    back = F.from_json("value", "id STRING, value STRING")
    return rejected.select("source_table", "reject_reason", back.alias("r")) \
        .select("source_table", "reject_reason", "r.*")


@query("t6_one_pass", f"""
    SELECT dest_table, count(*) AS rows FROM (
        SELECT 'accounts' AS dest_table FROM ({FEED_SQL}) WHERE source_table = 'signup' AND op <> 'delete'
        UNION ALL SELECT 'activity' FROM ({FEED_SQL}) WHERE source_table IN ('click', 'view', 'purchase') AND op <> 'delete'
        UNION ALL SELECT 'purchases' FROM ({FEED_SQL}) WHERE source_table = 'purchase' AND op <> 'delete') GROUP BY 1""")
def t6_one_pass(spark: SparkSession, sf: str) -> DataFrame:
    """All rules in one scan of the feed: what each destination is sent."""
    changes = feed(spark, sf).select("seq", "op", "source_table", F.struct("id", "event_type", "value", "props").alias("record"))
    return wire_changes(changes, RULES).groupBy("dest_table").agg(F.count(F.lit(1)).alias("rows"))


@query("t3_versions_by_time", f"""
    SELECT seq, id, epoch_us(ts) * 1000 AS ver FROM ({FEED_SQL}) WHERE op <> 'delete'""")
def t3_versions_by_time(spark: SparkSession, sf: str) -> DataFrame:
    return stamp_version(live_changes(feed(spark, sf)), by="commit_ts", commit_ts="ts").select("seq", "id", "ver")


LATEST = "row_number() OVER (PARTITION BY id ORDER BY ver DESC, seq DESC) = 1"


@query("r1_latest_state", f"""
    SELECT id, seq, event_type, value, ver
    FROM (SELECT *, seq + 1 AS ver FROM ({FEED_SQL}) WHERE op <> 'delete') QUALIFY {LATEST}""")
def r1_latest_state(spark: SparkSession, sf: str) -> DataFrame:
    changes = stamp_version(live_changes(feed(spark, sf))).select("id", "seq", "event_type", "value", "ver")
    return latest_state(changes, ["id"])


@query("r2_current", f"""
    SELECT id, seq, event_type, value FROM (
        SELECT * FROM (SELECT *, seq + 1 AS ver FROM ({FEED_SQL})) QUALIFY {LATEST})
    WHERE op <> 'delete'""")
def r2_current(spark: SparkSession, sf: str) -> DataFrame:
    changes = feed(spark, sf).select("id", "seq", "op", "event_type", "value", "ts")
    gone = tombstones(changes, "accounts", deleted_at="ts").drop("dest_table")
    versions = stamp_version(live_changes(changes)).unionByName(gone, allowMissingColumns=True)
    return latest_state(versions, ["id"], deleted="deleted_at").select("id", "seq", "event_type", "value")


SNAPSHOT_MERGE_SQL = f"""
    SELECT id, name, balance, event_type, value, ver, seq FROM (
        SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, NULL AS event_type,
               NULL AS value, CAST(0 AS BIGINT) AS ver, CAST(-1 AS BIGINT) AS seq FROM customer
        UNION ALL
        SELECT id, NULL, NULL, event_type, value, seq + 1, seq FROM ({FEED_SQL})
        WHERE op <> 'delete') QUALIFY {LATEST}"""


@query("r3_snapshot_merge", SNAPSHOT_MERGE_SQL)
def r3_snapshot_merge(spark: SparkSession, sf: str) -> DataFrame:
    snapshot = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    changes = stamp_version(live_changes(feed(spark, sf))).select("id", "event_type", "value", "ver", "seq")
    return merge_snapshot(snapshot, changes, ["id"])


@query("r3_orders_merge", f"""
    SELECT id, customer, price, event_type, value, ver, seq FROM (
        SELECT o_orderkey AS id, o_custkey AS customer, o_totalprice AS price, NULL AS event_type,
               NULL AS value, CAST(0 AS BIGINT) AS ver, CAST(-1 AS BIGINT) AS seq FROM orders
        UNION ALL
        SELECT id, NULL, NULL, event_type, value, seq + 1, seq FROM ({FEED_SQL})
        WHERE op <> 'delete') QUALIFY {LATEST}""")
def r3_orders_merge(spark: SparkSession, sf: str) -> DataFrame:
    snapshot = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer"), F.col("o_totalprice").alias("price"))
    changes = stamp_version(live_changes(feed(spark, sf))).select("id", "event_type", "value", "ver", "seq")
    return merge_snapshot(snapshot, changes, ["id"])


@query("r4_exclude_live", f"""
    SELECT c_custkey, c_name FROM customer
    WHERE c_custkey NOT IN (SELECT id FROM ({FEED_SQL}) WHERE op <> 'delete')""")
def r4_exclude_live(spark: SparkSession, sf: str) -> DataFrame:
    snapshot = table(spark, sf, "customer").select("c_custkey", "c_name")
    return exclude_live(snapshot, live_changes(feed(spark, sf)), "c_custkey", "id")


@query("r5_event_rate", f"""
    SELECT date_trunc('minute', cts) AS created_at, count(*) AS total
    FROM (SELECT xid, max(ts) AS cts FROM ({FEED_SQL}) GROUP BY xid) GROUP BY 1""")
def r5_event_rate(spark: SparkSession, sf: str) -> DataFrame:
    return event_rate(feed(spark, sf))


@query("r5_commit_times", f"""
    SELECT seq, xid, max(ts) OVER (PARTITION BY xid) AS commit_ts FROM ({FEED_SQL})""")
def r5_commit_times(spark: SparkSession, sf: str) -> DataFrame:
    return with_commit_time(feed(spark, sf)).select("seq", "xid", "commit_ts")


@query("r6_refresh", f"""
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)
      AND o_orderkey NOT IN (SELECT id FROM ({FEED_SQL}) WHERE op <> 'delete')""")
def r6_refresh(spark: SparkSession, sf: str) -> DataFrame:
    ids = table(spark, sf, "lineitem").filter("l_quantity > 45").select("l_orderkey")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return refresh_keys(orders, ids, "o_orderkey", live_changes(feed(spark, sf)), "id")
