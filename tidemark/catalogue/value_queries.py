"""Value conversions, wire rows and destination types: V and K queries without files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.catalogue.registry import query
from tidemark.catalogue.tables import FEED_SQL, feed, table
from tidemark.functions.convert import convert_record, snapshot_record, to_json_rows
from tidemark.operators.batches import assign_batches, load_report, partition_by_table
from tidemark.operators.conform import conform, split_conform
from tidemark.operators.timed import assign_timed_batches


@query("v_convert_events", """
    SELECT CAST(event_id AS VARCHAR) AS event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ts,
           CAST(user_id AS VARCHAR) AS user_id, event_type, CAST(value AS VARCHAR) AS value,
           strftime(ts, '%Y-%m-%d') AS day, props FROM events""")
def v_convert_events(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").withColumns({
        "day": F.col("ts").cast("date"), "ts": F.col("ts").cast("timestamp")})
    return convert_record(rows)


@query("v_convert_orders", """
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
           o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority FROM orders""")
def v_convert_orders(spark: SparkSession, sf: str) -> DataFrame:
    return convert_record(table(spark, sf, "orders"))


@query("v_convert_lineitem", """
    SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
           CAST(l_extendedprice AS VARCHAR) AS l_extendedprice, l_returnflag,
           strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate FROM lineitem""")
def v_convert_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return convert_record(table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_shipdate"))


@query("v12_catch_all", """
    SELECT CAST(event_id AS VARCHAR) AS event_id, hex(encode(event_type)) AS kind FROM events""")
def v12_catch_all(spark: SparkSession, sf: str) -> DataFrame:
    """A type no rule names, binary here, passes unchanged."""
    rows = table(spark, sf, "events").select("event_id", F.encode("event_type", "UTF-8").alias("kind"))
    return convert_record(rows).withColumn("kind", F.hex("kind"))


@query("v8_decimal_bool", """
    SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
           l_quantity AS quantity, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS returned
    FROM lineitem""")
def v8_decimal_bool(spark: SparkSession, sf: str) -> DataFrame:
    return convert_record(table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").cast("decimal(12,2)").alias("quantity"),
        (F.col("l_returnflag") == "R").alias("returned")))


@query("v9_objects", """
    SELECT CAST(user_id AS VARCHAR) AS user_id,
           '{"event":"' || event_type || '","id":' || event_id || ',"gone":null}' AS object
    FROM events""")
def v9_objects(spark: SparkSession, sf: str) -> DataFrame:
    return convert_record(table(spark, sf, "events").select(
        "user_id",
        F.struct(F.col("event_type").alias("event"), F.col("event_id").alias("id"),
                 F.lit(None).cast("string").alias("gone")).alias("object")))


@query("v10_lists", """
    SELECT CAST(vec_id AS VARCHAR) AS vec_id,
           array_to_string(list_transform(embedding, lambda x: CAST(CAST(round(CAST(x AS DOUBLE) * 1000) AS INTEGER) AS VARCHAR)), ',') AS parts,
           list_count(embedding) + 1 AS items
    FROM embeddings""")
def v10_lists(spark: SparkSession, sf: str) -> DataFrame:
    parts = F.transform("embedding", lambda x: F.round(x.cast("double") * 1000).cast("int"))
    with_null = F.concat(parts, F.array(F.lit(None).cast("int")))
    wire = convert_record(table(spark, sf, "embeddings").select("vec_id", with_null.alias("parts")))
    return wire.select("vec_id", F.array_join("parts", ",").alias("parts"),
                       F.size("parts").cast("long").alias("items"))


@query("v13_snapshot", """
    SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate
    FROM orders""")
def v13_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return snapshot_record(table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderdate"))


@query("k3_json_rows", """
    SELECT event_id, CAST(CASE WHEN event_type = 'error'
        THEN to_json({'user_id': CAST(user_id AS VARCHAR), 'value': CAST(value AS VARCHAR), 'props': props})
        ELSE to_json({'user_id': CAST(user_id AS VARCHAR), 'kind': event_type,
                      'value': CAST(value AS VARCHAR), 'props': props}) END AS VARCHAR) AS value
    FROM events""")
def k3_json_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").select(
        "event_id", "user_id", F.when(F.col("event_type") != "error", F.col("event_type")).alias("kind"),
        "value", "props")
    return to_json_rows(convert_record(rows, keep=("event_id",)), keep=("event_id",))


@query("k3_json_lineitem", """
    SELECT l_orderkey, l_linenumber, CAST(to_json({
        'l_partkey': CAST(l_partkey AS VARCHAR), 'l_quantity': CAST(l_quantity AS VARCHAR),
        'l_extendedprice': CAST(l_extendedprice AS VARCHAR), 'l_discount': CAST(l_discount AS VARCHAR),
        'l_returnflag': l_returnflag, 'l_shipdate': strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')}) AS VARCHAR) AS value
    FROM lineitem""")
def k3_json_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    keys = ("l_orderkey", "l_linenumber")
    rows = table(spark, sf, "lineitem").select(
        *keys, "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate")
    return to_json_rows(convert_record(rows, keep=keys), keep=keys)


@query("k3_json_documents", """
    SELECT doc_id, text, lang, CAST(n_chars AS VARCHAR) AS n_chars FROM documents""")
def k3_json_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts through the wire format and back."""
    rows = table(spark, sf, "documents").select("doc_id", "text", "lang", "n_chars")
    wire = to_json_rows(convert_record(rows, keep=("doc_id",)), keep=("doc_id",))
    back = F.from_json("value", "text STRING, lang STRING, n_chars STRING")
    return wire.select("doc_id", back.alias("r")).select("doc_id", "r.*")


ORDER_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType(), False),
    T.StructField("o_totalprice", T.DoubleType(), False),
    T.StructField("o_orderdate", T.TimestampNTZType(), False),
    T.StructField("o_orderpriority", T.StringType(), True),
    T.StructField("o_comment", T.StringType(), False),
    T.StructField("is_active", T.ShortType(), False),
    T.StructField("ver", T.LongType(), False),
])


@query("k5_conform", """
    SELECT o_orderkey, o_totalprice, date_trunc('second', o_orderdate) AS o_orderdate,
           CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS o_orderpriority,
           '' AS o_comment, CAST(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS SMALLINT) AS is_active,
           CAST(0 AS BIGINT) AS ver FROM orders""")
def k5_conform(spark: SparkSession, sf: str) -> DataFrame:
    status = F.col("o_orderstatus")
    rows = table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderdate",
        F.when(status != "P", F.col("o_orderpriority")).alias("o_orderpriority"),
        F.when(status == "F", F.lit(False)).alias("is_active"))
    return conform(convert_record(rows), ORDER_SCHEMA, {"is_active": 1})


@query("k5_misfits", """
    SELECT event_id, 'value' AS bad_columns FROM events WHERE event_type = 'error'""")
def k5_misfits(spark: SparkSession, sf: str) -> DataFrame:
    value = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("value").cast("string"))
    rows = table(spark, sf, "events").select("event_id", value.alias("value"))
    schema = T.StructType.fromDDL("event_id BIGINT NOT NULL, value DOUBLE")
    return split_conform(rows, schema)[1].select("event_id", F.array_join("bad_columns", ",").alias("bad_columns"))


_BATCHES_SQL = f"""
    SELECT source_table, 'activity' AS dest_table, seq, id,
           (row_number() OVER (PARTITION BY source_table ORDER BY seq) - 1) // 500 AS batch_id
    FROM ({FEED_SQL})"""


def _batches(spark: SparkSession, sf: str) -> DataFrame:
    rows = feed(spark, sf).select("source_table", F.lit("activity").alias("dest_table"), "seq", "id")
    return assign_batches(rows, size=500)


@query("b1_batches", _BATCHES_SQL)
def b1_batches(spark: SparkSession, sf: str) -> DataFrame:
    return _batches(spark, sf)


@query("b1_timed_batches", f"""
    WITH RECURSIVE r AS (
        SELECT source_table, seq, row_number() OVER (PARTITION BY source_table ORDER BY seq) - 1 AS p,
               max(epoch_ms(ts)) OVER (PARTITION BY source_table ORDER BY seq) AS t FROM ({FEED_SQL})),
    link AS (
        SELECT source_table, p, least(p + 25, count(*) OVER (
                   PARTITION BY source_table ORDER BY t RANGE BETWEEN UNBOUNDED PRECEDING AND 599999 FOLLOWING)) AS q FROM r),
    chain AS (
        SELECT DISTINCT source_table, CAST(0 AS BIGINT) AS p, CAST(0 AS BIGINT) AS batch_id FROM r
        UNION ALL SELECT c.source_table, l.q, c.batch_id + 1 FROM chain c JOIN link l ON l.source_table = c.source_table AND l.p = c.p),
    begun AS (SELECT r.source_table, r.seq, r.p, c.batch_id FROM r LEFT JOIN chain c ON c.source_table = r.source_table AND c.p = r.p)
    SELECT source_table, seq, max(batch_id) OVER (PARTITION BY source_table ORDER BY p) AS batch_id FROM begun""")
def b1_timed_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Batches of at most 25 rows and less than ten minutes."""
    return assign_timed_batches(feed(spark, sf), 25, 600_000, group=("source_table",)).select("source_table", "seq", "batch_id")


@query("b2_partitions", f"""
    SELECT source_table, id, count(*) AS rows, 1 AS partitions, max(seq) AS last_seq
    FROM ({FEED_SQL}) GROUP BY ALL""")
def b2_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """Each key of a table sits in one partition, its newest change last."""
    spread = partition_by_table(feed(spark, sf).select("source_table", "id", "seq"), key="id")
    placed = spread.select("*", F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("n"))
    return placed.groupBy("source_table", "id").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("p").cast("int").alias("partitions"),
        F.max_by("seq", "n").alias("last_seq"))


@query("k4_report", f"""
    SELECT source_table, dest_table, batch_id, arg_min(id, seq) AS first_id, count(*) AS rows,
           string_agg(CAST(id AS VARCHAR), ',' ORDER BY seq) AS ids
    FROM ({_BATCHES_SQL}) GROUP BY ALL""")
def k4_report(spark: SparkSession, sf: str) -> DataFrame:
    return load_report(_batches(spark, sf), with_ids=True, by=("source_table", "dest_table", "batch_id"))


@query("k4_report_no_key", f"""
    SELECT dest_table, batch_id, CAST(NULL AS VARCHAR) AS first_id, count(*) AS rows, '-' AS ids
    FROM ({_BATCHES_SQL}) GROUP BY ALL""")
def k4_report_no_key(spark: SparkSession, sf: str) -> DataFrame:
    return load_report(_batches(spark, sf).drop("id"), with_ids=True)
