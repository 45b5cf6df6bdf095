import datetime as dt
import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.keys import find_key, primary_key, profile_keys, screen_keys
from tidemark.sources.feed import decode_envelope, read_changes, table_changes
from tidemark.sources.snapshot import jdbc_windows, scan_source
from tidemark.sources.transactions import (assemble_transactions, committed_changes, numbered_operations,
                                           project_operation)


def envelope(op, before=None, after=None, table="customers"):
    return json.dumps({"before": before, "after": after, "op": op, "ts_ms": 7,
                       "source": {"version": "x", "table": table, "txId": 555, "lsn": 24, "xmin": None,
                                  "ts_ms": 1559033904863, "sequence": "[1]"}})


def test_envelope_operations(spark):
    row = {"id": 1, "email": "a@b.c"}
    old = {"id": 1, "email": None}
    texts = [envelope("c", None, row), envelope("r", None, row), envelope("u", old, row),
             envelope("d", row), envelope("t"), "not json"]
    schema = T.StructType.fromDDL("id INT, email STRING")
    got = decode_envelope(spark.createDataFrame([(t,) for t in texts], "value STRING"), schema, key="id").collect()
    assert [r["op"] for r in got] == ["insert", "insert", "update", "delete", "other", "other"]
    assert [r["record"]["email"] if r["record"] else None for r in got] == ["a@b.c"] * 4 + [None] * 2
    first = got[0].asDict()
    assert (first["xid"], first["seq"], first["source_table"], first["key"]) == (555, 24, "customers", 1)
    assert first["commit_ts"] == dt.datetime(2019, 5, 28, 8, 58, 24, 863000)


def test_text_that_cannot_be_read_is_kept(spark):
    row = T.StructType.fromDDL("id INT, email STRING")
    texts = [envelope("c", after={"id": 1}), envelope("c", after={"id": "abc"}), "not json", '{"op": "c"}']
    got = decode_envelope(spark.createDataFrame([(t,) for t in texts], "value STRING"), row).collect()
    assert [r["corrupt"] for r in got] == [None, *texts[1:]]


def test_table_changes_flattens_structs_and_text(spark):
    changes = spark.createDataFrame(
        [("insert", 1, "a", (1, "x")), ("insert", 2, "b", (2, "y"))],
        "op STRING, seq BIGINT, source_table STRING, record STRUCT<id: INT, v: STRING>")
    want = [("insert", 1, 1, "x")]
    assert [tuple(r) for r in table_changes(changes, "a").collect()] == want
    text = changes.withColumn("record", F.to_json("record"))
    schema = T.StructType.fromDDL("id INT, v STRING")
    assert [tuple(r) for r in table_changes(text, "a", schema).collect()] == want


def test_envelopes_of_many_tables(spark):
    texts = [envelope("c", None, {"id": 1, "v": "x"}, "a"), envelope("d", {"id": 2, "w": [1]}, None, "b")]
    got = decode_envelope(spark.createDataFrame([(t,) for t in texts], "value STRING"), key="id")
    assert sorted((r["source_table"], r["op"], r["key"]) for r in got.collect()) == [
        ("a", "insert", "1"), ("b", "delete", "2")]
    b = table_changes(got, "b", T.StructType.fromDDL("id INT, w ARRAY<INT>"), keep=("op",))
    assert [tuple(r) for r in b.collect()] == [("delete", 2, [1])]


def test_a_stamped_version_replaces_one_in_the_record(spark):
    changes = spark.createDataFrame([(9, "a", (1, 5))], "ver BIGINT, source_table STRING, record STRUCT<id: INT, ver: INT>")
    assert table_changes(changes, "a", keep=("ver",)).first().asDict() == {"ver": 9, "id": 1}


def test_read_changes_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "feed")
    spark.range(10).select(F.col("id").alias("seq"), F.concat(F.lit("t"), F.col("id") % 2).alias("source_table")) \
        .write.parquet(path)
    got = read_changes(spark, path, "seq BIGINT, source_table STRING", start_after=4, tables=["t1"])
    assert sorted(r["seq"] for r in got.collect()) == [5, 7, 9]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(seq,4)" in plan


MESSAGES = [
    # kind, xid, lsn, end_lsn, seq
    ("begin", 1, 10, None, 0), ("relation", 1, None, None, 1), ("insert", 1, None, None, 2),
    ("odd", 1, None, None, 3), ("delete", 1, None, None, 4), ("commit", 1, 10, 19, 5),
    ("begin", 2, 20, None, 6), ("insert", 2, None, None, 7),                                # no commit
    ("begin", 3, 30, None, 8), ("update", 3, None, None, 9), ("commit", 3, 31, 39, 10),     # other position
    ("begin", 4, 40, None, 11), ("commit", 4, 40, 49, 12), ("insert", 4, None, None, 13),   # after the commit
    ("begin", 5, 50, None, 14), ("update", 5, None, None, 15), ("update", 5, None, None, 16),
    ("insert", 5, None, None, 17), ("commit", 5, 50, 59, 18),
]


def test_transactions(spark):
    messages = spark.createDataFrame(MESSAGES, "kind STRING, xid BIGINT, lsn BIGINT, end_lsn BIGINT, seq BIGINT") \
        .orderBy(F.rand(3))
    flat = committed_changes(messages).orderBy("seq").collect()
    assert [(r["xid"], r["kind"], r["lsn"], r["end_lsn"]) for r in flat] == [
        (1, "insert", 10, 19), (1, "delete", 10, 19), (5, "update", 50, 59), (5, "update", 50, 59),
        (5, "insert", 50, 59)]
    numbered = numbered_operations(messages).orderBy("xid", "op_no").collect()
    assert [(r["xid"], r["op_no"], r["operations"]) for r in numbered] == [(1, 0, 2), (1, 1, 2), (5, 0, 3), (5, 1, 3), (5, 2, 3)]
    whole = assemble_transactions(messages, 10).orderBy("xid", "part").collect()
    assert [(r["xid"], r["ops"]) for r in whole] == [
        (1, ["insert", "delete"]), (5, ["update", "update", "insert"])]
    parts = assemble_transactions(messages, 2).orderBy("xid", "part").collect()
    assert [(r["xid"], r["part"], r["ops"]) for r in parts] == [
        (1, 0, ["insert", "delete"]), (5, 0, ["update", "update"]), (5, 1, ["insert"])]


def test_a_short_transaction_anywhere_in_the_log_is_one_list(spark):
    far = [(kind, xid, lsn, end, seq + 8190) for kind, xid, lsn, end, seq in MESSAGES]
    messages = spark.createDataFrame(far, "kind STRING, xid BIGINT, lsn BIGINT, end_lsn BIGINT, seq BIGINT")
    assert [(r["xid"], r["part"]) for r in assemble_transactions(messages, 10).orderBy("xid").collect()] == [(1, 0), (5, 0)]


def test_typed_operations(spark):
    ops = spark.createDataFrame(
        [("insert", ["1", "2.5", "x"], None), ("update", ["1", "bad", None], ["1", "2.5"]),
         ("delete", None, ["oops", "2.5", "t"]), ("truncate", None, None)],
        "op STRING, data ARRAY<STRING>, old_data ARRAY<STRING>")
    types = {"id": "int", "v": "double", "ok": "boolean"}
    got = [r.asDict(True) for r in project_operation(ops, types).collect()]
    assert [r["op"] for r in got] == ["insert", "update", "delete"]
    assert got[0]["record"] == {"id": 1, "v": 2.5, "ok": None} and got[0]["old_record"] is None
    assert got[0]["_rescued"] == {"ok": "x"}
    assert got[1]["record"] == {"id": 1, "v": None, "ok": None} and got[1]["_rescued"] == {"v": "bad"}
    assert got[1]["old_record"] == {"id": 1, "v": 2.5, "ok": None} and got[1]["_rescued_old"] == {}
    assert got[2]["record"] is None and got[2]["old_record"] == {"id": None, "v": 2.5, "ok": True}
    assert got[2]["_rescued_old"] == {"id": "oops"}
    raw = project_operation(ops, types, decode=False).first()
    assert raw["record"].asDict() == {"id": "1", "v": "2.5", "ok": "x"}


def test_scan_source_prunes_and_pushes(spark, sf):
    got = scan_source(spark, f"{sf}/orders.parquet", "SELECT o_orderkey", "WHERE o_orderkey < 10")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(o_orderkey,10)" in plan and "ReadSchema: struct<o_orderkey:bigint>" in plan
    assert got.count() == 10
    assert scan_source(spark, spark.range(5)).count() == 5


def test_jdbc_windows():
    assert jdbc_windows("id", 0, 39, 10) == {
        "partitionColumn": "id", "lowerBound": "0", "upperBound": "40", "numPartitions": "4"}
    assert jdbc_windows("id", 0, 40, 10)["numPartitions"] == "5"


def test_primary_key_from_catalogue_rows(spark):
    indexes = spark.createDataFrame(
        [(1, [2], True), (2, [3, 1], True), (3, [1], False), (2, [1], False)],
        "indrelid INT, indkey ARRAY<INT>, indisprimary BOOLEAN")
    attributes = spark.createDataFrame(
        [(t, n, f"c{t}{n}") for t in (1, 2, 3) for n in (1, 2, 3)], "attrelid INT, attnum INT, attname STRING")
    assert [r["attname"] for r in primary_key(indexes, attributes, 1).collect()] == ["c12"]
    assert [r["attname"] for r in primary_key(indexes, attributes, 2).collect()] == ["c23"]
    assert primary_key(indexes, attributes, 3).count() == 0


def test_profile_keys(spark):
    df = spark.createDataFrame([(1, 1, None), (2, 1, 5), (3, 2, 6)], "a INT, b INT, c INT")
    got = {r["candidate"]: (r["null_rows"], r["distinct_values"], r["is_key"])
           for r in profile_keys(df, ["a", "b", "c", ("b", "c")]).collect()}
    assert got == {"a": (0, 3, True), "b": (0, 2, False), "c": (1, 2, False), "b,c": (1, 2, False)}


def test_screen_keys(spark):
    df = spark.range(1000).select("id", (F.col("id") % 10).alias("few"), F.lit(None).cast("int").alias("none"),
                                  (F.col("id") / 1.1).alias("most"))
    assert screen_keys(df, df.columns) == ["id", "most", "few"]
    assert find_key(df.select("few", "none", "most", "id")) == "most" and find_key(df.select("few", "none")) is None
