"""Transactions over a stream: cut by micro-batches, replayed, compacted."""

from pyspark.sql import functions as F

from tidemark.sources.feed import read_changes
from tidemark.sources.transactions import numbered_operations, operation_lists
from tidemark.streaming.transactions import assemble_stream, emitted_operations, open_messages

SCHEMA = "xid LONG, seq LONG, kind STRING, lsn LONG, end_lsn LONG"
COLUMNS = ("xid", "seq", "kind", "lsn", "end_lsn", "op_no", "operations")


def log():
    """Interleaved transactions: 1 is long, 2 never commits, 3 commits elsewhere, 4 is one message late, 5 is empty."""
    rows, seq = [], 0

    def say(xid, kind, lsn=None, end=None):
        nonlocal seq
        rows.append((xid, seq, kind, lsn, end))
        seq += 1
    for xid in (1, 2, 3, 4):
        say(xid, "begin", xid * 10)
    for k in range(120):
        say(1, ("insert", "update", "delete", "relation")[k % 4])
        if k % 10 == 0:
            say(2 + k // 10 % 3, "insert")
    say(3, "commit", 31, 35)
    say(4, "commit", 40, 45)
    say(4, "update")
    say(5, "begin", 50)
    say(5, "commit", 50, 55)
    say(1, "commit", 10, 15)
    return rows


def rows(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def run(spark, path, **options):
    stream = read_changes(spark, f"{path}/log", SCHEMA, streaming=True, max_files=1)
    assemble_stream(stream, f"{path}/out", f"{path}/store", f"{path}/cp", available_now=True, **options).awaitTermination()


def test_a_stream_gives_what_the_batch_gives(spark, tmp_path):
    whole = spark.createDataFrame(log(), SCHEMA)
    path, step = str(tmp_path), 17
    for start in range(0, whole.count(), step):
        whole.filter(F.col("seq").between(start, start + step - 1)).coalesce(1).write.mode("append").parquet(f"{path}/log")
        if start % 3 == 0:
            run(spark, path, compact_every=3)
    run(spark, path, compact_every=3)
    got = emitted_operations(spark, f"{path}/out")
    assert rows(got) == rows(numbered_operations(whole))
    assert sorted({r["xid"] for r in got.collect()}) == [1, 4] and got.filter("xid = 1").count() == 90
    left = open_messages(spark, f"{path}/store", whole.schema)
    assert {r["xid"] for r in left.collect()} == {2, 3, 4}
    assert [r["kind"] for r in left.filter("xid = 4").collect()] == ["update"]  # came after its commit
    lists = operation_lists(got, 25).filter("xid = 1").collect()
    assert sorted(len(r["ops"]) for r in lists) == [15, 25, 25, 25]


def test_a_replayed_micro_batch_gives_the_same_folders(spark, tmp_path):
    path = str(tmp_path)
    whole = spark.createDataFrame(log(), SCHEMA)
    for start, end in ((0, 60), (61, 130), (131, 999)):
        whole.filter(F.col("seq").between(start, end)).coalesce(1).write.mode("append").parquet(f"{path}/log")
    run(spark, path, compact_every=1)
    want = rows(emitted_operations(spark, f"{path}/out"))
    # The last micro-batch has done its work, but the stream died before it noted that.
    commits = tmp_path / "cp" / "commits"
    for name in ("2", ".2.crc"):
        (commits / name).unlink(missing_ok=True)
    run(spark, path, compact_every=1)
    assert rows(emitted_operations(spark, f"{path}/out")) == want == rows(numbered_operations(whole))
