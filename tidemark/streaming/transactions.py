"""Transactions assembled from a stream of log messages.

A transaction may begin in one micro-batch and commit many later.  What is not committed yet is
carried over in a store::

    <store>/messages/batch_id=<b>/part-*    messages of micro-batch b whose transaction is still open after it
    <store>/closed/batch_id=<b>/part-*      xids that micro-batch b has emitted
    <store>/base/upto=<b>/part-*            what was open after micro-batch b, of all batches until then
    <out>/batch_id=<b>/part-*               operations emitted by micro-batch b, numbered

A micro-batch adds its own messages only; nothing stored is rewritten until the store is
compacted.  Only transactions that have a commit in the micro-batch are looked up in the store.
Folders are named by micro-batch and written as a whole, and micro-batch b reads what those
before it have written, so a replay after a failure gives the same folders again.

Operations are flat numbered rows: a transaction of any size stays spread over tasks and files.
``sources.transactions.operation_lists`` makes bounded lists of them.

A commit whose position differs from the begin's closes nothing, as in the batch form; messages
of transactions that never commit, or that come after their commit, stay in the store
(``open_messages``), so none is lost from sight.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.sinks import folders
from tidemark.sources.transactions import committed_headers, numbered_operations

BATCH = "batch_id"


def _numbers(spark: SparkSession, path: str, column: str, low: int, high: int) -> list[int]:
    """Finished folders of a store with numbers above ``low`` and below ``high``."""
    found = (int(n) for n in folders.partitions(spark, path, column))
    return sorted(n for n in found if low < n < high and folders.exists(spark, f"{path}/{column}={n}/_SUCCESS"))


def _stored(spark: SparkSession, store: str, schema: T.StructType, before: int, base_before: int | None = None) -> DataFrame:
    """Messages open after the micro-batches before number ``before``, from a base before ``base_before``."""
    bases = _numbers(spark, f"{store}/base", "upto", -1, before if base_before is None else base_before)
    base = bases[-1] if bases else -1
    later = _numbers(spark, f"{store}/messages", BATCH, base, before)
    paths = [f"{store}/base/upto={base}"] * (base >= 0) + [f"{store}/messages/{BATCH}={n}" for n in later]
    if not paths:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(*paths)
    closed = [f"{store}/closed/{BATCH}={n}" for n in _numbers(spark, f"{store}/closed", BATCH, base, before)]
    if not closed:
        return rows
    # A transaction's messages that lie in the batches before it was emitted are done with.
    gone = spark.read.schema("xid BIGINT, commit_seq BIGINT").parquet(*closed)
    return rows.join(gone, "xid", "left").filter("commit_seq IS NULL OR seq > commit_seq").select(*rows.columns)


def open_messages(spark: SparkSession, store: str, schema: T.StructType) -> DataFrame:
    """Messages of transactions that have not committed, as of the last micro-batch."""
    return _stored(spark, store, schema, 1 << 62)


def _compact(spark: SparkSession, store: str, schema: T.StructType, number: int) -> None:
    """Rewrite what is open after micro-batch ``number``; the base before this one is kept, for a replay."""
    _stored(spark, store, schema, number + 1, number).write.mode("overwrite").parquet(f"{store}/base/upto={number}")
    bases = _numbers(spark, f"{store}/base", "upto", -1, number)
    if not bases:
        return
    for old in bases[:-1]:
        folders.remove(spark, f"{store}/base/upto={old}")
    for part in ("messages", "closed"):
        for old in _numbers(spark, f"{store}/{part}", BATCH, -1, bases[-1] + 1):
            folders.remove(spark, f"{store}/{part}/{BATCH}={old}")


def assemble_stream(messages: DataFrame, out_dir: str, store_dir: str, checkpoint_dir: str, *,
                    compact_every: int = 64, available_now: bool = False,
                    interval: str = "5 seconds") -> StreamingQuery:
    """Emit each transaction's operations in the micro-batch that brings its commit."""
    schema = T.StructType(list(messages.schema.fields))

    def assemble(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            closing = batch.filter("kind = 'commit'").select("xid").distinct()
            known = _stored(spark, store_dir, schema, number).join(closing, "xid", "left_semi")
            whole = batch.join(closing, "xid", "left_semi").select(*schema.names).unionByName(known.select(*schema.names))
            numbered_operations(whole).write.mode("overwrite").parquet(f"{out_dir}/{BATCH}={number}")
            done = committed_headers(whole).select("xid", "commit_seq")
            done.write.mode("overwrite").parquet(f"{store_dir}/closed/{BATCH}={number}")
            done = spark.read.schema("xid BIGINT, commit_seq BIGINT").parquet(f"{store_dir}/closed/{BATCH}={number}")
            batch.join(done, "xid", "left").filter("commit_seq IS NULL OR seq > commit_seq").select(*schema.names) \
                .write.mode("overwrite").parquet(f"{store_dir}/messages/{BATCH}={number}")
            if number % compact_every == compact_every - 1:
                _compact(spark, store_dir, schema, number)
        finally:
            batch.unpersist()

    writer = messages.writeStream.foreachBatch(assemble).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def emitted_operations(spark: SparkSession, out_dir: str) -> DataFrame:
    """Operations of all transactions emitted so far, with ``op_no`` and ``operations``."""
    return spark.read.parquet(out_dir).drop(BATCH)
