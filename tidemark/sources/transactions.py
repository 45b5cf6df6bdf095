"""Transactions out of a message log (S5) and typed operations.

Message columns: ``kind`` (begin, relation, insert, update, delete, commit, anything
else), ``xid``, ``lsn``, ``end_lsn`` and ``seq``, the unique position in the log.
"""

from __future__ import annotations

from collections.abc import Mapping as Dict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.numbering import running_total

# The operation kinds of the log.
OPERATIONS = ("insert", "update", "delete")


def committed_headers(messages: DataFrame) -> DataFrame:
    """One row per transaction whose commit position equals its begin position.

    A conditional aggregate over begin and commit messages only: operations never
    enter this shuffle.
    """
    begin = F.col("kind") == "begin"
    commit = F.col("kind") == "commit"
    ends = messages.filter(F.col("kind").isin("begin", "commit"))
    heads = ends.groupBy("xid").agg(
        F.max(F.when(begin, F.col("lsn"))).alias("lsn"),
        F.max(F.when(begin, F.col("seq"))).alias("begin_seq"),
        F.max(F.when(commit, F.col("lsn"))).alias("commit_lsn"),
        F.max(F.when(commit, F.col("end_lsn"))).alias("end_lsn"),
        F.max(F.when(commit, F.col("seq"))).alias("commit_seq"),
    )
    closed = (F.col("lsn") == F.col("commit_lsn")) & (F.col("begin_seq") < F.col("commit_seq"))
    return heads.filter(closed).drop("commit_lsn")


def committed_changes(messages: DataFrame) -> DataFrame:
    """Operations of committed transactions as flat rows, ``seq`` giving their order.

    The form to use downstream: a transaction of any size stays spread over tasks,
    since adaptive execution can split the operation side of the join.
    """
    ops = messages.filter(F.col("kind").isin(*OPERATIONS)).drop("lsn", "end_lsn")
    inside = (F.col("seq") > F.col("begin_seq")) & (F.col("seq") < F.col("commit_seq"))
    return (
        ops.join(committed_headers(messages), "xid")
        .filter(inside)
        .drop("begin_seq", "commit_seq")
    )


def numbered_operations(messages: DataFrame) -> DataFrame:
    """Committed operations with ``op_no``, their exact place in the transaction from 0, and
    ``operations``, how many it has.  A transaction of any size stays spread over tasks."""
    changes = committed_changes(messages)
    rows = running_total(changes, "seq", group=("xid",), name="op_no")
    # Counted before the numbering, which would else be planned twice.
    sizes = changes.groupBy("xid").agg(F.count(F.lit(1)).alias("operations"))
    return rows.join(sizes, "xid")


def operation_lists(numbered: DataFrame, n: int, payload: Column | None = None) -> DataFrame:
    """Numbered operations as ordered lists of at most ``n``.

    ``part`` counts the lists of a transaction: it holds the operations ``part * n`` and on, so
    one that has no more than ``n`` is one list.
    """
    payload = F.col("kind") if payload is None else payload
    rows = numbered.select(
        "xid", "lsn", "end_lsn", "operations", F.call_function("div", F.col("op_no"), F.lit(n)).alias("part"),
        F.struct(F.col("op_no"), payload.alias("op")).alias("item"))
    return rows.groupBy("xid", "part").agg(
        F.first("lsn").alias("lsn"), F.first("end_lsn").alias("end_lsn"), F.first("operations").alias("operations"),
        F.array_sort(F.collect_list("item")).alias("items"),
    ).select("xid", "lsn", "end_lsn", "part", "operations", F.col("items.op").alias("ops"))


def assemble_transactions(messages: DataFrame, n: int, payload: Column | None = None) -> DataFrame:
    """Committed transactions as ordered lists of at most ``n`` operations."""
    return operation_lists(numbered_operations(messages), n, payload)


def _cast_fields(data: Column, types: Dict[str, str | T.DataType]) -> tuple[list[Column], Column]:
    """Typed fields of a text array, and a map of the texts that did not fit."""
    fields, misfits = [], []
    for i, (name, dtype) in enumerate(types.items()):
        text = F.get(data, F.lit(i))
        value = text.try_cast(dtype)
        fields.append(value.alias(name))
        misfits.append(F.when(text.isNotNull() & value.isNull(),
                              F.struct(F.lit(name).alias("key"), text.alias("value"))))
    entries = F.filter(F.array(*misfits), lambda m: m.isNotNull())
    return fields, F.map_from_entries(entries)


def project_operation(df: DataFrame, types: Dict[str, str | T.DataType], *, op: str = "op",
                      data: str = "data", old_data: str = "old_data",
                      decode: bool = True) -> DataFrame:
    """Text operations → ``record`` and ``old_record`` structs of the declared types.

    An insert has no old record; an update has both; a delete has only the old one,
    taken from ``old_data``.  A text its type cannot hold becomes null, and the raw text
    is kept under the column's name in ``_rescued`` (``_rescued_old`` for the old
    record).  ``decode=False`` keeps every column as text.
    """
    if not decode:
        types = {name: T.StringType() for name in types}
    new_fields, new_misfits = _cast_fields(F.col(data), types)
    old_fields, old_misfits = _cast_fields(F.col(old_data), types)
    has_new = F.col(op).isin("insert", "update")
    has_old = F.col(op).isin("update", "delete")
    kept = [c for c in df.columns if c not in (data, old_data)]
    return df.filter(F.col(op).isin(*OPERATIONS)).select(
        *kept,
        F.when(has_new, F.struct(*new_fields)).alias("record"),
        F.when(has_old, F.struct(*old_fields)).alias("old_record"),
        F.when(has_new, new_misfits).alias("_rescued"),
        F.when(has_old, old_misfits).alias("_rescued_old"),
    )
