"""Reading a landed change feed (S3) and decoding change envelopes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column order of the canonical change row; ``record`` is the payload column, or the
# payload may be flattened into columns of its own, which scans prune better.
CHANGE_COLUMNS = ("xid", "seq", "commit_ts", "op", "source_table", "key")

# Files a micro-batch takes, unless told otherwise: a backlog is worked off in bounded steps.
MAX_FILES = 1000

# Column with the text of a change that could not be read.
CORRUPT = "corrupt"

# Operation codes of the public change-envelope convention.
ENVELOPE_OPS = {"c": "insert", "r": "insert", "u": "update", "d": "delete"}


def read_changes(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    *,
    fmt: str = "parquet",
    streaming: bool = False,
    start_after: int | None = None,
    tables: Sequence[str] | None = None,
    seq: str = "seq",
    table: str = "source_table",
    max_files: int | None = None,
    glob: str | None = None,
) -> DataFrame:
    """Change rows after a feed position, for all tables or the listed ones.

    Both conditions are plain filters, so they reach the file scan.
    """
    reader = (spark.readStream if streaming else spark.read).format(fmt).schema(schema)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    if streaming:
        reader = reader.option("maxFilesPerTrigger", max_files or MAX_FILES)
    changes = reader.load(path)
    if start_after is not None:
        changes = changes.filter(F.col(seq) > F.lit(start_after))
    if tables is not None:
        changes = changes.filter(F.col(table).isin(list(tables)))
    return changes


def envelope_schema(row_schema: T.DataType) -> T.StructType:
    """Schema of the JSON envelope around rows of ``row_schema``; text keeps them as JSON."""
    source = T.StructType([
        T.StructField("ts_ms", T.LongType()),
        T.StructField("schema", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("txId", T.LongType()),
        T.StructField("lsn", T.LongType()),
    ])
    return T.StructType([
        T.StructField("before", row_schema),
        T.StructField("after", row_schema),
        T.StructField("source", source),
        T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
    ])


def _envelope_op(code: Column) -> Column:
    op = F.lit("other")
    for short, name in ENVELOPE_OPS.items():
        op = F.when(code == short, F.lit(name)).otherwise(op)
    return op


def decode_envelope(df: DataFrame, row_schema: T.StructType | None = None, value: str = "value",
                    key: str | None = None) -> DataFrame:
    """Envelopes in the text column ``value`` → change rows.

    A delete carries its old image in ``before``; everything else uses ``after``.
    Codes other than c, r, u and d get op ``other``.  Text that is no envelope, or whose row
    does not have the declared types, is kept whole in ``corrupt``.
    Without ``row_schema``, as for a feed of many tables, ``record`` is JSON text, which
    ``table_changes`` parses per table.  ``key`` names the key field of the rows.
    """
    schema = envelope_schema(row_schema or T.StringType()).add(CORRUPT, T.StringType())
    parsed = F.from_json(F.col(value), schema, {"columnNameOfCorruptRecord": CORRUPT})
    env = df.select(parsed.alias("e"), F.col(value).alias("text"))
    no_envelope = F.col("e.source.table").isNull() | F.col("e.op").isNull()
    record = F.coalesce("e.after", "e.before")
    columns = [
        F.col("e.source.txId").alias("xid"),
        F.col("e.source.lsn").alias("seq"),
        F.timestamp_millis(F.coalesce("e.source.ts_ms", "e.ts_ms")).alias("commit_ts"),
        _envelope_op(F.col("e.op")).alias("op"),
        F.col("e.source.table").alias("source_table"),
    ]
    if key is not None:
        field = record[key] if row_schema is not None else F.get_json_object(record, f"$.{key}")
        columns.append(field.alias("key"))
    corrupt = F.when(F.col(f"e.{CORRUPT}").isNotNull() | no_envelope, F.col("text"))
    return env.select(*columns, record.alias("record"), corrupt.alias(CORRUPT))


def table_changes(changes: DataFrame, table: str, record_schema: T.StructType | None = None,
                  keep: Sequence[str] = ("op", "seq")) -> DataFrame:
    """Changes of one table with the payload flattened into columns.

    ``record`` may be a struct, or JSON text when ``record_schema`` is given.  A field of
    the payload that is named like a ``keep`` column gives way to it.
    """
    record = F.col("record")
    if record_schema is not None:
        record = F.from_json(record, record_schema)
    fields = record_schema or changes.schema["record"].dataType
    return (
        changes.filter(F.col("source_table") == table)
        .select(*keep, record.alias("record"))
        .select(*keep, *[F.col("record").getField(f).alias(f) for f in fields.names if f not in keep])
    )
