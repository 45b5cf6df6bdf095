"""Scanning source tables."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession


def scan_source(spark: SparkSession, table: str | DataFrame, select: str = "SELECT *",
                clause: str = "", *, fmt: str = "parquet", **options: Any) -> DataFrame:
    """``<select> FROM <table> <clause>`` over a path, a JDBC table or a DataFrame.

    The text goes through ``spark.sql``, so the projection and the conditions of
    ``clause`` reach the scan (parquet or JDBC) by ordinary pushdown.
    """
    if isinstance(table, DataFrame):
        source = table
    elif fmt == "jdbc":
        source = spark.read.format("jdbc").options(dbtable=table, **options).load()
    else:
        source = spark.read.format(fmt).options(**options).load(table)
    return spark.sql(f"{select} FROM {{source}} {clause}", source=source)


def jdbc_windows(column: str, low: int, high: int, window: int) -> dict[str, str]:
    """JDBC read options for one task per ``window`` ids between ``low`` and ``high``."""
    parts = max(1, -(-(high - low + 1) // window))
    return {
        "partitionColumn": column,
        "lowerBound": str(low),
        "upperBound": str(high + 1),
        "numPartitions": str(parts),
    }
