"""Which rows of a replica differ from its source (F10): checksums by key range, opened only where they differ.

A range of keys has a checksum: the number of its rows and the sum of their hashes, which does
not depend on their order and adds up.  Leaf ranges hold ``2**LEAF_BITS`` keys; their checksums
come from one pre-aggregated pass over the key and the compared columns.  The ranges above are
sums of ``2**FAN_BITS`` ranges each, up to the whole table.  Two tables are compared from the top:
only the parts of ranges that differ are looked at on the level below, and only leaves that
differ are read again, row by row.

The checksums of a side may be kept (``keep_checksums``) and compared later, or with those of
another place, without reading its rows.

Defined results: keys are integers and unique on each side, rows without a key are ``keyless``
and counted only; values are equal if both are null; doubles compare by value, and so do -0.0
and 0.0; an empty side makes every row of the other one missing or extra.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import scratch_path

LEAF_BITS = 12
FAN_BITS = 8
_SUM = "decimal(38,0)"


def _number(key: str) -> Column:
    return F.col(f"`{key}`").cast("long")


def _value(df: DataFrame, name: str) -> Column:
    """A column as it is hashed: doubles without a negative zero."""
    column = F.col(f"`{name}`")
    return column + F.lit(0.0) if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)) else column


def checksums(df: DataFrame, key: str, columns: Sequence[str], *, leaf_bits: int = LEAF_BITS) -> DataFrame:
    """Leaf ranges of a table: ``range, rows, total``."""
    hashed = F.xxhash64(_number(key), *[_value(df, c) for c in columns]).cast(_SUM)
    return df.filter(F.col(f"`{key}`").isNotNull()).groupBy(F.shiftright(_number(key), leaf_bits).alias("range")) \
        .agg(F.count(F.lit(1)).alias("rows"), F.sum(hashed).cast(_SUM).alias("total"))


def keep_checksums(leaves: DataFrame, path: str) -> DataFrame:
    leaves.write.mode("overwrite").parquet(path)
    return leaves.sparkSession.read.parquet(path)


def _level(leaves: DataFrame, height: int, fan_bits: int) -> DataFrame:
    """Ranges ``height`` levels above the leaves."""
    if height == 0:
        return leaves
    return leaves.groupBy(F.shiftright("range", height * fan_bits).alias("range")) \
        .agg(F.sum("rows").alias("rows"), F.sum("total").cast(_SUM).alias("total"))


def _unequal(one: DataFrame, two: DataFrame) -> DataFrame:
    """Ranges with another count or checksum on the other side, or none there."""
    other = two.select("range", F.col("rows").alias("rows2"), F.col("total").alias("total2"))
    same = F.col("rows").eqNullSafe(F.col("rows2")) & F.col("total").eqNullSafe(F.col("total2"))
    return one.join(other, "range", "full").filter(~same).select("range")


def differing_ranges(one: DataFrame, two: DataFrame, *, fan_bits: int = FAN_BITS) -> DataFrame:
    """Leaf ranges that differ, found from the top; ``one`` and ``two`` are leaves."""
    spark = one.sparkSession
    span = one.unionByName(two).agg(F.min("range"), F.max("range")).first()
    height = 0
    # Up to one range, or two where keys below zero and above meet.
    while span[0] is not None and (span[1] >> height * fan_bits) - (span[0] >> height * fan_bits) > 1:
        height += 1
    found = None
    for level in range(height, -1, -1):
        sides = [_level(x, level, fan_bits) for x in (one, two)]
        if found is not None:
            parents = found.withColumnRenamed("range", "parent")
            sides = [x.withColumn("parent", F.shiftright("range", fan_bits)).join(parents, "parent", "left_semi").drop("parent")
                     for x in sides]
        path = scratch_path(spark, "unequal")
        _unequal(*sides).write.parquet(path)
        found = spark.read.schema("range BIGINT").parquet(path)
        if found.isEmpty():
            break
    return found


def _opened(df: DataFrame, key: str, ranges: DataFrame, leaf_bits: int) -> DataFrame:
    """Rows of the ranges; their ends reach the scan as filters."""
    low, high = ranges.agg(F.min("range"), F.max("range")).first()
    if low is None:
        return df.filter(F.lit(False))
    number = _number(key)
    inside = df.filter((number >= low << leaf_bits) & (number < (high + 1) << leaf_bits))
    return inside.withColumn("_range", F.shiftright(number, leaf_bits)) \
        .join(ranges.withColumnRenamed("range", "_range"), "_range", "left_semi").drop("_range")


def differences(source: DataFrame, replica: DataFrame, key: str, columns: Sequence[str], *,
                leaf_bits: int = LEAF_BITS, fan_bits: int = FAN_BITS) -> DataFrame:
    """``key, difference, columns``: rows that are missing in the replica, extra there, or unequal,
    the unequal ones with the names of the columns that differ."""
    spark = source.sparkSession
    sides = [keep_checksums(checksums(x, key, columns, leaf_bits=leaf_bits), scratch_path(spark, "checksums"))
             for x in (source, replica)]
    ranges = differing_ranges(*sides, fan_bits=fan_bits)

    def side(df: DataFrame, name: str) -> DataFrame:
        return _opened(df, key, ranges, leaf_bits).select(
            _number(key).alias("key"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias(name))

    both = side(source, "one").join(side(replica, "two"), "key", "full")
    unlike = F.filter(F.array(*[F.when(~F.col("one").getField(c).eqNullSafe(F.col("two").getField(c)), F.lit(c)) for c in columns]),
                      lambda c: c.isNotNull())
    what = F.when(F.col("two").isNull(), "missing").when(F.col("one").isNull(), "extra").when(F.size(unlike) > 0, "unequal")
    names = F.when(what == "unequal", F.array_join(unlike, ","))
    return both.select("key", what.alias("difference"), names.alias("columns")).filter("difference IS NOT NULL")
