"""Finding the key of a table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations, islice
from math import prod

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


ERROR = 0.02  # of the sketches, relative
LIKELY = 0.9  # of the row count: estimates from there on are alike, five errors below it rule out
AT_ONCE = 64  # column sets estimated in one pass
MOST_COLUMNS = 4  # of a key that is searched for


def profile_keys(df: DataFrame, candidates: Sequence[str | tuple[str, ...]]) -> DataFrame:
    """Which columns, or column tuples, could be the key: no nulls, no repeats.

    Output ``candidate, total_rows, null_rows, distinct_values, is_key``; a tuple is named
    with commas.  Each candidate is counted by itself from its own columns, so no row is
    multiplied; values aggregate before they shuffle, so a frequent one costs a row per task.
    """
    parts = []
    for candidate in candidates:
        columns = [candidate] if isinstance(candidate, str) else list(candidate)
        some_null = F.lit(False)
        for c in columns:
            some_null = some_null | F.col(f"`{c}`").isNull()
        values = df.groupBy(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)],
                            some_null.alias("gap")).agg(F.count(F.lit(1)).alias("rows"))
        parts.append(values.agg(
            F.coalesce(F.sum("rows"), F.lit(0).cast("long")).alias("total_rows"),
            F.coalesce(F.sum(F.when(F.col("gap"), F.col("rows"))), F.lit(0).cast("long")).alias("null_rows"),
            F.count_if(~F.col("gap")).alias("distinct_values"),
        ).select(F.lit(",".join(columns)).alias("candidate"), "*"))
    is_key = (F.col("null_rows") == 0) & (F.col("distinct_values") == F.col("total_rows"))
    return reduce(DataFrame.unionByName, parts).withColumn("is_key", is_key)


def screen_keys(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The columns without nulls, likeliest key first, by one pass of sketches of fixed size.

    The estimates only order the exact counts of ``profile_keys``; a column with a null, counted
    exactly here, cannot be a key.
    """
    rows, estimates = _screened(df, columns)
    # Estimates within their error of the row count are alike: then the columns' order decides.
    return sorted(estimates, key=lambda c: -min(estimates[c], LIKELY * rows))


def _screened(df: DataFrame, columns: Sequence[str]) -> tuple[int, dict[str, int]]:
    """The row count, and of each column without nulls about how many values it has."""
    measures = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(columns):
        measures.append(F.count(f"`{c}`").alias(f"n{i}"))
        measures.append(F.approx_count_distinct(f"`{c}`", ERROR).alias(f"d{i}"))
    seen = df.agg(*measures).first()
    return seen["rows"], {c: seen[f"d{i}"] for i, c in enumerate(columns) if seen[f"n{i}"] == seen["rows"]}


def find_key(df: DataFrame) -> str | None:
    """The first column, likeliest first, that an exact count proves to be a key."""
    found = find_key_columns(df, 1)
    return found[0] if found else None


def _likely(df: DataFrame, sets: list[tuple[str, ...]], rows: int) -> list[tuple[str, ...]]:
    """The column sets whose estimated number of values may be the row count, in one pass."""
    seen = df.agg(*[F.approx_count_distinct(F.xxhash64(*[f"`{c}`" for c in columns]), ERROR).alias(f"d{i}")
                    for i, columns in enumerate(sets)]).first()
    return [columns for i, columns in enumerate(sets) if seen[f"d{i}"] >= LIKELY * rows]


def find_key_columns(df: DataFrame, most: int = MOST_COLUMNS) -> tuple[str, ...] | None:
    """A least set of columns that is a key: no smaller set is one, exact counts prove it.

    Level by level: single columns, pairs, and so on, up to ``most``.  A set is not looked at if
    a column has nulls or one value, or if its columns have too few values for that many rows
    even together; sketches of fixed size, many sets in one pass, rule out most of the rest.
    Sets larger than a key that was found are never reached.  Of several keys of one level the
    first by the order of the columns is taken; none is returned if there is no key.
    """
    rows, estimates = _screened(df, df.columns)
    order = sorted(estimates, key=lambda c: -min(estimates[c], LIKELY * rows))
    for column in order:
        if (estimates[column] >= LIKELY * rows or rows == 0) and profile_keys(df, [column]).first()["is_key"]:
            return (column,)
    useful = [c for c in df.columns if estimates.get(c, 0) > 1]
    for size in range(2, most + 1):
        sets = (s for s in combinations(useful, size) if prod(estimates[c] for c in s) >= LIKELY * rows)
        while part := list(islice(sets, AT_ONCE)):
            for columns in _likely(df, part, rows):
                if profile_keys(df, [columns]).first()["is_key"]:
                    return columns
    return None


def primary_key(indexes: DataFrame, attributes: DataFrame, table: int | str) -> DataFrame:
    """First column of a table's primary key from catalogue rows; empty if it has none.

    ``indexes(indrelid, indkey ARRAY, indisprimary)``, ``attributes(attrelid, attnum, attname)``.
    """
    primary = indexes.filter(F.col("indisprimary") & (F.col("indrelid") == F.lit(table)))
    columns = attributes.filter(F.col("attrelid") == F.lit(table))
    return (
        primary.select("indrelid", F.posexplode("indkey").alias("place", "attnum"))
        .join(columns, "attnum")
        .orderBy("place").limit(1).select("attname")
    )
