"""Fitting wire values to a destination schema (K5)."""

from __future__ import annotations

from collections.abc import Iterable
from collections.abc import Mapping as Dict
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What a non-nullable destination column holds when nothing is given.
TYPE_DEFAULTS = (
    (T.StringType, ""),
    (T.BooleanType, False),
    (T.NumericType, 0),
    (T.DateType, "1970-01-01"),
    (T.TimestampType, "1970-01-01 00:00:00"),
    (T.TimestampNTZType, "1970-01-01 00:00:00"),
)


def _default(field: T.StructField, defaults: Dict[str, Any]) -> Column | None:
    if field.name in defaults:
        value = defaults[field.name]
        value = value if isinstance(value, Column) else F.lit(value)
        return value.cast(field.dataType)
    if field.nullable:
        return None
    for kind, value in TYPE_DEFAULTS:
        if isinstance(field.dataType, kind):
            return F.lit(value).cast(field.dataType)
    return None


def _source(df: DataFrame, field: T.StructField) -> Column | None:
    return F.col(f"`{field.name}`") if field.name in df.columns else None


def _fitted(df: DataFrame, schema: T.StructType, defaults: Dict[str, Any], strict: bool) -> list[Column]:
    columns = []
    for field in schema.fields:
        source = _source(df, field)
        value = F.lit(None).cast(field.dataType) if source is None else (
            source.cast(field.dataType) if strict else source.try_cast(field.dataType))
        default = _default(field, defaults)
        if default is not None:
            value = default if source is None else F.coalesce(value, default)
        columns.append(value.alias(field.name))
    return columns


def conform(df: DataFrame, schema: T.StructType, defaults: Dict[str, Any] | None = None,
            keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows with exactly the destination's columns and types.

    Absent and null fields take the column's default: the given one, else null for a
    nullable column, else the type's own (empty text, 0).  A value that does not parse
    fails the query, as a load would fail its batch.  ``keep`` columns pass unchanged.
    """
    return df.select(*keep, *_fitted(df, schema, defaults or {}, strict=True))


def misfit_columns(df: DataFrame, schema: T.StructType, keys: Iterable[str] = ()) -> Column:
    """Names of the columns that do not parse, and of keys that are null or absent."""
    misfits = []
    for field in schema.fields:
        source = _source(df, field)
        if source is not None:
            bad = source.isNotNull() & source.try_cast(field.dataType).isNull()
            misfits.append(F.when(bad | source.isNull() if field.name in keys else bad, F.lit(field.name)))
        elif field.name in keys:
            misfits.append(F.lit(field.name))
    return F.array_compact(F.array(*misfits)) if misfits else F.array().cast("array<string>")


def fitted(df: DataFrame, schema: T.StructType, defaults: Dict[str, Any] | None = None,
           keep: tuple[str, ...] = ()) -> DataFrame:
    """``conform`` for rows without misfits."""
    return df.select(*keep, *_fitted(df, schema, defaults or {}, strict=False))


def split_conform(df: DataFrame, schema: T.StructType, defaults: Dict[str, Any] | None = None,
                  keep: tuple[str, ...] = (), keys: Iterable[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(rows that fit, original rows with the ``bad_columns`` that do not parse).

    A key never takes a default: a row without it does not fit.
    """
    bad_columns = misfit_columns(df, schema, tuple(keys))
    good = fitted(df.filter(F.size(bad_columns) == 0), schema, defaults, keep)
    return good, df.withColumn("bad_columns", bad_columns).filter(F.size("bad_columns") > 0)
