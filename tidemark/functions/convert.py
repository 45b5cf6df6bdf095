"""Destination-safe values, chosen by column type when the plan is built."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The wire formats of the destination.
ZONED_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
UNZONED_FORMAT = "yyyy-MM-dd HH:mm:ss"

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATS = (T.FloatType, T.DoubleType)
_OBJECTS = (T.MapType, T.StructType)


def convert_value(col: Column, dtype: T.DataType) -> Column:
    """One value in the form the destination's JSON reader takes.

    integers and floats → text; booleans → 1/0; timestamps and dates → ISO text, cut to
    seconds; decimals → double; maps and structs → JSON text with inner nulls kept;
    lists element by element; text and anything else unchanged.
    """
    if isinstance(dtype, _INTEGERS + _FLOATS + (T.DateType,)):
        return col.cast("string")
    if isinstance(dtype, T.BooleanType):
        return col.cast("int")
    if isinstance(dtype, T.TimestampType):
        return F.date_format(col, ZONED_FORMAT)
    if isinstance(dtype, T.TimestampNTZType):
        return F.date_format(col, UNZONED_FORMAT)
    if isinstance(dtype, T.DecimalType):
        return col.cast("double")
    if isinstance(dtype, T.VariantType):
        return F.to_json(col)
    if isinstance(dtype, _OBJECTS):
        return F.to_json(col, {"ignoreNullFields": "false"})
    if isinstance(dtype, T.ArrayType):
        element = dtype.elementType
        if isinstance(element, T.StringType):
            return col
        return F.transform(col, lambda x: convert_value(x, element))
    return col


def convert_record(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every column converted, but for those named in ``keep``."""
    return df.select(*[
        F.col(f"`{f.name}`") if f.name in keep
        else convert_value(F.col(f"`{f.name}`"), f.dataType).alias(f.name)
        for f in df.schema.fields
    ])


def snapshot_record(df: DataFrame) -> DataFrame:
    """Rows of a snapshot scan: zone-less timestamps as text, all else untouched."""
    return df.select(*[
        F.date_format(F.col(f"`{f.name}`"), UNZONED_FORMAT).alias(f.name)
        if isinstance(f.dataType, T.TimestampNTZType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def to_json_rows(df: DataFrame, name: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """One JSON object per row, null fields left out; ``keep`` columns stay beside it."""
    body = [F.col(f"`{c}`") for c in df.columns if c not in keep]
    return df.select(*keep, F.to_json(F.struct(*body)).alias(name))
