import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.convert import convert_record, snapshot_record, to_json_rows
from tidemark.operators.conform import conform, split_conform

MOMENT = dt.datetime(2024, 2, 3, 4, 5, 6, 789000)


def test_every_clause(spark):
    schema = ("i INT, l BIGINT, b BOOLEAN, d DOUBLE, z TIMESTAMP, n TIMESTAMP_NTZ, day DATE, "
              "dec DECIMAL(10,2), s STRING, m MAP<STRING,INT>, o STRUCT<a: INT, c: STRING>, "
              "li ARRAY<INT>, ll ARRAY<ARRAY<DOUBLE>>, lo ARRAY<STRUCT<a: INT>>, none STRING, raw BINARY")
    row = (1, 2**40, True, 0.1, MOMENT, MOMENT, MOMENT.date(), Decimal("79.99"), "tëxt", {"k": None},
           (1, None), [1, None, 3], [[1.5], None, []], [(1,)], None, b"x")
    got = convert_record(spark.createDataFrame([row], schema)).first().asDict()
    assert got == {
        "i": "1", "l": str(2**40), "b": 1, "d": "0.1", "z": "2024-02-03T04:05:06",
        "n": "2024-02-03 04:05:06", "day": "2024-02-03", "dec": 79.99, "s": "tëxt",
        "m": '{"k":null}', "o": '{"a":1,"c":null}', "li": ["1", None, "3"],
        "ll": [["1.5"], None, []], "lo": ['{"a":1}'], "none": None, "raw": b"x",
    }


def test_false_and_null_booleans(spark):
    got = convert_record(spark.createDataFrame([(False,), (None,)], "b BOOLEAN"))
    assert [r["b"] for r in got.collect()] == [0, None]


def test_json_rows_leave_out_nulls_but_keep_them_in_lists(spark):
    df = spark.createDataFrame([(1, None, [1, None], 'q"\n')], "id INT, gone STRING, l ARRAY<INT>, t STRING")
    (line,) = [r["value"] for r in to_json_rows(convert_record(df)).collect()]
    assert json.loads(line) == {"id": "1", "l": ["1", None], "t": 'q"\n'}


def test_snapshot_rows(spark):
    df = spark.createDataFrame([(1, MOMENT, None)], "id INT, at TIMESTAMP_NTZ, other TIMESTAMP_NTZ")
    assert tuple(snapshot_record(df).first()) == (1, "2024-02-03 04:05:06", None)
    assert snapshot_record(df.limit(0)).count() == 0


SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("note", T.StringType(), True),
    T.StructField("price", T.DecimalType(10, 2), False),
    T.StructField("stock", T.IntegerType(), False),
    T.StructField("is_active", T.ShortType(), False),
    T.StructField("at", T.TimestampType(), False),
    T.StructField("ver", T.LongType(), False),
])


def test_conform_defaults(spark):
    wire = spark.createDataFrame([("5", None, "79.99", "2024-02-03T04:05:06")],
                                 "id STRING, name STRING, price STRING, at STRING")
    got = conform(wire, SCHEMA, {"is_active": 1, "name": F.lit("?")})
    assert got.schema.simpleString() == SCHEMA.simpleString()
    assert got.first().asDict() == {
        "id": 5, "name": "?", "note": None, "price": Decimal("79.99"), "stock": 0, "is_active": 1,
        "at": dt.datetime(2024, 2, 3, 4, 5, 6), "ver": 0}


def test_conform_fails_on_a_bad_value_and_split_keeps_it(spark):
    wire = spark.createDataFrame([("1", "a"), ("x", "b")], "id STRING, name STRING")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform(wire, SCHEMA).collect()
    good, bad = split_conform(wire, SCHEMA)
    assert [r["id"] for r in good.collect()] == [1]
    assert [(r["id"], r["bad_columns"]) for r in bad.collect()] == [("x", ["id"])]
