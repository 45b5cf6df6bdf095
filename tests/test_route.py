import pytest
from pyspark.sql import functions as F

from tidemark.functions.template import parse
from tidemark.operators.changes import filter_mapped, live_changes, stamp_version, tombstones
from tidemark.operators.route import (fan_in, register_script, reject_counts, rejects, remap, route,
                                      split_rejects)
from tidemark.sources.mapping import Entry, Mapping


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [(1, "ann", 3.5, 7), (2, None, 1.0, 8)], "id BIGINT, name STRING, score DOUBLE, ver BIGINT")


def out(df):
    return [r.asDict() for r in df.orderBy("id").collect()]


@pytest.mark.parametrize("value, kind", [
    ("{a}", "column"), ("x {a}", "text"), ("{a}-{b}", "constant"), ("plain", "constant"),
    (5, "constant"), (None, "constant"), ("{}", "column"), ("{a", "constant"), ("a}", "constant"),
])
def test_template_kinds(value, kind):
    assert parse(value).kind == kind


def test_whole_placeholder_keeps_the_type(people):
    got = remap(people, Entry("p", "d", remap={"id": "{id}", "points": "{score}"}))
    assert dict(got.dtypes) == {"id": "bigint", "points": "double", "ver": "bigint"}
    assert out(got) == [{"id": 1, "points": 3.5, "ver": 7}, {"id": 2, "points": 1.0, "ver": 8}]


def test_constants_literals_and_missing_columns(people):
    got = out(remap(people, Entry("p", "d", remap={
        "id": "{id}", "src": "pg", "n": 4, "ok": True, "none": None, "both": "{id}-{name}",
        "gone": "{nothing}", "tags": ["a", "b"]})))[0]
    assert got == {"id": 1, "src": "pg", "n": 4, "ok": True, "none": None, "both": "{id}-{name}",
                   "gone": None, "tags": ["a", "b"], "ver": 7}


def test_ver_overwrites_a_mapped_ver_and_defaults_to_zero(people):
    assert out(remap(people, Entry("p", "d", remap={"id": "{id}", "ver": "{score}"})))[0]["ver"] == 7
    assert out(remap(people.drop("ver"), Entry("p", "d", remap={"id": "{id}"})))[0]["ver"] == 0
    nulls = people.withColumn("ver", F.lit(None).cast("bigint"))
    assert out(remap(nulls, Entry("p", "d", remap={"id": "{id}"})))[0]["ver"] == 0


def test_identity_and_empty_remap(people):
    assert remap(people, Entry("p", "d")).columns == people.columns
    assert remap(people, Entry("p", "d", remap={})).columns == ["ver"]


def test_text_template_rejects_null_and_other_types(people):
    good, bad = split_rejects(people, Entry("p", "d", remap={"id": "{id}", "hi": "hi {name}!"}))
    assert out(good) == [{"id": 1, "hi": "hi ann!", "ver": 7}]
    assert [(r["id"], r["reject_reason"]) for r in bad.collect()] == [(2, "hi: name is null")]
    good, bad = split_rejects(people, Entry("p", "d", remap={"hi": "no {id}"}))
    assert good.count() == 0 and bad.count() == 2
    good, bad = split_rejects(people, Entry("p", "d", remap={"hi": "no {nothing}"}))
    assert good.count() == 0 and bad.first()["reject_reason"] == "hi: no column nothing"
    good, bad = split_rejects(people, Entry("p", None))
    assert good.count() == 0 and bad.count() == 2
    good, bad = split_rejects(people, Entry("p", "d"))
    assert good.count() == 2 and bad.count() == 0
    assert reject_counts(bad).count() == 0


def test_a_reject_in_one_rule_drops_the_row_everywhere(people):
    rules = Mapping([Entry("p", "a"), Entry("p", "b", remap={"id": "{id}", "hi": "hi {name}"})])
    routed = route({"p": people}, rules)
    assert [r["id"] for r in routed["a"].collect()] == [1]
    assert [r["id"] for r in routed["b"].collect()] == [1]
    assert rejects(people, rules.by_source("p")).count() == 1


def test_fan_in_aligns_columns_and_types(spark):
    a = spark.createDataFrame([(1, "x")], "id INT, v STRING")
    b = spark.createDataFrame([(2, 7)], "id BIGINT, v INT")
    both = fan_in([a, b])
    assert dict(both.dtypes) == {"id": "bigint", "v": "string"}
    assert out(both) == [{"id": 1, "v": "x"}, {"id": 2, "v": "7"}]
    c = spark.createDataFrame([(3, 1.5)], "id INT, w DOUBLE")
    assert out(fan_in([a, c])) == [{"id": 1, "v": "x", "w": None}, {"id": 3, "v": None, "w": 1.5}]


def test_a_missing_column_takes_the_other_sources_type(spark):
    a = spark.createDataFrame([(1, 9)], "id BIGINT, token INT")
    b = spark.createDataFrame([(2,)], "id BIGINT")
    rules = Mapping([Entry("a", "d", remap={"id": "{id}", "t": "{token}"}),
                     Entry("b", "d", remap={"id": "{id}", "t": "{token}"})])
    assert dict(route({"a": a, "b": b}, rules)["d"].dtypes)["t"] == "int"
    assert dict(route({"b": b}, rules)["d"].dtypes)["t"] == "string"


def test_script_runs_only_as_the_only_rule(people):
    register_script("M.f", lambda df: df.select("id", F.lit("scripted").alias("how")))
    register_script("M.g", lambda df: {"x": df.select("id"), "y": df.select("name")})
    one = Mapping([Entry("p", "d", script="M.f")])
    assert {r["how"] for r in route({"p": people}, one)["d"].collect()} == {"scripted"}
    assert set(route({"p": people}, Mapping([Entry("p", script="M.g")]))) == {"x", "y"}
    assert set(route({"p": people}, Mapping([Entry("p", script="M.f")]))) == {"p"}
    two = Mapping([Entry("p", "d", script="M.f"), Entry("p", "e")])
    assert "how" not in route({"p": people}, two)["d"].columns
    with pytest.raises(LookupError):
        route({"p": people}, Mapping([Entry("p", "d", script="M.unknown")]))


def test_python_rows_in_a_script(people):
    def shout(batches):
        for frame in batches:
            yield frame.assign(name=frame["name"].str.upper())
    register_script("M.rows", lambda df: df.mapInPandas(shout, df.schema))
    got = route({"p": people}, Mapping([Entry("p", "d", script="M.rows")]))["d"]
    assert out(got)[0]["name"] == "ANN"


def test_change_filters_and_versions(spark):
    changes = spark.createDataFrame(
        [(0, "a", "insert"), (1, "b", "update"), (2, "a", "delete"), (3, "c", "truncate"), (4, "a", None)],
        "seq BIGINT, source_table STRING, op STRING")
    assert [r["seq"] for r in live_changes(changes).orderBy("seq").collect()] == [0, 1]
    rules = Mapping([Entry("a", "x"), Entry("c", "y")])
    assert filter_mapped(changes, rules).count() == 4
    assert [r["ver"] for r in stamp_version(changes).orderBy("seq").collect()] == [1, 2, 3, 4, 5]
    timed = changes.withColumn("commit_ts", F.lit("2024-01-01 00:00:00.000001").cast("timestamp_ntz"))
    assert stamp_version(timed, by="commit_ts").first()["ver"] == 1704067200000001000
    with pytest.raises(ValueError):
        stamp_version(changes, by="clock")


def test_tombstones(spark):
    changes = spark.createDataFrame(
        [(0, "a", "insert", 1), (2, "a", "delete", 1), (3, "b", "delete", 2)],
        "seq BIGINT, source_table STRING, op STRING, id BIGINT").withColumn(
        "commit_ts", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    rules = Mapping([Entry("a", "x", remap={"key": "{id}"})])
    got = tombstones(changes, "x", rules).collect()
    assert [(r["id"], r["ver"], r["dest_table"]) for r in got] == [(1, 3, "x")]
    assert got[0]["deleted_at"] is not None
    assert tombstones(changes, "x").count() == 2
    assert tombstones(changes, "x", rules, table="b").count() == 0
