import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.catalogue.tables import row_type
from tidemark.sinks import folders, loads
from tidemark.sinks.staging import (HoldGate, compact, current_rows, drain, load_batch, loaded_batches, read_replica,
                                    read_staged, read_staged_files, segments, split_held, stage_batch,
                                    staged_batches, write_replica)
from tidemark.sinks.views import IncrementalView, build_view, drop_view, materialize, read_view

SCHEMAS = {
    "a": T.StructType([T.StructField("id", T.LongType(), False), T.StructField("v", T.DoubleType()),
                       T.StructField("tags", T.ArrayType(T.IntegerType())), T.StructField("ver", T.LongType(), False)]),
    "wide_name_b": row_type("id BIGINT NOT NULL, ver BIGINT NOT NULL"),
}


@pytest.fixture
def dirs(tmp_path):
    return str(tmp_path / "stage"), str(tmp_path / "replica")


def rows_a(spark, low, high, ver=0):
    return spark.range(low, high).select("id", (F.col("id") / 2).alias("v"), F.array(F.lit(1), F.lit(None).cast("int"))
                                         .alias("tags"), F.lit(ver).cast("long").alias("ver"))


def test_stage_then_load(spark, dirs):
    stage, replica = dirs
    stage_batch({"a": rows_a(spark, 0, 5), "wide_name_b": spark.range(3).withColumn("ver", F.lit(1))}, stage, "s", 7)
    stage_batch({"a": rows_a(spark, 5, 9)}, stage, "s", 3)
    assert staged_batches(spark, stage) == {"a": {"s": [[3, 3], [7, 7]]}, "wide_name_b": {"s": [[7, 7]]}}
    wire = read_staged(spark, stage, "a", SCHEMAS["a"], {"s": [[7, 7]]}).orderBy("id").first()
    assert (wire["id"], wire["v"], wire["tags"], wire["load_batch"]) == ("0", "0.0", ["1", None], 7)
    assert drain(spark, stage, replica, SCHEMAS) == {"a": 2, "wide_name_b": 1}
    assert staged_batches(spark, stage) == {}
    got = read_replica(spark, replica, "a", SCHEMAS["a"])
    assert sorted((r["id"], r["v"], tuple(r["tags"]), r["load_batch"]) for r in got.collect()) == [
        (i, i / 2, (1, None), 7 if i < 5 else 3) for i in range(9)]
    assert loaded_batches(spark, replica, "a") == {"s": [[3, 3], [7, 7]]}
    assert drain(spark, stage, replica, SCHEMAS) == {}


def test_repeating_a_batch_changes_nothing(spark, dirs):
    stage, replica = dirs
    for _ in range(2):
        stage_batch({"a": rows_a(spark, 0, 5)}, stage, "s", 1)
    load_batch(spark, stage, replica, "a", SCHEMAS["a"], {"s": [[1, 1]]})
    stage_batch({"a": rows_a(spark, 0, 5)}, stage, "s", 1)
    assert load_batch(spark, stage, replica, "a", SCHEMAS["a"], {"s": [[1, 1]]}) == 0
    assert segments(spark, stage, "a") == []
    assert write_replica(rows_a(spark, 0, 5), replica, "a", "s", 1) is None
    assert read_replica(spark, replica, "a", SCHEMAS["a"]).count() == 5


def test_equal_batch_ids_of_two_origins_stay_apart(spark, dirs):
    stage, replica = dirs
    for name, low in (("first", 0), ("second", 10)):
        stage_batch({"a": rows_a(spark, low, low + 5)}, stage, name, 0)
        assert drain(spark, stage, replica, SCHEMAS) == {"a": 1}
    assert read_replica(spark, replica, "a", SCHEMAS["a"]).count() == 10


def test_of_equal_versions_the_last_loaded_wins(spark, dirs):
    _, replica = dirs
    for number, v in enumerate((1.0, 2.0, 3.0)):
        assert write_replica(rows_a(spark, 0, 3).withColumn("v", F.lit(v)), replica, "a", f"run{number}", 0) == number
        if number == 1:
            break
    compact(spark, replica, "a", SCHEMAS["a"], ["id"])
    assert {r["v"] for r in current_rows(spark, replica, "a", SCHEMAS["a"], ["id"]).collect()} == {2.0}
    write_replica(rows_a(spark, 0, 3).withColumn("v", F.lit(3.0)), replica, "a", "run2", 0)
    assert {r["v"] for r in current_rows(spark, replica, "a", SCHEMAS["a"], ["id"]).collect()} == {3.0}


def test_a_load_that_died_leaves_nothing(spark, dirs, monkeypatch):
    _, replica = dirs
    write_replica(rows_a(spark, 0, 3), replica, "a", "s", 0)

    def die(*args, **kwargs):
        raise KeyboardInterrupt
    with monkeypatch.context() as patch:
        patch.setattr(loads, "commit", die)
        with pytest.raises(KeyboardInterrupt):
            write_replica(rows_a(spark, 3, 6), replica, "a", "s", 1)
    assert read_replica(spark, replica, "a", SCHEMAS["a"]).count() == 3
    assert write_replica(rows_a(spark, 3, 6), replica, "a", "s", 1) == 1
    assert read_replica(spark, replica, "a", SCHEMAS["a"]).count() == 6


def test_two_writers_never_share_a_number(spark, dirs):
    _, replica = dirs
    empty = loads.Manifest()  # both saw the table before the other's commit
    numbers = [loads.commit(spark, replica, "a", name, rows=0, batches={name: [[0, 0]]}, known=empty) for name in ("x", "y")]
    with pytest.raises(loads.Conflict) as conflict:
        loads.commit(spark, replica, "a", "z", rows=0, batches={"x": [[0, 2]], "z": [[5, 5]]}, known=empty)
    assert conflict.value.left == {"x": [[1, 2]], "z": [[5, 5]]}
    assert numbers == [0, 1] and loaded_batches(spark, replica, "a") == {"x": [[0, 0]], "y": [[0, 0]]}


def test_a_bad_batch_stays_staged_and_is_reported(spark, dirs):
    stage, replica = dirs
    stage_batch({"a": rows_a(spark, 0, 3).withColumn("v", F.lit("no number"))}, stage, "s", 1)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        drain(spark, stage, replica, SCHEMAS)
    assert staged_batches(spark, stage)["a"] == {"s": [[1, 1]]}
    assert loaded_batches(spark, replica, "a") == {}
    assert read_replica(spark, replica, "a", SCHEMAS["a"]).count() == 0
    (report,) = spark.read.json(f"{replica}/_failed/batches").collect()
    assert (report["rows"], report["load_batch"]) == (3, 1)
    assert sorted(r["id"] for r in spark.read.json(f"{replica}/_failed/ids").collect()) == ["0", "1", "2"]


def test_misfits_and_rows_without_a_key_are_kept_aside(spark, dirs, tmp_path):
    stage, replica = dirs
    rows = rows_a(spark, 0, 6).withColumn("v", F.when(F.col("id") == 1, "x").otherwise(F.col("v").cast("string"))) \
        .withColumn("id", F.when(F.col("id") != 2, F.col("id")))
    stage_batch({"a": rows}, stage, "s", 1)
    assert drain(spark, stage, replica, SCHEMAS, keys={"a": ("id",)}, reject_dir=f"{tmp_path}/rejects") == {"a": 1}
    assert sorted(r["id"] for r in read_replica(spark, replica, "a", SCHEMAS["a"]).collect()) == [0, 3, 4, 5]
    assert sorted(r["reject_reason"] for r in spark.read.json(f"{tmp_path}/rejects").collect()) == [
        "does not fit: id", "does not fit: v"]
    (entry,) = loads.entries(spark, replica, "a").collect()
    assert (entry["rows"], entry["rejected"]) == (4, 2)


def test_compact_keeps_latest_rows_tombstones_and_batches(spark, dirs):
    _, replica = dirs
    schema = row_type("id BIGINT NOT NULL, deleted_at STRING, ver BIGINT NOT NULL")
    for batch, (ver, gone) in enumerate([(1, None), (2, None), (3, "now")]):
        rows = spark.range(4 if ver < 3 else 2).select("id", F.lit(gone).cast("string").alias("deleted_at"),
                                                       F.lit(ver).cast("long").alias("ver"))
        write_replica(rows, replica, "a", "s", batch)
    for _ in range(2):
        compact(spark, replica, "a", schema, ["id"])
    assert loaded_batches(spark, replica, "a") == {"s": [[0, 2]]}
    assert write_replica(spark.range(1).withColumn("deleted_at", F.lit("x")).withColumn("ver", F.lit(9)), replica, "a", "s", 2) is None
    got = read_replica(spark, replica, "a", schema)
    assert sorted((r["id"], r["ver"]) for r in got.collect()) == [(0, 3), (1, 3), (2, 2), (3, 2)]
    assert current_rows(spark, replica, "a", schema, ["id"], deleted="deleted_at").count() == 2
    assert len(folders.names(spark, f"{replica}/dest_table=a")) == 2  # of the replaced ones only the last generation


def test_flat_staged_files(spark, tmp_path):
    folder = tmp_path / "flat"
    folder.mkdir()
    (folder / "100_shop_orders_eu.json").write_text(json.dumps([{"id": "1"}, {"id": "2", "x": "y"}]))
    (folder / "099_users.json").write_text(json.dumps([{"id": "3"}]))
    got = read_staged_files(spark, str(folder), "id STRING, x STRING").collect()
    assert sorted((r["dest_table"], r["staged_at"], r["id"], r["x"] or "") for r in got) == [
        ("shop_orders_eu", "100", "1", ""), ("shop_orders_eu", "100", "2", "y"), ("users", "099", "3", "")]


def test_holds(spark, tmp_path):
    gate = HoldGate(spark, str(tmp_path / "holds"))
    assert gate.held() == set()
    gate.hold("a")
    gate.hold("b")
    gate.release("a")
    assert gate.held() == {"b"} == HoldGate(spark, str(tmp_path / "holds")).held()
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "dest_table STRING, x INT")
    free, held = split_held(rows, gate.held())
    assert sorted(r["x"] for r in free.collect()) == [1, 3] and [r["x"] for r in held.collect()] == [2]
    free, held = split_held(rows, set())
    assert free.count() == 3 and held.count() == 0


def test_views(spark, dirs, tmp_path):
    stage, replica = dirs
    main, other = str(tmp_path / "main"), str(tmp_path / "other")
    view = materialize(spark, "squares", "SELECT id, id * id AS sq FROM {n}", [main, other, main + "/"], n=spark.range(4))
    assert view.count() == 4 == read_view(spark, other).count() == spark.table("squares").count()
    materialize(spark, "squares", "SELECT id, id * id AS sq FROM {n}", [main], n=spark.range(5))
    assert view.count() == 4 and read_view(spark, main).count() == 5  # the old generation can still be read
    gate = HoldGate(spark, str(tmp_path / "holds"))
    stage_batch({"a": rows_a(spark, 0, 3)}, stage, "s", 1)
    common = {"table": "a", "gate": gate, "stage_dir": stage, "replica_dir": replica, "schemas": SCHEMAS}
    with pytest.raises(Exception):
        build_view(spark, "bad", "SELECT nothing FROM {n}", [main], n=spark.range(4), **common)
    assert gate.held() == set() and staged_batches(spark, stage)["a"] == {"s": [[1, 1]]}
    build_view(spark, "good", "SELECT max(id) AS m FROM {n}", [main], n=spark.range(4), **common)
    assert gate.held() == set() and loaded_batches(spark, replica, "a") == {"s": [[1, 1]]}
    drop_view(spark, "squares", [other])
    assert not folders.exists(spark, other)


class Meanwhile:
    """A view during whose update something else happens, once."""

    table = "a"

    def __init__(self, act):
        self.act = act

    def add(self, rows, load):
        act, self.act = self.act, None
        if act:
            act()

    def drop(self, spark, load):
        pass


def test_two_drains_load_each_batch_once(spark, dirs, tmp_path):
    stage, replica = dirs
    view = IncrementalView("a", (), {"n": ("count", F.lit(1)), "total": ("sum", "id")}, str(tmp_path / "view"), replica)
    rejects = {"keys": {"a": ("id",)}, "reject_dir": f"{tmp_path}/rejects"}
    stage_batch({"a": rows_a(spark, 0, 2)}, stage, "s", 1)
    other = Meanwhile(lambda: drain(spark, stage, replica, SCHEMAS, views=[view], **rejects))
    assert drain(spark, stage, replica, SCHEMAS, views=[view, other], **rejects) == {"a": 0}
    assert [tuple(r) for r in view.read(spark).collect()] == [(2, 1)]
    # The other one has fewer batches: the rest of this one is loaded, its misfits are counted.
    bad = rows_a(spark, 4, 6).withColumn("v", F.lit("x"))
    stage_batch({"a": rows_a(spark, 2, 4)}, stage, "s", 2)
    other = Meanwhile(lambda: load_batch(spark, stage, replica, "a", SCHEMAS["a"], {"s": [[2, 2]]}, views=[view], **{
        "keys": ("id",), "reject_dir": rejects["reject_dir"]}))
    stage_batch({"a": bad}, stage, "t", 2)
    stage_batch({"a": rows_a(spark, 6, 9)}, stage, "s", 3)
    assert drain(spark, stage, replica, SCHEMAS, views=[view, other], **rejects) == {"a": 2}
    assert sorted(r["id"] for r in read_replica(spark, replica, "a", SCHEMAS["a"]).collect()) == [0, 1, 2, 3, 6, 7, 8]
    assert [tuple(r) for r in view.read(spark).collect()] == [(7, 27)]
    assert [(e["rows"], e["rejected"]) for e in loads.entries(spark, replica, "a").orderBy("load_no").collect()] == [(2, 0), (2, 0), (3, 2)]
    assert staged_batches(spark, stage) == {}
    assert len(folders.partitions(spark, f"{replica}/dest_table=a", "load")) == 3  # nothing of the loads that gave way


def test_of_two_compactions_one_counts(spark, dirs, monkeypatch):
    _, replica = dirs
    for batch in range(3):
        write_replica(rows_a(spark, 0, 4, ver=batch), replica, "a", "s", batch)
    known = loads.manifest(spark, replica, "a")
    compact(spark, replica, "a", SCHEMAS["a"], ["id"])
    with pytest.raises(loads.Conflict):
        loads.commit(spark, replica, "a", "late", rows=0, batches=known.batches(), known=known,
                     replaces=[e["name"] for e in known.live()])
    assert read_replica(spark, replica, "a", SCHEMAS["a"]).count() == 4


def test_a_batch_staged_again_counts_as_staged_last(spark, dirs):
    stage, replica = dirs
    batches = rows_a(spark, 0, 6).withColumn("batch_id", F.col("id") % 3)
    stage_batch({"a": batches}, stage, "s")
    stage_batch({"a": batches.filter("batch_id = 1").withColumn("v", F.lit(9.0)).limit(1)}, stage, "s")
    stage_batch({"a": batches}, stage, "other")
    assert staged_batches(spark, stage) == {"a": {"s": [[0, 2]], "other": [[0, 2]]}}
    assert load_batch(spark, stage, replica, "a", SCHEMAS["a"], {"s": [[1, 1]]}) == 1
    assert [(r["load_batch"], r["v"]) for r in read_replica(spark, replica, "a", SCHEMAS["a"]).collect()] == [(1, 9.0)]
    assert len(segments(spark, stage, "a")) == 2  # the one with the loaded batch alone is gone
    assert drain(spark, stage, replica, SCHEMAS) == {"a": 5}
    assert read_replica(spark, replica, "a", SCHEMAS["a"]).count() == 11


def test_many_batches_are_a_few_files_and_ranges(spark, dirs):
    stage, replica = dirs
    rows = spark.range(100_000).select("id", F.lit(1.0).alias("v"), F.array(F.lit(1)).alias("tags"), F.lit(0).cast("long").alias("ver"),
                                       (F.col("id") * 2).alias("batch_id"))
    stage_batch({"a": rows.filter("id < 70000").withColumn("batch_id", F.col("id"))}, stage, "s")
    stage_batch({"a": rows.filter("id >= 99000")}, stage, "sparse")
    assert {o: len(v) for o, v in staged_batches(spark, stage)["a"].items()} == {"s": 1, "sparse": 1000}
    assert len(folders.names(spark, f"{stage}/dest_table=a")) == 2
    assert drain(spark, stage, replica, SCHEMAS) == {"a": 71_000}
    assert read_replica(spark, replica, "a", SCHEMAS["a"]).count() == 71_000


def test_what_an_attempt_left_is_removed(spark, dirs):
    stage, _ = dirs
    folders.touch(spark, f"{stage}/_incoming/load_origin=s/dest_table=a/part-0.parquet")
    stage_batch({"a": rows_a(spark, 0, 2)}, stage, "s", 1)
    assert not folders.exists(spark, f"{stage}/_incoming/load_origin=s")


def test_ranges():
    assert loads.without({"a": [[0, 9]], "b": [[3, 3]]}, {"a": [[2, 3], [5, 5], [9, 20]], "b": [[1, 5]]}) == {
        "a": [[0, 1], [4, 4], [6, 8]]}
    assert loads.without({"a": [[0, 1]]}, {}) == {"a": [[0, 1]]}
    assert loads.batch_count({"a": [[0, 1], [4, 4]], "b": [[7, 7]]}) == 4


def test_a_view_outlives_the_loads_it_has_seen(spark, dirs, tmp_path):
    _, replica = dirs
    gate = HoldGate(spark, str(tmp_path / "holds"))
    write_replica(rows_a(spark, 0, 3), replica, "a", "s", 0)
    view = IncrementalView("a", ("k",), {"n": ("count", F.lit(1)), "total": ("sum", "id"), "top": ("max", "id"), "low": ("min", "id")},
                           str(tmp_path / "view"), replica)
    view = IncrementalView("a", ("ver",), view.measures, view.path, replica)
    gate.hold("a", "someone")
    view.build(spark, SCHEMAS["a"], gate)
    assert gate.held() == {"a"}
    seen = 3
    for batch in range(1, 7):
        write_replica(rows_a(spark, batch, batch + 2), replica, "a", "s", batch, [view])
        assert write_replica(rows_a(spark, batch, batch + 2), replica, "a", "s", batch, [view]) is None
        seen += 2
        compact(spark, replica, "a", SCHEMAS["a"], ["id"])
        if batch % 2 == 0:
            view.merge(spark)
            view.merge(spark)
        assert [tuple(r) for r in view.read(spark).collect()] == [(0, seen, 3 + sum(2 * b + 1 for b in range(1, batch + 1)), batch + 1, 0)]
    assert len(folders.partitions(spark, view.path, "load")) <= 3 and len(folders.partitions(spark, view.path, "merged")) <= 2


def test_partials_of_loads_that_never_committed_do_not_count(spark, dirs, tmp_path, monkeypatch):
    _, replica = dirs
    view = IncrementalView("a", (), {"n": ("count", F.lit(1))}, str(tmp_path / "view"), replica)
    write_replica(rows_a(spark, 0, 3), replica, "a", "s", 0, [view])

    def die(*args, **kwargs):
        raise KeyboardInterrupt
    with monkeypatch.context() as patch:
        patch.setattr(loads, "commit", die)
        with pytest.raises(KeyboardInterrupt):
            write_replica(rows_a(spark, 3, 6), replica, "a", "s", 1, [view])
    view.merge(spark)
    assert [r["n"] for r in view.read(spark).collect()] == [3]
    write_replica(rows_a(spark, 3, 6), replica, "a", "s", 1, [view])
    assert [r["n"] for r in view.read(spark).collect()] == [6]


def test_of_two_merges_one_is_announced(spark, dirs, tmp_path, monkeypatch):
    _, replica = dirs
    view = IncrementalView("a", (), {"n": ("count", F.lit(1))}, str(tmp_path / "view"), replica)
    for batch in range(2):
        write_replica(rows_a(spark, 0, 3), replica, "a", "s", batch, [view])
    combined, other = IncrementalView._combined, []

    def combine(self, *args):
        if not other:
            other.append(1)
            view.merge(spark)  # another merge, faster than this one
        return combined(self, *args)
    with monkeypatch.context() as patch:
        patch.setattr(IncrementalView, "_combined", combine)
        view.merge(spark)
    assert len(folders.partitions(spark, view.path, "merged")) == 1
    write_replica(rows_a(spark, 0, 3), replica, "a", "s", 2, [view])
    view.merge(spark)
    assert [r["n"] for r in view.read(spark).collect()] == [9]


def test_rejects_of_many_batches_are_a_file_each(spark, tmp_path):
    from tidemark.sinks.staging import write_rejects
    rows = spark.range(0, 400, 1, 8).select(F.lit("o").alias("load_origin"), (F.col("id") % 10).alias("load_batch"),
                                            F.lit("bad").alias("reject_reason"))
    write_rejects(rows, str(tmp_path / "rejects"), "load-x")
    assert spark.read.json(str(tmp_path / "rejects")).groupBy("load_batch").count().filter("count = 40").count() == 10
    assert len(list((tmp_path / "rejects").rglob("part-*.json"))) == 10
