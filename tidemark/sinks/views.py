"""Materialised views from user SQL, and views that follow the loads (M1)."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sinks import folders, loads
from tidemark.sinks.staging import Defaults, HoldGate, Keys, Schemas, drain

GENERATION = "generation"


def read_view(spark: SparkSession, target: str) -> DataFrame:
    """The newest complete generation at a target."""
    newest = max(map(int, folders.partitions(spark, f"{target}/_ready", GENERATION)))
    return spark.read.parquet(f"{target}/{GENERATION}={newest}")


def _store(view: DataFrame, target: str) -> None:
    """Write a new generation and then announce it: readers never meet a gap, and a failure
    leaves the one before.  Generations before that one are removed."""
    spark = view.sparkSession
    known = sorted(map(int, folders.partitions(spark, f"{target}/_ready", GENERATION)))
    number = known[-1] + 1 if known else 0
    view.write.mode("overwrite").parquet(f"{target}/{GENERATION}={number}")
    folders.touch(spark, f"{target}/_ready/{GENERATION}={number}")
    for old in known[:-1]:
        folders.remove(spark, f"{target}/_ready/{GENERATION}={old}")
        folders.remove(spark, f"{target}/{GENERATION}={old}")


def materialize(spark: SparkSession, name: str, sql: str, targets: Sequence[str],
                **frames: DataFrame) -> DataFrame:
    """Run ``sql`` once and store it at every target; targets with the same address count once.

    ``frames`` may be named in the text as ``{name}``.  The first target is computed, the
    others copy it.  Any failure is raised; success registers the view as ``name``.
    """
    first, *copies = dict.fromkeys(t.rstrip("/") for t in targets)
    _store(spark.sql(sql, **frames), first)
    stored = read_view(spark, first)
    for copy in copies:
        _store(stored, copy)
    stored.createOrReplaceTempView(name)
    return stored


def build_view(spark: SparkSession, name: str, sql: str, targets: Sequence[str], *, table: str,
               gate: HoldGate, stage_dir: str, replica_dir: str, schemas: Schemas,
               defaults: Defaults | None = None, keys: Keys | None = None, reject_dir: str | None = None,
               **frames: DataFrame) -> DataFrame:
    """Hold ``table``, build the view, release the hold and load what was staged meanwhile.

    The view is a snapshot; ``IncrementalView`` follows the loads.  A failure releases the hold
    as well, and is raised; staged batches then wait for the next drain.
    """
    holder = loads.new_name()
    gate.hold(table, holder)
    try:
        view = materialize(spark, name, sql, targets, **frames)
    finally:
        gate.release(table, holder)
    drain(spark, stage_dir, replica_dir, schemas, defaults, keys=keys, reject_dir=reject_dir, held=gate.held())
    return view


@dataclass(frozen=True)
class IncrementalView:
    """An aggregate over all rows that loads have brought to a table since the view was built.

    Given to ``load_batch``, ``drain`` or ``replicate`` as one of ``views``, every load adds its
    partial before it commits.  ``build`` starts the view from the loads there are, while the
    table is held; of rows that were compacted before, those the replica still has.

    The view keeps account of its partials itself, since entries of loads do not last::

        <path>/load=<name>/part-*          the partial of a load
        <path>/_counted/<name>             the load has committed, and its entry may be gone
        <path>/merged=<name>/part-*        partials combined
        <path>/_merged/<g>.json            their generation: the folder, and the loads it covers newly

    A partial counts if its load has an entry or is marked as counted; ``loads.sweep`` marks it
    before it forgets the entry.  A partial whose load never committed does not count.  ``merge``
    turns generation and partials into the next generation; the partials that covers go with
    the merge after it, so that readers may finish.
    """

    table: str
    keys: tuple[str, ...]
    measures: dict[str, tuple[str, str | Column]]
    path: str
    replica_dir: str

    def add(self, rows: DataFrame, load: str) -> None:
        loads.register_view(rows.sparkSession, self.replica_dir, self.table, self.path)
        _partial(rows, self.keys, self.measures).write.mode("overwrite").parquet(f"{self.path}/load={load}")

    def drop(self, spark: SparkSession, load: str) -> None:
        folders.remove(spark, f"{self.path}/load={load}")

    def build(self, spark: SparkSession, schema: T.StructType, gate: HoldGate) -> None:
        holder = loads.new_name()
        gate.hold(self.table, holder)
        try:
            full = T.StructType(list(schema.fields))
            live = loads.manifest(spark, self.replica_dir, self.table).live()
            number, _, covered = self._generation(spark)
            known = {*folders.partitions(spark, self.path, "load"), *covered}
            if number >= 0:
                return  # it has been built and merged since
            for entry in live:
                if entry["name"] not in known and not set(entry["replaces"] or ()) & known:
                    self.add(spark.read.schema(full).parquet(
                        loads.load_path(self.replica_dir, self.table, entry["name"])), entry["name"])
        finally:
            gate.release(self.table, holder)

    def _generation(self, spark: SparkSession) -> tuple[int, str | None, set[str]]:
        """The newest generation: its number (-1 if there is none), folder and newly covered loads."""
        found = [int(n.removesuffix(".json")) for n in folders.names(spark, f"{self.path}/_merged") if n.endswith(".json")]
        return self._announced(spark, max(found)) if found else (-1, None, set())

    def _announced(self, spark: SparkSession, number: int) -> tuple[int, str | None, set[str]]:
        row = spark.read.schema("folder STRING, covers ARRAY<STRING>").json(f"{self.path}/_merged/{number:012d}.json").first()
        return number, row["folder"], set(row["covers"])

    def _counting(self, spark: SparkSession, covered: set[str]) -> list[str]:
        """Loads whose partials count beside the newest generation."""
        counted = set(folders.names(spark, f"{self.path}/_counted"))
        known = {e["name"] for e in loads.manifest(spark, self.replica_dir, self.table).entries}
        return [n for n in folders.partitions(spark, self.path, "load") if n in known | counted and n not in covered]

    def _combined(self, spark: SparkSession, folder: str | None, names: Sequence[str]) -> DataFrame:
        paths = [f"{self.path}/load={n}" for n in names] + ([] if folder is None else [f"{self.path}/{folder}"])
        return spark.read.parquet(*paths).select(*self.keys, *self.measures).groupBy(*self.keys).agg(
            *[COMBINE[fn](name).alias(name) for name, (fn, _) in self.measures.items()])

    def read(self, spark: SparkSession) -> DataFrame:
        """All that counts, combined.  A compaction of the replica adds nothing: its rows are counted."""
        _, folder, covered = self._generation(spark)
        return self._combined(spark, folder, self._counting(spark, covered))

    def merge(self, spark: SparkSession) -> None:
        """Combine the partials into a new generation: thousands of them become one.

        Of two merges at a time one is announced; the other's work is dropped.
        """
        number, folder, covered = self._generation(spark)
        names = self._counting(spark, covered)
        if not names:
            return
        merged = f"merged={loads.new_name()}"
        self._combined(spark, folder, names).write.parquet(f"{self.path}/{merged}")
        # What the present generation covers is read no more, and must be gone before the next one,
        # which does not name it.
        for name in covered:
            folders.remove(spark, f"{self.path}/load={name}")
            folders.remove(spark, f"{self.path}/_counted/{name}")
        if number > 0:
            folders.remove(spark, f"{self.path}/{self._announced(spark, number - 1)[1]}")
        try:
            folders.write_new(spark, f"{self.path}/_merged", f"{number + 1:012d}.json",
                              json.dumps({"folder": merged, "covers": names}))
        except FileExistsError:
            folders.remove(spark, f"{self.path}/{merged}")


# Aggregates whose partial results combine with an aggregate of the same rows.
COMBINE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}
_PARTIAL = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}


def _partial(rows: DataFrame, keys: Sequence[str], measures: dict[str, tuple[str, str | Column]]) -> DataFrame:
    return rows.groupBy(*keys).agg(*[_PARTIAL[fn](col).alias(name) for name, (fn, col) in measures.items()])


def drop_view(spark: SparkSession, name: str, targets: Sequence[str]) -> None:
    spark.catalog.dropTempView(name)
    for target in targets:
        folders.remove(spark, target)
