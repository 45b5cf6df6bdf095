"""The loads of a replica table: what has been committed, in which order (K2, K4).

Layout::

    <replica>/dest_table=<t>/load=<name>/part-*      parquet: the destination's types, load_origin, load_batch
    <replica>/_loads/dest_table=<t>/<number>.json    one file per committed load

A load writes its rows into a folder of its own and then adds its entry under the next free
number.  Adding the entry is the commit: readers only read folders that an entry names, so a
load that died leaves nothing behind.  Numbers rise with the commits, and so tell which of two
rows of equal version was inserted last.

A batch is known by its origin, the stream or job it comes from, and its id there.  Entries
name the batches of their load; a batch that some entry names is not loaded again.

Commits are optimistic: a load is prepared against the entries it has read, and its number is
the one after them.  If another load has taken that number meanwhile, the entries are read
again; a load whose batches are now held by another one, or that replaces loads which are gone,
is in conflict and commits nothing.

A compaction is a load whose entry also names the loads it replaces and all their batches.
Views that follow a table are registered beside its entries, so that they are told before the
entry of a load is forgotten.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sinks import folders

ENTRY_SCHEMA = T.StructType([
    T.StructField("load_no", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("rejected", T.LongType()),
    T.StructField("batches", T.MapType(T.StringType(), T.ArrayType(T.ArrayType(T.LongType())))),
    T.StructField("replaces", T.ArrayType(T.StringType())),
])
# Reserved column names: which batch a row came with.
ORIGIN, BATCH = "load_origin", "load_batch"
Ranges = dict[str, list[list[int]]]


def ranges(ids: Iterable[int]) -> list[list[int]]:
    """Ids as inclusive ranges of neighbours."""
    out: list[list[int]] = []
    for i in sorted(set(ids)):
        if out and out[-1][1] == i - 1:
            out[-1][1] = i
        else:
            out.append([i, i])
    return out


def joined(parts: Iterable[Ranges]) -> Ranges:
    """Ranges of several loads as one set, neighbours merged."""
    found: dict[str, list[list[int]]] = {}
    for part in parts:
        for origin, spans in part.items():
            found.setdefault(origin, []).extend(list(s) for s in spans)
    out: Ranges = {}
    for origin, spans in found.items():
        merged: list[list[int]] = []
        for low, high in sorted(spans):
            if merged and low <= merged[-1][1] + 1:
                merged[-1][1] = max(merged[-1][1], high)
            else:
                merged.append([low, high])
        out[origin] = merged
    return out


def without(one: Ranges, two: Ranges) -> Ranges:
    """The batches of ``one`` that ``two`` does not name."""
    out: Ranges = {}
    taken = joined([two])
    for origin, spans in joined([one]).items():
        left: list[list[int]] = []
        gaps, at = taken.get(origin, []), 0
        for low, high in spans:
            while at < len(gaps) and gaps[at][0] <= high:
                start, end = gaps[at]
                if start > low:
                    left.append([low, start - 1])
                low = max(low, end + 1)
                if end > high:  # the next span may begin in it
                    break
                at += 1
            if low <= high:
                left.append([low, high])
        if left:
            out[origin] = left
    return out


def batch_count(batches: Ranges) -> int:
    return sum(high - low + 1 for spans in batches.values() for low, high in spans)


class Conflict(Exception):
    """Another load holds some of the batches, or has replaced what this one replaces.

    ``known`` is the manifest read last, ``left`` the batches no other load holds.
    """

    def __init__(self, known: Manifest, left: Ranges):
        super().__init__("another load was faster")
        self.known, self.left = known, left


@dataclass
class Manifest:
    """The committed loads of one table."""

    entries: list[dict[str, Any]] = field(default_factory=list)

    def live(self) -> list[dict[str, Any]]:
        """Entries whose rows count: all that no compaction has replaced."""
        gone = {name for e in self.entries for name in e["replaces"] or ()}
        return [e for e in self.entries if e["name"] not in gone]

    def batches(self) -> Ranges:
        return joined(e["batches"] or {} for e in self.entries)

    def has(self, origin: str, batch_id: int) -> bool:
        return any(low <= batch_id <= high for low, high in self.batches().get(origin, ()))

    def next_number(self) -> int:
        return max((e["load_no"] for e in self.entries), default=-1) + 1


def _folder(replica_dir: str, dest: str) -> str:
    return f"{replica_dir}/_loads/dest_table={dest}"


def entries(spark: SparkSession, replica_dir: str, dest: str) -> DataFrame:
    """The committed loads as rows: the load report of the table."""
    path = _folder(replica_dir, dest)
    if not folders.exists(spark, path):
        return spark.createDataFrame([], ENTRY_SCHEMA)
    return spark.read.schema(ENTRY_SCHEMA).json(path)


def manifest(spark: SparkSession, replica_dir: str, dest: str) -> Manifest:
    """One small row per load since the last compaction."""
    rows = entries(spark, replica_dir, dest).orderBy("load_no").toLocalIterator()
    return Manifest([r.asDict() for r in rows])


def new_name() -> str:
    return uuid.uuid4().hex


def load_path(replica_dir: str, dest: str, name: str) -> str:
    return f"{replica_dir}/dest_table={dest}/load={name}"


def commit(spark: SparkSession, replica_dir: str, dest: str, name: str, *, rows: int, rejected: int = 0,
           batches: Ranges, replaces: Iterable[str] = (), known: Manifest) -> int:
    """Add the load's entry under the number after ``known``, the manifest it was prepared with.

    Two writers never get the same number, and a load that another one has made superfluous
    raises ``Conflict``.
    """
    replaces = list(replaces)
    while True:
        number = known.next_number()
        text = json.dumps({"load_no": number, "name": name, "rows": rows, "rejected": rejected,
                           "batches": batches, "replaces": replaces})
        try:
            folders.write_new(spark, _folder(replica_dir, dest), f"{number:012d}.json", text)
            return number
        except FileExistsError:
            known = manifest(spark, replica_dir, dest)
            if replaces:
                if not set(replaces) <= {e["name"] for e in known.live()}:
                    raise Conflict(known, {}) from None
            elif (left := without(batches, known.batches())) != joined([batches]):
                raise Conflict(known, left) from None


def register_view(spark: SparkSession, replica_dir: str, dest: str, path: str) -> None:
    """Note that partials at ``path`` follow the table."""
    folder = f"{_folder(replica_dir, dest)}/_views"
    name = uuid.uuid5(uuid.NAMESPACE_URL, path).hex + ".json"
    if name not in folders.names(spark, folder):
        try:
            folders.write_new(spark, folder, name, json.dumps({"path": path}))
        except FileExistsError:
            pass


def count_partial(spark: SparkSession, path: str, load: str) -> None:
    """Mark a load's partial of a view as that of a committed load."""
    folders.touch(spark, f"{path}/_counted/{load}")


def read_loads(spark: SparkSession, replica_dir: str, dest: str, schema: T.StructType) -> DataFrame:
    """Rows of all live loads with ``load_origin``, ``load_batch`` and ``load_no``."""
    full = T.StructType(list(schema.fields)).add(ORIGIN, T.StringType()).add(BATCH, T.LongType())
    live = manifest(spark, replica_dir, dest).live()
    if not live:
        return spark.createDataFrame([], full.add("load_no", T.LongType()))
    stored = T.StructType(list(full.fields)).add("kept_no", T.LongType()).add("load", T.StringType())
    rows = spark.read.schema(stored).option("basePath", f"{replica_dir}/dest_table={dest}") \
        .parquet(*[load_path(replica_dir, dest, e["name"]) for e in live])
    numbers = entries(spark, replica_dir, dest).select(F.col("name").alias("load"), "load_no")
    return rows.join(numbers, "load").select(
        *[f"`{f.name}`" for f in full.fields], F.coalesce("kept_no", "load_no").alias("load_no"))


def sweep(spark: SparkSession, replica_dir: str, dest: str, keep: Iterable[str]) -> None:
    """Remove folders and entries of loads that earlier compactions replaced, but those in ``keep``.

    Views are told first which of these loads count.
    """
    known = manifest(spark, replica_dir, dest)
    replaced = {name for e in known.entries for name in e["replaces"] or ()} - set(keep)
    gone = [e for e in known.entries if e["name"] in replaced]
    views = f"{_folder(replica_dir, dest)}/_views"
    paths = [r["path"] for r in spark.read.schema("path STRING").json(f"{views}/*.json").toLocalIterator()] \
        if gone and folders.names(spark, views) else []
    for path in paths:
        partials = set(folders.partitions(spark, path, "load"))
        for entry in gone:
            if entry["name"] in partials:
                count_partial(spark, path, entry["name"])
    for entry in gone:
        folders.remove(spark, load_path(replica_dir, dest, entry["name"]))
        folders.remove(spark, f"{_folder(replica_dir, dest)}/{entry['load_no']:012d}.json")
