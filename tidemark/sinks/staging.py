"""Staged batches and the replica they are loaded into.

Layout::

    <stage>/dest_table=<t>/segment=<n>-<name>/part-*            load_origin, load_batch, value: a JSON object
    <rejects>/kind=<k>/load_origin=<o>/load_batch=<n>/part-*    rows left out, with the reason

A segment is what one call stages for one destination, any number of batches in few files.  The
rows are sorted by batch, so that the files' own statistics say which batches they hold: they
are the index.  ``origin`` names the stream or job a batch comes from; batch ids count within
it, so several streams and jobs may feed one table.  A batch staged again replaces the earlier
one, a segment later in number counts, so repeating a batch leaves the same rows.  A segment
goes when all its batches are loaded.  Which batches there are is known as ranges of ids; no
step of the driver goes batch by batch.  The replica's own layout and commits are described in
``loads``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from collections.abc import Mapping as Dict
from functools import reduce
from typing import Any, Protocol

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.convert import convert_record, to_json_rows
from tidemark.operators.batches import load_report
from tidemark.operators.conform import conform, fitted, misfit_columns
from tidemark.operators.replica import latest_state
from tidemark.operators.route import REJECTED
from tidemark.sinks import folders, loads

Schemas = Dict[str, T.StructType]
Defaults = Dict[str, Dict[str, Any]]
Keys = Dict[str, Sequence[str]]
# Reserved names: which batch a row came with.
ORIGIN, BATCH = loads.ORIGIN, loads.BATCH
BY_BATCH = ("dest_table", ORIGIN, BATCH)
RANGE_BITS = 16  # ids whose ranges one task joins
MANY_RANGES = 200  # that a filter names


class LoadedRows(Protocol):
    """Something fed by every load of a table, such as an incremental view."""

    table: str

    def add(self, rows: DataFrame, load: str) -> None: ...

    def drop(self, spark: SparkSession, load: str) -> None: ...


def _replace(df: DataFrame, path: str, fmt: str, *by: str) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*by).format(fmt).save(path))


def stage_wire(wire: DataFrame, stage_dir: str, origin: str, batch_id: int | None = None) -> None:
    """Write ``dest_table, value`` rows of all destinations to the stage, in one job.

    The rows bring their own ``batch_id`` column unless one number is given for all.  An origin
    stages one thing at a time; what an earlier attempt has left unfinished is removed.
    """
    spark = wire.sparkSession
    single = batch_id is not None
    if single:
        wire = wire.withColumn("batch_id", F.lit(batch_id).cast("long"))
    rows = wire.select("dest_table", F.lit(origin).alias(ORIGIN), F.col("batch_id").alias(BATCH), "value")
    if not single:
        rows = rows.sortWithinPartitions("dest_table", BATCH)
    # Written aside and then moved: whoever drains the stage meanwhile sees whole segments only.
    aside = f"{stage_dir}/_incoming/{ORIGIN}={origin}"
    folders.remove(spark, aside)
    rows.write.partitionBy("dest_table").parquet(aside)
    for dest in folders.partitions(spark, aside, "dest_table"):
        last = max((int(n.split("-")[0]) for n in segments(spark, stage_dir, dest)), default=-1)
        folders.move(spark, f"{aside}/dest_table={dest}",
                     f"{stage_dir}/dest_table={dest}/segment={last + 1:012d}-{loads.new_name()}")
    folders.remove(spark, aside)


def stage_rows(routed: Dict[str, DataFrame], batch_id: int | None = None) -> DataFrame:
    """Routed rows of all destinations as wire text: ``dest_table, batch_id, value``.

    Frames bring their own ``batch_id`` column unless one number is given for all.
    """
    parts = []
    for dest, frame in routed.items():
        if batch_id is not None:
            frame = frame.withColumn("batch_id", F.lit(batch_id).cast("long"))
        wire = convert_record(frame, keep=("batch_id",))
        lines = to_json_rows(wire, keep=("batch_id",))
        parts.append(lines.select(F.lit(dest).alias("dest_table"), "batch_id", "value"))
    return reduce(DataFrame.unionByName, parts)


def stage_batch(routed: Dict[str, DataFrame], stage_dir: str, origin: str, batch_id: int | None = None) -> None:
    """Write the batch of every destination to the stage, in one job."""
    stage_wire(stage_rows(routed, batch_id), stage_dir, origin)


def segments(spark: SparkSession, stage_dir: str, dest: str) -> list[str]:
    """The staged segments of a destination, in order."""
    return folders.partitions(spark, f"{stage_dir}/dest_table={dest}", "segment")


def _segment_rows(spark: SparkSession, stage_dir: str, dest: str, names: Iterable[str]) -> DataFrame:
    """Rows of the named segments; files removed meanwhile are passed over."""
    schema = T.StructType([T.StructField(ORIGIN, T.StringType()), T.StructField(BATCH, T.LongType()),
                           T.StructField("value", T.StringType()), T.StructField("segment", T.StringType())])
    base = f"{stage_dir}/dest_table={dest}"
    paths = [p for p in (f"{base}/segment={n}" for n in names) if folders.exists(spark, p)]
    if not paths:
        return spark.createDataFrame([], schema)
    # A segment goes only after a load with its batches has committed; whoever still reads it finds
    # these batches taken when it commits.
    return spark.read.schema(schema).option("basePath", base).option("ignoreMissingFiles", True).parquet(*paths)


def _held_ranges(rows: DataFrame) -> loads.Ranges:
    """The batches of the rows as ranges: neighbours are joined where they are counted."""
    ids = rows.select(ORIGIN, BATCH).distinct()
    part = F.shiftright(BATCH, RANGE_BITS)
    order = Window.partitionBy(ORIGIN, part).orderBy(BATCH)
    spans = ids.withColumn("island", F.col(BATCH) - F.row_number().over(order)) \
        .groupBy(ORIGIN, part.alias("part"), "island").agg(F.min(BATCH).alias("low"), F.max(BATCH).alias("high"))
    return loads.joined({r[ORIGIN]: [[r["low"], r["high"]]]} for r in spans.toLocalIterator())


def staged_batches(spark: SparkSession, stage_dir: str) -> dict[str, loads.Ranges]:
    """Destination → origin → inclusive ranges of the batches that are staged."""
    found = {dest: _held_ranges(_segment_rows(spark, stage_dir, dest, segments(spark, stage_dir, dest)))
             for dest in folders.partitions(spark, stage_dir, "dest_table")}
    return {dest: batches for dest, batches in found.items() if batches}


def loaded_batches(spark: SparkSession, replica_dir: str, dest: str) -> loads.Ranges:
    """Origin → inclusive ranges of the batches that have been loaded."""
    return loads.manifest(spark, replica_dir, dest).batches()


def _wire_type(dtype: T.DataType) -> T.DataType:
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_wire_type(dtype.elementType))
    return T.StringType()


def wire_schema(schema: T.StructType) -> T.StructType:
    """How the destination's columns look in staged text: lists of text, or text."""
    return T.StructType([T.StructField(f.name, _wire_type(f.dataType)) for f in schema.fields])


def only_batches(rows: DataFrame, batches: loads.Ranges) -> DataFrame:
    """Rows of the named batches: by ranges, which reach the files' statistics, while these are
    few, else by a join with the ids."""
    spans = [(origin, low, high) for origin, own in batches.items() for low, high in own]
    if len(spans) > MANY_RANGES:
        named = rows.sparkSession.createDataFrame(spans, f"{ORIGIN} STRING, low LONG, high LONG")
        ids = named.select(ORIGIN, F.explode(F.sequence("low", "high")).alias(BATCH))
        return rows.join(ids, [ORIGIN, BATCH], "left_semi").select(*rows.columns)
    named = F.lit(False)
    for origin, low, high in spans:
        named = named | ((F.col(ORIGIN) == origin) & F.col(BATCH).between(low, high))
    return rows.filter(named)


def read_staged(spark: SparkSession, stage_dir: str, dest: str, schema: T.StructType,
                batches: loads.Ranges | None = None, names: Sequence[str] | None = None) -> DataFrame:
    """Staged rows of one destination with their origin and batch; only the named batches are read."""
    names = segments(spark, stage_dir, dest) if names is None else names
    rows = _segment_rows(spark, stage_dir, dest, names)
    if batches is not None:
        rows = only_batches(rows, batches)
    if len(names) > 1:
        # A batch staged again counts as it was staged last.
        seen = rows.select(ORIGIN, BATCH, "segment").distinct()
        last = seen.groupBy(ORIGIN, BATCH).agg(F.max("segment").alias("last"))
        stale = seen.join(last, [ORIGIN, BATCH]).filter("segment < last").drop("last")
        rows = rows.join(stale, [ORIGIN, BATCH, "segment"], "left_anti")
    columns = [F.col("_row").getField(f.name).alias(f.name) for f in schema.fields]
    return rows.select(F.from_json("value", wire_schema(schema)).alias("_row"), ORIGIN, BATCH) \
        .select(*columns, ORIGIN, BATCH)


def drop_segments(spark: SparkSession, stage_dir: str, dest: str, names: Iterable[str], done: loads.Ranges) -> None:
    """Remove those of the segments whose batches are all among ``done``."""
    for name in names:
        own = _held_ranges(_segment_rows(spark, stage_dir, dest, [name]))
        if not loads.without(own, done):
            folders.remove(spark, f"{stage_dir}/dest_table={dest}/segment={name}")


def clear_stage(spark: SparkSession, stage_dir: str) -> None:
    """Remove what is staged for destinations; refused rows stay until a drain takes them."""
    for dest in folders.partitions(spark, stage_dir, "dest_table"):
        if dest != REJECTED:
            folders.remove(spark, f"{stage_dir}/dest_table={dest}")


def staged_name_parts(file_name: Column) -> tuple[Column, Column]:
    """(time text, table) out of a flat staged-file name, ``<time>_<table>.json``.

    Only the first underscore separates; tables may hold more of them.
    """
    pattern = r"^([^_]*)_(.*?)(?:\.json)?$"
    return F.regexp_extract(file_name, pattern, 1), F.regexp_extract(file_name, pattern, 2)


def read_staged_files(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Rows of flat staged files, each a JSON list, with ``staged_at`` and ``dest_table``."""
    rows = spark.read.schema(schema).option("multiLine", "true").json(path)
    staged_at, dest = staged_name_parts(F.col("_metadata.file_name"))
    return rows.select(staged_at.alias("staged_at"), dest.alias("dest_table"), "*")


def write_rejects(rejected: DataFrame, reject_dir: str, kind: str) -> None:
    """Keep rejected rows (with their origin and batch), replacing those of an earlier attempt."""
    # A batch goes to few tasks, a large one to several: not a file of every batch from every task.
    together = rejected.hint("rebalance", ORIGIN, BATCH)
    _replace(together.withColumn("kind", F.lit(kind)), reject_dir, "json", "kind", ORIGIN, BATCH)


def write_replica(df: DataFrame, replica_dir: str, dest: str, origin: str, batch_id: int,
                  views: Iterable[LoadedRows] = ()) -> int | None:
    """Append conformed rows to a replica table as one batch; returns the load's number.

    A batch that has been loaded is not loaded again (none is returned).
    """
    known = loads.manifest(df.sparkSession, replica_dir, dest)
    if known.has(origin, batch_id):
        return None
    rows = df.withColumns({ORIGIN: F.lit(origin), BATCH: F.lit(batch_id).cast("long")})
    done = _append(rows, replica_dir, dest, {origin: [[batch_id, batch_id]]}, known, views)
    return done[0] if done else None


def _append(rows: DataFrame, replica_dir: str, dest: str, batches: loads.Ranges, known: loads.Manifest,
            views: Iterable[LoadedRows], rejected: Callable[[loads.Ranges], int] | None = None
            ) -> tuple[int, loads.Ranges] | None:
    """Write the rows and commit them as one load: its number and batches.

    Batches that another load has committed meanwhile are left out; none is returned if that
    leaves nothing.
    """
    spark, earlier = rows.sparkSession, None
    views = [v for v in views if v.table == dest]
    while True:
        name = loads.new_name()
        path = loads.load_path(replica_dir, dest, name)
        seen = Observation(f"load-{name}")
        rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
        if earlier is not None:
            _withdraw(spark, replica_dir, dest, earlier, views)
        for view in views:
            view.add(spark.read.schema(rows.schema).parquet(path), name)
        try:
            number = loads.commit(spark, replica_dir, dest, name, rows=seen.get.get("rows", 0), batches=batches,
                                  rejected=rejected(batches) if rejected else 0, known=known)
            return number, batches
        except loads.Conflict as conflict:
            batches, known, earlier = conflict.left, conflict.known, name
            if not batches:
                _withdraw(spark, replica_dir, dest, name, views)
                return None
            rows = only_batches(spark.read.schema(rows.schema).parquet(path), batches)


def _withdraw(spark: SparkSession, replica_dir: str, dest: str, name: str, views: Iterable[LoadedRows]) -> None:
    """Remove what a load that did not commit has written."""
    for view in views:
        view.drop(spark, name)
    folders.remove(spark, loads.load_path(replica_dir, dest, name))


def load_batch(spark: SparkSession, stage_dir: str, replica_dir: str, dest: str, schema: T.StructType,
               batches: loads.Ranges | None = None, defaults: Dict[str, Any] | None = None, *,
               keys: Sequence[str] = (), reject_dir: str | None = None,
               views: Iterable[LoadedRows] = (), report_failure: bool = True) -> int:
    """Load staged batches of one destination, all by default, as one load; then drop their segments.

    Batches already loaded are not loaded again, nor are those that another load commits before
    this one does.  With ``reject_dir``, rows with values that do not parse or without a key go
    there with their reason, and the rest is loaded.  Without it such a value fails the load:
    nothing is committed, the segments stay, and the batches and their ids are reported under
    ``<replica>/_failed``, unless the caller says that it tries them one by one.  Returns the
    number of batches loaded.
    """
    names = segments(spark, stage_dir, dest)
    wanted = _held_ranges(_segment_rows(spark, stage_dir, dest, names)) if batches is None else batches
    known = loads.manifest(spark, replica_dir, dest)
    fresh, done = loads.without(wanted, known.batches()), None
    if fresh:
        whole = batches is None and fresh == wanted  # then the segments hold nothing else
        staged = read_staged(spark, stage_dir, dest, schema, None if whole else fresh, names)
        keep = (ORIGIN, BATCH)
        try:
            if reject_dir is None:
                done = _append(conform(staged, schema, defaults, keep), replica_dir, dest, fresh, known, views)
            else:
                marked = staged.withColumn("bad_columns", misfit_columns(staged, schema, tuple(keys)))
                misfits = Observation(f"misfits-{loads.new_name()}")
                is_bad = F.size("bad_columns") > 0
                good = marked.observe(misfits, F.count_if(is_bad).alias("rows")).filter(~is_bad)
                kind = f"load-{dest}"

                def keep_rejects(own: loads.Ranges) -> int:
                    found = misfits.get.get("rows", 0)
                    if not found:
                        return 0
                    if own != fresh:  # the rest of them was another load's
                        kept = spark.read.option("basePath", reject_dir).json(f"{reject_dir}/kind={kind}")
                        return only_batches(kept, own).count()
                    reason = F.concat(F.lit("does not fit: "), F.array_join("bad_columns", ", "))
                    value = F.to_json(F.struct(*[f"`{c}`" for c in wire_schema(schema).names]))
                    write_rejects(marked.filter(is_bad).select(
                        F.lit(dest).alias("dest_table"), reason.alias("reject_reason"), value.alias("value"), *keep),
                        reject_dir, kind)
                    return found

                done = _append(fitted(good, schema, defaults, keep), replica_dir, dest, fresh, known, views, keep_rejects)
        except Exception:
            if report_failure:
                _report_failure(staged, replica_dir, dest, schema)
            raise
    if batches is None:
        for name in names:
            folders.remove(spark, f"{stage_dir}/dest_table={dest}/segment={name}")
    else:
        drop_segments(spark, stage_dir, dest, names, loads.joined([wanted, known.batches()]))
    return loads.batch_count(done[1]) if done else 0


def _report_failure(staged: DataFrame, replica_dir: str, dest: str, schema: T.StructType) -> None:
    """Rows and first id of each batch of a failed load, and all its ids, one to a row."""
    key = schema.names[0] if schema.names else None
    order = "ver" if "ver" in schema.names else key
    rows = staged.withColumn("dest_table", F.lit(dest))
    load_report(rows, key, order, by=BY_BATCH).write.mode("append").json(f"{replica_dir}/_failed/batches")
    if key is not None:
        rows.select(*BY_BATCH, F.col(f"`{key}`").alias("id")).write.mode("append").json(f"{replica_dir}/_failed/ids")


def loaded_report(spark: SparkSession, replica_dir: str, dest: str, schema: T.StructType, key: str = "id",
                  order: str = "ver") -> DataFrame:
    """Per loaded batch its rows, first id and the number of its load."""
    rows = read_replica(spark, replica_dir, dest, schema).withColumn("dest_table", F.lit(dest))
    return load_report(rows, key, order, by=(*BY_BATCH, "load_no"))


def drain(spark: SparkSession, stage_dir: str, replica_dir: str, schemas: Schemas,
          defaults: Defaults | None = None, *, keys: Keys | None = None, reject_dir: str | None = None,
          held: Iterable[str] = (), views: Iterable[LoadedRows] = (), report_failure: bool = True) -> dict[str, int]:
    """Load everything staged for destinations not held: destination → number of batches loaded.

    What the rules refused moves from the stage to ``reject_dir``.
    """
    done, waiting = {}, set(held)
    for dest in folders.partitions(spark, stage_dir, "dest_table"):
        if dest in waiting or not segments(spark, stage_dir, dest):
            continue
        if dest == REJECTED:
            if reject_dir is not None:
                _move_rejects(spark, stage_dir, reject_dir)
            continue
        done[dest] = load_batch(spark, stage_dir, replica_dir, dest, schemas[dest], None,
                                (defaults or {}).get(dest), keys=(keys or {}).get(dest, ()),
                                reject_dir=reject_dir, views=views, report_failure=report_failure)
    return done


REJECT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("source_table", "reject_reason", "value")])


def _move_rejects(spark: SparkSession, stage_dir: str, reject_dir: str) -> None:
    names = segments(spark, stage_dir, REJECTED)
    write_rejects(read_staged(spark, stage_dir, REJECTED, REJECT_SCHEMA, names=names), reject_dir, "route")
    for name in names:
        folders.remove(spark, f"{stage_dir}/dest_table={REJECTED}/segment={name}")


def read_replica(spark: SparkSession, replica_dir: str, dest: str, schema: T.StructType) -> DataFrame:
    """All loaded versions of a table with ``load_origin``, ``load_batch`` and ``load_no``; of rows of one
    version, the one with the greatest ``load_no`` was inserted last."""
    return loads.read_loads(spark, replica_dir, dest, schema)


def current_rows(spark: SparkSession, replica_dir: str, dest: str, schema: T.StructType, keys: Iterable[str],
                 ver: str = "ver", deleted: str | None = None) -> DataFrame:
    """The latest row per key: greatest version, then last inserted."""
    rows = read_replica(spark, replica_dir, dest, schema)
    return latest_state(rows, list(keys), ver=ver, tie="load_no", deleted=deleted).drop(ORIGIN, BATCH, "load_no")


def compact(spark: SparkSession, replica_dir: str, dest: str, schema: T.StructType, keys: Iterable[str],
            ver: str = "ver") -> None:
    """Replace the loads of a table by one load with its latest rows.

    Thousands of small loads become a few large files.  The new load names all batches it
    covers, so that a replay of one of them is still known, and the rows keep the numbers of
    their loads.  Loads that commit meanwhile stay beside it.  Tombstones are kept, so that an
    older version arriving later still loses.  Readers of the replaced loads may finish: their
    files go with the next compaction.
    """
    before = loads.manifest(spark, replica_dir, dest)
    live = before.live()
    if not live:
        return
    rows = read_replica(spark, replica_dir, dest, schema)
    latest = latest_state(rows, list(keys), ver=ver, tie="load_no").withColumnRenamed("load_no", "kept_no")
    name = loads.new_name()
    seen = Observation(f"compact-{name}")
    latest.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(loads.load_path(replica_dir, dest, name))
    names = [e["name"] for e in live]
    try:
        loads.commit(spark, replica_dir, dest, name, rows=seen.get.get("rows", 0), batches=before.batches(),
                     replaces=names, known=before)
    except loads.Conflict:  # another compaction was faster: its rows stand for these
        folders.remove(spark, loads.load_path(replica_dir, dest, name))
        return
    loads.sweep(spark, replica_dir, dest, keep=names)


def split_held(rows: DataFrame, held: Iterable[str], dest: str = "dest_table") -> tuple[DataFrame, DataFrame]:
    """(rows free to load, rows of held destinations)."""
    names = sorted(held)
    if not names:
        return rows, rows.filter(F.lit(False))
    is_held = F.coalesce(F.col(dest).isin(names), F.lit(False))
    return rows.filter(~is_held), rows.filter(is_held)


class HoldGate:
    """Held destinations, as marker files in a shared folder: a restart keeps them.

    A destination stays held until every holder has released it.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def hold(self, dest: str, holder: str = "anyone") -> None:
        folders.touch(self.spark, f"{self.folder}/dest_table={dest}/holder={holder}")

    def release(self, dest: str, holder: str = "anyone") -> None:
        folders.remove(self.spark, f"{self.folder}/dest_table={dest}/holder={holder}")

    def held(self) -> set[str]:
        return {dest for dest in folders.partitions(self.spark, self.folder, "dest_table")
                if folders.partitions(self.spark, f"{self.folder}/dest_table={dest}", "holder")}
