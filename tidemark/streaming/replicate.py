"""The live path as one streaming query: feed → filter → version → route → convert → load."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from collections.abc import Mapping as Dict
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.changes import filter_mapped, live_changes, stamp_version
from tidemark.operators.route import has_script, rejected, route, sent_row, wire_of, wire_table
from tidemark.sinks.staging import Defaults, Keys, LoadedRows, Schemas, drain, stage_wire
from tidemark.sources.feed import CORRUPT, table_changes
from tidemark.sources.mapping import Mapping

LIVE_INTERVAL = "5 seconds"


def live_tables(changes: DataFrame, mapping: Mapping,
                record_schemas: Dict[str, T.StructType] | None = None,
                by: str = "seq") -> dict[str, DataFrame]:
    """Change rows of many tables → versioned live rows per mapped table."""
    live = stamp_version(live_changes(filter_mapped(changes, mapping)), by=by)
    return {
        table: table_changes(live, table, (record_schemas or {}).get(table), keep=("ver",))
        for table in mapping.distinct_tables()
    }


def route_changes(changes: DataFrame, mapping: Mapping,
                  record_schemas: Dict[str, T.StructType] | None = None,
                  by: str = "seq") -> dict[str, DataFrame]:
    """Change rows of many tables → versioned rows per destination (batch or micro-batch)."""
    return route(live_tables(changes, mapping, record_schemas, by), mapping)


def wire_changes(changes: DataFrame, mapping: Mapping, record_schemas: Dict[str, T.StructType] | None = None,
                 by: str = "seq", tombstones: Dict[str, str] | None = None) -> DataFrame:
    """Change rows of many tables → ``dest_table, value`` for all rules, in one pass over the feed.

    Each row unfolds into what its table's rules send.  ``tombstones`` names tables whose
    deletes go, with ``deleted_at`` from the commit time, to a destination.  Changes that could
    not be read, or whose payload does not have its table's types, go to ``REJECTED``.
    """
    tombstones = dict(tombstones or {})
    changes = stamp_version(changes, by=by)
    live = F.col("op").isin("insert", "update")
    scripted, parsed, branches = [], {}, []
    corrupt = F.col(CORRUPT) if CORRUPT in changes.columns else None
    for k, table in enumerate(mapping.distinct_tables()):
        entries, here = mapping.by_source(table), F.col("source_table") == table
        if has_script(entries):
            scripted.append(table)
            continue
        schema = (record_schemas or {}).get(table)
        record, payload = F.col("record"), schema or changes.schema["record"].dataType
        bad = None
        if schema is not None:
            full = T.StructType(list(schema.fields)).add("_corrupt", T.StringType())
            parsed[f"_record{k}"] = F.when(here, F.from_json(record, full, {"columnNameOfCorruptRecord": "_corrupt"}))
            record = F.col(f"_record{k}")
            bad = record["_corrupt"].isNotNull()
        types = {f.name: f.dataType for f in payload.fields if f.name != "ver"}

        def resolve(name: str, record: Column = record) -> Column:
            return F.col("ver") if name == "ver" else record.getField(name)

        sent = F.when(live, wire_of(table, entries, {**types, "ver": T.LongType()}, resolve))
        if table in tombstones:
            gone = [(name, resolve(name), dtype) for name, dtype in types.items() if name != "deleted_at"]
            moment = changes.schema["commit_ts"].dataType
            sent = F.when(F.col("op") == "delete", F.array(sent_row(tombstones[table], [
                *gone, ("deleted_at", F.col("commit_ts"), moment), ("ver", F.col("ver"), T.LongType())]))).otherwise(sent)
        if bad is not None:
            refused = rejected(table, F.lit("payload does not have the table's types"), F.col("record"))
            sent = F.when(bad, F.when(live, refused)).otherwise(sent)
        branches.append((here, sent))
    choice = None
    for here, sent in branches:
        choice = F.when(here, sent) if choice is None else choice.when(here, sent)
    wanted = F.col("source_table").isin(mapping.distinct_tables())
    if corrupt is not None:
        refused = rejected(F.col("source_table"), F.lit("change cannot be read"), corrupt)
        choice = F.when(corrupt.isNotNull(), refused) if choice is None else F.when(corrupt.isNotNull(), refused).otherwise(choice)
        wanted = wanted | corrupt.isNotNull()
    parts = []
    if choice is not None:
        parts.append(changes.filter(wanted).withColumns(parsed).select(F.inline(choice)))
    for table in scripted:
        rows = table_changes(live_changes(changes), table, (record_schemas or {}).get(table), keep=("ver",))
        parts.append(wire_table(rows, table, mapping))
    return reduce(DataFrame.unionByName, parts)


def replicate(changes: DataFrame, mapping: Mapping, schemas: Schemas, *, origin: str, replica_dir: str,
              stage_dir: str, checkpoint_dir: str,
              record_schemas: Dict[str, T.StructType] | None = None,
              held: Callable[[], set[str]] = set, defaults: Defaults | None = None,
              reject_dir: str | None = None, keys: Keys | None = None, tombstones: Dict[str, str] | None = None,
              views: Iterable[LoadedRows] = (), available_now: bool = False,
              interval: str = LIVE_INTERVAL) -> StreamingQuery:
    """Start the live path.

    Each micro-batch is routed in one pass into the stage; then everything staged for
    destinations that are not in ``held()`` is loaded, also what waited there while they were.
    ``origin`` is the stream's name, one for each checkpoint: batches are known by origin and
    id, so a replay after a failure changes nothing and streams into one table keep apart.
    With ``reject_dir``, changes that cannot be read, routed or fitted, or lack one of
    ``keys``, go there with the reason, and the rest flows on.
    """
    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stage_wire(wire_changes(batch, mapping, record_schemas, tombstones=tombstones), stage_dir, origin, batch_id)
        drain(spark, stage_dir, replica_dir, schemas, defaults, keys=keys, reject_dir=reject_dir,
              held=held(), views=views)

    writer = changes.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def append_versions(rows: DataFrame, path: str, checkpoint_dir: str, *,
                    available_now: bool = False, interval: str = LIVE_INTERVAL) -> StreamingQuery:
    """Append one destination's versioned rows to files, exactly once."""
    writer = (rows.writeStream.format("parquet").outputMode("append")
              .option("path", path).option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
