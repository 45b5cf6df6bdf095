"""Routing rows to destinations."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from collections.abc import Mapping as Dict
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.convert import convert_record, convert_value, to_json_rows
from tidemark.functions.template import Resolve, misfit, named, projection, reject_reason, rule_columns, settle
from tidemark.sources.mapping import Entry, Mapping

ScriptResult = DataFrame | dict[str, DataFrame]
Script = Callable[[DataFrame], ScriptResult]

_scripts: dict[str, Script] = {}


def register_script(name: str, fn: Script) -> None:
    """Make ``fn`` available to rules whose script is ``name`` (``module.function``).

    It receives the changes of the table as a DataFrame and returns the rows for the
    rule's destination, or a dict of destination → rows.
    """
    _scripts[name] = fn


def remap(df: DataFrame, entry: Entry) -> DataFrame:
    """The rule applied to the rows it can express; see ``split_rejects`` for the others."""
    reason = reject_reason(df, entry.remap)
    good = df if reason is None else df.filter(reason.isNull())
    return settle(projection(df, entry.remap)(good))


def _entries_reason(df: DataFrame, entries: Iterable[Entry]) -> Column | None:
    reason = None
    for entry in entries:
        if entry.dest_table is None:
            this: Column | None = F.lit("rule has no dest_table")
        else:
            this = reject_reason(df, entry.remap)
        if this is not None:
            reason = this if reason is None else F.coalesce(reason, this)
    return reason


def _with_reason(df: DataFrame, reason: Column) -> DataFrame:
    return df.withColumn("reject_reason", reason).filter(F.col("reject_reason").isNotNull())


def split_rejects(df: DataFrame, entry: Entry) -> tuple[DataFrame, DataFrame]:
    """(remapped rows, rows the rule cannot express with ``reject_reason``)."""
    good = remap(df, entry) if entry.dest_table is not None else df.filter(F.lit(False))
    return good, rejects(df, [entry])


def rejects(df: DataFrame, entries: Iterable[Entry]) -> DataFrame:
    """Rows that some rule of their table cannot express: they reach no destination at all."""
    reason = _entries_reason(df, entries)
    return _with_reason(df, F.lit(None).cast("string") if reason is None else reason)


def reject_counts(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("rows"))


def _run_script(df: DataFrame, entry: Entry) -> dict[str, DataFrame]:
    if entry.script not in _scripts:
        raise LookupError(f"no script registered as {entry.script!r}")
    result = _scripts[entry.script](df)
    if isinstance(result, dict):
        return result
    return {entry.dest_table or entry.source_table: result}


def route_table(df: DataFrame, entries: list[Entry]) -> list[tuple[str, DataFrame]]:
    """Rows of one source table → (destination, rows) per rule, in rule order.

    A script runs only when its rule is the table's only one, and replaces routing.
    """
    if len(entries) == 1 and entries[0].script is not None:
        return list(_run_script(df, entries[0]).items())
    reason = _entries_reason(df, entries)
    good = df if reason is None else df.filter(reason.isNull())
    return [(e.dest_table, projection(df, e.remap)(good)) for e in entries if e.dest_table]


def _aligned(frames: list[DataFrame]) -> list[DataFrame]:
    """Columns whose types disagree beyond number widening become text in every frame."""
    seen: dict[str, set[T.DataType]] = {}
    for frame in frames:
        for field in frame.schema.fields:
            if not isinstance(field.dataType, T.NullType):
                seen.setdefault(field.name, set()).add(field.dataType)
    clash = {name for name, types in seen.items()
             if len(types) > 1 and not all(isinstance(t, T.NumericType) for t in types)}
    if not clash:
        return frames
    return [frame.withColumns({c: F.col(f"`{c}`").cast("string")
                               for c in frame.columns if c in clash}) for frame in frames]


def fan_in(frames: list[DataFrame]) -> DataFrame:
    """Several inputs of one destination as one frame; absent columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), _aligned(frames))


def route(sources: Dict[str, DataFrame], mapping: Mapping) -> dict[str, DataFrame]:
    """All sources through all rules: one frame per destination."""
    by_dest: dict[str, list[DataFrame]] = {}
    for table in mapping.distinct_tables():
        if table in sources:
            for dest, frame in route_table(sources[table], mapping.by_source(table)):
                by_dest.setdefault(dest, []).append(frame)
    return {dest: settle(fan_in(frames)) for dest, frames in by_dest.items()}


def route_rejects(sources: Dict[str, DataFrame], mapping: Mapping) -> DataFrame | None:
    """What ``route`` leaves out: ``source_table, reject_reason, value`` (the row as JSON).

    ``None`` if the rules fit every row of these sources.
    """
    parts = []
    for table in mapping.distinct_tables():
        entries = mapping.by_source(table)
        if table not in sources or (len(entries) == 1 and entries[0].script is not None):
            continue
        reason = _entries_reason(sources[table], entries)
        if reason is not None:
            kept = ("reject_reason",)
            rows = to_json_rows(convert_record(_with_reason(sources[table], reason), kept), keep=kept)
            parts.append(rows.select(F.lit(table).alias("source_table"), "reject_reason", "value"))
    return reduce(DataFrame.unionByName, parts) if parts else None


# Destination under which rows that no rule can express travel with their reason.
REJECTED = "_rejected"


def _wire(columns: list[tuple[str, Column, T.DataType]]) -> Column:
    """A row as JSON of wire values; null fields left out."""
    return F.to_json(F.struct(*[convert_value(column, dtype).alias(name) for name, column, dtype in columns]))


def _sent(dest: str, value: Column) -> Column:
    return F.struct(F.lit(dest).alias("dest_table"), value.alias("value"))


def sent_row(dest: str, columns: list[tuple[str, Column, T.DataType]]) -> Column:
    return _sent(dest, _wire(columns))


def rejected(table: str | Column, reason: Column, value: Column) -> Column:
    """What is sent for a row that cannot be routed."""
    source = F.lit(table) if isinstance(table, str) else table
    return F.array(_sent(REJECTED, F.to_json(F.struct(
        source.alias("source_table"), reason.alias("reject_reason"), value.alias("value")))))


def wire_of(table: str, entries: Iterable[Entry], types: Dict[str, T.DataType], resolve: Resolve = named) -> Column:
    """Everything the rules of a table send for one row: a list of ``(dest_table, value)``.

    A row some rule cannot express is sent to ``REJECTED`` alone.
    """
    reason, parts = None, []
    for entry in entries:
        this = F.lit("rule has no dest_table") if entry.dest_table is None else misfit(dict(types), entry.remap, resolve)
        if this is not None:
            reason = this if reason is None else F.coalesce(reason, this)
        if entry.dest_table is not None:
            parts.append(sent_row(entry.dest_table, rule_columns(dict(types), entry.remap, resolve)))
    everything = _wire([(name, resolve(name), dtype) for name, dtype in types.items()])
    if reason is None:
        return F.array(*parts)
    refused = rejected(table, reason, everything)
    return F.when(reason.isNotNull(), refused).otherwise(F.array(*parts)) if parts else refused


def has_script(entries: list[Entry]) -> bool:
    return len(entries) == 1 and entries[0].script is not None


def wire_table(rows: DataFrame, table: str, mapping: Mapping) -> DataFrame:
    """Rows of one source table → ``dest_table, value`` for all its rules, in one pass."""
    entries = mapping.by_source(table)
    if has_script(entries):
        parts = [to_json_rows(convert_record(frame)).select(F.lit(dest).alias("dest_table"), "value")
                 for dest, frame in route_table(rows, entries)]
        return reduce(DataFrame.unionByName, parts)
    types = {f.name: f.dataType for f in rows.schema.fields}
    return rows.select(F.inline(wire_of(table, entries, types)))
