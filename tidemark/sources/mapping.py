"""Routing rules: which source table feeds which destination, and how."""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

ENTRY_SCHEMA = T.StructType([
    T.StructField("entry_no", T.IntegerType(), False),
    T.StructField("source_table", T.StringType(), False),
    T.StructField("dest_table", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("remap", T.MapType(T.StringType(), T.StringType())),
    T.StructField("script", T.StructType([
        T.StructField("module", T.StringType()),
        T.StructField("function", T.StringType()),
    ])),
])


@dataclass(frozen=True)
class Entry:
    """One routing rule.  ``remap=None`` passes rows through; ``remap={}`` keeps only ``ver``."""

    source_table: str
    dest_table: str | None = None
    topic: str | None = None
    remap: dict[str, Any] | None = None
    script: str | None = None

    @classmethod
    def from_json(cls, obj: dict[str, Any]) -> Entry:
        remap = obj.get("remap")
        script = obj.get("script")
        name = None
        if isinstance(script, dict) and {"module", "function"} <= script.keys():
            name = f"{script['module']}.{script['function']}"
        return cls(
            source_table=obj["source_table"],
            dest_table=obj.get("dest_table"),
            topic=obj.get("topic"),
            remap=remap if isinstance(remap, dict) else None,
            script=name,
        )


class Mapping:
    """An ordered list of routing rules, read once when a plan is built."""

    def __init__(self, entries: Iterable[Entry]):
        self.entries = tuple(entries)

    @classmethod
    def from_dicts(cls, objs: Iterable[dict[str, Any]]) -> Mapping:
        return cls(Entry.from_json(obj) for obj in objs)

    @classmethod
    def load(cls, path: str | None = None) -> Mapping:
        """Read ``path``, else the file named by ``MAPPER_FILE``, else ``./mapper.json``."""
        path = path or os.environ.get("MAPPER_FILE") or os.path.join(os.getcwd(), "mapper.json")
        with open(path, encoding="utf-8") as handle:
            return cls.from_dicts(json.load(handle)["data"])

    def __iter__(self) -> Iterator[Entry]:
        return iter(self.entries)

    def __len__(self) -> int:
        return len(self.entries)

    def tables(self) -> list[str]:
        """Source table of every rule, duplicates kept, in order."""
        return [entry.source_table for entry in self.entries]

    def distinct_tables(self) -> list[str]:
        return list(dict.fromkeys(self.tables()))

    def topics(self) -> list[str | None]:
        return [entry.topic for entry in self.entries]

    def by_topic(self, topic: str) -> Entry | None:
        return next((entry for entry in self.entries if entry.topic == topic), None)

    def by_source(self, table: str) -> list[Entry]:
        return [entry for entry in self.entries if entry.source_table == table]

    def destinations(self) -> list[str]:
        return list(dict.fromkeys(e.dest_table for e in self.entries if e.dest_table))

    def frame(self, spark: SparkSession) -> DataFrame:
        """The rules as a lookup table; constants of a remap are shown as JSON text."""
        rows = []
        for no, entry in enumerate(self.entries):
            remap = None
            if entry.remap is not None:
                remap = {k: v if isinstance(v, str) else json.dumps(v)
                         for k, v in entry.remap.items()}
            script = None
            if entry.script is not None:
                module, _, function = entry.script.rpartition(".")
                script = (module, function)
            rows.append((no, entry.source_table, entry.dest_table, entry.topic, remap, script))
        return spark.createDataFrame(rows, ENTRY_SCHEMA)
