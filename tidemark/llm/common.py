"""Helpers shared by the operators: reading, Arrow maps, stored intermediate tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.session import scratch_path
from tidemark.sinks import folders

# ASCII bytes that are no word characters in ``[^\x20\x09-\x0D]+``; bytes.split() cuts at just these.
SPACE = b" \t\n\x0b\x0c\r"
CONTINUATION = bytes(range(0x80, 0xC0))
# Text one shard or block of a task holds at once, whatever the batch size.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Lists that are told the paths ``stored`` writes.
_recorders: list[list[str]] = []


@contextmanager
def recorded_scratch(paths: list[str]) -> Iterator[None]:
    """Paths that ``stored`` writes meanwhile are added to ``paths``."""
    _recorders.append(paths)
    try:
        yield
    finally:
        _recorders.remove(paths)


def release_scratch(spark: SparkSession, paths: list[str]) -> None:
    """Remove tables that ``stored`` has written, once what was made of them is written elsewhere."""
    while paths:
        folders.remove(spark, paths.pop())


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts the lineage, survives lost
    executors, and gives joins a measured size to choose their strategy by."""
    path = scratch_path(df.sparkSession, label)
    for paths in _recorders:
        paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def code_points(raw: bytes) -> int:
    """Length of UTF-8 text in code points."""
    return len(raw) - (0 if raw.isascii() else len(raw) - len(raw.translate(None, CONTINUATION)))


def byte_column(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    return batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()


def slices(texts: list[bytes | None], most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``most`` bytes; a longer text is a range of its own."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text or b"")
        if held >= most:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict[str, list] | None],
                schema: T.StructType | str) -> DataFrame:
    """One output batch per input batch; ``fn`` gives the output columns."""
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                columns = fn(batch)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[f.name], type=f.type) if not isinstance(columns[f.name], pa.Array)
                     else columns[f.name].cast(f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def filter_batches(df: DataFrame, column: str, keep: Callable[[list[bytes | None]], list[bool]]) -> DataFrame:
    """Rows whose text passes; all columns stay as they are, whatever they are called."""
    position = df.columns.index(column)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                texts = batch.column(position).cast(pa.binary()).to_pylist()
                yield batch.filter(pa.array(keep(texts), pa.bool_()))

    return df.mapInArrow(run, df.schema)
