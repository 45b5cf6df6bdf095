"""Shards of near-equal bytes by sampled splitters.

Documents are ordered by (hash of the text, doc_id), so equal texts lie together.  A sample in
which a document's chance follows its size gives quantile boundaries; they cut the order into
ranges of about equal bytes.  Ranges that turn out overfull, such as a group of copies with a
third of all rows, are subdivided with samples of their own until none is.  Bytes and rows
ahead of each range then place every document: each shard gets an equal stretch of the byte
order, right to one document.

The sample and the totals of the ranges are bounded by the parameters, whatever the input; the
documents are shuffled once, by range.

Defined results: a null text has size 1 and checksum 0; repeated rows are rows like others and
interchangeable; an empty table gives no rows; other columns stay as they are.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

SHARDS = 8
RANGES = 4096  # target ranges; a range of 100 TB has some 8 million documents
SAMPLES = 16  # draws per range
OVERFULL = 2.0  # times the mean bytes of a range
ROUNDS = 5
SIZE, CRC, HASH, ID = "_op4_size", "_op4_crc", "_op4_hash", "_op4_id"
SPLIT = "_op4_range"


def _keys(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    raw = F.encode(F.col(text).cast("string"), "UTF-8")
    return docs.withColumns({
        SIZE: (F.coalesce(F.octet_length(raw), F.lit(0)) + 1).cast("long"),
        CRC: F.coalesce(F.crc32(raw), F.lit(0)).cast("long"),
        HASH: F.xxhash64(F.col(text)), ID: F.coalesce(F.col(doc_id).cast("long"), F.lit(-2**63).cast("long")),
    })


def _sortable(hashes: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """(hash, id) as byte strings that sort as the pairs do."""
    flip = np.uint64(1 << 63)
    pair = np.empty((len(hashes), 2), ">u8")
    pair[:, 0] = hashes.astype(np.int64).view(np.uint64) ^ flip
    pair[:, 1] = ids.astype(np.int64).view(np.uint64) ^ flip
    return pair.view("S16").reshape(-1)


def _range_of(splitters: np.ndarray) -> Column:
    @F.pandas_udf("int")
    def number(hashes: pd.Series, ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(splitters, _sortable(hashes.to_numpy(), ids.to_numpy()), "right")
                         .astype(np.int32))
    return number(HASH, ID)


def _quantiles(sample: pd.DataFrame, parts: int) -> np.ndarray:
    """Keys that cut the sample's weight into ``parts``."""
    if not len(sample):
        return np.empty(0, "S16")
    keys = _sortable(sample[HASH].to_numpy(), sample[ID].to_numpy())
    order = np.argsort(keys)
    weight = np.cumsum(sample["weight"].to_numpy()[order])
    cuts = np.searchsorted(weight, weight[-1] * np.arange(1, parts) / parts)
    return np.unique(keys[order][cuts])


def _draw(rows: DataFrame, total: float, draws: int, seed: int) -> pd.DataFrame:
    """About ``draws`` rows, each with a chance in proportion to its size; weight: size by chance."""
    chance = F.least(F.lit(1.0), F.col(SIZE) * F.lit(draws / max(total, 1)))
    lot = (F.xxhash64(HASH, ID, F.lit(seed)).bitwiseAND(F.lit(2**52 - 1))).cast("double") / float(2**52)
    return rows.filter(lot < chance).select(HASH, ID, (F.col(SIZE) / chance).alias("weight")).distinct().toPandas()


def splitters(rows: DataFrame, ranges: int, seed: int) -> tuple[np.ndarray, pd.DataFrame]:
    """Boundaries without overfull ranges, and bytes and rows of each range."""
    total = rows.agg(F.sum(SIZE)).first()[0] or 0
    found = _quantiles(_draw(rows, total, SAMPLES * ranges, seed), ranges)
    for turn in range(ROUNDS):
        split = rows.withColumn(SPLIT, _range_of(found))
        totals = split.groupBy(SPLIT).agg(F.sum(SIZE).alias("bytes"), F.count(F.lit(1)).alias("rows")).toPandas()
        full = totals[totals["bytes"] > OVERFULL * total / ranges]
        if full.empty or turn == ROUNDS - 1:
            return found, totals
        held = int(full["bytes"].sum())
        inside = split.filter(F.col(SPLIT).isin([int(k) for k in full[SPLIT]]))
        parts = -(-held * ranges // total)
        more = _quantiles(_draw(inside, held, SAMPLES * parts, seed + turn + 1), parts)
        grown = np.union1d(found, more)
        if len(grown) == len(found):  # only repeated rows are left in them
            return found, totals
        found = grown


def _placed(rows: DataFrame, found: np.ndarray, totals: pd.DataFrame, shards: int) -> DataFrame:
    """Rows with their position in the whole order and their shard."""
    totals = totals.sort_values(SPLIT)
    size = len(found) + 1
    in_range, n_rows = np.zeros(size, np.int64), np.zeros(size, np.int64)
    in_range[totals[SPLIT]], n_rows[totals[SPLIT]] = totals["bytes"], totals["rows"]
    ahead, first = np.cumsum(in_range) - in_range, np.cumsum(n_rows) - n_rows
    total = int(in_range.sum())

    @F.pandas_udf("long")
    def bytes_ahead(k: pd.Series) -> pd.Series:
        return pd.Series(ahead[k.to_numpy()])

    @F.pandas_udf("long")
    def rows_ahead(k: pd.Series) -> pd.Series:
        return pd.Series(first[k.to_numpy()])

    window = Window.partitionBy(SPLIT).orderBy(HASH, ID, CRC, SIZE)
    before = F.coalesce(F.sum(SIZE).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    middle = (F.col("_op4_ahead") + before) * 2 + F.col(SIZE)
    return rows.withColumn(SPLIT, _range_of(found)) \
        .withColumns({"_op4_ahead": bytes_ahead(SPLIT), "_op4_first": rows_ahead(SPLIT)}) \
        .withColumns({
            "_op4_shard": F.floor(middle / F.lit(2 * max(total, 1) / shards)).cast("int"),
            "_op4_position": F.col("_op4_first") + F.row_number().over(window) - 1}) \
        .withColumn("_op4_shard", F.least("_op4_shard", F.lit(shards - 1)))


def shard(docs: DataFrame, shards: int = SHARDS, *, doc_id: str = "doc_id", text: str = "text",
          ranges: int = RANGES, seed: int = 11) -> DataFrame:
    """All rows and columns with ``_op4_size``, ``_op4_crc``, ``_op4_shard`` and ``_op4_slot``."""
    keyed = _keys(docs, doc_id, text)
    rows = stored(keyed.select(SIZE, CRC, HASH, ID), "sizes")
    found, totals = splitters(rows, ranges, seed)
    starts = {r["_op4_shard"]: r["first"] for r in _placed(rows, found, totals, shards)
              .groupBy("_op4_shard").agg(F.min("_op4_position").alias("first")).collect()}
    start = F.get(F.array(*[F.lit(int(starts.get(k, 0))).cast("long") for k in range(shards)]), F.col("_op4_shard"))
    return _placed(keyed, found, totals, shards).withColumn("_op4_slot", F.col("_op4_position") - start) \
        .drop(HASH, ID, SPLIT, "_op4_ahead", "_op4_first", "_op4_position")
