"""Mixing sources to target weights by fitting each source's word budget exactly.

Targets share all words by weight; a target stops at so many times its source's size and the
excess is shared again by weight.  A source gives its documents in whole: full passes first,
then documents whose lengths sum to what is left.  Documents are counted by exact length; a
part of every length in proportion and a few long ones use up most of the budget, and a bounded
knapsack over the length counts fits the rest.  Of each length, the documents with the least
seeded hashes are taken.

What one task holds is a source's table of lengths, never its documents.  Documents of one
length are dealt into salts by their hash: salts before the last one are taken as they are,
and only inside that one are documents ranked.

Rows alike in source, id and text are copies of one document and count as documents of their
own: a source may take some copies once more than others.

Defined results: a null text has no words; which of a document's copies are taken more often is
left open; a null source comes last; documents without words are never taken; an empty table
gives no rows; other columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.operators.numbering import positions_by_range

WEIGHTS = (5, 2, 1)
MOST_PASSES = 3
SALTS = 1024
CUT_ROWS = 500_000  # of the table of cuts that is broadcast, about 40 MB
FIT_WORDS = 20_000  # budget left to the knapsack, at most (unless only longer documents remain)
WORD = r"[^\x20\x09-\x0D]+"


def knapsack(counts: dict[int, int], budget: int) -> dict[int, int]:
    """How many of each length come nearest to the budget from below; exact bounded subset sum.

    Sums that can be reached are the bits of one number; a length's count is cut into powers
    of two.  Stops as soon as the budget itself is reached.
    """
    items, states, reach, mask = [], [], 1, (1 << (budget + 1)) - 1
    for length in sorted(counts):
        left, part = min(counts[length], budget // length), 1
        while left > 0 and not reach >> budget & 1:
            take = min(part, left)
            items.append((length, take))
            states.append(reach)
            reach = (reach | reach << (length * take)) & mask
            left, part = left - take, part * 2
    value = reach.bit_length() - 1
    taken: dict[int, int] = {}
    for (length, take), before in zip(reversed(items), reversed(states)):
        if not before >> value & 1:
            value -= length * take
            taken[length] = taken.get(length, 0) + take
    return taken


def fit(counts: dict[int, int], budget: int) -> dict[int, int]:
    """How many documents of each length to take so that their words sum to the budget."""
    counts = {k: n for k, n in counts.items() if k > 0 and n > 0}
    total = sum(k * n for k, n in counts.items())
    if budget >= total:
        return counts
    taken = {k: n * budget // total for k, n in counts.items()}
    left = budget - sum(k * n for k, n in taken.items())
    for length in sorted(counts, reverse=True):
        if left <= FIT_WORDS:
            break
        more = min(counts[length] - taken[length], left // length, -(-(left - FIT_WORDS) // length))
        taken[length] += more
        left -= length * more
    rest = {k: counts[k] - taken[k] for k in counts if k <= left and counts[k] > taken[k]}
    for length, more in knapsack(rest, left).items():
        taken[length] += more
    return taken


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_PASSES) -> DataFrame:
    """``source``, ``source_size`` → also ``number`` (place by code point, null last) and ``target``."""
    ordered = positions_by_range(sources.withColumn("_null", F.col("source").isNull()), ["_null", "source"],
                                 name="number").drop("_null")
    share = F.element_at(F.array(*map(F.lit, weights)), (F.col("number") % len(weights) + 1).cast("int"))
    ordered = stored(ordered.withColumn("share", share.cast("double")), "sources")
    limit = F.col("source_size").cast("double") * most
    total = ordered.agg(F.sum("source_size")).first()[0] or 0
    level = None
    while True:
        above = F.lit(False) if level is None else F.col("share") * level > limit
        shares, held = ordered.agg(F.sum(F.when(~above, F.col("share"))),
                                   F.sum(F.when(above, limit))).first()
        found = (total - (held or 0.0)) / shares if shares else 0.0
        if level is not None and found <= level:
            break
        level = found
    return ordered.withColumn("target", F.least(limit, F.col("share") * level)).drop("share")


def _units(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    """Rows alike in source, id and text as one."""
    return docs.select(
        F.col(source).cast("string").alias("source"), F.col(doc_id).cast("long").alias("doc_id"),
        F.xxhash64(F.col(text)).alias("hash"),
        F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    ).groupBy("source", "doc_id", "hash", "size").agg(F.count(F.lit(1)).alias("copies"))


def _lots(seed: int, doc_id: str, hashed: str) -> dict[str, Column]:
    """A document's seeded hash, and the salt that it is dealt into."""
    lot = F.xxhash64(F.lit(seed), doc_id, hashed)
    return {"lot": lot, "salt": F.pmod(lot, F.lit(SALTS)).cast("int")}


def _planned(docs: DataFrame, doc_id: str, text: str, source: str, weights: Sequence[int], most: int, seed: int) -> DataFrame:
    """Per distinct document: source, doc_id, hash, size, copies, source_size, target, ``passes`` of
    each copy, how many copies are taken once ``more``, and its place in the ``order`` in which the
    documents of its source and length are taken."""
    units = stored(_units(docs, doc_id, text, source), "units")
    by_source = units.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    plan = stored(targets(stored(by_source, "by-source"), weights, most), "targets")
    units = stored(
        units.join(plan.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
        .withColumns(_lots(seed, "doc_id", "hash")), "dealt")
    salted = stored(units.filter("size > 0").groupBy("number", "size", "salt")
                    .agg(F.sum("copies").alias("n")), "salted")
    lengths = salted.groupBy("number", "size").agg(F.sum("n").alias("n")) \
        .join(plan.select("number", "source_size", "target"), "number")

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        size, target = int(rows["source_size"].iloc[0]), float(rows["target"].iloc[0])
        budget = max(0, round(target - size * int(target // size)))
        taken = fit(dict(zip(rows["size"].tolist(), rows["n"].tolist())), budget)
        return pd.DataFrame({"number": rows["number"], "size": rows["size"],
                             "take": [taken.get(k, 0) for k in rows["size"].tolist()]})

    chosen = lengths.groupBy("number").applyInPandas(choose, "number long, size long, take long")
    ahead = Window.partitionBy("number", "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    quota = salted.withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0).cast("long"))) \
        .join(chosen, ["number", "size"]) \
        .select("number", "size", "salt", F.greatest(F.lit(0).cast("long"), F.col("take") - F.col("ahead")).alias("quota"))
    before = F.sum("copies").over(Window.partitionBy("number", "size", "salt").orderBy("lot", "doc_id", "hash")
                                  .rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("copies")
    passes = F.when((F.col("source_size") > 0) & (F.col("size") > 0), F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    more = F.least(F.col("copies"), F.greatest(F.lit(0).cast("long"), F.coalesce("quota", F.lit(0)) - F.col("before")))
    return units.withColumn("before", before).join(quota, ["number", "size", "salt"], "left").select(
        "source", "doc_id", "hash", "size", "copies", "source_size", "target", passes.cast("long").alias("passes"), more.alias("more"),
        F.struct("salt", "lot", "doc_id", "hash").alias("order"))


def mix(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights: Sequence[int] = WEIGHTS, most: int = MOST_PASSES, seed: int = 5) -> DataFrame:
    """Per distinct document: source, doc_id, hash, size, copies, source_size, target and passes,
    the times that each of these copies is taken; two rows where its copies differ in that."""
    parts = F.array(F.struct(F.col("more").alias("copies"), (F.col("passes") + 1).alias("passes")),
                    F.struct((F.col("copies") - F.col("more")).alias("copies"), F.col("passes").alias("passes")))
    return _planned(docs, doc_id, text, source, weights, most, seed) \
        .withColumn("part", F.explode(F.filter(parts, lambda x: x["copies"] > 0))) \
        .select("source", "doc_id", "hash", "size", "part.copies", "source_size", "target", "part.passes")


def mixed_documents(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source",
                    weights: Sequence[int] = WEIGHTS, most: int = MOST_PASSES, seed: int = 5) -> DataFrame:
    """Each row as often as the mix takes it, with all its columns.

    Documents of one source and length are taken in their order up to a cut, so a table of cuts, a
    row per source and length, decides each row where it is read.  It is broadcast while it has
    at most ``CUT_ROWS`` rows, and joined otherwise.  Only the copies of the one document at a cut
    whose copies differ are numbered.
    """
    planned = _planned(docs, doc_id, text, source, weights, most, seed)
    split = (F.col("more") > 0) & (F.col("more") < F.col("copies"))
    cuts = stored(planned.groupBy(F.col("source").alias("_op8_source"), F.col("size").alias("_op8_size")).agg(
        F.max("passes").alias("_op8_passes"), F.max(F.when(F.col("more") == F.col("copies"), F.col("order"))).alias("_op8_cut"),
        F.max(F.when(split, F.struct("doc_id", "hash", "more"))).alias("_op8_split"))
        .filter("_op8_passes > 0 OR _op8_cut IS NOT NULL OR _op8_split IS NOT NULL"), "mix-cuts")
    names = [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]
    own = docs.select(*names, F.struct(
        F.col(source).cast("string").alias("source"), F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("hash"),
        F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size")).alias("_op8"))
    lots = _lots(seed, "_op8.doc_id", "_op8.hash")
    place = F.struct(lots["salt"].alias("salt"), lots["lot"].alias("lot"), F.col("_op8.doc_id").alias("doc_id"), F.col("_op8.hash").alias("hash"))
    side = F.broadcast(cuts) if cuts.count() <= CUT_ROWS else cuts
    rows = own.join(side, F.col("_op8.source").eqNullSafe(F.col("_op8_source")) & (F.col("_op8.size") == F.col("_op8_size")))
    at_cut = F.col("_op8_split").isNotNull() & F.col("_op8.doc_id").eqNullSafe(F.col("_op8_split.doc_id")) \
        & (F.col("_op8.hash") == F.col("_op8_split.hash"))
    below = F.coalesce(place <= F.col("_op8_cut"), F.lit(False))
    taken = rows.filter(~at_cut).withColumn("_op8_turns", F.col("_op8_passes") + F.when(below, 1).otherwise(0))
    if not cuts.filter("_op8_split IS NOT NULL").isEmpty():
        # Copies that differ in their passes are numbered by written part, so no task holds all of one document.
        copies = stored(rows.filter(at_cut).withColumn("_op8_at", F.monotonically_increasing_id()), "mix-copies") \
            .withColumn("_op8_part", F.shiftright("_op8_at", 33))
        unit = ["_op8_source", "_op8_size"]
        sizes = copies.groupBy(*unit, "_op8_part").agg(F.count(F.lit(1)).alias("_op8_n"))
        ahead = Window.partitionBy(*unit).orderBy("_op8_part").rowsBetween(Window.unboundedPreceding, -1)
        sizes = sizes.withColumn("_op8_ahead", F.coalesce(F.sum("_op8_n").over(ahead), F.lit(0).cast("long"))) \
            .select(*(F.col(c).alias(c + "_") for c in unit), F.col("_op8_part").alias("_op8_part_"), "_op8_ahead")
        number = F.row_number().over(Window.partitionBy(*unit, "_op8_part").orderBy("_op8_at"))
        alike = F.col("_op8_part") == F.col("_op8_part_")
        for c in unit:
            alike = alike & F.col(c).eqNullSafe(F.col(c + "_"))
        turn = F.when(F.col("_op8_place") + F.col("_op8_ahead") <= F.col("_op8_split.more"), 1).otherwise(0)
        numbered = copies.withColumn("_op8_place", number).join(sizes, alike).withColumn("_op8_turns", F.col("_op8_passes") + turn)
        taken = taken.select(*names, "_op8_turns").unionByName(numbered.select(*names, "_op8_turns"))
    return taken.filter("_op8_turns > 0").withColumn("_op8_turn", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_op8_turns").cast("long")))) \
        .select(*names)
