"""Near-duplicates: MinHash bands for candidates, odd sketches to screen them, full sets to confirm.

1. One pass turns each text into its set of word shingles (64-bit hashes), a digest of the set,
   MinHash samples, band values of the samples and an odd sketch: a bitmap in which each of the
   ``BOTTOM`` least hashes of the set (its bottom-k MinHash samples) flips one bit.  The XOR of
   two sketches has about as many bits as the samples differ in, which tells high similarities
   precisely from 256 bytes.
2. Texts with equal sets are one class and one node from here on, so thousands of copies cost
   one row.  Nodes that share a band value are candidates.
3. Each band value picks one member, against which all others are tested: as many pairs as
   rows, never all pairs.  Sketches screen the pairs in the JVM; survivors are confirmed on the
   full sets of both texts.  Confirmed links give components.
4. Band values whose members are not yet in one component go on, with another member each
   round; only members of another component are tested, and no pair twice.  In the last round,
   the members outside a band value's main component are tested against all others there, if the
   band value has at most ``FEW`` members.
5. Larger ones, such as that of a passage which thousands of otherwise different texts share, are
   refined by exact prefix filtering: of a set of n shingles, in order of rarity, two sets at the
   threshold share one among the first n - ceil(threshold * n) + 1 of either, and among still fewer
   of the smaller one.  Members meet only if they share such a rare shingle, and are in different
   components; what they all share comes last in that order and brings nobody together.  Where they
   meet, the places of that shingle bound what they can share (positional filter).  So every pair of
   a band value is either tested, already connected, or proven too dissimilar.

A link at just 0.8 shares no band value with a chance of six in a million (56 bands of 6 out of
192 samples, simulated), a closer one with less; the screen lets through what lies up to 4.5
standard deviations below it.

Texts travel only if a pair needs them: a bitmap of fixed size, made from the pairs' keys, drops
most others where they are read.  However full it gets, it only ever lets more through.

Defined results: words are ASCII-lower-cased; a text with fewer words than a shingle has one
shingle, its whole sequence; texts without words have none and are linked with nothing; rows
with one doc_id are one document; rows without doc_id take part, but no component is named
after them; other columns are never read by the search.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, stored
from tidemark.llm.graph import components

SHINGLE_WORDS = 5
PERCENT = 80
SAMPLES = 192
BANDS, BAND_ROWS = 56, 6
BOTTOM = 1024  # least hashes folded into a sketch
SKETCH_LONGS = 32
SKETCH_BITS = 64 * SKETCH_LONGS
DEVIATIONS = 4.5  # of the screen below the threshold
ROUNDS = 1  # in which band values test another member, before the last one
FEW = 64  # members of a band value that may all be tested against each other
KNOWN_WORDS = 150_000  # word hashes that a task keeps
WANTED_BITS = 1 << 24  # of the bitmap of wanted keys, 2 MB
PART_BITS = 1 << 15  # of its rows
CHUNK = 2048  # shingles hashed at once
NO_ID = 1 << 62  # keys of documents without id lie above

_rng = np.random.default_rng(20240607)
_FACTORS = _rng.integers(0, 2**63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _rng.integers(0, 2**64, SAMPLES, dtype=np.uint64)
_CHOSEN = np.array([_rng.choice(SAMPLES, BAND_ROWS, replace=False) for _ in range(BANDS)])
_BAND_FACTORS = _rng.integers(0, 2**63, (BANDS, BAND_ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND_SHIFTS = _rng.integers(0, 2**64, BANDS, dtype=np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    """64-bit hashes of words, each computed once; forgets all when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > KNOWN_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _WordHashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def shingles(raw: bytes | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of a text's word shingles."""
    words = raw.lower().split() if raw else []
    if not words:
        return np.empty(0, np.uint64)
    own = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    n = len(words) - size + 1
    x = own[:n] + np.uint64(size)
    for k in range(1, size):
        x = _mixed(x) + own[k:n + k]
    return np.unique(_mixed(x))


def samples(hashes: np.ndarray) -> np.ndarray:
    """MinHash samples: the least value of the set under each of the hash functions."""
    least = np.full(SAMPLES, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(hashes), CHUNK):
        part = hashes[start:start + CHUNK]
        np.minimum(least, (part[None, :] * _FACTORS[:, None] + _SHIFTS[:, None]).min(axis=1), out=least)
    return least


def bands(least: np.ndarray) -> np.ndarray:
    return _mixed((_mixed(least)[_CHOSEN] * _BAND_FACTORS).sum(axis=1, dtype=np.uint64) + _BAND_SHIFTS)


def odd_sketch(hashes: np.ndarray) -> np.ndarray:
    """Each of the least hashes of a set (sorted) flips one of the bits."""
    bit = (_mixed(hashes[:BOTTOM]) >> np.uint64(64 - int(math.log2(SKETCH_BITS)))).astype(np.int64)
    odd = np.bincount(bit, minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _most_odd_bits(one: Column, two: Column, similarity: float) -> Column:
    """Bits in which the sketches of sets of these sizes differ at the similarity, at the most.

    Sets at similarity s share s/(1+s) of their elements.  Of the larger set only the share t
    has come into the sketch, so the sampled sets differ in d; d flips leave about
    N/2 (1 - exp(-2d/N)) odd bits.  Both steps are widened by ``DEVIATIONS``.
    """
    n = float(SKETCH_BITS)
    common = (one + two) * (similarity / (1 + similarity))
    t = F.least(F.lit(1.0), F.lit(float(BOTTOM)) / F.greatest(one, two))
    taken = F.least(one, F.lit(BOTTOM)) + F.least(two, F.lit(BOTTOM))
    flips = taken - 2 * t * common + 2 * DEVIATIONS * F.sqrt(common * t * (1 - t))
    x = flips / n
    odd = n / 2 * (1 - F.exp(-2 * x))
    spread = F.sqrt(F.greatest(F.lit(0.0), n * ((1 - F.exp(-4 * x)) / 4 - x * F.exp(-4 * x))))
    return odd + DEVIATIONS * spread + 1


def _key(doc_id: str, text: str) -> Column:
    """A document's number: its id, or a hash of its text above all ids."""
    hashed = F.xxhash64(F.col(text)).bitwiseAND(F.lit(NO_ID - 1)).bitwiseOR(F.lit(NO_ID))
    return F.coalesce(F.col(doc_id).cast("long"), hashed)


def fingerprints(docs: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    def run(batch: pa.RecordBatch) -> dict:
        count, digest, band, sketch = [], [], [], []
        for text in batch.column(2).cast(pa.binary()):  # one text at a time is taken out of the batch
            own = shingles(text.as_py(), size)
            count.append(len(own))
            if len(own):
                least = samples(own)
                digest.append(xxhash.xxh3_128_digest(own.tobytes()))
                band.append(bands(least).view(np.int64))
                sketch.append(odd_sketch(own))
            else:
                digest.append(None)
                band.append(None)
                sketch.append(None)
        return {"key": batch.column(0), "doc_id": batch.column(1), "n_shingles": count, "digest": digest,
                "bands": band, "sketch": sketch}

    rows = docs.select(_key(doc_id, text).alias("key"), F.col(doc_id).cast("long").alias("doc_id"),
                       F.col(text).cast("string").alias("text"))
    return map_batches(rows, run, "key long, doc_id long, n_shingles long, digest binary, bands array<long>, "
                                  "sketch array<long>")


def _alike(similarity: float) -> Column:
    """Whether sets of sizes m and n with the sketches a and b may be that similar."""
    # Written out for each of the longs, the code of a join would be too long for the JVM to compile.
    odd = F.aggregate(F.zip_with("a", "b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    sizes = F.least("m", "n") >= F.greatest("m", "n") * similarity - 1e-6
    return sizes & (odd <= _most_odd_bits(F.col("m"), F.col("n"), similarity))


def _screened(pairs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """Pairs (u, v) whose sizes and odd sketches allow the similarity."""
    one = nodes.select(F.col("node").alias("u"), F.col("n_shingles").alias("m"), F.col("sketch").alias("a"))
    two = nodes.select(F.col("node").alias("v"), F.col("n_shingles").alias("n"), F.col("sketch").alias("b"))
    return pairs.join(one, "u").join(two, "v").filter(_alike(similarity)).select("u", "v")


def _marked(rows: DataFrame, key: str, keys: DataFrame, name: str) -> DataFrame:
    """The rows with a column that is true where ``key`` is among ``keys``, and for few others.

    The keys are marked in a bitmap of fixed size, ``WANTED_BITS`` in all, which is broadcast.
    """
    place = F.pmod(F.xxhash64(F.col(key)), F.lit(WANTED_BITS))
    part = F.call_function("div", F.col("_place"), F.lit(PART_BITS))
    bitmap = keys.select(place.alias("_place")).groupBy(part.alias("_part")) \
        .agg(F.bitmap_construct_agg(F.col("_place") % PART_BITS).alias("_bits"))
    placed = rows.withColumn("_place", place).withColumn("_part", part).join(F.broadcast(bitmap), "_part", "left")
    at = F.col("_place") % PART_BITS
    byte = F.conv(F.hex(F.substring("_bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    return placed.withColumn(name, hit).select(*(F.col(f"`{c}`") for c in rows.columns), name)


def _wanted(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows whose ``key`` is among ``keys``, and few others."""
    return _marked(rows, "key", keys.select("key"), "_hit").filter("_hit").drop("_hit")


def _confirmed(pairs: DataFrame, docs: DataFrame, doc_id: str, text: str, size: int, percent: int) -> DataFrame:
    """Pairs (u, v) whose full shingle sets are similar enough."""
    keys = pairs.select(F.col("u").alias("key")).unionAll(pairs.select("v"))
    texts = _wanted(docs.select(_key(doc_id, text).alias("key"), F.col(text).cast("string").alias("text")), keys)
    pivots = pairs.select("u").distinct().join(texts.withColumnsRenamed({"key": "u", "text": "a"}), "u")
    members = pairs.join(texts.withColumnsRenamed({"key": "v", "text": "b"}), "v")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, pivot = None, None
        for batch in batches:
            u, v = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            mine, other = batch.column(2).cast(pa.binary()), batch.column(3).cast(pa.binary())
            keep = []
            for i, name in enumerate(u):
                if name != last:  # rows come by pivot
                    last, pivot = name, shingles(mine[i].as_py(), size)
                own = shingles(other[i].as_py(), size)
                common = len(pivot) + len(own) - len(np.union1d(pivot, own))
                keep.append(100 * common >= percent * (len(pivot) + len(own) - common))
            kept = [k for k, good in enumerate(keep) if good]
            yield pa.RecordBatch.from_pydict({"u": pa.array([u[k] for k in kept], pa.int64()),
                                              "v": pa.array([v[k] for k in kept], pa.int64())})

    return members.join(pivots, "u").select("u", "v", "a", "b").mapInArrow(run, "u long, v long")


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    return members.join(labels, "node", "left").select("band", "node", F.coalesce("label", "node").alias("label"))


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after further links: only the components these join are looked at again."""
    one = labels.withColumnsRenamed({"node": "u", "label": "p"})
    two = labels.withColumnsRenamed({"node": "v", "label": "q"})
    between = stored(links.join(one, "u", "left").join(two, "v", "left")
                     .select(F.coalesce("p", "u").alias("u"), F.coalesce("q", "v").alias("v"))
                     .filter("u != v").distinct(), "between")
    if between.isEmpty():
        return labels
    moved = components(between).withColumnsRenamed({"node": "old", "label": "new"})
    kept = labels.join(moved, labels["label"] == moved["old"], "left") \
        .select("node", F.coalesce("new", "label").alias("label"))
    # Nodes that had no link so far, and labels that gave way to a smaller one.
    fresh = moved.join(labels, moved["old"] == labels["node"], "left_anti") \
        .select(F.col("old").alias("node"), F.col("new").alias("label"))
    return stored(kept.unionByName(fresh), "labels")


def _prefixes(nodes: DataFrame, docs: DataFrame, doc_id: str, text: str, size: int, percent: int) -> DataFrame:
    """(node, band, rank) for each node's rarest shingles, as many as the prefix filter needs, that another one has too."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, raw in zip(batch.column(0), batch.column(1).cast(pa.binary())):
                own = shingles(raw.as_py(), size).view(np.int64)
                yield pa.RecordBatch.from_pydict({"node": pa.array(np.full(len(own), node.as_py(), np.int64)),
                                                  "n": pa.array(np.full(len(own), len(own), np.int64)), "band": pa.array(own)})

    keys = nodes.select(F.col("node").alias("key"))
    texts = _wanted(docs.select(_key(doc_id, text).alias("key"), F.col(text).cast("string").alias("text")), keys) \
        .join(keys.distinct(), "key", "left_semi").select("key", "text")
    rows = stored(texts.mapInArrow(run, "node long, n long, band long").distinct(), "shingles")
    common = stored(rows.groupBy("band").agg(F.count(F.lit(1)).alias("holders")).filter("holders > 1"), "holders")
    rank = F.row_number().over(Window.partitionBy("node").orderBy(F.col("holders").asc_nulls_first(), "band"))
    first = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    rare = rows.join(common, "band", "left").withColumn("rank", rank).filter(F.col("rank") <= first)
    return rare.filter("holders > 1").select("node", "band", F.col("rank").cast("long").alias("rank"))


def _unsettled(members: DataFrame) -> DataFrame:
    """Band values whose members are in several components, with their size and main component."""
    by_label = members.groupBy("band", "label").agg(F.count(F.lit(1)).alias("n"))
    return by_label.groupBy("band").agg(F.sum("n").alias("size"), F.count(F.lit(1)).alias("parts"),
                                        F.max_by("label", F.struct("n", "label")).alias("main")) \
        .filter("parts > 1 AND size > 2")


def _member_pairs(members: DataFrame, chosen: DataFrame, similarity: float) -> DataFrame:
    """Pairs of the chosen members with those of other components of their band value, screened
    where they meet: only pairs that may be links come out of the join.

    Rows may have a ``rank``, the place of their band value in the node's order of shingles.  Then
    the chosen one is the smaller set, and nothing that ranks before the band value is counted as
    shared: two sets have no more in common than what is left of either from there on.
    """
    ranked = "rank" in members.columns
    one = chosen.select("band", F.col("node").alias("u"), F.col("label").alias("p"), F.col("n_shingles").alias("m"),
                        F.col("sketch").alias("a"), *([F.col("rank").alias("i")] if ranked else []))
    two = members.select("band", F.col("node").alias("v"), F.col("label").alias("q"), F.col("n_shingles").alias("n"),
                         F.col("sketch").alias("b"), *([F.col("rank").alias("j")] if ranked else []))
    other = (F.col("p") != F.col("q")) & (F.col("u") != F.col("v"))
    if ranked:
        smaller = (F.col("m") < F.col("n")) | ((F.col("m") == F.col("n")) & (F.col("u") < F.col("v")))
        left = F.least(F.col("m") - F.col("i"), F.col("n") - F.col("j")) + 1
        other = other & smaller & (left >= _least_common(F.col("m") + F.col("n"), similarity))
    return one.join(two, "band").filter(other & _alike(similarity)) \
        .select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def _least_common(sizes: Column, similarity: float) -> Column:
    """What two sets at the similarity have in common at the least, by the sum of their sizes."""
    return sizes * (similarity / (1 + similarity)) - 1e-6


def _rare_pairs(rare: DataFrame, similarity: float) -> DataFrame:
    """Screened pairs of different components that share a rare shingle (``band``).

    The smaller set of a pair shares one at a place that leaves enough even for a partner of its
    own size.  Those of a shingle's main component meet only what is outside it.
    """
    by_label = rare.groupBy("band", "label").agg(F.count(F.lit(1)).alias("n"))
    mains = stored(by_label.groupBy("band").agg(F.count(F.lit(1)).alias("parts"),
                                                F.max_by("label", F.struct("n", "label")).alias("main"))
                   .filter("parts > 1").select("band", "main"), "mains")
    outside = F.col("label") != F.col("main")
    rows = rare.join(mains, "band")

    def met(rows: DataFrame, kind: Column) -> DataFrame:
        return rows.select(F.xxhash64("band", kind).alias("band"), "node", "label", "n_shingles", "sketch", "rank")
    everyone, outsiders = met(rows, F.lit(0)), met(rows.filter(outside), F.lit(1))
    enough = F.col("n_shingles") - F.col("rank") + 1 >= _least_common(2 * F.col("n_shingles"), similarity)
    chosen = met(rows.filter(enough), F.when(outside, 0).otherwise(1))
    return _member_pairs(everyone.unionAll(outsiders), chosen, similarity)


def component_table(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE_WORDS,
                    percent: int = PERCENT) -> DataFrame:
    """Per row: key, doc_id, n_shingles, its component's least key and least doc_id."""
    similarity = percent / 100
    marks = stored(fingerprints(docs, doc_id, text, size), "fingerprints")
    classes = stored(marks.filter("n_shingles > 0").groupBy("digest")
                     .agg(F.min("key").alias("node"), F.min("doc_id").alias("low")), "classes")
    nodes = stored(marks.join(classes.select("digest", F.col("node").alias("key")), ["digest", "key"])
                   .select(F.col("key").alias("node"), "n_shingles", "bands", "sketch"), "nodes")

    rows = nodes.select("node", F.explode("bands").alias("band"))
    shared = rows.groupBy("band").agg(F.min("node").alias("pivot"), F.max("node").alias("last")) \
        .filter("pivot < last").select("band", "pivot")
    members = stored(rows.join(shared, "band").select("band", "node", "pivot").distinct(), "members")
    sketches = nodes.select("node", "n_shingles", "sketch")

    def links_of(pairs: DataFrame) -> DataFrame:
        """Confirmed links of screened pairs; both are stored."""
        pairs = stored(pairs, "screened")
        tested.append(pairs)
        return stored(_confirmed(pairs, docs, doc_id, text, size, percent), "confirmed")

    tested: list[DataFrame] = []
    first = members.filter("node != pivot").select(F.col("pivot").alias("u"), F.col("node").alias("v")).distinct()
    labels = components(links_of(_screened(first, sketches, similarity)))
    members = members.select("band", "node")
    for turn in range(ROUNDS + 1):
        members = stored(_labelled(members.select("band", "node"), labels), "members")
        open_bands = stored(_unsettled(members), "unsettled")
        members = stored(members.join(open_bands.select("band", "main"), "band").join(sketches, "node"), "open-members")
        refined = None
        if turn < ROUNDS:
            # Another member of each band value, as good as drawn by lot: the least after mixing.
            mixed = F.xxhash64("node", F.lit(turn))
            picked = members.groupBy("band").agg(F.min(mixed).alias("first"))
            chosen = members.join(picked, "band").filter(mixed == F.col("first"))
        else:
            large = stored(members.join(open_bands.filter(F.col("size") > FEW).select("band"), "band")
                           .select("node", "label").distinct(), "large")
            members = members.join(open_bands.filter(F.col("size") <= FEW).select("band"), "band")
            chosen = members.filter("label != main")
            if not large.isEmpty():
                rare = stored(_prefixes(large, docs, doc_id, text, size, percent), "rare")
                refined = _rare_pairs(rare.join(large, "node").join(sketches, "node"), similarity)
        pairs = _member_pairs(members, chosen, similarity)
        if refined is not None:
            pairs = pairs.unionByName(refined).distinct()
        for old in tested:
            pairs = pairs.join(old, ["u", "v"], "left_anti")
        labels = _joined(labels, links_of(pairs))

    named = classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    lows = named.groupBy("label").agg(F.min("low").alias("component_id"))
    named = named.select("digest", "label").join(lows, "label")
    return marks.select("key", "doc_id", "n_shingles", "digest").join(named, "digest", "left") \
        .select("key", "doc_id", "n_shingles", F.coalesce("label", "key").alias("label"),
                F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (least doc_id reachable) and kept."""
    return component_table(docs, **options).select(
        "doc_id", "n_shingles", "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def keep_one_each(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each component, with all its columns; of repeated rows one stays."""
    found = component_table(docs, doc_id=doc_id, text=text, **options)
    by_key = stored(found.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.min("label").alias("label")), "keys")
    acted = by_key.filter("label != key OR rows > 1").select(
        F.col("key").alias("_op6_key"), (F.col("label") != F.col("key")).alias("_op6_gone"))
    # Most rows are in no list: a bitmap of fixed size tells so where they are read, and they pass
    # narrow.  The others, and the few that only look alike, are joined.
    keyed = _marked(docs.withColumn("_op6_key", _key(doc_id, text)), "_op6_key", acted.select("_op6_key"), "_op6_hit")
    free = keyed.filter("NOT _op6_hit").select(*docs.columns)
    known = keyed.filter("_op6_hit").join(acted, "_op6_key", "left").filter("_op6_gone IS NULL OR NOT _op6_gone")
    single = known.filter("_op6_gone IS NULL").select(*docs.columns)
    repeated = known.filter("_op6_gone IS NOT NULL").dropDuplicates(["_op6_key"]).select(*docs.columns)
    return free.unionByName(single).unionByName(repeated)
