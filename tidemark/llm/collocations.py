"""Phrase collocations by stripes: each prefix keys a counter of the words that follow it.

1. A task codes the words of its texts and gathers positions into blocks of bounded size.  A
   block's stripes are those of the two-word prefixes (what follows each pair of words, the end
   of a piece counted like a word) and of the empty prefix (how often each word occurs).  They
   are exact: words are coded, never hashed into one another.
2. Stripes are dealt to buckets by prefix, many of a block packed into one compressed row per
   bucket; the number of buckets follows the size of the corpus.  The empty prefix, which holds
   everything, is dealt by its words.  A stripe that is wide in its block is dealt by the words
   that follow, and its home bucket is told.
3. Stripes of a bucket are merged elementwise.  A merged stripe gives all at once: its entries are
   the counts of three-word phrases (extensions), its sum is the count of the two-word prefix, its
   greatest entry is what may subsume that prefix from the right.  Prefixes that were wide
   anywhere are merged once more by Spark, entry by entry.
4. What reaches ``LEAST`` is left for joins: scores of the cuts, subsumption from the left (the
   greatest count by the last two words), and the first phrases of each language.

Scores are integer divisions of decimals with 38 digits: exact while a * a * 1000000 is below
10^38.

Defined results: null texts are empty, a null language is ``und``; A-Z are lower-cased, nothing
else; phrases do not cross the piece ends ``[.,;:!?\\x0A-\\x0D]``; rows are texts, so repeated rows
count as often as they occur; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import byte_column, stored

LEAST = 10
PERCENT = 50
FIRST = 2000
NO_LANGUAGE = "und"
BLOCK_WORDS = 1 << 20  # positions of a block
SLICE_WORDS = 1 << 17  # of one text at a time
WORD_BITS, LANGUAGE_BITS = 19, 6  # codes of a block: three words and a language make 63 bits
BUCKET_BYTES = 8 << 20  # text per bucket, about
ROWS_TOGETHER = 64  # of packed entries
WIDE = 1 << 12  # entries of a stripe from which on its block splits it
END = 0  # the code of a piece's end; its spelling is empty
# What a row of a bucket is: an entry of a prefix of two words, of the empty prefix, of a wide
# prefix, or the note that a prefix is wide.
PAIR, WORD, PART, NOTE = range(4)

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz\n\n\n\n\n\n\n\n\n ")
_SEEDS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


class _Codes(dict):
    """Code by spelling, given on first sight."""

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        return code


def _dealt(parts: list[np.ndarray], buckets: int) -> np.ndarray:
    """Buckets by the hashes of spellings: the same in all blocks."""
    x = np.zeros(len(parts[0]), np.uint64)
    for seed, part in zip(_SEEDS, parts):
        x = (x ^ part) * seed
        x ^= x >> np.uint64(31)
    return (x % np.uint64(buckets)).astype(np.int32)


def _packed(kind: np.ndarray, codes: list[np.ndarray], counts: np.ndarray, spelling: np.ndarray) -> bytes:
    """Entries as one compressed value: the spellings they use, and six columns of 32-bit numbers."""
    used, own = np.unique(np.concatenate(codes), return_inverse=True)
    words = b"\n".join(spelling[used].tolist())
    numbers = np.concatenate([kind, own, counts], dtype=np.int32, casting="unsafe")
    head = np.array([len(words), len(counts)], np.int64).tobytes()
    columns = numbers.view(np.uint8).reshape(-1, 4).T  # equal bytes together
    return zstandard.ZstdCompressor(level=1).compress(head + words + columns.tobytes())


def _unpacked(packed: bytes) -> tuple[list[bytes], np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(packed)
    size, rows = np.frombuffer(raw, np.int64, 2).tolist()
    numbers = np.frombuffer(raw, np.uint8, offset=16 + size).reshape(4, -1).T
    return raw[16:16 + size].split(b"\n"), np.ascontiguousarray(numbers).view(np.int32).reshape(6, rows)


class _Block:
    """Positions gathered until the block is full."""

    def __init__(self, buckets: int, wide: int, most: int, ahead: int) -> None:
        self.buckets, self.wide, self.most = buckets, wide, most
        self.most_words = (1 << WORD_BITS) - ahead - 2
        self.words, self.languages = _Codes({b"": END}), _Codes()
        self.triples, self.held = [], 0

    def add(self, language: bytes, codes: np.ndarray, new: int) -> None:
        """Count the first ``new`` positions of ``codes``, which go on by two codes or end."""
        one = np.append(codes, [END, END])
        two, three = one[1:new + 1], one[2:new + 2]
        one = one[:new]
        three = np.where(two == END, END, three)
        key = self.languages[language]
        for code in (one, two, three):
            key = (key << WORD_BITS) | code
        self.triples.append(key[one != END])
        self.held += new

    def full(self) -> bool:
        return self.held >= self.most or len(self.words) >= self.most_words or len(self.languages) >= 1 << LANGUAGE_BITS

    def rows(self) -> Iterator[tuple[int, bytes]]:
        """(bucket, packed entries)."""
        mask = (1 << WORD_BITS) - 1
        keys, counts = np.unique(np.concatenate(self.triples), return_counts=True)
        self.triples = []
        if not len(keys):
            return
        prefix, counts = keys >> WORD_BITS, counts.astype(np.int32)
        language, one, two, three = (x.astype(np.int32) for x in (
            keys >> 3 * WORD_BITS, keys >> 2 * WORD_BITS & mask, prefix & mask, keys & mask))
        # Stripes: runs of one prefix.  Wide ones are split, their home gets a note.
        starts = np.flatnonzero(np.append(True, prefix[1:] != prefix[:-1]))
        width = np.diff(np.append(starts, len(keys)))
        kind = np.repeat(np.where(width > self.wide, PART, PAIR).astype(np.int8), width)
        wide = starts[width > self.wide]
        nothing = np.full(len(wide), END, np.int32)
        # The empty prefix: one entry per word.
        first = np.flatnonzero(np.append(True, (keys[1:] >> 2 * WORD_BITS) != (keys[:-1] >> 2 * WORD_BITS)))
        ends = np.full(len(first), END, np.int32)
        del keys, prefix
        language = np.concatenate([language, language[wide], language[first]])
        one, two, three = (np.concatenate(x) for x in ((one, one[wide], one[first]), (two, two[wide], ends), (three, nothing, ends)))
        counts = np.concatenate([counts, nothing, np.add.reduceat(counts, first)])
        kind = np.concatenate([kind, np.full(len(wide), NOTE, np.int8), np.full(len(first), WORD, np.int8)])

        languages = np.fromiter(map(xxhash.xxh3_64_intdigest, self.languages), np.uint64, len(self.languages))
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.words), np.uint64, len(self.words))
        last = np.where(kind == PART, hashes[three], np.uint64(0))
        second = np.where(kind == WORD, np.uint64(1), hashes[two])
        bucket = _dealt([languages[language], hashes[one], second, last], self.buckets)
        spelling = np.empty(len(self.words) + len(self.languages), object)
        spelling[:] = [*self.words, *self.languages]
        language += len(self.words)
        del hashes, last, second
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.append(True, bucket[order][1:] != bucket[order][:-1]))
        for rows in np.split(order, cuts[1:]):
            yield int(bucket[rows[0]]), _packed(kind[rows], [x[rows] for x in (language, one, two, three)], counts[rows], spelling)


def stripes(docs: DataFrame, buckets: int, *, text: str = "text", lang: str = "lang", wide: int = WIDE,
            block_words: int = BLOCK_WORDS, slice_words: int = SLICE_WORDS) -> DataFrame:
    """The stripes of all blocks: (bucket, entries)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def written(block: _Block) -> Iterator[pa.RecordBatch]:
            rows = block.rows()
            while part := list(islice(rows, ROWS_TOGETHER)):
                yield pa.RecordBatch.from_pydict({"bucket": pa.array([b for b, _ in part], pa.int64()),
                                                  "entries": pa.array([e for _, e in part], pa.binary())})

        block = _Block(buckets, wide, block_words, slice_words)
        for batch in batches:
            for language, raw in zip(byte_column(batch, "lang"), byte_column(batch, "text")):
                if not raw:
                    continue
                words = raw.translate(_LOWER).replace(b"\n", b" \n ").split(b" ")
                for start in range(0, len(words), slice_words):
                    # Two words more than are counted; ends stay, empty words go.
                    part = words[start:start + slice_words]
                    new = len([w for w in part if w])
                    at = start + slice_words
                    ahead: list[bytes] = []
                    while at < len(words) and len(ahead) < 2:
                        ahead += [words[at]] if words[at] else []
                        at += 1
                    code = block.words
                    codes = np.fromiter((END if w == b"\n" else code[w] for w in (*part, *ahead) if w), np.int64)
                    block.add(language, codes, new)
                    if block.full():
                        yield from written(block)
                        block = _Block(buckets, wide, block_words, slice_words)
        if block.held:
            yield from written(block)

    # Languages as hexadecimal digits: whatever they hold, they separate like words.
    rows = docs.select(F.hex(F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANGUAGE))).alias("lang"),
                       F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "bucket long, entries binary")


def _grouped(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Order that brings equal rows together, and where each group starts."""
    key = columns[0]
    for column in columns[1:]:
        _, key = np.unique(key, return_inverse=True)
        key = key << 32 | column
    order = np.argsort(key, kind="stable")
    key = key[order]
    return order, np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)


_MERGED = pa.schema([("kind", pa.int32()), ("lang", pa.string()), ("w1", pa.string()), ("w2", pa.string()), ("w3", pa.string()),
                     ("n", pa.int64()), ("right", pa.int64())])
_MERGED_DDL = "kind int, lang string, w1 string, w2 string, w3 string, n long, right long"
# Kinds of merged rows: words of a language, a word, a phrase of two, of three, an entry of a wide prefix.
TOTAL, ONE, TWO, THREE, WIDE_ENTRY = range(5)


def _merge(least: int):
    def run(table: pa.Table) -> pa.Table:
        code, parts = _Codes({b"": END}), []
        for packed in table.column("entries").to_pylist():
            words, numbers = _unpacked(packed)
            own = np.fromiter(map(code.__getitem__, words), np.int32, len(words))
            parts.append(np.concatenate([numbers[:1], own[numbers[1:5]], numbers[5:]]))
        kind, language, one, two, three, counts = np.concatenate(parts, axis=1)
        del parts
        order, starts = _grouped([kind.astype(np.int64) << 32 | language, one, two, three])
        counts = np.add.reduceat(counts[order], starts, dtype=np.int64)
        kind, language, one, two, three = (x[order][starts] for x in (kind, language, one, two, three))
        found: list[tuple] = []

        def put(name: int, rows: np.ndarray, n: np.ndarray, right: np.ndarray | None = None) -> None:
            found.append((np.full(len(rows), name), language[rows], one[rows], two[rows], three[rows], n,
                          np.zeros(len(rows), np.int64) if right is None else right))

        rows = np.flatnonzero(kind == WORD)
        put(ONE, rows[counts[rows] >= least], counts[rows][counts[rows] >= least])
        of, starts = _grouped([language[rows]])
        put(TOTAL, rows[of][starts], np.add.reduceat(counts[rows][of], starts) if len(rows) else counts[:0])
        rows = np.flatnonzero(kind == PART)
        put(WIDE_ENTRY, rows, counts[rows])
        # Entries and notes of prefixes at home lie together by prefix.
        rows = np.flatnonzero((kind == PAIR) | (kind == NOTE))
        if len(rows):
            order, starts = _grouped([language[rows], one[rows], two[rows]])
            rows, size = rows[order], np.diff(np.append(starts, len(rows)))
            wide = np.repeat(np.maximum.reduceat(kind[rows], starts) == NOTE, size)
            entry = kind[rows] == PAIR
            put(WIDE_ENTRY, rows[wide & entry], counts[rows][wide & entry])
            common = (counts[rows] >= least) & (three[rows] != END) & ~wide & entry
            put(THREE, rows[common], counts[rows][common])
            total = np.add.reduceat(counts[rows], starts)
            right = np.maximum.reduceat(np.where(common, counts[rows], 0), starts)
            kept = (total >= least) & (two[rows[starts]] != END) & ~wide[starts]
            put(TWO, rows[starts][kept], total[kept], right[kept])
        columns = [np.concatenate(x) for x in zip(*found)]
        spelling = pa.array(list(code), pa.binary()).cast(pa.string())
        texts = [spelling.take(pa.array(x)) for x in columns[1:5]]
        return pa.table([pa.array(columns[0], pa.int32()), *texts, pa.array(columns[5]), pa.array(columns[6])], schema=_MERGED)

    return run


def phrase_counts(docs: DataFrame, *, text: str = "text", lang: str = "lang", least: int = LEAST,
                  bucket_bytes: int = BUCKET_BYTES, **options) -> dict[str, DataFrame]:
    """Counts of at least ``least``: ``one`` (lang, w1, n), ``two`` (with ``right``, the greatest
    count of a phrase of three that goes on from it), ``three``; and ``total`` (lang, n)."""
    size = docs.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    buckets = max(1, math.ceil(size / bucket_bytes))
    merged = stored(stripes(docs, buckets, text=text, lang=lang, **options).groupBy("bucket")
                    .applyInArrow(_merge(least), _MERGED_DDL), "stripes")

    def of(kind: int, *columns: str) -> DataFrame:
        return merged.filter(F.col("kind") == kind).select(F.decode(F.unhex("lang"), "UTF-8").alias("lang"), *columns)

    # Wide prefixes: their entries come from several buckets.
    entries = of(WIDE_ENTRY, "w1", "w2", "w3", "n").groupBy("lang", "w1", "w2", "w3").agg(F.sum("n").alias("n"))
    common = (F.col("n") >= least) & (F.col("w3") != "")
    wide = entries.groupBy("lang", "w1", "w2").agg(
        F.sum("n").alias("n"), F.max(F.when(common, F.col("n")).otherwise(0)).cast("long").alias("right"))
    return {
        "total": of(TOTAL, "n").groupBy("lang").agg(F.sum("n").alias("n")),
        "one": of(ONE, "w1", "n"),
        "two": of(TWO, "w1", "w2", "n", "right").unionByName(wide.filter((F.col("n") >= least) & (F.col("w2") != ""))),
        "three": of(THREE, "w1", "w2", "w3", "n").unionByName(entries.filter(common)),
    }


def _score(a: str, left: str, right: str) -> Column:
    wide = [F.col(c).cast("decimal(18,0)") for c in (a, left, right)]
    return F.call_function("div", F.lit(1000000).cast("decimal(7,0)") * (wide[0] * wide[0]).cast("decimal(31,0)"), wide[1] * wide[2])


def collocations(docs: DataFrame, *, first: int = FIRST, percent: int = PERCENT, **options) -> DataFrame:
    """The first phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    counts = phrase_counts(docs, **options)
    one, two, three = counts["one"], counts["two"], counts["three"]

    def words(name: str, word: str) -> DataFrame:
        return one.select("lang", F.col("w1").alias(word), F.col("n").alias(name))

    def pairs(name: str, first_word: str, second_word: str) -> DataFrame:
        return two.select("lang", F.col("w1").alias(first_word), F.col("w2").alias(second_word), F.col("n").alias(name))

    left = three.groupBy("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2")).agg(F.max("n").alias("left"))
    of_two = two.join(left, ["lang", "w1", "w2"], "left") \
        .filter(100 * F.greatest("right", F.coalesce("left", F.lit(0))) < percent * F.col("n")) \
        .join(words("l", "w1"), ["lang", "w1"]).join(words("r", "w2"), ["lang", "w2"]) \
        .select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), F.col("n").alias("a"), "l", "r", _score("n", "l", "r").alias("score"))
    cuts = three.join(pairs("l2", "w1", "w2"), ["lang", "w1", "w2"]).join(pairs("r1", "w2", "w3"), ["lang", "w2", "w3"]) \
        .join(words("l1", "w1"), ["lang", "w1"]).join(words("r2", "w3"), ["lang", "w3"]) \
        .withColumns({"s1": _score("n", "l1", "r1"), "s2": _score("n", "l2", "r2")})
    earlier = F.col("s1") <= F.col("s2")
    of_three = cuts.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), F.col("n").alias("a"),
                           F.when(earlier, F.col("l1")).otherwise(F.col("l2")).alias("l"),
                           F.when(earlier, F.col("r1")).otherwise(F.col("r2")).alias("r"),
                           F.least("s1", "s2").alias("score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return of_two.unionByName(of_three).withColumn("rank", F.row_number().over(order)) \
        .filter(F.col("rank") <= first).withColumn("rank", F.col("rank").cast("long")) \
        .join(counts["total"], "lang") \
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
