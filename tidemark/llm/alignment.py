"""Alignment of two tokenizers: which tokens of one cover which tokens of the other.

1. One pass encodes each text with both tokenizers and walks along the byte ends of the tokens:
   tokens whose ranges overlap are linked, and places where both end cut groups.  Texts are taken
   apart first at single spaces and line breaks between other characters, where tokens of both
   begin anew (read off the vocabularies when they are loaded), so the alignment of a word is
   worked out once.
2. The pass numbers the documents inside blocks of bounded size and inverts its block: a *posting*
   per id pair, the compressed bitmap of the documents that hold the pair (16-bit numbers while
   few, bits when many), and multiplicity planes, plane k being the bitmap of the documents in
   which bit k of the number of further links is set.
3. Counts of a pair over the corpus are popcounts: documents from the bitmaps, links from bitmaps
   plus planes times powers of two.  Both run in the JVM and are summed before rows are shuffled.
   The best count of each id of the second tokenizer follows; that table has one row per id.
4. Postings and the scores of their pairs go to their block, where documents gather them.

A pair in every document costs a posting per block, never a row per document; blocks are bounded
in documents and in links, and no step holds more than a block.  Only postings and numbers are
shuffled, no text.

Defined results: null and empty texts, and those that either tokenizer does not give back byte
by byte, have no tokens: zeros, and an empty ``groups_sha256``.  Documents are rows; repeated or
null ids do no harm, and other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import byte_column, slices, stored
from tidemark.llm.token_counts import byte_letters

BLOCK_DOCS = 1 << 16  # local numbers have 16 bits
BLOCK_POSTINGS = 1 << 20  # pairs of documents of a block, at least one document
KEPT = 150_000  # words whose alignment is kept, about twice at most
KEPT_LENGTH = 64
TOGETHER = 4096  # words encoded in one call
SLICE_BYTES = 2 << 20
LOW = 0xFFFFFFFF
# A stretch ends before a single space or line break between characters that are no white space.
_STRETCH = re.compile(r"\s*\S+(?:(?![ \n]\S)\s+\S+)*(?:\s+\Z)?|\s+\Z")
_PLAIN_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


def default_paths() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Aligner:
    """Both tokenizers, the bytes of their tokens, and the alignments of words seen so far."""

    def __init__(self, path_a: str, path_b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        number = {letter: b for b, letter in enumerate(byte_letters())}
        self.bytes_a = {i: bytes(map(number.__getitem__, t)) if all(c in number for c in t) else t.encode()
                        for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(m[1], 16)]) if (m := _PLAIN_BYTE.fullmatch(p)) else p.replace("▁", " ").encode()
                        for p in pieces]
        # Merges of B cross no space and no line break: else texts stay whole.
        self.cut = not any(re.search("[^▁]▁|\n", p) for p in pieces)
        self.dummy = self.b.piece_to_id("▁")
        self.known: dict[str, tuple | None] = {}
        self.older: dict[str, tuple | None] = {}

    def _aligned(self, stretch: str, a: list[int], b: list[int]) -> tuple | None:
        """Numbers of A tokens, B tokens and groups; the links, A id above B id; the groups as text."""
        raw = stretch.encode()
        if raw[:1] != b" ":
            if b[:1] != [self.dummy]:
                return None
            b = b[1:]  # the space that B puts before any text
        bytes_a, bytes_b = [*map(self.bytes_a.__getitem__, a)], [*map(self.bytes_b.__getitem__, b)]
        if b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            return None
        links, groups, i, j = array("q"), [], 0, 0
        one, two = str(a[0]), str(b[0])
        ahead = len(bytes_a[0]) - len(bytes_b[0])  # by how much A's token ends later than B's
        last = len(a) - 1
        while True:
            links.append(a[i] << 32 | b[j])
            if ahead == 0:
                groups.append(f"{one}|{two}")
                if i == last:
                    break
                i, j = i + 1, j + 1
                one, two = str(a[i]), str(b[j])
                ahead = len(bytes_a[i]) - len(bytes_b[j])
            elif ahead < 0:
                i += 1
                one = f"{one},{a[i]}"
                ahead += len(bytes_a[i])
            else:
                j += 1
                two = f"{two},{b[j]}"
                ahead -= len(bytes_b[j])
        return len(a), len(b), len(groups), links.tobytes(), ";".join(groups)

    def _both(self, stretches: list[str]) -> list[tuple | None]:
        a = self.a.encode_batch(stretches, add_special_tokens=False)
        b = self.b.encode([s[1:] if s[0] == " " else s for s in stretches], num_threads=1)
        return [self._aligned(s, x.ids, y) for s, x, y in zip(stretches, a, b)]

    def whole(self, text: str) -> tuple | None:
        """The alignment of a text encoded in one go."""
        return self._both([" " + text])[0]

    def align(self, texts: list[str | None]) -> list[tuple | None]:
        """Per text: n_a, n_b, n_groups, links, groups; None if it has no tokens."""
        cut = [([] if not t else _STRETCH.findall(" " + t) if self.cut else [" " + t]) for t in texts]
        known, older, fresh = self.known, self.older, {}
        for stretch in set(chain.from_iterable(cut)).difference(known):
            if stretch in older:
                known[stretch] = older[stretch]
            else:
                fresh[stretch] = None
        spellings = list(fresh)
        for start in range(0, len(spellings), TOGETHER):
            part = spellings[start:start + TOGETHER]
            fresh.update(zip(part, self._both(part)))
        found = []
        for text, stretches in zip(texts, cut):
            parts = [known[s] if s in known else fresh[s] for s in stretches]
            if None in parts:
                found.append(self.whole(text))
            elif not parts:
                found.append(None)
            elif len(parts) == 1:
                found.append(parts[0])
            else:
                a, b, groups, links, names = zip(*parts)
                found.append((sum(a), sum(b), sum(groups), b"".join(links), ";".join(names)))
        known.update((s, x) for s, x in fresh.items() if len(s) <= KEPT_LENGTH)
        if len(known) > KEPT:  # from then on the older half, from which what occurs again comes back
            self.known, self.older = {}, known
        return found


@cache
def aligner(path_a: str, path_b: str) -> Aligner:
    """One aligner a process."""
    return Aligner(path_a, path_b)


# Bitmaps -----------------------------------------------------------------------------------------

def _packed(numbers: np.ndarray, size: int) -> bytes:
    """A compressed bitmap: a tag, then sorted 16-bit numbers or, if shorter, bits."""
    if 2 * len(numbers) <= (size + 7) // 8:
        return b"\0" + numbers.astype("<u2").tobytes()
    bits = np.zeros(size, np.uint8)
    bits[numbers] = 1
    return b"\1" + np.packbits(bits, bitorder="little").tobytes()


def _unpacked(packed: bytes) -> np.ndarray:
    if packed[0] == 0:
        return np.frombuffer(packed, "<u2", offset=1).astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(packed, np.uint8, offset=1), bitorder="little"))


def popcount(packed: Column) -> Column:
    few = F.substring(packed, 1, 1) == F.lit(b"\0")
    return F.when(few, F.floor((F.octet_length(packed) - 1) / 2)) \
        .otherwise(F.bitmap_count(F.substring(packed, F.lit(2), F.octet_length(packed)))).cast("long")


def _postings(pairs: np.ndarray, docs: np.ndarray, times: np.ndarray, size: int) -> dict[str, list]:
    """The documents (numbers below ``size``) and multiplicity planes of each pair of a block."""
    order = np.lexsort((docs, pairs))
    pairs, docs, more = pairs[order], docs[order], times[order] - 1
    names, starts = np.unique(pairs, return_index=True)
    ends = np.append(starts[1:], len(pairs))
    most = np.maximum.reduceat(more, starts) if len(pairs) else more
    bitmaps, planes = [], []
    for start, end, top in zip(starts.tolist(), ends.tolist(), most.tolist()):
        own = docs[start:end]
        bitmaps.append(_packed(own, size))
        planes.append([_packed(own[(more[start:end] >> k) & 1 == 1], size) for k in range(top.bit_length())])
    return {"pair": names.tolist(), "docs": bitmaps, "planes": planes}


_INDEX = pa.schema([("block", pa.int64()), ("number", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()),
                    ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()),
                    ("pair", pa.int64()), ("docs", pa.binary()), ("planes", pa.list_(pa.binary()))])
_INDEX_DDL = ("block long, number int, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
              "groups_sha256 string, pair long, docs binary, planes array<binary>")


class _Block:
    """Documents and links gathered until the block is full."""

    def __init__(self, name: int) -> None:
        self.name, self.rows, self.pairs, self.times, self.held = name, [], [], [], 0

    def add(self, doc_id: int | None, found: tuple | None) -> None:
        if found is None:
            self.rows.append((doc_id, 0, 0, 0, 0, ""))
            pairs = times = np.empty(0, np.int64)
        else:
            n_a, n_b, n_groups, links, groups = found
            self.rows.append((doc_id, n_a, n_b, n_groups, len(links) // 8, hashlib.sha256(groups.encode()).hexdigest()))
            pairs, times = np.unique(np.frombuffer(links, np.int64), return_counts=True)
        self.pairs.append(pairs)
        self.times.append(times)
        self.held += len(pairs)

    def full(self) -> bool:
        return len(self.rows) >= BLOCK_DOCS or self.held >= BLOCK_POSTINGS

    def batches(self) -> Iterator[pa.RecordBatch]:
        n = len(self.rows)
        columns = list(zip(*self.rows))
        yield _batch(n, block=[self.name] * n, number=list(range(n)), **dict(zip(
            ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"), map(list, columns))))
        if self.held:
            docs = np.repeat(np.arange(n), [len(p) for p in self.pairs])
            found = _postings(np.concatenate(self.pairs), docs, np.concatenate(self.times), n)
            yield _batch(len(found["pair"]), block=[self.name] * len(found["pair"]), **found)


def _batch(rows: int, **columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns
                                       else pa.nulls(rows, f.type) for f in _INDEX], schema=_INDEX)


def inverted(docs: DataFrame, *, path_a: str | None = None, path_b: str | None = None, doc_id: str = "doc_id",
             text: str = "text") -> DataFrame:
    """The inverted index, written once: document rows (``pair`` null) and postings, by block."""
    default_a, default_b = default_paths() if path_a is None or path_b is None else ("", "")
    path_a, path_b = path_a or default_a, path_b or default_b

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = aligner(path_a, path_b)
        first = TaskContext.get().partitionId() << 32
        block = _Block(first)
        for batch in batches:
            names, raws = batch.column(0).to_pylist(), byte_column(batch, "text")
            for start, end in slices(raws, SLICE_BYTES):
                found = tokens.align([raw.decode() if raw else None for raw in raws[start:end]])
                for name, one in zip(names[start:end], found):
                    block.add(name, one)
                    if block.full():
                        yield from block.batches()
                        block = _Block(block.name + 1)
        if block.rows:
            yield from block.batches()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return stored(rows.mapInArrow(run, _INDEX_DDL), "inverted-pairs")


def pair_counts(index: DataFrame) -> DataFrame:
    """Per linked id pair over the corpus: a, b, pair, links and documents."""
    further = F.aggregate(
        F.transform("planes", lambda p, k: F.call_function("shiftleft", popcount(p), k)),
        F.lit(0).cast("long"), lambda total, n: total + n)
    docs = popcount(F.col("docs"))
    counted = index.filter("pair IS NOT NULL").select("pair", docs.alias("d"), (docs + further).alias("n")) \
        .groupBy("pair").agg(F.sum("n").alias("links"), F.sum("d").alias("documents"))
    return counted.select(F.shiftright("pair", 32).alias("a"), F.col("pair").bitwiseAND(F.lit(LOW)).alias("b"),
                          "pair", "links", "documents")


def scored_pairs(index: DataFrame) -> DataFrame:
    """``pair_counts`` with ``best``: whether no pair of the same B id has more links."""
    pairs = stored(pair_counts(index), "pair-counts")
    most = pairs.groupBy("b").agg(F.max("links").alias("most"))  # a row per id of the vocabulary
    return pairs.join(most, "b").withColumn("best", F.col("links") == F.col("most")).drop("most")


_SCORED = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                     ("n_links", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups_sha256", pa.string())])


def _gathered(docs: pa.Table, postings: pa.Table) -> pa.Table:
    """Document rows of one block with the scores that its postings bring."""
    rows = docs.num_rows
    best, total = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    place = np.asarray(docs["number"])
    is_score = postings["docs"].is_null()
    scores, bitmaps = postings.filter(is_score), postings.filter(pc.invert(is_score))
    pairs = np.asarray(scores["pair"])
    order = np.argsort(pairs)
    links, of_best = np.asarray(scores["links"])[order], np.asarray(scores["best"])[order]
    for batch in bitmaps.to_batches(1 << 14):
        at = np.searchsorted(pairs, np.asarray(batch["pair"]), sorter=order)
        for packed, planes, n, is_best in zip(batch["docs"].to_pylist(), batch["planes"].to_pylist(), links[at].tolist(), of_best[at].tolist()):
            own = _unpacked(packed)
            total[own] += n
            if is_best:
                best[own] += 1
            for k, plane in enumerate(planes):
                own = _unpacked(plane)
                total[own] += n << k
                if is_best:
                    best[own] += 1 << k
    return pa.table([docs[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
                    + [pa.array(best[place]), pa.array(total[place]), docs["groups_sha256"]], schema=_SCORED)


def align(docs: DataFrame, **options) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256."""
    index = inverted(docs, **options)
    rows = index.filter("pair IS NULL").select("block", "number", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    postings = index.filter("pair IS NOT NULL").select(F.col("block").alias("own_block"), "pair", "docs", "planes")
    # Scores go to the blocks as numbers; the bitmaps move once, to their block's documents.
    scores = postings.select("own_block", "pair").join(scored_pairs(index).select("pair", "links", "best"), "pair")
    whole = postings.select("own_block", "pair", "docs", "planes", F.lit(None).cast("long").alias("links"),
                            F.lit(None).cast("boolean").alias("best")) \
        .unionByName(scores.select("own_block", "pair", F.lit(None).cast("binary").alias("docs"),
                                   F.lit(None).cast("array<binary>").alias("planes"), "links", "best"))
    return rows.groupBy("block").cogroup(whole.groupBy("own_block")).applyInArrow(
        _gathered, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
