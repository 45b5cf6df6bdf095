"""Benchmark decontamination with suffix arrays over the training text.

Each task builds, shard by shard (a few megabytes of documents), a word-level suffix array of
its training text and binary-searches the suffixes of every benchmark item in it.  The array
is sparse: a suffix is left out when its first words occur nowhere in the benchmark as such a
sequence, since no search can then end at it; nothing that can match is left out.  An interval
of the array gives all places of a benchmark window; windows that follow each other at
successive places form the longest verbatim match.

The benchmark is the query set.  It is handed to the tasks in blocks of bounded size, one
narrow pass for each, so a benchmark of any size is searched and no shuffle is needed.

Defined results: null and word-less texts have no words and no hits; item ids that are null
count as one item and are left out of id lists; repeated documents are judged each for itself;
an empty benchmark hits nothing; other columns are never read.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import filter_batches, map_batches, slices

WINDOW = 10
BLOCK_BYTES = 16 << 20  # benchmark text handed to the tasks at once
# Lower-cases A-Z and blanks what ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` leaves out; words are whole code points.
FOLD = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32
             for b in range(256))
PRUNE = 4  # words of a suffix looked up before it enters the array, at most


def words(raw: bytes | None) -> list[bytes]:
    return raw.translate(FOLD).split() if raw else []


class Block:
    """The windows of some benchmark items as sequences of word numbers."""

    def __init__(self, items: list[tuple[str | None, bytes | None]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        number = self.vocabulary
        found: dict[tuple[int, ...], list[tuple[str | None, int]]] = defaultdict(list)
        for item, raw in items:
            ids = [number.setdefault(w, len(number) + 1) for w in words(raw)]
            size = min(window, len(ids))
            for at in range(len(ids) - size + 1 if ids else 0):
                found[tuple(ids[at:at + size])].append((item, at))
        self.patterns = list(found)
        self.places = list(found.values())
        self.shortest = min(map(len, self.patterns), default=0)
        self._low = self._keys(0)
        self._high = self._keys(-1)
        # Numbers of the word sequences of 2 and 4 words that windows begin with.
        self._pairs = self._quads = np.empty(0, np.int64)
        base = len(number) + 1
        if self.shortest >= 2:
            self._pairs = np.unique(np.array([p[k] * base + p[k + 1] for p in self.patterns
                                              for k in ((0, 2) if len(p) >= PRUNE else (0,))], np.int64))
        if self.shortest >= PRUNE:
            self._quads = np.unique(np.array([self._pair(p[0] * base + p[1]) * len(self._pairs)
                                              + self._pair(p[2] * base + p[3]) for p in self.patterns], np.int64))

    def _pair(self, key: int) -> int:
        return int(np.searchsorted(self._pairs, key))

    def _keys(self, fill: int) -> np.ndarray:
        """Sort keys of the windows; short ones filled with what sorts first or last."""
        grid = np.full((len(self.patterns), self.window), fill, ">i4").view(">u4")
        for row, pattern in enumerate(self.patterns):
            grid[row, :len(pattern)] = pattern
        return _as_bytes(grid)

    def _starts(self, text: np.ndarray) -> np.ndarray:
        """Places of the text whose first words begin some window."""
        base = len(self.vocabulary) + 1
        if self.shortest < 2:
            first = np.zeros(base, bool)
            first[[p[0] for p in self.patterns]] = True
            return np.flatnonzero(first[text[:-self.window]])
        at = np.flatnonzero((text[:-self.window] > 0) & (text[1:1 - self.window or None][:len(text) - self.window] > 0))
        keys = text[at].astype(np.int64) * base + text[at + 1]
        rank = np.searchsorted(self._pairs, keys)
        rank[rank == len(self._pairs)] = 0
        known = self._pairs[rank] == keys
        at, rank = at[known], rank[known]
        if self.shortest < PRUNE or not len(at):
            return at
        by_place = np.full(len(text), -1, np.int64)
        by_place[at] = rank
        after = by_place[at + 2]
        keys = np.where(after >= 0, rank * len(self._pairs) + after, -1)
        slot = np.searchsorted(self._quads, keys)
        slot[slot == len(self._quads)] = 0
        return at[self._quads[slot] == keys]

    def search(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (window, place) matches in a text of word numbers that ends in ``window`` zeros."""
        nothing = np.empty(0, np.int64)
        if not self.patterns or len(text) <= self.window:
            return nothing, nothing
        starts = self._starts(text)
        if not len(starts):
            return nothing, nothing
        grid = text[starts[:, None] + np.arange(self.window)].astype(">u4")
        suffixes = _as_bytes(grid)
        order = np.argsort(suffixes, kind="stable")  # the sparse suffix array: starts[order]
        suffixes = suffixes[order]
        low = np.searchsorted(suffixes, self._low, "left")
        high = np.searchsorted(suffixes, self._high, "right")
        count = np.maximum(high - low, 0)
        window = np.repeat(np.arange(len(count)), count)
        inside = np.arange(len(window)) - np.repeat(np.cumsum(count) - count, count)
        return window, starts[order[np.repeat(low, count) + inside]]

    def scan(self, texts: list[bytes | None]) -> list[tuple[int, list[tuple[int, int]], set, int]]:
        """Per text: its words, merged hit ranges, items with occurring windows, longest match in words."""
        out = []
        for start, end in slices(texts):
            out += self._scan(texts[start:end])
        return out

    def _scan(self, texts: list[bytes | None]) -> list[tuple[int, list[tuple[int, int]], set, int]]:
        get, lengths, parts = self.vocabulary.get, [], []
        for raw in texts:
            own = words(raw)
            lengths.append(len(own))
            parts.append(np.fromiter(map(get, own, repeat(0)), np.int32, len(own)))
            parts.append(np.zeros(1, np.int32))  # no match crosses from one document to the next
        text = np.concatenate([*parts, np.zeros(self.window, np.int32)])
        first = np.cumsum([0, *(n + 1 for n in lengths)])
        window, place = self.search(text)
        out = [(n, [], set(), 0) for n in lengths]
        if not len(place):
            return out
        by_place = np.argsort(place, kind="stable")
        window, place = window[by_place], place[by_place]
        owner = np.searchsorted(first, place, "right") - 1
        runs: dict[tuple, tuple[int, int]] = {}
        for w, p, d in zip(window.tolist(), place.tolist(), owner.tolist()):
            n, ranges, items, longest = out[d]
            at, size = p - int(first[d]), len(self.patterns[w])
            if ranges and at <= ranges[-1][1]:
                ranges[-1] = (ranges[-1][0], max(ranges[-1][1], at + size))
            else:
                ranges.append((at, at + size))
            for item, offset in self.places[w]:
                items.add(item)
                last, length = runs.get((d, item, at - offset), (-2, 0))
                length = length + 1 if last == at - 1 else size
                runs[(d, item, at - offset)] = (at, length)
                longest = max(longest, length)
            out[d] = (n, ranges, items, longest)
        return out


def _as_bytes(grid: np.ndarray) -> np.ndarray:
    """Rows of big-endian numbers as byte strings: they sort as the rows do."""
    width = grid.shape[1] * 4
    return np.ascontiguousarray(grid).view(f"S{width}").reshape(-1)


def blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int, window: int) -> list[Block]:
    """The query set in blocks of about ``block_bytes``."""
    items = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-total // block_bytes))
    part = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    return [Block([(r["item"], None if r["text"] is None else r["text"].encode())
                   for r in items.filter(part == k).collect()], window) for k in range(n)]


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


RESULT = ("doc_id long, n_words long, n_hit long, items array<string>, longest_match long, "
          "spans array<struct<start:int,end:int>>")


def find_matches(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                 item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: words, words hit, the items found (null: an item without id), the longest
    verbatim match and the hit ranges of words."""
    query = blocks(benchmark, item_id, item_text, block_bytes, window)
    out = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    for k, block in enumerate(query):
        last = k == len(query) - 1

        def scan(batch: pa.RecordBatch, block=block, first=k == 0, last=last) -> dict:
            raw = batch.column(1).cast(pa.binary()).to_pylist()
            rows = block.scan(raw)
            before = repeat((None, None, None, None)) if first else zip(*(
                batch.column(batch.schema.get_field_index(c)).to_pylist()
                for c in ("items", "longest_match", "spans", "n_hit")))
            items, longest, spans, hit = [], [], [], []
            for (_, ranges, own, match), (old, most, places, _) in zip(rows, before):
                ranges = _merged(ranges + [(s["start"], s["end"]) for s in places or ()])
                items.append(sorted(own | set(old or ()), key=lambda x: (x is None, x or "")))
                longest.append(max(match, most or 0))
                spans.append([{"start": s, "end": e} for s, e in ranges])
                hit.append(sum(e - s for s, e in ranges))
            out = {"doc_id": batch.column(0), "n_words": [r[0] for r in rows], "n_hit": hit, "items": items,
                   "longest_match": longest, "spans": spans}
            return out if last else {**out, "text": batch.column(1)}

        # The text travels on only while a block is left to search.
        schema = RESULT if last else "doc_id long, text string, " + RESULT.partition(", ")[2]
        out = map_batches(out, scan, schema)
    return out


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id",
                        item_text: str = "text", window: int = WINDOW,
                        block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents in which no window of the benchmark occurs, with all their columns."""
    out = docs
    for block in blocks(benchmark, item_id, item_text, block_bytes, window):
        out = filter_batches(out, text, lambda texts, block=block: [not row[1] for row in block.scan(texts)])
    return out
