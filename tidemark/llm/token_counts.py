"""Token counts of every prefix of a text, by dynamic programming over the merges of a tokenizer.

A byte-pair encoding has this property: a run of tokens is the encoding of its text exactly if
each two neighbours are the encoding of theirs.  So the encoding of a prefix is that of a
shorter prefix plus one token, and only one token fits.  Going once over a word gives, for
every prefix, its last token and hence its exact count; no prefix is ever encoded again.  The
word-end mark makes two cases of it: *open* prefixes, which go on, and *closed* ones, which end
here; a closed prefix is an open one plus one token that carries the mark.

Texts are cut at white space, which no token crosses.  What a stretch adds to the count at each
of its characters is computed once and kept by its spelling; the counts of a text are the
running sum over its stretches.  A text is worked through in windows of bounded size.

The stored counts answer by JVM expressions, without encoding again: how many tokens the first
n characters have (``tokens_of``), the longest start of a text within a budget (``truncated``),
which documents are over a limit.

Defined results: null and empty texts have no tokens; characters are code points of the text as
it is given, before the tokenizer's lower-casing and composition, and a prefix counts as if the
text ended there; special strings count as the tokenizer counts them by default; the vocabulary
file's path is a parameter.  Documents are rows: repeated or null ids do no harm; other columns
are left alone, a column of the new name gives way.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import map_batches

LIMIT = 2048
WINDOW = 1 << 20  # characters worked through at once
KEPT = 250_000  # spellings whose counts are kept, twice at most
PREFIXES_KEPT = 500_000  # and beginnings of words
NEVER = 1 << 40  # rank of a merge that does not exist
KEPT_LENGTH = 64  # longer ones are computed anew
WHITE = "\t-\r \x85\xa0  -     　"
_STRETCH = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
_BORDER = re.compile(f"[^{WHITE}][{WHITE}]")
_LEADING = re.compile(f"[{WHITE}]*")
# Below this bound lower-casing keeps the length and nothing composes, but for the dotted capital I.
_PLAIN_BOUND = 0x180
_OTHER = re.compile(f"[^\0-{chr(_PLAIN_BOUND - 1)}]|\u0130")


def _plain_piece() -> str:
    """How the tokenizer splits text below the bound; other text is split by the tokenizer itself."""
    def of(kind: str) -> str:
        return "".join(re.escape(c) for c in map(chr, range(_PLAIN_BOUND)) if unicodedata.category(c)[0] == kind)
    letters, numbers = of("L"), of("N")
    return f"[{letters}]+|[{numbers}]|'s|'t|'re|'ve|'m|'ll|'d|[^{letters}{numbers}{WHITE}]+"


_PLAIN_PIECE = re.compile(_plain_piece())
_PLAIN_SPACED = re.compile(f"[{WHITE}]*(?:{_plain_piece()})|[{WHITE}]+")


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@cache
def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it prints, else
    the next one above 255."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


class _Kept(dict):
    """Bytes by spelling, each computed once.

    When it has grown large it becomes the older half, from which what is asked for comes back;
    the half that was older is forgotten.
    """

    def __init__(self, compute) -> None:
        super().__init__()
        self.compute, self.older = compute, {}

    def __missing__(self, key: str):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= KEPT_LENGTH:
            if len(self) >= KEPT:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


class PrefixCounts:
    """Exact token counts of all prefixes of texts, for one vocabulary file."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.normalize = self.tokenizer.normalizer.normalize_str
        self.vocabulary = set(model["model"]["vocab"])
        self.mark = model["model"]["end_of_word_suffix"]
        self.ranks = {tuple(m): k for k, m in enumerate(model["model"]["merges"])}
        self.parts = {"".join(m): m for m in self.ranks}
        self.longest = max(len(t.removesuffix(self.mark)) for t in self.vocabulary)
        added = sorted((t["content"] for t in model["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, added))) if added else None
        self.fits: dict[tuple[str, str], bool] = {}
        self.own: dict[str, bool] = {}
        self.edges: tuple[dict, dict] = {}, {}
        self.pieces = _Kept(self._piece_steps)
        self.spaced = _Kept(self._spaced_steps)
        self.steps = _Kept(self._steps)
        self.prefixes: dict[str, tuple[str, int, int]] = {}
        self.older_prefixes: dict[str, tuple[str, int, int]] = {}
        self.letters: dict[str, str] = {}

    # One word ----------------------------------------------------------------------------------

    def _symbols(self, token: str) -> list[str]:
        if token.endswith(self.mark) and len(token) > len(self.mark):
            body = token[:-len(self.mark)]
            return [*body[:-1], body[-1] + self.mark]
        return list(token)

    def _whole(self, token: str) -> bool:
        """Whether a token is the encoding of its own text: merge the least rank first, the leftmost of it."""
        known = self.own.get(token)
        if known is None:
            symbols = self._symbols(token)
            while len(symbols) > 1:
                ranked = [(self.ranks.get(pair, NEVER), k) for k, pair in enumerate(zip(symbols, symbols[1:]))]
                rank, k = min(ranked)
                if rank == NEVER:
                    break
                symbols = [*symbols[:k], symbols[k] + symbols[k + 1], *symbols[k + 2:]]
            known = self.own[token] = len(symbols) == 1
        return known

    def _edge(self, token: str, side: int) -> list[tuple[int, str]]:
        """What stands at the left (0) or right (1) end of a token while it is put together, each
        with the rank of the merge that takes it up."""
        known = self.edges[side].get(token)
        if known is None:
            parts = self.parts.get(token)
            inner = [] if parts is None else self._edge(parts[side], side)
            known = [*inner[:-1], (self.ranks[parts], inner[-1][1])] if inner else []
            known = self.edges[side][token] = [*known, (NEVER, token)]
        return known

    def _fit(self, one: str, two: str) -> bool:
        """Whether the two tokens are the encoding of their text (``one`` may be empty).

        They are, unless a merge across their border comes before the merges that take up what
        stands there; of equal ranks the left one comes first.
        """
        known = self.fits.get((one, two))
        if known is None:
            known = self._whole(two)
            if known and one:
                left, right, i, j = self._edge(one, 1), self._edge(two, 0), 0, 0
                while True:
                    (p, a), (q, b) = left[i], right[j]
                    across = self.ranks.get((a, b), NEVER)
                    if across < p and across <= q:
                        known = False
                        break
                    if p == q == NEVER:
                        break
                    if p <= q:
                        i += 1
                    else:
                        j += 1
            if len(self.fits) >= 4 * KEPT:
                self.fits.clear()
            self.fits[one, two] = known
        return known

    def _closed_counts(self, piece: str) -> list[int]:
        """Tokens of each prefix of a piece, as a word that ends there.

        Per prefix: last token and count when open, count when closed.  Words share their
        beginnings, so prefixes are kept too.
        """
        if piece.isascii() and piece.isprintable():
            text, ends = piece, None
        else:
            letters = byte_letters()
            text = "".join(letters[b] for b in piece.encode())
            ends = list(accumulate(len(c.encode()) for c in piece))
        vocabulary, fits, fit, mark = self.vocabulary, self.fits, self._fit, self.mark
        kept, older = (self.prefixes, self.older_prefixes) if len(text) <= KEPT_LENGTH else ({}, {})
        last, count, closed = [""], [0], []
        for i in range(1, len(text) + 1):
            first = i - self.longest if i > self.longest else 0
            state = kept.get(text[:i]) or older.get(text[:i]) if i <= KEPT_LENGTH else None
            if state is None:
                ends_here, goes_on = 0, None
                for j in range(first, i):
                    token, before = text[j:i], last[j]
                    if goes_on is None and token in vocabulary:
                        known = fits.get((before, token))
                        if known or known is None and fit(before, token):
                            goes_on = token, count[j] + 1
                    if not ends_here:
                        token += mark
                        if token in vocabulary:
                            known = fits.get((before, token))
                            if known or known is None and fit(before, token):
                                ends_here = count[j] + 1
                    if ends_here and goes_on is not None:
                        break
                state = *goes_on, ends_here
                if i <= KEPT_LENGTH:
                    if len(kept) >= PREFIXES_KEPT:
                        older = self.older_prefixes = dict(kept)
                        kept.clear()
                    kept[text[:i]] = state
            last.append(state[0])
            count.append(state[1])
            closed.append(state[2])
        return closed if ends is None else [closed[k - 1] for k in ends]

    def _piece_steps(self, piece: str) -> bytes:
        """By how much each character of a normalized piece raises the count."""
        counts = self._closed_counts(piece)
        if piece[0] == "'" and len(piece) > 1 and piece[1].isalpha():
            # A contraction: what is cut off it is split otherwise.
            counts = [*(self._count(piece[:k]) for k in range(1, len(piece))), counts[-1]]
        return array("i", [b - a for a, b in zip([0, *counts], counts)]).tobytes()

    # One stretch without white space inside ---------------------------------------------------------

    def _split(self, text: str) -> list[str]:
        if _OTHER.search(text) is None:
            return _PLAIN_PIECE.findall(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def _count(self, text: str) -> int:
        """Tokens of normalized text."""
        return sum(sum(array("i", self.pieces[piece])) for piece in self._split(text))

    def _letter(self, c: str) -> str:
        known = self.letters.get(c)
        if known is None:
            known = self.letters[c] = self.normalize(c)
        return known

    def _segments(self, text: str) -> Iterator[str]:
        """Stretches whose composed forms do not depend on each other."""
        start = 0
        for i in range(1, len(text)):
            if not unicodedata.combining(text[i]):
                before, c = unicodedata.normalize("NFC", text[start:i])[-1], text[i]
                if unicodedata.normalize("NFC", before + c) == before + unicodedata.normalize("NFC", c):
                    yield text[start:i]
                    start = i
        yield text[start:]

    def _plain_steps(self, text: str) -> bytes:
        """The same for raw text without special strings and white space."""
        if _OTHER.search(text) is None:
            return b"".join(map(self.pieces.__getitem__, _PLAIN_PIECE.findall(text.lower())))
        whole, single = self.normalize(text), [self._letter(c) for c in text]
        pieces = self._split(whole)
        steps = b"".join(map(self.pieces.__getitem__, pieces))
        if len(single) == len(whole) and "".join(single) == whole:
            return steps
        counts = [0, *accumulate(array("i", steps))]
        if "".join(single) == whole:
            found = [counts[k] for k in accumulate(map(len, single))]
        else:
            # Characters that compose: prefixes that end inside a composition are counted from
            # the start of a piece before it, far enough for no contraction to reach across.
            starts = [0, *accumulate(map(len, pieces))]
            found, at = [], 0
            for segment in self._segments(text):
                for k in range(1, len(segment)):
                    piece = max((a for a in starts if a <= at - 3), default=0)
                    found.append(counts[piece] + self._count(whole[piece:at] + self.normalize(segment[:k])))
                at += len(self.normalize(segment))
                found.append(counts[at])
        return array("i", [b - a for a, b in zip([0, *found], found)]).tobytes()

    def _steps(self, stretch: str) -> bytes:
        """By how much each character of a stretch raises the count, as 32-bit numbers."""
        lead = _LEADING.match(stretch).end()
        text, done = stretch[lead:], bytes(4 * lead)
        if self.special is not None and "<|" in text:
            start = 0
            for m in self.special.finditer(text):
                # Up to its last character the special string is ordinary text.
                before = array("i", self._plain_steps(text[start:m.end() - 1]))
                before.append(sum(before[:m.start() - start]) + 1 - sum(before))
                done += before.tobytes()
                start = m.end()
            text = text[start:]
        return done + self._plain_steps(text) if text else done

    def _spaced_steps(self, spaced: str) -> bytes:
        """The same for a piece of plain lower-case text and the white space before it."""
        lead = _LEADING.match(spaced).end()
        return bytes(4 * lead) + (self.pieces[spaced[lead:]] if lead < len(spaced) else b"")

    # A text ----------------------------------------------------------------------------------------

    def windows(self, text: str | None) -> Iterator[np.ndarray]:
        """Counts of the prefixes of 1, 2, ... characters, a window of the text at a time."""
        start, base, text = 0, 0, text or ""
        while start < len(text):
            end = len(text)
            if end - start > WINDOW:  # up to the next border of a word
                border = _BORDER.search(text, start + WINDOW)
                end = border.start() + 1 if border else end
            part = text[start:end] if start or end < len(text) else text
            if _OTHER.search(part) is None and "<|" not in part:
                steps = b"".join(map(self.spaced.__getitem__, _PLAIN_SPACED.findall(part.lower())))
            else:
                steps = b"".join(map(self.steps.__getitem__, _STRETCH.findall(part)))
            steps = np.frombuffer(steps, np.int32)
            counts = np.cumsum(steps, dtype=np.int64) + base
            base = int(counts[-1])
            yield counts
            start = end

    def counts(self, text: str | None) -> np.ndarray:
        found = list(self.windows(text))
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def total(self, text: str | None) -> int:
        """The count at the last prefix, the whole text."""
        last = 0
        for counts in self.windows(text):
            last = int(counts[-1])
        return last


@cache
def counter(path: str) -> PrefixCounts:
    """One counter a process: the vocabulary is read once."""
    return PrefixCounts(path)


def token_counts(docs: DataFrame, *, path: str | None = None, doc_id: str = "doc_id", text: str = "text",
                 limit: int = LIMIT) -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens)."""
    path = path or default_path()

    def run(batch: pa.RecordBatch) -> dict:
        prefixes = counter(path)
        texts = batch.column(2)
        return {"doc_id": batch.column(0), "n_bytes": batch.column(1),
                "n_tokens": [prefixes.total(texts[i].as_py()) for i in range(batch.num_rows)]}

    rows = docs.select(F.col(doc_id).alias("doc_id"),
                       F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)).cast("long").alias("n_bytes"),
                       F.col(text).cast("string").alias("text"))
    schema = T.StructType([rows.schema["doc_id"], rows.schema["n_bytes"], T.StructField("n_tokens", T.LongType())])
    return map_batches(rows, run, schema).withColumn("over_limit", F.col("n_tokens") > limit)


def with_prefixes(docs: DataFrame, *, path: str | None = None, text: str = "text",
                  name: str = "token_prefixes") -> DataFrame:
    """The rows with an array of counts: element i is the count of the first i characters (from 1).

    Rows go through in parts, so that a batch of long texts is not held as arrays at once.
    """
    path = path or default_path()
    docs = docs.drop(name)
    columns, position = docs.columns, docs.columns.index(text)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.ArrayType(T.LongType(), False), False)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefixes = counter(path)
        for batch in batches:
            start, held = 0, []
            for i in range(batch.num_rows):
                held.append(prefixes.counts(batch.column(position)[i].as_py()))
                if sum(map(len, held)) >= WINDOW or i + 1 == batch.num_rows:
                    offsets = np.cumsum([0, *map(len, held)]).astype(np.int32)
                    added = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(held)))
                    part = batch.slice(start, len(held))
                    yield pa.RecordBatch.from_arrays([*part.columns, added], names=[*columns, name])
                    start, held = i + 1, []

    return docs.mapInArrow(run, schema)


def tokens_of(n_chars: Column | int, prefixes: str | Column = "token_prefixes") -> Column:
    """Tokens of the first ``n_chars`` characters, from the stored counts."""
    counts = F.col(prefixes) if isinstance(prefixes, str) else prefixes
    n = F.least(F.lit(n_chars) if isinstance(n_chars, int) else n_chars, F.size(counts))
    return F.when(n < 1, F.lit(0).cast("long")).otherwise(F.get(counts, n - 1))


def chars_within(budget: int, prefixes: str | Column = "token_prefixes") -> Column:
    """Characters of the longest start of the text with at most ``budget`` tokens.

    Counts may fall from one character to the next, so the last prefix that fits is looked for.
    """
    counts = F.col(prefixes) if isinstance(prefixes, str) else prefixes
    back = F.array_position(F.transform(F.reverse(counts), lambda n: n <= budget), True)
    return F.when(F.coalesce(back, F.lit(0)) == 0, F.lit(0)).otherwise(F.size(counts) - back + 1).cast("int")


def truncated(prefixed: DataFrame, budget: int, *, text: str = "text", prefixes: str = "token_prefixes") -> DataFrame:
    """The rows with their text cut to at most ``budget`` tokens, and its counts with it."""
    n = chars_within(budget, prefixes)
    return prefixed.withColumns({text: F.substring(F.col(text), F.lit(1), n),
                                 prefixes: F.slice(prefixes, F.lit(1), n)})
