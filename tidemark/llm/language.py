"""Language identification by cross-parsing.

For every language, a suffix automaton of labelled text answers how long a match of the coming
characters is.  A text is parsed greedily into longest matches against each language; few, long
phrases mean a similar language.  Phrases times the bits that point into the language's text,
per character, estimate the cross entropy; the least one wins.

The automata are fitted on a bounded sample: ``TRAIN_CHARS`` characters over all languages, at
most ``DOC_CHARS`` of one document, at a place drawn by hash, of at most ``DOCS`` documents a
language, drawn by hash from the labelled rows that are not held out.
Predictions read whole texts.  Texts are parsed in stretches of ``STRETCH`` characters, all of a
batch side by side, so the walk through the automata is array work.

Defined results: null texts and texts without a letter are ``und`` with score 0, as is every
text when nothing could be learned; ties go to the language first by code point; a null doc_id
counts as an empty text; repeated rows are alike; other columns are never read.
"""

from __future__ import annotations

from collections import Counter
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, slices, stored

TRAIN_CHARS = 160_000
DOC_CHARS = 1_000
DOCS = 200  # documents a language, at most
FOLDS = 5
LETTERS = 60  # letters with a column of the dense table; the transitions of all others are sorted keys
STRETCH = 256
SLICE = 2 << 20
OTHER, BLANK, PAD = 0, 1, 2  # an unknown letter, anything between words, the end of a stretch
UNKNOWN = "und"


def automaton(text: str) -> list[dict[str, int]]:
    """Transitions of the suffix automaton of a text; state 0 is the start."""
    moves: list[dict[str, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return moves


def folded(text: str) -> str:
    """Lower-cased words with one blank between them."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


class Model:
    """The automata of all languages in one table of next places, and sorted keys for rarer letters."""

    def __init__(self, texts: tuple[tuple[str, str], ...]):
        self.languages = [name for name, _ in texts]
        seen = Counter(c for _, text in texts for c in text if c != " ")
        code = {c: 3 + k for k, (c, _) in enumerate(sorted(seen.items(), key=lambda x: (-x[1], x[0])))}
        code[" "] = BLANK
        self.width = 3 + min(LETTERS, len(seen))
        self.alphabet = 3 + len(seen)
        tables, at = [np.zeros((1, self.width), np.int32)], 1  # state 0 matches nothing
        keys, values = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        self.afresh = np.zeros((len(texts), self.alphabet), np.int32)
        for k, (_, text) in enumerate(texts):
            moves = automaton(text)
            table = np.zeros((len(moves), self.width), np.int32)
            rows = [(s, code[c], t) for s, own in enumerate(moves) for c, t in own.items()]
            s, c, t = np.array(rows, np.int64).reshape(-1, 3).T
            t = (t + at) * self.width
            self.afresh[k, c[s == 0]] = t[s == 0]
            dense = c < self.width
            table[s[dense], c[dense]] = t[dense]
            keys.append((s[~dense] + at) * self.width * self.alphabet + c[~dense])
            values.append(t[~dense])
            tables.append(table)
            at += len(moves)
        self.next = np.concatenate(tables).reshape(-1)  # 0: no such match
        self.bits = np.log2([len(text) + 2 for _, text in texts])
        keys, values = np.concatenate(keys), np.concatenate(values)
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]
        self.code = np.where(_letters(), OTHER, BLANK).astype(np.min_scalar_type(self.alphabet))
        for c, k in code.items():
            self.code[ord(c)] = k

    def _after(self, state: np.ndarray, column: np.ndarray) -> np.ndarray:
        rare = np.flatnonzero(column >= self.width)
        if not len(rare):
            return self.next[state + column]
        after = self.next[state + np.where(column < self.width, column, OTHER)]
        wanted = state[:, rare].astype(np.int64) * self.alphabet + column[rare]
        place = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        after[:, rare] = np.where(self.keys[place] == wanted, self.values[place], 0)
        return after

    def phrases(self, stretches: np.ndarray) -> np.ndarray:
        """Phrases of each stretch (rows) in each language (columns)."""
        state = np.zeros((len(self.languages), len(stretches)), np.int32)
        count = np.zeros(state.shape, np.int32)
        for column in np.ascontiguousarray(stretches.T):
            after = self._after(state, column)
            missed = after == 0
            count += missed
            state = np.where(missed, self.afresh[:, column], after)
        return (count - (stretches == PAD).sum(axis=1, dtype=np.int32)).T

    def predict(self, texts: list[bytes | None]) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = []
        for start, end in slices(texts, SLICE):
            out += self._predict(texts[start:end])
        return out

    def _predict(self, texts: list[bytes | None]) -> list[tuple[str, float]]:
        parts = [np.frombuffer((raw or b"").decode().lower().encode("utf-32-le"), np.uint32) for raw in texts]
        owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        code = self.code[np.concatenate(parts)] if len(owner) else np.empty(0, self.code.dtype)
        has_letter = np.bincount(owner[code != BLANK], minlength=len(parts)) > 0
        keep = np.ones(len(code), bool)  # one blank between words
        keep[1:] = (code[1:] != BLANK) | (code[:-1] != BLANK) | (owner[1:] != owner[:-1])
        code, owner = code[keep], owner[keep]
        size = np.bincount(owner, minlength=len(parts))
        pieces = -(-size // STRETCH)
        of = np.repeat(np.arange(len(parts)), pieces)
        turn = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first = (np.cumsum(size) - size)[of] + turn * STRETCH
        place = first[:, None] + np.arange(STRETCH)
        inside = place < np.minimum(first + STRETCH, np.cumsum(size)[of])[:, None]
        stretches = np.full(place.shape, PAD, self.code.dtype)
        stretches[inside] = code[place[inside]]
        total = np.zeros((len(parts), len(self.languages)))
        np.add.at(total, of, self.phrases(stretches))
        cost = total * self.bits / np.maximum(size, 1)[:, None]
        order = np.argsort(cost, axis=1, kind="stable")
        out = []
        for i, good in enumerate(has_letter.tolist()):
            if not good:
                out.append((UNKNOWN, 0.0))
                continue
            best = order[i, 0]
            second = cost[i, order[i, 1]] if len(self.languages) > 1 else np.inf
            out.append((self.languages[best], float(min(1.0, max(0.0, 1 - cost[i, best] / second)))))
        return out


@cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


@cache
def _model(texts: tuple[tuple[str, str], ...]) -> Model:
    """Built once in each Python worker."""
    return Model(texts)


def _remainder(doc_id: str) -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


def training_texts(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
                   train_chars: int = TRAIN_CHARS, seed: int = 3) -> tuple[tuple[str, str], ...]:
    """Folded labelled text by language, from a bounded sample of the rows not held out."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(lang).cast("string").alias("lang"),
                       F.col(text).cast("string").alias("text")) \
        .filter((_remainder("doc_id") != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    drawn = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id"))
    # Documents are drawn, not rows: one that is repeated is drawn once, and gives one stretch.
    chosen = stored(rows.select("lang", "doc_id").distinct().withColumn("n", drawn).filter(F.col("n") <= DOCS), "drawn")
    places = F.greatest(F.lit(1), F.length("text") - DOC_CHARS + 1)
    place = (F.pmod(F.xxhash64("text", F.lit(seed)), places) + 1).cast("int")
    picked = rows.join(chosen, ["lang", "doc_id"]) \
        .groupBy("lang", "n").agg(F.min(F.substr("text", place, F.lit(DOC_CHARS))).alias("text")).orderBy("lang", "n").collect()
    names = sorted({r["lang"] for r in picked})
    texts = []
    for name in names:
        joined = " ".join(t for t in (folded(r["text"]) for r in picked if r["lang"] == name) if t)
        joined = joined[:train_chars // len(names)]
        if joined:
            texts.append((name, joined))
    return tuple(texts)


def identify(docs: DataFrame, texts: tuple[tuple[str, str], ...], *, doc_id: str = "doc_id",
             text: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, lang_pred and score; only the text is looked at."""
    def run(batch: pa.RecordBatch) -> dict:
        raw = batch.column(2).cast(pa.binary()).to_pylist()
        found = _model(texts).predict(raw) if texts else [(UNKNOWN, 0.0)] * len(raw)
        return {"doc_id": batch.column(0), "held_out": batch.column(1), "lang_pred": [f[0] for f in found],
                "score": [f[1] for f in found]}

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), (_remainder(doc_id) == 0).alias("held_out"),
                       F.col(text).cast("string").alias("text"))
    return map_batches(rows, run, "doc_id long, held_out boolean, lang_pred string, score double")
