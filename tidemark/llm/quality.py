"""Quality rules as a short-circuit cascade.

Every rule is a cheap test of one text.  Before the run, each rule is timed and its rejections
are counted on a bounded sample of rows, on the executors; rules then run in order of
rejections per second, and a text that one rule rejects meets no later one.  The order changes
the time, never the verdict: a text is kept if no rule rejects it.

Defined results: a null text has no words and fails the base rule; repeated rows are judged
alike; an empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, byte_column, code_points, filter_batches, map_batches

SAMPLE_ROWS = 2000  # rows that costs and rejections are estimated on, about
SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
LETTERS = UPPER + bytes(range(97, 123)) + bytes(range(0x80, 0x100))
NO_LETTERS = bytes(b for b in range(256) if b not in LETTERS and b not in SPACE)
MIN_WORDS = 50
REPEAT_PERCENT = 50


class Text:
    """What rules look at; each measure is taken once, when first asked for."""

    def __init__(self, raw: bytes | None):
        self.raw = raw or b""

    @cached_property
    def words(self) -> list[bytes]:
        return self.raw.split()

    @cached_property
    def lines(self) -> list[bytes]:
        return [line for line in self.raw.split(b"\n") if line.strip()]

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return code_points(b"".join(self.words))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, SYMBOLS))

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def dup_line_bytes(self) -> int:
        return sum(map(len, self.lines)) - sum(map(len, set(self.lines)))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words in a window of three that the text has twice or more."""
        w = self.words
        windows = list(zip(w, w[1:], w[2:]))
        if len(set(windows)) == len(windows):
            return 0
        first: dict[tuple, int] = {}
        hit = bytearray(len(w))
        for i, window in enumerate(windows):
            j = first.setdefault(window, i)
            if j != i:
                hit[i] = hit[i + 1] = hit[i + 2] = hit[j] = hit[j + 1] = hit[j + 2] = 1
        return sum(hit)

    @cached_property
    def n_letters(self) -> int:
        """ASCII letters and bytes of other characters."""
        return len(self.raw) - len(self.raw.translate(None, LETTERS))

    @cached_property
    def n_upper(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, UPPER))

    @cached_property
    def n_plain_words(self) -> int:
        """Words with a letter or a character beyond ASCII."""
        return len(self.raw.translate(None, NO_LETTERS).split())


@dataclass(frozen=True)
class Rule:
    """``rejects`` tells whether the text fails."""
    name: str
    rejects: Callable[[Text], bool]


BASE = (
    Rule("too_short", lambda t: t.n_words < MIN_WORDS),
    Rule("repeats", lambda t: 100 * t.n_repeat_words > REPEAT_PERCENT * t.n_words),
)
MORE = (
    Rule("symbols", lambda t: 10 * t.n_symbols > t.n_words),
    Rule("duplicate_lines", lambda t: 10 * t.dup_line_bytes > 3 * len(t.raw)),
    Rule("word_length", lambda t: not 2 * t.n_words <= t.word_chars <= 15 * t.n_words),
    Rule("few_letters", lambda t: 10 * t.n_plain_words < 7 * t.n_words),
    Rule("shouting", lambda t: 2 * t.n_upper > t.n_letters),
)
RULES = BASE + MORE


def estimate(docs: DataFrame, text: str, rules: Sequence[Rule] = RULES, *, sample_rows: int = SAMPLE_ROWS,
             seed: int = 7) -> dict[str, tuple[float, float]]:
    """Per rule, on a sample of about ``sample_rows`` rows: seconds a text and share rejected."""
    names = [r.name for r in rules]
    n = docs.count()
    fraction = min(1.0, sample_rows / n) if n else 1.0

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spent, rejected, rows = [0.0] * len(rules), [0] * len(rules), 0
        for batch in batches:
            for raw in batch.column(0).cast(pa.binary()).to_pylist():
                rows += 1
                for k, rule in enumerate(rules):
                    fresh = Text(raw)  # what a rule costs when it is the first to look
                    start = time.perf_counter()
                    rejected[k] += bool(rule.rejects(fresh))
                    spent[k] += time.perf_counter() - start
        yield pa.RecordBatch.from_pydict({"rule": names, "spent": spent, "rejected": rejected,
                                          "n": [rows] * len(rules)})

    sample = docs.select(F.col(text).cast("string")).sample(fraction=fraction, seed=seed)
    totals = sample.mapInArrow(measure, "rule string, spent double, rejected long, n long") \
        .groupBy("rule").agg(F.sum("spent"), F.sum("rejected"), F.sum("n")).collect()
    return {rule: (spent / n, rejected / n) if n else (0.0, 0.0) for rule, spent, rejected, n in totals}


def cascade_order(costs: dict[str, tuple[float, float]], rules: Sequence[Rule] = RULES) -> list[Rule]:
    """Rules by rejections per second, most first; unseen rules and ties keep their place."""
    def gain(rule: Rule) -> float:
        seconds, share = costs.get(rule.name, (0.0, 0.0))
        return share / max(seconds, 1e-9)
    return sorted(rules, key=lambda rule: -gain(rule))


def first_failure(text: Text, rules: Sequence[Rule]) -> str | None:
    return next((rule.name for rule in rules if rule.rejects(text)), None)


def judge(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", rules: Sequence[Rule] = MORE,
          sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per row: the base measures, ``base_failed``, ``kept`` and the rule that rejected it.

    Of several rules that would reject a text, ``failed_rule`` names the one that came first in
    this run's order; ``kept`` does not depend on it.
    """
    order = cascade_order(estimate(docs, text, rules, sample_rows=sample_rows), rules)

    def run(batch: pa.RecordBatch) -> dict:
        texts = [Text(raw) for raw in byte_column(batch, "text")]
        base = [any(rule.rejects(t) for rule in BASE) for t in texts]
        failed = ["base" if bad else first_failure(t, order) for t, bad in zip(texts, base)]
        return {
            "doc_id": batch.column(0), "n_words": [t.n_words for t in texts],
            "word_chars": [t.word_chars for t in texts], "n_symbols": [t.n_symbols for t in texts],
            "n_dup_lines": [t.n_dup_lines for t in texts], "n_repeat_words": [t.n_repeat_words for t in texts],
            "base_failed": base, "kept": [f is None for f in failed], "failed_rule": failed,
        }

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_batches(rows, run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                                  "n_repeat_words long, base_failed boolean, kept boolean, failed_rule string")


def keep_good(docs: DataFrame, *, text: str = "text", rules: Sequence[Rule] = RULES,
              sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows that no rule rejects, with all their columns; rules short-circuit."""
    order = cascade_order(estimate(docs, text, rules, sample_rows=sample_rows), rules)
    return filter_batches(docs, text, lambda texts: [first_failure(Text(raw), order) is None for raw in texts])
